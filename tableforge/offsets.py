"""Offsets and lag of message logs: frames with topic, partition, offset and timestamp, and frames of commits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART = ["topic", "partition"]
#: Topic partitions that may be broadcast.
FEW = 100_000


def topic_offsets(log: DataFrame) -> DataFrame:
    """Per partition: low, high (the next offset) and lag, the retained messages. A missing topic gives no rows. On a
    ``stored_log`` no message is read."""
    ends = log.groupBy(*PART).agg(F.min("offset").alias("low"), F.max("offset").alias("last"))
    return ends.select(*PART, "low", (F.col("last") + 1).alias("high"), (F.col("last") + 1 - F.col("low")).alias("lag"))


def write_log(log: DataFrame, path: str) -> None:
    """Store a log by topic and partition, each sorted by offset: questions about offsets then read footers, and questions
    about one partition or a range of offsets read little else."""
    log.repartition(*PART).sortWithinPartitions(*PART, "offset").write.partitionBy(*PART).parquet(path)


def stored_log(spark: SparkSession, path: str) -> DataFrame:
    """A log that ``write_log`` stored, by the reader that takes counts, least and largest values from Parquet footers. This
    turns the session's spark.sql.parquet.aggregatePushdown on."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    listed = spark.conf.get("spark.sql.sources.useV1SourceList")
    try:  # the reader is chosen here, for this frame alone
        spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in listed.split(",") if x != "parquet"))
        return spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", listed)


def group_lag(log: DataFrame, commits: DataFrame, group_id: str) -> DataFrame:
    """Per partition: committed (0 where there is no commit), high and lag of one consumer group."""
    own = commits.where(F.col("group_id") == group_id).select(*PART, "committed_offset")
    committed = F.coalesce("committed_offset", F.lit(0).cast("long"))
    return topic_offsets(log).join(own, PART, "left").select(*PART, committed.alias("committed"), "high", (F.col("high") - committed).alias("lag"))


def group_total_lag(log: DataFrame, commits: DataFrame, group_id: str) -> DataFrame:
    return group_lag(log, commits, group_id).groupBy("topic").agg(F.sum("lag").alias("total_lag"))


def offsets_latest(log: DataFrame) -> DataFrame:
    """The offsets that a group commits to skip all that is there."""
    return topic_offsets(log).select(*PART, F.col("high").alias("committed_offset"))


def starting_offsets(offsets: DataFrame, offset_col: str = "committed_offset") -> DataFrame:
    """One row per topic: its part of the Kafka source's startingOffsets option, as JSON."""
    by = F.map_from_entries(F.collect_list(F.struct(F.col("partition").cast("string"), F.col(offset_col))))
    return offsets.groupBy("topic").agg(F.to_json(by).alias("offsets"))


def offsets_for_timestamp(log: DataFrame, timestamp_ms: int) -> DataFrame:
    """Per partition the first offset whose timestamp is at or after the moment; null where there is none."""
    at = F.unix_millis(F.col("timestamp").cast("timestamp"))
    return log.groupBy(*PART).agg(F.min(F.when(at >= timestamp_ms, F.col("offset"))).alias("offset"))


def read_from_timestamp(log: DataFrame, timestamp_ms: int) -> DataFrame:
    """The messages from that offset on. The partitions' first offsets are broadcast where a count finds them few."""
    first = offsets_for_timestamp(log, timestamp_ms).where("offset IS NOT NULL").withColumnRenamed("offset", "first_offset")
    first = F.broadcast(first) if first.limit(FEW + 1).count() <= FEW else first
    return log.join(first, PART).where("offset >= first_offset").drop("first_offset")


def bounded_read(log: DataFrame, max_messages: int = 500_000) -> DataFrame:
    """The first messages by topic, partition and offset: the limit is the feature, and a top-k per task."""
    return log.orderBy(*PART, "offset").limit(max_messages)
