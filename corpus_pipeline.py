"""From raw documents to packed training sequences: each stage keeps or changes documents, the last one packs them.

Every stage takes all that its predecessor kept, whole texts included, and returns the columns of its input, whatever
further ones there are and whatever they are called; only the last one returns its own. All stages give no rows for an
empty table. Each stage's docstring says what it does with nulls, empty and very long texts, ties and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableforge.llm import common, dedup, langid, packing, secret_scan, toxicity


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or with too little confidence in any learned language go: null, empty and wordless texts
    and those in other languages. Repeated rows are judged alike. Rows with a null id or language are judged but not learned
    from; where nothing can be learned, all go."""
    return langid.keep_identified(docs, langid.fit(docs.where(langid.learnable())))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go. Null and empty texts have no neighbours: they get the rate of such examples,
    or of all labels. Repeated rows and equal texts are judged alike, ties between neighbours go to the first example.
    Without labels all documents stay."""
    labels = toxicity.learnable(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, toxicity.fit(docs, docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that of the smallest id, of repeated ids the one that comes first in its file. A
    null id counts as larger than all others. Null, empty and wordless texts are in no group and stay."""
    return dedup.keep_one_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are starred out; null texts stay null, overlapping spans are starred once, lengths stay. All rows stay."""
    return secret_scan.without_secrets(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences. Null and empty texts are one piece, the end id alone;
    texts of any length are cut into full pieces. Repeated rows and ties get a place each."""
    return packing.packed(docs)


STAGES = [("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", sequences)]
#: Models, MinHash and a genetic algorithm aren't SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        last, docs = docs, common.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        common.drop(last)  # what the stage before wrote
    return STAGES[-1][1](spark, docs, sf_dir)
