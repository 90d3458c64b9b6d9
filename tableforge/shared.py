"""Tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Where none is set, a single machine gets a temporary one; on a
    cluster that is an error, as each machine would see its own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        path = spark.sparkContext.getCheckpointDir()
    return path


def new_path(spark: SparkSession, name: str = "table") -> str:
    """A path in the shared folder that is deleted, at the latest, when the JVM exits."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    place, files = _file_system(spark, path)
    files.deleteOnExit(place)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage ends there, lost executors lose nothing.
    The table goes with ``drop``, at the latest when the JVM exits."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[back] = path
    return back


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` returned and nothing reads any more."""
    for table in tables:
        if path := _WRITTEN.pop(table, None):
            place, files = _file_system(table.sparkSession, path)
            files.delete(place, True)
