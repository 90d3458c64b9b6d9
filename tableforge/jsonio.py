"""Rows as JSON: text lines, arrays and files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableforge.groupfiles import GroupArraySink

#: Strftime directives and the letters that Spark has for them.
DIRECTIVES = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "f": "SSSSSS", "3f": "SSS", ".f": ".SSSSSS", ".3f": ".SSS", "p": "a", "b": "MMM", "B": "MMMM", "a": "E", "A": "EEEE", "j": "DDD", "%": "%", "F": "yyyy-MM-dd", "T": "HH:mm:ss"}
DEFAULT = "%Y-%m-%d %H:%M:%S"


def timestamp_format(pattern: str | None = None) -> str:
    """Spark's pattern for a strftime pattern; unknown directives raise."""
    pattern, out, i = pattern or DEFAULT, "", 0
    while i < len(pattern):
        if pattern[i] == "%":
            key = next((pattern[i + 1 : i + 1 + n] for n in (3, 2, 1) if pattern[i + 1 : i + 1 + n] in DIRECTIVES), None)
            if key is None:
                raise ValueError(f"unknown directive at {i} in {pattern!r}")
            out, i = out + DIRECTIVES[key], i + 1 + len(key)
        else:
            out, i = out + ("''" if pattern[i] == "'" else f"'{pattern[i]}'" if pattern[i].isalpha() or pattern[i] in "[]{}#" else pattern[i]), i + 1
    return out


def encode_json(df: DataFrame, datetime_format: str | None = None) -> Column:
    """A row as one JSON object: null fields are left out, binary is lower-case hex."""
    own = [F.lower(F.hex(F.col(f"`{f.name}`"))).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f"`{f.name}`") for f in df.schema]
    form = timestamp_format(datetime_format)
    return F.to_json(F.struct(*own), {"timestampNTZFormat": form, "timestampFormat": form, "ignoreNullFields": "true"})


def _counted(df: DataFrame, path: str) -> int:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).select("value").write.text(path)
    return seen.get["rows"]


def write_ndjson(df: DataFrame, path: str, datetime_format: str | None = None) -> int:
    """Write JSON lines; the number of rows, counted in the same pass."""
    return _counted(df.select(encode_json(df, datetime_format).alias("value"), F.lit(1).alias("_n")), path)


def in_groups(df: DataFrame, keys: list[str], datetime_format: str | None) -> DataFrame:
    """The keys and every row's JSON text as ``value``; a group's rows lie together, in the order of their texts."""
    key = [F.col(f"`{k}`") for k in keys]
    rows = df.select(*key, encode_json(df, datetime_format).alias("value"))
    return (rows.repartition(*key) if keys else rows.repartition(1)).sortWithinPartitions(*key, "value")


def write_json_array(df: DataFrame, path: str, keys: list[str], datetime_format: str | None = None) -> int:
    """Write one JSON array per group, a line each, whatever the groups' sizes; the number of rows. A group's rows are
    sorted (on disk, where they are many) and written as they come: no group is held. Without keys all rows are one array."""
    rows = in_groups(df, keys, datetime_format)
    df.sparkSession.dataSource.register(GroupArraySink)
    seen = Observation()
    key = F.struct(*[F.col(f"`{k}`") for k in keys]) if keys else F.lit(0)
    marked = rows.select(key.alias("key"), "value").mapInArrow(_marks, "mark boolean, value string")
    marked.observe(seen, F.count(F.lit(1)).alias("n")).write.format(GroupArraySink.name()).option("path", path).mode("append").save()
    return seen.get["n"]


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where a key differs from that of the row before."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        code = batch.column(0).to_pylist() if not pa.types.is_integer(batch.column(0).type) else [0] * batch.num_rows
        mark = [repr(a) != repr(b) for a, b in zip([last, *code[:-1]], code, strict=True)]
        mark[0] = mark[0] or last is None
        last = code[-1]
        yield pa.RecordBatch.from_arrays([pa.array(mark), batch.column(1)], ["mark", "value"])


def write_ndjson_groups(df: DataFrame, path: str, keys: list[str], datetime_format: str | None = None) -> int:
    """Write one file of JSON lines per group, under folders named by the keys; the number of rows. Groups of any size."""
    seen = Observation()
    same = {k: f"_{k}" for k in keys if k == "value"}  # the text's own name
    rows = in_groups(df.withColumnsRenamed(same) if same else df, [same.get(k, k) for k in keys], datetime_format)
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy(*[same.get(k, k) for k in keys]).text(path)
    return seen.get["n"]


def dump_ndjson_group(df: DataFrame, keys: list[str], datetime_format: str | None = None) -> DataFrame:
    """Per group: its rows as JSON lines, in the order of their texts. A group's document is one value of a row and has to
    fit one; ``write_ndjson_groups`` writes documents of any size."""
    return _documents(df, keys, datetime_format, lambda all_: F.array_join(all_, "\n"))


def json_arrays(df: DataFrame, keys: list[str], datetime_format: str | None = None) -> DataFrame:
    """Per group: its rows as one JSON array, in the order of their texts, as one value of a row."""
    return _documents(df, keys, datetime_format, lambda all_: F.concat(F.lit("["), F.array_join(all_, ","), F.lit("]")))


def _documents(df: DataFrame, keys: list[str], datetime_format: str | None, put: Callable[[Column], Column]) -> DataFrame:
    rows = df.select(*[F.col(f"`{k}`") for k in keys], encode_json(df, datetime_format).alias("_j"))
    return rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(put(F.array_sort(F.collect_list("_j"))).alias("value"))
