"""Line-delimited query results: a meta line with names and types, data lines, a status line."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tableforge import jsonin


def parse_type(text: str) -> str:
    """The DDL of a remote type; unknown types are strings that hold JSON text."""
    text = text.strip().lower()
    if text.startswith("array<") and text.endswith(">"):
        return f"array<{parse_type(text[6:-1])}>"
    name = text.split("(")[0].strip()
    if name.startswith("decimal"):
        if not (m := re.search(r"\(\s*(\d+)\s*,\s*(\d+)\s*\)", text)):
            raise ValueError(f"decimal without precision and scale: {text}")
        return f"decimal({m[1]},{m[2]})"
    return {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "bigint", "float": "double", "double": "double", "boolean": "boolean", "bool": "boolean", "date": "date", "datetime": "timestamp_ntz"}.get(name, "string")


def arrow_type(ddl: str) -> pa.DataType:
    """The Arrow type of one of ``parse_type``'s."""
    if ddl.startswith("array<"):
        return pa.list_(arrow_type(ddl[6:-1]))
    if ddl.startswith("decimal"):
        return pa.decimal128(*map(int, ddl[8:-1].split(",")))
    return {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "date": pa.date32(), "timestamp_ntz": pa.timestamp("us")}.get(ddl, pa.string())


def meta_schema(meta: list[dict]) -> pa.Schema:
    """The columns that a meta line's list of names and types declares."""
    return pa.schema([pa.field(c["name"], arrow_type(parse_type(c["type"]))) for c in meta])


def one_object(line: str) -> dict:
    """The one object of a line; anything else raises."""
    found = list(jsonin.objects_of(line, as_written=True))
    if len(found) != 1:
        raise ValueError(f"not JSON of one object: {line[:60]}")
    return found[0]


def data_batch(lines: list[str], schema: pa.Schema) -> pa.RecordBatch:
    """Data lines as typed columns: short rows are padded with nulls, what doesn't fit its column raises."""
    rows = [one_object(line)["data"] for line in lines]
    for row in rows:
        if not isinstance(row, list):
            raise ValueError(f"not a list of values: {jsonin.written(row)[:60]}")
    columns = [jsonin.column([r[i] if i < len(r) else None for r in rows], f, jsonin.STRICT) for i, f in enumerate(schema)]
    return pa.RecordBatch.from_arrays(columns, schema.names)


def decode_result_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Typed rows of the data lines. Blank and other lines are ignored, short rows padded with nulls; a failed status, a
    missing meta line, meta lines that differ and values that don't fit raise. One aggregate over all meta and status
    lines goes to the driver, so ``lines`` is read twice; a remote source knows its columns and needs one pass."""
    line = F.trim(F.col(line_col))
    heads = lines.where(line.startswith('{"meta"') | line.startswith('{"status"')).select(line.alias("line"), F.try_parse_json(line).alias("v"))
    part = lambda name: F.variant_get("v", f"$.{name}", "string")
    failed = F.upper(part("status")) == "FAILED"
    said = heads.agg(
        F.max(F.when(failed, F.coalesce(part("msg"), F.lit("")))).alias("failed"), F.min(F.when(F.col("v").isNull(), F.col("line"))).alias("broken"),
        F.min(part("meta")).alias("meta"), F.max(part("meta")).alias("other"),
    ).first()
    if said.failed is not None:
        raise RuntimeError(said.failed or "query failed")
    if said.broken is not None:
        raise ValueError(f"not JSON: {said.broken}")
    if said.meta is None:
        raise ValueError("no meta line")
    if said.meta != said.other:
        raise ValueError(f"meta lines differ: {said.meta} and {said.other}")
    schema = meta_schema(json.loads(said.meta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield data_batch(batch.column(0).to_pylist(), schema)

    return lines.where(line.startswith('{"data"')).select(line.alias("line")).mapInArrow(run, from_arrow_schema(schema, prefer_timestamp_ntz=True))
