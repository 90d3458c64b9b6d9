"""Decode and encode message payloads: frames shaped as the Kafka source gives them, batch or streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from tableforge import jsonin
from tableforge.jsonio import encode_json

#: Names of the types that a schema hint may use.
HINTS = {
    "bool": pa.bool_(), "boolean": pa.bool_(), "int8": pa.int8(), "int16": pa.int16(), "int32": pa.int32(), "int": pa.int32(), "int64": pa.int64(), "long": pa.int64(),
    "uint8": pa.uint8(), "uint16": pa.uint16(), "uint32": pa.uint32(), "uint": pa.uint32(), "uint64": pa.uint64(), "ulong": pa.uint64(),
    "float32": pa.float32(), "float": pa.float32(), "float64": pa.float64(), "double": pa.float64(), "utf8": pa.string(), "string": pa.string(), "large_utf8": pa.large_string(),
    "binary": pa.binary(), "date32": pa.date32(), "date64": pa.date64(), "timestamp_us": pa.timestamp("us"), "timestamp_microsecond": pa.timestamp("us"),
    "timestamp_ms": pa.timestamp("ms"), "timestamp_millisecond": pa.timestamp("ms"),
}
#: Objects that are turned into rows together.
BATCH_ROWS = 8192


def arrow_hint(pairs: list[tuple[str, str]]) -> pa.Schema:
    """Arrow schema of (name, type) pairs; types are trimmed and matched in any case, unknown ones raise."""
    fields = []
    for name, kind in pairs:
        if (key := kind.strip().lower()) not in HINTS:
            raise ValueError(f"unsupported type for schema: '{kind}'")
        fields.append(pa.field(name, HINTS[key]))
    return pa.schema(fields)


def spark_schema(schema: pa.Schema) -> T.StructType:
    """The columns that Spark has for an Arrow schema: unsigned numbers widened, large types as usual ones, times in
    microseconds."""
    return from_arrow_schema(pa.schema([f.with_type(jsonin.spark_side(f.type)) for f in schema]), prefer_timestamp_ntz=True)


def schema_from_hint(pairs: list[tuple[str, str]]) -> T.StructType:
    """``spark_schema`` of ``arrow_hint``."""
    return spark_schema(arrow_hint(pairs))


METADATA = ("kafka_partition_id", "kafka_offset", "kafka_timestamp")


def metadata_columns() -> list[Column]:
    found = (F.col("partition").cast("int"), F.col("offset").cast("long"), F.unix_millis(F.col("timestamp").cast("timestamp")))
    return [c.alias(n) for c, n in zip(found, METADATA, strict=True)]


def message_metadata(messages: DataFrame) -> DataFrame:
    return messages.where("value IS NOT NULL").select(*metadata_columns())


def payload_text() -> Column:
    """The payload as text; bytes that aren't UTF-8 become replacement characters."""
    return F.make_valid_utf8(F.col("value").cast("string"))


def decode_messages_raw(messages: DataFrame, include_metadata: bool = False) -> DataFrame:
    """One ``value`` string per message; messages without a payload are left out."""
    return messages.where("value IS NOT NULL").select(payload_text().alias("value"), *metadata_columns() * include_metadata)


def decode_messages_json(messages: DataFrame, schema: pa.Schema | T.StructType | list[tuple[str, str]], include_metadata: bool = False) -> DataFrame:
    """Each JSON object of a payload as a row of ``schema``, an Arrow or Spark schema or (name, type) pairs. Lists, structs
    and maps nest.

    A payload may hold any number of objects, with or without white space between them; payloads without one give no row.
    Missing keys are null, unknown ones ignored, of repeated ones the last counts. Numbers may come as strings and any
    value as text; numbers for dates and times count in the type's unit. Everything else raises: values of another kind,
    numbers out of range (of unsigned types too), nulls where the schema has none, what isn't an object, cut objects,
    text behind one and bytes that aren't UTF-8."""
    schema = arrow_hint(schema) if isinstance(schema, list) else to_arrow_schema(schema) if isinstance(schema, T.StructType) else schema
    as_written = any(jsonin.needs_written(f.type) for f in schema)
    held = [jsonin.spark_side(f.type) for f in schema]
    for f in schema:
        jsonin.column([], f)  # types that JSON can't give raise here
    out = spark_schema(schema)
    with_schema = T.StructType([*out, *[T.StructField(n, k, True) for n, k in zip(METADATA, (T.IntegerType(), T.LongType(), T.LongType()), strict=True)]]) if include_metadata else out

    def rows(objects: list[dict], origins: list[int], batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [jsonin.column([o.get(f.name) for o in objects], f).cast(kind, safe=False) for f, kind in zip(schema, held, strict=True)]
        if not include_metadata:
            return pa.RecordBatch.from_arrays(columns, schema.names) if columns else batch.slice(0, 0)
        return pa.RecordBatch.from_arrays([*columns, *(c.take(pa.array(origins)) for c in batch.columns[1:])], [*schema.names, *METADATA])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            objects, origins = [], []
            for k, payload in enumerate(batch.column(0)):
                try:
                    for value in jsonin.objects_of(payload.as_buffer().to_pybytes().decode(), as_written):
                        objects.append(value)
                        origins.append(k)
                        if len(objects) == BATCH_ROWS:
                            yield rows(objects, origins, batch)
                            objects, origins = [], []
                except (ValueError, RecursionError) as e:
                    raise ValueError(f"JSON read failed: {e}") from e
            if objects:
                yield rows(objects, origins, batch)

    return messages.where("value IS NOT NULL").select(F.col("value").cast("binary").alias("value"), *metadata_columns() * include_metadata).mapInArrow(run, with_schema)


def encode_messages_json(df: DataFrame, datetime_format: str | None = None) -> DataFrame:
    """One JSON payload per row."""
    return df.select(encode_json(df, datetime_format).cast("binary").alias("value"))


def encode_messages_raw(df: DataFrame) -> DataFrame:
    """The payloads of a single string or binary column; null is an empty payload."""
    if len(df.columns) != 1:
        raise ValueError(f"raw mode takes one column, not {len(df.columns)}")
    field = df.schema[0]
    if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        raise ValueError(f"raw mode takes a string or binary column, not {field.dataType.simpleString()}")
    return df.select(F.coalesce(F.col(f"`{field.name}`").cast("binary"), F.lit(b"")).alias("value"))


def encode_messages(df: DataFrame, mode: str, datetime_format: str | None = None) -> DataFrame:
    if mode not in ("json", "raw"):
        raise ValueError(f"invalid mode: {mode}")
    return encode_messages_json(df, datetime_format) if mode == "json" else encode_messages_raw(df)
