"""Sketch aggregates as SQL table functions, and generated tables as views.

``SELECT * FROM hll_sketch(TABLE(events), 'event_type', 'user_id')`` gives the named keys (separated by commas) and a
``sketch`` per group, with the bytes of ``hll.hll_agg``; ``tdigest_sketch`` gives a ``digest``. The functions name the table's partitioning
themselves and hold a bounded number of values; rows go through Python one by one and without a combine before the
shuffle, so the DataFrame aggregates are the faster way.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, PartitioningColumn

from tableforge import gen, hll, tdigest

#: Values that are held before they go into the sketch.
HELD = 4096


@dataclass
class Grouped(AnalyzeResult):
    keys: list[str] = field(default_factory=list)
    value: str = ""
    kind: pa.DataType | None = None


def grouped(table: AnalyzeArgument, keys: AnalyzeArgument, value: AnalyzeArgument, name: str) -> Grouped:
    """The result's columns (the keys, then ``name``) and the partitioning that it takes."""
    if not table.isTable or not all(isinstance(a.value, str) for a in (keys, value)):
        raise ValueError("the arguments are a table, the names of the keys and the name of the values' column")
    columns = {f.name: f for f in table.dataType}
    names = [k.strip() for k in keys.value.split(",") if k.strip()]
    if missing := [c for c in (*names, value.value) if c not in columns]:
        raise ValueError(f"no such column: {', '.join(missing)}")
    schema = StructType([columns[k] for k in names]).add(name, BinaryType())
    by = [PartitioningColumn(f"`{k}`") for k in names]
    return Grouped(schema=schema, withSinglePartition=not names, partitionBy=by, keys=names, value=value.value, kind=to_arrow_type(columns[value.value].dataType))


class _Aggregate:
    """Collects values and hands them on in parts. A group without values gives no row."""

    def __init__(self, said: Grouped):
        self.said, self.key, self.held, self.state = said, (), [], None

    def eval(self, row: Row, keys: str, value: str, *more):
        if row[self.said.value] is not None:
            self.key = tuple(row[k] for k in self.said.keys)
            self.held.append(row[self.said.value])
            if len(self.held) == HELD:
                self.empty()

    def empty(self) -> None:
        if self.held:
            self.state, self.held = self.fold(self.state, pa.array(self.held, self.said.kind)), []

    def terminate(self):
        self.empty()
        if self.state is not None:
            yield (*self.key, self.finish(self.state))


@udtf
class HllSketch(_Aggregate):
    @staticmethod
    def analyze(table: AnalyzeArgument, keys: AnalyzeArgument, value: AnalyzeArgument) -> AnalyzeResult:
        said = grouped(table, keys, value, "sketch")
        kind = next(f.dataType for f in table.dataType if f.name == said.value)
        if not hll.hashable(kind):
            raise ValueError(f"values of type {kind.simpleString()} can't be counted")
        return said

    @staticmethod
    def fold(state: hll.Sketch | None, values: pa.Array) -> hll.Sketch:
        return (state or hll.Sketch.empty(12, 6)).add(hll.murmur3_of(values))

    @staticmethod
    def finish(state: hll.Sketch) -> bytes:
        return state.to_bytes()


@udtf
class TDigestSketch(_Aggregate):
    @staticmethod
    def analyze(table: AnalyzeArgument, keys: AnalyzeArgument, value: AnalyzeArgument) -> AnalyzeResult:
        return grouped(table, keys, value, "digest")

    @staticmethod
    def fold(state: tdigest.Digest | None, values: pa.Array) -> tdigest.Digest:
        new = tdigest.of_values(np.asarray(values.to_pylist(), float))
        return tdigest.merged([state, new]) if state else new

    @staticmethod
    def finish(state: tdigest.Digest) -> bytes:
        return tdigest.to_bytes(state)


def register_table_functions(spark: SparkSession) -> None:
    """hll_sketch and tdigest_sketch, beside the scalar functions of both modules."""
    hll.register_functions(spark)
    tdigest.register_functions(spark)
    spark.udtf.register("hll_sketch", HllSketch)
    spark.udtf.register("tdigest_sketch", TDigestSketch)


def register_generated(spark: SparkSession, name: str, spec: str | list, rows: int, **options) -> None:
    """A view of a generated table: its rows are made, in parallel, where SQL asks for them."""
    gen.gen_table(spark, spec, rows, **options).createOrReplaceTempView(name)
