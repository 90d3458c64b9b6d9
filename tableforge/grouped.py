"""Per-key aggregation of byte states: states combine within tasks, then fan in by rounds whose width their bytes decide.

No step holds more than HELD_BYTES of states, however many rows a key has: a task combines what it has read whenever that
much has come together. In a round, a key whose states take more than TASK_BYTES is dealt to as many groups as that takes;
the salt is a hash of the state and of the partition it lies in, so equal states are parted too. The last round sorts by key
and combines as rows come. A key may be null or NaN and of any type that can be sorted; without keys all rows are one
group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableforge import shared

HELD_BYTES, TASK_BYTES = 16 << 20, 32 << 20

#: States of groups: group numbers (0, 1, ...) and the states of each row to the merged state of each group.
Merge = Callable[[np.ndarray, int, pa.Array], pa.Array]


def key_columns(df: DataFrame, keys: list[str]) -> list[Column]:
    """The keys as they group: -0.0 is 0.0."""
    return [F.when(F.col(f"`{k}`") == 0, F.lit(0.0)).otherwise(F.col(f"`{k}`")).cast(df.schema[k].dataType).alias(k) if isinstance(df.schema[k].dataType, (T.FloatType, T.DoubleType)) else F.col(f"`{k}`") for k in keys]


def codes(columns: list[pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row that is equal for equal keys (nulls are equal), and a row of each number."""
    code = np.zeros(n, np.int64)
    for column in columns:
        own = column.dictionary_encode(null_encoding="encode").indices.to_numpy() if not pa.types.is_nested(column.type) else np.unique([repr(v) for v in column.to_pylist()], return_inverse=True)[1]
        code = np.unique(code * (int(own.max(initial=0)) + 1) + own, return_inverse=True)[1]
    return code, np.unique(code, return_index=True)[1]


def combined(batch: pa.RecordBatch, merge: Merge) -> pa.RecordBatch:
    """One row per key: the last column's states merged."""
    columns = batch.columns[:-1]
    code, first = codes(columns, batch.num_rows)
    return pa.RecordBatch.from_arrays([*(c.take(pa.array(first)) for c in columns), merge(code, len(first), batch.columns[-1])], batch.schema.names)


def in_tasks(batches: Iterator[pa.RecordBatch], merge: Merge) -> Iterator[pa.RecordBatch]:
    """States combined as far as HELD_BYTES allow."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held, size = [*held, batch], size + batch.nbytes
        if size > HELD_BYTES:
            one = combined(pa.concat_batches(held), merge)
            if one.nbytes > HELD_BYTES // 2:
                yield one
                held, size = [], 0
            else:
                held, size = [one], one.nbytes
    if held:
        yield combined(pa.concat_batches(held), merge)


def in_order(batches: Iterator[pa.RecordBatch], merge: Merge) -> Iterator[pa.RecordBatch]:
    """States of rows that come sorted by key: the last key of a batch may go on in the next."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        one = combined(pa.concat_batches([*held, batch]), merge)
        last = pa.concat_batches([*held, batch]).slice(len(batch) + sum(map(len, held)) - 1, 1)
        code, _ = codes(pa.concat_batches([one, last]).columns[:-1], len(one) + 1)
        at = int(np.flatnonzero(code[:-1] == code[-1])[0])
        held = [one.slice(at, 1)]
        if len(one) > 1:
            yield one.take(pa.array([i for i in range(len(one)) if i != at]))
    yield from held


def partial_states(df: DataFrame, keys: list[str], value: str, name: str, build: Merge, merge: Merge) -> DataFrame:
    """keys and ``name``: states that each task builds of its rows' values and combines."""
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = (combined(b, build) for b in batches if b.num_rows)
        yield from (b.rename_columns([*keys, name]) for b in in_tasks(built, merge))

    return df.select(*key_columns(df, keys), F.col(f"`{value}`")).mapInArrow(run, schema)


def merged_states(df: DataFrame, keys: list[str], column: str, name: str, merge: Merge, task_bytes: int = TASK_BYTES) -> DataFrame:
    """keys and ``name``: the merge of each group's states; nulls are left out, a group of nulls alone has no row."""
    key = [F.col(f"`{k}`") for k in keys]
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField(name, T.BinaryType())])
    some = df.where(F.col(f"`{column}`").isNotNull()).select(*key_columns(df, keys), F.col(f"`{column}`").alias(name))
    states = shared.materialise(some.mapInArrow(lambda batches: in_tasks(batches, merge), schema), "states")
    while True:
        weights = states.groupBy(*key).agg(F.sum(F.octet_length(name)).alias("_bytes"), F.count("*").alias("_n"))
        heavy = weights.where((F.col("_bytes") > task_bytes) & (F.col("_n") > 1))
        if heavy.isEmpty():
            break
        states = fanned_in(states, heavy, keys, name, merge, task_bytes)
    rows = states.repartition(*key) if keys else states.repartition(1)
    ordered = rows.sortWithinPartitions(*key) if keys else rows
    return ordered.mapInArrow(lambda batches: in_order(batches, merge), schema)


def dealt(states: DataFrame, heavy: DataFrame, keys: list[str], name: str, task_bytes: int) -> DataFrame:
    """The states with ``_salt``: heavy keys get as many as their bytes ask for, at most one for two states."""
    ways = heavy.select(*[F.col(f"`{k}`").alias(f"_of_{i}") for i, k in enumerate(keys)], F.least(F.ceil(F.col("_bytes") / task_bytes), F.ceil(F.col("_n") / 2)).cast("int").alias("_ways"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_of_{i}"))
    placed = states.withColumn("_place", F.xxhash64(name, F.spark_partition_id()))
    return placed.join(ways, same, "left").withColumn("_salt", F.when(F.col("_ways").isNull(), 0).otherwise(F.pmod("_place", F.col("_ways")))).select(*[F.col(f"`{k}`") for k in keys], "_salt", name)


def fanned_in(states: DataFrame, heavy: DataFrame, keys: list[str], name: str, merge: Merge, task_bytes: int) -> DataFrame:
    """One round: the states of each key and salt as one, as a table."""
    by = [*[F.col(f"`{k}`") for k in keys], F.col("_salt")]
    salted = dealt(states, heavy, keys, name, task_bytes)
    ordered = salted.repartition(*by).sortWithinPartitions(*by)
    out = shared.materialise(ordered.mapInArrow(lambda batches: in_order(batches, merge), salted.schema).drop("_salt"), "states")
    shared.drop(states)
    return out
