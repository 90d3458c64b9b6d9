"""Helpers shared by the corpus operators: table access, Arrow batches as numpy bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tableforge.shared import drop, materialise, shared_dir  # noqa: F401

#: Text bytes that numpy handles at a time; a longer document is handled alone.
BLOCK_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def arrow_limits(spark: SparkSession) -> None:
    """Keep Arrow batches small whatever the length of the texts, where the caller has no setting of their own."""
    for key, usual, ours in (("maxRecordsPerBatch", "10000", "2000"), ("maxBytesPerBatch", "64MB", str(16 << 20))):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", usual) == usual:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", ours)


def fold(modulus: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids give null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def spread(id_col: str = "doc_id") -> Column:
    """A number in [0, 1) that depends on the id alone, for bounded samples."""
    return F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 40)) / float(1 << 40)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """mapInArrow with one output batch per input batch; ``fn`` sees whole rows, never parts of a text."""
    arrow_limits(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def unused(df: DataFrame, name: str) -> str:
    """``name`` behind as many underscores as it takes for no column of ``df`` to begin so."""
    while any(c.lower().startswith(name) for c in df.columns):
        name = "_" + name
    return name


def annotated(df: DataFrame, columns: list[str], fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, prefix: str) -> DataFrame:
    """All columns of ``df`` and, under ``prefix`` (see ``unused``), those that ``fn`` makes of ``columns`` (behind its
    first, the id)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = fn(batch.select(columns))
        return pa.RecordBatch.from_arrays([*batch.columns, *made.columns[1:]], [*batch.schema.names, *(prefix + n for n in made.schema.names[1:])])

    made = [StructField(prefix + f.name, f.dataType) for f in StructType.fromDDL(schema)]
    return map_arrow(df, run, StructType([*(StructField(f.name, f.dataType) for f in df.schema), *made]))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows on end, and where each row starts (one more entry than rows); null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, starts) of runs of rows with about ``limit`` bytes; every row comes once, whole."""
    data, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each row; null counts as empty."""
    data, offsets = text_bytes(column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield data[a:b].tobytes()


def chunks(raw: bytes, cut: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """``raw`` in parts of ``size`` bytes or a little more, each but the last ending with ``cut``."""
    at = 0
    while at < len(raw):
        end = raw.find(cut, at + size - 1) + len(cut) if at + size <= len(raw) else 0
        end = end if end > at else len(raw)
        yield raw[at:end] if at or end < len(raw) else raw
        at = end


def sums(values: np.ndarray, offsets: np.ndarray, dtype=np.int64) -> np.ndarray:
    """Sum of ``values`` within each [offsets[i], offsets[i + 1]); 0 for empty ranges."""
    out = np.zeros(len(offsets) - 1, dtype)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], dtype=dtype)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** n modulo 2 ** 64."""
    return _powers(base, 1 << n.bit_length())[: n + 1] if n <= BLOCK_BYTES else _powers.__wrapped__(base, n)


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the white-space separated words of each row, and where each row's words start. The bytes are
    taken BLOCK_BYTES at a time; a word that is cut carries its sum and its length over."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    hashes, firsts = [], []
    carried, so_far = np.uint64(0), 0
    for lo in range(0, len(data), BLOCK_BYTES):
        part = data[lo : lo + BLOCK_BYTES]
        hi = lo + len(part)
        text, inside = LOWER[part] if lower else part, ~_SPACE[part]
        cut = np.zeros(len(part) + 1, bool)  # before each byte: a row's start parts words too
        cut[offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, side="right")] - lo] = True
        starts = np.flatnonzero(inside & (cut[:-1] | np.append(so_far == 0, ~inside[:-1])))
        ends = np.flatnonzero(inside & (cut[1:] | np.append(~inside[1:], hi == len(data) or _SPACE[data[hi]]))) + 1
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(part))[:-1], out=total[1:], dtype=np.uint64)
        firsts.append(starts + lo)
        if so_far:  # the part begins within a word
            end = int(ends[0]) if len(ends) else len(part)
            carried, so_far = carried + total[end : end + 1] * np.uint64(pow(_BASE, so_far, 1 << 64)), so_far + end
            if len(ends):
                hashes.append(mix(carried + np.uint64(so_far)))
                ends, so_far = ends[1:], 0
            else:
                continue
        whole = starts[: len(ends)]
        inverse = powers(_INVERSE, len(part))
        hashes.append(mix((total[ends] - total[whole]) * inverse[whole] + (ends - whole).astype(np.uint64)))
        if len(starts) > len(ends):
            carried, so_far = (total[-1:] - total[starts[-1:]]) * inverse[starts[-1:]], len(part) - int(starts[-1])
    return np.concatenate(hashes), np.searchsorted(np.concatenate(firsts), offsets)
