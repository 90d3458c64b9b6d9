"""t-digest sketches as aggregates: digests of all keys of a batch at once, merged by rounds; portable bytes.

Nulls and NaN aren't counted. Group keys may be null; a group of nulls alone has no row.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge import grouped


@dataclass
class Digest:
    size: int = 100
    count: int = 0
    low: float = float("inf")
    high: float = float("-inf")
    mean: np.ndarray = None
    weight: np.ndarray = None

    def __post_init__(self):
        self.mean = np.zeros(0) if self.mean is None else self.mean
        self.weight = np.zeros(0, np.int64) if self.weight is None else self.weight


def _limits(size: int) -> np.ndarray:
    """The share of the weight that the first 1, 2, ... centroids may hold: fine at both ends."""
    k = np.arange(1, size + 1) / size
    return np.where(k < 0.5, 2 * k * k, 1 - 2 * (1 - k) ** 2)


def combined_many(size: int, code: np.ndarray, n: int, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, mean and weight of the centroids of n groups at once: ``code`` says to which group each input belongs."""
    some = weight > 0
    code, mean, weight = code[some], mean[some], weight[some].astype(np.int64)
    order = np.lexsort((weight, mean, code))
    code, mean, weight = code[order], mean[order], weight[order]
    if not len(code):
        return code, mean, weight
    begins = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    total = np.add.reduceat(weight, begins)
    lengths = np.diff(np.append(begins, len(code)))
    before = np.cumsum(weight) - np.repeat(np.cumsum(total) - total, lengths)
    group = np.searchsorted(_limits(size), (before - weight / 2) / np.repeat(total, lengths), side="left")
    first = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (code[1:] != code[:-1])))
    sums = np.add.reduceat(weight, first)
    return code[first], np.add.reduceat(mean * weight, first) / sums, sums


def combined(size: int, mean: np.ndarray, weight: np.ndarray, low: float, high: float) -> Digest:
    _, means, sums = combined_many(size, np.zeros(len(mean), np.int64), 1, mean, weight)
    return Digest(size, int(sums.sum()), low, high, means, sums) if len(sums) else Digest(size)


def of_values(values: np.ndarray, size: int = 100) -> Digest:
    values = values[~np.isnan(values)]
    return combined(size, values, np.ones(len(values), np.int64), float(values.min()), float(values.max())) if len(values) else Digest(size)


def merged(digests: list[Digest]) -> Digest:
    some = [d for d in digests if d.count]
    if not some:
        return Digest(digests[0].size if digests else 100)
    return combined(digests[0].size, np.concatenate([d.mean for d in some]), np.concatenate([d.weight for d in some]), min(d.low for d in some), max(d.high for d in some))


#: The layout of a digest's head and of each centroid behind it, big-endian.
HEAD = np.dtype([("version", ">u4"), ("count", ">u8"), ("size", ">u4"), ("n", ">u4"), ("low", ">f8"), ("high", ">f8")])
CENTROID = np.dtype([("mean", ">f8"), ("weight", ">u8")])


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length."""
    return np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def many_from_bytes(raws: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heads of all digests, and the digest and fields of every centroid."""
    raws = raws.cast(pa.large_binary())
    ends = np.frombuffer(raws.buffers()[1], np.int64)[raws.offset : raws.offset + len(raws) + 1]
    data = np.frombuffer(raws.buffers()[2], np.uint8) if raws.buffers()[2] is not None else np.zeros(0, np.uint8)
    size = np.diff(ends)
    if (size < HEAD.itemsize).any():
        raise ValueError("truncated digest")
    head = data[ends[:-1, None] + np.arange(HEAD.itemsize)].reshape(-1).view(HEAD)
    n = head["n"].astype(np.int64)
    if (head["version"] != 1).any() or (size < HEAD.itemsize + CENTROID.itemsize * n).any():
        raise ValueError("truncated digest or unknown version")
    return head, np.repeat(np.arange(len(n)), n), data[_places(ends[:-1] + HEAD.itemsize, CENTROID.itemsize * n)].view(CENTROID)


def many_to_bytes(size: int, n: int, code: np.ndarray, mean: np.ndarray, weight: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """n digests of the centroids, which lie in the order of their digests."""
    head, body = np.zeros(n, HEAD), np.zeros(len(mean), CENTROID)
    head["version"], head["size"], head["low"], head["high"] = 1, size, low, high
    head["n"], head["count"] = np.bincount(code, minlength=n), np.bincount(code, weight, minlength=n) if weight.sum() < 2**53 else [int(weight[code == k].sum()) for k in range(n)]
    body["mean"], body["weight"] = mean, weight
    lengths = head["n"].astype(np.int64) * CENTROID.itemsize
    ends = np.append(0, np.cumsum(lengths + HEAD.itemsize))
    out = np.zeros(int(ends[-1]), np.uint8)
    out[ends[:-1, None] + np.arange(HEAD.itemsize)] = head.view(np.uint8).reshape(n, -1)
    out[_places(ends[:-1] + HEAD.itemsize, lengths)] = body.view(np.uint8)
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(out)]).cast(pa.binary())


def states_of_values(size: int):
    """Digests of each group's numbers; NaN isn't counted."""

    def build(code: np.ndarray, n: int, values: pa.Array) -> pa.Array:
        x = values.to_numpy(zero_copy_only=False)
        known = ~np.isnan(x)
        code, x = code[known], x[known]
        low, high = np.full(n, np.inf), np.full(n, -np.inf)
        np.minimum.at(low, code, x)
        np.maximum.at(high, code, x)
        return many_to_bytes(size, n, *combined_many(size, code, n, x, np.ones(len(x), np.int64)), low, high)

    return build


def merged_many(code: np.ndarray, n: int, raws: pa.Array) -> pa.Array:
    """The digests of each group as one, of the largest size among all."""
    head, of, body = many_from_bytes(raws)
    low, high = np.full(n, np.inf), np.full(n, -np.inf)
    np.minimum.at(low, code, head["low"].astype(float))
    np.maximum.at(high, code, head["high"].astype(float))
    size = int(head["size"].max(initial=0)) or 100
    return many_to_bytes(size, n, *combined_many(size, code[of], n, body["mean"].astype(float), body["weight"].astype(np.int64)), low, high)


def quantile(d: Digest, q: float, empty_as_zero: bool = False) -> float | None:
    if not d.count:
        return 0.0 if empty_as_zero else None
    if q <= 0 or q >= 1:
        return d.low if q <= 0 else d.high
    middle = np.cumsum(d.weight) - d.weight / 2
    return float(np.clip(np.interp(q * d.count, np.concatenate([[0], middle, [d.count]]), np.concatenate([[d.low], d.mean, [d.high]])), d.low, d.high))


def to_bytes(d: Digest) -> bytes:
    body = np.zeros(len(d.mean), [("mean", ">f8"), ("weight", ">u8")])
    body["mean"], body["weight"] = d.mean, d.weight
    return struct.pack(">IQIIdd", 1, d.count, d.size, len(d.mean), d.low, d.high) + body.tobytes()


def from_bytes(raw: bytes) -> Digest:
    if len(raw) < 36:
        raise ValueError("truncated digest")
    version, count, size, n, low, high = struct.unpack(">IQIIdd", raw[:36])
    if version != 1 or len(raw) < 36 + 16 * n:
        raise ValueError("truncated digest or unknown version")
    body = np.frombuffer(raw, [("mean", ">f8"), ("weight", ">u8")], n, 36)
    return Digest(size, count, low, high, body["mean"].astype(float), body["weight"].astype(np.int64))


def merged_bytes(raws: list[bytes]) -> bytes:
    return to_bytes(merged([from_bytes(bytes(b)) for b in raws]))


def tdigest_union_agg(df: DataFrame, keys: list[str], digest: str = "digest") -> DataFrame:
    """keys and the merge of each group's digests, as ``digest``; null digests are left out."""
    return grouped.merged_states(df, keys, digest, "digest", merged_many)


def tdigest_agg(df: DataFrame, keys: list[str], value: str, size: int = 100) -> DataFrame:
    """keys and ``digest`` bytes of a number column. Raw values never meet per key: each task hands on digests."""
    rows = df.where(F.col(f"`{value}`").isNotNull()).select(*grouped.key_columns(df, keys), F.col(f"`{value}`").cast("double").alias("_v"))
    return tdigest_union_agg(grouped.partial_states(rows, keys, "_v", "digest", states_of_values(size), merged_many), keys)


def tdigest_decode(df: DataFrame, keys: list[str], digest: str = "digest") -> DataFrame:
    """keys and a row (mean, weight) per centroid of every digest."""

    @F.pandas_udf("array<struct<mean:double,weight:long>>")
    def centroids(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: None if b is None else [{"mean": m, "weight": w} for d in [from_bytes(bytes(b))] for m, w in zip(d.mean.tolist(), d.weight.tolist(), strict=True)])

    return df.select(*keys, F.explode(centroids(digest)).alias("_c")).select(*keys, "_c.mean", "_c.weight")


def register_functions(spark: SparkSession) -> None:
    """SQL functions: tdigest_value_at(digest, q), tdigest_count(digest), tdigest_merge(digest, digest)."""

    @F.arrow_udf("double")
    def tdigest_value_at(raw: pa.Array, q: pa.Array) -> pa.Array:
        return pa.array([None if b is None or x is None else quantile(from_bytes(b), x) for b, x in zip(raw.to_pylist(), q.to_pylist(), strict=True)], pa.float64())

    @F.arrow_udf("long")
    def tdigest_count(raw: pa.Array) -> pa.Array:
        return pa.array([None if b is None else from_bytes(b).count for b in raw.to_pylist()], pa.int64())

    @F.arrow_udf("binary")
    def tdigest_merge(one: pa.Array, two: pa.Array) -> pa.Array:
        """A null digest adds nothing; two nulls are null."""
        pairs = ([x for x in (a, b) if x is not None] for a, b in zip(one.to_pylist(), two.to_pylist(), strict=True))
        return pa.array([merged_bytes(p) if p else None for p in pairs], pa.binary())

    for f in (tdigest_value_at, tdigest_count, tdigest_merge):
        spark.udf.register(f.__name__ if hasattr(f, "__name__") else f.func.__name__, f)


def tdigest_quantile(digest: Column, qs: list[float], empty_as_zero: bool = False) -> Column:
    """array<double>: the value at each q."""

    @F.pandas_udf("array<double>")
    def values(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: None if b is None else [quantile(from_bytes(bytes(b)), q, empty_as_zero) for q in qs])

    return values(digest)


def tdigest_stats(digest: Column) -> Column:
    """struct of count, min, max and max_size; its fields are null for a null digest."""

    @F.pandas_udf("count long, min double, max double, max_size int")
    def stats(raw: pd.Series) -> pd.DataFrame:
        found = [None if b is None else from_bytes(bytes(b)) for b in raw]
        some = lambda get: [None if d is None else get(d) for d in found]
        return pd.DataFrame({"count": pd.array(some(lambda d: d.count), "Int64"), "min": some(lambda d: d.low if d.count else None), "max": some(lambda d: d.high if d.count else None), "max_size": pd.array(some(lambda d: d.size), "Int32")})

    return stats(digest)
