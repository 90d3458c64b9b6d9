"""HyperLogLog sketches as aggregates: small groups are counted exactly, larger ones by registers; portable bytes.

Nulls aren't counted; a group of nulls alone has no row. Group keys may be null. All aggregates are Catalyst's own: registers
are maxima by key and index, which tasks take before they shuffle, so a hot key sends each task's registers and no more;
bytes are packed from them by shifts. Python is only asked for the portable hash of a column and to read sketch bytes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableforge import grouped

STATES = {"empty": 1, "explicit": 2, "sparse": 3, "full": 4}


def limits(log2m: int, regwidth: int) -> tuple[int, int]:
    """Most hashes of an explicit and most registers of a sparse sketch."""
    if not (8 <= log2m <= 20 and 4 <= regwidth <= 6):
        raise ValueError("log2m is 8 to 20, regwidth 4 to 6")
    m = 1 << log2m
    return min((regwidth * m + 7) // 8 // 8, 1 << 17), 1 << ((m * regwidth // (log2m + regwidth)).bit_length() - 1)


def register(h: Column, log2m: int, regwidth: int) -> tuple[Column, Column]:
    """Index and register value of a 64-bit hash."""
    s = F.shiftrightunsigned(h, log2m)
    low = F.bit_count(s.bitwiseAND(F.when(s == 0, F.lit(0)).otherwise(-s).cast("long")) - 1)
    return h.bitwiseAND(F.lit((1 << log2m) - 1)).cast("int"), F.when(s == 0, 0).otherwise(F.least(low, F.lit((1 << regwidth) - 2)) + 1).cast("int")


def estimate_column(inverse_sum: Column, filled: Column, log2m: int, regwidth: int) -> Column:
    """Cardinality from the sum of 2^-register over the filled registers and their number."""
    m, top = 1 << log2m, 2.0 ** ((1 << regwidth) - 2 + log2m)
    alpha = 0.7213 / (1 + 1.079 / m) * m * m
    zeros = F.lit(m) - filled
    e = F.lit(alpha) / (inverse_sum + zeros)
    return F.when((zeros > 0) & (e < 2.5 * m), m * F.log(F.lit(float(m)) / F.when(zeros > 0, zeros))).when(e <= top / 30, e).otherwise(-top * F.log(1 - e / top))


def hashable(kind: T.DataType) -> bool:
    fixed = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    return isinstance(kind, (*fixed, T.StringType, T.BinaryType))


def hll_hash(value: Column, portable: bool = False) -> Column:
    """64-bit hash: xxhash64, or (portable) the low half of 128-bit murmur3. The latter's bytes are those of the value's
    type, little-endian: 4 for integers up to int, float and date, 8 for long, double, timestamps (microseconds) and
    decimals of up to 18 digits (unscaled), 16 for wider ones, 1 for booleans; text as UTF-8. -0.0 is 0.0, all NaN are
    one, and null stays null. Other types raise."""
    return murmur3_udf()(value) if portable else F.xxhash64(value)


def _rows(df: DataFrame, keys: list[str], value: str, log2m: int, regwidth: int, portable: bool, hashed: bool = False) -> DataFrame:
    own = F.col(value).cast("long") if hashed else hll_hash(F.col(value), portable)
    h = df.where(F.col(value).isNotNull()).select(*grouped.key_columns(df, keys), own.alias("_h"))
    return h.select(*[F.col(f"`{k}`") for k in keys], "_h", *(c.alias(n) for c, n in zip(register(F.col("_h"), log2m, regwidth), ("_idx", "_reg"), strict=True)))


def registers_of_hash(df: DataFrame, keys: list[str], hash_col: str, log2m: int = 12, regwidth: int = 6) -> DataFrame:
    """keys, ``idx`` and ``reg``: the registers that 64-bit hashes fill."""
    idx, reg = register(F.col(hash_col), log2m, regwidth)
    return df.where(F.col(hash_col).isNotNull()).groupBy(*keys, idx.alias("idx")).agg(F.max(reg).alias("reg"))


def estimate_of_registers(registers: DataFrame, keys: list[str], log2m: int = 12, regwidth: int = 6) -> DataFrame:
    """keys and ``estimate`` of registers (``idx``, ``reg``)."""
    filled = F.sum(F.when(F.col("reg") > 0, 1).otherwise(0))
    inverse = F.sum(F.when(F.col("reg") > 0, F.pow(F.lit(2.0), -F.col("reg"))).otherwise(0.0))
    return registers.groupBy(*keys).agg(estimate_column(inverse, filled, log2m, regwidth).alias("estimate"))


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Join condition: equal keys, null and null included."""
    found = F.lit(True)
    for k in keys:
        found = found & a[k].eqNullSafe(b[k])
    return found


def hll_estimate(df: DataFrame, keys: list[str], value: str, log2m: int = 12, regwidth: int = 6, portable: bool = False) -> DataFrame:
    """keys and ``estimate``: the exact count where the sketch would be explicit. Catalyst only unless portable. Only
    groups that may be explicit are counted exactly; large ones never gather or shuffle their hashes."""
    few, _ = limits(log2m, regwidth)
    rows = _rows(df, keys, value, log2m, regwidth, portable)
    registers = rows.groupBy(*keys, "_idx").agg(F.max("_reg").alias("_reg")).withColumnsRenamed({"_idx": "idx", "_reg": "reg"})
    rough = estimate_of_registers(registers, keys, log2m, regwidth)
    able = rough.where(F.col("estimate") <= 2 * few).select(*keys)
    counted = rows.join(able, same_keys(rows, able, keys), "left_semi").select(*keys, "_h").distinct().groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n").between(1, few))
    exact = counted.select(*[F.col(k).alias(f"_exact_{i}") for i, k in enumerate(keys)], "_n")
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_exact_{i}"))
    return rough.join(exact, on, "left").select(*keys, F.coalesce(F.col("_n").cast("double"), "estimate").alias("estimate"))


def with_part(df: DataFrame, keys: list[str], value: str, log2m: int = 12, regwidth: int = 6, part: str = "_part") -> DataFrame:
    """``df`` and the part of all values that a row's value belongs to. There are so many parts, by the estimate of the
    largest group, that sketches by keys and part stay explicit (their mean lies twelve deviations below the limit), at any
    size. Parts share no value, so their counts add up exactly; only keys and parts with values have a sketch."""
    mean = (math.sqrt(limits(log2m, regwidth)[0] + 36) - 6) ** 2
    hashes = df.where(F.col(f"`{value}`").isNotNull()).select(*[F.col(f"`{k}`") for k in keys], F.xxhash64(F.col(f"`{value}`")).alias("_h"))
    most = estimate_of_registers(registers_of_hash(hashes, keys, "_h"), keys).agg(F.ceil(F.coalesce(F.max("estimate"), F.lit(1.0)) / mean).alias("_parts"))
    own = F.pmod(F.xxhash64(F.lit("part"), F.col(f"`{value}`")), F.col("_parts"))
    return df.crossJoin(F.broadcast(most)).withColumn(part, own).drop("_parts")


@dataclass
class Sketch:
    """The distinct hashes while they are few, else registers."""

    log2m: int
    regwidth: int
    hashes: np.ndarray | None
    registers: np.ndarray | None = None

    @classmethod
    def empty(cls, log2m: int, regwidth: int) -> Sketch:
        return cls(log2m, regwidth, np.zeros(0, np.int64))

    def add(self, hashes: np.ndarray) -> Sketch:
        if self.hashes is not None:
            self.hashes = np.union1d(self.hashes, hashes)
            if len(self.hashes) <= limits(self.log2m, self.regwidth)[0]:
                return self
            hashes, self.hashes = self.hashes, None
            self.registers = np.zeros(1 << self.log2m, np.int64)
        np.maximum.at(self.registers, *registers_of(hashes, self.log2m, self.regwidth))
        return self

    def merge(self, raw: bytes) -> Sketch:
        state, idx, reg, hashes = from_bytes(raw, self.log2m, self.regwidth)
        if hashes is not None:
            return self.add(hashes)
        if self.registers is None:
            own, self.hashes, self.registers = self.hashes, None, np.zeros(1 << self.log2m, np.int64)
            self.add(own)
        np.maximum.at(self.registers, idx, reg)
        return self

    def to_bytes(self) -> bytes:
        none = np.zeros(0, np.int64)
        filled = none if self.registers is None else np.flatnonzero(self.registers)
        return to_bytes(filled, none if self.registers is None else self.registers[filled], self.hashes, self.log2m, self.regwidth)


def union_bytes(raws: list[bytes], log2m: int = 12, regwidth: int = 6) -> bytes:
    """Sketches as one: explicit if all are and the union fits, else registers. Any order gives the same."""
    sketch = Sketch.empty(log2m, regwidth)
    for raw in raws:
        sketch.merge(bytes(raw))
    return sketch.to_bytes()


def hll_agg(df: DataFrame, keys: list[str], value: str, log2m: int = 12, regwidth: int = 6, portable: bool = True, hashed: bool = False) -> DataFrame:
    """keys and ``sketch`` bytes, of portable hashes or (faster, no Python) of xxhash64; ``hashed``: the values are 64-bit
    hashes already. Groups that may be explicit are read a second time for their hashes."""
    limits(log2m, regwidth)
    kind = df.schema[value].dataType
    if not hashable(kind):
        raise ValueError(f"values of type {kind.simpleString()} can't be counted")
    rows = _rows(df, keys, value, log2m, regwidth, portable, hashed)
    return sketches_of(rows.withColumn("_explicit", F.lit(True)), keys, log2m, regwidth)


def _shifted(word: Column, left: Column) -> Column:
    """A word moved to the left by a number of bits, or to the right where that is negative."""
    return F.when(left >= 0, F.call_function("shiftleft", word, left)).otherwise(F.call_function("shiftrightunsigned", word, -left))


def _packed_block(regwidth: int) -> list[Column]:
    """``regwidth`` 64-bit numbers that hold the 64 registers of a block, highest bit first: a register's place says in
    which number it lies and how far it is shifted; the parts of one that lies in two meet there."""
    at, out = F.col("idx").bitwiseAND(F.lit(63)) * regwidth, []
    for k in range(regwidth):
        within = (at > 64 * k - regwidth) & (at < 64 * (k + 1))
        moved = _shifted(F.col("reg").cast("long"), F.lit(64 - regwidth + 64 * k) - at)
        out.append(F.coalesce(F.bit_or(F.when(within, moved)), F.lit(0).cast("long")).alias(f"_p{k}"))
    return out


def _hex64(number: Column) -> Column:
    return F.lpad(F.hex(number), 16, "0")


def _packed_words(words: Column, n: Column, width: int) -> Column:
    """n words of ``width`` bits on end, as hex digits of whole bytes: each 64-bit number gathers the words that reach into
    it."""

    def number(q: Column) -> Column:
        first, last = F.floor(64 * q / width).cast("int"), F.least(F.floor((64 * q + 63) / width), n - 1).cast("int")
        moved = lambda i: _shifted(F.get(words, i), (F.lit(64 - width) - i * width + 64 * q).cast("int"))
        return F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), lambda acc, i: acc.bitwiseOR(moved(i)))

    numbers = F.transform(F.sequence(F.lit(0), (F.floor((n * width + 63) / 64) - 1).cast("int")), lambda q: _hex64(number(q)))
    return F.left(F.array_join(numbers, ""), (2 * F.ceil(n * width / 8)).cast("int"))


def sketches_of(rows: DataFrame, keys: list[str], log2m: int, regwidth: int) -> DataFrame:
    """keys and ``sketch`` of rows with _h, _idx, _reg and _explicit (false where only the register is known)."""
    few, sparse = limits(log2m, regwidth)
    blocks = (1 << log2m) // 64
    same = [F.col(f"`{k}`") for k in keys]
    registers = rows.groupBy(*same, F.col("_idx").alias("idx")).agg(F.max("_reg").alias("reg"), F.bool_and("_explicit").alias("_explicit"))
    filled = F.col("reg") > 0
    held = registers.groupBy(*same, F.shiftright("idx", 6).alias("_block")).agg(
        *_packed_block(regwidth), F.sum(F.when(filled, F.pow(F.lit(2.0), -F.col("reg"))).otherwise(0.0)).alias("_inverse"), F.count(F.when(filled, 1)).alias("_filled"), F.bool_and("_explicit").alias("_explicit"),
        F.sort_array(F.collect_list(F.when(filled, F.shiftleft(F.col("idx").cast("long"), regwidth).bitwiseOR(F.col("reg").cast("long"))))).alias("_words"),
    )
    text = F.concat(*[_hex64(F.col(f"_p{k}")) for k in range(regwidth)])
    whole = held.groupBy(*same).agg(
        F.sum("_inverse").alias("_inverse"), F.sum("_filled").alias("_filled"), F.bool_and("_explicit").alias("_explicit"), F.sort_array(F.collect_list(F.struct("_block", text.alias("_text"), "_words"))).alias("_all"),
    )
    rough = estimate_column(F.col("_inverse"), F.col("_filled"), log2m, regwidth)
    able = whole.where(F.col("_explicit") & (rough <= 2 * few)).select(*same)
    hashes = rows.select(*same, "_h").join(able, same_keys(rows, able, keys), "left_semi").distinct()
    exact = hashes.groupBy(*same).agg(F.count("_h").alias("_n"), F.array_join(F.sort_array(F.collect_list(_hex64(F.col("_h")))), "").alias("_hashes")).where(F.col("_n").between(1, few))
    exact = exact.select(*[F.col(f"`{k}`").alias(f"_exact_{i}") for i, k in enumerate(keys)], "_hashes")
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"_exact_{i}"))
    out = whole.join(exact, on, "left")
    head = lambda state: F.lit(header(state, log2m, regwidth).hex())
    zeros = lambda n: F.call_function("repeat", F.lit("0"), (16 * regwidth * n).cast("int"))
    before = lambda i: F.when(i > 0, F.get(F.col("_all"), i - 1)["_block"]).otherwise(-1)
    full = F.array_join(F.transform("_all", lambda x, i: F.concat(zeros(x["_block"] - before(i) - 1), x["_text"])), "")
    full = F.concat(full, zeros(blocks - 1 - F.element_at("_all", -1)["_block"]))
    words = _packed_words(F.flatten(F.transform("_all", lambda x: x["_words"])), F.col("_filled"), log2m + regwidth)
    body = F.when(F.col("_hashes").isNotNull(), F.concat(head("explicit"), "_hashes")).when(F.col("_filled") == 0, F.when(F.col("_explicit"), head("empty")).otherwise(head("sparse")))
    body = body.when(F.col("_filled") <= sparse, F.concat(head("sparse"), words)).otherwise(F.concat(head("full"), full))
    # one value from an array of one: a step that later projections aren't merged with, as Python UDFs take no lambdas
    return out.select(*same, F.explode(F.array(F.unhex(body))).alias("sketch"))


def _most(code: np.ndarray, idx: np.ndarray, reg: np.ndarray, log2m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest register of each code and index."""
    key = code << log2m | idx
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(key[order]) > 0)) if len(key) else np.zeros(0, np.int64)
    top = key[order][first]
    return top >> log2m, top & ((1 << log2m) - 1), np.maximum.reduceat(reg[order], first) if len(first) else reg


def many_from_bytes(raws: pa.Array, code: np.ndarray, log2m: int, regwidth: int) -> tuple[np.ndarray, ...]:
    """code, idx, reg, hash and kind (0: register of a sketch without hashes, 1: hash, 2: an empty sketch) of the sketches'
    contents; registers of equal codes are merged. All sketches of a state are read together."""
    raws = raws.cast(pa.large_binary())
    ends = np.frombuffer(raws.buffers()[1], np.int64)[raws.offset : raws.offset + len(raws) + 1]
    data = np.append(np.frombuffer(raws.buffers()[2], np.uint8), np.zeros(8, np.uint8)) if raws.buffers()[2] is not None else np.zeros(8, np.uint8)
    begin, size = ends[:-1], np.diff(ends)
    state = data[begin] & 15
    if (size < 3).any() or (data[begin] >> 4 != 1).any() or (data[begin + 1] != ((regwidth - 1) << 5 | log2m)).any():
        raise ValueError("not a sketch of these parameters")
    body, long = begin + 3, size - 3
    is_ = {k: np.flatnonzero(state == v) for k, v in STATES.items()}
    m = 1 << log2m
    need = regwidth * m // 8
    if sum(map(len, is_.values())) < len(state) or (long[is_["explicit"]] % 8).any() or (long[is_["full"]] < need).any():
        raise ValueError("broken sketch")
    rows = is_["explicit"]
    counts = long[rows] // 8
    hashes = data[np.arange(int(8 * counts.sum())) + np.repeat(body[rows] - 8 * (np.cumsum(counts) - counts), 8 * counts)].view(">u8").astype(np.uint64).view(np.int64)
    parts = [(np.repeat(code[rows], counts), *registers_of(hashes, log2m, regwidth), hashes, np.ones(len(hashes), np.int8))]
    none = lambda n, kind: (np.zeros(n, np.int64), np.full(n, kind, np.int8))
    rows, width = is_["sparse"], log2m + regwidth
    counts = 8 * long[rows] // width
    bit = 8 * np.repeat(body[rows], counts) + width * (np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts))
    word = np.zeros(len(bit), np.int64)
    for k in range(5):
        word = word << 8 | data[bit // 8 + k]
    word = word >> (40 - bit % 8 - width) & ((1 << width) - 1)
    reg = word & ((1 << regwidth) - 1)
    merged = _most(np.repeat(code[rows], counts)[reg > 0], word[reg > 0] >> regwidth, reg[reg > 0], log2m)
    parts.append((*merged, *none(len(merged[0]), 0)))
    rows = is_["full"][np.argsort(code[is_["full"]], kind="stable")]
    step = max(1, (1 << 25) // (regwidth * m))
    for at in range(0, len(rows), step):
        some = rows[at : at + step]
        bits_ = np.unpackbits(data[body[some][:, None] + np.arange(need)], axis=1).reshape(len(some), m, regwidth)
        table = sum(bits_[:, :, k] << (regwidth - 1 - k) for k in range(regwidth))
        first = np.flatnonzero(np.append(True, np.diff(code[some]) != 0))
        top = np.maximum.reduceat(table, first, axis=0)
        own, idx = np.nonzero(top)
        parts.append((code[some][first][own], idx, top[own, idx].astype(np.int64), *none(len(own), 0)))
    rows = is_["empty"]
    parts.append((code[rows], *(np.zeros(len(rows), np.int64) for _ in range(2)), *none(len(rows), 2)))
    return tuple(np.concatenate([p[k] for p in parts]) for k in range(5))


def _contents(df: DataFrame, keys: list[str], sketch: str, log2m: int, regwidth: int, apart: bool) -> DataFrame:
    """keys, _explicit, _idx, _reg, _h and _kind of the sketches; registers of a batch's equal keys are merged unless
    ``apart``."""
    schema = T.StructType([*(df.schema[k] for k in keys), *T.StructType.fromDDL("_explicit boolean, _idx int, _reg int, _h long, _kind int")])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                columns = batch.columns[:-1]
                code, first = grouped.codes(columns, batch.num_rows) if not apart else (np.arange(batch.num_rows),) * 2
                code, idx, reg, h, kind = many_from_bytes(batch.columns[-1], code, log2m, regwidth)
                own = [c.take(pa.array(first[code])) for c in columns]
                made = [pa.array(kind > 0), pa.array(idx.astype(np.int32)), pa.array(reg.astype(np.int32)), pa.array(h, mask=kind != 1), pa.array(kind.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*own, *made], schema.names)

    return df.where(F.col(f"`{sketch}`").isNotNull()).select(*grouped.key_columns(df, keys), F.col(f"`{sketch}`")).mapInArrow(run, schema)


def hll_decode(df: DataFrame, keys: list[str], sketch: str = "sketch", log2m: int = 12, regwidth: int = 6) -> DataFrame:
    """keys, _explicit and one row per hash (_h, with its register) or register (_h null) of every sketch."""
    return _contents(df, keys, sketch, log2m, regwidth, True).where("_kind < 2").drop("_kind")


def hll_union_agg(df: DataFrame, keys: list[str], sketch: str = "sketch", log2m: int = 12, regwidth: int = 6) -> DataFrame:
    """keys and the union of each group's sketches, as ``sketch``; null sketches are left out. Explicit if all are and the
    union fits, else registers."""
    return sketches_of(_contents(df, keys, sketch, log2m, regwidth, False), keys, log2m, regwidth)


def register_functions(spark: SparkSession, log2m: int = 12, regwidth: int = 6) -> None:
    """SQL functions: hll_hash_of(text), hll_cardinality(sketch), hll_union(sketch, sketch)."""

    @F.arrow_udf("double")
    def hll_cardinality(raw: pa.Array) -> pa.Array:
        return pa.array([None if b is None else estimate(b, log2m, regwidth) for b in raw.to_pylist()], pa.float64())

    @F.arrow_udf("binary")
    def hll_union(one: pa.Array, two: pa.Array) -> pa.Array:
        """A null sketch adds nothing; two nulls are null."""
        pairs = ([x for x in (a, b) if x is not None] for a, b in zip(one.to_pylist(), two.to_pylist(), strict=True))
        return pa.array([union_bytes(p, log2m, regwidth) if p else None for p in pairs], pa.binary())

    @F.arrow_udf("long")
    def hll_hash_of(text: pa.Array) -> pa.Array:
        return hashed(text)

    for f in (hll_cardinality, hll_union, hll_hash_of):
        spark.udf.register(f.__name__ if hasattr(f, "__name__") else f.func.__name__, f)


def hll_sketch_estimate(sketch: Column, log2m: int = 12, regwidth: int = 6) -> Column:
    """The cardinality that sketch bytes stand for."""

    @F.pandas_udf("double")
    def count(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: None if b is None else estimate(bytes(b), log2m, regwidth))

    return count(sketch)


def bits(values: np.ndarray, width: int) -> bytes:
    """Numbers of ``width`` bits each, highest bit first."""
    return np.packbits((values.astype(np.int64)[:, None] >> np.arange(width - 1, -1, -1) & 1).astype(np.uint8).reshape(-1)).tobytes()


def unbits(raw: bytes, width: int) -> np.ndarray:
    flat = np.unpackbits(np.frombuffer(raw, np.uint8))
    return flat[: len(flat) // width * width].reshape(-1, width).astype(np.int64) @ (1 << np.arange(width - 1, -1, -1))


def header(state: str, log2m: int, regwidth: int) -> bytes:
    return bytes([1 << 4 | STATES[state], (regwidth - 1) << 5 | log2m, 127])


def to_bytes(idx: np.ndarray, reg: np.ndarray, hashes: np.ndarray | None, log2m: int, regwidth: int) -> bytes:
    few, sparse = limits(log2m, regwidth)
    if hashes is not None and len(hashes) <= few:
        if not len(hashes):
            return header("empty", log2m, regwidth)
        return header("explicit", log2m, regwidth) + np.sort(hashes.view(np.uint64)).astype(">u8").tobytes()
    idx, reg = idx[reg > 0], reg[reg > 0]
    if len(idx) <= sparse:
        return header("sparse", log2m, regwidth) + bits(np.sort(idx.astype(np.int64) << regwidth | reg), log2m + regwidth)
    full = np.zeros(1 << log2m, np.int64)
    full[idx] = reg
    return header("full", log2m, regwidth) + bits(full, regwidth)


def registers_of(hashes: np.ndarray, log2m: int, regwidth: int) -> tuple[np.ndarray, np.ndarray]:
    h = hashes.view(np.uint64)
    s = h >> np.uint64(log2m)
    zeros = np.bitwise_count((s & (~s + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    return (h & np.uint64((1 << log2m) - 1)).astype(np.int64), np.where(s == 0, 0, np.minimum(zeros, (1 << regwidth) - 2) + 1)


def from_bytes(raw: bytes, log2m: int, regwidth: int) -> tuple[str, np.ndarray, np.ndarray, np.ndarray | None]:
    """state, indexes, registers and (explicit) hashes."""
    if len(raw) < 3 or raw[0] >> 4 != 1 or raw[1] != ((regwidth - 1) << 5 | log2m):
        raise ValueError("not a sketch of these parameters")
    names = {v: k for k, v in STATES.items()}
    state, body = names.get(raw[0] & 15), raw[3:]
    if state == "empty":
        return state, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if state == "explicit" and len(body) % 8 == 0:
        hashes = np.frombuffer(body, ">u8").astype(np.uint64).view(np.int64)
        return state, *registers_of(hashes, log2m, regwidth), hashes
    if state == "sparse":
        words = unbits(body, log2m + regwidth)
        words = words[words & ((1 << regwidth) - 1) > 0]
        return state, words >> regwidth, words & ((1 << regwidth) - 1), None
    if state == "full" and len(body) * 8 >= regwidth << log2m:
        reg = unbits(body, regwidth)[: 1 << log2m]
        return state, np.flatnonzero(reg), reg[reg > 0], None
    raise ValueError("broken sketch")


def estimate(raw: bytes, log2m: int = 12, regwidth: int = 6) -> float:
    if raw[:2] == header("explicit", log2m, regwidth)[:2] and len(raw) % 8 == 3:
        return float(len(raw) // 8)  # no need to read the hashes
    _, _, reg, hashes = from_bytes(raw, log2m, regwidth)
    if hashes is not None:
        return float(len(hashes))
    m, top = 1 << log2m, 2.0 ** ((1 << regwidth) - 2 + log2m)
    zeros = m - len(reg)
    e = 0.7213 / (1 + 1.079 / m) * m * m / (float((2.0**-reg).sum()) + zeros)
    if zeros and e < 2.5 * m:
        return m * float(np.log(m / zeros))
    return e if e <= top / 30 else float(-top * np.log(1 - e / top))


def murmur3(items: list[bytes]) -> np.ndarray:
    """Low half of the 128-bit murmur3 hash (x64, seed 0) of each item; items of like lengths advance together."""
    n = np.array([len(i) for i in items], np.int64)
    out = np.zeros(len(items), np.uint64)
    kind = np.ceil(np.log2(n // 16 + 1)).astype(int) if len(n) else n
    for k in np.unique(kind):
        rows = np.flatnonzero(kind == k)
        width = int(n[rows].max()) // 16 * 16 + 16
        out[rows] = _murmur3(np.frombuffer(b"".join(items[i].ljust(width, b"\0") for i in rows), "<u8").reshape(len(rows), -1), n[rows])
    return out


def murmur3_words(words: np.ndarray) -> np.ndarray:
    """The same of 64-bit numbers as eight little-endian bytes."""
    return _murmur3(np.column_stack([words, np.zeros_like(words)]), np.full(len(words), 8))


def _murmur3(data: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of padded 16-byte blocks (two numbers each), with the items' lengths."""
    u = np.uint64
    c1, c2 = u(0x87C37B91114253D5), u(0x4CF5AD432745937F)
    rot = lambda x, r: (x << u(r)) | (x >> u(64 - r))
    a = b = np.zeros(len(data), u)
    for k in range(data.shape[1] // 2):
        x, y, left = data[:, 2 * k], data[:, 2 * k + 1], n - 16 * k
        x, y = rot(x * c1, 31) * c2, rot(y * c2, 33) * c1
        p = (rot(a ^ x, 27) + b) * u(5) + u(0x52DCE729)
        q = (rot(b ^ y, 31) + p) * u(5) + u(0x38495AB5)
        whole, tail = left >= 16, (left > 0) & (left < 16)
        a, b = np.where(whole, p, np.where(tail, a ^ x, a)), np.where(whole, q, np.where(tail, b ^ y, b))
    a, b = a ^ n.astype(u), b ^ n.astype(u)
    a = a + b
    b = b + a

    def fin(x):
        x = (x ^ (x >> u(33))) * u(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> u(33))) * u(0xC4CEB9FE1A85EC53)
        return x ^ (x >> u(33))

    return fin(a) + fin(b)


def murmur3_of(values: pa.Array) -> np.ndarray:
    """The hashes of values without nulls, by their Arrow type."""
    kind = values.type
    if pa.types.is_string(kind) or pa.types.is_large_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_binary(kind):
        return murmur3([v.encode("utf-8", "surrogatepass") if isinstance(v, str) else v for v in values.to_pylist()]).view(np.int64)
    if pa.types.is_decimal(kind):
        # the unscaled number, as 16 bytes of two's complement
        raw = np.frombuffer(values.cast(pa.decimal128(38, kind.scale)).buffers()[1], "<u8").reshape(-1, 2)
        words = raw[values.offset : values.offset + len(values)] if values.type == pa.decimal128(38, kind.scale) else raw[: len(values)]
        return (murmur3_words(words[:, 0]) if kind.precision <= 18 else _murmur3(np.column_stack([words, np.zeros_like(words)]), np.full(len(words), 16))).view(np.int64)
    if pa.types.is_boolean(kind):
        plain, size = values.cast(pa.uint8()).to_numpy().astype(np.uint64), 1
    elif pa.types.is_floating(kind):
        number = values.to_numpy(zero_copy_only=False)
        number = np.where(np.isnan(number), np.nan, number + 0.0).astype(number.dtype)
        plain, size = number.view(f"u{number.itemsize}").astype(np.uint64), number.itemsize
    elif pa.types.is_date(kind):
        plain, size = values.cast(pa.int32()).to_numpy().astype(np.uint32).astype(np.uint64), 4
    elif pa.types.is_timestamp(kind):
        plain, size = values.cast(pa.timestamp("us", kind.tz)).cast(pa.int64()).to_numpy().view(np.uint64), 8
    elif pa.types.is_integer(kind):
        size = 8 if kind.bit_width == 64 else 4
        plain = values.to_numpy().astype(np.int64).view(np.uint64) if size == 8 else values.to_numpy().astype(np.int32).view(np.uint32).astype(np.uint64)
    else:
        raise ValueError(f"values of type {kind} can't be hashed")
    return _murmur3(np.column_stack([plain, np.zeros_like(plain)]), np.full(len(plain), size)).view(np.int64)


def hashed(values: pa.Array) -> pa.Array:
    """``murmur3_of``, with nulls for nulls."""
    some = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
    out, known = np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    out[some], known[some] = murmur3_of(values.take(pa.array(some))), True
    return pa.array(out, pa.int64(), mask=~known)


def murmur3_udf():
    @F.arrow_udf("long")
    def portable(values: pa.Array) -> pa.Array:
        return hashed(values)

    return portable
