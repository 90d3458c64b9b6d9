"""Typed tables of any size from a JSON spec. Every value is a function of the row id and the seed, so rows are the same
whatever the partitioning; each generator is a column expression (an Arrow UDF for IPv6 and sketches)."""

from __future__ import annotations

import base64
import binascii
import datetime
import ipaddress
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from re import _constants as K
from re import _parser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge import derive, hll, ordinal, tdigest

SPAN = 1 << 53


@dataclass
class Draw:
    """One draw: its ordinal for stateful generators, and the coordinates that random ones hash."""

    at: Column
    salt: tuple[Column, ...]

    def number(self, *more) -> Column:
        return F.xxhash64(*self.salt, *[m if isinstance(m, Column) else F.lit(m) for m in more])

    def uniform(self, *more) -> Column:
        return F.pmod(self.number(*more), F.lit(SPAN)) / float(SPAN)

    def below(self, n, *more) -> Column:
        return F.pmod(self.number(*more), F.lit(n).cast("long") if not isinstance(n, Column) else n)


def _pick(values: list, draw: Draw, random: bool, kind: str) -> Column:
    """One of a list that may hold nulls."""
    options = F.array(*[F.lit(v).cast(kind) for v in values])
    return F.element_at(options, ((draw.below(len(values)) if random else F.pmod(draw.at, F.lit(len(values)))) + 1).cast("int"))


def _range(spec: dict, draw: Draw, kind: str) -> Column:
    low, high = spec.get("min", 0), spec.get("max", 0)
    if low >= high:
        raise ValueError(f"{spec['name']}: min must be below max")
    if kind in ("float", "double"):
        return (F.lit(float(low)) + draw.uniform() * (high - low)).cast(kind)
    wide = high - low >= 1 << 63
    step = F.pmod(draw.number().cast("decimal(38,0)"), F.lit(str(high - low)).cast("decimal(38,0)")) if wide else draw.below(high - low)
    if not spec.get("random", True):
        step = F.pmod(draw.at.cast("decimal(38,0)"), F.lit(str(high - low)).cast("decimal(38,0)")) if wide else F.pmod(draw.at, F.lit(high - low).cast("long"))
    return (F.lit(str(low)).cast("decimal(38,0)") + step).cast(kind) if wide else (F.lit(low).cast("long") + step).cast(kind)


def _number(kind: str) -> Callable:
    def build(spec: dict, draw: Draw) -> Column:
        return _pick(spec["options"], draw, spec.get("random", True), kind) if spec.get("options") else _range(spec, draw, kind)

    return build


def _boolean(spec: dict, draw: Draw) -> Column:
    if spec.get("options"):
        return _pick(spec["options"], draw, spec.get("random", True), "boolean")
    rate = float(spec.get("true_rate", 0.5))
    rate = 0.5 if rate != rate else min(1.0, max(0.0, rate))
    return draw.uniform() < rate if spec.get("random", True) else draw.at % 2 == 1


def _steps(spec: dict, draw: Draw, start: int) -> Column:
    batch = max(1, spec.get("batch", 1))
    return F.lit(start).cast("long") + F.lit(spec.get("step", 1)).cast("long") * F.floor(draw.at / batch)


def _sequence(spec: dict, draw: Draw) -> Column:
    return _steps(spec, draw, spec.get("start", 0))


def _joined(n: int | Column, item: Callable[[Column], Column]) -> Column:
    count = F.lit(n) if isinstance(n, int) else n
    return F.array_join(F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), item)).otherwise(F.expr("cast(array() as array<string>)")), "")


def _chars(alphabet: str, draw: Draw, *more) -> Column:
    return F.substring(F.lit(alphabet), (draw.below(len(alphabet), *more) + 1).cast("int"), F.lit(1))


_SETS = {K.CATEGORY_DIGIT: "0123456789", K.CATEGORY_WORD: "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_", K.CATEGORY_SPACE: " \t\n\r\x0b\x0c"}
_ALL = "".join(map(chr, range(32, 127)))


def _class(items) -> str:
    """The ASCII characters of a class."""
    chars, negate = "", False
    for op, v in items:
        if op is K.NEGATE:
            negate = True
        elif op is K.LITERAL:
            chars += chr(v)
        elif op is K.RANGE:
            chars += "".join(map(chr, range(v[0], v[1] + 1)))
        elif op is K.CATEGORY and v in _SETS:
            chars += _SETS[v]
        elif op is K.CATEGORY:
            chars += "".join(c for c in _ALL if c not in _SETS[{K.CATEGORY_NOT_DIGIT: K.CATEGORY_DIGIT, K.CATEGORY_NOT_WORD: K.CATEGORY_WORD, K.CATEGORY_NOT_SPACE: K.CATEGORY_SPACE}[v]])
    return "".join(c for c in _ALL if c not in chars) if negate else "".join(dict.fromkeys(chars))


def regex_column(pattern: str, draw: Draw) -> Column:
    """A string that matches: open repeats have up to four more than their least; anchors raise."""
    sites = iter(range(1 << 30))

    def walk(items, loops: tuple) -> Column:
        parts = []
        for op, v in items:
            site = next(sites)
            if op is K.LITERAL:
                parts.append(F.lit(chr(v)))
            elif op is K.NOT_LITERAL or op is K.ANY:
                parts.append(_chars(_ALL.replace(chr(v), "") if op is K.NOT_LITERAL else _ALL, draw, site, *loops))
            elif op is K.IN:
                parts.append(_chars(_class(v), draw, site, *loops))
            elif op is K.SUBPATTERN:
                parts.append(walk(v[3], loops))
            elif op is K.BRANCH:
                branches = [walk(b, loops) for b in v[1]]
                parts.append(F.element_at(F.array(*branches), (draw.below(len(branches), site, *loops) + 1).cast("int")))
            elif op in (K.MAX_REPEAT, K.MIN_REPEAT):
                low, high = int(v[0]), int(v[0]) + 4 if v[1] is K.MAXREPEAT else int(v[1])
                n = F.lit(low) + draw.below(high - low + 1, site, *loops).cast("int")
                parts.append(_repeat(n, v[2], walk, loops))
            else:
                raise ValueError(f"can't generate {op} of {pattern!r}")
        return F.concat(*parts) if parts else F.lit("")

    return walk(_parser.parse(pattern), ())


def _repeat(n: Column, inner, walk: Callable, loops: tuple) -> Column:
    return _joined(n, lambda j: walk(inner, (*loops, j)))


def _string(spec: dict, draw: Draw) -> Column:
    if spec.get("options"):
        return _pick(spec["options"], draw, spec.get("random", True), "string")
    if spec.get("chars"):
        return _joined(spec.get("len", 0), lambda j: _chars(spec["chars"], draw, j))
    return regex_column(spec.get("regex") or "[a-zA-Z]{0,5}", draw)


def _day(text: str) -> datetime.date:
    try:
        return datetime.date.fromisoformat(text)
    except ValueError:
        return datetime.datetime.now(datetime.UTC).date()


def _as_date(days: Column, spec: dict) -> Column:
    return days.cast("int") if spec.get("date_type", "date") == "number" else F.date_from_unix_date(days.cast("int"))


def _date(spec: dict, draw: Draw) -> Column:
    return _as_date(F.unix_date(F.to_date(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))), spec)


def _date_sequence(spec: dict, draw: Draw) -> Column:
    return _as_date(_steps(spec, draw, (_day(spec.get("start", "")) - datetime.date(1970, 1, 1)).days), spec)


_UNITS = {"seconds": 1_000_000, "millis": 1_000, "micros": 1}


def _as_time(number: Column, spec: dict) -> Column:
    if spec.get("timestamp_type", "number") == "number":
        return number
    micros = number * _UNITS[spec.get("unit", "seconds")]
    return F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) + F.make_dt_interval(secs=(micros / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)"))


def _timestamp(spec: dict, draw: Draw) -> Column:
    return _as_time(F.floor(F.unix_micros(F.current_timestamp()) / _UNITS[spec.get("unit", "seconds")]), spec)


def _timestamp_sequence(spec: dict, draw: Draw) -> Column:
    try:
        start = datetime.datetime.fromisoformat(spec.get("start", "")).replace(tzinfo=datetime.UTC)
    except ValueError:
        start = datetime.datetime.now(datetime.UTC)
    micros = (start - datetime.datetime(1970, 1, 1, tzinfo=datetime.UTC)) // datetime.timedelta(microseconds=1)
    return _as_time(_steps(spec, draw, micros // _UNITS[spec.get("unit", "seconds")]), spec)


def _ipv4(spec: dict, draw: Draw) -> Column:
    low, high = (int(ipaddress.IPv4Address(spec.get(k, d))) for k, d in (("start", "0.0.0.0"), ("end", "255.255.255.255")))
    if low >= high:
        raise ValueError(f"{spec['name']}: start must be below end")
    v = F.lit(low).cast("long") + draw.below(high - low + 1)
    return F.concat_ws(".", *[F.shiftright(v, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)])


def _ipv6(spec: dict, draw: Draw) -> Column:
    low, high = (int(ipaddress.IPv6Address(spec.get(k, d))) for k, d in (("start", "::"), ("end", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff")))
    if low >= high:
        raise ValueError(f"{spec['name']}: start must be below end")

    @F.pandas_udf("string")
    def address(a: pd.Series, b: pd.Series) -> pd.Series:
        words = zip(a.to_numpy().view(np.uint64).tolist(), b.to_numpy().view(np.uint64).tolist(), strict=True)
        return pd.Series([str(ipaddress.IPv6Address(low + (x << 64 | y) % (high - low + 1))) for x, y in words])

    return address(draw.number("a"), draw.number("b"))


def _out(raw: Column, spec: dict) -> Column:
    kind = spec.get("out_type", "binary")
    return raw if kind == "binary" else F.base64(raw) if kind == "base64" else F.lower(F.hex(raw))


def _option_bytes(text: str | None) -> bytes | None:
    if text is None:
        return None
    try:
        if len(text) % 2 == 0:
            return bytes.fromhex(text)
    except ValueError:
        pass
    try:
        return base64.b64decode(text, validate=True)
    except (binascii.Error, ValueError):
        return text.encode()


def _binary(spec: dict, draw: Draw) -> Column:
    if spec.get("options"):
        return _out(F.unhex(_pick([None if b is None else b.hex() for b in map(_option_bytes, spec["options"])], draw, spec.get("random", True), "string")), spec)
    alphabet = bytes(spec.get("bytes") or b"abcdefg")
    codes = F.array(*[F.lit(f"{b:02x}") for b in alphabet])
    return _out(F.unhex(_joined(spec.get("len", 0), lambda j: F.element_at(codes, (draw.below(len(alphabet), j) + 1).cast("int")))), spec)


#: Items that numpy handles at a time.
ITEMS = 1 << 14


def _items(seeds: list[int], n: int, below: int) -> np.ndarray:
    """A row of n items for each seed: those of Generator(Philox(seed)), whose start one generator is given in turn."""
    bits = np.random.Philox(0)
    random, start, out = np.random.Generator(bits), bits.state, np.zeros((len(seeds), n), np.int64)
    for k, seed in enumerate(seeds):
        start["state"]["key"] = np.random.SeedSequence(seed & (1 << 64) - 1).generate_state(2, np.uint64)
        bits.state = start
        out[k] = random.integers(0, below, n)
    return out


def _blocks(seeds: pd.Series, n: int, below: int) -> Iterator[np.ndarray]:
    all_, rows = seeds.tolist(), max(1, ITEMS // max(n, 1))
    for at in range(0, len(all_), rows):
        yield _items(all_[at : at + rows], n, below)


def _sketches(items: np.ndarray, log2m: int, width: int) -> list[bytes]:
    """The HLL sketch of each row of items."""
    rows, n = items.shape
    hashes = np.sort(hll.murmur3_words(items.reshape(-1).astype(np.uint64)).reshape(rows, n), axis=1)
    few, head, raw = hll.limits(log2m, width)[0], hll.header("explicit", log2m, width), hashes.astype(">u8").tobytes()
    distinct = (hashes[:, 1:] != hashes[:, :-1]).sum(1) + 1 if n else np.zeros(rows, int)
    out = []
    for k, count in enumerate(distinct.tolist()):
        if 0 < count == n <= few:
            out.append(head + raw[8 * n * k : 8 * n * (k + 1)])
            continue
        own = np.unique(hashes[k]).view(np.int64)
        best = np.zeros(1 << log2m if count > few else 0, np.int64)
        if count > few:
            np.maximum.at(best, *hll.registers_of(own, log2m, width))
        out.append(hll.to_bytes(np.flatnonzero(best), best[best > 0], own, log2m, width))
    return out


def _hll(spec: dict, draw: Draw) -> Column:
    log2m, width, below, n = spec.get("log2m", 12), spec.get("regwidth", 6), spec.get("item_count", 1_000_000), spec.get("batch_count", 1000)
    hll.limits(log2m, width)

    @F.pandas_udf("binary")
    def sketch(seeds: pd.Series) -> pd.Series:
        return pd.Series([raw for items in _blocks(seeds, n, below) for raw in _sketches(items, log2m, width)], dtype=object)

    return _out(sketch(draw.number()), spec)


def _tdigest(spec: dict, draw: Draw) -> Column:
    below, n, size = spec.get("max", 1_000_000), spec.get("batch_count", 1000), spec.get("compression", 100)

    @F.pandas_udf("binary")
    def sketch(seeds: pd.Series) -> pd.Series:
        return pd.Series([tdigest.to_bytes(tdigest.of_values(row, size)) for items in _blocks(seeds, n, below) for row in items.astype(float)], dtype=object)

    return _out(sketch(draw.number()), spec)


#: type name -> fn(spec, draw) -> Column; add to it to extend the generator.
GENERATORS: dict[str, Callable[[dict, Draw], Column]] = {
    "int": _number("int"), "bigint": _number("bigint"), "float": _number("float"), "double": _number("double"), "boolean": _boolean, "sequence": _sequence,
    "string": _string, "date": _date, "date_sequence": _date_sequence, "timestamp": _timestamp, "timestamp_sequence": _timestamp_sequence,
    "ipv4": _ipv4, "ipv6": _ipv6, "binary": _binary, "hll": _hll, "tdigest": _tdigest,
}
_UDF = ("ipv6", "hll", "tdigest")


def stateful(spec: dict) -> bool:
    return spec["type"].endswith("sequence") or spec.get("random", True) is False or spec["type"] == "struct" and any(map(stateful, spec["fields"]))


def _rate(spec: dict, key: str) -> float:
    return min(1.0, max(0.0, float(spec.get(key, 0))))


class Builder:
    """Adds the columns of a spec to a frame."""

    def __init__(self, df: DataFrame, id_col: str, seed: int):
        self.base, self.id, self.seed = df, id_col, seed
        self.draws: dict[str, Column] = {}

    def draw(self, name: str, at: Column) -> Draw:
        return Draw(at, (F.lit(self.seed), F.lit(name), F.col(self.id)))

    def prefix(self, draws: Column) -> Column:
        """The ordinal that a column's draws give; ``framed`` adds those of all columns in one pass."""
        self.draws[name := f"_ordinal{len(self.draws)}"] = draws
        return F.col(name)

    def framed(self) -> DataFrame:
        return ordinal.with_prefix_sums(self.base, self.id, self.draws)

    def leaf(self, spec: dict, draw: Draw, path: str) -> Column:
        if spec["type"] == "struct":
            names = [f["name"] for f in spec["fields"]]
            if len(set(names)) < len(names) or any(f["type"] in ("union", "eval") for f in spec["fields"]):
                raise ValueError(f"{path}: struct fields need unique names and can't be union or eval")
            return F.struct(*[self.value(f, Draw(draw.at, (*draw.salt, F.lit(f["name"]))), f"{path}.{f['name']}").alias(f["name"]) for f in spec["fields"]])
        if spec["type"] not in GENERATORS:
            raise ValueError(f"{path}: unknown type {spec['type']}")
        return GENERATORS[spec["type"]](spec, draw)

    def value(self, spec: dict, draw: Draw, path: str, alive: Column | None = None) -> Column:
        """The wrapped column. ``alive``: rows that draw at all, where that isn't all of them."""
        null, item_null = _rate(spec, "null_rate"), _rate(spec, "array_item_null_rate")
        present = draw.uniform("null") >= null if null else None
        drawing = [c for c in (alive, present) if c is not None]
        if not spec.get("array"):
            if drawing and stateful(spec):
                on = drawing[0] if len(drawing) == 1 else drawing[0] & drawing[1]
                draw = Draw(self.prefix(on.cast("int")), draw.salt)
            out = self.leaf(spec, draw, path)
            return F.when(present, out) if present is not None else out
        low, high = spec.get("array_len_min", 0), spec.get("array_len_max", 5)
        size = (F.lit(low) + draw.below(high - low + 1, "length")).cast("int")
        there = lambda j: draw.uniform("item", j) >= item_null
        indexes = lambda n: F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.expr("cast(array() as array<int>)"))
        start = draw.at
        if stateful(spec):
            count = F.size(F.filter(indexes(size), there)) if item_null else size
            for c in drawing:
                count = F.when(c, count).otherwise(0)
            start = self.prefix(count)
        if spec["type"] in _UDF:
            items = []
            for j in range(1, high + 1):
                one = self.leaf(spec, Draw(start, (*draw.salt, F.lit(j))), path)
                items.append(F.when(there(F.lit(j)), one) if item_null else one)
            out = F.slice(F.array(*items), F.lit(1), size)
        else:

            def item(j: Column) -> Column:
                before = F.size(F.filter(indexes(j - 1), there)) if item_null and stateful(spec) else j - 1
                one = self.leaf(spec, Draw(start + before, (*draw.salt, j)), path)
                return F.when(there(j), one) if item_null else one

            out = F.transform(indexes(size), item)
        return F.when(present, out) if present is not None else out

    def union(self, spec: dict) -> dict[str, Column]:
        """Fields of the branch that a row falls into; the others' are null. Same name, same type."""
        groups = spec["union_fields"]
        weights = [int(g.get("weight", 1)) for g in groups]
        if min(weights) < 1:
            raise ValueError(f"{spec['name']}: weights must be 1 or more")
        draw, total = self.draw(spec["name"], F.col(self.id)), sum(weights)
        random = spec.get("random", True)
        r = draw.below(total, "branch") if random else F.pmod(F.col(self.id), F.lit(total))
        out: dict[str, Column] = {}
        kinds: dict[str, str] = {}
        edge = 0
        for b, (group, weight) in enumerate(zip(groups, weights, strict=True)):
            on = (r >= edge) & (r < edge + weight)
            at = F.col(self.id) if random else F.floor(F.col(self.id) / total) * weight + (r - edge)
            for f in group["fields"]:
                if f["type"] in ("union", "eval"):
                    raise ValueError(f"{spec['name']}: a union can't hold union or eval")
                if kinds.setdefault(f["name"], f["type"]) != f["type"]:
                    raise ValueError(f"{spec['name']}: {f['name']} has two types")
                own = Draw(at, (*draw.salt, F.lit(b), F.lit(f["name"])))
                alive = on if random or f.get("null_rate") or f.get("array") else None
                value = F.when(on, self.value(f, own, f"{spec['name']}.{b}.{f['name']}", alive))
                out[f["name"]] = F.coalesce(out[f["name"]], value) if f["name"] in out else value
            edge += weight
        return out


def with_generated(df: DataFrame, spec: list[dict] | str, id_col: str, seed: int = 42) -> DataFrame:
    """``df`` with the columns of ``spec``; ``id_col`` numbers its rows from 0 without gaps where a generator has state."""
    spec = json.loads(spec) if isinstance(spec, str) else spec
    build, made = Builder(df, id_col, seed), []
    columns: dict[str, Column] = {}
    for f in spec:
        if f["type"] == "eval":
            made.append(f["name"])
            continue
        new = build.union(f) if f["type"] == "union" else {f["name"]: build.value(f, build.draw(f["name"], F.col(id_col)), f["name"])}
        columns.update(new)
        made += new
    if len(set(made)) < len(made):
        raise ValueError("column names must be unique")
    out = build.framed().withColumns(columns) if columns else build.framed()
    hidden = {x["name"] for f in spec if f["type"] == "union" for g in f["union_fields"] for x in g["fields"]}
    seen: dict[str, str] = {}
    for f in spec:
        if f["type"] == "eval":
            out = out.withColumn(f["name"], derive.expression(f["expression"], seen))
        if f["type"] != "union" and f["name"] not in hidden:
            seen[f["name"]] = dict(out.dtypes)[f["name"]]
    return out.select(*df.columns, *made)


def gen_table(spark: SparkSession, spec: list[dict] | str, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """An n-row table of ``spec``."""
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return with_generated(base.withColumnRenamed("id", "_row"), spec, "_row", seed).drop("_row")
