"""Golden values, rejected input and invariance of the table operators."""

import datetime
import decimal
import json
import re
import struct
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualNullSafe, EqualTo, In, LessThan, Not

from tableforge import connect, derive, gen, grouped, hll, jsonin, jsonio, messages, offsets, ordinal, results, sqlfunctions, tdigest


def test_ndjson_and_array(spark, tmp_path):
    df = spark.createDataFrame([(7, "Zoë \"Z\""), (-2, None), (7, "")], "no int, who string").coalesce(1)
    assert jsonio.write_ndjson(df, f"{tmp_path}/a") == 3
    assert sorted(r[0] for r in spark.read.text(f"{tmp_path}/a").collect()) == ['{"no":-2}', '{"no":7,"who":""}', '{"no":7,"who":"Zoë \\"Z\\""}']
    one = jsonio.json_arrays(df.withColumn("k", F.lit(1)), ["k"]).first().value
    assert json.loads(one) == [{"no": -2, "k": 1}, {"no": 7, "who": "", "k": 1}, {"no": 7, "who": 'Zoë "Z"', "k": 1}]
    at = spark.createDataFrame([(datetime.datetime(1969, 12, 31, 23, 5, 9), bytearray(b"\x0a\xff"))], "seen timestamp_ntz, raw binary")
    assert at.select(jsonio.encode_json(at)).first()[0] == '{"seen":"1969-12-31 23:05:09","raw":"0aff"}'
    with pytest.raises(ValueError):
        jsonio.timestamp_format("%Q")


LINES = [
    '{"connectionId":31}', '{"meta":[{"name":"shop","type":"varchar"},{"name":"open","type":"boolean"},{"name":"since","type":"date"},{"name":"seen","type":"datetime"},{"name":"stock","type":"bigint(20)"},{"name":"rent","type":"decimal64(12, 3)"},{"name":"mark","type":"double"}]}',
    '{"data":["Quay 4",false,"1999-12-31","2031-07-04 23:59:58",9007199254740993,78.9999,-0.5]}', '{"data":["",  "true","2000-2-29","2031-07-04 23:59:58.25","-12","-1.0005","1e3"]}', '{"data":[null,null]}', "", '{"statistics":{"scanRows":3}}', '{"status":"OK"}',
]


def test_result_lines(spark):
    frame = lambda lines: spark.createDataFrame([(x,) for x in lines], "line string")
    rows = {r.shop: r for r in results.decode_result_lines(frame(LINES)).collect()}
    one, two = rows["Quay 4"], rows[""]
    assert (one.open, one.since, one.seen, one.stock, str(one.rent), one.mark) == (False, datetime.date(1999, 12, 31), datetime.datetime(2031, 7, 4, 23, 59, 58), 2**53 + 1, "78.999", -0.5)
    assert (two.open, two.since, two.seen.microsecond, two.stock, str(two.rent), two.mark) == (True, datetime.date(2000, 2, 29), 250000, -12, "-1.000", 1000.0)
    assert set(rows[None]) == {None}
    lists = frame(['{"meta":[{"name":"days","type":"array<date>"},{"name":"sizes","type":"array<decimal(5, 1)>"}]}', '{"data":[["2024-05-06"],[1.25,"2.99"]]}', '{"data":[[],null]}'])
    assert sorted(((r.days, r.sizes and [str(x) for x in r.sizes]) for r in results.decode_result_lines(lists).collect()), key=str) == [([], None), ([datetime.date(2024, 5, 6)], ["1.2", "2.9"])]
    meta = '{"meta":[{"name":"a","type":"%s"}]}'
    for kind, value in (("int", "7.5"), ("boolean", "1"), ("decimal(9,2)", '"1e3"'), ("decimal(9,2)", '""'), ("date", '"2020"'), ("date", "20200101"), ("date", '"2020-01-01 "'), ("datetime", '"2020-01-01"'), ("datetime", "5"), ("array<date>", '["2020-01"]')):
        with pytest.raises(Exception, match="not a"):
            results.decode_result_lines(frame([meta % kind, '{"data":[%s]}' % value])).collect()
    for bad in (["{}"], [meta % "decimal"], ['{"status":"failed","msg":"no"}']):
        with pytest.raises((ValueError, RuntimeError)):
            results.decode_result_lines(frame(bad))


def test_every_head_of_many_parts_counts(spark):
    frame = lambda some: spark.createDataFrame([(x,) for x in some], "line string").coalesce(1)
    meta, status = '{"meta":[{"name":"a","type":"int"}]}', '{"status":"OK"}'
    parts = [meta, '{"data":[1]}', status] * 1200
    assert results.decode_result_lines(frame(parts)).agg(F.sum("a")).first()[0] == 1200
    assert results.decode_result_lines(frame([status] * 1500 + [meta.replace(":", " : "), meta, '{"data":[1]}'])).collect() == [(1,)]
    with pytest.raises(RuntimeError, match="late"):
        results.decode_result_lines(frame([*parts, '{"status":"FAILED","msg":"late"}']))
    with pytest.raises(ValueError, match="differ"):
        results.decode_result_lines(frame([*parts, meta.replace("int", "date")]))
    with pytest.raises(ValueError, match="not JSON"):
        results.decode_result_lines(frame([*parts, '{"status"']))


def test_messages(spark):
    log = spark.createDataFrame([(b'{"id":"7","name":3}\n{"id":8,"x":1}', 0, 5, datetime.datetime(2024, 1, 1)), (None, 0, 6, None), (b"{}", 1, 0, None)], "value binary, partition int, offset long, timestamp timestamp_ntz")
    rows = messages.decode_messages_json(log, [("id", " Int64 "), ("name", "string")], include_metadata=True).collect()
    assert sorted((r.id, r.name, r.kafka_offset, r.kafka_timestamp) for r in rows if r.id) == [(7, "3", 5, 1704067200000), (8, None, 5, 1704067200000)]
    assert len(rows) == 3
    wide = [b'{\n "id": 1,\n "name": "x}\\n{y"\n}\n\n{"id":2,\n"name":[{},\n{}]}\r\n', b'  {"id":3}']
    found = messages.decode_messages_json(spark.createDataFrame([(w,) for w in wide], "value binary"), [("id", "int64"), ("name", "string")])
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "x}\n{y"), (2, "[{},{}]"), (3, None)]
    raw = spark.createDataFrame([(b"a\xffb",), (None,)], "value binary")
    assert [r.value for r in messages.decode_messages_raw(raw).collect()] == ["a�b"]
    with pytest.raises(Exception):
        messages.decode_messages_json(spark.createDataFrame([(b"{bad",)], "value binary"), [("id", "int")]).collect()
    with pytest.raises(ValueError):
        messages.schema_from_hint([("a", "varchar")])
    text = spark.createDataFrame([("m1",), (None,)], "value string")
    assert sorted(bytes(r.value) for r in messages.encode_messages(text, "raw").collect()) == [b"", b"m1"]
    for bad in (text.withColumn("b", F.lit(1)), text.select(F.lit(1).alias("a"))):
        with pytest.raises(ValueError):
            messages.encode_messages_raw(bad)
    with pytest.raises(ValueError):
        messages.encode_messages(text, "csv")


def payloads(spark, *texts):
    return spark.createDataFrame([(t if isinstance(t, bytes) else t.encode(),) for t in texts], "value binary")


def test_every_object_of_a_payload_counts(spark):
    """Against a scan of the payload one character at a time."""

    def scanned(text):
        depth, inside, escaped, begin = 0, False, False, 0
        for i, c in enumerate(text):
            if inside:
                escaped, inside = c == "\\" and not escaped, escaped or c != '"'
            elif c == '"':
                inside = True
            elif c in "{[":
                begin, depth = (i if not depth else begin), depth + 1
            elif c in "}]":
                depth -= 1
                if not depth:
                    yield json.loads(text[begin : i + 1])

    rng = np.random.default_rng(4)
    parts = ['{"a":1}', '{"a":"2"}', '{ "a" : 3, "b": {"a": [{}, "}{"]} }', '{"b":"\\"}{\\\\", "a":4}', "{}", '{"a":5,"a":6}', '{"a":null,"c":[[1],{"a":9}]}']
    gaps = ["", " ", "\n", "\r\n\t", "\n\n"]
    texts = ["".join(rng.choice(gaps) + rng.choice(parts) for _ in range(rng.integers(0, 9))) + rng.choice(gaps) for _ in range(300)]
    found = messages.decode_messages_json(payloads(spark, *texts), [("a", "int64")])
    want = [None if o.get("a") is None else int(o["a"]) for t in texts for o in scanned(t)]
    assert sorted((r.a for r in found.collect()), key=str) == sorted(want, key=str)
    for bad in ('{"a":5} trailing', '{"a":1}{', '{"a":1},{"a":2}', "123", '"x"', "null", '[{"a":1}]', "{a:1}", '{"a":1}}', '{"a":NaN}', "\ufeff{}", b'{"a":"\xff"}'):
        with pytest.raises(Exception, match="JSON read failed|decode"):
            messages.decode_messages_json(payloads(spark, "{}", bad), [("a", "string")]).collect()


def test_nested_declared_types(spark):
    kind = pa.schema([("rows", pa.list_(pa.struct([("x", pa.uint16()), ("at", pa.timestamp("ms"))]))), ("by", pa.map_(pa.string(), pa.list_(pa.int32()))), ("cost", pa.decimal128(8, 2)), ("deep", pa.list_(pa.list_(pa.string())))])
    text = '{"rows":[{"x":7,"at":1500},null,{"y":1}],"by":{"k":[1,null],"l":null},"cost":-3.999,"deep":[["a",1.50,true],null,[]]}{"rows":null}{"rows":[]}'
    one, two, three = messages.decode_messages_json(payloads(spark, text), kind).collect()
    assert [r and tuple(r) for r in one.rows] == [(7, datetime.datetime(1970, 1, 1, 0, 0, 1, 500000)), None, (None, None)] and one.by == {"k": [1, None], "l": None}
    assert str(one.cost) == "-3.99" and one.deep == [["a", "1.50", "true"], None, []] and set(two) == {None} and three.rows == []
    declared = messages.decode_messages_json(payloads(spark, '{"p":{"q":[1,"2"]}}'), T.StructType.fromDDL("p struct<q: array<int>>"))
    assert declared.first().p.q == [1, 2]
    for bad in ('{"rows":{}}', '{"rows":[1]}', '{"rows":[{"x":70000}]}', '{"by":[]}', '{"by":{"k":1}}', '{"cost":1234567.5}', '{"deep":["a"]}', '{"cost":"x"}'):
        with pytest.raises(Exception, match="not a value of type"):
            messages.decode_messages_json(payloads(spark, bad), kind).collect()
    with pytest.raises(Exception, match="null in a"):
        messages.decode_messages_json(payloads(spark, "{}"), T.StructType.fromDDL("a int not null")).collect()
    with pytest.raises(ValueError, match="unsupported"):
        messages.decode_messages_json(payloads(spark, "{}"), pa.schema([("a", pa.duration("s"))]))


DAY, MOMENT = datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2, 3, 4, 5, 678000)
#: For each name of a hint: its Spark type, what is read and what it gives, and what doesn't fit.
HINTED = {
    **{n: ("boolean", [("true", True), ("false", False)], ["1", '"true"', "0.0"]) for n in ("bool", "boolean")},
    "int8": ("tinyint", [("-128", -128), ('"127"', 127)], ["128", '"x"', "true"]), "int16": ("smallint", [("32767", 32767)], ["-32769", '"7.5"']),
    **{n: ("int", [("2147483647", 2**31 - 1), ("2e1", 20), ("7.0", 7)], ["2147483648", '""', "[]"]) for n in ("int32", "int")}, **{n: ("bigint", [("-9223372036854775808", -(2**63)), ('"+5"', 5)], ["9223372036854775808", '" 1"']) for n in ("int64", "long")},
    "uint8": ("smallint", [("0", 0), ("255", 255)], ["300", "-1"]), "uint16": ("int", [("65535", 65535)], ["65536", "-1"]), **{n: ("bigint", [("4294967295", 2**32 - 1)], ["4294967296", "-1"]) for n in ("uint32", "uint")},
    **{n: ("decimal(20,0)", [("18446744073709551615", 2**64 - 1)], ["18446744073709551616", "-5"]) for n in ("uint64", "ulong")},
    **{n: ("float", [("1.5", 1.5), ('"-2"', -2.0), ("1e39", float("inf"))], ['"x"', "true"]) for n in ("float32", "float")}, **{n: ("double", [("1e300", 1e300), ("3", 3.0)], ['"1_0"', "false"]) for n in ("float64", "double")},
    **{n: ("string", [('"a"', "a"), ("1.50", "1.50"), ("true", "true"), ("1e3", "1e3")], ['"\\ud800"']) for n in ("utf8", "string", "large_utf8")}, "binary": ("binary", [('"0aff"', b"\n\xff"), ('""', b"")], ['"0g"', "12"]),
    "date32": ("date", [("19724", DAY), ('"2024-1-2"', DAY), ('"2024-01-02T03:04:05Z"', DAY)], ['"2024-13-01"', '"x"', "true"]), "date64": ("timestamp_ntz", [("1704164645678", MOMENT), ('"2024-01-02 03:04:05.678"', MOMENT)], ['"2024"']),
    **{n: ("timestamp_ntz", [("1704164645678000", MOMENT), ('"2024-01-02T05:04:05.678+02:00"', MOMENT)], ['"2024-01-02T25:00"', "true"]) for n in ("timestamp_us", "timestamp_microsecond")},
    **{n: ("timestamp_ntz", [("1704164645678", MOMENT), ('"2024-01-02T03:04:05.678999"', MOMENT)], ['"now"']) for n in ("timestamp_ms", "timestamp_millisecond")},
}


def test_every_hint_has_its_unit_and_range(spark):
    assert set(HINTED) == set(messages.HINTS)
    names = sorted(HINTED)
    schema = messages.schema_from_hint([(n, f" {n.upper()} ") for n in names])
    assert {f.name: f.dataType.simpleString() for f in schema} == {n: HINTED[n][0] for n in names}
    n_rows = max(len(HINTED[n][1]) for n in names)
    texts = ["{" + ",".join(f'"{n}":{HINTED[n][1][k % len(HINTED[n][1])][0]}' for n in names) + "}" for k in range(n_rows)]
    found = messages.decode_messages_json(payloads(spark, "\n".join(texts)), [(n, n) for n in names]).collect()
    for k, row in enumerate(found):
        for n in names:
            assert row[n] == HINTED[n][1][k % len(HINTED[n][1])][1], (n, k)
    for n in names:
        for bad in HINTED[n][2]:
            with pytest.raises(ValueError, match="not a value of type"):
                f = messages.arrow_hint([("a", n)]).field(0)
                jsonin.column([o["a"] for o in jsonin.objects_of(f'{{"a":{bad}}}', as_written=True)], f)


def test_streaming_is_batch(spark, tmp_path):
    """Decoders and encoders on a stream give what they give on a table."""
    path = f"{tmp_path}/in"
    made = spark.range(100).select(F.to_json(F.struct("id")).cast("binary").alias("value"), (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"), F.timestamp_seconds("id").alias("timestamp"))
    made.write.parquet(path)
    steps = {
        "json": lambda m: derive.derive_columns(messages.decode_messages_json(m, [("id", "long")], include_metadata=True), [("twice", "id * 2")]), "raw": lambda m: messages.decode_messages_raw(m, include_metadata=True), "meta": messages.message_metadata,
        "to_json": lambda m: messages.encode_messages_json(m.select("offset", "timestamp")), "to_raw": lambda m: messages.encode_messages_raw(m.select("value")), "lines": lambda m: m.select(jsonio.encode_json(m).alias("line")),
    }
    for name, step in steps.items():
        stream = step(spark.readStream.schema(made.schema).parquet(path))
        stream.writeStream.format("memory").queryName(f"stream_{name}").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/{name}").start().awaitTermination(120)
        assert sorted(map(str, spark.table(f"stream_{name}").collect())) == sorted(map(str, step(spark.read.parquet(path)).collect())), name


def test_one_array_per_group_of_any_size(spark, tmp_path):
    """Groups that lie over many Arrow batches, of equal rows too, are one array each; so are null and odd keys."""
    df = spark.range(60_000).select(F.when(F.col("id") < 50_000, F.lit("hot")).when(F.col("id") < 50_090, None).otherwise(F.concat(F.lit("k]\n["), F.col("id") % 9)).alias("k"), F.when(F.col("id") < 50_000, 7).otherwise(F.col("id")).alias("v"))
    assert jsonio.write_json_array(df, f"{tmp_path}/a", ["k"]) == 60_000
    arrays = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/a").collect()]
    sizes = {a[0].get("k"): len(a) for a in arrays}
    assert len(arrays) == len(sizes) == 11 and all(len({r.get("k") for r in a}) == 1 for a in arrays)
    assert sizes == {r.k: r["count"] for r in df.groupBy("k").count().collect()} and sizes["hot"] == 50_000
    assert sorted(r["v"] for a in arrays for r in a) == sorted(r.v for r in df.collect())
    assert jsonio.write_json_array(df.where("k = 'hot'"), f"{tmp_path}/a", ["k"]) == 50_000  # appends
    assert spark.read.text(f"{tmp_path}/a").count() == 12 and not [p for p in (tmp_path / "a").iterdir() if "_staging" in p.name]
    assert jsonio.write_json_array(df.limit(0), f"{tmp_path}/none", ["k"]) == 0
    assert jsonio.write_json_array(spark.range(5), f"file://{tmp_path}/all", []) == 5
    assert json.loads(spark.read.text(f"{tmp_path}/all").first()[0]) == [{"id": i} for i in range(5)]
    with pytest.raises(Exception):  # a task fails: nothing is left
        jsonio.write_json_array(df.withColumn("v", F.when(F.col("v") == 59_999, F.raise_error(F.lit("late"))).otherwise(F.col("v"))), f"{tmp_path}/bad", ["k"])
    assert not (tmp_path / "bad").exists() or not list((tmp_path / "bad").rglob("*.json"))
    assert jsonio.write_ndjson_groups(df, f"{tmp_path}/lines", ["k"]) == 60_000
    files = [p for p in (tmp_path / "lines").rglob("part-*")]
    assert len(files) == 11 and sorted(len(p.read_text().splitlines()) for p in files) == sorted(sizes.values())


def test_stored_log_answers_from_footers(spark, tmp_path):
    log = spark.range(1000).select(F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), (F.col("id") + 50).alias("offset"), F.col("id").cast("string").cast("binary").alias("value"), F.timestamp_seconds("id").alias("timestamp"))
    offsets.write_log(log, f"{tmp_path}/log")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    stored = offsets.stored_log(spark, f"{tmp_path}/log")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    found = offsets.topic_offsets(stored)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(offset), MAX(offset)]" in plan and "PushedGroupBy: [topic, partition]" in plan and "value" not in plan
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, offsets.topic_offsets(log).collect()))
    one = stored.where("partition = 1 AND offset > 900")
    assert one.count() == log.where("partition = 1 AND offset > 900").count() and re.search(r"partition#\d+ = 1", one._jdf.queryExecution().executedPlan().toString())


def test_prefix_sums(spark):
    df = spark.range(500).select((F.col("id") * 7).alias("i"), (F.col("id") % 3).alias("d"), (F.col("id") % 2).alias("g"))
    found = ordinal.with_prefix_sum(df.repartition(5), "i", F.col("d"), "before", block=4, by=("g",)).collect()
    rows, sums = sorted((r.i, r.d, r.g, r.before) for r in found), {0: 0, 1: 0}
    for _, d, g, before in rows:
        assert before == sums[g]
        sums[g] += d
    assert len(rows) == 500
    both = ordinal.with_prefix_sums(df, "i", {"a": F.col("d"), "b": F.lit(1)}, block=16).orderBy("i").collect()
    assert [r.b for r in both] == list(range(500)) and both[-1].a == sum(r.d for r in both[:-1])


def test_expressions(spark):
    top, wide = 2**31 - 1, 2**63 - 1
    df = spark.createDataFrame([(top, wide, -7, 2.0, 0.0)], "a int, b bigint, c int, d double, z double")
    one = lambda e: derive.derive_columns(df, [("x", e)]).first().x
    assert one("a + 1") == -(2**31) and one("b * b") == 1 and one("c / 2") == -3 and one("c % 3") == -1 and one("c * 1.5") == -7
    assert one("d / z") == float("inf") and one("-d + 0.5D") == -1.5 and one("(`c` + 1L) * 2") == -12 and one("-a") == -top
    for bad in ("1 + 2", "5", "a + b", "a < 3", "nope + 1", "'x' + a"):
        with pytest.raises((ValueError, SyntaxError)):
            one(bad)


def test_generators(spark):
    spec = json.dumps([
        {"name": "lane", "type": "int", "min": 2, "max": 7, "random": False}, {"name": "load", "type": "float", "min": -1, "max": 0}, {"name": "far", "type": "bigint", "min": 1 << 40, "max": (1 << 40) + 4, "random": False},
        {"name": "s", "type": "sequence", "null_rate": 0.3}, {"name": "marks", "type": "sequence", "array": True, "array_item_null_rate": 0.3, "null_rate": 0.2}, {"name": "r", "type": "string", "regex": r"\d{3}-\d{2}"},
        {"name": "u", "type": "union", "union_fields": [{"weight": 1, "fields": [{"name": "serial", "type": "sequence"}]}, {"weight": 3, "fields": [{"name": "word", "type": "string"}]}, {"weight": 1, "fields": [{"name": "on", "type": "boolean"}]}]}, {"name": "ip", "type": "ipv6", "array": True},
    ])
    frames = [gen.gen_table(spark, spec, 700, partitions=p).collect() for p in (1, 3, 8)]
    assert sorted(map(str, frames[0])) == sorted(map(str, frames[1])) == sorted(map(str, frames[2]))
    rows = sorted(frames[0], key=lambda r: str(r.s))
    assert sorted(r.s for r in rows if r.s is not None) == list(range(sum(r.s is not None for r in rows)))
    given = sorted(x for r in rows for x in r.marks or [] if x is not None)
    assert given == list(range(len(given))) and any(x is None for r in rows for x in r.marks or [])
    assert all([r.serial, r.word, r.on].count(None) == 2 for r in rows)
    serial = sorted(r.serial for r in rows if r.serial is not None)
    assert serial == list(range(len(serial))) and abs(len(serial) / 700 - 1 / 5) < 0.08
    assert all(2 <= r.lane < 7 and -1 <= r.load <= 0 and 0 <= r.far - (1 << 40) < 4 for r in rows)
    for bad in ([{"name": "a", "type": "int"}], [{"name": "a", "type": "x"}], [{"name": "a", "type": "sequence"}] * 2, [{"name": "a", "type": "string", "regex": "^a"}], [{"name": "a", "type": "ipv4", "start": "10.0.0.1", "end": "10.0.0.0"}]):
        with pytest.raises(ValueError):
            gen.gen_table(spark, bad, 3).collect()


@pytest.mark.parametrize("n", [0, 10, 100, 1000, 10_000, 100_000])
def test_hll_bytes(n):
    hashes = hll.murmur3_words(np.arange(n, dtype=np.uint64)).view(np.int64)
    idx, reg = hll.registers_of(hashes, 12, 6)
    full = np.zeros(4096, np.int64)
    np.maximum.at(full, idx, reg)
    raw = hll.to_bytes(np.flatnonzero(full), full[full > 0], hashes, 12, 6)
    _, i, r, h = hll.from_bytes(raw, 12, 6)
    assert hll.to_bytes(i, r, h, 12, 6) == raw and abs(hll.estimate(raw) - n) <= 0.05 * n


@pytest.mark.parametrize("n, below, log2m, regwidth", [(0, 5, 12, 6), (1, 5, 12, 6), (300, 1_000_000, 12, 6), (300, 200, 12, 6), (1000, 1_000_000, 12, 6), (1000, 400, 12, 6), (5000, 1_000_000, 12, 6), (50, 1000, 8, 4)])
def test_sketches_of_many_rows_at_once(monkeypatch, n, below, log2m, regwidth):
    """The bytes that rows would give one by one, though items are hashed by block."""
    seeds = pd.Series(np.random.default_rng(n).integers(-(1 << 63), (1 << 63) - 1, 100))
    want = []
    for seed in seeds.tolist():
        items = np.random.Generator(np.random.Philox(seed & (1 << 64) - 1)).integers(0, below, n)
        want.append(hll.Sketch.empty(log2m, regwidth).add(hll.murmur3_words(items.astype(np.uint64)).view(np.int64)).to_bytes())
    calls, plain = [], hll.murmur3_words
    monkeypatch.setattr(hll, "murmur3_words", lambda words: calls.append(len(words)) or plain(words))
    assert [raw for items in gen._blocks(seeds, n, below) for raw in gen._sketches(items, log2m, regwidth)] == want
    assert len(calls) <= 1 + 100 * n // (gen.ITEMS - n)


def test_hll_packing_and_hash():
    assert hll.bits(np.array([11 << 6 | 6, 1099 << 6 | 19]), 17).hex() == "016344b4c0"
    assert [int(x) for x in hll.murmur3([b"hello", b"The quick brown fox jumps over the lazy dog"])] == [0xCBD8A7B341BD9B02, 0xE34BBC7BBC071B6C]
    with pytest.raises(ValueError):
        hll.limits(12, 7)
    with pytest.raises(ValueError):
        hll.from_bytes(b"\x12", 12, 6)


def scalar_murmur3(data):
    """Low half of the 128-bit hash, by its definition, one item at a time."""
    top = (1 << 64) - 1
    rot = lambda x, r: (x << r | x >> 64 - r) & top
    c1, c2, a, b, n = 0x87C37B91114253D5, 0x4CF5AD432745937F, 0, 0, len(data)
    for at in range(0, n - 15, 16):
        x, y = (int.from_bytes(data[at + k : at + k + 8], "little") for k in (0, 8))
        a = (rot(a ^ rot(x * c1 & top, 31) * c2 & top, 27) + b) * 5 + 0x52DCE729 & top
        b = (rot(b ^ rot(y * c2 & top, 33) * c1 & top, 31) + a) * 5 + 0x38495AB5 & top
    rest = data[n // 16 * 16 :]
    a ^= rot(int.from_bytes(rest[:8], "little") * c1 & top, 31) * c2 & top
    b ^= rot(int.from_bytes(rest[8:], "little") * c2 & top, 33) * c1 & top
    a, b = a ^ n, b ^ n
    a = a + b & top
    b = b + a & top
    for _ in range(2):
        x = a
        for c in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ x >> 33) * c & top
        a, b = b, x ^ x >> 33
    a = a + b & top
    return a - (1 << 64) if a >> 63 else a


def test_hashes_by_type(spark):
    from tableforge.queries import HASHES

    assert all(scalar_murmur3(k.encode()) == v for k, v in HASHES.items())
    day, moment = datetime.date(2024, 2, 29), datetime.datetime(2024, 2, 29, 1, 2, 3, 4)
    micros = 1709168523000004
    cases = [
        ("byte", -3, (-3).to_bytes(4, "little", signed=True)), ("int", 7, (7).to_bytes(4, "little")), ("long", -(1 << 40), (-(1 << 40)).to_bytes(8, "little", signed=True)), ("double", 1.5, struct.pack("<d", 1.5)), ("double", -0.0, struct.pack("<d", 0.0)), ("float", 0.1, struct.pack("<f", 0.1)),
        ("decimal(10,3)", decimal.Decimal("-1.234"), (-1234).to_bytes(8, "little", signed=True)), ("decimal(30,3)", decimal.Decimal("-1.234"), (-1234).to_bytes(16, "little", signed=True)), ("date", day, (day - datetime.date(1970, 1, 1)).days.to_bytes(4, "little")), ("timestamp_ntz", moment, micros.to_bytes(8, "little")), ("timestamp", moment.replace(tzinfo=datetime.UTC), micros.to_bytes(8, "little")),
        ("boolean", True, b"\x01"), ("string", "Größe " * 9, ("Größe " * 9).encode()), ("binary", bytearray(b"\x00\xff"), b"\x00\xff"), ("string", "", b""),
    ]
    for kind, value, raw in cases:
        df = spark.createDataFrame([(value,), (None,)], f"v {kind}")
        assert [r[0] for r in df.select(hll.hll_hash(F.col("v"), True)).collect()] == [scalar_murmur3(raw), None], kind


def test_sketches_of_every_type_and_key(spark):
    df = spark.range(600).withColumn("k", F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 3)))
    columns = {
        "double": F.col("id") / 1000, "decimal": (F.col("id") / 1000).cast("decimal(10,3)"), "wide": (F.col("id") / 1000).cast("decimal(30,3)"), "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")), "ts": F.timestamp_seconds("id"),
        "text": F.col("id").cast("string"), "some": F.when(F.col("id") % 2 == 0, F.col("id").cast("int")), "flag": F.col("id") % 2 == 0,
    }
    df = df.withColumns(columns)
    for name in columns:
        exact = {r.k: r.n for r in df.groupBy("k").agg(F.countDistinct(name).alias("n")).collect()}
        assert exact == {r.k: hll.estimate(bytes(r.sketch)) for r in hll.hll_agg(df, ["k"], name).collect()} == {r.k: r.estimate for r in hll.hll_estimate(df, ["k"], name).collect()}, name
    whole = hll.hll_agg(df, [], "id").collect()
    assert len(whole) == 1 and abs(hll.estimate(bytes(whole[0].sketch)) - 600) < 30 and abs(hll.hll_estimate(df, [], "id").first().estimate - 600) < 30
    numbers = df.withColumn("n", F.when(F.col("id") % 3 > 0, F.col("id") % 3))
    for keys in (["k"], ["n"], ["k", "n"], []):
        digests = tdigest.tdigest_agg(numbers, keys, "id")
        assert sorted(r[0] for r in digests.select(tdigest.tdigest_stats(F.col("digest"))["count"]).collect()) == ([200] * 3 if keys else [600])
        assert tdigest.tdigest_agg(numbers.limit(0), keys, "id").count() == 0
    assert hll.hll_agg(df.limit(0), ["k"], "id").count() == 0
    none = spark.createDataFrame([(None,)], "digest binary").select(tdigest.tdigest_stats(F.col("digest")).alias("s")).first().s
    assert none["count"] is None and none["max_size"] is None
    with pytest.raises(ValueError):
        hll.hll_agg(df.withColumn("v", F.array("id")), ["k"], "v")


def test_sketch_functions_in_sql(spark):
    df = spark.range(300).withColumn("k", F.col("id") % 2)
    hll.register_functions(spark)
    tdigest.register_functions(spark)
    hll.hll_agg(df, ["k"], "id").join(tdigest.tdigest_agg(df, ["k"], "id"), "k").createOrReplaceTempView("sketches")
    one = spark.sql("SELECT hll_cardinality(hll_union(a.sketch, b.sketch)), hll_cardinality(hll_union(a.sketch, NULL)), tdigest_count(tdigest_merge(a.digest, b.digest)), tdigest_value_at(a.digest, 0.5D), hll_hash_of('hello'), hll_cardinality(NULL) FROM sketches a JOIN sketches b ON a.k = 0 AND b.k = 1").first()
    assert list(one) == [300, 150, 300, 149, scalar_murmur3(b"hello"), None]


def test_table_functions_in_sql(spark):
    sqlfunctions.register_table_functions(spark)
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("a b"), (F.col("id") % 2).cast("string").alias("c"), (F.col("id") % 900).alias("v"), F.when(F.col("id") % 5 > 0, F.col("id") / 7).alias("x"))
    df.createOrReplaceTempView("rows_of_table")
    for keys in (["a b"], ["a b", "c"], []):
        found = spark.sql(f"SELECT * FROM hll_sketch(TABLE(rows_of_table), '{', '.join(keys)}', 'v')")
        assert found.columns == [*keys, "sketch"]
        assert sorted(map(str, found.collect())) == sorted(map(str, hll.hll_agg(df, keys, "v").collect()))
        counts = spark.sql(f"SELECT tdigest_count(digest) AS n, tdigest_value_at(digest, 0.5D) AS m FROM tdigest_sketch(TABLE(rows_of_table), '{', '.join(keys)}', 'x')").collect()
        assert sum(r.n for r in counts) == 4800 and all(abs(r.m - 428) < 6 for r in counts)
    for bad in ("TABLE(rows_of_table), 'nope', 'v'", "TABLE(rows_of_table), 'c', 'nope'", "TABLE(SELECT array(id) AS v FROM range(3)), '', 'v'"):
        with pytest.raises(Exception, match="no such column|can't be counted"):
            spark.sql(f"SELECT * FROM hll_sketch({bad})").collect()
    sqlfunctions.register_generated(spark, "made_rows", '[{"name": "id", "type": "sequence"}, {"name": "side", "type": "string", "options": ["l", "r"], "random": false}]', 500)
    assert spark.sql("SELECT side, sum(id) FROM made_rows GROUP BY side ORDER BY side").collect() == [("l", 62250), ("r", 62500)]


def test_hll_large_groups(spark):
    df = spark.range(20_000).withColumn("k", F.col("id") % 2)
    halves = hll.hll_agg(df.withColumn("part", F.col("id") % 3), ["k", "part"], "id")
    whole = {r.k: bytes(r.sketch) for r in hll.hll_agg(df, ["k"], "id").collect()}
    assert {r.k: bytes(r.sketch) for r in hll.hll_union_agg(halves, ["k"]).collect()} == whole
    assert all(abs(r.estimate - 10_000) < 500 for r in hll.hll_estimate(df, ["k"], "id").collect())


@pytest.mark.parametrize("log2m, regwidth", [(12, 6), (8, 4), (10, 5)])
def test_hll_bytes_of_catalyst(spark, log2m, regwidth):
    """Every state against the same sketch built by numpy, from rows and as a union of parts."""
    sizes = {"a": 1, "b": 300, "c": 900, "d": 30_000, None: 2_000}
    df = spark.createDataFrame([(k, n) for k, n in sizes.items()], "k string, n int").select("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long"))).alias("v")).withColumn("part", (F.col("v") % 5).cast("int"))
    for portable in (True, False):
        hashes = {}
        for r in df.select("k", hll.hll_hash(F.col("v"), portable).alias("h")).collect():
            hashes.setdefault(r.k, []).append(r.h)
        want = {k: hll.Sketch.empty(log2m, regwidth).add(np.array(h)).to_bytes() for k, h in hashes.items()}
        made = hll.hll_agg(df, ["k"], "v", log2m, regwidth, portable)
        assert {r.k: bytes(r.sketch) for r in made.collect()} == want
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert ("Python" in plan or "Arrow" in plan) == portable
        parts = hll.hll_agg(df, ["k", "part"], "v", log2m, regwidth, portable)
        assert {r.k: bytes(r.sketch) for r in hll.hll_union_agg(parts, ["k"], "sketch", log2m, regwidth).collect()} == want
    empty = hll.header("empty", log2m, regwidth)
    frame = spark.createDataFrame([("x", empty), ("x", None), ("y", None), ("z", want["a"]), ("z", empty)], "k string, sketch binary")
    assert {r.k: bytes(r.sketch) for r in hll.hll_union_agg(frame, ["k"], "sketch", log2m, regwidth).collect()} == {"x": empty, "z": want["a"]}
    for bad in (b"\x11", empty[:1] + b"\x00\x7f", bytes([0x15]) + empty[1:], hll.header("full", log2m, regwidth) + b"\x00"):
        with pytest.raises(Exception, match="sketch"):
            hll.hll_union_agg(spark.createDataFrame([("x", bad)], "k string, sketch binary"), ["k"], "sketch", log2m, regwidth).collect()


def test_states_fan_in(spark):
    """A hot key's states, equal ones too, go to many groups; rounds go on until a task's share is small."""
    one = tdigest.to_bytes(tdigest.of_values(np.arange(100.0)))
    df = spark.range(4000, numPartitions=16).select(F.when(F.col("id") % 100 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), F.lit(one).alias("digest"))
    heavy = df.groupBy("k").agg(F.sum(F.octet_length("digest")).alias("_bytes"), F.count("*").alias("_n")).where("k = 'hot'")
    salts = grouped.dealt(df, heavy, ["k"], "digest", 100_000).groupBy("k", "_salt").count().collect()
    assert len([r for r in salts if r.k == "hot"]) > 8 and {r._salt for r in salts if r.k != "hot"} == {0}
    merged = {r.k: tdigest.from_bytes(bytes(r.digest)) for r in grouped.merged_states(df, ["k"], "digest", "digest", tdigest.merged_many, task_bytes=10_000).collect()}
    assert merged["hot"].count == 396_000 and sum(d.count for d in merged.values()) == 400_000 and merged["hot"].high == 99
    whole = grouped.merged_states(df, [], "digest", "digest", tdigest.merged_many, task_bytes=10_000).collect()
    assert len(whole) == 1 and tdigest.from_bytes(bytes(whole[0].digest)).count == 400_000
    # batches in a task: held states stay small, and a key goes on from one sorted batch to the next
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 2]), pa.array([one] * 3, pa.binary())], ["k", "d"])
    for run in (grouped.in_order, grouped.in_tasks):
        rows = [(r["k"], tdigest.from_bytes(r["d"]).count) for b in run(iter([batch, batch.slice(2), batch.slice(0, 0), batch.slice(2)]), tdigest.merged_many) for r in b.to_pylist()]
        assert sorted(rows) == [(1, 200), (2, 300)]


def test_tdigests_of_many_keys_at_once():
    rng = np.random.default_rng(6)
    code, values = rng.integers(0, 40, 5000), rng.normal(0, 10, 5000)
    made = tdigest.states_of_values(50)(code, 41, pa.array(values)).to_pylist()
    assert made == [tdigest.to_bytes(tdigest.of_values(values[code == k], 50)) for k in range(41)]
    again = tdigest.merged_many(np.arange(41) % 3, 3, pa.array(made, pa.binary())).to_pylist()
    for k, raw in enumerate(again):
        d, own = tdigest.from_bytes(raw), values[code % 3 == k]
        assert d.count == len(own) and (d.low, d.high) == (own.min(), own.max())
        assert all(abs((own <= tdigest.quantile(d, q)).mean() - q) < 0.02 for q in (0.01, 0.25, 0.5, 0.9, 0.99))


def test_tdigest():
    rng = np.random.default_rng(3)
    for values in (rng.uniform(0, 1e6, 10**6), np.concatenate([rng.uniform(0, 1e6, 600_000), np.full(400_000, 5e5)])):
        d = tdigest.of_values(values)
        assert all(abs(tdigest.quantile(d, q) / np.quantile(values, q) - 1) < 0.01 for q in (0.01, 0.5, 0.99))
    m = tdigest.merged([tdigest.of_values(np.arange(1.0, 1001)) for _ in range(100)])
    assert (tdigest.quantile(m, 0), tdigest.quantile(m, 1), m.count) == (1, 1000, 100_000) and abs(tdigest.quantile(m, 0.5) - 500) < 5
    raw = tdigest.to_bytes(m)
    assert tdigest.to_bytes(tdigest.from_bytes(raw)) == raw
    with pytest.raises(ValueError):
        tdigest.from_bytes(raw[:-9])
    assert tdigest.quantile(tdigest.Digest(), 0.5) is None and tdigest.quantile(tdigest.Digest(), 0.5, True) == 0.0


DEPOTS = pa.table({"code": pa.array([9000, 12, None], pa.uint32()), "opened": pa.array([datetime.date(1998, 5, 1), None, datetime.date(2011, 2, 3)]), "tons": [0.5, float("nan"), -3.0]})


@pytest.fixture
def server():
    """Two databases behind one port: it keeps what it was sent, and the labels that it has loaded."""
    seen, loaded = [], {}

    class Handler(BaseHTTPRequestHandler):
        def reply(self, code, body=b"", **headers):
            self.send_response(code)
            for k, v in headers.items():
                self.send_header(k, v)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def handle_any(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            seen.append((self.command, self.path, {k.lower(): v for k, v in self.headers.items()}, body))
            if self.command == "PUT":
                if not self.path.startswith("/moved"):
                    return self.reply(307, Location="/moved" + self.path)
                label = self.headers.get("label")
                if label in loaded:
                    return self.reply(200, b'{"Status":"Label Already Exists","ExistingJobStatus":"FINISHED"}')
                loaded[label or len(loaded)] = json.loads(body)
                return self.reply(200, b'{"Status":"Success"}')
            if "sql" in self.path:
                lines = [x for x in LINES if b"LIMIT 0" not in body or not x.startswith('{"data"')]
                return self.reply(200, "\n".join(lines + ['{"status":"FAILED","msg":"late"}'] * (b"late" in body and b"LIMIT 0" not in body)).encode())
            if b"INSERT" in body or "INSERT" in self.path:
                return self.reply(200)
            if b"boom" in body:
                return self.reply(500, b"no such table")
            sink, table = pa.BufferOutputStream(), DEPOTS.slice(0, 0 if b"LIMIT 0" in body else None)
            with pa.ipc.new_stream(sink, table.schema) as w:
                w.write_table(table)
            return self.reply(200, sink.getvalue().to_pybytes())

        do_POST = do_PUT = handle_any

        def log_message(self, *a):
            pass

    httpd = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}", seen, loaded
    httpd.shutdown()


def test_remote_scans(spark, server):
    url, seen, _ = server
    rows = connect.scan_clickhouse(spark, url, "db", "SELECT * FROM depots;", predicates=["code < 50", "code >= 50"]).collect()
    assert sorted(str(r.code) for r in rows) == ["12", "12", "9000", "9000", "None", "None"] and {r.opened for r in rows} == {datetime.date(1998, 5, 1), None, datetime.date(2011, 2, 3)}
    assert any(b"WHERE code >= 50 FORMAT ArrowStream" in body for _, _, _, body in seen)
    with pytest.raises(ValueError):
        connect.scan_clickhouse(spark, url, "db", "SELECT 1 format JSON")
    with pytest.raises(Exception, match="no such table"):
        connect.scan_clickhouse(spark, url, "db", "SELECT boom").collect()
    before = len(seen)
    scanned = connect.scan_starrocks(spark, url, "db", "SELECT 1")
    assert len(seen) == before + 1 and scanned.dtypes[:5] == [("shop", "string"), ("open", "boolean"), ("since", "date"), ("seen", "timestamp_ntz"), ("stock", "bigint")]
    assert sorted(map(str, scanned.collect())) == sorted(map(str, results.decode_result_lines(spark.createDataFrame([(x,) for x in LINES], "line string")).collect())) and len(seen) == before + 2
    with pytest.raises(Exception, match="late"):
        connect.scan_starrocks(spark, url, "db", "SELECT late").collect()


def test_filters_go_into_the_remote_query(spark, server):
    url, seen, _ = server
    depots = connect.scan_clickhouse(spark, url, "db", "SELECT * FROM depots")
    asked = lambda df: (df.collect(), seen[-1][3].decode())
    rows, text = asked(depots.where((F.col("code") > 100) & F.col("opened").isNotNull()).where("opened < DATE '2000-01-01'"))
    assert len(rows) == 3  # the stub filters nothing, and Spark left these filters to it
    assert "FROM (SELECT * FROM depots) AS q WHERE" in text and "`code` > 100" in text and "`opened` IS NOT NULL" in text and "`opened` < toDate32('2000-01-01')" in text
    rows, text = asked(depots.where("tons > 0.1D"))
    assert "> 0.1" not in text and sorted(r.code for r in rows) == [12, 9000]  # NaN is greatest in Spark: it filters
    rows, text = asked(connect.scan_clickhouse(spark, url, "db", "SELECT * FROM depots", push_filters=False).where("code > 100"))
    assert "WHERE" not in text and [r.code for r in rows] == [9000]
    shops = connect.scan_starrocks(spark, url, "db", "SELECT 1", predicates=["a = 1 OR b"])
    shops.where("shop = 'it''s \\\\ x' AND seen >= TIMESTAMP_NTZ '2031-01-01 00:00:00' AND stock IN (1, 2) AND shop LIKE 'Qu%' AND NOT (open <=> true)").collect()
    text = json.loads(seen[-1][3])["query"]
    assert text.startswith("SELECT * FROM (SELECT 1) AS q WHERE (a = 1 OR b) AND ") and "`shop` = 'it\\'s \\\\ x'" in text and "`seen` >= CAST('2031-01-01 00:00:00.000000' AS DATETIME)" in text
    assert "`stock` IN (1, 2)" in text and "starts_with(`shop`, 'Qu')" in text
    connect.scan_starrocks(spark, url, "db", "SHOW TABLES").where("stock = 1").collect()
    assert json.loads(seen[-1][3])["query"] == "SHOW TABLES"
    one, two = ("a",), ("s", "f")
    known = {EqualNullSafe(one, None): "`a` IS NULL", EqualNullSafe(one, 1): "(`a` IS NOT NULL AND `a` = 1)", Not(EqualTo(one, True)): "NOT (`a` = true)", In(one, (1, None)): None, EqualTo(two, 1): None, LessThan(one, 2.5): "`a` < 2.5", EqualTo(one, b"x"): None, EqualTo(one, float("nan")): None, EqualTo(one, decimal.Decimal("1.50")): "`a` = CAST('1.50' AS DECIMAL(3, 2))"}
    assert {f: connect.remote_filter(f, "starrocks") for f in known} == known
    cuts = connect.range_predicates("a", 0, 10, 3)
    assert cuts == ["`a` < 3 OR `a` IS NULL", "`a` >= 3 AND `a` < 6", "`a` >= 6"] and connect.range_predicates("a", 0, 10, 1) == []


def test_sinks(spark, server):
    url, seen, loaded = server
    df = spark.createDataFrame([(41, "Ürzig", 0.25), (-7, None, None)], "berth int, port string, depth double").coalesce(1)
    assert connect.sink_clickhouse(df, url, "db", "t") == 2 and seen[-1][3] == '{"berth":41,"port":"Ürzig","depth":0.25}\n{"berth":-7}\n'.encode()
    assert connect.sink_clickhouse(df, url, "db", "t", label="L") == 2 and "insert_deduplication_token=L-0-0" in seen[-1][1]
    assert connect.sink_starrocks(df, url, "db", "t", label="L") == 2
    assert seen[-1][1].startswith("/moved/api/db/t/_stream_load") and loaded["L-0-0"] == [{"berth": 41, "port": "Ürzig", "depth": 0.25}, {"berth": -7}]
    assert connect.sink_starrocks(df, url, "db", "t", label="L") == 2 and len(loaded) == 1  # known by its label
    with pytest.raises(ValueError):
        connect.sink_clickhouse(df, url, "db", " ")


def test_stream_sink_loads_nothing_twice(spark, server, tmp_path):
    url, seen, loaded = server
    spark.range(30).coalesce(1).write.parquet(f"{tmp_path}/in/a")
    start = lambda: connect.stream_sink(spark.readStream.schema("id long").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in"), f"{tmp_path}/c", "starrocks", url, "db", "t", "root", label="S")
    start().awaitTermination(120)
    assert sorted(r["id"] for rows in loaded.values() for r in rows) == list(range(30)) and all(k.startswith("S-0-") for k in loaded)
    (tmp_path / "c" / "commits" / "0").unlink()  # as if the stream had died before it noted the batch
    (tmp_path / "c" / "commits" / ".0.crc").unlink(missing_ok=True)
    before = len(seen)
    start().awaitTermination(120)
    assert len(seen) > before and sorted(r["id"] for rows in loaded.values() for r in rows) == list(range(30))
    spark.range(30, 40).coalesce(1).write.parquet(f"{tmp_path}/in/b")
    start().awaitTermination(120)
    assert sorted(r["id"] for rows in loaded.values() for r in rows) == list(range(40)) and any(k.startswith("S-1-") for k in loaded)
    with pytest.raises(ValueError):
        connect.stream_sink(spark.readStream.schema("id long").parquet(f"{tmp_path}/in"), "c", "other", url, "db", "t", "root")
