"""HTTP sources and sinks as Python data sources, and the Kafka connector. One request stream per partition.

Paths, headers, parameters and status words are fixed values: those of the two databases' protocols.
"""

from __future__ import annotations

import base64
import datetime
import decimal
import json
import math
import re
import urllib.error
import urllib.parse
import urllib.request
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
    LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema

from tableforge import jsonin, results
from tableforge.jsonio import encode_json

CHUNK_ROWS = 10_000


def _request(url: str, body: bytes, headers: dict, method: str = "POST"):
    """The response of a request; any status but 200 raises with its body."""
    try:
        response = urllib.request.urlopen(urllib.request.Request(url, body, headers, method=method), timeout=600)
    except urllib.error.HTTPError as e:
        raise RuntimeError(f"HTTP {e.code}: {e.read().decode(errors='replace')}") from e
    if response.status != 200:
        raise RuntimeError(f"HTTP {response.status}: {response.read().decode(errors='replace')}")
    return response


def _basic(user: str, password: str) -> dict:
    return {"Authorization": "Basic " + base64.b64encode(f"{user}:{password}".encode()).decode()}


def arrow_stream_query(query: str) -> str:
    """The query with its output format; one that names a format is rejected, by its text alone."""
    query = query.strip().rstrip(";").strip()
    if not query or re.search(r" format ", query, re.I) or re.search(r" format$", query, re.I):
        raise ValueError("the query must not be empty or name a format")
    return f"{query} FORMAT ArrowStream"


# --- filters and splits ---


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal(value, dialect: str) -> str | None:
    """A value in the remote dialect; None for those whose comparison may differ there."""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int) or isinstance(value, float) and math.isfinite(value):
        return repr(value)
    if isinstance(value, str):
        return quoted(value)
    if isinstance(value, datetime.datetime):  # the other dialect's times depend on the server's zone
        return f"CAST({quoted(value.strftime('%Y-%m-%d %H:%M:%S.%f'))} AS DATETIME)" if dialect == "starrocks" and value.tzinfo is None else None
    if isinstance(value, datetime.date):
        return f"toDate32({quoted(value.isoformat())})" if dialect == "clickhouse" else f"CAST({quoted(value.isoformat())} AS DATE)"
    if isinstance(value, decimal.Decimal) and value.is_finite() and dialect == "starrocks":
        scale = max(0, -value.as_tuple().exponent)
        return f"CAST({quoted(format(value, 'f'))} AS DECIMAL({max(len(value.as_tuple().digits), scale + 1)}, {scale}))"
    return None


#: Functions of the two dialects, by what they test.
TESTS = {"clickhouse": ("startsWith({}, {})", "endsWith({}, {})", "position({}, {}) > 0"), "starrocks": ("starts_with({}, {})", "ends_with({}, {})", "instr({}, {}) > 0")}


def remote_filter(f: Filter, dialect: str) -> str | None:
    """One of Spark's filters in the remote dialect, or None where Spark has to apply it: paths into structs, values
    without a literal, and "greater" on floats, as NaN is greater than all in Spark and than none there."""
    if isinstance(f, Not):
        inner = remote_filter(f.child, dialect)
        return None if inner is None else f"NOT ({inner})"
    if len(f.attribute) != 1 or "`" in f.attribute[0]:
        return None
    name = f"`{f.attribute[0]}`"
    if isinstance(f, IsNull):
        return f"{name} IS NULL"
    if isinstance(f, IsNotNull):
        return f"{name} IS NOT NULL"
    if isinstance(f, In):
        values = [literal(v, dialect) for v in f.value if v is not None]
        return None if not values or None in values or len(values) < len(f.value) else f"{name} IN ({', '.join(values)})"
    if isinstance(f, EqualNullSafe) and f.value is None:
        return f"{name} IS NULL"
    if (value := literal(f.value, dialect)) is None:
        return None
    if isinstance(f, EqualNullSafe):
        return f"({name} IS NOT NULL AND {name} = {value})"
    for kind, sign in ((EqualTo, "="), (LessThan, "<"), (LessThanOrEqual, "<="), (GreaterThan, ">"), (GreaterThanOrEqual, ">=")):
        if isinstance(f, kind):
            return None if sign[0] == ">" and isinstance(f.value, float) else f"{name} {sign} {value}"
    for kind, test in zip((StringStartsWith, StringEndsWith, StringContains), TESTS[dialect], strict=True):
        if isinstance(f, kind):
            return test.format(name, value)
    return None


def range_predicates(column: str, lower: int, upper: int, parts: int) -> list[str]:
    """Predicates of ``parts`` ranges of a whole-number column that are disjoint and together all rows, nulls too."""
    cuts = sorted({lower + (upper - lower) * k // parts for k in range(1, parts)})
    if not cuts:
        return []
    name = f"`{column}`"
    between = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{name} < {cuts[0]} OR {name} IS NULL", *between, f"{name} >= {cuts[-1]}"]


@dataclass
class QueryPart(InputPartition):
    query: str


def selects(query: str) -> bool:
    """Whether a query can stand in parentheses."""
    return re.match(r"\s*(select|with)\b", query, re.I) is not None


def parts_of(options: dict, filters: list[str] = ()) -> list[QueryPart]:
    """A request for each predicate, with the filters; the query as it is where there is neither."""
    query = options["query"].strip().rstrip(";").strip()
    predicates = json.loads(options.get("predicates", "[]"))
    if not predicates and not filters:
        return [QueryPart(query)]
    wheres = [[f"({p})" if filters or " or " in p.lower() else p] for p in predicates] or [[]]
    return [QueryPart(f"SELECT * FROM ({query}) AS q WHERE {' AND '.join([*w, *filters])}") for w in wheres]


class PushedFilters:
    """What a reader sends along with its query. ``dialect`` is the class's."""

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            if not selects(self.options["query"]) or (text := remote_filter(f, self.dialect)) is None:
                yield f
            else:
                self.filters.append(text)


# --- sources ---


class ClickHouseSource(DataSource):
    """Options: url, database, query, user, password, predicates (JSON), push (true: filters are sent along)."""

    @classmethod
    def name(cls) -> str:
        return "tableforge_clickhouse"

    def schema(self):
        query = parts_of(dict(self.options) | {"predicates": "[]"})[0].query
        head = f"SELECT * FROM ({query}) AS q LIMIT 0" if selects(query) else query
        return from_arrow_schema(_widened(pa.ipc.open_stream(clickhouse_response(self.options, arrow_stream_query(head))).schema), prefer_timestamp_ntz=True)

    def reader(self, schema):
        return (PushingClickHouseReader if self.options.get("push") == "true" else ClickHouseReader)(self.options)


def clickhouse_response(o: dict, query: str):
    return _request(o["url"], query.encode(), {"X-ClickHouse-Database": o.get("database", "default"), **_basic(o.get("user", "default"), o.get("password", ""))})


def _widened(schema: pa.Schema) -> pa.Schema:
    return pa.schema([pa.field(f.name, jsonin.spark_side(f.type), True) for f in schema])


class ClickHouseReader(DataSourceReader):
    dialect = "clickhouse"

    def __init__(self, options: dict):
        self.options, self.filters = dict(options), []

    def partitions(self):
        return parts_of(self.options, self.filters)

    def read(self, partition):
        stream = pa.ipc.open_stream(clickhouse_response(self.options, arrow_stream_query(partition.query)))
        wide = _widened(stream.schema)
        for batch in stream:
            yield pa.RecordBatch.from_arrays([c.cast(f.type, safe=False) for c, f in zip(batch.columns, wide, strict=True)], schema=wide)


class PushingClickHouseReader(PushedFilters, ClickHouseReader):
    pass


def _scan(spark: SparkSession, source: type, push_filters: bool, **options) -> DataFrame:
    if push_filters:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(push=str(push_filters).lower(), **options).load()


def scan_clickhouse(spark: SparkSession, url: str, database: str, query: str, user: str = "default", password: str = "", predicates: list[str] | None = None, push_filters: bool = True) -> DataFrame:
    """Rows of a remote query with its schema; one task per predicate (disjoint, and together all rows; see
    ``range_predicates``). Filters on the frame go into the remote query (this turns the session's
    spark.sql.python.filterPushdown.enabled on); those that can't stay in Spark."""
    arrow_stream_query(query)
    return _scan(spark, ClickHouseSource, push_filters, url=url, database=database, query=query, user=user, password=password, predicates=json.dumps(predicates or []))


class StarRocksSource(DataSource):
    """Typed rows of the HTTP SQL endpoint. Options: url, catalog, database, query, user, password, predicates (JSON), push."""

    @classmethod
    def name(cls) -> str:
        return "tableforge_starrocks"

    def schema(self):
        query = parts_of(dict(self.options) | {"predicates": "[]"})[0].query
        reader = StarRocksReader(self.options)
        for line in reader.lines(f"SELECT * FROM ({query}) AS q LIMIT 0" if selects(query) else query):
            if line.startswith('{"meta"'):
                return from_arrow_schema(results.meta_schema(results.one_object(line)["meta"]), prefer_timestamp_ntz=True)
        raise ValueError("no meta line")

    def reader(self, schema):
        return (PushingStarRocksReader if self.options.get("push") == "true" else StarRocksReader)(self.options, schema)


class StarRocksReader(DataSourceReader):
    dialect = "starrocks"

    def __init__(self, options: dict, schema=None):
        self.options, self.columns, self.filters = dict(options), schema, []

    def partitions(self):
        return parts_of(self.options, self.filters)

    def lines(self, query: str):
        """The response's lines as they come; a failed status raises."""
        o = self.options
        url = f"{o['url'].rstrip('/')}/api/v1/catalogs/{o['catalog']}/databases/{o['database']}/sql"
        with _request(url, json.dumps({"query": query}).encode(), {"Content-Type": "application/json", **_basic(o["user"], o["password"])}) as response:
            for raw in response:
                line = raw.decode().strip()
                if line.startswith('{"status"'):
                    said = results.one_object(line)
                    if str(said.get("status")).upper() == "FAILED":
                        raise RuntimeError(said.get("msg") or "query failed")
                yield line

    def read(self, partition):
        """Batches of the data lines as they come. The task ends well only behind the last line, so a failure that comes
        late fails it, and Spark drops what it has read."""
        schema, held = None, []
        for line in self.lines(partition.query):
            if line.startswith('{"meta"'):
                schema = results.meta_schema(results.one_object(line)["meta"])
                found = from_arrow_schema(schema, prefer_timestamp_ntz=True)
                if found.simpleString() != self.columns.simpleString():
                    raise ValueError(f"columns differ: {found.simpleString()} and {self.columns.simpleString()}")
            elif line.startswith('{"data"'):
                if schema is None:
                    raise ValueError("no meta line")
                held.append(line)
                if len(held) == CHUNK_ROWS:
                    yield results.data_batch(held, schema)
                    held = []
        if schema is None:
            raise ValueError("no meta line")
        if held:
            yield results.data_batch(held, schema)


class PushingStarRocksReader(PushedFilters, StarRocksReader):
    pass


def scan_starrocks(spark: SparkSession, url: str, database: str, query: str, user: str = "root", password: str = "", catalog: str = "default_catalog", predicates: list[str] | None = None, push_filters: bool = True) -> DataFrame:
    """Typed rows of a remote query, decoded as its lines come; one request per predicate, and one without rows for the
    columns. Filters go along as in ``scan_clickhouse``."""
    return _scan(spark, StarRocksSource, push_filters, url=url, database=database, query=query, user=user, password=password, catalog=catalog, predicates=json.dumps(predicates or []))


# --- sinks ---


@dataclass
class Sent(WriterCommitMessage):
    rows: int


class HttpSink(DataSource):
    """Sends JSON texts (column value) in chunks, of tables and of streams. Options: kind, url, database, table, user,
    password, label."""

    @classmethod
    def name(cls) -> str:
        return "tableforge_http"

    def writer(self, schema, overwrite):
        return HttpWriter(self.options)

    def streamWriter(self, schema, overwrite):  # noqa: N802
        return HttpStreamWriter(self.options)


def send_all(options: dict, batches, label: str) -> int:
    """Send a task's rows in chunks, each with a label of its own; their number."""
    send = {"clickhouse": send_clickhouse, "starrocks": send_starrocks}[options["kind"]]
    chunk, sent, held = 0, 0, []
    for batch in batches:
        held += batch.column(0).to_pylist()
        while len(held) >= CHUNK_ROWS:
            send(options, held[:CHUNK_ROWS], f"{label}-{chunk}")
            sent, chunk, held = sent + CHUNK_ROWS, chunk + 1, held[CHUNK_ROWS:]
    if held:
        send(options, held, f"{label}-{chunk}")
    return sent + len(held)


class HttpWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.options = options

    def write(self, iterator):
        from pyspark import TaskContext

        return Sent(send_all(self.options, iterator, str(TaskContext.get().partitionId())))


class HttpStreamWriter(DataSourceStreamArrowWriter):
    """Labels hold the batch's number, which a restarted stream uses again: what it sends again is known by them."""

    def __init__(self, options):
        self.options = options

    def write(self, iterator):
        from pyspark import TaskContext

        task = TaskContext.get()
        return Sent(send_all(self.options, iterator, f"{task.getLocalProperty('streaming.sql.batchId')}-{task.partitionId()}"))

    def commit(self, messages, batchId):  # noqa: N803
        pass  # each chunk was loaded as a whole

    def abort(self, messages, batchId):  # noqa: N803
        pass  # the batch runs again with the same labels


def send_clickhouse(o: dict, rows: list[str], label: str) -> None:
    """One insert; with a label, the server drops a chunk whose token it has seen, as a task's second attempt sends."""
    token = {"insert_deduplication_token": f"{o['label']}-{label}"} if o.get("label") else {}
    url = f"{o['url'].rstrip('/')}/?{urllib.parse.urlencode({'query': f'INSERT INTO {o["table"]} FORMAT JSONEachRow', **token})}"
    _request(url, ("\n".join(rows) + "\n").encode(), {"Content-Type": "application/x-ndjson", "X-ClickHouse-Database": o["database"], **_basic(o["user"], o["password"])}).read()


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args):
        return None


def send_starrocks(o: dict, rows: list[str], label: str) -> dict:
    """One stream load; a redirect is followed once, with the body sent again. A label that exists already is a chunk
    that an earlier attempt of the task has loaded."""
    headers = {"Content-Type": "application/json", "Expect": "100-continue", "format": "json", "strip_outer_array": "true", "ignore_json_size": "true", "two_phase_commit": "false", **_basic(o["user"], o["password"])}
    if o.get("label"):
        headers["label"] = f"{o['label']}-{label}"
    url, body = f"{o['url'].rstrip('/')}/api/{o['database']}/{o['table']}/_stream_load", f"[{','.join(rows)}]".encode()
    opener = urllib.request.build_opener(_NoRedirect)
    for attempt in range(2):
        try:
            answer = json.loads(opener.open(urllib.request.Request(url, body, headers, method="PUT"), timeout=600).read())
            break
        except urllib.error.HTTPError as e:
            if e.code != 307 or attempt:
                raise RuntimeError(f"HTTP {e.code}: {e.read().decode(errors='replace')}") from e
            url = urllib.parse.urljoin(url, e.headers["Location"])
    known = answer.get("Status") == "Label Already Exists" and answer.get("ExistingJobStatus", "FINISHED") in ("FINISHED", "VISIBLE", "COMMITTED")
    if answer.get("Status") not in ("Success", "Publish Timeout") and not known:
        raise RuntimeError(f"load failed: {answer}")
    return answer


def _sink(df: DataFrame, datetime_format: str | None, **options: str) -> int:
    from pyspark.sql import Observation

    if not options["table"].strip():
        raise ValueError("the table's name is empty")
    df.sparkSession.dataSource.register(HttpSink)
    seen = Observation()
    df.select(encode_json(df, datetime_format).alias("value")).observe(seen, F.count("*").alias("n")).write.format(HttpSink.name()).options(**options).mode("append").save()
    return seen.get["n"]


def sink_clickhouse(df: DataFrame, url: str, database: str, table: str, user: str = "default", password: str = "", datetime_format: str | None = None, label: str = "") -> int:
    """Insert all rows; their number. With a label, a task's second attempt inserts nothing twice if its rows come in a
    fixed order. Run with spark.speculation off."""
    return _sink(df, datetime_format, kind="clickhouse", url=url, database=database, table=table, user=user, password=password, label=label)


def sink_starrocks(df: DataFrame, url: str, database: str, table: str, user: str = "root", password: str = "", datetime_format: str | None = None, label: str = "") -> int:
    """Load all rows; their number. With a label, a task's second attempt loads nothing twice if its rows come in a
    fixed order. Run with spark.speculation off."""
    return _sink(df, datetime_format, kind="starrocks", url=url, database=database, table=table, user=user, password=password, label=label)


def stream_sink(df: DataFrame, checkpoint: str, kind: str, url: str, database: str, table: str, user: str, password: str = "", datetime_format: str | None = None, label: str = "", trigger: dict | None = None):
    """Start a stream that loads all rows into a table (kind: clickhouse or starrocks); its query. With a label, a batch
    that runs again after a failure loads nothing twice if its rows come in a fixed order. The label is the stream's own:
    give another stream, or one with a new checkpoint, another."""
    if not table.strip() or kind not in ("clickhouse", "starrocks"):
        raise ValueError("the table's name is empty, or the kind is unknown")
    df.sparkSession.dataSource.register(HttpSink)
    rows = df.select(encode_json(df, datetime_format).alias("value"))
    options = {"kind": kind, "url": url, "database": database, "table": table, "user": user, "password": password, "label": label, "checkpointLocation": checkpoint}
    return rows.writeStream.format(HttpSink.name()).options(**options).trigger(**(trigger or {"availableNow": True})).start()


def kafka_messages(spark: SparkSession, brokers: str, topic: str, properties: dict | None = None, start_timestamp_ms: int | None = None, stream: bool = False, max_messages: int | None = None) -> DataFrame:
    """The Kafka source (its connector must be on the class path); max_messages bounds a stream's batches."""
    reader = (spark.readStream if stream else spark.read).format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topic).options(**{f"kafka.{k}": v for k, v in (properties or {}).items()})
    if start_timestamp_ms is not None:
        reader = reader.option("startingTimestamp", str(start_timestamp_ms))
    if stream and max_messages:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    return reader.load()


def write_kafka(messages: DataFrame, brokers: str, topic: str, properties: dict | None = None) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).options(**{f"kafka.{k}": v for k, v in (properties or {}).items()}).save()
