"""MinHash near-duplicates: one-permutation sketches with optimal densification, banded buckets, star-shaped edges.

1. Every document becomes its set of 64-bit shingle hashes; equal sets are one node (so exact copies never meet).
2. One hash per shingle fills BINS bins with minima; an empty bin borrows from a non-empty one that a 2-universal
   sequence of its own index picks. BANDS bands of ROWS bins give the buckets.
3. In each bucket all nodes get one edge to its centre, the node that shares the most buckets overall: edges stay
   below nodes times bands however large a group is. Edges are confirmed on the full sets.
4. Buckets that still hold several components are compared in cells of bounded size: sketches first, then full sets.
   A cell gives one link per pair of components, never its pairs. No bucket is capped or skipped.
5. Components by min-label propagation with pointer jumping, each round a table in the shared folder.

Null, empty and wordless texts have no shingles and link with nothing (component: themselves). Repeated rows and
repeated ids are equal sets or separate nodes; a null id takes part, its own component_id is the smallest id that is
not null, and it is kept only if there is none. Empty tables give no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableforge.llm import common

WORDS, SIMILARITY = 5, 75
BANDS, ROWS = 36, 4
BINS = BANDS * ROWS
#: Least share of equal sketch bins for a comparison of full sets in a cell: far below 0.75, as shares of half-empty
#: sketches scatter more than those of independent bins.
SKETCH_LEAST = 0.5
#: Shingles in one side of a cell.
CELL_SHINGLES = 1 << 20
_U = np.uint64


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within it, and where each row's begin."""
    words, at = common.words_of(data, offsets)
    counts = np.diff(at)
    n = max(0, len(words) - WORDS + 1)
    value = np.zeros(n, _U)
    for k in range(WORDS):
        value *= _U(0xD6E8FEB86659FD93)
        value += words[k : k + n]
    value = common.mix(value)
    if len(counts) == 1 and n:  # one text, which may be a very long one
        value = np.unique(value)
        return value, np.array([0, len(value)])
    row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    inside = row[:n] == row[WORDS - 1 :]  # else the window begins in one text and ends in another
    rows, value = row[:n][inside], value[inside]
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    whole = np.zeros(len(short), _U)
    for k in range(WORDS - 1):
        has = counts[short] > k
        whole[has] = whole[has] * _U(0xA24BAED4963EE407) + words[at[short[has]] + k] + _U(k + 1)
    rows, value = np.concatenate([rows, short]), np.concatenate([value, common.mix(whole)])
    order = np.lexsort((value, rows))
    rows, value = rows[order], value[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (value[1:] != value[:-1])
    rows, value = rows[new], value[new]
    return value, np.searchsorted(rows, np.arange(len(counts) + 1))


def nodes(value: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """16 bytes that stand for each set; null for empty sets."""
    a, b = (common.sums(common.mix(value ^ _U(c)), offsets, _U) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
    return [k if n else None for k, n in zip(map(bytes, np.stack([a, b], 1).view(np.uint8)), np.diff(offsets), strict=True)]


def sketches(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Densified one-permutation MinHash of each (non-empty) row: BINS 64-bit numbers."""
    n = len(offsets) - 1
    empty = _U(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * BINS, empty)
    bins = ((value >> _U(32)) * _U(BINS) >> _U(32)).astype(np.int64)
    np.minimum.at(out, np.repeat(np.arange(n), np.diff(offsets)) * BINS + bins, common.mix(value))
    out = out.reshape(n, BINS)
    filled = out != empty
    row, bin_ = np.nonzero(~filled & filled.any(1)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        other = (common.mix((bin_ + BINS * attempt).astype(_U)) % _U(BINS)).astype(np.int64)
        hit = filled[row, other]
        out[row[hit], bin_[hit]] = out[row[hit], other[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band; the band's number is part of it."""
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), (len(sketch), BANDS)).copy()
    for k in range(ROWS):
        key = common.mix(key * _U(0x9FB21C651E98DF25) + sketch[:, k::ROWS])
    return key.view(np.int64)


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def sketched(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, node, keys (a bucket per band) and the sketch's low bytes of every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for _, _, data, offsets in common.blocks(batch.column(1)):
            value, at = shingles(data, offsets)
            sketch = sketches(value, at)
            parts.append((np.diff(at), nodes(value, at), band_keys(sketch), sketch.astype(np.uint8)))
        n, node, keys, low = (np.concatenate(x) if k != 1 else sum(x, []) for k, x in enumerate(zip(*parts, strict=True)))
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary()), _lists(keys.reshape(-1), np.arange(0, (len(n) + 1) * BANDS, BANDS)), pa.array(map(bytes, low), pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["id", "n_shingles", "node", "keys", "sketch"])

    kind = df.schema[id_col].dataType.simpleString()
    return common.map_arrow(df.select(id_col, text_col), run, f"id {kind}, n_shingles long, node binary, keys array<long>, sketch binary")


def full_sets(df: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes in ``wanted`` (id, node): their texts are read once more."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for _, _, data, offsets in common.blocks(batch.column(0)):
            value, at = shingles(data, offsets)
            parts.append((nodes(value, at), value, np.diff(at)))
        values, counts = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        return pa.RecordBatch.from_arrays([pa.array(sum((p[0] for p in parts), []), pa.binary()), _lists(values, np.append(0, np.cumsum(counts)))], ["node", "shingles"])

    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted.select(F.col("id").alias("_id")), F.col("id").eqNullSafe(F.col("_id")), "left_semi").select("text")
    found = common.map_arrow(texts, run, "node binary, shingles array<long>")
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def confirmed(edges: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The edges (a, b) whose full sets are similar enough."""
    one, two = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}"), F.size("shingles").alias(f"n{x}")) for x in "ab")
    # sizes alone rule out some pairs
    pairs = edges.join(one, "a").join(two, "b").where((100 * F.least("na", "nb") >= similarity * F.greatest("na", "nb")))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.where(100 * both >= similarity * (F.col("na") + F.col("nb") - both)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge; label is the least node of its component."""
    both = common.materialise(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = common.materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"), F.lit(True).alias("moved")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b").groupBy("a").agg(F.min("l").alias("l"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "l").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("top"))
        last, labels = labels, common.materialise(step.join(up, "low").select("node", F.least("low", "top").alias("label"), (F.least("low", "top") != F.col("label")).alias("moved")), "labels")
        common.drop(last)
        if labels.where("moved").isEmpty():
            common.drop(both)
            return labels


def links_within(cell: pa.RecordBatch, similarity: int) -> list[tuple[bytes, bytes]]:
    """Links between components of one cell that aren't joined yet: at most one per pair of components met."""
    names: dict[bytes, int] = {}
    comp = np.array([names.setdefault(c, len(names)) for c in cell.column("label").to_pylist()])
    side, n, node = cell.column("side").to_numpy(), len(comp), cell.column("node").to_pylist()
    sketch = np.frombuffer(b"".join(cell.column("sketch").to_pylist()), np.uint8).reshape(n, BINS)
    keys = cell.column("keys").flatten().to_numpy().reshape(n, BANDS)
    flat, sizes = cell.column("shingles").flatten().to_numpy().view(_U), cell.column("shingles").value_lengths().to_numpy()
    ends = np.append(0, np.cumsum(sizes))
    here = int(np.flatnonzero(keys[0] == cell.column("key")[0].as_py())[0])
    first, other, links = np.flatnonzero(side == side.min()), side == side.max(), []
    for i in first:
        at = np.flatnonzero(other & (comp != comp[i]) & (100 * np.minimum(sizes, sizes[i]) >= similarity * np.maximum(sizes, sizes[i])))
        at = at[(sketch[at] == sketch[i]).mean(1) >= SKETCH_LEAST]
        at = at[~(keys[at, :here] == keys[i, :here]).any(1)]  # else an earlier band's bucket compares them
        mine = flat[ends[i] : ends[i + 1]]
        for j in at.tolist():
            if comp[i] != comp[j]:
                theirs = flat[ends[j] : ends[j + 1]]
                place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                both = int((mine[place] == theirs).sum())
                if 100 * both >= similarity * (len(mine) + len(theirs) - both):
                    links.append((node[i], node[j]))
                    comp[comp == comp[j]] = comp[i]
    return links


def cell_links(cells: DataFrame, similarity: int) -> DataFrame:
    """``links_within`` every cell. Rows of a cell lie together; one that goes over Arrow batches is put together."""

    def found(parts: list[pa.RecordBatch]) -> list[tuple[bytes, bytes]]:
        return links_within(parts[0] if len(parts) == 1 else pa.concat_batches(parts), similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        name = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")], 1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1).tolist(), len(ids)]
            links = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if waiting and (a or tuple(ids[a]) != name):
                    links += found(waiting)
                    waiting = []
                waiting.append(batch.slice(a, b - a))
            name = tuple(ids[-1])
            yield _edges(links)
        if waiting:
            yield _edges(found(waiting))

    order = ["key", "i", "j"]
    return cells.repartition(*order).sortWithinPartitions(*order, "node").mapInArrow(run, "a binary, b binary")


def _edges(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["a", "b"])


def near_duplicates(df: DataFrame, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, kept of every document."""
    all_ = common.materialise(sketched(df, id_col, text_col), "sketches")
    rows = all_.where(F.col("node").isNotNull())
    kinds = common.materialise(rows.groupBy("node").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")), "nodes")
    bucket = kinds.select("node", "n", F.explode("keys").alias("key"))
    shared = bucket.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = common.materialise(bucket.join(shared, "key"), "members")
    centre = members.groupBy("node").agg(F.sum("size").alias("central"))
    leaders = members.join(centre, "node").groupBy("key").agg(F.max(F.struct("central", "node")).alias("top")).select("key", F.col("top.node").alias("b"))
    edges = members.join(leaders, "key").where("node != b").select(F.col("node").alias("a"), "b").distinct()
    involved = kinds.join(members.select("node").distinct(), "node", "left_semi")
    sets = common.materialise(full_sets(df, id_col, text_col, involved), "sets")
    labels = components(confirmed(edges, sets, similarity))

    # buckets that still hold several components, in cells of bounded size; a pair alone was the star's own edge
    labelled = members.where("size > 2").select("key", "node", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.sum("n").alias("weight")).where("lo < hi").select("key", F.ceil(F.col("weight") / CELL_SHINGLES).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    cells = labelled.join(open_, "key").withColumn("part", part).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    cells = cells.select("key", "node", "label", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), (F.col("part") > F.col("other")).cast("int").alias("side"))
    cells = cells.join(sets, "node").join(kinds.select("node", "keys", "sketch"), "node")
    first = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    more = components(first.unionByName(cell_links(cells, similarity)))
    common.drop(members, sets, labels)
    labels = more

    least = kinds.join(labels.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    tops = least.groupBy("label").agg(F.min("id").alias("component_id"))
    found = least.select("node", "label").join(tops, "label").select("node", "component_id")
    out = rows.select("id", "n_shingles", "node").join(found, "node").select("id", "n_shingles", "component_id")
    out = out.unionByName(all_.where(F.col("node").isNull()).select("id", "n_shingles", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per group of near duplicates, that with the smallest id. A row's key is its id and its place in
    its Parquet file, which stays the same however many executors a later pass finds; other frames are written first."""
    own = common.unused(docs, "_key")
    try:
        place = docs.metadataColumn("_metadata")
        keyed = docs.withColumn(own, F.struct(F.col(id_col).alias("id"), F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("row")))
    except AnalysisException:  # no Parquet files behind it
        return keep_one_each(common.materialise(docs, "documents"), id_col, text_col)
    gone = near_duplicates(keyed.select(own, text_col), id_col=own, text_col=text_col).where(~F.col("kept")).select(own)
    return keyed.join(gone, own, "left_anti").select(docs.columns)


def op8_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir))
