"""N-gram Jaccard join by parity sketches: documents whose shingle sets are similar, as classes.

1. A document's set of shingle hashes is cut into P parts by the hashes' high bits; a part's word is the exclusive or of
   its shingles. A shingle in one set and not in the other changes one part's word at most, so the number of different
   words (their Hamming distance) bounds the symmetric difference from below. Sets of like size share a band: sizes in
   [2^k, 2^(k+1)) and those above whose partners may lie in it.
2. Sets that are similar enough differ by at most D shingles, so at least P - D words agree (pigeonhole). All documents
   rank words alike, by how many sets have them, and drop their own P - D - 1 most frequent: the rarest word that two
   similar sets share is kept by both. Sets with nothing left have no partner. Frequent passages therefore cost nothing.
3. Sets with a kept word in common are compared with the word's centre, a star, not with each other; words whose sets are
   still in several components go on to further stars and then to cells of bounded size, where all sets of different
   components are compared by bit sketches (one parity bit a shingle, folded to BITS times the set's size), whose Hamming
   distance bounds the difference likewise. Pairs that pass are verified on the full sets, in salted joins.
4. Components by min-label propagation (see ``dedup``), each round a table in the shared folder.

Words that a sample of the sets shows to be very frequent are dealt to several tasks; exact copies are one node and go
out once per task. Nothing is capped: a word of any number of sets is taken whole.

Null, empty and wordless texts have no shingles and link with nothing (component: themselves). Repeated rows and ids are
equal sets or separate nodes; a null id takes part, and its component's id is the smallest that isn't null. Empty tables
give no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableforge.llm import common, dedup

SIMILARITY = 80
#: Parts for each shingle that may differ, in percent, and the least number of parts.
SPARE, LEAST_PARTS = 120, 64
#: One set in SAMPLE shows which words are frequent: those of at least OFTEN sampled sets, one task for each SLICE sets.
SAMPLE, OFTEN, SLICE = 64, 16, 1 << 18
#: Bits of a sketch for each shingle of its band's largest set (a power of two, as a sketch is folded to that of a band below).
BITS = 4
#: Sets and bytes of sketches in one side of a cell.
CELL_SETS, CELL_BYTES = 2048, 1 << 24
#: Rounds of further stars, which are made while cells would have FEW_PAIRS comparisons or more (they cost a shuffle or two
#: each and find no more than cells do).
STARS, FEW_PAIRS = 3, 1 << 31
#: Node names that a task remembers, so as not to send a copy's words again.
REMEMBERED = 1 << 20
_U = np.uint64


def bands(n: np.ndarray, similarity: int) -> tuple[np.ndarray, ...]:
    """(row, band, parts, D) of each set in each band that it takes part in; sets that can't have a partner are left out.
    In its own band a set's partner may be larger or smaller, in the band below it is smaller."""
    row = np.flatnonzero(n > 0)
    own = np.frexp(n[row].astype(float))[1].astype(np.int64) - 1
    down = (own > 0) & (similarity * n[row] <= 100 * ((1 << own) - 1))
    rows, band = np.concatenate([row, row[down]]), np.concatenate([own, own[down] - 1])
    top = (2 << band) - 1  # the band's largest set
    size = n[rows]
    differ = np.where(size > top, np.minimum((size + top) * (100 - similarity) // (100 + similarity), top * (100 - similarity) // similarity), size * (100 - similarity) // similarity)
    most = top * (100 - similarity) // similarity
    parts = np.maximum(LEAST_PARTS, -(-SPARE * (most + 1) // 100))
    some = differ > 0
    return rows[some], band[some], parts[some], differ[some]


def words(value: np.ndarray, at: np.ndarray, similarity: int) -> tuple[np.ndarray, ...]:
    """Keys of all words that sets send, and of each run of them: its length, row, band and spare words (so many of the most
    frequent are dropped). The low five bits of a key are its band. Empty parts count as the most frequent words of all; a
    set that has more of them than it may drop sends the last ones."""
    n = np.diff(at)
    row, band, parts, differ = bands(n, similarity)
    if not len(row):
        none = np.zeros(0, np.int64)
        return np.zeros(0, _U), none, none, none, none
    size = n[row]
    ends = np.cumsum(size)
    job = np.repeat(np.arange(len(row)), size)
    v = value[np.arange(int(ends[-1])) - np.repeat(ends - size - at[row], size)]
    part = ((v >> _U(32)) * parts[job].astype(_U) >> _U(32)).astype(np.int64)
    first = np.flatnonzero(np.append(True, (job[1:] != job[:-1]) | (part[1:] != part[:-1])))
    key = np.bitwise_xor.reduceat(v, first)
    job_of, part_of = job[first], part[first]
    filled = np.bincount(job_of, minlength=len(row))
    spare = filled - differ - 1
    for j in np.flatnonzero(spare < 0).tolist():
        empty = np.setdiff1d(np.arange(parts[j]), part_of[job_of == j])[spare[j] :]
        key, job_of, part_of = np.concatenate([key, np.zeros(len(empty), _U)]), np.concatenate([job_of, np.full(len(empty), j)]), np.concatenate([part_of, empty])
    order = np.argsort(job_of, kind="stable")
    key, job_of, part_of = key[order], job_of[order], part_of[order]
    key = common.mix(common.mix(key) + part_of.astype(_U) * _U(0x9FB21C651E98DF25)) & ~_U(31) | band[job_of].astype(_U)
    return key, np.bincount(job_of, minlength=len(row)), row, band, np.maximum(spare, 0)


def fingerprints(value: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    """Two 64-bit numbers for each set: its name, and one that shows whether names clash."""
    sums = [common.mix(common.sums(common.mix(value ^ _U(c + seed)), at, _U) + np.diff(at).astype(_U)) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return np.stack(sums).view(np.int64)


def sets_of(batch_column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for lo, _, data, offsets in common.blocks(batch_column):
        yield lo, *dedup.shingles(data, offsets)


def named(df: DataFrame, id_col: str, text_col: str, similarity: int, seed: int) -> DataFrame:
    """id, n_shingles, node, proof, band, own and low (the spare words in the set's own band and in the one below) of every
    document, and the keys of every sampled set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for _, value, at in sets_of(batch.column(1)):
            key, sent, row, band, spare = words(value, at, similarity)
            size, (name, proof) = np.diff(at), fingerprints(value, at, seed)
            own = np.frexp(size.astype(float))[1] - 1
            both = np.zeros((len(size), 2), np.int32)
            both[row, (band < own[row]).astype(int)] = spare
            kept: list = [None] * len(size)
            for r, a, b in zip(row.tolist(), (np.cumsum(sent) - sent).tolist(), np.cumsum(sent).tolist(), strict=True):
                if not name[r] % SAMPLE:
                    kept[r] = [*(kept[r] or []), *key[a:b].view(np.int64).tolist()]
            parts.append((size, name, proof, own, both, kept))
        size, name, proof, own, both = (np.concatenate([p[k] for p in parts]) for k in range(5))
        columns = [batch.column(0), pa.array(size, pa.int64()), pa.array(name, mask=size == 0), pa.array(proof), pa.array(own.astype(np.int32)), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(sum((p[5] for p in parts), []), pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["id", "n_shingles", "node", "proof", "band", "own", "low", "sampled"])

    kind = df.schema[id_col].dataType.simpleString()
    return common.map_arrow(df.select(id_col, text_col), run, f"id {kind}, n_shingles long, node long, proof long, band int, own int, low int, sampled array<long>")


def sent_words(df: DataFrame, text_col: str, similarity: int, seed: int) -> DataFrame:
    """(key, node) of every word of every set; a task sends a set that it remembers only once."""
    common.arrow_limits(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, value, at in sets_of(batch.column(0)):
                key, sent, row, _, _ = words(value, at, similarity)
                name = fingerprints(value, at, seed)[0]
                fresh = np.zeros(len(name), bool)
                for r in np.unique(row).tolist():
                    if name[r] not in seen:
                        seen.add(int(name[r]))
                        fresh[r] = True
                owner = np.repeat(row, sent)
                own = fresh[owner]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)[own]), pa.array(name[owner[own]])], ["key", "node"])
            if len(seen) > REMEMBERED:
                seen = set()

    return df.where(F.col(text_col).isNotNull()).select(text_col).mapInArrow(run, "key long, node long")


def kept_words(keys: DataFrame, nodes: DataFrame, frequent: DataFrame) -> DataFrame:
    """(key, node, size, b): what each set keeps of the words that other sets have too, where at least one other set keeps
    it; how many do, and the one of them that shares most with others."""
    dealt = keys.join(frequent, "key", "left").withColumn("salt", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(0))
    own = dealt.repartition("key", "salt").dropDuplicates(["key", "salt", "node"])
    counted = own.withColumn("size", F.coalesce("often", F.count(F.lit(1)).over(Window.partitionBy("key", "salt"))))
    shared = counted.where("size > 1").select("key", "node", "size", F.col("key").bitwiseAND(F.lit(31)).cast("int").alias("level"))
    lists = shared.groupBy("node", "level").agg(F.sort_array(F.collect_list(F.struct("size", "key"))).alias("all"))  # a set's own words
    spare = F.when(F.col("level") == F.col("band"), F.col("own")).otherwise(F.col("low"))
    left = lists.join(nodes.select("node", "band", "own", "low"), "node").withColumn("left", F.size("all") - spare).where("left > 0")
    central = F.aggregate("all", F.lit(0).cast("long"), lambda total, x: total + x["size"]).alias("central")
    kept = common.materialise(left.select("node", central, F.explode(F.slice("all", F.lit(1), F.col("left"))).alias("x")).select("node", "central", "x.key"), "kept-words")
    held = kept.groupBy("key").agg(F.count("*").alias("size"), F.max(F.struct("central", "node")).alias("top")).where("size > 1")
    return kept.join(held, "key").select("key", "node", "size", F.col("top.node").alias("b"))


def bit_sketch(value: np.ndarray) -> np.ndarray:
    """A parity bit at each of the sketch's places, as 64-bit numbers: the low bits of a shingle's hash say which one it
    turns over. There are BITS places for each shingle of the largest set in the set's band."""
    places = max(64, BITS << len(value).bit_length())
    turned = np.bincount((value & _U(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(turned.astype(np.uint8)).view(np.int64)


def folded(sketch: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of 64-bit numbers) at a smaller width: parities add up."""
    while sketch.shape[-1] > width:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.append(0, np.cumsum(list(map(len, arrays)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)))


def wanted_sets(df: DataFrame, id_col: str, text_col: str, wanted: DataFrame, seed: int) -> DataFrame:
    """(node, n, sketch, shingles) of the nodes in ``wanted`` (id, node): their texts are read once more."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        want = batch.column(1).to_numpy()
        for lo, value, at in sets_of(batch.column(0)):
            rows = np.flatnonzero(fingerprints(value, at, seed)[0] == want[lo : lo + len(at) - 1])  # an id may have several texts
            own = [value[at[r] : at[r + 1]] for r in rows.tolist()]
            parts.append((want[lo + rows], own, [bit_sketch(v) for v in own]))
        sets, sketches = (sum((p[k] for p in parts), []) for k in (1, 2))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[0] for p in parts])), pa.array(list(map(len, sets)), pa.int64()), _lists(sketches), _lists(sets)], ["node", "n", "sketch", "shingles"])

    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted.select(F.col("id").alias("_id"), "node"), F.col("id").eqNullSafe(F.col("_id"))).select("text", "node")
    return common.map_arrow(texts, run, "node long, n long, sketch array<long>, shingles array<long>")


def most_apart(na: np.ndarray, nb: np.ndarray, similarity: int) -> np.ndarray:
    """The largest symmetric difference of similar enough sets of these sizes."""
    return (na + nb) * (100 - similarity) // (100 + similarity)


def beside(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """a, b and both sides' ``n`` and ``column``. The side that many pairs may share is joined first, while rows are small;
    its copies then lie apart by the other side."""
    one, two = (sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col(column).alias(f"x{x}")) for x in "ab")
    return pairs.join(two, "b").join(one, "a").select("a", "b", "na", "nb", "xa", "xb")


def _distance(x: Column, y: Column) -> Column:
    """The Hamming distance of two sketches; that of a larger set, from the next band, is folded to the other's width."""
    half = lambda c: F.zip_with(F.slice(c, 1, F.size(c) / 2), F.slice(c, F.size(c) / 2 + 1, F.size(c) / 2), lambda a, b: a.bitwiseXOR(b))
    one, two = F.when(F.size(x) > F.size(y), half(x)).otherwise(x), F.when(F.size(y) > F.size(x), half(y)).otherwise(y)
    return F.aggregate(F.zip_with(one, two, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, n: total + n)


def verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) that are similar enough: sizes and sketches rule out, full sets decide. The side that many pairs
    may share is joined first, while rows are small; its copies then lie apart by the other side."""
    one, two = (sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"k{x}"), F.col("shingles").alias(f"s{x}")) for x in "ab")
    total, both = F.col("na") + F.col("nb"), F.size(F.array_intersect("sa", "sb"))  # asked for once
    able = (100 * F.least("na", "nb") >= similarity * F.greatest("na", "nb")) & (_distance(F.col("ka"), F.col("kb")) * (100 + similarity) <= total * (100 - similarity))
    found = pairs.join(two, "b").join(one, "a").where(able).where((100 + similarity) * both >= similarity * total).select("a", "b")
    return common.materialise(found, "found")


def pairs_of(cell: pa.RecordBatch, similarity: int) -> pa.RecordBatch:
    """(a, b): pairs of a cell's sets in different components that their sketches don't rule out: those of its two parts, or
    of its only one."""
    side, n, node, label = (cell.column(c).to_numpy() for c in ("side", "n", "node", "label"))
    ends = np.append(0, np.cumsum(cell.column("sketch").value_lengths().to_numpy()))
    flat = cell.column("sketch").flatten().to_numpy().view(_U)  # bits are counted of numbers without a sign
    raw = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    width = min(map(len, raw))
    sketch = np.stack([folded(x, width) for x in raw])
    other, out = np.flatnonzero(side == side.max()), []
    for i in np.flatnonzero(side == side.min()).tolist():
        to = other[(label[other] != label[i]) & (100 * np.minimum(n[other], n[i]) >= similarity * np.maximum(n[other], n[i]))]
        if side[i] == side.max():
            to = to[to > i]
        to = to[np.bitwise_count(sketch[to] ^ sketch[i]).sum(1) <= most_apart(n[to], n[i], similarity)]
        out.append(np.stack([np.full(len(to), node[i]), node[to]], 1))
    pairs = np.concatenate([*out, np.zeros((0, 2), np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(pairs.min(1, initial=(1 << 63) - 1)), pa.array(pairs.max(1, initial=-(1 << 63)))], ["a", "b"])


def cell_pairs(cells: DataFrame, similarity: int) -> DataFrame:
    """``pairs_of`` every cell. A cell's rows lie together; one that goes over Arrow batches is put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        name = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")], 1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if waiting and (a or tuple(ids[a]) != name):
                    yield pairs_of(pa.concat_batches(waiting), similarity)
                    waiting = []
                waiting.append(batch.slice(a, b - a))
            name = tuple(ids[-1])
        if waiting:
            yield pairs_of(pa.concat_batches(waiting), similarity)

    order = ["key", "i", "j"]
    return cells.repartition(*order).sortWithinPartitions(*order, "node").mapInArrow(run, "a long, b long")


def linked(members: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """(node, label) of the sets that have a link: ``members`` (key, node, size, b) through stars, then cells."""
    stars = members.where("node != b").select(F.col("node").alias("a"), "b").distinct()
    labels = dedup.components(verified(stars, sets, similarity))
    for turn in range(STARS + 1):
        own = members.where("size > 2").select("key", "node").join(labels.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
        hub = F.max(F.struct(F.xxhash64("node", F.lit(turn)), "node", "label")).alias("hub")
        open_ = own.groupBy("key").agg(hub, F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).where("lo < hi")
        open_ = common.materialise(open_.select("key", "n", F.col("hub.node").alias("b"), F.col("hub.label").alias("at")), "open")
        pairs = open_.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0]
        if pairs is None:  # every word's sets are one component
            return labels
        last_turn = turn == STARS or pairs < FEW_PAIRS
        if not last_turn:
            more = own.join(open_, "key").where("label != at").select(F.col("node").alias("a"), "b").distinct()
        else:
            bytes_ = F.pow(F.lit(2.0), F.col("key").bitwiseAND(F.lit(31)) + 1) * BITS / 8
            cut = open_.select("key", F.ceil(F.greatest(F.col("n") / CELL_SETS, F.col("n") * bytes_ / CELL_BYTES)).cast("int").alias("parts"))
            cells = own.join(cut, "key").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
            cells = cells.select("key", "node", "label", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), (F.col("part") > F.col("other")).cast("int").alias("side"))
            more = cell_pairs(cells.join(sets.select("node", "n", "sketch"), "node"), similarity).distinct()
        found = verified(more, sets, similarity)
        common.drop(open_)
        if not found.isEmpty():
            last, labels = labels, dedup.components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(found))
            common.drop(last)
        if last_turn:
            break
    return labels


def similarity_classes(df: DataFrame, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles and component_id of every document; ``similarity`` in percent, over 50."""
    if not 50 < similarity <= 100:
        raise ValueError("similarity is over 50, up to 100")
    seed = 0
    while True:
        all_ = common.materialise(named(df, id_col, text_col, similarity, seed), "named")
        rows = all_.where(F.col("node").isNotNull())
        nodes = common.materialise(rows.groupBy("node").agg(F.min("id").alias("id"), *(F.min(c).alias(c) for c in ("n_shingles", "band", "own", "low")), (F.min("proof") != F.max("proof")).alias("clash")), "nodes")
        if nodes.where("clash").isEmpty():
            break
        seed += 1  # two sets of one name: other names for all
    sampled = rows.where(F.col("sampled").isNotNull()).select("node", F.explode("sampled").alias("key")).distinct()
    often = sampled.groupBy("key").agg((F.count("*") * SAMPLE).alias("often")).where(F.col("often") >= OFTEN * SAMPLE)
    frequent = common.materialise(often.withColumn("parts", F.ceil(F.col("often") / SLICE).cast("int")), "frequent")
    members = common.materialise(kept_words(sent_words(df, text_col, similarity, seed), nodes, frequent), "members")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("id", "node")
    sets = common.materialise(wanted_sets(df, id_col, text_col, wanted, seed), "sets")
    if sets.count() > wanted.count():  # repeated rows
        sets = common.materialise(sets.dropDuplicates(["node"]), "sets")
    labels = linked(members, sets, similarity)
    common.drop(members, sets)
    least = nodes.select("node", "id").join(labels.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    tops = least.groupBy("label").agg(F.min("id").alias("component_id"))
    found = least.select("node", "label").join(tops, "label").select("node", "component_id")
    out = rows.select("id", "n_shingles", "node").join(found, "node").select("id", "n_shingles", "component_id")
    out = out.unionByName(all_.where(F.col("node").isNull()).select("id", "n_shingles", F.col("id").alias("component_id")))
    return out.withColumnRenamed("id", id_col)


def op13_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(common.documents(spark, sf_dir))
