"""Spelling variants: vocabulary words at one inserted, deleted or replaced letter, by search schemes on FM-indexes.

1. Runs of letters are counted within tasks and then summed; a run that its hash picks loses a letter first.
2. If two words are one error apart, one half of either is found unchanged at that end of the other. So every word is
   indexed under the first and last halves it may have to answer for (two of each) and asks once for each of its own: in
   the block that its half is dealt to. A half that more words share than a block holds is dealt to blocks of its own,
   by word, and is asked in all of them: each block has a bounded number of words, whatever the vocabulary's size.
3. A block builds a bidirectional index of its delimited words, matches the exact half of all its queries at once and
   goes on across the other half with one error (see ``fm_index``). A pair comes out in one place only.
4. Forms are followed to their last by pointer jumping: each form is at least twice as frequent as the word before it,
   so a few rounds do. Every round is a table in the shared folder.

Null, empty and letterless texts have no words; a null id counts as empty text in the hash. Repeated rows count as often
as they come. Of near words with equal counts the first in code-point order is the form. Empty tables give no rows. Very
long texts are read a run at a time. Other columns aren't read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.llm import common, fm_index

#: A run of ASCII letters (the text is in small letters) and of those from U+00C0 to U+00FF, as UTF-8.
RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
MODULUS, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3
#: Different words that a task counts before it hands them on; runs of a text that are counted at a time.
HELD, RUNS = 300_000, 1 << 20
#: Words in a block's index.
BLOCK_WORDS = 1 << 15


def words_of(raw: bytes, key: bytes, modulus: int = MODULUS, least: int = LEAST_LENGTH) -> Counter:
    """The counted words of a text, as UTF-8: runs of at least ``least`` letters, some of which have lost one. ``key`` is
    what the hash of a run begins with."""
    counts: Counter = Counter()
    runs = (m.group() for m in RUN.finditer(raw.lower())) if len(raw) > RUNS else iter(RUN.findall(raw.lower()))
    while part := list(islice(runs, RUNS)):
        counts.update(r for r in part if len(r) >= least)
    start, out = zlib.crc32(key), Counter()
    for run, n in counts.items():
        h = zlib.crc32(run, start)
        if not h % modulus:
            text = run.decode()
            at = h % len(text)
            run = (text[:at] + text[at + 1 :]).encode()
        if len(run) >= 2 * least or len(run.decode()) >= least:
            out[run] += n
    return out


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n of every word that comes often enough."""
    common.arrow_limits(df.sparkSession)

    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held]), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), common.raw_texts(batch.column(1)), strict=True):
                held.update(words_of(raw, f"{'' if name is None else name}:".encode()))
                if len(held) > HELD:
                    yield batch_of(held)
                    held = Counter()
        if held:
            yield batch_of(held)

    texts = df.where(F.col(f"`{text_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _half(length: Column, right: bool) -> Column:
    """How long the exact half of a query is: the first for a search to the right, else the last."""
    floor = F.shiftright(length, 1)
    return floor if right else length - floor


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, near and its n: every ordered pair of ``words`` (word, n) that are one error apart, once."""
    length = F.length("word")
    sides = []
    for right in (True, False):
        cut = (lambda k: F.substring(F.col("word"), F.lit(1), k)) if right else (lambda k: F.right(F.col("word"), k))
        lengths = F.array_distinct(F.array(*[_half(F.greatest(length + k, F.lit(1)), right) for k in (-1, 0, 1)]))
        held = words.withColumn("k", F.explode(lengths)).where(F.col("k") <= length).select("word", "n", F.lit(right).alias("right"), cut(F.col("k")).alias("half"))
        asked = words.select("word", "n", F.lit(right).alias("right"), cut(_half(length, right)).alias("half"))
        sides.append((held, asked))
    held, asked = (sides[0][k].unionByName(sides[1][k]) for k in (0, 1))
    total = 4 * words.count()
    spread = max(1, -(-2 * total // block_words))
    sizes = held.groupBy("right", "half").agg(F.count("*").alias("size")).where("size > 1")  # else the word itself
    sizes = common.materialise(sizes.withColumn("parts", F.when(F.col("size") > block_words // 2, F.ceil(2 * F.col("size") / block_words)).otherwise(0).cast("int")), "halves")
    block = F.when(F.col("parts") == 0, F.pmod(F.xxhash64("half"), F.lit(spread))).otherwise(F.xxhash64("half", "part").bitwiseOR(F.lit(1 << 62)))

    def dealt(rows: DataFrame, part: Column, query: bool) -> DataFrame:
        return rows.join(sizes, ["right", "half"]).withColumn("part", part).select("right", block.alias("block"), "word", "n", F.lit(query).alias("query"))

    index = dealt(held, F.when(F.col("parts") > 0, F.pmod(F.xxhash64("word"), F.col("parts"))).otherwise(0).cast("int"), False)
    queries = dealt(asked, F.explode(F.sequence(F.lit(0), F.greatest(F.col("parts") - 1, F.lit(0)))), True)

    def search(table: pa.Table) -> pa.Table:
        right = table.column("right")[0].as_py()
        split = {}
        for query in (False, True):
            own = table.filter(pa.compute.equal(table.column("query"), query))
            split[query] = dict(zip(own.column("word").to_pylist(), own.column("n").to_pylist(), strict=True))
        names, asks = list(split[False]), list(split[True])
        q, w = fm_index.one_error(fm_index.Index([x.encode("latin-1") for x in names]), [x.encode("latin-1") for x in asks], right) if names else ([], [])
        found = [(asks[i], names[j]) for i, j in zip(q, w, strict=True)]
        if not right:  # those that share the first half too come from the other search
            found = [(a, b) for a, b in found if not b.startswith(a[: len(a) // 2])]
        return pa.table({"word": pa.array([a for a, _ in found], pa.string()), "near": pa.array([b for _, b in found], pa.string()), "n": pa.array([split[False][b] for _, b in found], pa.int64())})

    return index.unionByName(queries).groupBy("right", "block").applyInArrow(search, "word string, near string, n long")


def last_forms(links: DataFrame) -> DataFrame:
    """word and root: where following ``links`` (word, form) from each word ends. Links have no cycle."""
    reached = common.materialise(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not reached.where("moved").isEmpty():
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reached.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        last, reached = reached, common.materialise(step, "roots")
        common.drop(last)
    return reached.select("word", "root")


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    words = common.materialise(vocabulary(df, id_col, text_col), "words")
    near = near_words(words, block_words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("top"))
    said = words.join(near, "word", "left").withColumn("most", -F.col("top.less"))
    better = F.col("most") >= 2 * F.col("n")
    out = common.materialise(said.select("word", F.when(better, F.col("top.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(better, F.col("most")).alias("form_n")), "variants")
    roots = last_forms(out.where(F.col("form").isNotNull()))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(common.documents(spark, sf_dir))
