"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableforge.llm import common

#: Characters that all texts of a sample may hold together (a longer document is scored whole all the same).
TOTAL_CHARS = 16_000_000


def within(sizes: list[tuple], total: int) -> list:
    """The keys of (key, size), in order, whose sizes fit into ``total`` together; one that doesn't fit is passed over."""
    kept = []
    for key, size in sizes:
        if size <= total:
            kept.append(key)
            total -= size
    return kept


def texts_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, total: int = TOTAL_CHARS) -> list[tuple]:
    """(id, text, label) of the ids in ``chosen`` (id, label, rank), in the order of their ranks and within ``total``
    characters; of several texts of one id the least counts. ``chosen`` must be small: it is broadcast."""
    rows = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(chosen), id_col)
    sizes = rows.groupBy(id_col).agg(F.max(F.length("text")).alias("n"), F.min("rank").alias("rank")).collect()
    fit = within([(r[0], r["n"]) for r in sorted(sizes, key=lambda r: (r["rank"], str(r[0])))], total)
    if not fit:
        return []
    wanted = docs.sparkSession.createDataFrame([(i,) for i in fit], docs.select(id_col).schema)
    found = rows.join(F.broadcast(wanted), id_col, "left_semi").groupBy(id_col).agg(F.min("text").alias("text"), F.min("label").alias("label")).collect()
    place = {i: k for k, i in enumerate(fit)}
    return sorted(((r[0], r["text"], r["label"]) for r in found), key=lambda r: place[r[0]])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[tuple], dict[int, int]]:
    """The ``per_class`` (id, text, label) of each class that come first by a hash of the id, and how many labels each
    class has. Labels that are null or whose id is null are left out; of several labels of one id the largest counts."""
    own = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label).cast("int").alias("label"))
    counts = {r[0]: r[1] for r in own.groupBy("label").count().collect()}
    if not counts:
        return [], {}
    ranked = own.select(id_col, "label", common.spread(id_col).alias("rank"))
    firsts = [ranked.where(F.col("label") == c).orderBy("rank", id_col).limit(per_class) for c in sorted(counts)]
    chosen = firsts[0]
    for more in firsts[1:]:
        chosen = chosen.unionByName(more)
    return texts_of(docs, docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema), id_col, text_col), counts


def isotonic(x, y, weight):
    """Knots (x, fitted) of the weighted non-decreasing fit of y on x, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for a, b, w in sorted(zip(x, y, weight, strict=True)):
        blocks.append([a, b * w, w, a])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1][1] += top[1]
            blocks[-1][2] += top[2]
            blocks[-1][3] = top[3]
    return [k for b in blocks for k in (b[0], b[3])], [b[1] / b[2] for b in blocks for _ in range(2)]
