"""Toxicity by nearest labelled examples under exact TF-IDF cosine, found through a block-max inverted index.

A bounded sample of labelled documents gives the examples. All their terms are in the index; a term weighs its logarithmic
count times its inverse document frequency, counted over all documents, times its relevance in the sample (TF-RF:
log2(2 + toxic examples with it / clean ones), squared), so that what tells the classes apart decides who is near.
Examples are laid out in blocks of 64 by their heaviest term. The COMMON most frequent terms, whose long postings weigh
least, are kept by example, with the largest weight in each block; all others as postings. A query adds up the postings
of its rarer terms. The block maxima of its common terms then bound what the examples of a block can still gain, and
only examples that can reach its K-th best sum are completed, so its neighbours are exact. Similarity-weighted votes
are calibrated by isotonic regression on the votes of held-back folds, weighted to the labels' ratio.

Null text is empty. A text without any of the terms has no neighbours: its score is the rate of such examples. Equal
texts have equal scores; ties between neighbours go to the first example. Without labels every score is 0. Texts are
scored whole, long ones in chunks cut between words. Repeated rows are scored one by one; an empty table gives no
rows. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableforge.llm import common, sampling

#: Bound of the examples, beside sampling.TOTAL_CHARS.
PER_CLASS = 1500
BLOCK, NEIGHBOURS, COMMON, FOLDS = 64, 15, 128, 5
#: Queries that are scored together and the postings that they may read (one query may read more), and pairs of query
#: and example that are completed together. They bound memory, never results.
QUERIES, READ, PAIRS = 64, 1 << 21, 1 << 14
_TABLE = bytes(b + 32 if 65 <= b < 91 else b if 97 <= b < 123 or b >= 128 else 32 for b in range(256))
_SCALE, _IDS = 10**6, 1 << 20


def words_of(raw: bytes) -> Iterator[list[bytes]]:
    """Runs of letters and bytes over 127, A-Z in lower case; of a long text a bounded list at a time."""
    for part in common.chunks(raw.translate(_TABLE), b" "):
        yield part.split()


def term_counts(raws: list[bytes], number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the known terms in each text, sorted."""
    parts = [[np.fromiter(map(number.get, words, repeat(-1)), np.int32, len(words)) for words in words_of(raw)] for raw in raws]
    found = np.concatenate([np.zeros(0, np.int32), *(p for part in parts for p in part)])
    row = np.repeat(np.arange(len(raws)), [sum(map(len, part)) for part in parts])
    key, n = np.unique((row * len(number) + found)[found >= 0], return_counts=True)
    return key // max(1, len(number)), key % max(1, len(number)), n


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All places of the ranges [start, start + count), on end."""
    return np.repeat(starts - np.append(0, np.cumsum(counts))[:-1], counts) + np.arange(counts.sum())


@dataclass
class Index:
    ids: list[str]
    labels: np.ndarray
    number: dict[bytes, int]
    scale: np.ndarray  # by term: its weight at a count of one
    column: np.ndarray  # by term: its column if it is common, else -1
    columns: np.ndarray  # [example, column]: weight
    most: np.ndarray  # [column, block]: the largest of these
    postings: np.ndarray  # by term: where its (example, weight) begin
    example: np.ndarray
    weight: np.ndarray
    knots: tuple[list[float], list[float]] = ((0.0,), (0.0,))
    empty: float = 0.0

    def vectors(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, weight) of the unit TF-IDF vectors, sorted."""
        row, term, n = term_counts(raws, self.number)
        value = (1 + np.log(n)) * self.scale[term]
        size = np.sqrt(np.bincount(row, value * value, len(raws)))
        return row, term, value / np.where(size > 0, size, 1)[row]

    def nearest(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Similarity and number of the k nearest examples of n queries, exactly; similarities count in millionths."""
        wide, column = len(self.columns), self.column[term]
        rare = column < 0
        sizes = self.postings[term[rare] + 1] - self.postings[term[rare]]
        place = _spans(self.postings[term[rare]], sizes)
        sums = np.bincount(np.repeat(row[rare] * wide, sizes) + self.example[place], np.repeat(value[rare], sizes) * self.weight[place], n * wide).reshape(n, wide)
        least = np.partition(sums, wide - k, axis=1)[:, wide - k] if wide > k else np.zeros(n)
        own = np.zeros((n, self.columns.shape[1]))
        own[row[~rare], column[~rare]] = value[~rare]
        gain = own @ self.most
        query, example = np.nonzero((sums.reshape(n, -1, BLOCK) + gain[:, :, None]).reshape(n, wide) >= (least - 2 / _SCALE)[:, None])
        keys = np.full((n, max(wide, k)), -1, np.int64)  # similarity and, of equal ones, the first example
        for lo in range(0, len(query), PAIRS):
            q, e = query[lo : lo + PAIRS], example[lo : lo + PAIRS]
            near = np.rint((sums[q, e] + np.einsum("ij,ij->i", own[q], self.columns[e])) * _SCALE).astype(np.int64)
            keys[q, e] = np.where(near > 0, near * _IDS + (_IDS - 1 - e), -1)
        best = -np.sort(-np.partition(keys, keys.shape[1] - k, axis=1)[:, -k:], axis=1)
        found = best >= 0
        return np.where(found, best // _IDS, 0) / _SCALE, np.where(found, _IDS - 1 - best % _IDS, -1)

    def votes(self, similarity: np.ndarray, example: np.ndarray) -> np.ndarray:
        total = similarity.sum(1)
        return np.divide((similarity * self.labels[example] * (example >= 0)).sum(1), total, out=np.full(len(total), np.nan), where=total > 0)

    def search(self, raws: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
        """``nearest`` of any number of texts."""
        row, term, value = self.vectors(raws)
        ends = np.searchsorted(row, np.arange(len(raws) + 1))
        read = np.append(0, np.cumsum(self.postings[term + 1] - self.postings[term]))[ends]
        parts, hi = [], 0
        while hi < len(raws):
            lo, hi = hi, max(hi + 1, int(np.searchsorted(read[: hi + QUERIES + 1], read[hi] + READ, side="right")) - 1)
            some = slice(ends[lo], ends[hi])
            parts.append(self.nearest(row[some] - lo, term[some], value[some], hi - lo, k))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def score(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not len(self.number):
            return np.full(len(raws), self.empty), np.zeros((len(raws), 1)), np.full((len(raws), 1), -1)
        similarity, example = self.search(raws, NEIGHBOURS)
        vote = self.votes(similarity, example)
        return np.where(np.isnan(vote), self.empty, np.interp(vote, *self.knots)), similarity, example


def lay_out(index: Index, row: np.ndarray, term: np.ndarray, value: np.ndarray) -> None:
    """Fill the columns, block maxima and postings of ``index`` from its examples' vectors."""
    n_terms, wide = len(index.number), -(-len(index.labels) // BLOCK) * BLOCK
    held = np.bincount(term, minlength=n_terms)
    common_terms = np.sort(np.argsort(-held, kind="stable")[:COMMON])
    index.column = np.full(n_terms, -1)
    index.column[common_terms] = np.arange(len(common_terms))
    rare = index.column[term] < 0
    index.columns = np.zeros((wide, len(common_terms)))
    index.columns[row[~rare], index.column[term[~rare]]] = value[~rare]
    index.most = np.ascontiguousarray(index.columns.reshape(-1, BLOCK, len(common_terms)).max(1).T)
    row, term, value = row[rare], term[rare], value[rare]
    order = np.lexsort((row, term))
    index.example, index.weight = row[order].astype(np.int32), value[order]
    index.postings = np.searchsorted(term[order], np.arange(n_terms + 1))


def document_counts(docs: DataFrame, number: dict[bytes, int], text_col: str) -> tuple[int, np.ndarray]:
    """How many documents there are, and how many hold each term; one partial count a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(len(number), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for lo in range(0, batch.num_rows, 500):
                counts += np.bincount(term_counts(list(common.raw_texts(batch.column(0).slice(lo, 500))), number)[1], minlength=len(number))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], n))], ["term", "n"])

    common.arrow_limits(docs.sparkSession)
    counted = docs.select(text_col).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(number) + 1, np.int64)
    out[counted["term"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    return int(out[-1]), out[:-1]


def relevance(y: np.ndarray, row: np.ndarray, term: np.ndarray, n_terms: int) -> np.ndarray:
    """How telling each term is among examples with these labels: log2(2 + toxic / clean ones with it), squared."""
    toxic, clean = np.bincount(term, y[row] == 1, n_terms), np.bincount(term, y[row] != 1, n_terms)
    return np.log2(2 + toxic / np.maximum(1, clean)) ** 2


def filled(index: Index, raws: list[bytes], y: np.ndarray, ids: list[str]) -> np.ndarray:
    """Lay the examples that have terms out in ``index``, by their heaviest term; which of them have none."""
    row, term, value = index.vectors(raws)
    zero = np.bincount(row, minlength=len(y)) == 0
    heaviest = np.full(len(y), -1)
    order = np.lexsort((value, row))
    last = np.append(row[order][1:] != row[order][:-1], True)
    heaviest[row[order][last]] = term[order][last]
    some = np.flatnonzero(~zero)
    some = some[np.lexsort((some, heaviest[some]))]
    place = np.full(len(y), -1)
    place[some] = np.arange(len(some))
    index.ids, index.labels = [ids[i] for i in some], y[some]
    lay_out(index, place[row], term, value)
    return zero


def fit(docs: DataFrame, train: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Index:
    """An index of examples among ``train``; term statistics over all ``docs``. Votes are calibrated on FOLDS: each fold's
    examples are scored by the others, with weights in which their own labels don't count."""
    rows, class_counts = sampling.labelled_sample(train, labels, label, PER_CLASS, id_col, text_col)
    y, raws, ids = np.array([r[2] for r in rows], np.int64), [r[1].encode("utf-8", "surrogatepass") for r in rows], [str(r[0]) for r in rows]
    number = {t: k for k, t in enumerate(sorted({t for raw in raws for words in words_of(raw) for t in words}))}
    none = np.zeros(0, np.int64)
    empty = lambda: Index([], none, number, np.ones(len(number)), none, np.zeros((0, 0)), np.zeros((0, 0)), none, none, np.zeros(0))
    index = empty()
    if not number:
        index.empty = class_counts.get(1, 0) / max(1, sum(class_counts.values()))
        return index
    n, counts = document_counts(docs, number, text_col)
    rarity = np.log((1 + n) / (1 + np.minimum(counts, n)))
    row, term, _ = term_counts(raws, number)
    index.scale = rarity * relevance(y, row, term, len(number)) + 1e-3
    zero = filled(index, raws, y, ids)
    weight = np.array([class_counts[c] / max(1, int((y == c).sum())) for c in y])
    index.empty = float((weight * y)[zero].sum() / weight[zero].sum()) if zero.any() else float((weight * y).sum() / weight.sum())
    votes = np.full(len(y), np.nan)
    fold = np.array([zlib.crc32(raw) for raw in raws]) % FOLDS  # equal texts lie in one fold
    for k in np.unique(fold).tolist():
        out, others = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        within = np.isin(row, others)
        part = empty()
        part.scale = rarity * relevance(y, row[within], term[within], len(number)) + 1e-3
        if len(others):
            filled(part, [raws[i] for i in others], y[others], [ids[i] for i in others])
        if len(part.ids):
            votes[out] = part.votes(*part.search([raws[i] for i in out], NEIGHBOURS))
    ok = ~np.isnan(votes)
    vote, of = np.unique(votes[ok], return_inverse=True)  # equal votes have one rate
    total, toxic = np.bincount(of, weight[ok]), np.bincount(of, (weight * y)[ok])
    index.knots = sampling.isotonic(vote.tolist(), (toxic / total).tolist(), total.tolist()) if ok.any() else ((0.0,), (0.0,))
    return index


def scorer(index: Index, id_col: str = "doc_id"):
    """The step over Arrow batches (id, text) that ``score`` takes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, said = [], []
        for lo in range(0, batch.num_rows, 500):
            value, similarity, example = index.score(list(common.raw_texts(batch.column(1).slice(lo, 500))))
            values.append(value)
            said += [",".join(f"{index.ids[e]}:{s:.3f}:{index.labels[e]}" for s, e in zip(ss, ee, strict=True) if e >= 0) for ss, ee in zip(similarity[:, :3].tolist(), example[:, :3].tolist(), strict=True)]
        value = np.concatenate(values)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(value), pa.array((value >= 0.5).astype(np.int32)), pa.array(said, pa.string())], [id_col, "score", "predicted", "evidence"])

    return run


RESULT = "score double, predicted int, evidence string"


def score(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, predicted and evidence (the three nearest examples: id, similarity, label)."""
    return common.map_arrow(docs.select(id_col, text_col), scorer(index, id_col), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {RESULT}")


def keep_clean(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with their own columns."""
    prefix = common.unused(docs, "_toxic_")
    return common.annotated(docs, [id_col, text_col], scorer(index), RESULT, prefix).where(f"{prefix}predicted = 0").select(docs.columns)


def learnable(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Labels that the index may learn from."""
    return labels.where(common.fold(5, id_col) != 0)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    labels = learnable(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, fit(docs, docs, labels)).withColumn("held_out", F.coalesce(common.fold(5) == 0, F.lit(False)))
    return out.select("doc_id", "held_out", "score", "predicted", "evidence")
