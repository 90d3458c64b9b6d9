"""Document quality by a linear-chain conditional random field over lines.

Every line that holds a word gets surface features, and those of its two neighbours; the field labels lines good or bad.
It is trained in numpy on a bounded sample of labelled documents: first with each line labelled as its document, then,
in bad documents, with the lines that the first field finds rather bad. Forward-backward marginals, weighted by the
lines' lengths, aggregate into the good share of a document, which a logistic fit turns into a score.

Null, empty and blank texts have no line: their good share is 0. Long documents are scored whole, their lines' features
taken a bounded run of lines at a time; equal texts have equal scores. Without labels every score is 0.5. Repeated rows
are scored one by one; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableforge.llm import common, sampling

PER_CLASS, STEPS, RATE, RIDGE = 600, 150, 0.08, 1e-3
_KINDS = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "#*$%&<>", "|", "!?", ".,;:", "@/\\_=+~^`\"'()[]{}-"]


def _classes() -> np.ndarray:
    table = np.full(256, len(_KINDS), np.uint8)
    for k, chars in enumerate(_KINDS):
        table[list(chars.encode())] = k
    table[128:] = 1
    table[[32, 9, 10, 11, 12, 13]] = len(_KINDS) + 1
    return table


_CLASS = _classes()


def line_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each row's lines start, and the end."""
    if not len(data):
        return np.zeros(1, np.int64)
    return np.append(np.union1d(offsets[:-1][offsets[1:] > offsets[:-1]], np.flatnonzero(data[:-1] == 10) + 1), len(data))


def own_features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line with a word, its bytes and its start."""
    words, at = common.words_of(data, starts, lower=False)
    n_words = np.diff(at)
    keep = n_words > 0
    size = np.maximum(np.diff(starts), 1)
    kind = _CLASS[data]
    share = np.stack([common.sums(kind == k, starts) for k in range(len(_KINDS) + 1)], 1) / size[:, None]
    line = np.repeat(np.arange(len(n_words)), n_words)
    again = np.append(False, (words[1:] == words[:-1]) & (line[1:] == line[:-1])) if len(words) else np.zeros(0, bool)
    order = np.lexsort((words, line))
    copy = np.append(False, (words[order][1:] == words[order][:-1]) & (line[order][1:] == line[order][:-1])) if len(words) else np.zeros(0, bool)
    n = np.maximum(n_words, 1)
    own = np.column_stack([share, share[:, 0] / np.maximum(share[:, 0] + share[:, 1], 0.01), common.sums(again, at) / n, common.sums(copy, at) / n, np.log1p(n_words) / 4, np.log1p(size / n) / 4])[keep]
    return own, size[keep], starts[:-1][keep]


def neighbours(rows: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each line the row of the line before and of that behind within its document; zeros where there is none."""
    before, after = np.roll(rows, 1, 0), np.roll(rows, -1, 0)
    some = begins[1:] > begins[:-1]
    before[begins[:-1][some]] = 0
    after[begins[1:][some] - 1] = 0
    return before, after


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line with a word and of its neighbours, its bytes, and where each row's lines begin."""
    own, size, starts = own_features(data, line_starts(data, offsets))
    begins = np.searchsorted(np.searchsorted(offsets, starts, side="right") - 1, np.arange(len(offsets)))
    return np.column_stack([np.ones(len(own)), own, *neighbours(own, begins)]), size, begins


def line_runs(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Starts (and the end) of runs of whole lines of about BLOCK_BYTES each."""
    starts = line_starts(data, offsets)
    cuts = [0]
    while cuts[-1] < len(starts) - 1:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(starts, starts[cuts[-1]] + common.BLOCK_BYTES, side="right")) - 1))
    return [starts[a : b + 1] for a, b in zip(cuts, cuts[1:], strict=False)]


def forward_backward(scores: np.ndarray, moves: np.ndarray, begins: np.ndarray, pairs: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (line, state) and summed pair marginals (state, next state) of all rows; rows advance together."""
    counts = np.diff(begins)
    order = np.argsort(-counts, kind="stable")
    counts, first = counts[order], begins[:-1][order]
    longest = int(counts[0]) if len(counts) else 0
    active = [int(np.searchsorted(-counts, -t, side="left")) for t in range(longest + 1)]  # rows of more than t lines
    a, b = scores.copy(), np.zeros_like(scores)
    for t in range(1, longest):
        here = first[: active[t]] + t
        came = a[here - 1]
        a[here] += np.logaddexp(came[:, :1] + moves[0], came[:, 1:] + moves[1])
    for t in range(longest - 2, -1, -1):
        here = first[: active[t + 1]] + t
        goes = scores[here + 1] + b[here + 1]
        b[here] = np.logaddexp(moves[:, 0] + goes[:, :1], moves[:, 1] + goes[:, 1:])
    joint = a + b
    total = np.logaddexp(joint[:, 0], joint[:, 1])
    marginal = np.exp(joint - total[:, None])
    if not pairs:
        return marginal, np.zeros((2, 2))
    inner = np.ones(len(scores), bool)
    inner[first[counts > 0] + counts[counts > 0] - 1] = False
    i = np.flatnonzero(inner)
    pair = np.exp(a[i][:, :, None] + moves[None] + (scores[i + 1] + b[i + 1])[:, None, :] - total[i][:, None, None])
    return marginal, pair.sum(0)


@dataclass
class Field:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    logistic: tuple[float, float] = (0.0, 0.0)

    def emissions(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores (line, state) of each line with a word, its bytes, and where each row's lines begin. Sums go feature by
        feature, so that they don't depend on what else is in the block."""
        gain = self.weights / self.scale[:, None]
        level = gain[0] - (self.mean[:, None] * gain).sum(0)
        width = (len(gain) - 1) // 3
        parts, sizes, places = [np.zeros((0, 6))], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for starts in line_runs(data, offsets):
            own, size, place = own_features(data[starts[0] : starts[-1]], starts - starts[0])
            share = np.zeros((len(own), 6))  # what a line gives itself, the line behind and the line before
            for k in range(width):
                share += own[:, k : k + 1] * np.concatenate([gain[1 + k], gain[1 + width + k], gain[1 + 2 * width + k]])
            parts.append(share)
            sizes.append(size)
            places.append(place + starts[0])
        share, size, place = map(np.concatenate, (parts, sizes, places))
        begins = np.searchsorted(np.searchsorted(offsets, place, side="right") - 1, np.arange(len(offsets)))
        return level + share[:, :2] + neighbours(share[:, 2:4], begins)[0] + neighbours(share[:, 4:], begins)[1], size, begins

    def good_share(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        scores, size, begins = self.emissions(data, offsets)
        marginal, _ = forward_backward(scores, self.moves, begins, pairs=False)
        total = common.sums(size, begins)
        good = common.sums(size * marginal[:, 1], begins, np.float64)
        return np.divide(good, total, out=np.zeros(len(total)), where=total > 0)

    def score(self, share: np.ndarray) -> np.ndarray:
        a, b = self.logistic
        return 1 / (1 + np.exp(-np.clip(a * logit(share) + b, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 0.001, 0.999)
    return np.log(p / (1 - p))


def train_field(x: np.ndarray, begins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Field:
    """Maximum likelihood of line labels by Adam; ``weight`` of each line."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 0.05)
    mean[0], scale[0] = 0, 1
    z = (x - mean) / scale
    parts = [np.zeros((x.shape[1], 2)), np.zeros((2, 2))]
    one, two = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    inner = np.ones(len(y), bool)
    inner[begins[1:][begins[1:] > begins[:-1]] - 1] = False
    i = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[i], y[i + 1]), 1)
    truth = np.eye(2)[y]
    for step in range(1, STEPS + 1):
        marginal, pair = forward_backward(z @ parts[0], parts[1], begins)
        grads = [z.T @ ((truth - marginal) * weight[:, None]) / weight.sum() - RIDGE * parts[0], (seen - pair) / len(y) - RIDGE * parts[1]]
        for k, g in enumerate(grads):
            one[k] = 0.9 * one[k] + 0.1 * g
            two[k] = 0.99 * two[k] + 0.01 * g * g
            parts[k] = parts[k] + RATE * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.99**step)) + 1e-8)
    return Field(mean, scale, *parts)


def train(rows: list[tuple], class_counts: dict[int, int]) -> Field | None:
    """rows: (id, text, label)."""
    if len({r[2] for r in rows}) < 2:
        return None
    data, offsets = common.text_bytes(pa.array([r[1] for r in rows], pa.string()))
    label = np.array([r[2] for r in rows], np.int64)
    x, size, begins = line_features(data, offsets)
    y = np.repeat(label, np.diff(begins))
    field = train_field(x, begins, y, np.ones(len(y)))
    for _ in range(2):
        marginal, _ = forward_backward(((x - field.mean) / field.scale) @ field.weights, field.moves, begins)
        bad = (np.repeat(label, np.diff(begins)) == 0) & (marginal[:, 0] >= 0.6)
        y = np.where(bad, 0, 1)
        field = train_field(x, begins, y, np.ones(len(y)))
    share = logit(field.good_share(data, offsets))
    weight = np.array([class_counts[c] / max(1, int((label == c).sum())) for c in label])
    weight /= weight.mean()
    a, b = 1.0, 0.0
    design = np.column_stack([share, np.ones(len(share))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * share + b, -30, 30)))
        h = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag([0.1, 1e-3])
        a, b = np.array([a, b]) + np.clip(np.linalg.solve(h, design.T @ (weight * (label - p)) - [0.1 * a, 1e-3 * b]), -2, 2)
    field.logistic = (float(a), float(b))
    return field


def quality(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, predicted and good_share of every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        share = np.concatenate([field.good_share(data, offsets) for _, _, data, offsets in common.blocks(batch.column(1))]) if field else np.full(batch.num_rows, 0.5)
        value = field.score(share) if field else share
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(value), pa.array((value >= 0.5).astype(np.int32)), pa.array(share)], [id_col, "score", "predicted", "good_share"])

    kind = docs.schema[id_col].dataType.simpleString()
    return common.map_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, score double, predicted int, good_share double")


def op5_line_crf_quality(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    held_out = common.fold(3) == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)
    field = train(*sampling.labelled_sample(docs, labels, "quality", PER_CLASS))
    out = quality(docs, field).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return out.select("doc_id", "held_out", "score", "predicted", "good_share")
