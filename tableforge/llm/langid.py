"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

Letters are lower-cased (A-Z), all else but bytes over 127 becomes a blank, and every run of 2, 3 and 4 bytes is hashed
into a bucket. A document is the mean of its buckets' embeddings; a linear layer and softmax give the language. The
model is trained by stochastic gradient descent in numpy on a bounded sample of labelled rows (SAMPLE per language, the
first by a hash of the id, and sampling.TOTAL_CHARS in all; whole documents and short pieces of them). One more class
stands for what isn't any learned language: the same pieces with their letters swapped by random tables, and runs of
random letters. A held-back part of the sample sets the temperature and, for each class of lengths, how likely the learned
languages must be together for a text to stay: what parts learned from strange pieces of such lengths best, but not so
much that more than one learned piece in 500 would go.

Null texts and texts without a letter are ``und`` with score 0 and rejected. Texts of any length are scored whole, a
bounded part at a time; equal texts have equal results. With no labelled row every document is ``und``. Repeated rows are
scored one by one; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableforge.llm import common, sampling

BUCKETS, SIZES, WIDTH = 8192, (2, 3, 4), 16
#: Bound of the training sample: documents per language, beside sampling.TOTAL_CHARS.
SAMPLE = 200
PIECES = (1, 2, 4, 8, 16, 40)
EPOCHS, RATE = 15, 2.0
#: Share of held-back pieces of learned languages that may be rejected, and the bytes where the classes of lengths part.
LOST, LENGTHS = 0.002, (16, 32, 64, 128, 256)
#: Log odds by which the confidence that is asked for stays below what the held-back pieces say: texts vary more than they.
MARGIN = 2.0
_LATIN = re.compile("[A-Za-z]")
_CLEAN = np.full(256, 32, np.uint8)
_CLEAN[97:123] = np.arange(97, 123)
_CLEAN[65:91] = np.arange(97, 123)
_CLEAN[128:] = np.arange(128, 256)


def has_letter(text: str) -> bool:
    """Whether a character is a letter of any script; digits, fractions and other numbers are none."""
    return bool(_LATIN.search(text)) or any(map(str.isalpha, text))


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each size, the buckets of the runs of bytes in each row, and where each row's begin. A row stands between
    blanks, so that its runs don't depend on its neighbours."""
    pad, n = max(SIZES), len(offsets) - 1
    starts = offsets + pad * np.arange(n + 1)
    text = np.full(starts[-1] + pad, 32, np.uint32)
    text[np.arange(len(data)) + np.repeat(pad * np.arange(n) + pad - 1, np.diff(offsets))] = _CLEAN[data]
    out = []
    for size in SIZES:
        h = np.full(starts[-1], size, np.uint32)
        for k in range(size):
            h = (h ^ text[k : k + len(h)]) * np.uint32(0x01000193)
        out.append(((h ^ (h >> np.uint32(15))) % np.uint32(BUCKETS)).astype(np.int32))
    return out, starts


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # a row for each bucket: its embedding, under the linear layer if that makes it shorter
    linear: np.ndarray | None
    bias: np.ndarray  # the last class is that of no language
    sharpness: float = 1.0
    least: np.ndarray = field(default_factory=lambda: np.zeros(len(LENGTHS) + 1))  # by class of lengths

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) == 2 and len(data) > common.BLOCK_BYTES:
            total, n = self.long_sum(data)
        else:
            total, n = self.sums(*subwords(data, offsets))
        mean = total / n[:, None]
        return (mean if self.linear is None else mean @ self.linear) + self.bias

    def sums(self, buckets: list[np.ndarray], offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The summed rows of the table and how many they are."""
        total = np.zeros((len(offsets) - 1, self.table.shape[1]))
        for bucket in buckets:
            for k in range(self.table.shape[1]):
                total[:, k] += common.sums(self.table[:, k][bucket], offsets, np.float64)
        return total, np.diff(offsets) * len(SIZES)

    def long_sum(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``sums`` of one text, a part at a time; runs over the cuts come with the part before."""
        over, total, n = max(SIZES) - 1, np.zeros((1, self.table.shape[1])), np.zeros(1, np.int64)
        for lo in range(0, len(data), common.BLOCK_BYTES):
            part = data[max(0, lo - over) : lo + common.BLOCK_BYTES]
            buckets, _ = subwords(part, np.array([0, len(part)]))
            last = lo + common.BLOCK_BYTES >= len(data)
            # the part's runs that begin at its own bytes and, but for the last part, end in them too
            for k, (size, bucket) in enumerate(zip(SIZES, buckets, strict=True)):
                first = 0 if lo == 0 else over + max(SIZES) - size
                own = bucket[first : len(bucket) if last else len(bucket) - size]
                total[0] += [self.table[:, c][own].sum(dtype=np.float64) for c in range(self.table.shape[1])]
                n += len(own)
        return total, n

    def scored(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The likeliest language of each row, its probability, and whether the learned languages together, between which
        a mixed text may waver, are likely enough."""
        p = softmax(self.sharpness * self.logits(data, offsets))
        return p[:, :-1].argmax(1), p[:, :-1].max(1), 1 - p[:, -1] >= self.least[np.searchsorted(LENGTHS, np.diff(offsets), side="right")]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def bags(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The buckets of each text and their shares."""
    out = []
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        places, n = np.unique(np.concatenate(subwords(data, np.array([0, len(data)]))[0]), return_counts=True)
        out.append((places, (n / n.sum()).astype(np.float32)))
    return out


def strange(piece: bytes, rng: np.random.Generator) -> bytes:
    """A piece of no learned language: letters swapped by a random table, or random letters in words of the same lengths."""
    table = np.arange(256, dtype=np.uint8)
    table[97:123] = 97 + rng.permutation(26)
    table[128:] = 128 + rng.permutation(128)
    data = _CLEAN[np.frombuffer(piece, np.uint8)]
    if rng.random() < 0.25:
        data = np.where(data == 32, 32, rng.integers(97, 123, len(data))).astype(np.uint8)
    return table[data].tobytes()


def train(rows: list[tuple[int, str, str]], seed: int = 7) -> Model:
    """rows: (id, text, language). One in five, by order, is held back for the calibration."""
    languages = sorted({r[2] for r in rows})
    number, none = {x: k for k, x in enumerate(languages)}, len(languages)
    rng = np.random.default_rng(seed)
    texts: list[list[bytes]] = [[], []]
    target: list[list[int]] = [[], []]
    for i, (_, text, lang) in enumerate(sorted(rows, key=lambda r: (str(r[0]), r[1]))):
        if not has_letter(text):
            continue
        words = text.split()
        held = int(i % 5 == 4)
        for n in (len(words), *PIECES):
            at = int(rng.integers(0, max(1, len(words) - n + 1)))
            piece = " ".join(words[at : at + n])
            if has_letter(piece):
                raw = piece.encode("utf-8", "surrogatepass")
                texts[held].append(raw)
                target[held].append(number[lang])
                if held or rng.random() < 2 / (1 + none):
                    texts[held].append(strange(raw, rng))
                    target[held].append(none)
    if not texts[0]:
        return Model([], np.zeros((BUCKETS, 1)), None, np.zeros(1))
    x, y = bags(texts[0]), np.array(target[0])
    share = np.bincount(y, minlength=none + 1) / len(y)
    embedding = rng.normal(0, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    linear, bias = rng.normal(0, 0.5, (WIDTH, none + 1)).astype(np.float32), np.zeros(none + 1, np.float32)
    weight = (1 / np.maximum(share, 1e-9) / (none + 1))[y].astype(np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 64):
            some = order[lo : lo + 64]
            bag = np.zeros((len(some), BUCKETS), np.float32)
            for k, i in enumerate(some):
                bag[k, x[i][0]] = x[i][1]
            mean = bag @ embedding
            error = softmax(mean @ linear + bias)
            error[np.arange(len(some)), y[some]] -= 1
            error = (error * weight[some, None] / len(some)).astype(np.float32)
            embedding -= 40 * rate * (bag.T @ (error @ linear.T))
            linear -= rate * (mean.T @ error)
            bias -= 0.1 * rate * error.sum(0)
    short = none + 1 <= WIDTH
    model = Model(languages, embedding @ linear if short else embedding, None if short else linear, bias.astype(np.float64))
    if texts[1]:
        logits, y = model.logits(*common.text_bytes(pa.array(texts[1], pa.binary()))), np.array(target[1])
        grid = np.geomspace(0.05, 20, 60)
        loss = [-np.log(np.maximum(softmax(g * logits)[np.arange(len(y)), y], 1e-12)).mean() for g in grid]
        model.sharpness = float(grid[int(np.argmin(loss))])
        known = 1 - softmax(model.sharpness * logits)[:, -1]
        length = np.searchsorted(LENGTHS, [len(t) for t in texts[1]], side="right")
        for k in range(len(model.least)):
            some = length == k if ((length == k) & (y < none)).any() else length >= 0
            model.least[k] = threshold(known[some], y[some] < none)
    return model


def threshold(score: np.ndarray, known: np.ndarray) -> float:
    """The confidence that parts pieces of learned languages from strange ones best, within the bound on lost ones."""
    values = np.unique(score)
    kept = 1 - np.searchsorted(np.sort(score[known]), values) / max(1, known.sum())
    gone = np.searchsorted(np.sort(score[~known]), values) / max(1, (~known).sum())
    least = np.clip(min(float(values[int(np.argmax(kept + gone))]), float(np.quantile(score[known], LOST))), 1e-6, 1 - 1e-6)
    return float(1 / (1 + np.exp(MARGIN) * (1 - least) / least))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from ``sample`` rows per language of the rows given; passes over ids and languages alone come first."""
    known = df.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}
    if not counts:
        return Model([], np.zeros((BUCKETS, 1)), None, np.zeros(1))
    # a little over ``sample`` of each language by the hash, then the first ones of these
    share = F.element_at(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, (sample + 5 * sample**0.5 + 10) / n))]), F.col(lang_col))
    near = known.where(common.spread(id_col) < share).select(id_col, F.col(lang_col).alias("label"), common.spread(id_col).alias("rank")).collect()
    taken: dict[str, int] = {}
    chosen = []
    for r in sorted(near, key=lambda r: (r["rank"], str(r[0]), r["label"])):
        taken[r["label"]] = taken.get(r["label"], 0) + 1
        if taken[r["label"]] <= sample:
            chosen.append(tuple(r))
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, label string, rank double"
    return train(sampling.texts_of(known, df.sparkSession.createDataFrame(chosen, schema), id_col, text_col))


def identifier(model: Model, id_col: str = "doc_id"):
    """The step over Arrow batches (id, text) that ``identify`` takes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        letter = np.array([t is not None and has_letter(t) for t in texts])
        lang, score, sure = np.full(len(texts), "und", object), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if model.languages:
            for lo, hi, data, offsets in common.blocks(batch.column(1)):
                best, score[lo:hi], sure[lo:hi] = model.scored(data, offsets)
                lang[lo:hi] = np.array(model.languages, object)[best]
        lang[~letter] = "und"
        score[~letter] = 0.0
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(~sure | ~letter)], [id_col, "lang_pred", "score", "rejected"])

    return run


RESULT = "lang_pred string, score double, rejected boolean"


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, rejected of every document."""
    return common.map_arrow(df.select(id_col, text_col), identifier(model, id_col), f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, {RESULT}")


def keep_identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with their own columns."""
    prefix = common.unused(docs, "_lang_")
    return common.annotated(docs, [id_col, text_col], identifier(model), RESULT, prefix).where(f"NOT {prefix}rejected").select(docs.columns)


def learnable(id_col: str = "doc_id"):
    """Rows that the model may learn from."""
    return F.coalesce(common.fold(4, id_col) != 2, F.lit(False))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir, "doc_id", "text", "lang")
    out = identify(docs, fit(docs.where(learnable()))).withColumn("held_out", F.coalesce(common.fold(4) == 2, F.lit(False)))
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")
