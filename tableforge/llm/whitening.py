"""Embedding whitening by Chebyshev-filtered subspace iteration: the covariance is never formed, only applied.

Every step that touches the vectors is one pass, in which each task adds up X'(XQ) of its own centred rows and Spark sums
the d x block partial results; the driver holds Q and no vector. A polynomial recurrence of such passes damps the
spectrum from its lower end to the block's smallest Ritz value, QR makes the block orthonormal again, and a Rayleigh-Ritz
step gives values, vectors and their residuals. One more column of each pass is a Lanczos step, which finds the lower end.
Vectors whose residual is small are kept and projected out of the recurrence, as the largest would drown the others. The
iteration ends when every wanted residual is certified small; it raises if that doesn't come about.

Rows with a null vector, a null or non-finite entry or an entry beyond LARGEST are left out, and so are vectors of
another length than most have (of equally frequent lengths the larger counts). Repeated rows count as often as they
come; ids are only carried along, nulls too. Constant vectors have no component and an empty table has no rows: both give
no result. Directions whose eigenvalue is below RANK of the largest are no components. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.llm import common

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Directions that the block holds beyond the wanted ones: the flatter the spectrum, the more they speed up.
GUARD = 24
#: Certified: residuals below this share of the largest eigenvalue.
TOLERANCE = 2e-14
RANK = 1e-12
LARGEST = float(1 << 40)
ROUNDS = 60


@dataclass
class Whitening:
    n: int
    sums: np.ndarray  # of each dimension, exact
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column each
    trace: float
    residual: float
    passes: int


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): the remaining rows with their entries as whole numbers, written to the shared folder."""
    v = F.col(f"`{vector_col}`")
    good = F.forall(v, lambda c: c.isNotNull() & (F.abs(c.cast("double")) <= LARGEST))  # false for NaN, which counts as largest
    rows = df.where(v.isNotNull() & (F.size(v) > 0)).where(good).select(F.col(f"`{id_col}`").alias("id"), v.alias("v"))
    kept = common.materialise(rows.select("id", F.transform("v", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT).alias("x")), "vectors")
    lengths = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(2).collect()
    return kept.where(F.size("x") == lengths[0].d) if len(lengths) > 1 else kept


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n from the exact n*x - S."""
    top = max(float(np.abs(x).max(initial=0)), float(np.abs(sums).max(initial=0)) / n)
    return (n * x - sums) / n if 2 * n * top < 2**62 else x - sums / n


def added(x: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], kind: str) -> np.ndarray:
    """The sum over all rows of ``part`` (rows' matrix to an array of ``shape``): summed within tasks, then by Spark."""
    common.arrow_limits(x.sparkSession)
    names = [f"q{j}" for j in range(shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(matrix(batch.column(0)))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(shape[0], dtype=np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in total.T)], ["i", *names])

    parts = x.select("x").mapInArrow(run, "i int, " + ", ".join(f"{c} {kind}" for c in names))
    out = np.zeros(shape, np.int64 if kind == "long" else float)
    for row in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect():  # at most shape's entries
        out[row.i] = row[1:]
    return out


class LowerEnd:
    """Where the spectrum begins: Lanczos steps, orthogonal to all before, of one random direction."""

    def __init__(self, d: int, rng: np.random.Generator):
        self.rng, self.basis, self.images = rng, np.zeros((d, 0)), np.zeros((d, 0))
        self.next = self.orthogonal(rng.standard_normal(d))

    def orthogonal(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v / np.linalg.norm(v)
            v = v - self.basis @ (self.basis.T @ v)
        return (v / np.linalg.norm(v))[:, None]

    def step(self, image: np.ndarray) -> None:
        """``image``: the covariance's product with ``next``."""
        self.basis, self.images = np.hstack([self.basis, self.next]), np.hstack([self.images, image])
        if self.basis.shape[0] == self.basis.shape[1]:
            self.next = self.next[:, :0]  # the whole space is known
            return
        rest = image[:, 0] - self.basis @ (self.basis.T @ image[:, 0])
        self.next = self.orthogonal(rest if np.linalg.norm(rest) > RANK * np.linalg.norm(image) else self.rng.standard_normal(len(rest)))

    def value(self) -> float:
        """The smallest Ritz value less its residual. Directions below are damped less, but by more than the wanted ones."""
        h = self.basis.T @ self.images
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        return max(0.0, float(theta[0] - np.linalg.norm(self.images @ turn[:, 0] - theta[0] * (self.basis @ turn[:, 0]))))


def degree_for(top: float, wanted: float, low: float, high: float, needed: float) -> int:
    """Passes in a filter: enough to damp by ``needed`` at the last wanted value, but no more than let ``top``, the largest
    that isn't kept, outgrow it by 1e9 (beyond that rounding would hide it); 4 to 24."""
    rate = lambda v: np.arccosh(max((v - (high + low) / 2) / ((high - low) / 2), 1 + 1e-9))
    most = np.log(1e9) / max(rate(top) - rate(wanted), 1e-9)
    return int(np.clip(min(np.ceil(np.log(needed) / rate(wanted)), most), 4, 24))


def fit(x: DataFrame, components: int = COMPONENTS, guard: int = GUARD, seed: int = 1) -> Whitening | None:
    """The leading eigenvectors of the covariance of ``usable`` vectors; None without rows."""
    first = x.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d, n = first.d, x.count()
    sums = added(x, lambda m: m.sum(0)[:, None], (d, 1), "long")[:, 0]
    trace = float(added(x, lambda m: (centred(m, n, sums) ** 2).sum(0)[:, None], (d, 1), "double").sum()) / n
    passes, rng = [2], np.random.default_rng(seed)
    end = LowerEnd(d, rng)

    def applied(q: np.ndarray) -> np.ndarray:
        """V q, in one pass."""
        passes[0] += 1
        columns = np.hstack([q, end.next])

        def part(m: np.ndarray) -> np.ndarray:
            c = centred(m, n, sums)
            return c.T @ (c @ columns)

        out = added(x, part, columns.shape, "double") / n
        if end.next.size:
            end.step(out[:, q.shape[1] :])
        return out[:, : q.shape[1]]

    if trace <= 0:
        return Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, 0.0, passes[0])
    width = min(d, components + max(2, guard))  # what is damped ends below the wanted values
    q = np.linalg.qr(rng.standard_normal((d, width)))[0]
    best = np.inf
    for _ in range(ROUNDS):
        w = applied(q)
        h = q.T @ w
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        wanted = int((theta[:components] > RANK * theta[0]).sum())
        residuals = np.linalg.norm(w[:, :wanted] - q[:, :wanted] * theta[:wanted], axis=0)
        residual = float(residuals.max())
        # certified, or at the floor of double precision: no better than the round before, and nearly there
        if residual <= TOLERANCE * theta[0] or (residual <= 50 * TOLERANCE * theta[0] and residual > best / 2):
            v = q[:, :wanted]
            sign = np.sign(v[np.abs(v).argmax(0), np.arange(wanted)])
            return Whitening(n, sums, theta[:wanted], v * sign, trace, residual, passes[0])
        best = min(best, residual)
        done = int(np.argmax(np.append(residuals, np.inf) > TOLERANCE * theta[0]))
        keep, q, w, top = q[:, :done], q[:, done:], w[:, done:], float(theta[min(done, wanted - 1)])
        apart = lambda b: b - keep @ (keep.T @ b)
        high = max(float(theta[-1]), RANK * float(theta[0]))
        low = end.value() if end.value() < high else 0.0
        half, middle = (high - low) / 2, (high + low) / 2
        sigma = half / (top - middle)
        rise, last, now = sigma, q, apart((w - middle * q) * (sigma / half))
        for _ in range(degree_for(top, float(theta[wanted - 1]), low, high, 10 * residual / (TOLERANCE * theta[0])) - 1):
            step = 1 / (2 / rise - sigma)
            last, now = now, apart(2 * step / half * (applied(now) - middle * now) - sigma * step * last)
            sigma = step
        q = np.linalg.qr(np.hstack([keep, now]))[0]
    raise RuntimeError(f"not certified after {ROUNDS} rounds: residual {best}")


def whiten(x: DataFrame, model: Whitening | None, id_col: str = "vec_id") -> DataFrame:
    """id, component, n, deviation (exact, as decimal), whitened and explained of every row and component."""
    kind = x.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double"
    if model is None or not len(model.values):
        return x.sparkSession.createDataFrame([], schema)
    n, sums, k = model.n, model.sums, len(model.values)
    project = model.vectors / np.sqrt(model.values)
    share = model.values / model.trace

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = matrix(batch.column(1))
        far = float(np.abs(m).max()) * n + float(np.abs(sums).max())
        t = n * m - sums if far < 2**62 else n * m.astype(object) - sums.astype(object)
        off = (t**2).sum(1) if float(np.abs(t).max()) ** 2 * m.shape[1] < 2**62 else (t.astype(object) ** 2).sum(1)
        rows = np.repeat(np.arange(len(m)), k)
        columns = [
            batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(m))), pa.array(np.full(len(rows), n)),
            pa.array([int(v) for v in off], pa.decimal128(38, 0)).take(pa.array(rows)), pa.array((centred(m, n, sums) @ project).reshape(-1)), pa.array(np.tile(share, len(m))),
        ]
        return pa.RecordBatch.from_arrays(columns, [id_col, "component", "n", "deviation", "whitened", "explained"])

    return common.map_arrow(x.select("id", "x"), run, schema)


def identity_error(x: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    k, project = len(model.values), model.vectors / np.sqrt(model.values)

    def part(m: np.ndarray) -> np.ndarray:
        w = centred(m, model.n, model.sums) @ project
        return np.vstack([w.T @ w, w.sum(0)])

    total = added(x, part, (k + 1, k), "double") / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    model = fit(x)
    error = identity_error(x, model) if model is not None and len(model.values) else 0.0
    return whiten(x, model).withColumns({"deviation": F.col("deviation").cast("long"), "identity_error": F.lit(error)})
