"""Whitening of embeddings by shifted CholeskyQR.

Entries become integers ``x = floor(64 c) + 1000000``.  Every distinct x vector
counts once in the fit; its rows, centred, form a tall matrix A that only lives
as files.  One pass over them gives the Gram matrix of the current rows
``Q = A R1^-1 R2^-1 ...`` (the triangular solves run in the tasks, batch by
batch); the driver factors it, with a shift on the diagonal as long as it is too
ill-conditioned for a plain Cholesky step, and the factors are composed into R
with A = QR.  The SVD of R (dimensions x dimensions) gives the components and
the variances: squares of small singular values are never subtracted from large
ones, so components far below the first one keep their digits.

What reaches the driver is of the size of dimensions squared.  Centred entries
are ``(n x - S) / n`` from whole numbers, so centring cancels nothing.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries are dropped, and so are vectors that have not the most frequent length
(of equally frequent ones the greatest); entries beyond 2**53 / 64 in size are
cut to it; a dimension without variance has no part in any component; there are
as many components as directions with variance (``RANK``; at most ``components``), so one
distinct vector, or an empty table, gives no rows; repeated rows and ids, also
null ids, are each returned; extra columns are ignored; a deviation beyond the
range of a long is null.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import cut, load

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
BATCH = 4096            # rows of a solve
UNIT = np.finfo(np.float64).eps / 2
SETTLED = (0.5, 2.0)    # Gram eigenvalues of rows that are nearly orthonormal
NULL = 1e-12            # ... and of a direction without variance
RANK = 1e-13            # singular values below this share of the first are zero


def _rows(batch, column: str) -> np.ndarray:
    """A list column without nulls as a matrix."""
    col = batch.column(column)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def quantise(df: DataFrame, column: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """vec_id, x (array of long) of the rows that take part."""
    size = F.size(column)
    good = (df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("c"))
            .where(F.col("c").isNotNull() & (F.size("c") > 0))
            .where(F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))))
    size = F.size("c")
    common = good.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0

    def run(batches):
        for b in batches:
            limit = float(2 ** 53) / SCALE
            x = np.floor(SCALE * np.clip(_rows(b, "c"), -limit, limit)).astype(np.int64) + OFFSET
            ends = np.arange(0, x.size + 1, max(d, 1), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.ListArray.from_arrays(pa.array(ends[:len(x) + 1]), pa.array(x.ravel()))],
                names=["vec_id", "x"])

    return good.where(size == d).mapInArrow(run, "vec_id long, x array<long>")


class Centre:
    """n distinct vectors with sums S."""

    def __init__(self, n: int, sums: np.ndarray):
        self.n, self.sums = n, sums

    def whole(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: as long where it fits, else as Python numbers."""
        if x.size and self.n * (int(np.abs(x).max()) + 1) + int(np.abs(self.sums).max()) < 1 << 62:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums.astype(object)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (self.whole(x) / self.n).astype(np.float64)

    def deviation(self, x: np.ndarray) -> list:
        """Sum over the dimensions of (n x - S) squared, exact; null beyond a long."""
        w = self.whole(x)
        if w.dtype != object and w.size and int(np.abs(w).max()) ** 2 * w.shape[1] < 1 << 63:
            return (w * w).sum(axis=1).tolist()
        out = [sum(int(v) ** 2 for v in row) for row in w]
        return [v if v < 1 << 63 else None for v in out]


def centre(fit: DataFrame) -> Centre:
    """Count and sums of the fit list (whole numbers, added by Spark)."""

    def run(batches):
        for b in batches:
            x = _rows(b, "x")
            if len(x):
                low, high = (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(x.shape[1], dtype=np.int32)), pa.array(low), pa.array(high),
                     pa.array(np.full(x.shape[1], len(x)))], names=["i", "low", "high", "n"])

    parts = fit.mapInArrow(run, "i int, low long, high long, n long")
    got = parts.groupBy("i").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high", "n")])
    got = got.orderBy("i").collect()
    sums = np.array([int(r["low"]) + (int(r["high"]) << 32) for r in got], dtype=object)
    return Centre(int(got[0]["n"]) if got else 0, sums)


def solve_right(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a r^-1 for an upper triangular r, column by column."""
    q = np.empty_like(a, order="F")
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def gram(fit: DataFrame, rows_of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over the fit list of the outer products of ``rows_of(x)``: upper
    triangles per task, added by Spark."""
    at = np.triu_indices(size)

    def run(batches):
        total = np.zeros((size, size))
        for b in batches:
            x = _rows(b, "x")
            for k in range(0, len(x), BATCH):
                q = rows_of(x[k:k + BATCH])
                total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)),
                                          pa.array(total[at])], names=["i", "j", "v"])

    sums = fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    g = np.zeros((size, size))
    for r in sums:
        g[r["i"], r["j"]] = g[r["j"], r["i"]] = r["v"]
    return g


def pivoted_cholesky(g: np.ndarray, least: float) -> np.ndarray:
    """r with r.T r = g for a positive semidefinite g: the largest remaining
    diagonal entry first, until none is above ``least``; one row per pivot."""
    rest, out = g.copy(), []
    while len(out) < len(g):
        p = int(np.argmax(np.diag(rest)))
        if rest[p, p] <= least:
            break
        row = rest[p] / np.sqrt(rest[p, p])
        out.append(row)
        rest -= np.outer(row, row)
    return np.array(out).reshape(len(out), len(g))


def shifted_cholesky_qr(fit: DataFrame, mean: Centre, dims: np.ndarray, passes: int = 12) -> np.ndarray:
    """R of the centred rows of the fit list, over the dimensions ``dims``."""
    d, factors = len(dims), []
    for _ in range(passes):
        held = list(factors)

        def rows_of(x, held=held):
            q = mean(x)[:, dims]
            for r in held:
                q = solve_right(q, r)
            return q

        g = gram(fit, rows_of, d)
        values = np.linalg.eigvalsh(g)
        live = values > NULL
        if factors and np.all((values[live] >= SETTLED[0]) & (values[live] <= SETTLED[1])):
            r = pivoted_cholesky(g, 1e-9)    # the last one: no shift, only directions with variance
            break
        if values[0] <= 1e3 * d * UNIT * values[-1] or not factors:
            g = g + 11 * (mean.n * d + d * (d + 1)) * UNIT * values[-1] * np.eye(d)
        factors.append(np.linalg.cholesky(g).T)
    else:
        raise ArithmeticError(f"rows are not orthonormal after {passes} passes")
    for f in reversed(factors):
        r = r @ f
    return r


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> dict:
    """The model as plain arrays: n, sums, components (one per column), their
    variances and shares.  ``fit`` holds every x vector once."""
    mean = centre(fit)
    out = {"n": mean.n, "sums": mean.sums, "components": np.zeros((len(mean.sums), 0)), "variance": np.zeros(0),
           "explained": np.zeros(0)}
    if mean.n == 0:
        return out

    def spread(batches):
        for b in batches:
            x = _rows(b, "x")
            if len(x):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(x.shape[1], dtype=np.int32)), pa.array(x.min(axis=0)), pa.array(x.max(axis=0))],
                    names=["i", "a", "b"])

    varied = (fit.mapInArrow(spread, "i int, a long, b long").groupBy("i").agg(F.min("a").alias("a"), F.max("b").alias("b"))
              .where("a < b").collect())
    dims = np.array(sorted(r["i"] for r in varied), dtype=np.int64)
    if not len(dims):
        return out
    r = shifted_cholesky_qr(fit, mean, dims)
    _, s, vt = np.linalg.svd(r)
    s = s[s > RANK * s[0]]
    k = min(components, len(s))
    vectors = np.zeros((len(mean.sums), k))
    vectors[dims] = vt[:k].T
    largest = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[largest, np.arange(k)])    # one sign on every run
    out.update(components=vectors, variance=s[:k] ** 2 / mean.n, explained=s[:k] ** 2 / (s ** 2).sum())
    return out


def project(x: np.ndarray, model: dict) -> np.ndarray:
    mean = Centre(model["n"], model["sums"])
    return mean(x) @ model["components"] / np.sqrt(model["variance"])


def identity_error(fit: DataFrame, model: dict) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = len(model["variance"])
    if not k:
        return 0.0
    return float(np.abs(gram(fit, lambda x: project(x, model), k) / model["n"] - np.eye(k)).max())


def whiten(rows: DataFrame, model: dict) -> DataFrame:
    """vec_id, deviation, whitened (array of double, one entry per component)."""

    def run(batches):
        mean, k = Centre(model["n"], model["sums"]), len(model["variance"])
        for b in batches:
            x = _rows(b, "x")
            if not len(x):
                continue
            y = project(x, model)
            ends = pa.array(np.arange(0, y.size + 1, max(k, 1), dtype=np.int32)) if k else pa.array(
                np.zeros(len(x) + 1, np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(mean.deviation(x), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(y.ravel()))],
                names=["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(quantise(load(spark, sf_dir, "embeddings")), "whitening-rows")
    fit = cut(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit)
    error = identity_error(fit, model)
    out = whiten(rows, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.array(*[F.lit(float(v)) for v in model["explained"]]) if len(model["explained"]) else F.array().cast("array<double>")
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model["n"]).cast("long").alias("n"), "deviation",
                      "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
