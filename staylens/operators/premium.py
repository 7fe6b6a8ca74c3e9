"""Price-premium model (pipeline D): OLS fit, residuals, score correlation,
top/bottom premium lists (sections 2.5, 2.6, 2.10).

OLS plan: pass 1 aggregates n and column means (p + 2 numbers); pass 2 emits
each partition's centred Gram matrix (features and label) in tiles, summed per
tile row by one aggregate.  Only the (p+1)^2 merged moments reach the driver,
where a rank-revealing solve handles dependent columns.  Coefficients go back as
literals in a column expression -- nothing is broadcast that grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from staylens.functions.scalar import fixed_round

LABEL = "ADR"
TOP_BOTTOM_K = 15
MIN_PAIRS = 3


@dataclass
class OlsModel:
    label: str
    features: list[str]
    intercept: float = 0.0
    coefficients: list[float] = field(default_factory=list)
    n: int = 0
    ok: bool = False
    rank: int = 0
    means: list[float] = field(default_factory=list)
    moments: np.ndarray | None = None

    def prediction(self):
        expr = F.lit(float(self.intercept))
        for f_, b_ in zip(self.features, self.coefficients):
            expr = expr + F.col(f_).cast("double") * F.lit(float(b_))
        return expr

    def coefficient_df(self, spark) -> DataFrame:
        rows = [("intercept", float(self.intercept))] + list(zip(self.features, map(float, self.coefficients)))
        return spark.createDataFrame(rows, "term string, coefficient double")


def numeric_features(df: DataFrame, label: str = LABEL, exclude: Sequence[str] = ()) -> list[str]:
    """All numeric columns except the label (booleans / strings excluded)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name != label and f.name not in exclude]


def complete_rows_filter(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Coerce features to double (unparsable -> NULL) and drop rows with a NULL
    in any of them; zeros are kept."""
    conv = {c: F.col(c).cast("string").try_cast("double") if not isinstance(df.schema[c].dataType, NumericType)
            else F.col(c).cast("double") for c in features}
    return df.withColumns(conv).dropna(subset=list(features))


def regression_frame(df: DataFrame, label: str = LABEL, features: Sequence[str] | None = None,
                     exclude: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Valid label rows (to-numeric > 0) with complete features."""
    feats = list(features) if features is not None else numeric_features(df, label, exclude)
    y = F.col(label).cast("string").try_cast("double") if not isinstance(df.schema[label].dataType, NumericType) \
        else F.col(label).cast("double")
    valid = df.withColumn(label, y).where(F.col(label) > 0)
    return complete_rows_filter(valid, feats), feats


TILE = 32  # columns per side of a Gram tile


def _partial_tiles(cols: list[str], means: list[float]):
    k = len(cols)
    side = min(TILE, k)
    blocks = -(-k // side)
    mu = np.asarray(means, dtype="float64")

    def fn(batches):
        import pyarrow as pa
        acc = np.zeros((blocks * side, blocks * side))
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) - mu
            acc[:k, :k] += x.T @ x
        rows = [(i, j, r, acc[i * side + r, j * side:(j + 1) * side]) for i in range(blocks) for j in range(i, blocks)
                for r in range(side)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[c] for x in rows], pa.int32()) for c in range(3)]
            + [pa.array(np.array([x[3][c] for x in rows])) for c in range(side)],
            names=["ti", "tj", "r", *[f"v{c}" for c in range(side)]])
    return fn


def regression_moments(frame: DataFrame, label: str, features: Sequence[str]) -> tuple[int, list[float], np.ndarray]:
    """n, means and the centred cross-product matrix over [features..., label].

    The matrix is cut into tiles of ``TILE`` columns a side; each task emits the
    rows of its tiles on and above the diagonal, and one aggregate with
    ``TILE`` sums adds them per (tile, row).  Only the summed (p+1)^2 numbers
    reach the driver."""
    cols = list(features) + [label]
    row = frame.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    n, k = int(row["n"]), len(cols)
    if n == 0:
        return 0, [0.0] * k, np.zeros((k, k))
    means = [float(row[f"m{i}"]) for i in range(k)]
    side = min(TILE, k)
    names = [f"v{c}" for c in range(side)]
    parts = frame.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(
        _partial_tiles(cols, means), "ti int, tj int, r int, " + ", ".join(f"{v} double" for v in names))
    m = np.zeros((-(-k // side) * side,) * 2)
    for t in parts.groupBy("ti", "tj", "r").agg(*[F.sum(v).alias(v) for v in names]).collect():
        i, j = t["ti"] * side + t["r"], t["tj"] * side
        m[i, j:j + side] = [t[v] for v in names]
        m[j:j + side, i] = m[i, j:j + side]
    return n, means, m[:k, :k]


RANK_TOLERANCE = 1e-12


def solve_moments(g: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, int]:
    """Least-squares coefficients of centred moments, and the rank of the design.

    Columns are brought to unit length first, so a feature of small variance is
    not cut off; directions whose eigenvalue is below ``RANK_TOLERANCE`` of the
    largest are dependent and get no weight (minimum norm among all solutions)."""
    scale = np.sqrt(np.clip(np.diag(g), 0, None))
    scale[scale == 0] = 1.0
    values, vectors = np.linalg.eigh(g / np.outer(scale, scale))
    live = values > RANK_TOLERANCE * max(values[-1], 0.0)
    basis = vectors[:, live]
    return basis @ ((basis.T @ (c / scale)) / values[live]) / scale, int(live.sum())


def ols_fit(df: DataFrame, label: str = LABEL, features: Sequence[str] | None = None,
            exclude: Sequence[str] = ()) -> OlsModel:
    """Least squares of ``label`` on the features plus an intercept.

    Needs n >= p + 1 rows, else ``ok=False`` (no coefficients, like the
    reference's early return)."""
    from staylens.plans.common import reuse
    frame, feats = regression_frame(df, label, features, exclude)
    frame = reuse(frame.select(*feats, label))  # two passes (means, moments) read it
    model = OlsModel(label=label, features=feats)
    if not feats:
        return model
    n, means, m = regression_moments(frame, label, feats)
    model.n, model.means, model.moments = n, means, m
    p = len(feats)
    if n < p + 1:
        return model
    beta, model.rank = solve_moments(m[:p, :p], m[:p, p])
    model.coefficients = [float(x) for x in beta]
    model.intercept = float(means[p] - np.dot(np.asarray(means[:p]), beta))
    model.ok = True
    return model


def ols_residuals(df: DataFrame, model: OlsModel, key: str = "listing_id", out: str = "residual") -> DataFrame:
    """actual - predicted for every valid, complete row (coefficients inlined)."""
    frame, _ = regression_frame(df, model.label, model.features)
    return frame.select(key, F.col(model.label).alias("actual"),
                        (F.col(model.label) - model.prediction()).alias(out))


def r_squared(residuals: DataFrame, actual: str = "actual", residual: str = "residual") -> DataFrame:
    """1 - SS_res / SS_tot (0 when SS_tot = 0), one aggregate pass."""
    agg = residuals.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(residual) ** 2).alias("ss_res"),
                        (F.variance(actual) * (F.count(F.lit(1)) - 1)).alias("ss_tot"))
    r2 = F.when(F.col("ss_tot") > 0, F.lit(1.0) - F.col("ss_res") / F.col("ss_tot")).otherwise(F.lit(0.0))
    return agg.select("n", r2.alias("r_squared"))


def residual_stats(residuals: DataFrame, residual: str = "residual") -> DataFrame:
    """mean, sample std, min, max -- 2 dp."""
    return residuals.agg(fixed_round(F.avg(residual), 2).alias("mean"),
                         fixed_round(F.stddev_samp(residual), 2).alias("std"),
                         fixed_round(F.min(residual), 2).alias("min"),
                         fixed_round(F.max(residual), 2).alias("max"))


def top_bottom_premium(residuals: DataFrame, k: int = TOP_BOTTOM_K, key: str = "listing_id",
                       residual: str = "residual") -> DataFrame:
    """Top ``k`` and bottom ``k`` by residual, each ranked 1..k in descending
    residual order (the two lists overlap when there are fewer than 2k rows).

    Two global top-k's: Spark plans each ``orderBy().limit(k)`` as a
    TakeOrderedAndProject, so every task forwards only its own k rows.
    """
    top = residuals.orderBy(F.col(residual).desc(), F.col(key)).limit(k) \
        .withColumn("side", F.lit("top"))
    bottom = residuals.orderBy(F.col(residual).asc(), F.col(key).desc()).limit(k) \
        .withColumn("side", F.lit("bottom"))
    both = top.unionByName(bottom)
    w = Window.partitionBy("side").orderBy(F.col(residual).desc(), F.col(key))
    return both.withColumn("rank", F.row_number().over(w))


def scores_long(scores: DataFrame, key: str = "listing_id", dimensions: Sequence[str] | None = None) -> DataFrame:
    """Wide numeric score columns -> (key, dimension, dimension_pos, score)."""
    dims = list(dimensions) if dimensions is not None else numeric_features(scores, label=key)
    entries = [F.struct(F.lit(d).alias("dimension"), F.lit(i).alias("dimension_pos"),
                        F.col(d).cast("double").alias("score")) for i, d in enumerate(dims)]
    return scores.select(key, F.inline(F.array(*entries)))


def dimension_correlation(scores: DataFrame, residuals: DataFrame, key: str = "listing_id",
                          dimensions: Sequence[str] | None = None, residual: str = "residual") -> DataFrame:
    """Pearson r (4 dp) and n per score dimension vs the residual.

    Inner join on the key (not position), NULL score pairs dropped, fewer than
    three pairs -> no row, zero variance -> 0.0.  Ranked by |r| desc with the
    dimension's declared position as tie-break.
    """
    long = scores_long(scores, key, dimensions).where(F.col("score").isNotNull())
    j = long.join(residuals.select(key, residual), key)
    x, y = F.col("score"), F.col(residual)
    r = F.coalesce(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)), F.lit(0.0))
    agg = j.groupBy("dimension", "dimension_pos").agg(fixed_round(r, 4).alias("correlation"),
                                                      F.count(F.lit(1)).alias("n"))
    agg = agg.where(F.col("n") >= MIN_PAIRS)
    w = Window.orderBy(F.abs(F.col("correlation")).desc(), F.col("dimension_pos"))
    return agg.withColumn("rank", F.row_number().over(w))
