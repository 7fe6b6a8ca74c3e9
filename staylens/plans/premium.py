"""Pipeline D: from the clean matrix to residuals, score correlations, the
top / bottom premium lists, the description-quality record and its Markdown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.scalar import LISTING_URL_PREFIX, fixed_round
from staylens.operators import premium as pm
from staylens.plans.common import written

# ---------------------------------------------------------------------------
# fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
REPORT_TITLE = "# Listing Description Quality Analysis\n\n"
TOP_LABEL = "Top 15 — Highest ADR Premium"
BOTTOM_LABEL = "Bottom 15 — Lowest ADR Premium"
LINK_TEXT = "View on Airbnb"


def quality_report_markdown(r2: DataFrame, top_bottom: DataFrame, n_scored: DataFrame, features: Sequence[str],
                            area_label: str, body: DataFrame | None = None, key: str = "listing_id") -> DataFrame:
    """One report row: R² with the feature list, property / scored counts,
    top and bottom premium link sections, then the body text.

    ``r2`` has ``n, r_squared``; ``top_bottom`` comes from
    :func:`staylens.operators.premium.top_bottom_premium`; ``n_scored`` has one
    row with ``n_scored``; ``body`` (optional) has ``o, t`` lines.  All inputs
    are bounded (one row, 2 x 15 rows, a few body lines), assembled by one
    tagged union and one global aggregate."""
    feats = ", ".join(features) if features else "(none)"
    link_line = F.concat(F.col("rank").cast("string"), F.lit(". **"), F.col(key).cast("string"),
                         F.lit("** — ADR premium $"), F.format_string("%+.0f", fixed_round("residual", 0)),
                         F.lit("/night — [" + LINK_TEXT + "]("), F.lit(LISTING_URL_PREFIX),
                         F.col(key).cast("string"), F.lit(")"))
    parts = (r2.select(F.lit("r2").alias("part"), F.lit(0).alias("o"),
                       F.format_string("%.3f", fixed_round("r_squared", 3)).alias("t"))
             .unionByName(r2.select(F.lit("n").alias("part"), F.lit(0).alias("o"), F.col("n").cast("string").alias("t")))
             .unionByName(n_scored.select(F.lit("s").alias("part"), F.lit(0).alias("o"),
                                          F.col("n_scored").cast("string").alias("t")))
             .unionByName(top_bottom.select(F.col("side").alias("part"), F.col("rank").cast("int").alias("o"),
                                            link_line.alias("t"))))
    if body is not None:
        parts = parts.unionByName(body.select(F.lit("body").alias("part"), F.col("o").cast("int"), "t"))

    def block(part, sep="\n"):
        items = F.array_sort(F.collect_list(F.when(F.col("part") == part, F.struct("o", "t"))))
        return F.array_join(F.transform(items, lambda x: x["t"]), sep)
    agg = parts.groupBy().agg(block("r2").alias("r2"), block("n").alias("n"), block("s").alias("s"),
                              block("top").alias("top"), block("bottom").alias("bottom"), block("body").alias("body"))
    text = F.concat(
        F.lit(REPORT_TITLE), F.lit(f"**Zipcode:** {area_label}\n\n**Feature-Adjustment R²:** "), F.col("r2"),
        F.lit(f" (proportion of ADR variance explained by {len(features)} features: {feats})\n\n"),
        F.lit("**Properties Analyzed:** "), F.col("n"), F.lit(" ("), F.col("s"), F.lit(" descriptions scored)\n\n"),
        F.lit("## Property Links\n\n### " + TOP_LABEL + "\n\n"), F.col("top"), F.lit("\n"),
        F.lit("### " + BOTTOM_LABEL + "\n\n"), F.col("bottom"), F.lit("\n"),
        F.lit("---\n\n"), F.col("body"))
    return agg.select(text.alias("report"))


ANALYSIS_TYPE = "description_quality"


def premium_pipeline(matrix: DataFrame, scores: DataFrame, dimensions: Sequence[str], area: str = "all",
                     features: Sequence[str] | None = None, label: str = pm.LABEL, key: str = "listing_id",
                     k: int = pm.TOP_BOTTOM_K) -> dict:
    """The whole of pipeline D over one matrix.

    Every numeric column of ``matrix`` but the label and the key is a feature
    (dependent ones included); ``scores`` has the key and one numeric column per
    dimension.  The residuals are written once and feed the fit's quality, the
    correlations, both lists and the counts.  Returns ``model``, ``residuals``,
    ``correlation``, ``top_bottom`` and ``record`` (one row, nested; empty where
    the fit has too few rows)."""
    from staylens.operators.matrix import select_numeric_features
    feats = list(features) if features is not None else select_numeric_features(matrix, label, exclude=[key])
    model = pm.ols_fit(matrix.select(key, label, *feats), label, feats)
    residuals = written(pm.ols_residuals(matrix.select(key, label, *feats), model, key).where(F.lit(model.ok)), "residuals")
    scored = written(scores.join(residuals.select(key, "residual"), key), "scored")
    correlation = pm.dimension_correlation(scored.drop("residual"), scored.select(key, "residual"), key, dimensions)
    return {"model": model, "residuals": residuals, "correlation": correlation,
            "top_bottom": pm.top_bottom_premium(residuals, k, key),
            "record": quality_record(residuals, scored, correlation, feats, dimensions, area)}


def quality_record(residuals: DataFrame, scored: DataFrame, correlation: DataFrame, features: Sequence[str],
                   dimensions: Sequence[str], area: str = "all") -> DataFrame:
    """The ``write_quality_stats`` record: one nested row per area, from one
    aggregate over the residuals, the count of scored listings and the
    correlations (at most one row per dimension), joined by a tagged union."""
    fit = residuals.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("residual") ** 2).alias("ss_res"),
        (F.variance("actual") * (F.count(F.lit(1)) - 1)).alias("ss_tot"),
        F.struct(*[fixed_round(f("residual"), 2).alias(c) for c, f in (
            ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]).alias("stats"))
    r2 = F.when(F.col("ss_tot") > 0, F.lit(1.0) - F.col("ss_res") / F.col("ss_tot")).otherwise(F.lit(0.0))
    corr_type = "struct<rank:int,dimension:string,correlation:double,n:bigint>"
    stats_type = "struct<mean:double,std:double,min:double,max:double>"

    def part(df, **cols):
        types = {"r2": "double", "n": "bigint", "stats": stats_type, "scored": "bigint", "corr": corr_type}
        return df.select(*[(cols[c] if c in cols else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
    parts = part(fit.where("n > 0"), r2=fixed_round(r2, 4), n=F.col("n"), stats=F.col("stats")) \
        .unionByName(part(scored.agg(F.count(F.lit(1)).alias("c")), scored=F.col("c"))) \
        .unionByName(part(correlation, corr=F.struct(F.col("rank").cast("int").alias("rank"), "dimension", "correlation",
                                                     F.col("n").cast("long").alias("n"))))
    one = parts.groupBy().agg(F.max("r2").alias("r2"), F.max("n").alias("n"), F.max("stats").alias("stats"),
                              F.max("scored").alias("scored"), F.array_sort(F.collect_list("corr")).alias("corr"))
    return one.where(F.col("n") > 0).select(
        F.lit(area).alias("zipcode"), F.lit(ANALYSIS_TYPE).alias("analysis_type"),
        F.col("r2").alias("regression_r_squared"),
        F.array(*[F.lit(f) for f in features]).cast("array<string>").alias("regression_features_used"),
        F.col("n").alias("num_properties_analyzed"), F.col("scored").alias("num_descriptions_scored"),
        F.array(*[F.lit(d) for d in dimensions]).cast("array<string>").alias("score_dimensions"),
        F.transform("corr", lambda x: F.struct(x["dimension"].alias("dimension"), x["correlation"].alias("correlation"),
                                               x["n"].alias("n"))).alias("dimension_correlations"),
        F.col("stats").alias("residual_stats"))
