"""Pipeline C: tier comparison for each configured metric."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.scalar import fixed_round
from staylens.operators import market as mk
from staylens.operators import tiers as tr
from staylens.plans.common import reuse
from staylens.sources import bindings as b


def binding_matrix(spark, sf: str) -> DataFrame:
    """Listing matrix over the driver tables: part attributes LEFT JOIN market
    metrics (with occupancy columns) LEFT JOIN the pivoted amenity icons."""
    market = mk.occupancy_metrics(b.b_market(spark, sf))
    feats = b.b_part_features(spark, sf).drop("retail_price")
    from staylens.operators.matrix import amenity_matrix
    wide = amenity_matrix(b.b_icon_rows(spark, sf), b.BINDING_ICONS)
    m = mk.join_market_metrics(feats, market)
    return m.join(wide, "listing_id", "left")


BINDING_METRICS = {"adr": "ADR", "occupancy": "Occ_Rate_Based_on_Avail"}


def tier_analysis(matrix: DataFrame, metrics: Mapping[str, str] = None, amenities: Sequence[str] = None,
                  numeric: Sequence[str] = tr.NUMERIC_COLUMNS, top: int = 25, bottom: int = 25,
                  by=None, persist: bool = True) -> dict[str, DataFrame]:
    """All tier outputs for every metric, from two passes over the matrix
    (thresholds, then one grouped aggregate for every tier statistic)."""
    metrics = metrics or {k: v["column"] for k, v in tr.METRIC_CONFIG.items()}
    amenities = amenities or tr.AMENITY_COLUMNS
    df = mk.has_market_data_filter(matrix)
    if persist:
        df = reuse(df)
    th = tr.tier_thresholds(df, metrics, top, bottom, by)
    if persist:
        th = reuse(th)  # attached to every row and reused by the report
    tiered = tr.tier_assign(df, metrics, th, top, bottom, by)
    present_a = [a for a in amenities if a in df.columns]
    present_n = [c for c in numeric if c in df.columns]
    stats = tr.tier_feature_stats(tiered, present_a, present_n, by)
    if persist:
        stats = reuse(stats)  # groups x metrics x 2 rows; feeds prevalence, numeric and counts
    prev = tr.amenity_prevalence(tiered, present_a, by, stats=_rename(stats, "a", len(present_a)))
    num = tr.numeric_tier_stats(tiered, present_n, by, stats=_rename(stats, "m", len(present_n)))
    return {"thresholds": th, "tiered": tiered, "stats": stats, "prevalence": prev, "numeric": num}


def _rename(stats: DataFrame, prefix: str, n: int) -> DataFrame:
    keep = [c for c in stats.columns if not (c[0] in "am" and c[1:].isdigit())]
    return stats.select(*keep, *[F.col(f"{prefix}{i}") for i in range(n)])


def tier_report(res: dict[str, DataFrame], top: int = 25, bottom: int = 25, by=None,
                metric_columns: Mapping[str, str] | None = None, raw_thresholds: bool = False) -> DataFrame:
    """One row per (group, metric): the ``write_tier_stats`` record plus the
    comparison text -- thresholds rounded to 2 dp, tier counts."""
    keys = [] if by is None else ([by] if isinstance(by, str) else list(by))
    counts = res["stats"].select(*keys, "metric", "tier", "n")
    cnt = counts.groupBy(*keys, "metric").agg(
        F.max(F.when(F.col("tier") == "high", F.col("n"))).alias("high_tier_count"),
        F.max(F.when(F.col("tier") == "low", F.col("n"))).alias("low_tier_count"))
    text = tr.comparison_table_text(res["prevalence"], res["numeric"], by=by)
    mc = metric_columns or {}
    col_expr = F.lit(None).cast("string")
    for k, v in mc.items():
        col_expr = F.when(F.col("metric") == k, F.lit(v)).otherwise(col_expr)
    out = (res["thresholds"].join(cnt, keys + ["metric"]).join(text, keys + ["metric"])
           .where(F.col("high_tier_count").isNotNull() & F.col("low_tier_count").isNotNull()))
    return out.select(*keys, "metric", col_expr.alias("metric_column"),
                      *(["high_threshold", "low_threshold"] if raw_thresholds else []),
                      fixed_round("high_threshold", 2).alias("high_tier_threshold"),
                      fixed_round("low_threshold", 2).alias("low_tier_threshold"),
                      "high_tier_count", "low_tier_count",
                      F.lit(top).alias("top_percentile"), F.lit(bottom).alias("bottom_percentile"),
                      "comparison_text")


def tier_record(res: dict[str, DataFrame], area: str = "all", top: int = 25, bottom: int = 25,
                metric_columns: Mapping[str, str] | None = None) -> DataFrame:
    """The ``write_tier_stats`` record, one nested row per metric: thresholds,
    counts, percentiles, and both comparisons in their rank order (at most the
    number of amenities and numeric columns per row)."""
    base = tier_report(res, top, bottom, metric_columns=metric_columns).drop("comparison_text")

    def listed(df, order, name, *cols):
        rows = df.groupBy("metric").agg(F.array_sort(F.collect_list(F.struct(order, *cols))).alias(name))
        return rows.withColumn(name, F.transform(name, lambda x: F.struct(*[x[c].alias(c) for c in cols])))
    diffs = "difference"
    amen = listed(res["prevalence"], "rank", "amenity_comparison", "amenity", "high_tier_pct", "low_tier_pct", diffs)
    nums = listed(res["numeric"], "attribute_pos", "numeric_comparison", "attribute", "high_tier_avg", "low_tier_avg", diffs)
    return base.join(amen, "metric", "left").join(nums, "metric", "left").select(
        F.lit(area).alias("zipcode"), *base.columns, "amenity_comparison", "numeric_comparison")


def tier_report_markdown(report: DataFrame, area_label: str, metric_config=None) -> DataFrame:
    """One Markdown report per metric: title, area, both tier thresholds with
    counts, then the comparison block as the body (the model's insight text
    is appended downstream when it exists)."""
    from staylens.functions.scalar import threshold_label
    cfg = metric_config or tr.METRIC_CONFIG
    title = F.lit(None).cast("string")
    hi = F.lit(None).cast("string")
    lo = F.lit(None).cast("string")
    for k, v in cfg.items():
        is_k = F.col("metric") == k
        title = F.when(is_k, F.lit(v["display_name"])).otherwise(title)
        hi = F.when(is_k, threshold_label("high_tier_threshold", v["unit"])).otherwise(hi)
        lo = F.when(is_k, threshold_label("low_tier_threshold", v["unit"])).otherwise(lo)
    text = F.concat(
        F.lit("# "), F.coalesce(title, F.col("metric")), F.lit(" Correlation Analysis\n\n**Zipcode:** "),
        F.lit(area_label), F.lit("\n\n**High Tier:** "), hi, F.lit(" (top "), F.col("top_percentile").cast("string"),
        F.lit("%, n="), F.col("high_tier_count").cast("string"), F.lit(")\n\n**Low Tier:** "), lo,
        F.lit(" (bottom "), F.col("bottom_percentile").cast("string"), F.lit("%, n="),
        F.col("low_tier_count").cast("string"), F.lit(")\n\n---\n\n"), F.col("comparison_text"))
    return report.select("metric", text.alias("report"))


def tier_insight_prompts(report: DataFrame, samples: DataFrame, template: str, area_label: str,
                         units: Mapping[str, str] | None = None) -> DataFrame:
    """The per-metric insights request: thresholds as labels ('$x.xx' or
    'x.x%'), percentiles, the comparison block and up to three sample
    descriptions per tier joined by blank lines ('No descriptions
    available.' when a tier has none).  ``samples`` comes from
    :func:`staylens.operators.prompts.sample_descriptions`; every list is
    bounded by the sample size."""
    from staylens.functions.scalar import fill_template, threshold_label
    from staylens.plans.templates import NO_DESCRIPTIONS
    units = units or {k: v["unit"] for k, v in tr.METRIC_CONFIG.items()}

    def block(tier):
        items = F.array_sort(F.collect_list(F.when(F.col("tier") == tier, F.struct("sample_rank", "sample"))))
        return F.array_join(F.transform(items, lambda x: x["sample"]), "\n\n")
    s = samples.groupBy("metric").agg(block("high").alias("_hi"), block("low").alias("_lo"))
    j = report.join(s, "metric", "left")
    hi_lbl = F.lit(None).cast("string")
    lo_lbl = F.lit(None).cast("string")
    for m, unit in units.items():
        hi_lbl = F.when(F.col("metric") == m, threshold_label("_hi_raw", unit)).otherwise(hi_lbl)
        lo_lbl = F.when(F.col("metric") == m, threshold_label("_lo_raw", unit)).otherwise(lo_lbl)

    def or_none(c):
        return F.when(F.coalesce(F.length(c), F.lit(0)) > 0, F.col(c)).otherwise(F.lit(NO_DESCRIPTIONS))
    j = j.withColumnsRenamed({"high_threshold": "_hi_raw", "low_threshold": "_lo_raw"})
    prompt = fill_template(F.lit(template), {
        "ZIPCODE": F.lit(area_label), "HIGH_THRESHOLD": hi_lbl, "LOW_THRESHOLD": lo_lbl,
        "TOP_PERCENTILE": F.col("top_percentile").cast("string"),
        "BOTTOM_PERCENTILE": F.col("bottom_percentile").cast("string"),
        "FEATURE_COMPARISON": F.col("comparison_text"),
        "HIGH_TIER_DESCRIPTIONS": or_none("_hi"), "LOW_TIER_DESCRIPTIONS": or_none("_lo")})
    return j.select("metric", prompt.alias("prompt"))
