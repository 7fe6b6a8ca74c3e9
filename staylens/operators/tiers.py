"""Top/bottom tier comparison (sections 2.5-2.7, pipeline C).

Plan shape (per call, whatever the data size):

1. ``tier_thresholds``: exact linear-interpolated quantiles of every group and
   metric by repeated histogram refinement; memory is the bin count.
2. ``tier_assign``: thresholds are attached as literals (global) or through a
   join on the grouping keys (one row per group and metric), then each row is
   exploded into the tiers it belongs to -- inclusive on both sides, so a row
   can be in both tiers.
3. ``tier_feature_stats``: ONE grouped aggregate over the tiered rows computes
   every amenity count and every numeric mean (wide aggregate, map-side
   combined); only the tiny per-tier result is unpivoted and ranked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.scalar import display_name, fixed_round, presence_sql, signed

# ---------------------------------------------------------------------------
# fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
# Amenity columns compared between tiers, in declared order (ties keep it).
AMENITY_COLUMNS = [
    "SYSTEM_PETS", "SYSTEM_JACUZZI", "SYSTEM_POOL", "SYSTEM_FIREPLACE", "SYSTEM_WI_FI",
    "SYSTEM_WORKSPACE", "SYSTEM_GRILL", "SYSTEM_FIREPIT", "SYSTEM_WASHER", "SYSTEM_DRYER",
    "SYSTEM_DISHWASHER", "SYSTEM_TV", "SYSTEM_SNOWFLAKE", "SYSTEM_SUPERHOST", "SYSTEM_POOL_TABLE",
    "SYSTEM_VIDEO_GAME", "SYSTEM_SAUNA", "SYSTEM_EV_CHARGER", "SYSTEM_VIEW_MOUNTAIN",
    "SYSTEM_VIEW_OCEAN", "SYSTEM_HAMMOCK", "SYSTEM_BEACH",
]
# Numeric attributes averaged per tier.
NUMERIC_COLUMNS = ["capacity", "bedrooms", "beds", "bathrooms"]
# Metric key -> matrix column, display name, unit.
METRIC_CONFIG = {
    "adr": {"column": "ADR", "display_name": "Average Daily Rate", "unit": "$"},
    "occupancy": {"column": "Occ_Rate_Based_on_Avail", "display_name": "Occupancy Rate", "unit": "%"},
}
# Heads of the two comparison tables.
AMENITY_HEAD = ("### Amenity Prevalence (% of properties with feature)\n\n"
                "| Amenity | High Tier | Low Tier | Difference |\n"
                "|---------|-----------|----------|------------|")
NUMERIC_HEAD = ("### Numeric Averages\n\n"
                "| Attribute | High Tier Avg | Low Tier Avg | Difference |\n"
                "|-----------|---------------|--------------|------------|")
TOP_FEATURES = 15
MIN_VALID_ROWS = 4


def _keys(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def valid_metric(col: str | Column, numeric: bool = False) -> Column:
    """to-numeric with coercion; valid iff not NULL and > 0 (returns the double or NULL).

    ``numeric=True`` skips the string round trip for columns already typed."""
    c = F.col(col) if isinstance(col, str) else col
    v = c.cast("double") if numeric else c.cast("string").try_cast("double")
    return F.when(v > 0, v)


def _is_num(df: DataFrame, c: str) -> bool:
    from pyspark.sql.types import NumericType
    return c in df.columns and isinstance(df.schema[c].dataType, NumericType)


def valid_metric_filter(df: DataFrame, col: str) -> DataFrame:
    return df.where(valid_metric(col).isNotNull())


def tier_thresholds(df: DataFrame, metrics: Mapping[str, str], top: int = 25, bottom: int = 25,
                    by: Sequence[str] | str | None = None) -> DataFrame:
    """Exact thresholds per (group, metric): ``high_threshold = q(1 - top/100)``,
    ``low_threshold = q(bottom/100)`` over valid rows; groups with fewer than four
    valid rows produce no row.

    ``metrics`` maps metric key -> column.  One scan handles every metric: the
    columns are unpivoted and the numbers written once (:func:`exact_quantiles`).
    """
    keys = _keys(by)
    long = _metric_long(df, metrics, keys)
    q = exact_quantiles(long, [*keys, "metric"], "value", [1 - top / 100.0, bottom / 100.0])
    return q.where(F.col("n") >= MIN_VALID_ROWS).select(
        *keys, "metric", F.col("q0").alias("high_threshold"), F.col("q1").alias("low_threshold"), F.col("n").alias("n_valid"))


BINS = 1024     # counters per range and round
RANKED = 10_000  # a range of at most so many values is ranked as it is


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles per group, exact, without a per-group task.

    Each probability needs the values at two ranks.  A rank's range starts as
    its group's [min, max]; while a range holds more than ``RANKED`` values, one
    pass counts the values of every such range of all groups in ``BINS`` bins
    (count, min and max per bin, combined on the map side) and the bin with the
    rank becomes its range.  Ranges always shrink, because the largest value has
    a bin of its own.  What is left is ranked, at most ``RANKED`` values per
    range.  NULL and NaN values take no part.  Returns ``group.., n, q0, q1, ...``.
    """
    from staylens.plans.common import written
    g = F.to_json(F.struct(*group)) if group else F.lit("")
    values = written(df.select(*group, g.alias("_g"), F.col(value).cast("double").alias("_v"))
                     .where(F.col("_v").isNotNull() & ~F.isnan("_v")), "quantile-values")
    stats = values.groupBy("_g", *group).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    places = []
    for k, p in enumerate(probs):
        r = F.lit(float(p)) * (F.col("n") - 1)
        places += [F.struct(F.lit(2 * k).alias("k"), F.floor(r).alias("rank")),
                   F.struct(F.lit(2 * k + 1).alias("k"), F.ceil(r).alias("rank"))]
    ranks = written(stats.select("_g", *group, "n", "lo", "hi", F.lit(0).cast("long").alias("before"),
                                 F.col("n").alias("size"), F.inline(F.array(*places))), "quantile-ranks")
    wide = (F.col("size") > RANKED) & (F.col("lo") < F.col("hi"))
    values = values.select("_g", "_v")
    while ranks.where(wide).limit(1).count():
        inside = values.join(ranks.where(wide).select("_g", "lo", "hi").distinct(), "_g").where(
            F.col("_v").between(F.col("lo"), F.col("hi")))
        at = F.floor((F.col("_v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * (BINS - 1))
        at = F.when(F.col("_v") >= F.col("hi"), F.lit(BINS - 1)).otherwise(F.greatest(F.lit(0), F.least(F.lit(BINS - 2), at)))
        bins = inside.groupBy("_g", "lo", "hi", at.alias("bin")).agg(
            F.count(F.lit(1)).alias("c"), F.min("_v").alias("a"), F.max("_v").alias("z"))
        below = Window.partitionBy("_g", "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("under", F.coalesce(F.sum("c").over(below), F.lit(0)))
        place = F.col("rank") - F.col("before") - F.col("under")
        found = ranks.where(wide).join(bins, ["_g", "lo", "hi"]).where((place >= 0) & (place < F.col("c")))
        ranks = written(found.select("_g", *group, "n", F.col("a").alias("lo"), F.col("z").alias("hi"),
                                     (F.col("before") + F.col("under")).alias("before"), F.col("c").alias("size"), "k", "rank")
                        .unionByName(ranks.where(~wide)), "quantile-ranks")
    ranges = ranks.where("lo < hi").select("_g", "lo", "hi", "before").distinct()
    order = Window.partitionBy("_g", "lo", "hi").orderBy("_v")
    ranked = values.join(ranges, "_g").where(F.col("_v").between(F.col("lo"), F.col("hi"))).withColumn(
        "rank", F.col("before") + F.row_number().over(order) - 1).select("_g", "lo", "hi", "rank", "_v")
    picked = ranks.join(ranked, ["_g", "lo", "hi", "rank"], "left").withColumn("_v", F.coalesce("_v", "lo"))
    out = picked.groupBy("_g", *group, "n").agg(*[F.max(F.when(F.col("k") == k, F.col("_v"))).alias(f"v{k}")
                                                  for k in range(2 * len(probs))])
    qs = []
    for k, p in enumerate(probs):
        r = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"v{2 * k}"), F.col(f"v{2 * k + 1}")
        qs.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (r - F.floor(r))).alias(f"q{k}"))
    return out.select(*group, "n", *qs)


def _metric_long(df: DataFrame, metrics: Mapping[str, str], keys: list[str],
                 extra: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), valid_metric(c, _is_num(df, c)).alias("value"))
                      for m, c in metrics.items()])
    return (df.select(*keys, *extra, F.inline(pairs))
              .where(F.col("value").isNotNull()))


def tier_assign(df: DataFrame, metrics: Mapping[str, str], thresholds: DataFrame | None = None,
                top: int = 25, bottom: int = 25, by: Sequence[str] | str | None = None) -> DataFrame:
    """Rows of ``df`` exploded into their tiers: adds ``metric, tier, value``.

    ``tier`` is 'high' when value >= high threshold and 'low' when value <= low
    threshold (inclusive; a row may be in both; the middle is dropped).  Rows
    of a metric whose group has no threshold row produce nothing.
    """
    keys = _keys(by)
    if thresholds is None:
        thresholds = tier_thresholds(df, metrics, top, bottom, by)
    if not keys:
        # one row per metric: bounded by the metric list -> literals, no join
        th = {r["metric"]: (r["high_threshold"], r["low_threshold"]) for r in thresholds.collect()}
        entries = []
        for m, c in metrics.items():
            if m not in th:
                continue
            v = valid_metric(c, _is_num(df, c))
            hi, lo = th[m]
            for tier, cond in (("high", v >= F.lit(hi)), ("low", v <= F.lit(lo))):
                entries.append(F.when(v.isNotNull() & cond,
                                      F.struct(F.lit(m).alias("metric"), F.lit(tier).alias("tier"),
                                               v.alias("value"))))
        if not entries:
            return df.select("*", F.lit(None).cast("string").alias("metric"),
                             F.lit(None).cast("string").alias("tier"),
                             F.lit(None).cast("double").alias("value")).where(F.lit(False))
        arr = F.filter(F.array(*entries), lambda x: x.isNotNull())
        return df.select("*", F.inline(arr))
    # grouped: explode per metric, then an equi-join on (keys, metric) with the
    # thresholds table (one row per group and metric; AQE broadcasts it when
    # its measured size is under the broadcast threshold, else sort-merge).
    cols = df.columns
    long = _metric_long(df, metrics, keys, extra=[c for c in cols if c not in keys])
    j = long.join(thresholds.select(*keys, "metric", "high_threshold", "low_threshold"), keys + ["metric"])
    tiers = F.filter(F.array(
        F.when(F.col("value") >= F.col("high_threshold"), F.lit("high")),
        F.when(F.col("value") <= F.col("low_threshold"), F.lit("low"))), lambda x: x.isNotNull())
    return j.select(*cols, "metric", F.explode(tiers).alias("tier"), "value")


def tier_counts(tiered: DataFrame, by: Sequence[str] | str | None = None) -> DataFrame:
    return tiered.groupBy(*_keys(by), "metric", "tier").agg(F.count(F.lit(1)).alias("n"))


def tier_feature_stats(tiered: DataFrame, amenities: Sequence[str], numeric: Sequence[str],
                       by: Sequence[str] | str | None = None) -> DataFrame:
    """One wide aggregate per (group, metric, tier): row count, amenity counts,
    numeric sums/counts.  Output is tiny (groups x metrics x 2 rows)."""
    keys = _keys(by)
    cols = set(tiered.columns)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(a for a in amenities if a in cols):
        aggs.append(F.expr(f"sum({presence_sql(a)})").alias(f"a{i}"))
    for i, c in enumerate(c for c in numeric if c in cols):
        v = F.col(c).cast("string").try_cast("double")
        aggs.append(F.avg(v).alias(f"m{i}"))
    return tiered.groupBy(*keys, "metric", "tier").agg(*aggs)


def _pivot_tiers(stats: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, metric, tier, fields..) -> (keys, metric, hi_*, lo_*) via conditional max."""
    out = [F.expr(f"max({f}) FILTER (WHERE tier = '{t}') AS {p}_{f}") for f in fields for t, p in (("high", "hi"), ("low", "lo"))]
    return stats.groupBy(*keys, "metric").agg(*out)


def amenity_prevalence(tiered: DataFrame, amenities: Sequence[str] = AMENITY_COLUMNS,
                       by: Sequence[str] | str | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Per (group, metric, amenity): % of each tier holding it (1 dp), the
    difference (1 dp, from the unrounded values) and ``rank`` by |rounded
    difference| desc, ties in declared amenity order.

    Amenities missing from the columns are skipped.  Only metrics that have
    both tiers produce rows (like the reference's early exit).
    """
    keys = _keys(by)
    present = [a for a in amenities if a in set(tiered.columns)]
    if stats is None:
        stats = tier_feature_stats(tiered, present, [], by)
    fields = ["n"] + [f"a{i}" for i in range(len(present))]
    w = _pivot_tiers(stats, keys, fields).where(F.col("hi_n").isNotNull() & F.col("lo_n").isNotNull())
    if not present:
        return w.select(*keys, "metric").where(F.lit(False))
    entries = ", ".join(f"named_struct('amenity', '{a}', 'amenity_pos', {i}, 'hi', hi_a{i}, 'lo', lo_a{i})" for i, a in enumerate(present))
    long = w.select(*keys, "metric", "hi_n", "lo_n", F.expr(f"inline(array({entries}))"))
    hi, lo = F.col("hi") / F.col("hi_n") * 100.0, F.col("lo") / F.col("lo_n") * 100.0
    long = long.select(*keys, "metric", "amenity", "amenity_pos", fixed_round(hi, 1).alias("high_tier_pct"),
                       fixed_round(lo, 1).alias("low_tier_pct"), fixed_round(hi - lo, 1).alias("difference"))
    return rank_by_abs(long, keys + ["metric"], "difference", "amenity_pos")


def rank_by_abs(df: DataFrame, part: Sequence[str], value: str, pos: str, out: str = "rank") -> DataFrame:
    """Stable ranking by |value| desc with ``pos`` (declared order) as tie-break.

    Used on small result tables only (amenities or dimensions per group)."""
    w = Window.partitionBy(*part).orderBy(F.abs(F.col(value)).desc(), F.col(pos))
    return df.withColumn(out, F.row_number().over(w))


def numeric_tier_stats(tiered: DataFrame, numeric: Sequence[str] = NUMERIC_COLUMNS,
                       by: Sequence[str] | str | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Mean per tier of each numeric attribute (to-numeric with coercion, NULLs
    skipped, all-NULL -> 0), rounded to 2 dp; difference from unrounded means."""
    keys = _keys(by)
    present = [c for c in numeric if c in set(tiered.columns)]
    if stats is None:
        stats = tier_feature_stats(tiered, [], present, by)
    fields = ["n"] + [f"m{i}" for i in range(len(present))]
    w = _pivot_tiers(stats, keys, fields).where(F.col("hi_n").isNotNull() & F.col("lo_n").isNotNull())
    entries = []
    for i, c in enumerate(present):
        hi = F.coalesce(F.col(f"hi_m{i}"), F.lit(0.0))
        lo = F.coalesce(F.col(f"lo_m{i}"), F.lit(0.0))
        entries.append(F.struct(F.lit(c).alias("attribute"), F.lit(i).alias("attribute_pos"),
                                fixed_round(hi, 2).alias("high_tier_avg"),
                                fixed_round(lo, 2).alias("low_tier_avg"),
                                fixed_round(hi - lo, 2).alias("difference")))
    if not entries:
        return w.select(*keys, "metric").where(F.lit(False))
    return w.select(*keys, "metric", F.inline(F.array(*entries)))


def top_features(prevalence: DataFrame, k: int = TOP_FEATURES) -> DataFrame:
    return prevalence.where(F.col("rank") <= k)


def tier_sample(tiered: DataFrame, k: int = 3, order_col: str = "ADR", key: str = "listing_id",
                by: Sequence[str] | str | None = None) -> DataFrame:
    """First ``k`` rows of each tier in matrix order (``order_col`` desc, key).

    Implemented as a per-(metric, tier) top-k: the window keeps only k rows
    per partition after the sort, and Spark's ``WindowGroupLimit`` prunes each
    map task to its local top k before the shuffle.
    """
    keys = _keys(by)
    w = Window.partitionBy(*keys, "metric", "tier").orderBy(
        F.col(order_col).cast("string").try_cast("double").desc_nulls_last(), F.col(key))
    return tiered.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= k)


def comparison_table_text(prevalence: DataFrame, numeric: DataFrame, k: int = TOP_FEATURES,
                          by: Sequence[str] | str | None = None) -> DataFrame:
    """Markdown comparison block per (group, metric).  Both inputs are small
    (amenities / attributes per metric), so the per-metric ``collect_list`` is
    bounded by the amenity list, never by the data."""
    keys = _keys(by)
    a_line = F.concat(F.lit("| "), display_name("amenity"), F.lit(" | "),
                      F.col("high_tier_pct").cast("string"), F.lit("% | "),
                      F.col("low_tier_pct").cast("string"), F.lit("% | "),
                      signed("difference", 1, "%%"), F.lit(" |"))
    n_line = F.concat(F.lit("| "), F.initcap(F.replace(F.col("attribute"), F.lit("_"), F.lit(" "))),
                      F.lit(" | "), F.col("high_tier_avg").cast("string"), F.lit(" | "),
                      F.col("low_tier_avg").cast("string"), F.lit(" | "),
                      signed("difference", 2), F.lit(" |"))
    a = (prevalence.where(F.col("rank") <= k)
         .groupBy(*keys, "metric")
         .agg(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("o"), a_line.alias("t")))).alias("al")))
    n = (numeric.groupBy(*keys, "metric")
         .agg(F.array_sort(F.collect_list(F.struct(F.col("attribute_pos").alias("o"), n_line.alias("t"))))
              .alias("nl")))
    j = a.join(n, keys + ["metric"], "full_outer")
    head_a, head_n = F.lit(AMENITY_HEAD), F.lit(NUMERIC_HEAD)
    lines_a = F.transform(F.coalesce(F.col("al"), F.array().cast("array<struct<o:int,t:string>>")),
                          lambda x: x["t"])
    lines_n = F.transform(F.coalesce(F.col("nl"), F.array().cast("array<struct<o:int,t:string>>")),
                          lambda x: x["t"])
    body = F.array_join(F.concat(F.array(head_a), lines_a, F.array(F.lit(""), head_n), lines_n), "\n")
    return j.select(*keys, "metric", body.alias("comparison_text"))
