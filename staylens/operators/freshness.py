"""Output freshness and coverage: expected outputs vs a manifest of written
outputs (sections 2.4, 2.5, 2.8, 2.9).

Expected outputs come from the rows of their id source, expanded by the stage
rules (or a plain stage list) in place -- no join, no shuffle.  Missing / stale outputs are a
``left_anti`` join on (stage, listing) -- both sides hash-partitioned on the
same keys.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.scalar import is_fresh

# ---------------------------------------------------------------------------
# fixed values (must equal the reference for identical results): the outputs of
# each stage.  (stage, ids the output is made per, ids that must exist, names)
# ids: "listing" = listings found by the search, "reviews" = listings with
# reviews, "area" = the area itself
# ---------------------------------------------------------------------------
METRICS = ("adr", "occupancy")
STAGE_RULES = [
    ("search_results", "area", None, ["search_results_{area}.json"]),
    ("comp_sets", "listing", None, ["listing_{id}.json"]),
    ("comp_sets", "area", "listing", ["comp_set_{area}.json"]),
    ("reviews_scrape", "listing", None, ["reviews_{area}_{id}.json"]),
    ("details_scrape", "listing", None, ["property_details_{id}.json"]),
    ("listing_summaries", "reviews", None, ["listing_summary_{area}_{id}.json"]),
    ("details_results", "area", None, [
        "property_amenities_matrix_{area}.csv", "property_amenities_matrix_cleaned_{area}.csv",
        "house_rules_details_{area}.json", "property_descriptions_{area}.json", "neighborhood_highlights_{area}.json"]),
    ("area_summary", "area", None, ["area_summary_{area}.md"]),
    ("correlation_results", "area", None, [
        f"correlation_{kind}_{m}_{{area}}.{end}" for m in METRICS for kind, end in (("stats", "json"), ("insights", "md"))]),
    ("description_analysis", "area", None, ["description_quality_stats_{area}.json", "description_quality_{area}.md"]),
]
STAGES = list(dict.fromkeys(r[0] for r in STAGE_RULES))

# Retry thresholds: more than 20 % missing reviews or 25 % missing metrics.
REVIEW_RETRY_THRESHOLD = 0.20
METRICS_RETRY_THRESHOLD = 0.25


def with_freshness(manifest: DataFrame, as_of, ttl_hours: float, mtime: str = "mtime",
                   enabled: bool = True, force_refresh: bool = False) -> DataFrame:
    return manifest.withColumn("fresh", is_fresh(mtime, F.lit(as_of), ttl_hours, enabled, force_refresh))


def expected_outputs(listings: DataFrame, stages: Sequence[str], key: str = "listing_id",
                     exclude: DataFrame | None = None) -> DataFrame:
    """Every (stage, listing) pair that should have an output.

    ``exclude`` (stage, key) removes pairs that can never have an output --
    e.g. listings known to have zero reviews, which the reference keeps
    expecting forever (so its review stage is never fresh)."""
    exp = listings.select(key).distinct().select(F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage"),
                                                 key)
    if exclude is not None:
        exp = exp.join(exclude.select("stage", key), ["stage", key], "left_anti")
    return exp


def output_name(pattern: str, area: str = "area", key: str = "listing_id") -> F.Column:
    """The output's name: a pattern with the row's area and listing id."""
    parts = re.split(r"(\{area\}|\{id\})", pattern)
    cols = {"{area}": F.col(area).cast("string"), "{id}": F.col(key).cast("string")}
    return F.concat(*[cols.get(p, F.lit(p)) for p in parts if p])


def expected_by_rule(areas: DataFrame, sources: Mapping[str, DataFrame], rules: Sequence = STAGE_RULES,
                     area: str = "area", key: str = "listing_id") -> DataFrame:
    """``stage, area, listing_id, output``: what every stage should have written.

    ``areas`` has a row per area; ``sources`` maps an id source of the rules to
    its (area, listing) rows.  Outputs made per listing take one row per listing
    of their source; those made per area one row with a NULL listing, where the
    rule asks for it only in areas that its source knows.  The rules expand each
    row of a source in place, so the only joins are the area semi joins."""
    frames = {"area": areas.select(area).distinct().withColumn(key, F.lit(None).cast("string"))}
    for name, df in sources.items():
        frames[name] = df.select(area, F.col(key).cast("string").alias(key)).distinct()
    groups: dict[tuple, list] = {}
    for stage, per, needs, patterns in rules:
        groups.setdefault((per, needs), []).extend((stage, p) for p in patterns)
    out = None
    for (per, needs), outputs in groups.items():
        rows = frames[per] if needs is None else frames[per].join(frames[needs].select(area).distinct(), area, "left_semi")
        made = rows.select(area, key, F.inline(F.array(*[
            F.struct(F.lit(stage).alias("stage"), output_name(p, area, key).alias("output")) for stage, p in outputs])))
        out = made if out is None else out.unionByName(made)
    return out.select("stage", area, key, "output")


def missing_outputs(expected: DataFrame, manifest: DataFrame, as_of, ttl_hours: float,
                    key: str = "listing_id") -> DataFrame:
    """Expected (stage, ``key``) pairs without a fresh output (absent or older than the TTL)."""
    fresh = with_freshness(manifest, as_of, ttl_hours).where("fresh").select("stage", key)
    return expected.join(fresh, ["stage", key], "left_anti")


def stage_freshness(expected: DataFrame, manifest: DataFrame, as_of, ttl_hours: float,
                    key: str = "listing_id", enabled: bool = True,
                    force_stages: Sequence[str] = (), groups: DataFrame | None = None) -> DataFrame:
    """Per stage: fresh iff caching is enabled, the stage is not forced, its
    expected set is non-empty and every expected output exists within the TTL.

    ``key`` names the output within its stage.  ``groups`` lists the groups the
    answer is for (its columns, ``stage`` among them, are the grouping): one with
    no expected output gets a row, never fresh.  Without it the stages are those
    of ``expected``."""
    by = ["stage"] if groups is None else groups.columns
    fresh = with_freshness(manifest, as_of, ttl_hours, enabled=enabled).where("fresh").select("stage", key).distinct()
    if force_stages:
        fresh = fresh.where(~F.col("stage").isin(*force_stages))
    j = expected.join(fresh.withColumn("_fresh", F.lit(1)), ["stage", key], "left")
    counts = j.groupBy(*by).agg(F.count(F.lit(1)).alias("expected"), F.count("_fresh").alias("fresh_outputs"))
    if groups is not None:
        counts = groups.distinct().join(counts, by, "left").na.fill(0, ["expected", "fresh_outputs"])
    return counts.withColumn("stage_fresh", (F.col("expected") > 0) & (F.col("fresh_outputs") == F.col("expected")))


def _names(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def resolved_prescan(ids: DataFrame, done: DataFrame, key: str | Sequence[str] = "listing_id") -> DataFrame:
    """Ids that already have an output (existence only, no TTL); ``key`` may name
    several columns, such as stage and listing."""
    return ids.join(done.select(*_names(key)), _names(key), "left_semi")


def id_difference(ids: DataFrame, done: DataFrame, key: str | Sequence[str] = "listing_id") -> DataFrame:
    """Ids still to process."""
    return ids.join(done.select(*_names(key)), _names(key), "left_anti")


def unprocessed_or_stale(items: DataFrame, outputs: DataFrame, as_of, ttl_hours: float,
                         key: str | Sequence[str] = "listing_id", mtime: str = "mtime") -> DataFrame:
    """Items whose listing has no output newer than the TTL."""
    fresh = with_freshness(outputs, as_of, ttl_hours, mtime).where("fresh").select(*_names(key))
    return items.join(fresh, _names(key), "left_anti")


def coverage_gate(expected: DataFrame, done: DataFrame, threshold: float = REVIEW_RETRY_THRESHOLD,
                  by: Sequence[str] = ("stage",), key: str = "listing_id") -> DataFrame:
    """missing / total per group; another pass is needed when it exceeds the threshold."""
    d = done.select(*by, key).distinct().withColumn("_done", F.lit(1))
    j = expected.join(d, [*by, key], "left")
    return j.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col("_done").isNull(), 1).otherwise(0)).alias("missing")).withColumns({
            "missing_rate": F.col("missing") / F.greatest(F.lit(1), F.col("total")),
        }).withColumn("retry", F.col("missing_rate") > F.lit(threshold))
