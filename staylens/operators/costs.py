"""Model request cost accounting (sections 2.5, 2.7, 2.9).

A request log is a table (``session, listing_id, prompt, response, success,
cached, ...``); sessions are ``groupBy(session)`` aggregates, so any number of
requests per session is partial-aggregated on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.scalar import estimate_tokens, fixed_round, request_cost

LAST_N_SESSIONS = 100


def request_costs(requests: DataFrame, prompt: str = "prompt", response: str = "response",
                  reviews: str | None = None, cached: str = "cached") -> DataFrame:
    """Per request: input/output tokens (length // 4 of the text sent and
    received; output 0 without a response) and cost (cached -> 0; failed,
    uncached requests are still charged for their input)."""
    inp = F.col(prompt) if reviews is None else F.concat(F.col(prompt), F.array_join(F.col(reviews), "\n"))
    in_tok = F.floor(F.length(F.coalesce(inp, F.lit(""))) / 4).cast("long")
    out_tok = F.when(F.col(response).isNotNull() & (F.length(response) > 0),
                     F.floor(F.length(response) / 4)).otherwise(F.lit(0)).cast("long")
    return requests.withColumns({"input_tokens": in_tok, "output_tokens": out_tok}).withColumn(
        "cost", request_cost("input_tokens", "output_tokens", cached))


def request_cost_session(costed: DataFrame, session: str = "session", key: str = "listing_id",
                         success: str = "success", cached: str = "cached",
                         strip_merge_suffix: bool = False) -> DataFrame:
    """Session summary: counts, cache rate (1 dp), unique listings, token and
    cost sums over uncached requests, cost per listing (4 dp) and per 100
    listings (2 dp), with max(1, n) denominators.

    Merge requests are logged as listing '<id>_merge' (counted as another
    listing, as the reference does); ``strip_merge_suffix`` counts them under
    their listing instead."""
    unc = ~F.col(cached)
    n_req = F.count(F.lit(1))
    hits = F.sum(F.when(F.col(cached), 1).otherwise(0))
    lid = F.col(key).cast("string")
    listings = F.count_distinct(F.regexp_replace(lid, "_merge$", "") if strip_merge_suffix else F.col(key))
    in_t = F.sum(F.when(unc, F.col("input_tokens")).otherwise(0))
    out_t = F.sum(F.when(unc, F.col("output_tokens")).otherwise(0))
    cost = F.sum(F.when(unc, F.col("cost")).otherwise(0.0))
    agg = costed.groupBy(session).agg(
        n_req.alias("total_requests"),
        F.sum(F.when(F.col(success), 1).otherwise(0)).alias("successful_requests"),
        F.sum(F.when(F.col(success), 0).otherwise(1)).alias("failed_requests"),
        hits.alias("cache_hits"), listings.alias("unique_listings"),
        in_t.alias("total_input_tokens"), out_t.alias("total_output_tokens"), cost.alias("_cost"))
    den = F.greatest(F.lit(1), F.col("unique_listings"))
    return agg.select(
        session, "total_requests", "successful_requests", "failed_requests", "cache_hits",
        fixed_round(F.col("cache_hits") / F.greatest(F.lit(1), F.col("total_requests")) * 100.0, 1)
        .alias("cache_hit_rate"),
        "unique_listings", "total_input_tokens", "total_output_tokens",
        (F.col("total_input_tokens") + F.col("total_output_tokens")).alias("total_tokens"),
        fixed_round("_cost", 4).alias("total_cost"),
        fixed_round(F.col("_cost") / den, 4).alias("average_cost_per_listing"),
        fixed_round(F.col("_cost") * 100.0 / den, 2).alias("estimated_cost_per_100_listings"))


def historical_cost(sessions: DataFrame, as_of, days: int = 30, start: str = "session_start",
                    cost: str = "total_cost", listings: str = "listings", requests: str = "total_requests") -> DataFrame:
    """Sessions started within ``days`` of ``as_of``: totals and averages
    (one row; ``no_data`` when nothing qualifies)."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days))
    recent = sessions.where(F.col(start) >= cutoff)
    agg = recent.agg(F.count(F.lit(1)).alias("sessions"), F.sum(cost).alias("_c"),
                     F.sum(listings).alias("total_listings"), F.sum(requests).alias("total_requests"))
    return agg.select(
        F.lit(days).alias("days"), (F.col("sessions") == 0).alias("no_data"), "sessions",
        fixed_round(F.coalesce("_c", F.lit(0.0)), 4).alias("total_cost"),
        F.coalesce("total_listings", F.lit(0)).cast("long").alias("total_listings"),
        F.coalesce("total_requests", F.lit(0)).cast("long").alias("total_requests"),
        fixed_round(F.coalesce("_c", F.lit(0.0)) / F.greatest(F.lit(1), F.coalesce("total_listings", F.lit(0))), 4)
        .alias("average_cost_per_listing"),
        fixed_round(F.coalesce("_c", F.lit(0.0)) / F.greatest(F.lit(1), F.col("sessions")), 4)
        .alias("average_cost_per_session"))


def last_n_sessions(sessions: DataFrame, order_col: str, n: int = LAST_N_SESSIONS,
                    tie: str | None = None) -> DataFrame:
    """Keep the ``n`` most recent sessions (a global top-k: each task forwards
    only its own ``n`` rows).  Sessions of the same start go by ``tie``, latest
    value first; without it by all their other columns, so a rerun keeps the
    same rows."""
    if tie is not None and tie not in sessions.columns:
        raise ValueError(f"unknown tie-break column {tie}")
    ties = [tie] if tie else [c for c in sorted(sessions.columns) if c != order_col]
    order = [F.col(c).desc() for c in [order_col, *ties]]
    w = Window.orderBy(*order)
    return sessions.orderBy(*order).limit(n).withColumn("recency", F.row_number().over(w))
