"""Review ratings, counts and review/summary filters (sections 2.3, 2.5, 2.6).

All aggregations are plain ``groupBy`` + built-in aggregates, so Spark runs a
map-side partial aggregate before the shuffle: a listing holding a third of
all reviews still ships one partial row per map task, not its reviews.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.scalar import combined_review, fixed_round


def _keys(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def listing_mean_rating(reviews: DataFrame, key: str = "listing_id", rating: str = "rating",
                        by: Sequence[str] | str | None = None) -> DataFrame:
    """sum(rating, NULL as 0) / count(*) rounded to 4 dp -- NULLs stay in the denominator.

    Returns ``by.. , key, mean_rating, n_reviews``.
    """
    g = _keys(by) + [key]
    return reviews.groupBy(*g).agg(
        fixed_round(F.sum(F.coalesce(F.col(rating).cast("double"), F.lit(0.0))) / F.count(F.lit(1)), 4)
        .alias("mean_rating"),
        F.count(F.lit(1)).alias("n_reviews"),
    )


def overall_mean_rating(reviews: DataFrame, key: str = "listing_id", rating: str = "rating",
                        by: Sequence[str] | str | None = None) -> DataFrame:
    """Macro mean of the rounded per-listing means, rounded to 4 dp.

    ``by=None`` gives one global row (the reference mixes every area);
    an empty input gives NULL instead of a division error.
    """
    per = listing_mean_rating(reviews, key, rating, by)
    return per.groupBy(*_keys(by)).agg(
        fixed_round(F.avg("mean_rating"), 4).alias("overall_mean"),
        F.count(F.lit(1)).alias("n_listings"),
    )


def above_mean_listings(reviews: DataFrame, key: str = "listing_id", rating: str = "rating",
                        by: Sequence[str] | str | None = None) -> DataFrame:
    """Listings whose mean rating is above their area's (or the global) macro mean."""
    per = listing_mean_rating(reviews, key, rating, by)
    overall = per.groupBy(*_keys(by)).agg(fixed_round(F.avg("mean_rating"), 4).alias("overall_mean"))
    if _keys(by):
        joined = per.join(overall, _keys(by))  # one row per area: small side, AQE broadcasts it
    else:
        joined = per.withColumn("overall_mean", F.lit(overall.first()["overall_mean"]))
    return joined.where(F.col("mean_rating") > F.col("overall_mean"))


def review_counts(reviews: DataFrame, key: str = "listing_id") -> DataFrame:
    return reviews.groupBy(key).agg(F.count(F.lit(1)).alias("review_count"))


def min_reviews_filter(reviews: DataFrame, key: str = "listing_id", threshold: int = 5) -> DataFrame:
    """Keep the reviews of listings that have at least ``threshold`` reviews."""
    counts = review_counts(reviews, key).where(F.col("review_count") >= threshold).select(key)
    return reviews.join(counts, key, "left_semi")


def with_combined_review(reviews: DataFrame, rating: str = "rating", review: str = "review",
                         out: str = "combined_review") -> DataFrame:
    return reviews.withColumn(out, combined_review(rating, review))


def record_field(record, name: str, cast: str, default) -> F.Column:
    """Field of a VARIANT record: ``default`` where the record lacks the key,
    NULL where the key holds an explicit null."""
    v = F.try_variant_get(record, f"$.{name}", "variant")
    return F.when(v.isNull(), F.lit(default).cast(cast)).when(~F.is_variant_null(v), F.try_variant_get(record, f"$.{name}", cast))


def normalize_reviews(raw: DataFrame, key: str = "listing_id", record: str = "record") -> DataFrame:
    """Raw review records -> ``key, review, rating``.

    With a VARIANT column ``record`` each record is judged by its own keys:
    ``comments`` becomes ``review``; an absent text gives '' and an absent rating
    0, while an explicit null stays NULL.  Other columns are kept.  A frame that
    has the fields as columns cannot tell the two apart: a column it lacks gives
    the default, NULL in one it has stays NULL.  Listings with no reviews
    produce no rows (the exploded array is empty).
    """
    if record in raw.columns:
        rest = [c for c in raw.columns if c not in (key, record, "review", "rating")]
        return raw.select(key, *rest, record_field(F.col(record), "comments", "string", "").alias("review"),
                          record_field(F.col(record), "rating", "double", 0).alias("rating"))
    cols = set(raw.columns)
    review = F.col("comments") if "comments" in cols else F.col("review") if "review" in cols else F.lit("")
    rating = F.col("rating") if "rating" in cols else F.lit(0)
    return raw.select(key, review.cast("string").alias("review"), rating.alias("rating"))


def empty_summary_filter(summaries: DataFrame, col: str = "summary") -> DataFrame:
    """Drop summaries that are NULL or ''."""
    return summaries.where(F.col(col).isNotNull() & (F.length(col) > 0))


def incomplete_summary_filter(summaries: DataFrame, col: str = "summary") -> DataFrame:
    """Summaries containing '?' need another pass."""
    return summaries.where(F.col(col).contains("?"))


def limit_listings(listings: DataFrame, n: int, key: str = "listing_id") -> DataFrame:
    """First ``n`` listings in key order (n larger than the total keeps all).

    Spark plans ``orderBy + limit`` as a TakeOrderedAndProject: each task
    keeps its own top ``n`` and only those reach the final merge.
    """
    return listings.select(key).distinct().orderBy(key).limit(n)
