"""Pipeline B: reviews -> listing prompts (chunked) -> area prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.scalar import estimate_tokens, fill_template, fixed_round
from staylens.operators import packing as pk
from staylens.operators.prompts import area_summaries
from staylens.plans.common import reuse

# Placeholders filled in the listing and area prompt templates.
LISTING_TEMPLATE = ("Summarize the guest reviews of a listing in {ZIP_CODE_HERE} ({ISO_CODE_HERE}). "
                    "The listing's mean rating is {RATING_AVERAGE_HERE}; the area mean is {OVERALL_MEAN}.")
AREA_TEMPLATE = ("Summarize the listings of area {ZIP_CODE_HERE} ({ISO_CODE_HERE}); "
                 "the overall mean rating is {OVERALL_MEAN}.")
REVIEW_THRESHOLD = 5


def listing_stats(reviews: DataFrame, key: str = "listing_id", rating: str = "rating") -> DataFrame:
    """One pass: mean rating (4 dp, NULL as 0 in the sum), review count, and
    whether the listing's ratings render as floats -- pandas renders a rating
    column with any missing or fractional value as '5.0', else as '5'."""
    r = F.col(rating).cast("double")
    return reviews.groupBy(key).agg(
        fixed_round(F.sum(F.coalesce(r, F.lit(0.0))) / F.count(F.lit(1)), 4).alias("mean_rating"),
        F.count(F.lit(1)).alias("n_reviews"),
        F.max(F.when(r.isNull() | (r != F.floor(r)), 1).otherwise(0)).alias("_floaty"))


def rating_text(rating: str = "rating") -> F.Column:
    r = F.col(rating).cast("double")
    return F.when(F.col("_floaty") == 1, r.cast("string")).otherwise(r.cast("long").cast("string"))


def review_pack(reviews: DataFrame, order_cols: Sequence[str], area_of: DataFrame | None = None,
                key: str = "listing_id", rating: str = "rating", review: str = "review",
                template: str = LISTING_TEMPLATE, iso_code: str = "us", threshold: int = REVIEW_THRESHOLD,
                limit: int = pk.CHUNK_TOKEN_LIMIT, mean_by_area: bool = False) -> DataFrame:
    """Per listing: mean rating, global macro mean, threshold, filled template,
    combined '<rating> <review>' items packed under the token limit, one
    prompt row per chunk (``key, chunk_no, n_chunks, n_items, prompt``).

    Plan: one partial-aggregated pass builds the per-listing table (materialised
    once: it feeds the macro mean and the prompts);
    one join attaches it to the reviews; packing and prompt assembly follow.
    """
    stats = reuse(listing_stats(reviews, key, rating))
    if area_of is not None:
        stats = reuse(stats.join(area_of.select(key, "area"), key, "left"))
    else:
        stats = stats.withColumn("area", F.lit(None).cast("string"))
    if mean_by_area:
        # macro mean per area (one row per area), attached by an equi-join
        per_area = stats.groupBy("area").agg(fixed_round(F.avg("mean_rating"), 4).alias("_overall"))
        keep = stats.where(F.col("n_reviews") >= threshold).join(per_area, "area", "left")
        overall_txt = F.col("_overall").cast("string")
    else:
        # the reference's form: one macro mean over every listing loaded
        overall = stats.agg(fixed_round(F.avg("mean_rating"), 4)).first()[0]
        keep = stats.where(F.col("n_reviews") >= threshold)
        overall_txt = F.lit(str(overall))
    prompt = fill_template(F.lit(template), {
        "ZIP_CODE_HERE": F.col("area"), "ISO_CODE_HERE": F.lit(iso_code),
        "RATING_AVERAGE_HERE": F.col("mean_rating").cast("string"),
        "OVERALL_MEAN": overall_txt})
    heads = keep.select(key, "_floaty", prompt.alias("base_prompt")) \
        .withColumn("prompt_tokens", estimate_tokens("base_prompt"))
    # only the per-listing numbers travel with the reviews; the prompt text is
    # attached per chunk after packing
    items = reviews.join(heads.select(key, "_floaty", "prompt_tokens"), key)
    items = items.withColumn("text", F.concat(rating_text(rating), F.lit(" "), F.col(review)))
    ch = pk.chunk_reviews(items, key, list(order_cols), "text", "prompt_tokens", limit)
    return pk.chunk_prompt(ch, heads, key, limit=limit)


def area_prompts(summaries: DataFrame, overall_mean: float | None = None, n: int | None = None,
                 area: str = "area", key: str = "listing_id", summary: str = "summary",
                 template: str = AREA_TEMPLATE, iso_code: str = "us",
                 limit: int = pk.CHUNK_TOKEN_LIMIT) -> DataFrame:
    """Area requests: the first ``n`` non-empty summaries per area, packed under
    the token limit like reviews (``area, chunk_no, n_chunks, n_items, prompt``)."""
    pack = area_summaries(summaries, n, area, key, summary).where(F.col(area).isNotNull())
    mean_txt = F.lit(str(overall_mean if overall_mean is not None else 0.0))
    base = fill_template(F.lit(template), {"ZIP_CODE_HERE": F.col(area).cast("string"),
                                           "ISO_CODE_HERE": F.lit(iso_code), "OVERALL_MEAN": mean_txt})
    heads = pack.groupBy(area).agg(F.count(F.lit(1)).alias("n_properties")) \
        .withColumn("base_prompt", base).withColumn("prompt_tokens", estimate_tokens("base_prompt"))
    items = pack.withColumn("prompt_tokens", estimate_tokens(base))
    ch = pk.chunk_reviews(items, area, [key], "rendered", "prompt_tokens", limit)
    out = pk.chunk_prompt(ch, heads, area, limit=limit)
    return out.join(heads.select(area, "n_properties"), area)


# ---------------------------------------------------------------------------
# fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
AREA_REPORT = "# Area Summary: %s\n\n**ISO Code:** %s\n\n**Properties Analyzed:** %d\n\n---\n\n"


def area_report_markdown(responses: DataFrame, counts: DataFrame, iso_code: str = "us", area: str = "area",
                         text: str = "response") -> DataFrame:
    """One Markdown report per area: area, ISO code, the number of properties
    summarised (``counts``: area, n_properties) and the model's text.  Areas
    without a response, or without a property, have no report."""
    j = responses.where(F.col(text).isNotNull()).join(counts, area)
    return j.select(area, F.concat(F.format_string(AREA_REPORT, F.col(area).cast("string"), F.lit(iso_code), "n_properties"),
                                   F.col(text)).alias("report"))
