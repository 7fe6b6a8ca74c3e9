"""Prompt tables and model-response parsing (sections 2.9, 2.10).

The model boundary is a table: prompts go out as rows, responses come back
as rows and are parsed with built-in JSON functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.scalar import fill_template, normalize_description, truncate_sample, word_count


def parse_score_json(df: DataFrame, text_col: str = "response", key: str = "listing_id") -> DataFrame:
    """Model response -> ``key, dimension, score`` for numeric values only.

    Markdown code fences are stripped when the text starts with them; text
    that is not a JSON object (or NULL) gives no rows.  Booleans and strings
    are dropped (numbers only).
    """
    t = F.trim(F.col(text_col))
    fenced = t.startswith("```")
    body = F.when(fenced, F.regexp_replace(F.regexp_replace(t, r"^```(?:json)?\s*", ""), r"\s*```\s*$", "")) \
        .otherwise(t)
    # variant values keep the JSON token type, so '"7"' (a string) and 'true'
    # are told apart from numbers without re-parsing the text
    kv = df.select(key, F.explode(F.from_json(body, "map<string,variant>")).alias("dimension", "v"))
    numeric = F.schema_of_variant("v").rlike(r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)")
    return kv.where(numeric).select(key, "dimension", F.try_variant_get("v", "$", "double").alias("score"))


def description_score_prompts(residuals: DataFrame, descriptions: DataFrame, template: str,
                              key: str = "listing_id", desc_col: str = "description") -> DataFrame:
    """One scoring prompt per listing that has both a residual and a description
    (inner join on the key); '{DESCRIPTION}' and '{PROPERTY_ID}' filled."""
    j = residuals.select(key).join(descriptions.select(key, desc_col), key)
    prompt = fill_template(F.lit(template), {"DESCRIPTION": F.col(desc_col),
                                             "PROPERTY_ID": F.col(key).cast("string")})
    return j.select(key, prompt.alias("prompt"), word_count(desc_col).alias("word_count"))


def join_score_residual(scores: DataFrame, residuals: DataFrame, key: str = "listing_id") -> DataFrame:
    """Scores INNER residuals on the key (not by position)."""
    return scores.join(residuals, key)


def id_intersection(a: DataFrame, b: DataFrame, key: str = "listing_id") -> DataFrame:
    return a.select(key).intersect(b.select(key))


def sample_descriptions(ranked: DataFrame, descriptions: DataFrame, k: int = 3, key: str = "listing_id",
                        rank_col: str = "sample_rank", part: Sequence[str] = ("metric", "tier"),
                        desc_col: str = "description", max_parts: int | None = 3,
                        max_chars: int = 500) -> DataFrame:
    """First ``k`` ranked rows per part, kept only when a description exists (no
    back-fill), rendered as 'Property <id>: <text>' (list cut to ``max_parts``
    parts, text cut to ``max_chars`` + '...')."""
    top = ranked.where(F.col(rank_col) <= k)
    j = top.join(descriptions.select(key, desc_col), key)
    dtype = descriptions.schema[desc_col].dataType.typeName()
    text = normalize_description(desc_col, max_parts) if dtype == "array" else F.col(desc_col)
    return j.select(*part, rank_col, key,
                    F.concat(F.lit("Property "), F.col(key).cast("string"), F.lit(": "),
                             truncate_sample(text, max_chars)).alias("sample"))


def join_topk_scores(top_bottom: DataFrame, scores: DataFrame, descriptions: DataFrame,
                     key: str = "listing_id", desc_col: str = "description") -> DataFrame:
    """Top/bottom premium rows LEFT JOIN scores, INNER JOIN descriptions."""
    return top_bottom.join(scores, key, "left").join(descriptions.select(key, desc_col), key)


# ---------------------------------------------------------------------------
# fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
CORRELATION_HEAD = "| Dimension | Correlation | n |\n|-----------|-------------|---|"
PROPERTY_HEAD = "**Property %s** ([Airbnb listing](%s)) (ADR premium: $%+.0f/night)"
PROPERTY_SCORES = "\n  Scores: "


def _fmt_scores(dims: Sequence[str]) -> Column:
    """'  Scores: dim: value, ...' under the head, where the listing has scores."""
    parts = [F.when(F.col(d).isNotNull(), F.concat(F.lit(f"{d}: "), F.col(d).cast("string"))) for d in dims]
    text = F.concat_ws(", ", *parts)
    return F.when(F.length(text) > 0, F.concat(F.lit(PROPERTY_SCORES), text)).otherwise(F.lit(""))


def synthesis_prompt(r2: DataFrame, correlations: DataFrame, topk: DataFrame, template: str,
                     dims: Sequence[str], area: str = "all", desc_col: str = "description",
                     key: str = "listing_id") -> DataFrame:
    """Final synthesis request: area, r-squared, number of properties, the
    correlation table (title-cased dimensions) and the top / bottom
    descriptions, each with its link, premium and scores.  ``r2`` has ``n`` and
    ``r_squared``.  Every input is already bounded (one r2 row, one row per
    dimension, 2k listings), so the single output row is bounded too."""
    from staylens.functions.scalar import display_name, fixed_round, listing_link
    # numbers are rounded before formatting so no half-way digit is left to the formatter
    corr_line = F.format_string("| %s | %+.3f | %d |", display_name("dimension"), fixed_round("correlation", 3),
                                F.col("n"))
    desc_line = F.concat(F.format_string(PROPERTY_HEAD, F.col(key).cast("string"), listing_link(key), fixed_round("residual", 0)),
                         _fmt_scores(dims), F.lit("\n"), F.col(desc_col), F.lit("\n"))
    # one tagged union + one global aggregate assembles the single row (no joins)
    tagged = (r2.select(F.lit("r2").alias("part"), F.lit(0).alias("o"),
                        F.format_string("%.3f", fixed_round("r_squared", 3)).alias("t"))
              .unionByName(r2.select(F.lit("n").alias("part"), F.lit(0).alias("o"), F.col("n").cast("string").alias("t")))
              .unionByName(correlations.select(F.lit("corr").alias("part"), F.col("rank").cast("int").alias("o"),
                                               corr_line.alias("t")))
              .unionByName(topk.select(F.col("side").alias("part"), F.col("rank").cast("int").alias("o"),
                                       desc_line.alias("t"))))

    def block(part, sep):
        items = F.array_sort(F.collect_list(F.when(F.col("part") == part, F.struct("o", "t"))))
        return F.array_join(F.transform(items, lambda x: x["t"]), sep)
    one = tagged.groupBy().agg(block("r2", "").alias("r2"), block("n", "").alias("n"),
                               F.concat(F.lit(CORRELATION_HEAD + "\n"), block("corr", "\n")).alias("corr_table"),
                               block("top", "\n").alias("top_text"), block("bottom", "\n").alias("bottom_text"))
    prompt = fill_template(F.lit(template), {"ZIPCODE": F.lit(area), "R_SQUARED": F.col("r2"),
                                             "CORRELATION_TABLE": F.col("corr_table"),
                                             "HIGH_PREMIUM_DESCRIPTIONS": F.col("top_text"),
                                             "LOW_PREMIUM_DESCRIPTIONS": F.col("bottom_text"),
                                             "NUM_PROPERTIES": F.col("n")})
    return one.select(prompt.alias("prompt"))


def area_summaries(summaries: DataFrame, n: int | None = None, area: str = "area", key: str = "listing_id",
                   summary: str = "summary") -> DataFrame:
    """The non-empty ones of the first ``n`` (default: all) summaries per area in
    key order, with ``rendered``: 'Listing <id>:\\n<summary>'."""
    from staylens.operators.packing_dist import global_positions
    if n is not None:  # the first n are taken before empty ones drop out
        summaries = global_positions(summaries, area, [key]).where(F.col("gidx") < n).drop("gidx")
    ne = summaries.where(F.col(summary).isNotNull() & (F.length(summary) > 0))
    return ne.withColumn("rendered", F.concat(F.lit("Listing "), F.col(key).cast("string"), F.lit(":\n"), F.col(summary)))


def area_summary_pack(summaries: DataFrame, n: int | None = None, area: str = "area", key: str = "listing_id",
                      summary: str = "summary") -> DataFrame:
    """:func:`area_summaries` numbered inside their area, with the area's property count.

    One row per summary (``area, pack_pos, key, n_properties, rendered``).  The
    position comes from a range-partitioned numbering (``global_positions``), so
    a hot area is spread over many tasks.
    """
    from staylens.operators.packing_dist import global_positions
    ranked = global_positions(area_summaries(summaries, n, area, key, summary), area, [key]) \
        .withColumn("pack_pos", F.col("gidx") + 1)
    counts = ranked.groupBy(area).agg(F.count(F.lit(1)).alias("n_properties"))
    return ranked.join(counts, area).select(area, "pack_pos", key, "n_properties", "rendered")
