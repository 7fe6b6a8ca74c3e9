"""Token-budget packing of reviews into model prompts (section 2.10).

Greedy in-order packing (per listing, budget = limit - prompt tokens):

* an item that fits joins the current chunk;
* an over-budget item after a non-empty chunk closes it and opens the next
  chunk, uncut (so an oversized item then sits alone);
* an over-budget item while the current chunk is empty (only possible before
  the first item that fitted) is cut to 2000 chars + '... [truncated]' and
  emitted alone.

Closed form: with exclusive prefix sums ``P``, a chunk starting at item ``i``
(tokens <= budget) ends before the first ``j`` with ``P[j+1] - P[i] > budget``;
an over-budget start is a chunk by itself.  Chunk starts are the chain
0 -> next(0) -> ...; :mod:`staylens.operators.packing_dist` walks it over range
partitions of the numbers, so no task holds a listing and no text leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.scalar import estimate_tokens, truncate_item
from staylens.operators.packing_dist import chunk_numbers
from staylens.plans.common import written

# Reference defaults: token limit per request and minimum reviews per listing.
CHUNK_TOKEN_LIMIT = 120000
MIN_REVIEWS = 5


def chunk_reviews(df: DataFrame, key: str = "listing_id", order_cols: Sequence[str] = ("pos",),
                  text_col: str = "text", prompt_tokens: int | str = 0,
                  limit: int = CHUNK_TOKEN_LIMIT, partitions: int | None = None) -> DataFrame:
    """Assign every item to a chunk: ``key, chunk_no, item_no, text, tokens, truncated``.

    ``prompt_tokens`` is a number or the name of a per-listing column (the
    filled template differs per listing).  Every item of the input is kept
    (only cut items change text).

    Plan, the same at every size: the items are written once with a row id and
    their token count; the numbers alone are range-partitioned by (key, order)
    and packed (:func:`staylens.operators.packing_dist.chunk_numbers`); chunk
    and item numbers come back to the texts by an equi-join on the row id.
    """
    pt = F.col(prompt_tokens) if isinstance(prompt_tokens, str) else F.lit(int(prompt_tokens))
    extra = [c for c in dict.fromkeys(order_cols) if c not in (key, text_col)]
    staged = written(df.select(key, *extra, F.col(text_col).alias("text"), estimate_tokens(text_col).cast("long").alias("tokens"),
                               (F.lit(int(limit)) - pt).cast("long").alias("budget"),
                               F.monotonically_increasing_id().alias("_id")), "pack-items")
    order = ["text" if c == text_col else c for c in order_cols]
    numbers = written(chunk_numbers(staged, key, order, partitions), "pack-chunks")
    return staged.select(key, "text", "tokens", "_id").join(numbers, "_id").select(
        key, "chunk_no", "item_no", F.when(F.col("truncated"), truncate_item("text")).otherwise(F.col("text")).alias("text"),
        "tokens", "truncated")


def needs_chunking(df: DataFrame, key: str = "listing_id", text_col: str = "text", prompt_tokens: int = 0,
                   limit: int = CHUNK_TOKEN_LIMIT) -> DataFrame:
    """prompt + sum(review tokens) > limit, per listing (partial-aggregated)."""
    return df.groupBy(key).agg(F.sum(estimate_tokens(text_col)).alias("review_tokens")).withColumn(
        "needs_chunking", (F.lit(int(prompt_tokens)) + F.col("review_tokens")) > F.lit(int(limit)))


# A missing review renders as pandas' NA marker inside the prompt.
NA_TEXT = "<NA>"


def review_numbering(chunks: DataFrame) -> DataFrame:
    """'Review i: text', i 1-based inside the chunk."""
    return chunks.withColumn("numbered", F.concat(F.lit("Review "), F.col("item_no").cast("string"),
                                                  F.lit(": "), F.coalesce(F.col("text"), F.lit(NA_TEXT))))


# ---------------------------------------------------------------------------
# fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
REVIEWS_HEADER = "Reviews to analyze:\n"
PROMPT_FOOTER = "Please provide the analysis following the exact format specified above."
CHUNK_INFO = "Processing chunk %d of %d (%d reviews)"
MERGE_HEAD = ("\nYou have received multiple partial analyses of Airbnb reviews for the same listing. "
              "Please combine them into a single comprehensive summary following the original format "
              "requirements.\n\nOriginal format requirements:\n")
MERGE_PARTS = "\n\nPartial analyses to merge:\n"
MERGE_ITEM = "\n--- Analysis %d ---\n%s\n"
MERGE_TAIL = ("\nPlease provide a single unified analysis that:\n"
              "1. Maintains the exact 5-section format from the original requirements\n"
              "2. Combines and reconciles the data from all partial analyses\n"
              "3. Provides accurate overall percentages and mention counts\n"
              "4. Creates a coherent final summary\n\nUnified Analysis:")


def chunk_prompt(chunks: DataFrame, base_prompt: str | DataFrame, key: str = "listing_id", prompt_tokens: int = 0,
                 limit: int = CHUNK_TOKEN_LIMIT) -> DataFrame:
    """One prompt per (listing, chunk): base + chunk info (only when the
    listing's prompt + reviews exceed the limit) + numbered reviews + footer.

    ``base_prompt`` is one string, or a table with a row per listing (``key,
    base_prompt, prompt_tokens``) that joins the finished chunks, not the
    reviews.  The ``collect_list`` is per chunk, so its size is bounded by the
    token budget (plus at most one oversized item), never by the listing size.
    """
    per = written(review_numbering(chunks).groupBy(key, "chunk_no").agg(
        F.array_sort(F.collect_list(F.struct("item_no", "numbered"))).alias("items"),
        F.count(F.lit(1)).alias("n_items"), F.sum("tokens").alias("_tokens")), "pack-prompts")
    # listing totals from the written chunks' numbers, joined back (no per-listing window task,
    # and the items meet their chunk numbers once)
    tot = per.groupBy(key).agg(F.max("chunk_no").alias("n_chunks"), F.sum("_tokens").alias("_tt"))
    if isinstance(base_prompt, str):
        tot = tot.withColumns({"base_prompt": F.lit(base_prompt), "prompt_tokens": F.lit(int(prompt_tokens))})
    else:
        tot = tot.join(base_prompt.select(key, "base_prompt", "prompt_tokens"), key)
    per = per.join(tot, key)
    body = F.array_join(F.transform("items", lambda x: x["numbered"]), "\n")
    info = F.when(F.col("_tt") + F.col("prompt_tokens") > F.lit(int(limit)),
                  F.concat(F.format_string(CHUNK_INFO, F.col("chunk_no").cast("int"), F.col("n_chunks").cast("int"),
                                           F.col("n_items").cast("int")), F.lit("\n\n"))).otherwise(F.lit(""))
    prompt = F.concat(F.col("base_prompt"), F.lit("\n\n"), info, F.lit(REVIEWS_HEADER), body,
                      F.lit("\n\n" + PROMPT_FOOTER))
    return per.select(key, "chunk_no", "n_chunks", "n_items", prompt.alias("prompt"))


def merge_prompt(partials: DataFrame, base_prompt: str, key: str = "listing_id",
                 summary: str = "summary", max_parts: int | None = None) -> DataFrame:
    """Merge requests from the successful partial analyses of each listing
    (failed, NULL or empty partials are dropped, as in the reference).

    Each listing yields one request whose partials are numbered 1..n in chunk
    order; a single partial passes through unchanged.  With ``max_parts`` the
    partials are grouped by chunk number (``merge_group``) and each group yields
    a request (``final`` is true where it is the listing's only one).
    """
    ok = partials.where(F.col(summary).isNotNull() & (F.length(summary) > 0))
    ok = ok.withColumn("merge_group", (
        F.lit(0) if max_parts is None else F.floor((F.col("chunk_no") - 1) / max_parts)).cast("long"))
    per = ok.groupBy(key, "merge_group").agg(
        F.array_sort(F.collect_list(F.struct("chunk_no", F.col(summary).alias("s")))).alias("parts"),
        F.count(F.lit(1)).alias("n_parts"))
    groups = per.groupBy(key).agg(F.count(F.lit(1)).alias("n_groups"))
    numbered = F.transform("parts", lambda x, i: F.format_string(MERGE_ITEM, (i + 1).cast("int"), x["s"]))
    head = F.trim(F.split(F.lit(base_prompt), REVIEWS_HEADER[:-1]).getItem(0))
    merged = F.concat(F.lit(MERGE_HEAD), head, F.lit(MERGE_PARTS), F.array_join(numbered, ""), F.lit(MERGE_TAIL))
    return per.join(groups, key).select(
        key, "merge_group", "n_groups", "n_parts", (F.col("n_groups") == 1).alias("final"),
        F.when(F.col("n_parts") == 1, F.col("parts")[0]["s"]).otherwise(merged).alias("prompt"))
