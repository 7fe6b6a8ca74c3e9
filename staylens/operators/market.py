"""Market metrics: page-text extraction, merge/dedup, join to listings,
occupancy arithmetic and filters (sections 2.3, 2.4, 2.7, 2.9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.scalar import (abs_occupancy_rate, availability_rate, parse_currency,
                                       parse_days, parse_percentage, parse_revenue)

# ---------------------------------------------------------------------------
# fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
# Label-anchored KPI patterns over the page text.
KPI_REVENUE = r"([\$\d,.]+[KkMm]?)\s*\n?\s*Annual Revenue"
KPI_ADR = r"([\$\d,.]+)\s*\n?\s*Average Daily Rate"
KPI_OCCUPANCY = r"(\d+%?)\s*\n?\s*Occupancy"
KPI_DAYS = r"(\d+)\s*\n?\s*Days Available"
# Header patterns: rating "(count)" anywhere; bed/bath/guest within the first 500 chars.
HDR_RATING = r"★?\s*([\d.]+)\s*\((\d+)\)"
HDR_BED = r"(?i)(?:bed|bedroom)s?\s*[:.]?\s*(\d+)"
HDR_BATH = r"(?i)(?:bath|bathroom)s?\s*[:.]?\s*(\d+\.?\d*)"
HDR_GUEST = r"(?i)(?:guest|max.?guest)s?\s*[:.]?\s*(\d+)"
HEADER_CHARS = 500
# The ten market-metric fields of a merged record.
MARKET_FIELDS = ["ADR", "Occupancy", "Revenue", "Bedrooms", "Bathrooms", "Max_Guests",
                 "Days_Available", "LY_Revenue", "Rating", "Review_Count"]


def _group(text: Column, pattern: str, idx: int = 1) -> Column:
    """Captured group or NULL when the pattern does not match."""
    # the groups of all patterns take at least one character, so '' means no match
    return F.nullif(F.regexp_extract(text, pattern, idx), F.lit(""))


def extract_kpis(pages: DataFrame, text_col: str = "page_text") -> DataFrame:
    """Revenue / ADR / Occupancy / Days_Available from page text; missing -> 0."""
    t = F.col(text_col)
    return pages.withColumns({
        "Revenue": F.coalesce(parse_revenue(_group(t, KPI_REVENUE)), F.lit(0.0)),
        "ADR": F.coalesce(parse_currency(_group(t, KPI_ADR)), F.lit(0.0)),
        "Occupancy": F.coalesce(parse_percentage(_group(t, KPI_OCCUPANCY)), F.lit(0)),
        "Days_Available": F.coalesce(parse_days(_group(t, KPI_DAYS)), F.lit(0)),
    })


def extract_header(pages: DataFrame, text_col: str = "page_text") -> DataFrame:
    """Rating / Review_Count anywhere; Bedrooms / Bathrooms / Max_Guests in the
    first 500 characters (case-insensitive).  Missing -> NULL."""
    t = F.col(text_col)
    head = F.substring(t, 1, HEADER_CHARS)
    return pages.withColumns({
        "Rating": _group(t, HDR_RATING, 1).try_cast("double"),
        "Review_Count": _group(t, HDR_RATING, 2).try_cast("int"),
        "Bedrooms": _group(head, HDR_BED).try_cast("int"),
        "Bathrooms": _group(head, HDR_BATH).try_cast("double"),
        "Max_Guests": _group(head, HDR_GUEST).try_cast("int"),
    })


def empty_metrics_filter(metrics: DataFrame) -> DataFrame:
    """Drop failed scrapes: ADR = Revenue = Occupancy = Days = 0 (missing = 0)."""
    cols = set(metrics.columns)

    def z(c):
        return (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) == 0) if c in cols else F.lit(True)
    empty = z("ADR") & z("Revenue") & z("Occupancy") & z("Days_Available")
    return metrics.where(~empty)


def first_wins(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str | Column]) -> DataFrame:
    """Keep the first record per key in ``order_cols`` order (ascending).

    ``max_by``/``min_by`` over a struct would also work; ``row_number`` keeps
    every column without listing them.  Spark turns ``rn = 1`` into a
    WindowGroupLimit that trims each map task to one row per key before the
    shuffle, so a hot key ships one row per task, not all its records.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_wins(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Later record overwrites: keep the last per key in ``order_cols`` order."""
    return first_wins(df, key, [F.col(c).desc_nulls_last() for c in order_cols])


def market_merge_audit(df: DataFrame, key: str = "listing_id") -> DataFrame:
    """Merged count, distinct keys and duplicates skipped (one row)."""
    return df.agg(F.count(F.lit(1)).alias("records"),
                  F.count_distinct(key).alias("merged"),
                  (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicates_skipped"))


def occupancy_metrics(metrics: DataFrame, occupancy: str = "Occupancy", days: str = "Days_Available") -> DataFrame:
    """Adds Occ_Rate_Based_on_Avail, Days_Avail, Abs_Occ_Rate, Avail_Rate.

    Occupancy and days default to 0 when the column is absent; ADR stays NULL.
    """
    cols = set(metrics.columns)
    occ = F.col(occupancy) if occupancy in cols else F.lit(0)
    d = F.col(days) if days in cols else F.lit(0)
    return metrics.withColumns({
        "Occ_Rate_Based_on_Avail": occ,
        "Days_Avail": d,
        "Abs_Occ_Rate": abs_occupancy_rate(occ, d),
        "Avail_Rate": availability_rate(d),
    })


def join_market_metrics(details: DataFrame, metrics: DataFrame, key: str = "listing_id") -> DataFrame:
    """details LEFT OUTER metrics on the key, plus ``has_airdna_data``.

    Both sides are per-listing tables; Spark sort-merge joins them on the key
    (AQE switches to broadcast when the metrics side measures small).
    """
    m = metrics.withColumn("_has", F.lit(True))
    j = details.join(m, key, "left")
    return j.withColumn("has_airdna_data", F.coalesce(F.col("_has"), F.lit(False))).drop("_has")


def has_market_data_filter(df: DataFrame, flag: str = "has_airdna_data") -> DataFrame:
    """Keep rows with market data, then drop the flag; no flag column -> keep all."""
    if flag not in df.columns:
        return df
    return df.where(F.col(flag) == F.lit(True)).drop(flag)


def min_days_filter(df: DataFrame, n: int = 100, col: str = "Days_Avail") -> DataFrame:
    """Keep ``coalesce(Days_Avail, 0) >= n`` (inclusive); absent column -> no filter."""
    if col not in df.columns:
        return df
    return df.where(F.coalesce(F.col(col).cast("double"), F.lit(0.0)) >= n)


def entire_home_filter(df: DataFrame, strict: bool = False, col: str = "room_type") -> DataFrame:
    """Flag ``is_entire_home``; ``strict`` drops the other rows (the default
    keeps them, as the reference's matrix does)."""
    out = df.withColumn("is_entire_home", F.coalesce(F.col(col) == "Entire home/apt", F.lit(False)))
    return out.where("is_entire_home") if strict else out


def matrix_sort(df: DataFrame, key: str = "listing_id", col: str = "ADR") -> DataFrame:
    """ADR desc (missing last), key as tie-break -- a range-partitioned global sort."""
    return df.orderBy(F.col(col).cast("string").try_cast("double").desc_nulls_last(), F.col(key))
