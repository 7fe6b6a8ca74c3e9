"""Listing x amenity matrix (pipeline A): nested details -> long features ->
wide matrix -> clean matrix.

A record's icons are resolved inside its row (the last entry of an icon wins)
and become columns by lookups in a map, so the matrix takes one scan of the
details; the icon list is supplied, or found by one small distinct job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from staylens.functions.scalar import presence_sql

# ---------------------------------------------------------------------------
# fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
# Columns removed from the clean matrix when present.
DROP_COLUMNS = ["link", "property_id", "Occ_Rate_Based_on_Avail", "Abs_Occ_Rate", "Avail_Rate", "title",
                "review_count", "accuracy", "checking", "cleanliness", "communication", "location",
                "value", "guest_satisfaction"]
ENTIRE_HOME = "Entire home/apt"
NEIGHBORHOOD_TITLE = "Neighborhood highlights"
# Source order for icon conflicts: amenities, then house rules, then highlights (last wins).
SRC_AMENITY, SRC_RULE, SRC_HIGHLIGHT = 0, 1, 2
ICON_ARRAY = "array<struct<title:string,icon:string>>"


def last_icons(details: DataFrame, categorical: bool = False) -> DataFrame:
    """``details`` with ``_icons``: array of (icon, title, source), one entry per
    icon of the record.

    The amenity groups, house rules and highlights of a record are read in that
    order and a later entry overwrites an earlier one of the same icon.  All
    inside the row: entries sorted by icon and place, the last of each icon
    kept; nothing is exploded and nothing shuffles.
    """
    def entries(values, src):
        title = (lambda v: F.lit("True")) if categorical and src == SRC_AMENITY else (lambda v: v["title"])
        return F.transform(F.coalesce(values, F.array().cast(ICON_ARRAY)),
                           lambda v: F.struct(v["icon"].alias("icon"), title(v).alias("title"), F.lit(src).alias("source")))

    def grouped(groups):
        """The entries of all groups; a missing group has none."""
        none = F.array().cast(ICON_ARRAY)
        return F.flatten(F.transform(groups, lambda g: F.coalesce(g["values"], none)))
    every = F.filter(F.concat(entries(grouped(F.col("amenities")), SRC_AMENITY),
                              entries(grouped(F.col("house_rules.general")), SRC_RULE),
                              entries(F.col("highlights"), SRC_HIGHLIGHT)), lambda e: e["icon"].isNotNull())
    placed = F.array_sort(F.transform(every, lambda e, i: F.struct(
        e["icon"].alias("icon"), i.alias("place"), e["title"].alias("title"), e["source"].alias("source"))))
    out = details.withColumn("_placed", placed)
    last = F.filter("_placed", lambda e, i: ~e["icon"].eqNullSafe(F.get("_placed", i + 1)["icon"]))
    return out.withColumn("_icons", F.transform(last, lambda e: F.struct(
        e["icon"].alias("icon"), e["title"].alias("title"), e["source"].alias("source")))).drop("_placed")


def amenity_long(details: DataFrame, key: str = "listing_id", categorical: bool = False) -> DataFrame:
    """Nested amenities / house-rule icons / highlights -> one row per (listing,
    icon) with the entry that wins (highlights over rules over amenities, and
    within a source the later one): :func:`last_icons` of each record, unnested."""
    return last_icons(details, categorical).select(key, F.inline("_icons"))


def icon_sql(icon: str) -> str:
    """The map lookup of an icon as SQL text."""
    return "_m['" + icon.replace("\\", "\\\\").replace("'", "\\'") + "']"


def icon_map(df: DataFrame, entries: str = "_icons", value: str = "title") -> DataFrame:
    """``df`` with ``_m``, icon -> value, in place of the entries."""
    pairs = F.transform(entries, lambda e: F.struct(e["icon"].alias("icon"), e[value].alias(value)))
    return df.withColumn("_m", F.map_from_entries(pairs)).drop(entries)


def amenity_matrix(long: DataFrame, icons: Sequence[str] | None = None, key: str = "listing_id",
                   value: str = "title") -> DataFrame:
    """Wide matrix: one column per icon holding the title (NULL = missing).

    ``long`` has rows (listing, icon, title); equal rows count once.
    ``icons`` fixes the columns; without it one distinct job lists them (the
    icon vocabulary is small -- a few hundred names at most).

    Plan: one aggregate per listing, the only shuffle, collects the set of its
    (icon, title) pairs (a listing holds at most the vocabulary); each column is
    a lookup in the map made of it.
    """
    if icons is None:
        icons = sorted(r[0] for r in long.select("icon").distinct().collect())
    m = long.groupBy(key).agg(F.collect_set(F.struct("icon", value)).alias("_icons"))
    return icon_map(m, value=value).selectExpr(f"`{key}`", *[f"{icon_sql(i)} AS `{i}`" for i in icons])


def amenity_flags(df: DataFrame, prefix: str = "SYSTEM_") -> DataFrame:
    """``SYSTEM_*`` columns -> 0/1 (present = non-NULL and not False/'False')."""
    return df.selectExpr(*[f"{presence_sql(c)} AS `{c}`" if c.startswith(prefix) else f"`{c}`" for c in df.columns])


def drop_columns(df: DataFrame, cols: Sequence[str] = DROP_COLUMNS) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def fill_missing(df: DataFrame, cols: Sequence[str] | None = None, value=0) -> DataFrame:
    """'False' sentinel / NULL -> 0 in the clean matrix; ints stay ints."""
    cols = list(cols) if cols is not None else df.columns
    out = {}
    for c in cols:
        t = df.schema[c].dataType
        if isinstance(t, NumericType):
            out[c] = F.coalesce(F.col(c), F.lit(value).cast(t))
        else:
            s = F.col(c).cast("string")
            out[c] = F.when(s.isNull() | (F.lower(s) == "false"), F.lit(str(value))).otherwise(s)
    return df.withColumns(out)


def clean_matrix(raw: DataFrame, min_days: int = 100, key: str = "listing_id") -> DataFrame:
    """Raw matrix -> clean matrix: drop listed columns, SYSTEM_* as 0/1,
    beds / bedrooms int, bathrooms double (unparsable -> 0), then keep
    Days_Avail >= min_days (missing = 0; no column -> no filter)."""
    df = drop_columns(raw)
    df = amenity_flags(df)
    conv = {}
    for c, t in (("beds", "int"), ("bedrooms", "int"), ("bathrooms", "double")):
        if c in df.columns:
            v = F.col(c).cast("string").try_cast("double")
            conv[c] = F.coalesce(v, F.lit(0.0)).cast(t)
    df = df.withColumns(conv)
    if "Days_Avail" in df.columns:
        df = df.where(F.coalesce(F.col("Days_Avail").cast("double"), F.lit(0.0)) >= min_days)
    return df


def select_numeric_features(df: DataFrame, label: str = "ADR", exclude: Sequence[str] = ()) -> list[str]:
    """All numeric columns except the label (booleans and strings excluded)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name != label and f.name not in exclude]


def parse_sub_description(items_col: str = "sub_description.items", legacy: bool = False):
    """bedrooms / beds / bathrooms from the sub-description items.

    ``legacy=True`` reproduces the positional plural-only split (items[1],
    items[2], items[3]); the default also reads singular forms and studios
    anywhere in the list.  Out-of-range positions give NULL.
    """
    items = F.col(items_col)
    if legacy:
        def at(i, word):
            s = F.get(items, i)
            return F.when(s.contains(word), F.split(s, word).getItem(0))
        return {"bedrooms": at(1, " bedrooms"), "beds": at(2, " beds"), "bathrooms": at(3, " baths")}

    def find(pattern):
        hit = F.filter(items, lambda x: x.rlike(pattern))
        return F.regexp_extract(F.get(hit, 0), pattern, 1)

    def nz(c):
        return F.when(c != "", c)
    studio = F.exists(items, lambda x: F.lower(x).contains("studio"))
    return {
        "bedrooms": F.when(studio, F.lit("0")).otherwise(nz(find(r"^\s*([\d.]+)\s+bedrooms?\b"))),
        "beds": nz(find(r"^\s*([\d.]+)\s+beds?\b")),
        "bathrooms": nz(find(r"^\s*([\d.]+)\s+(?:shared |private )?baths?\b")),
    }


def parse_details_columns(legacy: bool = False) -> dict:
    """Listing-level columns of the nested details record."""
    loc0 = F.get(F.col("location_descriptions"), 0)
    return {"room_type": F.col("room_type"), "is_entire_home": F.col("room_type") == ENTIRE_HOME,
            "capacity": F.col("person_capacity"), "title": F.col("title"), **parse_sub_description(legacy=legacy),
            "house_rules": F.col("house_rules.aditional"),
            "neighborhood_highlight": F.when(loc0["title"] == NEIGHBORHOOD_TITLE, loc0["content"]),
            "rating": F.col("rating")}


def parse_details(details: DataFrame, key: str = "listing_id", legacy: bool = False) -> DataFrame:
    return details.select(key, *[v.alias(c) for c, v in parse_details_columns(legacy).items()])


def build_matrix(details: DataFrame, metrics: DataFrame, icons: Sequence[str] | None = None,
                 key: str = "listing_id", strict_entire_home: bool = False,
                 categorical: bool = False, rating_keys: Sequence[str] = ()) -> DataFrame:
    """Raw matrix: link + financials for every listing; basic details and
    amenity columns only for entire homes (non-entire rows survive with
    link + financials, as in the reference).  The ADR-desc order is applied
    by the sink (``write_matrix``), not here, so no global sort runs unless
    an ordered file is written.  One scan of the details and one join."""
    from staylens.functions.scalar import listing_link
    from staylens.operators.market import occupancy_metrics
    entire = F.col("room_type") == ENTIRE_HOME
    parsed = parse_details_columns()
    basic = {c: parsed[c] for c in ("capacity", "title", "bedrooms", "beds", "bathrooms")}
    basic.update({k: F.col("rating")[k] for k in rating_keys})
    if icons is None:
        icons = sorted(r[0] for r in amenity_long(details.where(entire), key, categorical).select("icon").distinct().collect())
    rows = icon_map(last_icons(details, categorical).where(entire) if strict_entire_home else last_icons(details, categorical))
    wide = rows.select(key, listing_link(key).alias("link"),
                       *[F.when(entire, v).alias(c) for c, v in basic.items()],
                       F.when(entire, F.col("_m")).alias("_m"))
    fin = occupancy_metrics(metrics).select(key, "ADR", "Occ_Rate_Based_on_Avail", "Days_Avail", "Abs_Occ_Rate",
                                            "Avail_Rate", F.lit(True).alias("has_airdna_data"))
    return wide.join(fin, key, "left").selectExpr(
        f"`{key}`", "link", "ADR", "Occ_Rate_Based_on_Avail", "Days_Avail", "Abs_Occ_Rate", "Avail_Rate",
        "coalesce(has_airdna_data, false) AS has_airdna_data", *[f"`{c}`" for c in basic],
        *[f"{icon_sql(i)} AS `{i}`" for i in icons])
