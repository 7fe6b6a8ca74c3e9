"""Logical rental tables derived from the driver's parquet tables.

Each binding is a plain DataFrame plan over the given tables, so work grows
with them; the SQL twins for the DuckDB oracle live in
:mod:`staylens.plans.oracle`.  ``listing`` = part, ``area`` = p_type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.scalar import fixed_round, word_count
from staylens.sources.tables import table

# Columns that together order lineitem rows ((orderkey, linenumber) is not unique).
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]

DOCUMENT_LINES = 1 << 17    # lines of a task that makes review documents


def b_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """listing_id, rating (NULL for N/F lines), review text, order columns."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_partkey").alias("listing_id"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), F.lit(None).cast("int"))
         .otherwise(F.lit(1) + F.col("l_quantity").cast("int") % 5).alias("rating"),
        F.concat(F.lit("qty "), F.col("l_quantity").cast("string"), F.lit(" flag "),
                 F.col("l_returnflag")).alias("review"),
        *LINEITEM_ORDER,
    )


def b_review_records(spark: SparkSession, sf: str) -> DataFrame:
    """listing_id, record (VARIANT) of every line: some records lack ``comments``
    or ``rating``, some hold an explicit null."""
    r = b_reviews(spark, sf)
    k = F.col("l_orderkey") + F.col("l_linenumber")
    comments = F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, F.lit('"comments":null')) \
        .otherwise(F.concat(F.lit('"comments":"'), F.col("review"), F.lit('"')))
    rating = F.when(k % 3 == 0, F.lit(None)).otherwise(
        F.concat(F.lit('"rating":'), F.coalesce(F.col("rating").cast("string"), F.lit("null"))))
    doc = F.concat(F.lit("{"), F.concat_ws(",", comments, rating), F.lit("}"))
    return r.select("listing_id", *LINEITEM_ORDER, F.parse_json(doc).alias("record"))


def b_review_documents(spark: SparkSession, sf: str) -> DataFrame:
    """file, value: one JSON document ``{listing: [reviews]}`` per listing and
    month of the ship date, the month naming the file."""
    r = b_reviews(spark, sf).withColumn("file", F.date_format("l_shipdate", "yyyy-MM"))
    # ranges of documents: a task's share stays the same as the table grows, and it writes few months
    r = r.repartitionByRange(table(spark, sf, "lineitem").count() // DOCUMENT_LINES + 1, "file", "listing_id")
    per = r.groupBy("file", "listing_id").agg(F.array_sort(F.collect_list(
        F.struct(*LINEITEM_ORDER, "review", F.col("rating").cast("double").alias("rating")))).alias("rows"))
    items = F.transform("rows", lambda x: F.struct(x["review"].alias("review"), x["rating"].alias("rating")))
    doc = F.to_json(F.create_map(F.col("listing_id").cast("string"), items), {"ignoreNullFields": "false"})
    return per.select("file", doc.alias("value"))


def b_market(spark: SparkSession, sf: str) -> DataFrame:
    """Per-listing market metrics (ADR, Occupancy, Revenue, Days_Available)."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("listing_id")).agg(
        fixed_round((F.sum("l_extendedprice") / F.sum("l_quantity")).cast("decimal(18,8)"), 2).alias("ADR"),
        F.floor(100.0 * F.sum(F.when(F.col("l_returnflag") != "N", 1).otherwise(0)) / F.count(F.lit(1)))
         .cast("int").alias("Occupancy"),
        fixed_round(F.sum("l_extendedprice"), 2).alias("Revenue"),  # cents; raw sums differ in the last bits
        F.least(F.lit(365), 10 * F.countDistinct(F.col("l_shipdate").cast("date"))).cast("int").alias("Days_Available"),
    )


def _icon():
    """One icon per return flag and discount of a line."""
    cents = F.lpad(F.round(F.col("l_discount") * 100).cast("int").cast("string"), 2, "0")
    return F.concat(F.lit("SYSTEM_"), F.col("l_returnflag"), F.lit("_"), cents)


def b_icon_rows(spark: SparkSession, sf: str) -> DataFrame:
    """listing_id, icon, title of every line (an icon may repeat)."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("listing_id"), _icon().alias("icon"), F.concat(F.lit("Feature "), _icon()).alias("title"))


def b_feature_icons(spark: SparkSession, sf: str) -> DataFrame:
    """Long amenity form: listing_id, icon, title (one row per held icon)."""
    return b_icon_rows(spark, sf).distinct()


# The binding's 33 icons: return flag x discount in cents.
BINDING_ICONS = [f"SYSTEM_{f}_{d:02d}" for f in ("A", "N", "R") for d in range(11)]


def b_part_features(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric listing attributes: capacity, bedrooms (with 'False' sentinel), area."""
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("listing_id"),
        F.col("p_type").alias("area"),
        F.col("p_size").alias("capacity"),
        F.when(F.col("p_size") % 7 == 0, F.lit("False"))
         .otherwise(F.floor(F.col("p_size") / 4).cast("string")).alias("bedrooms"),
        F.col("p_retailprice").alias("retail_price"),
    )


def b_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Wide description scores: listing_id (=doc_id), quality, toxic, word_count."""
    lab = table(spark, sf, "labels")
    doc = table(spark, sf, "documents").select("doc_id", "text")
    return lab.join(doc, "doc_id").select(
        F.col("doc_id").alias("listing_id"),
        F.col("quality").cast("double").alias("quality"),
        F.col("toxic").cast("double").alias("toxic"),
        word_count("text").cast("double").alias("word_count"),
    )


def b_residuals(spark: SparkSession, sf: str) -> DataFrame:
    """Per-document premium stand-in: n_chars minus the mean over all documents."""
    doc = table(spark, sf, "documents").select("doc_id", "n_chars")
    # one scalar aggregate -> literal (size-bounded; no cross join)
    mean = doc.agg(F.avg("n_chars")).first()[0]
    return doc.select(F.col("doc_id").alias("listing_id"),
                      (F.col("n_chars") - F.lit(mean)).alias("residual"))


def b_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    """listing_id, description (whole document text)."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("listing_id"),
                                                F.col("text").alias("description"))


def b_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Model request log derived from conversations (one row per assistant turn).

    The prompt is the previous turn's text.  Instead of a ``lag`` window (one
    task per conversation), turns get range-partitioned positions and the
    previous turn is an equi-join on (conversation, position - 1)."""
    from staylens.operators.packing_dist import global_positions
    c = global_positions(table(spark, sf, "conversations"), "conv_id", ["turn"]).drop("pe")
    prev = c.select("conv_id", (F.col("gidx") + 1).alias("gidx"), F.col("text").alias("prompt"))
    base = c.join(prev, ["conv_id", "gidx"], "left")
    a = base.where(F.col("role") == "assistant")
    return a.select(
        (F.col("conv_id") % 10).alias("session"),
        F.col("conv_id").alias("listing_id"),
        F.col("turn"),
        F.col("prompt"),
        F.col("text").alias("response"),
        (F.col("prompt").isNotNull()).alias("success"),
        (F.col("turn") % 7 == 0).alias("cached"),
        (F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 600 + F.col("turn") * 30)).alias("ts"),
    )


def b_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Output manifest: stage, listing_id, mtime (latest write)."""
    e = table(spark, sf, "events")
    return e.groupBy(F.col("event_type").alias("stage"), F.col("user_id").alias("listing_id")) \
            .agg(F.max("ts").alias("mtime"))


def b_stage_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Areas: nations, and one whose search found nothing."""
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("area"))
    return n.unionByName(table(spark, sf, "region").agg(F.lit("empty").alias("area")))


def b_stage_sources(spark: SparkSession, sf: str) -> dict:
    """Id sources of the stage rules: listings (customers) and those with
    reviews (customers who are users of events), by nation."""
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("area"), F.col("c_custkey").alias("listing_id"))
    users = table(spark, sf, "events").select(F.col("user_id").alias("listing_id")).distinct()
    return {"listing": c, "reviews": c.join(users, "listing_id", "left_semi")}


# Event type that stands for the outputs of a stage.
STAGE_EVENTS = {"search_results": "view", "comp_sets": "signup", "reviews_scrape": "view", "details_scrape": "click",
                "listing_summaries": "purchase", "area_summary": "error"}


def b_stage_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """stage, output, mtime: a listing's outputs are as new as its user's last
    event of the stage's type, an area's as new as its last event of that type."""
    from staylens.operators import freshness as fr
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("area"), F.col("c_custkey").alias("listing_id"))
    seen = b_manifest(spark, sf).withColumnRenamed("stage", "event_type").join(c, "listing_id")
    out = None
    for stage, per, _needs, patterns in fr.STAGE_RULES:
        if stage not in STAGE_EVENTS:
            continue
        rows = seen.where(F.col("event_type") == STAGE_EVENTS[stage])
        if per == "area":
            rows = rows.groupBy("area").agg(F.max("mtime").alias("mtime")).withColumn("listing_id", F.lit(None).cast("string"))
        for p in patterns:
            made = rows.select(F.lit(stage).alias("stage"), fr.output_name(p).alias("output"), "mtime")
            out = made if out is None else out.unionByName(made)
    return out


def b_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Listing coordinates in whole milli-degrees around per-area centroids, some on
    the edges of cells and of the box."""
    c = table(spark, sf, "customer")
    n = F.col("c_nationkey")
    k = F.col("c_custkey")
    return c.select(
        k.alias("listing_id"), n.alias("area"),
        (n * 1000 + (k * 37) % 281 - 140).cast("double").alias("lat"),
        (-n * 1000 + (k * 53) % 281 - 140).cast("double").alias("lon"))


def b_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Area centroid table (area, lat, lon) from nation keys."""
    n = table(spark, sf, "nation")
    return n.select(F.col("n_nationkey").alias("area"),
                    (F.col("n_nationkey") * 1000).cast("double").alias("lat"),
                    (-F.col("n_nationkey") * 1000).cast("double").alias("lon"))


def b_page_text(spark: SparkSession, sf: str) -> DataFrame:
    """Rendered market page text per listing (KPI cards + header line)."""
    m = b_market(spark, sf)
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("listing_id"), "p_size")
    txt = F.concat(
        F.lit("★ "), F.format_string("%.1f", fixed_round(3 + (F.col("p_size") % 20) / 10.0, 1)),
        F.lit(" ("), F.col("p_size").cast("string"), F.lit(")\nBedrooms: "),
        F.floor(F.col("p_size") / 4).cast("string"), F.lit(" Baths: "),
        F.format_string("%.1f", fixed_round(1 + (F.col("p_size") % 4) / 2.0, 1)),
        F.lit(" Guests: "), (F.col("p_size") % 16 + 1).cast("string"),
        F.lit("\n$"), F.format_string("%.1f", fixed_round(F.col("Revenue") / 1000.0, 1)),
        F.lit("K\nAnnual Revenue\n$"), F.format_string("%.2f", F.col("ADR")),
        F.lit("\nAverage Daily Rate\n"), F.col("Occupancy").cast("string"),
        F.lit("%\nOccupancy\n"), F.col("Days_Available").cast("string"), F.lit("\nDays Available"))
    return m.join(p, "listing_id").select("listing_id", txt.alias("page_text"))


def b_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Generated summaries: area = source, listing_id = doc_id; empty when doc_id % 11 = 0."""
    d = table(spark, sf, "documents")
    return d.select(F.col("source").alias("area"), F.col("doc_id").alias("listing_id"),
                    F.when(F.col("doc_id") % 11 == 0, F.lit("")).otherwise(F.col("text")).alias("summary"))


def _plural(n: F.Column, word: str) -> F.Column:
    return F.when(n == 1, F.lit(f"1 {word}")).otherwise(F.concat(n.cast("string"), F.lit(f" {word}s")))


def b_details(spark: SparkSession, sf: str) -> DataFrame:
    """Nested listing-details records derived from part + amenity icons, in the
    reference's shape (amenity groups, house rules, highlights, sub-description
    items, list-or-string description).  The per-listing amenity list is
    bounded by the icon vocabulary."""
    p = table(spark, sf, "part")
    icons = b_icon_rows(spark, sf).groupBy("listing_id").agg(
        F.array_sort(F.collect_set(F.struct("title", "icon"))).alias("vals"))
    size = F.col("p_size")
    desc_json = F.when(size % 4 != 0, F.to_json(F.array("p_name", "p_brand"))) \
        .otherwise(F.to_json(F.array("p_name")).substr(F.lit(2), F.length(F.to_json(F.array("p_name"))) - 2))
    empty_groups = F.array().cast("array<struct<values:array<struct<title:string,icon:string>>>>")
    empty_icons = F.array().cast("array<struct<title:string,icon:string>>")
    d = p.join(icons, p.p_partkey == icons.listing_id, "left").select(
        F.col("p_partkey").cast("string").alias("listing_id"),
        F.when(size % 5 == 0, F.lit("Private room")).otherwise(F.lit("Entire home/apt")).alias("room_type"),
        size.cast("long").alias("person_capacity"),
        F.create_map(F.lit("guest_satisfaction"), (3 + (size % 20) / 10.0)).alias("rating"),
        F.struct(F.concat(F.lit("Quiet hours for "), F.col("p_brand")).alias("aditional"),
                 F.when(size % 3 == 0, F.array(F.struct(F.array(F.struct(
                     F.lit("No pets").alias("title"), F.lit("SYSTEM_A_03").alias("icon"))).alias("values"))))
                 .otherwise(empty_groups).alias("general")).alias("house_rules"),
        F.col("p_name").alias("title"),
        F.struct(F.array(F.concat(size.cast("string"), F.lit(" guests")),
                         _plural(F.floor(size / 4), "bedroom"), _plural(F.floor(size / 3), "bed"),
                         _plural(1 + size % 3, "bath")).alias("items")).alias("sub_description"),
        F.array(F.struct(F.when(size % 2 == 0, F.lit("Neighborhood highlights"))
                         .otherwise(F.lit("Getting around")).alias("title"),
                         F.col("p_type").alias("content"))).alias("location_descriptions"),
        F.parse_json(desc_json).alias("description"),
        F.when(F.col("vals").isNotNull(), F.array(F.struct(F.col("vals").alias("values"))))
         .otherwise(empty_groups).alias("amenities"),
        F.when(size % 4 == 0, F.array(F.struct(F.lit("Guest favourite").alias("title"),
                                               F.lit("SYSTEM_N_05").alias("icon"))))
         .otherwise(empty_icons).alias("highlights"))
    return d
