"""File sources (section 2.1): the reference's JSON / CSV layouts read as
DataFrames with explicit schemas (no inference pass over the data).

Layouts accepted:

* one JSON document per file (the reference's layout; ``wholetext``), or
* JSON lines (one document per line) -- the scalable form our sinks write.

Where the reference keeps the listing id only in the file name, the id is
parsed from ``_metadata.file_path``.  A missing path yields an empty frame
with the schema instead of an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ICON = T.StructType([T.StructField("title", T.StringType()), T.StructField("icon", T.StringType())])
ICON_GROUP = T.StructType([T.StructField("values", T.ArrayType(ICON))])

DETAILS_SCHEMA = T.StructType([
    T.StructField("listing_id", T.StringType()),
    T.StructField("room_type", T.StringType()),
    T.StructField("person_capacity", T.LongType()),
    T.StructField("rating", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("house_rules", T.StructType([
        T.StructField("aditional", T.StringType()),
        T.StructField("general", T.ArrayType(ICON_GROUP))])),
    T.StructField("title", T.StringType()),
    T.StructField("sub_description", T.StructType([T.StructField("items", T.ArrayType(T.StringType()))])),
    T.StructField("location_descriptions", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()), T.StructField("content", T.StringType())]))),
    # list or str in the reference: kept as raw JSON text, normalised on read
    T.StructField("description", T.StringType()),
    T.StructField("amenities", T.ArrayType(ICON_GROUP)),
    T.StructField("highlights", T.ArrayType(ICON)),
])

TASK_BYTES = 16 << 20   # of documents whose reviews one task joins

METRICS_STRUCT = ("struct<ADR:double,Occupancy:int,Revenue:double,Bedrooms:int,Bathrooms:double,"
                  "Max_Guests:int,Days_Available:int,LY_Revenue:double,Rating:double,Review_Count:int>")
REVIEW_ARRAY = "array<struct<review:string,comments:string,rating:double>>"


def _exists(path: str) -> bool:
    """Path (or glob) exists, checked through Hadoop's FileSystem so local,
    HDFS and object-store paths behave the same."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    try:
        jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
    except Exception:  # no JVM handle (Spark Connect): let the reader report a missing path
        return True
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    st = fs.globStatus(p)
    return st is not None and len(st) > 0


def _bytes(path: str) -> int:
    """Bytes of the files under a path (or glob)."""
    spark = SparkSession.getActiveSession()
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    except Exception:  # no JVM handle (Spark Connect): the session's settings decide
        return 0
    return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(p) or [])


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def _file_name() -> F.Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)


def _json_docs(spark: SparkSession, path: str, glob: str | None, wholetext: bool) -> DataFrame:
    """(file, doc) rows: whole files or JSON lines."""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.text(path, wholetext=wholetext)  # the argument, not .option(): text() would override it
    return df.select(_file_name().alias("file"), F.col("_metadata.file_path").alias("path"),
                     F.col("value").alias("doc")).where(F.length(F.trim("doc")) > 0)


def read_search_results(spark: SparkSession, path: str, area_pattern: str = r"_(\w+)\.json$",
                        lines: bool = False) -> DataFrame:
    """Search hits: ``area, listing_id, lat, lon``; id = room_id, else id; falsy ids dropped."""
    schema = "room_id string, id string, lat double, lon double"
    if not _exists(path):
        return _empty(spark, f"area string, listing_id string, lat double, lon double")
    df = spark.read.schema(schema).option("multiLine", not lines).json(path)
    rid = F.coalesce(F.nullif(F.col("room_id"), F.lit("")), F.nullif(F.col("id"), F.lit("")))
    area = F.nullif(F.regexp_extract(F.col("_metadata.file_path"), area_pattern, 1), F.lit(""))
    # area=<value>/ partition folders (our sink layout) take precedence over file names
    part = F.nullif(F.regexp_extract(F.col("_metadata.file_path"), r"/area=([^/]+)/", 1), F.lit(""))
    return df.select(F.coalesce(part, area).alias("area"), rid.alias("listing_id"), "lat", "lon") \
        .where(F.col("listing_id").isNotNull())


def read_listing_details(spark: SparkSession, path: str, prefix: str = "property_details_",
                         suffix: str = ".json", lines: bool = False) -> DataFrame:
    """Nested listing details; the id comes from a ``listing_id`` field when the
    documents carry one, else from ``<prefix><id><suffix>`` in the file name."""
    if not _exists(path):
        return _empty(spark, DETAILS_SCHEMA)
    r = spark.read.schema(DETAILS_SCHEMA)
    if not lines:
        r = r.option("multiLine", True).option("pathGlobFilter", f"{prefix}*{suffix}")
    df = r.json(path)
    from_name = F.regexp_extract(_file_name(), f"^{prefix}(.+){suffix.replace('.', '[.]')}$", 1)
    lid = F.coalesce(F.col("listing_id"), F.nullif(from_name, F.lit("")))
    return df.withColumn("listing_id", lid)


def normalize_description_value(v: F.Column) -> F.Column:
    """Raw JSON text of a description: list -> items joined by ' ', string ->
    itself, anything else -> NULL."""
    var = F.try_parse_json(v)
    t = F.schema_of_variant(var)
    as_list = F.array_join(F.from_json(v, "array<string>"), " ")
    return F.when(t.startswith("ARRAY"), as_list).when(t == "STRING", F.try_variant_get(var, "$", "string")) \
        .when(var.isNull() & v.isNotNull(), v)


def read_market_metrics(spark: SparkSession, path: str, glob: str | None = "listing_*.json",
                        wholetext: bool = True) -> DataFrame:
    """``{id: {ten fields}}`` documents -> ``file, listing_id, <fields>``.
    Duplicates are kept (``first_wins`` on ``file`` resolves them)."""
    if not _exists(path):
        return _empty(spark, f"file string, listing_id string, m {METRICS_STRUCT}").select(
            "file", "listing_id", "m.*")
    docs = _json_docs(spark, path, glob, wholetext)
    m = docs.select("file", F.explode(F.from_json("doc", f"map<string,{METRICS_STRUCT}>")).alias("listing_id", "m"))
    return m.select("file", "listing_id", "m.*")


def read_reviews(spark: SparkSession, path: str, glob: str | None = "reviews_*.json",
                 wholetext: bool = True) -> DataFrame:
    """``{id: [{review|comments, rating}]}`` documents -> one row per review:
    ``file, listing_id, pos, review, rating``.  A listing appearing in several
    files keeps the last file's list (dict update order = file path order).

    Documents are unnested as VARIANT, so records of any shape are read; which
    file wins is decided on (listing, path) alone, and the reviews of the other
    files are dropped by a semi join before they are unnested."""
    if not _exists(path):
        return _empty(spark, "file string, listing_id string, pos int, review string, rating double")
    docs = _json_docs(spark, path, glob, wholetext)
    per = docs.select("file", "path", F.explode(F.from_json("doc", "map<string,variant>")).alias("listing_id", "rv"))
    parts, names = _bytes(path) // TASK_BYTES + 1, per.select("listing_id", "path")
    if parts > 1:   # a task's share of the aggregate and of the join stays the same as the files grow
        per, names = per.repartition(parts, "listing_id", "path"), names.repartition(parts, "listing_id")
    last = names.groupBy("listing_id").agg(F.max("path").alias("path"))
    if parts > 1:
        last = last.repartition(parts, "listing_id", "path")
    records = F.coalesce(F.try_variant_get("rv", "$", "array<variant>"), F.array().cast("array<variant>"))
    rows = per.join(last, ["listing_id", "path"], "left_semi").select("file", "listing_id", F.posexplode(records).alias("pos", "r"))

    def field(name, cast):
        return F.try_variant_get("r", f"$.{name}", cast)
    return rows.select("file", "listing_id", F.col("pos").cast("int"),
                       F.coalesce(field("review", "string"), field("comments", "string")).alias("review"),
                       field("rating", "double").alias("rating"))


def read_summaries(spark: SparkSession, path: str, area: str | None = None, glob: str | None = None,
                   wholetext: bool = True) -> DataFrame:
    """``{id: text}`` documents named ``listing_summary_<area>_*.json`` ->
    ``area, listing_id, summary`` (NULL and '' kept; filters decide)."""
    if not _exists(path):
        return _empty(spark, "area string, listing_id string, summary string")
    g = glob or (f"listing_summary_{area}_*.json" if area else "listing_summary_*.json")
    docs = _json_docs(spark, path, g, wholetext)
    ar = F.coalesce(F.nullif(F.regexp_extract("file", r"^listing_summary_([^_]+)_", 1), F.lit("")),
                    F.nullif(F.regexp_extract("path", r"/area=([^/]+)/", 1), F.lit("")))
    out = docs.select(ar.alias("area"),
                      F.explode(F.from_json("doc", "map<string,string>")).alias("listing_id", "summary"))
    return out if area is None else out.where(F.col("area") == area)


def read_descriptions(spark: SparkSession, path: str, glob: str | None = None, wholetext: bool = True) -> DataFrame:
    """``{id: str | list | other}`` -> ``listing_id, description`` (lists joined
    by ' ', other value types dropped; unreadable documents give nothing)."""
    if not _exists(path):
        return _empty(spark, "listing_id string, description string")
    docs = _json_docs(spark, path, glob, wholetext)
    kv = docs.select(F.explode(F.from_json("doc", "map<string,variant>")).alias("listing_id", "v"))
    t = F.schema_of_variant("v")
    as_list = F.array_join(F.transform(F.try_variant_get("v", "$", "array<variant>"),
                                       lambda x: F.coalesce(F.try_variant_get(x, "$", "string"),
                                                            F.to_json(x))), " ")
    val = F.when(t.startswith("ARRAY"), as_list).when(t == "STRING", F.try_variant_get("v", "$", "string"))
    return kv.select("listing_id", val.alias("description")).where(F.col("description").isNotNull())


def read_matrix(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Listing matrix written by :func:`staylens.sources.sinks.write_matrix`
    (parquet by default; CSV with header and an explicit schema)."""
    if not _exists(path):
        return _empty(spark, schema or "listing_id string")
    if fmt == "csv":
        r = spark.read.option("header", True)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
        return r.csv(path)
    return spark.read.parquet(path)
