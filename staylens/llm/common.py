"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.session import scratch_path

# A word is a run of anything but the six ASCII white-space characters.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage
    ends there, so a lost executor costs a re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """Array of the words of a text; null or blank text: empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fnull(df: DataFrame, col: str, default) -> Column:
    """Column ``col`` of ``df``, or a literal where the frame lacks it."""
    return F.col(col) if col in df.columns else F.lit(default)


def ranked(df: DataFrame, order: list[str], name: str, rank: str = "rank") -> DataFrame:
    """Gapless global rank (from 0) in ascending ``order`` without a
    single-task sort: range partitions are sorted, written with their row
    numbers, and each partition is shifted by the rows of the ones before it
    (one number per partition reaches the driver)."""
    spark = df.sparkSession
    out = (df.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
           .withColumn("_at", F.monotonically_increasing_id()))
    out = cut(out, name)
    part = F.shiftright("_at", 33)
    sizes = {r[0]: r[1] for r in out.groupBy(part.alias("p")).count().collect()}
    before, total = {}, 0
    for p in sorted(sizes):
        before[p], total = total, total + sizes[p]
    offsets = spark.createDataFrame([(int(p), int(n)) for p, n in before.items()], "_p long, _before long")
    row = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (out.withColumn("_p", part).join(offsets, "_p")
            .withColumn(rank, F.col("_before") + row).drop("_p", "_before", "_at")), total


def write_binary(df: DataFrame, path: str, column: str, sync: bytes) -> None:
    """Write one binary column as raw files, one per partition: every value is
    followed by the marker ``sync``.  Goes through Spark's own file writer, so
    any shared store works and a retried task leaves no partial file."""
    (df.select(F.col(column).cast("string").alias("value")).write
     .option("encoding", "ISO-8859-1").option("lineSep", sync.decode("latin-1")).text(path))


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """path, content of the files of :func:`write_binary`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content")
