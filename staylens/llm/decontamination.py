"""Benchmark decontamination: SimHash of item-sized windows, looked up in a
multi-index of Hamming blocks, then exact weighted-shingle similarity.

* Words are runs of letters and digits, lower case; shingles are five words,
  weighted by how often they occur.
* A window has the length of an item.  A window whose similarity reaches the
  threshold shares shingles with the item, so only windows aligned at a shared
  shingle are fingerprinted; no window that could be reported is left out.
* The 64 fingerprint bits are cut into ``RADIUS + 1`` blocks.  Two fingerprints
  within ``RADIUS`` agree on at least one whole block, so equal blocks find all
  of them; the pair is taken at the first block it agrees on.
* A pair is reported when the multiset similarity (sum of minima over sum of
  maxima of the shingle counts) is at least ``SIMILARITY``.  At that threshold
  two fingerprints differ in 9.7 bits on average (standard deviation 2.9).

All of it is DataFrame expressions.

Defined cases: null and short texts (under five words) hold no item; items of
under five words match nothing; a document shorter than an item is one window;
repeated rows are found once per doc_id and item; empty tables give no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import cut, load

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
BROADCAST_ROWS = 1 << 18   # of benchmark shingles, 32 bytes each; above, a shuffled join


def word_hashes(text: Column) -> Column:
    w = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    return F.transform(w, lambda x: F.xxhash64(x))


def shingles(h: Column, k: int = SHINGLE) -> Column:
    """Hashes of the k-word shingles of an array of word hashes, in order."""
    return F.when(F.size(h) >= k, F.transform(F.sequence(F.lit(1), F.size(h) - (k - 1)),
                                              lambda i: F.xxhash64(F.slice(h, i, k)))) \
        .otherwise(F.array().cast("array<bigint>"))


def simhash(col: str) -> Column:
    """64-bit SimHash of an array of hashes: a bit is set when it is set in
    more than half of the elements (each occurrence counts)."""
    return F.expr(f"""aggregate(sequence(0, 63), 0L, (acc, b) -> acc | if(
        2 * size(filter({col}, x -> (shiftright(x, b) & 1L) = 1L)) > size({col}), shiftleft(1L, b), 0L))""")


def block_cuts(radius: int = RADIUS) -> list[tuple[int, int]]:
    """(first bit, bits) of the ``radius + 1`` blocks of a fingerprint."""
    m = radius + 1
    edges = [round(i * 64 / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def blocks(fp: Column, radius: int = RADIUS) -> Column:
    """Array of block values."""
    return F.array(*[F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << n) - 1)) for a, n in block_cuts(radius)])


def similarity(a: str, b: str) -> Column:
    """Sum of minima over sum of maxima of the element counts of two arrays."""
    both = f"""aggregate(array_intersect({a}, {b}), 0, (acc, s) -> acc + least(
        size(filter({a}, x -> x = s)), size(filter({b}, x -> x = s))))"""
    return F.expr(f"{both} / cast(size({a}) + size({b}) - {both} as double)")


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    h = word_hashes(F.col("text"))
    return (benchmark.select("item_id", h.alias("h")).where(F.size("h") >= SHINGLE)
            .select("item_id", F.size("h").alias("n"), shingles(F.col("h")).alias("item_shingles"))
            .withColumn("item_fp", simhash("item_shingles")))


def contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS,
                 threshold: float = SIMILARITY) -> DataFrame:
    """doc_key, doc_id, item_id, start (word number of the window), n_words,
    hamming, similarity: the best window of each document and item found."""
    items = cut(benchmark_items(benchmark), "bench-items")
    spots = cut(items.select("n", F.posexplode("item_shingles").alias("ipos", "s")).distinct(), "bench-shingles")
    if spots.count() <= BROADCAST_ROWS:
        spots = F.broadcast(spots)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", text).alias("doc_key"))
    found = (keyed.select("doc_key", word_hashes(F.col("text")).alias("h"))
             .select("doc_key", F.size("h").alias("len"), F.posexplode(shingles(F.col("h"))).alias("pos", "s"))
             .join(spots, "s"))
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("ipos"), F.col("len") - F.col("n")))
    spans = (found.select("doc_key", start.alias("start"), "n").distinct()
             .groupBy("doc_key").agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    spans = cut(spans, "bench-spans")
    windows = (keyed.join(spans, "doc_key").dropDuplicates(["doc_key"])
               .select("doc_id", "doc_key", word_hashes(F.col("text")).alias("h"), "spans")
               .select("doc_id", "doc_key", "h", F.inline("spans"))
               .select("doc_id", "doc_key", "start", "n",
                       shingles(F.slice(F.col("h"), F.col("start") + 1, F.col("n"))).alias("win_shingles"))
               .withColumn("fp", simhash("win_shingles")))
    windows = cut(windows, "bench-windows")
    index = items.select("item_id", "item_fp", "item_shingles", F.col("n").alias("item_n"),
                         F.posexplode(blocks(F.col("item_fp"), radius)).alias("block", "value"))
    index = cut(index, "bench-index")
    probes = windows.select("*", blocks(F.col("fp"), radius).alias("own")) \
        .select("*", F.posexplode("own").alias("b", "v"))
    pairs = probes.join(index, (F.col("n") == F.col("item_n")) & (F.col("b") == F.col("block"))
                        & (F.col("v") == F.col("value")))
    agree = F.transform(F.arrays_zip(F.col("own"), blocks(F.col("item_fp"), radius).alias("theirs")),
                        lambda z: z["own"] == z["theirs"])
    hamming = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    pairs = (pairs.withColumn("hamming", hamming).where(F.col("hamming") <= radius)
             .where(F.array_position(agree, F.lit(True)) == F.col("b") + 1)
             .withColumn("similarity", similarity("win_shingles", "item_shingles"))
             .where(F.col("similarity") >= threshold))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), (-F.col("hamming")).alias("h"), "n")).alias("m")
    return (pairs.groupBy("doc_key", "doc_id", "item_id").agg(best)
            .select("doc_key", "doc_id", "item_id", (-F.col("m.s")).alias("start"), F.col("m.n").alias("n_words"),
                    (-F.col("m.h")).alias("hamming"), F.col("m.similarity").alias("similarity")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; same columns."""
    leaks = cut(contaminated(docs, benchmark, **options).select("doc_key").distinct(), "bench-leaks")
    key = F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit("")))
    return (docs.withColumn("_bench_key", key)
            .join(leaks.withColumnRenamed("doc_key", "_bench_key"), "_bench_key", "left_anti").drop("_bench_key"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    bench = load(spark, sf_dir, "benchmark").select("item_id", "text")
    return contaminated(docs, bench).drop("doc_key").distinct()
