"""Structured Streaming versions of the two incremental behaviours (2.11).

* ``stream_review_ratings``: review files arrive in a folder and a later file of
  a listing overwrites its earlier ones.  Keyed state holds each listing's last
  file and its sum and count; an overwrite emits the new contribution together
  with the one it retracts, so a running overall mean needs no second look at
  the reviews.  Rows are summed per (listing, file) inside their task before
  they are shuffled, so a hot listing sends one row per batch of a task.
* ``stream_request_cost``: request events with an event time, aggregated per
  session and event-time window in append mode: a window is written once, when
  the watermark passes its end, and rows that come later are left out.

The file source's checkpoint remembers which files were seen (the reference's
"already processed" check).  Both sinks are ``foreachBatch`` writes of one folder
per batch under the shared checkpoint root, which a replayed batch overwrites; a
restarted query resumes from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.scalar import fixed_round, request_cost
from staylens.operators.market import latest_wins
from staylens.session import scratch_path


def _append_batches(out_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # re-running a batch after a failure rewrites the same batch folder
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .parquet(f"{out_path}/batch_id={batch_id}")
    return write


def _latest(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    res = spark.read.option("basePath", out_path).parquet(f"{out_path}/batch_id=*")
    return latest_wins(res, keys, ["batch_id"]).drop("batch_id")


def run_available(stream: DataFrame, out_path: str, checkpoint: str, mode: str = "update") -> None:
    """Process everything available now, then stop (batch-like trigger)."""
    q = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(_append_batches(out_path)).trigger(availableNow=True).start())
    q.awaitTermination()


def review_ratings_stream(spark: SparkSession, source: str, schema: str, key: str = "listing_id",
                          rating: str = "rating", max_files: int | None = None) -> DataFrame:
    """Running per-listing rating sums and counts over a review file folder.

    ``max_files`` caps files per micro-batch (None: everything that has
    landed since the last batch; the checkpoint remembers what was seen)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    src = r.parquet(source)
    return src.groupBy(key).agg(F.sum(F.coalesce(F.col(rating).cast("double"), F.lit(0.0))).alias("rating_sum"),
                                F.count(F.lit(1)).alias("n_reviews"))


def land(rows: DataFrame, arrival: str, count: int, source: str):
    """Lands ``rows`` in the folder ``source`` arrival by arrival (column
    ``arrival``, 0 to ``count`` - 1); yields after each.  The rows are written
    once, split by arrival, and each arrival reads its own part."""
    spark = rows.sparkSession
    parts = scratch_path(spark, "stream-arrivals")
    rows.write.partitionBy(arrival).parquet(parts)
    schema = rows.drop(arrival).schema
    for k in range(count):
        part = spark.read.schema(rows.schema).parquet(parts).where(F.col(arrival) == k).select(*schema.names)
        part.write.mode("append").parquet(source)
        yield k


BUCKETS = 512   # state rows; one holds the listings of a bucket, so choose listings / a few thousand at most
STATE = "keys array<string>, files array<string>, sums array<double>, counts array<long>"
UPDATE = "key string, file string, rating_sum double, n_reviews long, old_sum double, old_n long"


def partial_ratings(src: DataFrame, key: str, rating: str = "rating") -> DataFrame:
    """key, file, rating_sum, n_reviews of the last file of each key in each Arrow
    batch (NULL ratings count as 0): rows of a file that the same batch
    overwrites need not travel."""
    rows = src.select(key, "file", F.coalesce(F.col(rating).cast("double"), F.lit(0.0)).alias("r"))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            t = pa.Table.from_batches([b]).group_by([key, "file"]).aggregate([("r", "sum"), ("r", "count")])
            t = t.sort_by([(key, "ascending"), ("file", "descending")])
            k = t.column(key).combine_chunks()
            first = pa.array([True] * min(1, len(k)) + pc.fill_null(pc.not_equal(k[1:], k[:-1]), True).to_pylist())
            yield from t.filter(first).select([key, "file", "r_sum", "r_count"]).rename_columns(
                [key, "file", "rating_sum", "n_reviews"]).to_batches()

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, file string, rating_sum double, n_reviews long")


def _last_files(bucket, frames, state):
    """State of a bucket: each listing's last file with its sum and count."""
    import pandas as pd
    held = {k: (f, t, n) for k, f, t, n in zip(*state.get)} if state.exists else {}
    before = {}
    for pdf in frames:
        for k, f, t, n in zip(*(pdf[c].tolist() for c in ("key", "file", "rating_sum", "n_reviews"))):
            old = held.get(k, ("", 0.0, 0))
            before.setdefault(k, old)
            if f > old[0]:          # a later file takes the place of the listing's reviews
                held[k] = (f, t, n)
            elif f == old[0]:       # more of the same file
                held[k] = (f, old[1] + t, old[2] + n)
    changed = [(k, *held[k], old[1], old[2]) for k, old in before.items() if held.get(k, old) != old]
    if changed:
        state.update((list(held), *(list(c) for c in zip(*held.values()))))
    yield pd.DataFrame(changed, columns=["key", "file", "rating_sum", "n_reviews", "old_sum", "old_n"])


def last_file_ratings(src: DataFrame, key: str = "listing_id", rating: str = "rating", buckets: int = BUCKETS) -> DataFrame:
    """Stream of updates per listing: its last file's sum and count, and the
    ones they replace (count 0: the listing is new).  ``src`` has ``file``, whose
    order says which file is later; files may arrive in any order.  State is kept
    per bucket of listings (``buckets`` stays the same for the life of a
    checkpoint), which spares a Python call per listing."""
    kt = src.schema[key].dataType.simpleString()
    parts = partial_ratings(src.withColumn(key, F.col(key).cast("string")), key, rating).withColumnRenamed(key, "key")
    rows = parts.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    out = rows.groupBy("bucket").applyInPandasWithState(_last_files, UPDATE, STATE, "update", "NoTimeout")
    return out.withColumn("key", F.col("key").cast(kt)).withColumnRenamed("key", key)


def running_overall_mean(updates: DataFrame) -> DataFrame:
    """Mean over listings of their rounded means, from the updates alone: each
    adds its new mean and takes back the one it retracts."""
    new = fixed_round(F.col("rating_sum") / F.col("n_reviews"), 4)
    old = F.when(F.col("old_n") > 0, fixed_round(F.try_divide("old_sum", "old_n"), 4)).otherwise(F.lit(0.0))
    return updates.agg(fixed_round(F.try_divide(F.sum(new - old), F.sum(F.when(F.col("old_n") == 0, 1).otherwise(0))), 4)
                       .alias("overall_mean"))


def stream_review_ratings(spark: SparkSession, reviews: DataFrame, key: str = "listing_id",
                          rating: str = "rating", file: str = "file", arrival: str = "arrival", arrivals: int = 3):
    """Lands ``reviews`` in ``arrivals`` steps and streams them; returns the
    updates (every micro-batch) and the ratings of each listing's last file."""
    src, out, ck = (scratch_path(spark, f"stream-reviews-{x}") for x in ("src", "out", "ck"))
    rows = reviews.select(key, rating, F.col(file).alias("file"), F.col(arrival).alias("arrival"))
    schema = rows.drop("arrival").schema
    for _ in land(rows, "arrival", arrivals, src):
        run_available(last_file_ratings(spark.readStream.schema(schema).parquet(src), key, rating), out, ck, "update")
    updates = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*")
    last = latest_wins(updates, [key], ["batch_id"])
    return updates, last.select(key, fixed_round(F.col("rating_sum") / F.col("n_reviews"), 4).alias("mean_rating"), "n_reviews")


def request_cost_stream(src: DataFrame, watermark: str, window: str, session: str = "session") -> DataFrame:
    """Per (session, event-time window): requests, cache hits, uncached tokens and cost."""
    unc = ~F.col("cached")
    return (src.withWatermark("ts", watermark)
            .groupBy(session, F.window("ts", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("total_requests"),
                 F.sum(F.when(F.col("cached"), 1).otherwise(0)).alias("cache_hits"),
                 F.sum(F.when(unc, F.col("input_tokens")).otherwise(0)).alias("total_input_tokens"),
                 F.sum(F.when(unc, F.col("output_tokens")).otherwise(0)).alias("total_output_tokens"),
                 F.sum(F.when(unc, F.col("cost")).otherwise(0.0)).alias("total_cost")))


def stream_request_cost(spark: SparkSession, costed: DataFrame, watermark: str = "30 days",
                        window: str = "1 day", arrival: str | None = None, arrivals: int = 1,
                        mode: str = "update") -> DataFrame:
    """Lands costed requests in ``arrivals`` steps (column ``arrival``) and
    streams them through the watermarked windowed aggregate.  Rows that come
    after the watermark closed their window are left out.  ``append`` gives the
    windows it closed, each written once; ``update`` the last state of every
    window, open ones included."""
    cols = ["session", "listing_id", "ts", "cached", "input_tokens", "output_tokens", "cost"]
    src, out, ck = (scratch_path(spark, f"stream-cost-{x}") for x in ("src", "out", "ck"))
    rows = costed.select(*cols, (F.col(arrival) if arrival else F.lit(0)).cast("int").alias("arrival"))
    schema = rows.drop("arrival").schema
    for _ in land(rows, "arrival", arrivals, src):
        stream = request_cost_stream(spark.readStream.schema(schema).parquet(src), watermark, window).select(
            "session", F.col("w.start").alias("window_start"), "total_requests", "cache_hits",
            "total_input_tokens", "total_output_tokens", "total_cost")
        run_available(stream, out, ck, mode)
    if mode == "append":
        res = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*").drop("batch_id")
    else:
        res = _latest(spark, out, ["session", "window_start"])
    return res.withColumn("total_cost", fixed_round("total_cost", 4))


__all__ = ["last_file_ratings", "review_ratings_stream", "request_cost", "request_cost_stream",
           "running_overall_mean", "stream_request_cost", "stream_review_ratings"]
