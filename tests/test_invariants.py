"""Invariants on the driver tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, has_data

pytestmark = pytest.mark.skipif(not has_data(), reason="driver tables not present")


def test_residuals_sum_to_zero_and_r_bounded(spark):
    from staylens.plans import registry as rg
    from staylens.operators import premium as pm
    from staylens.sources import bindings as b
    _f, model, res = rg._ols(spark, SF_SMALL)
    agg = res.agg(F.sum("residual").alias("s"), F.sum(F.abs("actual")).alias("a")).first()
    assert abs(agg["s"]) < 1e-6 * agg["a"]
    corr = pm.dimension_correlation(b.b_scores(spark, SF_SMALL), b.b_residuals(spark, SF_SMALL))
    assert all(-1.0 <= r["correlation"] <= 1.0 for r in corr.collect())


def test_chunks_partition_the_reviews(spark):
    from staylens.operators import packing as pk
    from staylens.sources import bindings as b
    items = b.b_reviews(spark, SF_SMALL).withColumn("text", F.col("review"))
    ch = pk.chunk_reviews(items, "listing_id", b.LINEITEM_ORDER, "text", prompt_tokens=5, limit=40)
    assert ch.count() == items.count()
    # inside a listing chunks are numbered 1..k and items 1..m without gaps
    per = ch.groupBy("listing_id", "chunk_no").agg(F.max("item_no").alias("m"), F.count(F.lit(1)).alias("c"))
    assert per.where(F.col("m") != F.col("c")).count() == 0
    lst = per.groupBy("listing_id").agg(F.max("chunk_no").alias("k"), F.count(F.lit(1)).alias("c"))
    assert lst.where(F.col("k") != F.col("c")).count() == 0
    # each chunk stays within the budget unless it holds a single over-budget item
    tok = ch.groupBy("listing_id", "chunk_no").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("c"))
    assert tok.where((F.col("t") > 35) & (F.col("c") > 1)).count() == 0


def test_anti_plus_semi_is_everything(spark):
    from staylens.operators import freshness as fr
    from staylens.sources import bindings as b
    from staylens.sources.tables import table
    ids = table(spark, SF_SMALL, "events").select(F.col("user_id").alias("listing_id")).distinct()
    done = b.b_manifest(spark, SF_SMALL).where(F.col("stage") == "purchase")
    assert fr.resolved_prescan(ids, done).count() + fr.id_difference(ids, done).count() == ids.count()


def test_disabled_or_forced_cache_is_never_fresh(spark):
    from staylens.operators import freshness as fr
    from staylens.sources import bindings as b
    m = b.b_manifest(spark, SF_SMALL)
    assert fr.with_freshness(m, "2024-01-31 00:00:00", 72).where("fresh").count() > 0
    assert fr.with_freshness(m, "2024-01-31 00:00:00", 72, enabled=False).where("fresh").count() == 0
    assert fr.with_freshness(m, "2024-01-31 00:00:00", 72, force_refresh=True).where("fresh").count() == 0


def test_expected_outputs_exclusion(spark):
    from staylens.operators import freshness as fr
    ls = spark.createDataFrame([("a",), ("b",)], "listing_id string")
    ex = spark.createDataFrame([("reviews", "b")], "stage string, listing_id string")
    out = sorted(tuple(r) for r in fr.expected_outputs(ls, ["reviews", "details"], exclude=ex).collect())
    assert out == [("details", "a"), ("details", "b"), ("reviews", "a")]


def test_stream_cost_equals_batch(spark):
    from staylens.operators import costs as cs
    from staylens.sources import bindings as b
    from staylens.streaming.incremental import stream_request_cost
    costed = cs.request_costs(b.b_requests(spark, SF_SMALL))
    s = stream_request_cost(spark, costed)
    batch = costed.groupBy("session", F.window("ts", "1 day").start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("total_requests"))
    got = sorted((r["session"], r["window_start"], r["total_requests"]) for r in s.collect())
    exp = sorted((r["session"], r["window_start"], r["total_requests"]) for r in batch.collect())
    assert got == exp


def test_packing_does_not_depend_on_the_partitions(spark):
    from staylens.operators import packing as pk
    from staylens.sources import bindings as b
    items = b.b_reviews(spark, SF_SMALL).withColumn("text", F.col("review"))
    cols = ["listing_id", "chunk_no", "item_no", "text", "tokens", "truncated"]
    few, many = (pk.chunk_reviews(items, "listing_id", b.LINEITEM_ORDER, "text", prompt_tokens=5, limit=30, partitions=n)
                 for n in (1, 70))   # 70 partitions: more exit tables than one task composes
    a = sorted(tuple(r[c] for c in cols) for r in few.collect())
    assert a == sorted(tuple(r[c] for c in cols) for r in many.collect()) and len(a) == items.count()
