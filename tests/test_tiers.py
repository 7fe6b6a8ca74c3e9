from pyspark.sql import functions as F

from staylens.operators import tiers as tr


def test_prevalence_string_false(spark):
    high = [("p1", "Private hot tub", "False", "Fire pit"), ("p2", "False", "False", "Fire pit"),
            ("p3", "Hot tub", "False", "Fire pit"), ("p4", "False", "False", "False")]
    low = [("p5", "False", "False", "False"), ("p6", "False", "False", "False"), ("p7", "False", "False", "False")]
    rows = [(*r, "adr", "high") for r in high] + [(*r, "adr", "low") for r in low]
    df = spark.createDataFrame(rows, "listing_id string, SYSTEM_JACUZZI string, SYSTEM_POOL string, "
                                     "SYSTEM_FIREPIT string, metric string, tier string")
    out = {r["amenity"]: r for r in tr.amenity_prevalence(df).collect()}
    assert (out["SYSTEM_JACUZZI"]["high_tier_pct"], out["SYSTEM_JACUZZI"]["low_tier_pct"],
            out["SYSTEM_JACUZZI"]["difference"]) == (50.0, 0.0, 50.0)
    assert (out["SYSTEM_POOL"]["high_tier_pct"], out["SYSTEM_POOL"]["low_tier_pct"]) == (0.0, 0.0)
    assert (out["SYSTEM_FIREPIT"]["high_tier_pct"], out["SYSTEM_FIREPIT"]["low_tier_pct"]) == (75.0, 0.0)
    # ranked by |difference| desc, ties in declared order
    ranks = {r["amenity"]: r["rank"] for r in out.values()}
    assert ranks == {"SYSTEM_FIREPIT": 1, "SYSTEM_JACUZZI": 2, "SYSTEM_POOL": 3}


def _adr(spark):
    data = [("p0", "300", 4), ("p1", "250", 6), ("p2", "200", 3), ("p3", "180", 5), ("p4", "150", 2),
            ("p5", "120", 4), ("p6", "100", 3), ("p7", "False", 2)]
    return spark.createDataFrame(data, "listing_id string, ADR string, capacity int")


def test_false_metric_rows_excluded_and_thresholds(spark):
    df = _adr(spark)
    th = tr.tier_thresholds(df, {"adr": "ADR"}).collect()[0]
    import numpy as np
    vals = [300, 250, 200, 180, 150, 120, 100]
    assert abs(th["high_threshold"] - np.quantile(vals, 0.75)) < 1e-9
    assert abs(th["low_threshold"] - np.quantile(vals, 0.25)) < 1e-9
    tiered = tr.tier_assign(df, {"adr": "ADR"}).collect()
    assert "p7" not in {r["listing_id"] for r in tiered}
    assert th["high_threshold"] > th["low_threshold"]


def test_tiers_inclusive_and_overlapping(spark):
    df = spark.createDataFrame([(f"p{i}", 10.0) for i in range(5)], "listing_id string, v double")
    t = tr.tier_assign(df, {"m": "v"}).collect()
    # all equal: every row is in both tiers
    assert sorted((r["listing_id"], r["tier"]) for r in t) == sorted(
        [(f"p{i}", "high") for i in range(5)] + [(f"p{i}", "low") for i in range(5)])


def test_fewer_than_four_valid_rows_gives_no_threshold(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", 0.0)], "listing_id string, v double")
    assert tr.tier_thresholds(df, {"m": "v"}).count() == 0


def test_grouped_thresholds(spark):
    rows = [("x", f"x{i}", float(i)) for i in range(1, 9)] + [("y", f"y{i}", float(10 * i)) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "area string, listing_id string, v double")
    t = tr.tier_assign(df, {"m": "v"}, by="area")
    counts = {(r["area"], r["tier"]): r["n"] for r in tr.tier_counts(t, by="area").collect()}
    assert counts == {("x", "high"): 2, ("x", "low"): 2, ("y", "high"): 2, ("y", "low"): 2}


def test_numeric_stats_coerce_and_zero_when_all_null(spark):
    rows = [("a", "m", "high", "3", None), ("b", "m", "high", "False", None), ("c", "m", "low", "1", None)]
    df = spark.createDataFrame(rows, "listing_id string, metric string, tier string, bedrooms string, beds string")
    out = {r["attribute"]: r for r in tr.numeric_tier_stats(df, ["bedrooms", "beds"]).collect()}
    assert (out["bedrooms"]["high_tier_avg"], out["bedrooms"]["low_tier_avg"], out["bedrooms"]["difference"]) == (3.0, 1.0, 2.0)
    assert (out["beds"]["high_tier_avg"], out["beds"]["low_tier_avg"]) == (0.0, 0.0)


def test_quantiles_by_refinement(spark, monkeypatch):
    """Several rounds of few bins against numpy: skewed, tied, huge and far
    smaller values, a null group, a hot group with a third of the rows."""
    import numpy as np
    rng = np.random.default_rng(7)
    data = {"hot": rng.lognormal(0, 3, 900), "ties": rng.integers(1, 4, 400).astype(float), "one": np.full(300, 2.5),
            "wide": np.concatenate([[1e-300, 1e300, np.inf], rng.uniform(0, 1, 200)]), None: rng.normal(0, 1, 300), "few": np.array([5.0, 6.0])}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("few", None), ("few", float("nan"))]
    df = spark.createDataFrame(rows, "area string, v double")
    for bins, ranked in ((4, 3), (1024, 100), (1024, 10_000)):
        monkeypatch.setattr(tr, "BINS", bins)
        monkeypatch.setattr(tr, "RANKED", ranked)
        got = {r["area"]: r for r in tr.exact_quantiles(df, ["area"], "v", [0.75, 0.25, 1.0]).collect()}
        assert set(got) == set(data)
        for k, vs in data.items():
            assert got[k]["n"] == len(vs)
            want = [np.quantile(vs, p) for p in (0.75, 0.25)] + [vs.max()]
            assert np.allclose([got[k][f"q{i}"] for i in range(3)], want, rtol=1e-12)
        assert tr.exact_quantiles(df.where("false"), ["area"], "v", [0.5]).count() == 0
    assert tr.exact_quantiles(df.where("area = 'hot'"), [], "v", [0.5]).collect()[0]["q0"] == np.quantile(data["hot"], 0.5)
    th = {r["area"] for r in tr.tier_thresholds(df.withColumn("listing_id", F.lit(1)), {"m": "v"}, by="area").collect()}
    assert th == {"hot", "ties", "one", "wide", None}   # fewer than four valid rows: no thresholds


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=4, max_size=40))
def test_rank_quantiles_with_ties_match_numpy(spark, vals):
    import numpy as np
    df = spark.createDataFrame([(f"l{i}", float(v)) for i, v in enumerate(vals)], "listing_id string, v double")
    q = tr.exact_quantiles(df.withColumn("g", F.lit("a")), ["g"], "v", [0.75, 0.25]).collect()[0]
    assert abs(q["q0"] - np.quantile(vals, 0.75)) < 1e-9 and abs(q["q1"] - np.quantile(vals, 0.25)) < 1e-9


def test_insight_prompt_without_samples_says_so(spark):
    from staylens.plans import tiers as tp
    from staylens.plans.templates import NO_DESCRIPTIONS
    report = spark.createDataFrame(
        [("adr", 364.1, 201.8, 25, 25, "TABLE")],
        "metric string, high_threshold double, low_threshold double, top_percentile int, "
        "bottom_percentile int, comparison_text string")
    samples = spark.createDataFrame([("adr", "high", 1, "Property 7: nice")],
                                    "metric string, tier string, sample_rank int, sample string")
    out = tp.tier_insight_prompts(report, samples, "{HIGH_THRESHOLD}|{LOW_THRESHOLD}|{FEATURE_COMPARISON}|"
                                  "{HIGH_TIER_DESCRIPTIONS}|{LOW_TIER_DESCRIPTIONS}", "97067").collect()[0]
    assert out["prompt"] == f"$364.10|$201.80|TABLE|Property 7: nice|{NO_DESCRIPTIONS}"
