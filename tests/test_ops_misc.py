from pyspark.sql import functions as F

from staylens.functions import scalar as sc
from staylens.operators import costs as cs
from staylens.operators import freshness as fr
from staylens.operators import grid as gd


def test_request_cost_literals(spark):
    df = spark.createDataFrame([(1000000, 0, False), (0, 1000000, False), (500000, 250000, False),
                                (1000000, 1000000, True)], "i long, o long, c boolean")
    out = [r[0] for r in df.select(sc.request_cost("i", "o", "c")).collect()]
    assert out == [0.4, 1.6, 0.6, 0.0]


def test_session_summary_counts(spark):
    reqs = spark.createDataFrame([(1, "l1", "p", "resp", True, False), (1, "l2", "p", "resp", True, True),
                                  (1, "l3", "p", None, False, False)],
                                 "session int, listing_id string, prompt string, response string, "
                                 "success boolean, cached boolean")
    s = cs.request_cost_session(cs.request_costs(reqs)).collect()[0]
    assert (s["total_requests"], s["successful_requests"], s["failed_requests"], s["cache_hits"],
            s["unique_listings"]) == (3, 2, 1, 1, 3)
    assert s["cache_hit_rate"] == 33.3 and s["total_output_tokens"] == 1


def test_bbox_literal(spark):
    c = spark.createDataFrame([("97224", 45.5155, -122.6789)], "area string, lat double, lon double")
    r = gd.area_bbox(c).collect()[0]
    assert (r["ne_lat"], r["sw_lat"]) == (round(45.5155 + 0.14, 7), round(45.5155 - 0.14, 7))
    assert (r["ne_lon"], r["sw_lon"]) == (round(-122.6789 + 0.14, 7), round(-122.6789 - 0.14, 7))
    cells = gd.bbox_grid(gd.area_bbox(c))
    assert cells.count() == 4
    pts = spark.createDataFrame([("x", "97224", 45.52, -122.60), ("y", "97224", 45.40, -122.70),
                                 ("z", "97224", 46.0, -122.6)], "listing_id string, area string, lat double, lon double")
    hits = {r["listing_id"]: r["cell_no"] for r in gd.grid_range_join(pts, cells).collect()}
    assert hits == {"x": 3, "y": 0}


def test_freshness_missing_stale_fresh(spark):
    listings = spark.createDataFrame([("a",), ("b",), ("c",)], "listing_id string")
    manifest = spark.createDataFrame([("s1", "a", "2024-01-30 12:00:00"), ("s1", "b", "2024-01-01 00:00:00")],
                                     "stage string, listing_id string, mtime string") \
        .withColumn("mtime", F.col("mtime").cast("timestamp"))
    exp = fr.expected_outputs(listings, ["s1"])
    missing = sorted(r["listing_id"] for r in fr.missing_outputs(exp, manifest, "2024-01-31 00:00:00", 72).collect())
    assert missing == ["b", "c"]
    st = fr.stage_freshness(exp, manifest, "2024-01-31 00:00:00", 72).collect()[0]
    assert (st["expected"], st["fresh_outputs"], st["stage_fresh"]) == (3, 1, False)
    gate = fr.coverage_gate(exp, manifest.select("stage", "listing_id")).collect()[0]
    assert gate["missing"] == 1 and gate["retry"]  # 1/3 > 0.20
    ids = listings
    assert fr.resolved_prescan(ids, manifest).count() + fr.id_difference(ids, manifest).count() == 3


def test_text_helpers(spark):
    df = spark.createDataFrame([("a  b c\td ",)], "t string")
    r = df.select(sc.word_count("t"), sc.truncate_sample(F.lit("x" * 501)), sc.display_name(F.lit("SYSTEM_POOL_TABLE")),
                  sc.threshold_label(F.lit(364.1), "$"), sc.threshold_label(F.lit(64.0), "%")).collect()[0]
    assert r[0] == 4 and r[1] == "x" * 500 + "..." and r[2] == "Pool Table" and r[3] == "$364.10" and r[4] == "64.0%"


def test_stage_freshness_forced_stage(spark):
    listings = spark.createDataFrame([("a",)], "listing_id string")
    manifest = spark.createDataFrame([("s1", "a", "2024-01-30 12:00:00"), ("s2", "a", "2024-01-30 12:00:00")],
                                     "stage string, listing_id string, mtime string") \
        .withColumn("mtime", F.col("mtime").cast("timestamp"))
    exp = fr.expected_outputs(listings, ["s1", "s2"])
    out = {r["stage"]: r["stage_fresh"] for r in
           fr.stage_freshness(exp, manifest, "2024-01-31 00:00:00", 72, force_stages=["s2"]).collect()}
    assert out == {"s1": True, "s2": False}


def test_merge_requests_listing_count(spark):
    reqs = spark.createDataFrame([(1, "l1", "p", "r", True, False), (1, "l1_merge", "Merge prompt", "r", True, False)],
                                 "session int, listing_id string, prompt string, response string, "
                                 "success boolean, cached boolean")
    c = cs.request_costs(reqs)
    assert cs.request_cost_session(c).collect()[0]["unique_listings"] == 2
    assert cs.request_cost_session(c, strip_merge_suffix=True).collect()[0]["unique_listings"] == 1


def test_expected_outputs_by_rule(spark):
    """Summaries expect listings with reviews only, reports one row per area, and
    an area whose search found nothing expects no listing and no merged set."""
    areas = spark.createDataFrame([("A",), ("B",)], "area string")
    found = spark.createDataFrame([("A", 1), ("A", 2), ("A", 2)], "area string, listing_id long")
    reviews = spark.createDataFrame([("A", 2)], "area string, listing_id long")
    exp = fr.expected_by_rule(areas, {"listing": found, "reviews": reviews})
    rows = {(r["stage"], r["area"], r["listing_id"], r["output"]) for r in exp.collect()}
    assert len(rows) == exp.count()
    assert {r[3] for r in rows if r[0] == "listing_summaries"} == {"listing_summary_A_2.json"}
    assert {r[3] for r in rows if r[0] == "comp_sets"} == {"listing_1.json", "listing_2.json", "comp_set_A.json"}
    assert {r[3] for r in rows if r[0] == "reviews_scrape"} == {"reviews_A_1.json", "reviews_A_2.json"}
    assert {r[3] for r in rows if r[:2] == ("correlation_results", "B")} == {
        "correlation_stats_adr_B.json", "correlation_insights_adr_B.md", "correlation_stats_occupancy_B.json",
        "correlation_insights_occupancy_B.md"}
    assert all(r[2] is None for r in rows if r[1] == "B") and len([r for r in rows if r[0] == "details_results"]) == 10
    groups = areas.selectExpr("area", "explode(array('comp_sets', 'area_summary')) AS stage")
    manifest = spark.createDataFrame([("area_summary", "area_summary_B.md", "2024-01-30 12:00:00")],
                                     "stage string, output string, mtime string").selectExpr(
        "stage", "output", "CAST(mtime AS TIMESTAMP) AS mtime")
    got = {(r["stage"], r["area"]): (r["expected"], r["fresh_outputs"], r["stage_fresh"]) for r in fr.stage_freshness(
        exp, manifest, "2024-01-31 00:00:00", 72, key="output", groups=groups).collect()}
    assert got == {("comp_sets", "A"): (3, 0, False), ("comp_sets", "B"): (0, 0, False),
                   ("area_summary", "A"): (1, 0, False), ("area_summary", "B"): (1, 1, True)}


def test_grid_edges_equal_a_test_of_every_cell(spark):
    """Steps that are no binary fractions, points on and beside every edge."""
    import math
    for d, sw, half in ((2, 45.3755, 0.14), (7, -122.8189, 0.14), (100, 0.1, 0.05), (3, -0.3, 0.3)):
        c = spark.createDataFrame([("a", sw + half, sw + half), ("b", 5.0, 5.0)], "area string, lat double, lon double")
        cells = gd.bbox_grid(gd.area_bbox(c, half_width=half), d)
        rows = [r for r in cells.collect() if r["area"] == "a"]
        edges = sorted({r[k] for r in rows for k in ("box_sw_lat", "box_ne_lat")})
        near = [x for e in edges for x in (e, math.nextafter(e, -1e9), math.nextafter(e, 1e9))]
        near = near if d < 50 else near[::7]
        pts = [(i, "a", x, edges[0] + (edges[-1] - edges[0]) * 0.37) for i, x in enumerate(near)]
        pts += [(1000 + i, "a", edges[0] + (edges[-1] - edges[0]) * 0.62, x) for i, x in enumerate(near)] + [(-1, "c", 0.0, 0.0)]
        df = spark.createDataFrame(pts, "listing_id long, area string, lat double, lon double")
        got = sorted((r["listing_id"], r["cell_no"]) for r in gd.grid_range_join(df, cells, d).collect())
        want = sorted((p[0], r["cell_no"]) for p in pts if p[1] == "a" for r in rows
                      if r["box_sw_lat"] <= p[2] < r["box_ne_lat"] and r["box_sw_lon"] <= p[3] < r["box_ne_lon"])
        assert got == want and len(want) > d // 2
