from pyspark.sql import functions as F

from staylens.operators import reviews as rv


def _reviews(spark, data):
    return spark.createDataFrame(data, "listing_id string, rating double, review string")


def test_null_rating_stays_in_denominator(spark):
    df = _reviews(spark, [("a", 5.0, "x"), ("a", None, "y"), ("a", 4.0, "z")])
    r = rv.listing_mean_rating(df).collect()[0]
    assert r["mean_rating"] == 3.0 and r["n_reviews"] == 3


def test_overall_mean_is_macro_mean_of_rounded_means(spark):
    df = _reviews(spark, [("a", 5.0, ""), ("a", 5.0, ""), ("b", 3.0, ""), ("b", 3.0, "")])
    assert rv.overall_mean_rating(df).collect()[0]["overall_mean"] == 4.0


def test_overall_mean_empty_is_null(spark):
    df = _reviews(spark, [])
    r = rv.overall_mean_rating(df).collect()
    assert r == [] or r[0]["overall_mean"] is None


def test_combined_review_text_and_null_propagation(spark):
    df = spark.createDataFrame([("a", 4, "Test review text"), ("a", None, "t")], "listing_id string, rating int, review string")
    out = [r["combined_review"] for r in rv.with_combined_review(df).orderBy("review").collect()]
    assert out == ["4 Test review text", None]


def test_summary_filters(spark):
    df = spark.createDataFrame([("z", "1", "Good stay"), ("z", "2", ""), ("z", "3", None), ("z", "4", "Why?")],
                               "area string, listing_id string, summary string")
    assert sorted(r["listing_id"] for r in rv.empty_summary_filter(df).collect()) == ["1", "4"]
    assert [r["listing_id"] for r in rv.incomplete_summary_filter(df).collect()] == ["4"]


def test_min_reviews_filter_and_limit(spark):
    data = [("a", 5.0, "")] * 5 + [("b", 4.0, "")] * 2
    df = _reviews(spark, data)
    kept = rv.min_reviews_filter(df, threshold=5)
    assert kept.select("listing_id").distinct().collect()[0]["listing_id"] == "a"
    assert [r[0] for r in rv.limit_listings(df, 10).collect()] == ["a", "b"]
    assert [r[0] for r in rv.limit_listings(df, 1).collect()] == ["a"]


def test_normalize_reviews_defaults(spark):
    raw = spark.createDataFrame([("a", "nice", 5.0), ("a", None, None)], "listing_id string, comments string, rating double")
    out = rv.normalize_reviews(raw).orderBy(F.col("review").asc_nulls_last()).collect()
    assert out[0]["review"] == "nice" and out[1]["review"] is None and out[1]["rating"] is None


def test_normalize_reviews_by_each_records_keys(spark):
    docs = ['{"comments":"nice","rating":5}', '{}', '{"comments":null,"rating":null}', '{"rating":4.5}', '{"comments":""}',
            '{"comments":7,"rating":"x"}', 'null']
    raw = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "listing_id int, doc string").select(
        "listing_id", F.parse_json("doc").alias("record"))
    out = [(r["review"], r["rating"]) for r in rv.normalize_reviews(raw).orderBy("listing_id").collect()]
    assert out == [("nice", 5.0), ("", 0.0), (None, None), ("", 4.5), ("", 0.0), ("7", None), ("", 0.0)]


def test_review_pack_overall_mean_global_or_by_area(spark):
    from staylens.plans import reviews as rp
    data = [("a", i, 5.0, "great") for i in range(5)] + [("b", i, 3.0, "ok") for i in range(5)]
    reviews = spark.createDataFrame(data, "listing_id string, pos int, rating double, review string")
    areas = spark.createDataFrame([("a", "north"), ("b", "south")], "listing_id string, area string")
    tmpl = "{ZIP_CODE_HERE} {RATING_AVERAGE_HERE} {OVERALL_MEAN}"
    g = {r["listing_id"]: r["prompt"] for r in rp.review_pack(reviews, ["pos"], areas, template=tmpl).collect()}
    assert g["a"].startswith("north 5.0 4.0\n\nReviews to analyze:\nReview 1: 5 great")
    a = {r["listing_id"]: r["prompt"] for r in
         rp.review_pack(reviews, ["pos"], areas, template=tmpl, mean_by_area=True).collect()}
    assert a["a"].startswith("north 5.0 5.0") and a["b"].startswith("south 3.0 3.0")


def test_area_report_and_synthesis_prompt(spark):
    from staylens.operators import prompts as pr
    from staylens.plans import reviews as rp
    responses = spark.createDataFrame([("97067", "Nice area."), ("97068", None), ("1", "x")], "area string, response string")
    counts = spark.createDataFrame([("97067", 507), ("97068", 3)], "area string, n_properties long")
    rep = {r["area"]: r["report"] for r in rp.area_report_markdown(responses, counts).collect()}
    assert rep == {"97067": "# Area Summary: 97067\n\n**ISO Code:** us\n\n**Properties Analyzed:** 507\n\n---\n\nNice area."}
    r2 = spark.createDataFrame([(346, 0.8729)], "n long, r_squared double")
    corr = spark.createDataFrame([(1, "sense_of_place", 0.1089, 345), (2, "length", -0.0351, 344)],
                                 "rank int, dimension string, correlation double, n long")
    top = spark.createDataFrame([("top", 1, "7", 230.4, 5.0, None, "By the river"), ("bottom", 1, "9", -152.0, None, None, "Room")],
                                "side string, rank int, listing_id string, residual double, a double, b double, description string")
    tmpl = "{ZIPCODE}|{R_SQUARED}|{NUM_PROPERTIES}|{CORRELATION_TABLE}|{HIGH_PREMIUM_DESCRIPTIONS}|{LOW_PREMIUM_DESCRIPTIONS}"
    got = pr.synthesis_prompt(r2, corr, top, tmpl, ["a", "b"], "97067").collect()[0]["prompt"]
    url = "https://www.airbnb.com/rooms/"
    assert got == ("97067|0.873|346|| Dimension | Correlation | n |\n|-----------|-------------|---|\n"
                   "| Sense Of Place | +0.109 | 345 |\n| Length | -0.035 | 344 |"
                   f"|**Property 7** ([Airbnb listing]({url}7)) (ADR premium: $+230/night)\n  Scores: a: 5.0\nBy the river\n"
                   f"|**Property 9** ([Airbnb listing]({url}9)) (ADR premium: $-152/night)\nRoom\n")
