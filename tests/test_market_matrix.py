from pyspark.sql import functions as F

from staylens.functions import scalar as sc
from staylens.operators import market as mk
from staylens.operators import matrix as mx


def test_parsers(spark):
    df = spark.createDataFrame([("$945.57", "$1,234.56", "88%", "335 days", "$47.8K", "$1.2M", "$174900")],
                               "a string, b string, c string, d string, e string, f string, g string")
    r = df.select(sc.parse_currency("a"), sc.parse_currency("b"), sc.parse_percentage("c"), sc.parse_days("d"),
                  sc.parse_revenue("e"), sc.parse_revenue("f"), sc.parse_revenue("g"),
                  sc.parse_days(F.lit("none"))).collect()[0]
    assert list(r) == [945.57, 1234.56, 88, 335, 47800.0, 1200000.0, 174900.0, None]


def test_first_wins_and_audit(spark):
    df = spark.createDataFrame([("listing_a.json", "1", 100.0), ("listing_b.json", "1", 999.0),
                                ("listing_b.json", "2", 5.0)], "file string, listing_id string, ADR double")
    kept = {r["listing_id"]: r["ADR"] for r in mk.first_wins(df, "listing_id", ["file"]).collect()}
    assert kept == {"1": 100.0, "2": 5.0}
    a = mk.market_merge_audit(df).collect()[0]
    assert (a["records"], a["merged"], a["duplicates_skipped"]) == (3, 2, 1)


def test_empty_metrics_and_occupancy(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0, 0, 0), ("b", 200.0, 1.0, 70, 300), ("c", None, None, None, None)],
                               "listing_id string, ADR double, Revenue double, Occupancy int, Days_Available int")
    assert sorted(r[0] for r in mk.empty_metrics_filter(df).collect()) == ["b"]
    occ = {r["listing_id"]: r for r in mk.occupancy_metrics(df).collect()}
    assert occ["b"]["Abs_Occ_Rate"] == 58 and occ["b"]["Avail_Rate"] == 82.19
    assert occ["c"]["Abs_Occ_Rate"] is None


def test_min_days_inclusive_and_absent(spark):
    df = spark.createDataFrame([("a", 50), ("b", 100), ("c", 300)], "listing_id string, Days_Avail int")
    assert sorted(r[0] for r in mk.min_days_filter(df, 100).collect()) == ["b", "c"]
    assert mk.min_days_filter(df.drop("Days_Avail"), 100).count() == 3


def test_market_flag_filter(spark):
    df = spark.createDataFrame([("a", True), ("b", False)], "listing_id string, has_airdna_data boolean")
    out = mk.has_market_data_filter(df)
    assert out.columns == ["listing_id"] and out.count() == 1


def test_extract_kpis_and_header(spark):
    text = "★ 4.7 (287)\nBedrooms: 4 Baths: 3.5 Guests: 15\n$47.8K\nAnnual Revenue\n$945.57\nAverage Daily Rate\n88%\nOccupancy\n335\nDays Available"
    df = spark.createDataFrame([("a", text), ("b", "nothing here")], "listing_id string, page_text string")
    k = {r["listing_id"]: r for r in mk.extract_header(mk.extract_kpis(df)).collect()}
    a = k["a"]
    assert (a["Revenue"], a["ADR"], a["Occupancy"], a["Days_Available"]) == (47800.0, 945.57, 88, 335)
    assert (a["Rating"], a["Review_Count"], a["Bedrooms"], a["Bathrooms"], a["Max_Guests"]) == (4.7, 287, 4, 3.5, 15)
    assert (k["b"]["ADR"], k["b"]["Occupancy"]) == (0.0, 0)


def _details(spark):
    from staylens.sources.files import DETAILS_SCHEMA
    icon = lambda t, i: {"title": t, "icon": i}
    rows = [
        {"listing_id": "1", "room_type": "Entire home/apt", "person_capacity": 4, "rating": {"accuracy": 4.9},
         "house_rules": {"aditional": "No parties", "general": [{"values": [icon("No pets", "SYSTEM_PETS")]}]},
         "title": "Cabin", "sub_description": {"items": ["guests", "2 bedrooms", "3 beds", "1 baths"]},
         "location_descriptions": [{"title": "Neighborhood highlights", "content": "Quiet"}],
         "description": '["A.", "B."]',
         "amenities": [{"values": [icon("Pets allowed", "SYSTEM_PETS"), icon("Hot tub", "SYSTEM_JACUZZI")]}],
         "highlights": [icon("Great view", "SYSTEM_VIEW_MOUNTAIN")]},
        {"listing_id": "2", "room_type": "Private room", "person_capacity": 2, "rating": {},
         "house_rules": {"aditional": None, "general": []}, "title": "Room",
         "sub_description": {"items": ["guests", "1 bedroom", "1 bed", "1 bath"]}, "location_descriptions": [],
         "description": '"Just a room"', "amenities": [], "highlights": []},
    ]
    return spark.createDataFrame(rows, DETAILS_SCHEMA)


def test_amenity_long_last_wins_and_matrix(spark):
    d = _details(spark)
    long = {(r["listing_id"], r["icon"]): r["title"] for r in mx.amenity_long(d).collect()}
    assert long[("1", "SYSTEM_PETS")] == "No pets"  # house rule overwrites amenity
    metrics = spark.createDataFrame([("1", 200.0, 70, 300), ("2", 90.0, 50, 50)],
                                    "listing_id string, ADR double, Occupancy int, Days_Available int")
    raw = mx.build_matrix(d, metrics, ["SYSTEM_PETS", "SYSTEM_JACUZZI", "SYSTEM_VIEW_MOUNTAIN"])
    rows = {r["listing_id"]: r for r in raw.collect()}
    assert rows["2"]["capacity"] is None and rows["2"]["ADR"] == 90.0  # non-entire row survives
    assert rows["1"]["bedrooms"] == "2" and rows["1"]["bathrooms"] == "1"
    clean = {r["listing_id"]: r for r in mx.clean_matrix(raw, min_days=100).collect()}
    assert set(clean) == {"1"} and clean["1"]["SYSTEM_JACUZZI"] == 1 and "link" not in raw.drop("link").columns


def test_legacy_sub_description_plural_only(spark):
    d = _details(spark)
    legacy = {r["listing_id"]: r for r in mx.parse_details(d, legacy=True).collect()}
    tolerant = {r["listing_id"]: r for r in mx.parse_details(d).collect()}
    assert legacy["2"]["bedrooms"] is None and tolerant["2"]["bedrooms"] == "1"
    assert legacy["1"]["bathrooms"] == "1" and legacy["2"]["bathrooms"] is None  # singular 'bath' unmatched
    assert tolerant["1"]["neighborhood_highlight"] == "Quiet" and tolerant["1"]["house_rules"] == "No parties"


def test_fill_missing_and_flags(spark):
    df = spark.createDataFrame([("a", "False", None, 3), ("b", "Pool", "x", None)],
                               "listing_id string, SYSTEM_POOL string, beds string, n int")
    f = {r["listing_id"]: r for r in mx.fill_missing(df, ["SYSTEM_POOL", "beds", "n"]).collect()}
    assert (f["a"]["SYSTEM_POOL"], f["a"]["beds"], f["b"]["n"]) == ("0", "0", 0)
    fl = {r["listing_id"]: r["SYSTEM_POOL"] for r in mx.amenity_flags(df).collect()}
    assert fl == {"a": 0, "b": 1}
