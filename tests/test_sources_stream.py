import json
import os
import random

import pytest
from conftest import SF_SMALL, has_data

from staylens.sources import files as fl
from staylens.sources import sinks as sk


def _write(path, name, obj):
    with open(os.path.join(path, name), "w") as f:
        json.dump(obj, f, indent=4)  # pretty-printed, like the reference's files


def test_missing_paths_give_empty_frames(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "nothing")
    assert fl.read_reviews(spark, p).count() == 0
    assert fl.read_market_metrics(spark, p).count() == 0
    assert fl.read_descriptions(spark, p).count() == 0
    assert fl.read_listing_details(spark, p).count() == 0


def test_search_results_and_metrics(spark, tmpdir_path):
    _write(tmpdir_path, "search_results_97067.json", [{"room_id": "abc"}, {"room_id": "def"}, {"room_id": "", "id": "ghi"},
                                                      {"room_id": ""}])
    ids = sorted(r["listing_id"] for r in fl.read_search_results(spark, tmpdir_path).collect())
    assert ids == ["abc", "def", "ghi"]
    d = os.path.join(tmpdir_path, "m")
    os.makedirs(d)
    _write(d, "listing_a.json", {"1": {"ADR": 100.0, "Occupancy": 70}})
    _write(d, "listing_b.json", {"1": {"ADR": 999.0}, "2": {"ADR": 5.0, "Days_Available": 10}})
    from staylens.operators.market import first_wins
    m = {r["listing_id"]: r["ADR"] for r in first_wins(fl.read_market_metrics(spark, d), "listing_id", ["file"]).collect()}
    assert m == {"1": 100.0, "2": 5.0}


def test_reviews_last_file_wins_and_descriptions(spark, tmpdir_path):
    _write(tmpdir_path, "reviews_a.json", {"1": [{"review": "old", "rating": 1}]})
    _write(tmpdir_path, "reviews_b.json", {"1": [{"comments": "new", "rating": 5}, {"review": "x", "rating": None}],
                                           "2": []})
    r = sorted((x["listing_id"], x["pos"], x["review"], x["rating"]) for x in fl.read_reviews(spark, tmpdir_path).collect())
    assert r == [("1", 0, "new", 5.0), ("1", 1, "x", None)]
    d = os.path.join(tmpdir_path, "d")
    os.makedirs(d)
    _write(d, "descriptions.json", {"1": ["Part one.", "Part two."], "2": "Plain", "3": 12345})
    out = {x["listing_id"]: x["description"] for x in fl.read_descriptions(spark, d).collect()}
    assert out == {"1": "Part one. Part two.", "2": "Plain"}


def test_details_id_from_file_name_and_summaries(spark, tmpdir_path):
    _write(tmpdir_path, "property_details_123.json", {"room_type": "Entire home/apt", "title": "T",
                                                      "description": ["a", "b"]})
    d = fl.read_listing_details(spark, tmpdir_path).collect()[0]
    assert d["listing_id"] == "123" and d["room_type"] == "Entire home/apt"
    s = os.path.join(tmpdir_path, "s")
    os.makedirs(s)
    _write(s, "listing_summary_97067_1.json", {"1": "Great"})
    _write(s, "listing_summary_97067_2.json", {"2": None})
    out = sorted((r["area"], r["listing_id"], r["summary"]) for r in fl.read_summaries(spark, s, area="97067").collect())
    assert out == [("97067", "1", "Great"), ("97067", "2", None)]


def test_sinks_roundtrip(spark, tmpdir_path):
    raw = spark.createDataFrame([("a", 1.0, 200), ("b", None, 50)], "listing_id string, ADR double, Days_Avail int")
    sk.write_matrix(raw, raw, os.path.join(tmpdir_path, "mx"))
    back = fl.read_matrix(spark, os.path.join(tmpdir_path, "mx", "raw"))
    assert [r["listing_id"] for r in back.collect()] == ["a", "b"]
    sk.write_request_log(spark.createDataFrame([(1, "2024-01-01")], "s int, session_start string"),
                         os.path.join(tmpdir_path, "log"))
    assert sk.read_request_log(spark, os.path.join(tmpdir_path, "log")).count() == 1


def test_matrices_from_one_run_and_few_files_per_area(spark, tmpdir_path):
    from staylens.operators.matrix import clean_matrix
    raw = spark.createDataFrame([("a", 1.0, 200, "True", "x", None), ("b", None, 50, None, "y", "2"), ("c", 3.0, 100, "False", "z", "1.5")],
                                "listing_id string, ADR double, Days_Avail int, SYSTEM_POOL string, title string, beds string")
    path = os.path.join(tmpdir_path, "both")
    sk.write_matrices(raw, path)
    assert [r["listing_id"] for r in fl.read_matrix(spark, f"{path}/raw").collect()] == ["c", "a", "b"]
    got, want = (sorted(map(tuple, d.collect())) for d in (fl.read_matrix(spark, f"{path}/clean"), clean_matrix(raw)))
    assert got == want and len(got) == 2
    rows = spark.range(600).selectExpr("id", "IF(id % 3 = 0, 'hot', concat('a', id % 4)) AS area").repartition(12)
    out = os.path.join(tmpdir_path, "areas")
    sk.write_by_area(rows, out)
    files = [f for _, _, names in os.walk(out) for f in names if f.endswith(".parquet")]
    assert spark.read.parquet(out).count() == 600 and len(files) <= 10     # not 12 tasks x 5 areas


def test_request_log_ties_are_settled_by_name(spark, tmpdir_path):
    import pytest
    from staylens.operators.costs import last_n_sessions
    rows = [(i, "2024-01-01", i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "session int, session_start string, cost int").repartition(5)
    got = last_n_sessions(df, "session_start", 4, tie="session").collect()
    assert [(r["session"], r["recency"]) for r in got] == [(29, 1), (28, 2), (27, 3), (26, 4)]
    assert [r["session"] for r in last_n_sessions(df, "session_start", 4).collect()] == [29, 26, 23, 20]  # cost, then session
    with pytest.raises(ValueError):
        last_n_sessions(df, "session_start", 4, tie="session_id")


def test_side_tables_and_summaries_read_back_in_full(spark, tmpdir_path):
    _write(tmpdir_path, "property_details_1.json", {
        "description": ["a", "b"], "house_rules": {"aditional": "no smoking"},
        "location_descriptions": [{"title": "Neighborhood highlights", "content": "quiet"}]})
    _write(tmpdir_path, "property_details_2.json", {"description": "plain", "location_descriptions": [
        {"title": "Getting around", "content": "bus"}]})
    out = os.path.join(tmpdir_path, "side")
    sk.write_side_tables(fl.read_listing_details(spark, tmpdir_path), out)
    assert sorted((r["table"], r["listing_id"], r["text"]) for r in sk.read_side_tables(spark, out).collect()) == [
        ("descriptions", "1", "a b"), ("descriptions", "2", "plain"), ("house_rules", "1", "no smoking"),
        ("neighborhood_highlights", "1", "quiet")]
    s = spark.createDataFrame([("97067", "1", "Great"), ("97067", "2", None), ("97068", "3", "")],
                              "area string, listing_id string, summary string")
    path = os.path.join(tmpdir_path, "summaries")
    sk.write_summaries(s, path)
    back = fl.read_summaries(spark, path, glob="*", wholetext=False)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, s.collect()), key=str)


def test_stream_equals_batch(spark):
    from staylens.operators.reviews import listing_mean_rating
    from staylens.streaming.incremental import stream_review_ratings
    data = [(f"l{i % 7}", float(i % 5) if i % 9 else None, "one file", 0) for i in range(200)]
    df = spark.createDataFrame(data, "listing_id string, rating double, file string, arrival int")
    s = sorted(tuple(r) for r in stream_review_ratings(spark, df, arrivals=1)[1].collect())
    b = sorted(tuple(r) for r in listing_mean_rating(df).select("listing_id", "mean_rating", "n_reviews").collect())
    assert s == b


def test_review_stream_retracts_overwritten_files(spark):
    """Files of a listing arrive in any order over four micro-batches, some in
    two parts; a third of all rows is one listing's."""
    from staylens.streaming.incremental import running_overall_mean, stream_review_ratings
    rng = random.Random(4)
    order = [1, 0, 1, 3, 0, 2]      # arrival of each file; the second part of the last one comes later
    step = {(f, part): order[f] + (f == 5 and part) for f in range(6) for part in range(2)}
    rows = [(f"l{rng.randrange(7)}" if i % 3 else "hot", float(i % 5) if i % 9 else None, f"f{f}", step[f, part])
            for i, f, part in ((i, min(rng.randrange(9), 5), rng.randrange(2)) for i in range(400))]
    df = spark.createDataFrame(rows, "listing_id string, rating double, file string, arrival int")
    updates, last = stream_review_ratings(spark, df, arrivals=4)
    want = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        final = [r[1] or 0.0 for r in mine if r[2] == max(m[2] for m in mine)]
        want[key] = (round(sum(final) / len(final) + 1e-12, 4), len(final))
    assert {r["listing_id"]: (r["mean_rating"], r["n_reviews"]) for r in last.collect()} == want
    got = updates.collect()
    assert len({r["batch_id"] for r in got}) >= 3
    assert any(r["old_n"] > 0 and r["n_reviews"] < r["old_n"] for r in got)     # a smaller file took a larger one's place
    for r in got:   # what an update retracts is what the listing's update before it gave
        before = [x for x in got if x["listing_id"] == r["listing_id"] and x["batch_id"] < r["batch_id"]]
        b = max(before, key=lambda x: x["batch_id"], default=None)
        assert (r["old_sum"], r["old_n"]) == ((b["rating_sum"], b["n_reviews"]) if b else (0.0, 0))
    mean = running_overall_mean(updates).collect()[0]["overall_mean"]
    assert abs(mean - sum(m for m, _ in want.values()) / len(want)) < 1e-4


def test_cost_stream_closes_windows_and_drops_late_rows(spark):
    from datetime import datetime, timedelta
    from staylens.streaming.incremental import stream_request_cost
    t0 = datetime(2024, 1, 1)
    # (minutes, arrival): arrival 1 opens 03:00, so 00:00 and 01:00 are closed before arrival 2
    events = [(5, 0), (50, 0), (70, 0), (190, 1), (200, 1), (20, 2), (100, 2), (170, 2), (400, 2), (410, 3), (130, 3)]
    rows = [("s", i, t0 + timedelta(minutes=m), i % 2 == 0, 10, 1, 0.5, a) for i, (m, a) in enumerate(events)]
    df = spark.createDataFrame(rows, "session string, listing_id long, ts timestamp, cached boolean, input_tokens long, "
                                     "output_tokens long, cost double, arrival int")
    out = stream_request_cost(spark, df, "30 minutes", "1 hour", "arrival", 4, "append").collect()
    got = {r["window_start"].hour: r["total_requests"] for r in out}
    assert got == {0: 2, 1: 1, 2: 1, 3: 2} and len(out) == 4   # 20, 100 and 130 came late; 06:00 is still open


def test_stream_one_file_per_batch_equals_batch(spark):
    from staylens.operators.reviews import listing_mean_rating
    from staylens.session import scratch_path
    from staylens.streaming import incremental as inc
    data = [(f"l{i % 5}", float(i % 4)) for i in range(120)]
    df = spark.createDataFrame(data, "listing_id string, rating double")
    src = scratch_path(spark, "t-src")
    df.repartition(4).write.parquet(src)
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    inc.run_available(inc.review_ratings_stream(spark, src, "listing_id string, rating double", max_files=1),
                      out, ck)
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 4  # one micro-batch per file
    res = inc._latest(spark, out, ["listing_id"])
    got = sorted((r["listing_id"], r["n_reviews"]) for r in res.collect())
    exp = sorted((r["listing_id"], r["n_reviews"]) for r in listing_mean_rating(df).collect())
    assert got == exp


def test_review_documents_are_dealt_by_size(spark, tmpdir_path, monkeypatch):
    import json
    for name, docs in (("a", {"1": [{"review": "old", "rating": 1.0}], "2": [{"comments": "two"}]}),
                       ("b", {"1": [{"review": "new", "rating": 2.0}, {"review": None}], "3": []})):
        with open(f"{tmpdir_path}/reviews_{name}.json", "w") as f:
            f.write(json.dumps(docs))

    def rows(df):
        return sorted((r["listing_id"], r["pos"], str(r["review"]), r["rating"]) for r in df.collect())

    plain = rows(fl.read_reviews(spark, tmpdir_path))
    monkeypatch.setattr(fl, "TASK_BYTES", 10)
    parts = fl._bytes(tmpdir_path) // 10 + 1
    many = fl.read_reviews(spark, tmpdir_path)
    assert rows(many) == plain and [r[:3] for r in plain] == [("1", 0, "new"), ("1", 1, "None"), ("2", 0, "two")]
    assert "hashpartitioning(listing_id#" in (plan := many._jdf.queryExecution().toString()) and f", {parts})" in plan


@pytest.mark.skipif(not has_data(), reason="no test data")
def test_review_documents_of_many_lines(spark, monkeypatch):
    from staylens.sources import bindings as b
    want = sorted(b.b_review_documents(spark, SF_SMALL).collect())
    monkeypatch.setattr(b, "DOCUMENT_LINES", 100)
    got = b.b_review_documents(spark, SF_SMALL)
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count() // 100 + 1
    assert sorted(got.collect()) == want and "rangepartitioning(file" in (plan := got._jdf.queryExecution().toString()) and f", {n})" in plan
