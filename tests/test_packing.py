import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staylens.operators import packing as pk
from staylens.operators import packing_dist as pd_
from staylens.plans.common import written


def check_packing(tokens, budget, chunk, item, trunc):
    """What makes a packing right: order kept, every item once, a chunk over
    the budget only where it is one item, no chunk could take the next item,
    and only an over-budget item that meets no open chunk is cut."""
    assert list(chunk) == sorted(chunk) and len(chunk) == len(tokens)
    groups = {}
    for i, c in enumerate(chunk):
        groups.setdefault(int(c), []).append(i)
    assert sorted(groups) == list(range(1, len(groups) + 1))
    for c, members in groups.items():
        assert [int(item[i]) for i in members] == list(range(1, len(members) + 1))
        size = sum(tokens[i] for i in members)
        assert size <= budget or len(members) == 1
        nxt = groups.get(c + 1)
        if nxt and not trunc[members[-1]]:
            assert size + tokens[nxt[0]] > budget
    for i, cut in enumerate(trunc):
        if cut:  # alone in its chunk, over the budget, and nothing open before it
            assert tokens[i] > budget and len(groups[int(chunk[i])]) == 1
            assert i == 0 or trunc[i - 1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 60)), min_size=1, max_size=60), st.integers(0, 80))
def test_packing_properties(pairs, budget):
    pairs = sorted(pairs, key=lambda p: p[0])  # stable: order inside a key kept
    keys = np.asarray([p[0] for p in pairs])
    tok = np.asarray([p[1] for p in pairs], dtype="int64")
    chunk, item, trunc = pd_.pack_many(keys, tok, np.full(len(tok), budget))
    for k in np.unique(keys):
        sel = keys == k
        check_packing(tok[sel], budget, chunk[sel], item[sel], trunc[sel])


def test_packing_by_hand():
    def packed(tokens, budget):
        tok = np.asarray(tokens, dtype="int64")
        chunk, item, trunc = pd_.pack_many(np.zeros(len(tok)), tok, np.full(len(tok), budget))
        return list(chunk), list(item), [bool(t) for t in trunc]
    assert packed([3, 4, 5, 2], 7) == ([1, 1, 2, 2], [1, 2, 1, 2], [False] * 4)
    assert packed([9, 1, 9], 7) == ([1, 2, 3], [1, 1, 1], [True, False, False])
    assert packed([7, 7], 7) == ([1, 2], [1, 1], [False, False])


def test_chunk_reviews_spark_keeps_every_review(spark):
    reviews = [f"Review number {i} with some extra text to add tokens" for i in range(10)]
    df = spark.createDataFrame([("l1", i, r) for i, r in enumerate(reviews)], "listing_id string, pos int, text string")
    out = pk.chunk_reviews(df, "listing_id", ["pos"], "text", prompt_tokens=len("Analyze these reviews") // 4,
                           limit=100).collect()
    assert len({r["chunk_no"] for r in out}) > 1
    assert sorted(r["text"] for r in out) == sorted(reviews)


def test_chunk_reviews_empty_and_truncation(spark):
    empty = spark.createDataFrame([], "listing_id string, pos int, text string")
    assert pk.chunk_reviews(empty, "listing_id", ["pos"], "text").count() == 0
    big = "x" * 5000
    df = spark.createDataFrame([("a", 0, big), ("a", 1, "ok"), ("a", 2, big)], "listing_id string, pos int, text string")
    out = {r["item_no"] + 10 * r["chunk_no"]: r for r in pk.chunk_reviews(df, "listing_id", ["pos"], "text",
                                                                           limit=100).collect()}
    rows = sorted(out.values(), key=lambda r: r["chunk_no"])
    assert rows[0]["truncated"] and rows[0]["text"].endswith("... [truncated]") and len(rows[0]["text"]) == 2015
    # the later oversized review follows a non-empty chunk: opens its own chunk, uncut
    assert rows[-1]["text"] == big and not rows[-1]["truncated"]
    assert [r["chunk_no"] for r in rows] == [1, 2, 3]


def test_chunk_prompt_numbering_and_info(spark):
    df = spark.createDataFrame([("a", i, "y" * 40) for i in range(6)], "listing_id string, pos int, text string")
    ch = pk.chunk_reviews(df, "listing_id", ["pos"], "text", prompt_tokens=0, limit=25)
    prompts = {r["chunk_no"]: r["prompt"] for r in pk.chunk_prompt(ch, "BASE", prompt_tokens=0, limit=25).collect()}
    assert len(prompts) == 3
    assert prompts[1].startswith("BASE\n\nProcessing chunk 1 of 3 (2 reviews)\n\nReviews to analyze:\nReview 1: ")
    assert prompts[1].endswith("Please provide the analysis following the exact format specified above.")


def test_merge_prompt_single_passes_through(spark):
    parts = spark.createDataFrame([("a", 1, "only"), ("b", 1, "p1"), ("b", 2, "p2"), ("b", 3, None)],
                                  "listing_id string, chunk_no int, summary string")
    out = {r["listing_id"]: r for r in pk.merge_prompt(parts, "BASE").collect()}
    assert out["a"]["prompt"] == "only"
    assert out["b"]["n_parts"] == 2 and "--- Analysis 2 ---\np2\n" in out["b"]["prompt"]


COLS = ["listing_id", "chunk_no", "item_no", "text", "tokens", "truncated"]


def packed_alone(rows, budget_of):
    """What one pass over each listing gives: rows of (key, pos, text)."""
    out = []
    for k in sorted({r[0] for r in rows}, key=str):
        mine = sorted([r for r in rows if r[0] == k], key=lambda r: r[1])
        tok = np.asarray([len(r[2]) // 4 if r[2] else 0 for r in mine], dtype="int64")
        chunk, item, cut = pd_.pack_many(np.zeros(len(tok)), tok, np.full(len(tok), budget_of(k)))
        for r, t, c, i, x in zip(mine, tok, chunk, item, cut):
            out.append((k, int(c), int(i), r[2][:2000] + "... [truncated]" if x and r[2] is not None else r[2], int(t), bool(x)))
    return sorted(out, key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.integers(-3, 25), st.data())
def test_exit_tables_compose(tokens, budget, data):
    """Partitions of one listing: entering table after table, and entering any
    composition of them, gives the state of one pass over all rows."""
    tok = np.asarray(tokens, dtype="int64")
    cuts = sorted(set(data.draw(st.lists(st.integers(1, len(tokens)), max_size=6))) | {len(tokens)})
    tables = [pd_.exit_table("k", tok[a:b], budget) for a, b in zip([0, *cuts], cuts) if b > a]
    state = pd_.FRESH
    for t in tables:
        state = pd_.enter(t, state)
    chunk, item, _ = pd_.pack_many(np.zeros(len(tok)), tok, np.full(len(tok), budget))
    last = [t for t, c in zip(tokens, chunk) if c == chunk[-1]]
    assert state == ("k", sum(last), int(chunk[-1]), int(item[-1]), bool((tok <= budget).any()))
    while len(tables) > 1:
        i = data.draw(st.integers(0, len(tables) - 2))
        tables[i:i + 2] = [pd_.compose(tables[i], tables[i + 1])]
    assert pd_.enter(tables[0], pd_.FRESH) == state
    other = ("before", 5, 3, 2, True)
    assert pd_.enter(tables[0], other) == state                      # another listing before
    inside = ("k", data.draw(st.integers(0, 30)), 4, 2, True)        # an open chunk before
    one = pd_.exit_table("k", tok, budget)
    assert pd_.enter(tables[0], inside) == pd_.enter(one, inside)
    table = {"reset": True, "state": other}
    assert pd_.compose(table, one) == {"reset": True, "state": state} and pd_.compose(one, table) is table


def test_exit_table_is_bounded_by_the_budget():
    tok = np.ones(100_000, dtype="int64")
    assert len(pd_.exit_table("k", tok, 50)["bounds"]) == 51
    a = pd_.exit_table("k", tok[:40], 50)
    assert len(pd_.compose(a, pd_.exit_table("k", tok, 50))["bounds"]) <= 92


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 120)), min_size=1, max_size=60),
       st.integers(0, 60), st.integers(1, 9))
def test_partitions_equal_one_pass(spark, pairs, limit, partitions):
    rows = [(k, i, "z" * n if n % 7 else None) for i, (k, n) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "listing_id string, pos int, text string")
    out = pk.chunk_reviews(df, "listing_id", ["pos"], "text", prompt_tokens=3, limit=limit, partitions=partitions)
    got = sorted((tuple(r[c] for c in COLS) for r in out.collect()), key=str)
    assert got == packed_alone(rows, lambda k: limit - 3)


def test_hot_listing_over_many_partitions(spark, monkeypatch):
    """A third of all rows on one listing, more partitions than one task composes."""
    monkeypatch.setattr(pd_, "FAN", 3)
    rows = [("hot" if i % 3 == 0 else f"l{i % 50}", i, "w" * ((i * 37) % 90)) for i in range(3000)]
    df = spark.createDataFrame(rows, "listing_id string, pos int, text string")
    out = pk.chunk_reviews(df, "listing_id", ["pos"], "text", prompt_tokens=5, limit=60, partitions=23)
    assert sorted((tuple(r[c] for c in COLS) for r in out.collect()), key=str) == packed_alone(rows, lambda k: 55)


def test_no_text_in_python(spark):
    """The plan sends numbers through Python only."""
    df = spark.createDataFrame([("a", 1, "text")], "listing_id string, pos int, text string")
    out = pk.chunk_reviews(df, "listing_id", ["pos"], "text")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "InArrow" not in plan and "InPandas" not in plan     # the numbers are written before the texts join


def test_global_positions_hot_key_spans_partitions(spark):
    from staylens.operators.packing_dist import global_positions
    import random
    rnd = random.Random(3)
    rows = [("hot", i, rnd.randint(0, 9)) for i in range(500)] + [(f"k{i % 7}", i, rnd.randint(0, 9)) for i in range(60)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o int, w long")
    out = global_positions(df, "k", ["o"], weight="w", partitions=16).collect()
    by = {}
    for r in out:
        by.setdefault(r["k"], []).append((r["o"], r["gidx"], r["pe"], r["w"]))
    for k, xs in by.items():
        xs.sort()
        assert [x[1] for x in xs] == list(range(len(xs)))
        acc = 0
        for _o, _g, pe, w in xs:
            assert pe == acc
            acc += w


def test_merge_prompt_bounded_groups(spark):
    parts = spark.createDataFrame([("a", i, f"p{i}") for i in range(1, 8)], "listing_id string, chunk_no int, summary string")
    out = sorted(pk.merge_prompt(parts, "BASE", max_parts=3).collect(), key=lambda r: r["merge_group"])
    assert [(r["merge_group"], r["n_parts"], r["final"]) for r in out] == [(0, 3, False), (1, 3, False), (2, 1, False)]
    assert out[2]["prompt"] == "p7" and "--- Analysis 3 ---\np3\n" in out[0]["prompt"]
    one = pk.merge_prompt(parts, "BASE").collect()
    assert len(one) == 1 and one[0]["final"] and one[0]["n_parts"] == 7


def test_per_listing_prompt_column(spark):
    pt = {"a": 2, "b": 30, "c": 90}
    rows = [(k, i, "w" * (7 * ((i * 13 + len(k)) % 11)), pt[k]) for k in "abc" for i in range(25)]
    df = spark.createDataFrame(rows, "listing_id string, pos int, text string, pt long")
    out = pk.chunk_reviews(df, "listing_id", ["pos"], "text", prompt_tokens="pt", limit=60, partitions=7)
    got = sorted((tuple(r[c] for c in COLS) for r in out.collect()), key=str)
    assert got == packed_alone([r[:3] for r in rows], lambda k: 60 - pt[k])
    assert any(r[5] for r in got)  # listing "c" (prompt over the limit) truncates everything


def test_global_positions_descending_expression(spark):
    from pyspark.sql import functions as F
    from staylens.operators.packing_dist import global_positions
    rows = [("all", float((i * 37) % 101), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v double, id int")
    out = global_positions(df, "k", [F.col("v").desc(), F.col("id")], partitions=7).collect()
    got = [r["id"] for r in sorted(out, key=lambda r: r["gidx"])]
    exp = [r[2] for r in sorted(rows, key=lambda r: (-r[1], r[2]))]
    assert got == exp and sorted(r["gidx"] for r in out) == list(range(300))


def test_items_meet_their_numbers_once(spark):
    df = spark.createDataFrame([(k, i, "x" * (4 * (i % 5 + 1))) for k in ("a", "b") for i in range(30)], "listing_id string, pos int, text string")
    ch = pk.chunk_reviews(df, limit=9, partitions=4)
    out = pk.chunk_prompt(ch, "base", limit=9)
    assert out.agg(F.sum("n_items")).first()[0] == 60
    # the prompts and the listings' totals read the written chunks, not the join of items and numbers again
    assert "_id#" not in out._jdf.queryExecution().toString().replace("listing_id", "")
    staged = written(df.select("listing_id", "pos", (F.length("text") / 4).cast("long").alias("tokens"), F.lit(9).cast("long").alias("budget"),
                               F.monotonically_increasing_id().alias("_id")), "t-items")
    numbers = pd_.chunk_numbers(staged, "listing_id", ["pos"], 4)
    # the exit tables come with the written numbers: those are dealt by partition once
    assert "FlatMapGroupsInArrow" not in numbers._jdf.queryExecution().toString()
    assert {(r.chunk_no, r.item_no) for r in numbers.collect()} == {(r.chunk_no, r.item_no) for r in ch.collect()}
