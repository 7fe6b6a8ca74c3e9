"""Training-data operators against brute force on small tables that hold nulls,
empty and long texts, repeated rows, ties and clashing column names."""

import base64
import hashlib
import json
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.llm import attention_lm, bitpack, cotraining, decontamination, jaccard, jvm, lines, mixing, sharding, style_tree, warc
from staylens.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}" for i in range(120))
NEAR = BASE.replace("w60 ", "changed ")
TEXTS = [None, "", "  \n ", "One", "one two", BASE, BASE, NEAR, BASE.upper(), BASE + " tail end here",
         "x y z " * 30, "a b c d e f g h i j\n" * 5, "long " * 3000 + "end", "the cat sat on the mat " + " ".join(f"v{i}" for i in range(40))]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"src{i % 3}", None, 1) for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "text without an id", "en", "src0", 3, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_warc_round_trip(spark):
    html = [None, "", "<p>a\r\n\r\nb</p>", "same", "same", "same", "é" * 5000]
    rows = [(i, None if i == 2 else f"http://h{i % 2}.example/p?{i}", h) for i, h in enumerate(html)] + [(None, "http://x/", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = scratch_path(spark, "t-warc")
    warc.write_archives(pages, path)
    got = warc.merge_index(warc.read_archives(spark, path)).collect()
    assert len(got) == len(rows)
    first = {"": 0, "same": 3}
    for r in got:
        raw = ((html[r.page_id] if r.page_id is not None else "same") or "").encode()
        assert r.payload_bytes == len(raw)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        f = first.get(raw.decode(), r.page_id)
        assert (r.record_type, r.refers_to) == (("response", None) if f == r.page_id else ("revisit", f))
    order = sorted(got, key=lambda r: (r.block, r.slot))
    keys = [(r.urlkey.encode(), r.timestamp) for r in order]
    assert keys == sorted(keys)
    none = scratch_path(spark, "t-warc")
    warc.write_archives(pages.where("false"), none)
    assert warc.merge_index(warc.read_archives(spark, none)).count() == 0


def test_loser_tree():
    rng = np.random.default_rng(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.integers(0, 20, rng.integers(0, 30)).tolist()) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(sum(runs, []))


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        assert r.size == 0 or r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    for s, rows in by.items():
        assert rows[0].source_size == sum(r.size for r in rows)
        assert sum(r.taken for r in rows) == round(rows[0].target)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    assert mixing.mix(empty).count() == 0
    assert mixing.targets({"a": 10, "b": 100, "c": 10}, {"a": 3, "b": 1, "c": 1}) == {"a": 30.0, "b": 60.0, "c": 30.0}
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    c, cover = Counter(wins), set()
    for i, x in enumerate(wins):
        if c[x] > 1:
            cover.update(range(i, i + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_line_rules(spark, docs, empty):
    for r in lines.line_rules(docs).collect():
        want = base_counts(TEXTS[r.doc_id] if r.doc_id is not None else "text without an id")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    assert lines.line_rules(empty).count() == 0
    name = lambda i: chr(97 + i // 10) + chr(107 + i % 10)  # noqa: E731 -- digits are normalised
    own = " ".join("u" + name(i) for i in range(30))
    shared = " ".join("s" + name(i) for i in range(90))
    rows = [(i, f"{shared}\n{own} d{name(i)}" if i < 30 else f"{own} e{name(i)}", "h") for i in range(60)]
    rows += [(100 + i, rows[40][1], "h") for i in range(30)]  # exact copies are one text
    got = {r.doc_id: r.kept for r in lines.line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i] == (i >= 30) for i in got)


def test_remove_lines(spark):
    """Frequent lines leave the texts that hold them, brute force per host."""
    name = lambda i: chr(97 + i // 10) + chr(107 + i % 10)  # noqa: E731 -- digits are normalised
    rows = []
    for h in ("a", None):
        rows += [(len(rows) + i, f"Same  Line 7\n\nown {name(i)}\nsame line 12\n tail", h, "x") for i in range(25)]
        rows += [(len(rows) + i, f"same line 3\nother {name(i)}", "b" if h else "c", "x") for i in range(4)]
    rows += [(900, None, "a", "x"), (901, "", "a", "x"), rows[3], rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, line string")
    hot = lines.frequent_lines(lines.document_lines(df, F.col("source")))
    got = sorted(((r.doc_id, r.text, r.source, r.line) for r in lines.remove_lines(df, hot).collect()), key=str)
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", x.lower())).strip(" ")
    held = {}
    for _, t, h, _ in set(rows):
        for x in {norm(x) for x in (t or "").split("\n") if x.strip()}:
            held.setdefault((h, x), set()).add(t)
    often = {k for k, v in held.items() if len(v) > lines.MIN_DOCS}
    assert {x for _, x in often} == {"same line 0", "tail"}
    want = [(d, "\n".join(x for x in t.split("\n") if (h, norm(x)) not in often) if t else t, h, o) for d, t, h, o in rows]
    assert got == sorted(want, key=str)
    assert lines.remove_lines(df.where("false"), hot).count() == 0


def test_line_limit_does_not_grow_with_the_host(spark):
    name = lambda i: "".join(chr(97 + int(c)) for c in f"{i:05d}")  # noqa: E731 -- digits are normalised
    own = lambda i: " ".join(f"o{name(i)}{name(j)}" for j in range(24))
    line, passage = (" ".join(f"{p}{name(j)}" for j in range(n)) for p, n in (("l", 50), ("p", 60)))
    planted = [(i, f"{line}\n{own(i)[:60]}", "h") for i in range(25)]
    planted += [(100 + i, f"{passage}\n{own(100 + i)[:60]}", "h") for i in range(6)]
    planted += [(200 + i, f"{passage} q\n{own(200 + i)[:60]}", "h") for i in range(5)]
    rest = [(1000 + i, own(1000 + i), "h") for i in range(6000)]  # 0.5 % of them are 30
    for rows in (planted, planted + rest):
        got = {r.doc_id: r.kept for r in lines.line_rules(
            spark.createDataFrame(rows, "doc_id long, text string, source string")).select("doc_id", "kept").collect()}
        assert not any(got[i] for i in [*range(25), *range(100, 106)])
        assert all(kept for i, kept in got.items() if i >= 200)


def test_sharding(docs, empty):
    got = sharding.shard_documents(docs, 5).collect()
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    for r in got:
        raw = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert sharding.shard_documents(empty).count() == 0


def test_sharding_keeps_columns_with_clashing_names(docs):
    clash = docs.withColumns({"rank": F.lit(7), "shard": F.lit("x"), "p": F.lit(1)})
    out = sharding.shard_documents(clash)
    assert out.where("rank = 7 AND p = 1").count() == docs.count() and dict(out.dtypes)["shard"] == "int"


def test_hilbert_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    index = sharding.hilbert_index(grid, 3)
    assert sorted(index) == list(range(512))
    assert set(np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(1)) == {1}


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                x, y = sets[a], sets[b]
                if x and y and 100 * len(x & y) >= 90 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_one_per_class_with_columns_that_do_not_compare(spark):
    rows = [(1, BASE, {"a": 1}), (1, BASE, {"a": 1}), (2, BASE, {"a": 2}), (3, "other words", None), (1, BASE, {"a": 3})]
    df = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>")
    got = sorted((r.doc_id, (r.m or {}).get("a")) for r in jaccard.one_per_class(df).collect())
    assert got == [(1, 1), (1, 3), (3, None)]


def test_jaccard(spark, docs, empty):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    w = BASE.split()
    for j in range(25):  # chains: each copy changes one more word
        w = list(w)
        w[3 * j] = f"c{j}"
        rows.append((100 + j, " ".join(w)))
    want = brute_components(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()}
    assert got == want
    with_null = jaccard.jaccard_components(docs.select("doc_id", "text")).collect()
    assert len(with_null) == docs.count() and [r.component_id for r in with_null if r.doc_id is None] == [None]
    assert jaccard.jaccard_components(empty.select("doc_id", "text")).count() == 0


def test_divide_skip():
    rng = np.random.default_rng(2)
    for _ in range(50):
        lists = [np.unique(rng.integers(0, 40, rng.integers(1, 30))) for _ in range(12)]
        count = Counter(int(x) for a in lists for x in a)
        for least in (1, 4, 9):
            for long_lists in (0, least - 1):
                assert jaccard.divide_skip(lists, least, long_lists) == {x: c for x, c in count.items() if c >= least}


def test_prefix_overlap_is_a_lower_bound():
    rng = np.random.default_rng(3)
    for _ in range(300):
        x = set(rng.choice(400, 60, replace=False).tolist())
        y = set(x)
        for t in rng.choice(sorted(x), rng.integers(0, 5), replace=False):
            y.discard(int(t))
        y |= set((500 + rng.choice(50, rng.integers(0, 3), replace=False)).tolist())
        if 100 * len(x & y) >= 90 * len(x | y):
            p, q = (set(sorted(s)[:jaccard.prefix_size(len(s))]) for s in (x, y))
            assert len(p & q) >= jaccard.prefix_overlap(len(x), len(y)) >= 1


def test_style_tree(spark):
    body = lambda i: " ".join(f"b{i}x{j}" for j in range(12))
    rows = [(i, f"http://a.example/{i}", f"<html><head><title>t</title></head><body><nav>menu</nav><div class='box'>Same text &amp; more"
             f"</div><div class='story'><h1>H{i}</h1><p>{body(i)}<p>two  <b>b</b>\n{i}</div><div id=comments>no</div></body>") for i in range(12)]
    rows += [(50, None, None), (51, "x", ""), (52, "http://b/", "<article><header><h1>T</h1></header><p>a &lt; b</p></article><footer>f</footer>")]
    got = {r.page_id: r.text for r in style_tree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[50] == got[51] == "" and got[52] == "T a < b"
    for i in range(12):  # the box is the same on every page of the host
        assert got[i] == f"H{i} {body(i)} two b {i}"


def test_style_tree_near_copies(spark):
    page = lambda i, body, ad="": (i, f"http://n.example/{i}", f"<body><!-- ad {i} --><script>track({i})</script>"  # noqa: E731
                                   f"<article><h1>T</h1><p>{body}</p>{ad}</article></body>")
    text = lambda i: " ".join(f"c{i}x{j}" for j in range(30))
    rows = [page(i, text(0)) for i in range(300)] + [page(300 + i, text(1 + i)) for i in range(20)]
    rows += [page(1000 + i, text(99), f"<p>offer {i}</p>") for i in range(300)]  # copies that differ in what is seen
    got = {r.page_id: r.text for r in style_tree.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == text(0 if i < 300 else i - 299) for i in range(320))  # the heading is the same on all pages
    assert all(text(99) in got[1000 + i] for i in range(300))


def test_style_tree_names_are_a_prior(spark):
    text = lambda i: " ".join(f"d{i}x{j}" for j in range(40))
    nav = lambda i: f"<nav>menu {i}</nav><div class='ad'>buy {i}</div>"
    rows = [(i, f"http://w.example/{i}", f"<body>{nav(i)}<div class='has-sidebar'><article class='category-legal'><p>{text(i)}</p></article>"
                                         f"<div class='sidebar'>side {i}</div></div><footer>f {i}</footer></body>") for i in range(12)]
    rows += [(20 + i, f"http://cards.example/{i}", f"<body>{nav(i)}<div class='story'><p>{text(20 + i)}</p></div>"
                                                   f"<article>card {i}</article></body>") for i in range(12)]
    rows += [(40, "http://one.example/", f"<body>{nav(1)}<form id='page'><article>{text(40)}</article></form></body>")]
    got = {r.page_id: r.text for r in style_tree.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == text(i) for i in [*range(12), 40])
    assert all(text(20 + i) in got[20 + i] and "menu" not in got[20 + i] for i in range(12))


def test_style_tree_furniture_longer_than_the_article(spark):
    """Comments, adverts and menus with more text than the article, on hosts of
    twelve pages and of one; the same page gives the same text on both."""
    words = lambda k, i, n: " ".join(f"{k}{i}x{j}" for j in range(n))

    def pages(kind, i):
        art = f"<h1>T{i}</h1><p>{words('a', i, 30)}</p>"
        long = "".join(f"<p>{words(kind, f'{i}y{k}', 40)}</p>" for k in range(2))
        return {"comments": f"<body><article>{art}</article><section class='comments'>{long}</section></body>",
                "commented": f"<body><main><article>{art}</article></main><div id='comments'><article class='comment'>{long}</article></div></body>",
                "plain": f"<body><div class='page has-sidebar'><div class='text'>{art}</div></div><div class='comment-list'>{long}</div></body>",
                "advert": f"<body><div class='advert'>{long}</div><article>{art}</article></body>",
                "nav": f"<body><nav>{words('n', i, 80)}</nav><article>{art}</article></body>",
                "inside": f"<body><article>{art}<div class='comments'>{long}</div></article></body>"}[kind]

    rows, want = [], {}
    for k, kind in enumerate(("comments", "commented", "plain", "advert", "nav", "inside")):
        for i in range(13):
            page = 100 * k + i
            rows.append((page, f"http://{kind}{'-one' if i == 12 else ''}.example/{i}", pages(kind, i)))
            want[page] = f"T{i} {words('a', i, 30)}"
    rows += [(900, "http://again.example/", pages("comments", 3)), (901, "http://comments.example/3", pages("comments", 3))]
    want[900] = want[901] = want[3]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in style_tree.main_text(df).collect()}
    assert {p: got[p] for p in want if got[p] != want[p]} == {}
    assert style_tree.main_text(df.where("false")).count() == 0


def test_decontamination(spark, docs, empty):
    item = " ".join(f"Item{i}," for i in range(30))
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (4, item)], "item_id long, text string")
    near = item.replace("Item29,", "other")
    far = " ".join(f"Item{i}," for i in range(12))
    rows = [(0, f"before {item.lower()} after"), (1, near), (2, far), (3, None), (4, "x " * 500 + item), (5, item), (5, item)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()}
    assert got == {(d, i) for d in (0, 1, 4, 5) for i in (1, 4)}
    assert sorted(r.doc_id for r in decontamination.decontaminate(df, bench).collect()) == [2, 3]
    assert decontamination.contaminated(empty.select("doc_id", "text"), bench).count() == 0
    assert decontamination.contaminated(df, bench.where("false")).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    spec = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    return spec, Tokenizer.from_str(spec)


def test_bitpack(spark, docs, empty, tokenizer):
    spec, tok = tokenizer
    path = scratch_path(spark, "t-pack")
    bitpack.write_packed(docs, path, spec, 49408, block_ids=64)
    got = sorted(bitpack.with_starts(bitpack.read_packed(spark, path)).collect(), key=lambda r: r.start)
    ids = lambda t: tok.encode(t or "", add_special_tokens=False).ids + [1]
    at = 0
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: -1 if d is None else d)
    for r in got:
        want = ids(TEXTS[r.doc_id] if r.doc_id is not None else "text without an id")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        at += len(want)
    none = scratch_path(spark, "t-pack")
    bitpack.write_packed(empty, none, spec, 49408)
    assert bitpack.with_starts(bitpack.read_packed(spark, none)).count() == 0


def test_pack_any_width():
    rng = np.random.default_rng(4)
    for width in range(1, 25):
        ids = rng.integers(0, 1 << width, 301).astype(np.uint32)
        data = bitpack.pack(ids, width)
        assert len(data) == (301 * width + 7) // 8
        for a, b in ((0, 301), (7, 8), (100, 100), (13, 290)):
            assert (bitpack.unpack(data, width, a, b) == ids[a:b]).all()


def test_word_encoder_equals_tokenizer(tokenizer):
    spec, tok = tokenizer
    enc = bitpack.WordEncoder(spec, cached=8)
    for t in ["ΑΣ ΣΑΣ", "İ ﬁ é", "a<|endoftext|>b", "it's WE'LL 12,3 ½", "a b\x1cc\x85d", "日本 😀", BASE, "x" * 5000]:
        assert list(enc(t)) == tok.encode(t, add_special_tokens=False).ids


def test_attention_gradient():
    rng = np.random.default_rng(0)
    flat = attention_lm.initial(np.full(attention_lm.CLASSES + 1, 1 / (attention_lm.CLASSES + 1), np.float32)).astype(np.float64)
    x, y, counts = attention_lm.windows([np.append(rng.integers(0, attention_lm.CLASSES, n), attention_lm.END) for n in (5, 40, 17)])
    assert (y >= 0).sum() == 6 + 41 + 18 and counts.tolist() == [1, 3, 2]

    def loss(f):
        logp, _ = attention_lm.forward(attention_lm.split(f), x)
        t = y.ravel()
        return -logp[np.flatnonzero(t >= 0), t[t >= 0]].mean()

    g = attention_lm.gradient(attention_lm.split(flat), x, y)
    for i in rng.choice(len(flat), 30, replace=False):
        e = np.zeros_like(flat)
        e[i] = 1e-4
        assert abs(g[i] - (loss(flat + e) - loss(flat - e)) / 2e-4) < 1e-5


def test_attention_lm(spark, docs, empty, tokenizer, monkeypatch):
    monkeypatch.setattr(attention_lm, "HEAD", 40)  # the rest goes through the join
    got = attention_lm.scored(docs, tokenizer[0], 49408).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    c, n = Counter(), 0
    for d, t in rows:
        if not attention_lm.is_held(d):
            c.update(attention_lm.lower_words(t))
            n += 1
    N, V = sum(c.values()) + n, len(c) + 1
    texts = dict(rows)
    for r in got:
        ws = attention_lm.lower_words(texts[r.doc_id])
        base = sum(math.log10((k + .5) / (N + .5 * (V + 1))) for k in [c[w] for w in ws] + [n])
        assert r.train_tokens == N and r.n_tokens == len(ws) + 1 and r.n_known == sum(c[w] > 0 for w in ws) + 1
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    assert attention_lm.scored(empty, tokenizer[0], 49408).count() == 0


def test_attention_lm_learns_from_every_document(spark, tokenizer):
    spec, tok = tokenizer
    # training documents of which a sample of every 24th id holds none
    ids = [i for i in range(400) if not attention_lm.is_held(i) and zlib.crc32(f"s{i}".encode()) % 24][:120]
    topics = ["the river runs down from green hills", "price stock market trade bank money"]
    rows = [(i, " ".join([topics[n % 2]] * 5)) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lang, _, _ = attention_lm.learn(df, spec, 49408)
    assert attention_lm.class_sequences(df, spec, lang).count() == len(rows)
    share = np.append(lang.mass, len(rows) + 0.5)
    assert np.abs(lang.flat - attention_lm.initial((share / share.sum()).astype(np.float32))).max() > 0.01
    best = [lang.id_cluster[tok.encode(t, add_special_tokens=False).ids].argmax(axis=1) for t in topics]
    assert not set(best[0]) & set(best[1])


def test_attention_batch_gradient():
    rng = np.random.default_rng(5)
    p = attention_lm.split(attention_lm.initial(np.full(attention_lm.CLASSES + 1, 1 / (attention_lm.CLASSES + 1), np.float32)))
    x, y, _ = attention_lm.windows([np.append(rng.integers(0, attention_lm.CLASSES, n), attention_lm.END) for n in (900, 3, 400)])
    assert np.abs(attention_lm.batch_gradient(p, x, y, 16) - attention_lm.gradient(p, x, y)).max() < 1e-5


def small_language(seed=3, vocabulary=90):
    rng = np.random.default_rng(seed)
    lang = attention_lm.Language(rng.standard_normal((vocabulary, attention_lm.CLUSTERS)).astype(np.float32))
    lang.count(rng.integers(0, 50, vocabulary + 1).astype(float), 5)
    for name in ("own", "turn"):
        setattr(lang, name, (rng.standard_normal(getattr(lang, name).shape) * .3).astype(np.float32))
    return lang


def test_attention_reads_and_predicts_subword_ids(spark, tokenizer):
    spec, tok = tokenizer
    texts = ["It's the unquestionable \u00e9lan", "green hills green hills", None, "a \x01 b"]
    ids = [i for i in range(40) if not attention_lm.is_held(i)][:len(texts)]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    lang, _, _ = attention_lm.learn(df, spec, 49408)
    got = {r.data for r in attention_lm.class_sequences(df, spec, lang).collect()}
    want = set()
    for t in texts:
        ws = [tok.encode(w, add_special_tokens=False).ids or [lang.none] for w in (t or "").lower().split(" ") if w]
        want.add(np.array(sum(ws, []) + [lang.end], lang.ids_type()).tobytes())
    assert got == want
    a, b = (tok.encode(w, add_special_tokens=False).ids[0] for w in ("green", "hills"))
    assert np.abs(lang.own[[a, b]]).min() > 0       # both ids have learned their own rows


def test_attention_probabilities_of_ids():
    lang = small_language()
    rng = np.random.default_rng(1)
    before = rng.integers(0, lang.none, 20)

    # the next symbol after a context: ids, none and the end sum to one
    x, y, _ = attention_lm.windows([np.append(before, [i, lang.end]) for i in range(lang.none + 1)], lang.end, lang.pad)
    logp, kept = attention_lm.forward(attention_lm.split(lang.flat), lang.cls[x], lang.own[x])
    h, place = kept[-1].reshape(-1, attention_lm.DIM), np.arange(lang.none + 1) * 2 * attention_lm.STEP + len(before)
    t = np.arange(lang.none + 1)
    p = np.exp(logp[place, lang.cls[t]])
    some, begin, _, side, z, _, _ = attention_lm.turns(lang, t, h[place])
    p[some] *= np.exp(-np.add.reduceat(np.logaddexp(0, -side * z), begin))
    assert abs(p.sum() + np.exp(logp[place[0], attention_lm.END]) - 1) < 1e-4
    assert np.abs(h[place] - h[place[0]]).max() < 1e-5     # the symbol itself is not seen

    # at first the model is the smoothed frequencies of the ids
    plain = attention_lm.Language(lang.id_cluster)
    counts = np.arange(lang.none + 1.0)
    plain.count(counts, 7)
    split = attention_lm.split(plain.flat)
    split["Wo"][:] = 0
    total = counts.sum() + (len(counts) + 1) * 0.5 + 7
    want = np.log10((counts[before] + 0.5) / total).sum() + math.log10(7.5 / total)
    assert abs(attention_lm.class_scores(plain, [np.append(before, plain.end)])[0] - want) < 1e-3


def test_attention_gradient_of_id_tables():
    lang = small_language()
    rng = np.random.default_rng(2)
    for name in ("flat", "own", "turn", "bias"):
        setattr(lang, name, getattr(lang, name).astype(np.float64))
    x, y, _ = attention_lm.windows([np.append(rng.integers(0, lang.none + 1, n), lang.end) for n in (5, 40, 17)], lang.end, lang.pad)
    seqs = np.split(y[y >= 0], np.flatnonzero(y[y >= 0] == lang.end)[:-1] + 1)

    def loss():
        return -attention_lm.class_scores(lang, seqs).sum() * math.log(10) / (y >= 0).sum()

    g, (ins, d_in, _), (nodes, d_node, _) = attention_lm.Trainer(lang, 0.02, 0).gradient(x, y, 2)
    checks = [("flat", (i,), g[i]) for i in rng.choice(len(g), 20, replace=False)]
    checks += [("own", (ins[k], 3), d_in[k, 3]) for k in rng.choice(len(ins), 8, replace=False)]
    checks += [("turn", (nodes[k], 5), d_node[k, 5]) for k in rng.choice(len(nodes), 8, replace=False)]
    checks += [("bias", (nodes[k],), d_node[k, -1]) for k in rng.choice(len(nodes), 4, replace=False)]
    for name, at, want in checks:
        table, old = getattr(lang, name), getattr(lang, name)[at]
        table[at] = old + 1e-4
        up = loss()
        table[at] = old - 1e-4
        assert abs((up - loss()) / 2e-4 - want) < 1e-5, (name, at)
        table[at] = old


def test_attention_learns_from_one_reading(spark, tokenizer):
    texts = ["green hills run down", None, "the  river \x01", "a b c " * 40]
    ids = [i for i in range(60) if not attention_lm.is_held(i)][:len(texts)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").mapInArrow(counted, "doc_id long, text string")
    lang, words, totals = attention_lm.learn(df, tokenizer[0], 49408)
    assert read.value == len(texts)      # words, ids and sequences come from one pass
    assert totals["docs"] == len(texts) and {r.c for r in words.collect()} == {1, 40}


def test_attention_row_sums():
    rng = np.random.default_rng(6)
    for n, most in ((0, 1), (1, 5), (400, 3), (3000, 200), (500, 90000)):
        rows, at = rng.integers(0, most, n), rng.integers(0, 70, n)
        values, weight = np.append(rng.standard_normal((70, 5)), np.zeros((1, 5)), axis=0), rng.standard_normal(n)
        for w in (None, weight):
            want = np.zeros((most, 5))
            np.add.at(want, rows, values[at] * (1 if w is None else w[:, None]))
            got, sums, times = attention_lm.row_sums(rows, at, values, w)
            assert (got == np.unique(rows)).all() and (times == np.bincount(rows, minlength=most)[got]).all()
            assert np.abs(sums - want[got]).max(initial=0) < 1e-9


def test_attention_equals_plain_softmax():
    rng = np.random.default_rng(8)
    x, _, _ = attention_lm.windows([np.append(rng.integers(0, attention_lm.CLASSES, n), attention_lm.END) for n in (3, 70, 16)])
    for scale in (1, 30):       # 30: rows' greatest scores lie far apart
        share = np.full(attention_lm.CLASSES + 1, 1 / (attention_lm.CLASSES + 1))
        p = {k: v.astype(float) for k, v in attention_lm.split(attention_lm.initial(share)).items()}
        p["E"] *= scale
        p["R"] += rng.standard_normal(len(p["R"]))
        _, kept = attention_lm.forward(p, x)
        h = kept[-1].reshape(len(x), attention_lm.STEP, -1)
        for w, row in enumerate(x):
            for i in range(attention_lm.STEP, len(row)):
                seen = [j for j in range(i + 1) if row[j] != attention_lm.PAD]
                if row[i] == attention_lm.PAD:
                    continue
                e = p["E"][row[seen]]
                s = (e @ p["Wk"]) @ (p["E"][row[i]] @ p["Wq"]) / math.sqrt(attention_lm.DIM) + p["R"][i - np.array(seen)]
                a = np.exp(s - s.max())
                want = p["E"][row[i]] + a @ e @ p["Wv"] @ p["Wc"] / a.sum()
                assert np.abs(h[w, i - attention_lm.STEP] - want).max() < 1e-5 * scale


ODD_WORDS = ["It's WE'LL they'RE don't o'clock '' 'll l'l a's's *'s", "\u00c9lan \u00e0\u00d7b na\u00efve\u00f7 \u00fe\u00df\u00ff", "a<|endoftext|>b <|x a<b |>",
             "12,3 x9y \u00bd 7%%%", "\u0130stanbul \u03a3\u0391\u03a3 \u65e5\u672c caf\u0065\u0301 \u0142\u00f3d\u017a", "a\x01b \x1c \x7f", "long" * 16 + " " + "longer" * 20, None, "", " \t\v\f\r\n "]


def test_attention_on_the_jvm(spark, tokenizer, monkeypatch):
    """The JVM's loops give what the Python code gives: words, ids, counts, the
    trained tables (so also the order of the windows) and the scores."""
    rng = np.random.default_rng(4)
    letters = "etaoinshr\u00e9\u00c9\u00fc'.,-<|3 "
    texts = ODD_WORDS + ["".join(rng.choice(list(letters), n)) for n in rng.integers(1, 900, 60)]
    rows = [(None if i % 9 == 4 else i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(attention_lm, "HEAD", 40)
    monkeypatch.setattr(attention_lm, "COUNTED", 200)      # the table of words is written out and begun anew
    monkeypatch.setattr(attention_lm, "TOGETHER", 5000)
    assert jvm.loader(spark)

    def run():
        stats = attention_lm.statistics(df, tokenizer[0], 49408).collect()
        lang, words, totals = attention_lm.learn(df, tokenizer[0], 49408)
        scores = attention_lm.scored(df, tokenizer[0], 49408).collect()
        sequences = sorted((r.sequence, r.ids or b"") for r in stats if r.kind == 3)
        return sequences, sorted(tuple(r) for r in words.collect()), totals, lang.rows(), sorted(scores, key=lambda r: (r.doc_id or -1, r.n_tokens, r.base_score))

    got = run()
    monkeypatch.setattr(jvm, "loader", lambda spark: None)
    want = run()
    assert got[:3] == want[:3] and len(got[0]) > 50
    assert np.abs(got[3] - want[3]).max() < 1e-3 and np.abs(want[3][-49000:, :attention_lm.DIM]).max() > 0.05     # trained
    assert len(got[4]) == len(rows)
    for a, b in zip(got[4], want[4]):
        assert tuple(a)[:-2] == tuple(b)[:-2]
        assert abs(a.base_score - b.base_score) < 1e-9 * abs(b.base_score) and abs(a.score - b.score) < 1e-4 * abs(b.score)


def test_pair_tables_of_other_rules(tokenizer):
    spec = json.loads(tokenizer[0])
    assert len(attention_lm.pair_tables(tokenizer[0])["merges"]) == len(spec["model"]["merges"])
    for change in ({"ignore_merges": True}, {"byte_fallback": True}, {"vocab": {"a": 0}}):
        other = {**spec, "model": {**spec["model"], **change}}
        assert not len(attention_lm.pair_tables(json.dumps(other))["merges"])     # all words are left to Python


def test_cotraining_held_out(spark):
    from staylens.llm.common import load
    sf = "/root/testdata/sf0.01"
    docs_, labels = load(spark, sf, "documents"), load(spark, sf, "labels")
    model = cotraining.fit(docs_, labels)
    assert model["quality"]["accuracy"] >= 0.9
    odd = spark.createDataFrame([(1, None, None, None), (2, " ", "en", "s")], "doc_id long, text string, lang string, source string")
    assert [(r.score, r.kept) for r in cotraining.score(odd, model).collect()] == [(0.0, False)] * 2
    none = cotraining.fit(docs_, labels.where("false"))
    assert cotraining.score(docs_, none).where("not kept").count() == docs_.where("trim(text) = ''").count()


def test_cotraining_rejects_toxic_documents(spark):
    from staylens.llm.common import load
    sf = "/root/testdata/sf0.1"
    docs_, labels = load(spark, sf, "documents").select("doc_id", "text", "lang", "source"), load(spark, sf, "labels")
    model = cotraining.fit(docs_, labels)
    assert model["quality"]["accuracy"] >= 0.95 and model["toxic"]["accuracy"] >= 0.95   # on labels nothing else used
    by = {(r.quality, r.toxic): r.kept for r in cotraining.score(docs_, model).join(labels, "doc_id").groupBy("quality", "toxic").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert by[1, 0] >= 0.99 and by[1, 1] <= 0.05 and by[0, 0] <= 0.05 and by[0, 1] <= 0.05


def test_cotraining_sums_equal_the_documents(spark):
    """The exchanged sums against a plain loop over the pseudo-labelled documents."""
    sf = "/root/testdata/sf0.001"
    rows = cotraining.load(spark, sf, "documents").select("text", "lang", "source").repartition(3)
    f = cotraining.Features()
    table = rows.toArrow().combine_chunks().to_batches()[0]
    raw = [(t or "").encode() for t in table.column("text").to_pylist()]
    cuts = cotraining.metadata_cuts(np.array([f.metadata(r, "en", "s") for r in raw]))
    text, meta = cotraining.views_of(table, cuts, f)
    rng = np.random.default_rng(3)
    w = [rng.normal(size=cotraining.FEATURES).astype(np.float32), 4 * rng.normal(size=cotraining.metadata_size(cuts)).astype(np.float32)]
    m = {"w": w, "b": [0.1, -0.2], "scale": [np.array([1.0, 0.0])] * 2, "sides": [[True, False], [True, True]],
         "weights": (0.5, 2.0), "rows": 10 ** 9}
    got = cotraining.exchange(rows, cuts, {"quality": m})["quality"]
    logit = [np.clip(x.dot(v.astype(float)) + c, -30, 30) for x, v, c in zip((text, meta), w, m["b"])]
    for j, x in enumerate((text, meta)):
        want = np.zeros((4, len(w[j]) + 1))
        at = np.concatenate([[0], np.cumsum(x.n)])
        for d in range(len(raw)):
            p = 1 / (1 + math.exp(-logit[1 - j][d]))
            no, yes = m["sides"][1 - j]
            if not (p >= cotraining.CONFIDENT and yes or p <= 1 - cotraining.CONFIDENT and no):
                continue
            y, q = float(p > 0.5), 1 / (1 + math.exp(-logit[j][d]))
            weight = m["weights"][int(y)]
            for i in [*x.index[at[d]:at[d + 1]].tolist(), len(w[j])]:
                want[:, i] += (1, y, (q - y) * weight, q * (1 - q) * weight * (x.n[d] + 1))
        assert want[0, -1] > 0
        np.testing.assert_allclose(got[j].held, want, rtol=1e-4, atol=1e-4)


def test_cotraining_defined_cases(spark, docs, empty):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (6, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for some, lab in ((empty, labels), (docs, labels.where("false")), (empty, labels.where("false"))):
        model = cotraining.fit(some, lab)
        assert cotraining.score(some, model).count() == some.count()
    model = cotraining.fit(docs, labels)     # too few labels of either class: nothing but blank texts is rejected
    got = cotraining.score(docs.withColumn("score", F.lit("x")), model, columns=("doc_id", "text", "score")).collect()
    assert all(r.kept == bool((r.text or "").strip()) and isinstance(r.score, float) for r in got) and len(got) == docs.count()


def test_pipeline(spark):
    import corpus_pipeline as P
    from staylens.llm.common import load
    sf = "/root/testdata/sf0.001"
    docs_ = load(spark, sf, "documents")
    out = P.run(spark, sf).toPandas()
    assert {*docs_.columns, "shard", "slot"} <= {*out.columns} and len(out)
    texts = {r.doc_id: r.text for r in docs_.collect()}
    assert all(texts[d] == t for d, t in zip(out.doc_id, out.text))
    bench = [" ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in load(spark, sf, "benchmark").collect()]
    assert not any(b in " ".join(re.findall(r"[^\W_]+", t.lower())) for t in out.text for b in bench)
