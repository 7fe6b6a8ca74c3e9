"""Block convolution against an all-periods search."""

import hashlib
import random
import re
import zlib

import numpy as np

from staylens.llm import periodic_runs as pr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted([(s, e - s, q) for (s, e), q in best.items()], key=lambda r: (r[0], r[2]))


def samples(count):
    rng = random.Random(5)
    out = [[], [b"a"], [b"a"] * 11, [b"a"] * 12, [b"a", b"b"] * 6, [b"x"] * 900, [b"%d" % i for i in range(50)] * 7]
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 900:
        a, b = b, b + a
    out.append(b[:900])     # many overlapping runs
    for _ in range(count):
        n = rng.choice([3, 12, 13, 14, 30, 60, 150, 400])
        v = rng.choice([1, 2, 3, 5, 50])
        w = [b"%d" % rng.randrange(v) for _ in range(n)]
        for _ in range(rng.randrange(0, 4)):
            a = rng.randrange(n)
            p, e = rng.randrange(1, max(2, (n - a) // 2)), rng.randrange(a, n + 1)
            for i in range(a + p, e):
                w[i] = w[i - p]
        out.append(w)
    return out


def test_runs_equal_brute_force():
    texts = samples(150)
    assert pr.runs_of(texts) == [brute(w) for w in texts]
    assert [pr.runs_of([w])[0] for w in texts[:8]] == [brute(w) for w in texts[:8]]


def test_periods_beyond_the_largest_block(monkeypatch):
    monkeypatch.setattr(pr, "MAX_BLOCK", 8)
    texts = samples(60)
    assert pr.runs_of(texts) == [brute(w) for w in texts]


def test_transform_correlates_exactly():
    rng = np.random.default_rng(2)
    for size in (16, 64, 128, 256, 1024, 4096):
        t = pr.transform(size)
        a, b = rng.integers(0, 1000, (2, 3, size))
        got = t.backward(pr.balanced(t.mirrored(t.forward(pr.balanced(a.astype(float)))) * t.forward(pr.balanced(b.astype(float)))))
        for k in (0, 1, size // 2, size - 1):
            want = (a * np.roll(b, -k, axis=1)).sum(axis=1)
            assert ((got[:, k].astype(np.int64) - want) % pr.PRIME == 0).all()


def test_shifted_spectrum():
    """The spectrum of two blocks in a row from those of each."""
    rng = np.random.default_rng(3)
    for size in (8, 32, 512):
        t = pr.transform(2 * size)
        x = np.zeros((2, 2 * size))
        x[:, :size] = rng.integers(0, 99, (2, size))
        f = t.forward(x)
        both = pr.balanced(f[:1] + t.sign * f[1:])
        want = t.forward(np.concatenate([x[0, :size], x[1, :size]])[None, :])
        assert (pr.balanced(both - want) == 0).all()


def expected(doc_id, text):
    w = [x.encode() for x in WORD.findall(text or "")]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, n_, q in runs for i in range(s + q, s + n_)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def test_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pr, "BATCH_WORDS", 500)
    rng = random.Random(9)
    texts = [None, "", " \n\t ", "one", "a " * 12, "é　x " * 30, "lone\x1cword " * 15, "long " * 3000 + "end"]
    rows = [(i, texts[i % 8] if i < 16 else " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 200))), i, "x")
            for i in range(120)]
    rows += [rows[4], rows[5], (None, "a b " * 20, 1, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, period long, collapsed string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = pr.op12_periodic_runs(spark, str(tmp_path)).collect()
    got = sorted(((str(r.doc_id), *r[1:]) for r in out), key=str)
    assert got == sorted(((str(r[0]), *expected(r[0], r[1])) for r in rows), key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(120)) > 5
    assert [c for c, _ in pr.op12_periodic_runs(spark, str(tmp_path)).dtypes] == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert pr.periodic_runs(df.where("false")).count() == 0
