"""Quality classifier by co-training.

Two views of a document -- the words of its text, and metadata (language,
source, lengths, character and repetition shares) -- each learn both labels,
``quality`` and ``toxic``, from labelled documents.  Over several rounds a view
passes the pseudo-labels it is confident of (and right about on held-out labels)
to the other view's training set.  The views are then calibrated and combined on
held-out labels, and every document is scored.

Only the labelled sample is bounded (``LABELLED`` documents, chosen by a hash of
their id).  All documents take part in every exchange (their own labels do not:
leaving out the labelled ones would cost a shuffle of the texts): each task
labels its documents with the confident views and sums, per feature of the other
view, how many documents hold it, how many of those are positive, and the
gradient and curvature of the loss; Spark adds these sums (``FEATURES`` numbers
a view at most reach the driver), and the view is fitted to its labelled rows
plus this quadratic bound of the loss of the pseudo-labelled ones.

Of the labelled documents a quarter calibrates and combines the views, one in 32
only measures their accuracy, the rest is fitted.

Defined cases: null and blank texts score 0 and are rejected; null metadata is
a category of its own; repeated labels of a document count as one (lowest
quality, highest toxic); a label that has one class only, or none, does not
reject anything; repeated rows score alike; an empty table gives no rows; a
column named like a score is replaced by it.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import load

LABELLED = 12_000
HASH_BITS = 18
FEATURES = 1 << HASH_BITS
BLOCK = 256     # features of one partial sum
ROUNDS = 3
EPOCHS = 30
CONFIDENT = 0.98
BINS = 8
CHI2 = 25.0     # evidence a feature needs (one in 3 million by chance)
SYMBOLS = b"#*$%&|<>!@{}[]()=/\\_~^+-.,;:?\"'"
MEMO = 1 << 19
NAMES = 64      # hashed cells for language and source each
LABELS = ("quality", "toxic")
SCORES = ("quality_score", "toxic_score", "score", "kept")


class Features:
    """Hashed distinct words and metadata numbers of a document."""

    WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
    UPPER = bytes(range(65, 91))
    DIGIT = bytes(range(48, 58))

    def __init__(self):
        self.memo = {}

    def words(self, raw: bytes) -> np.ndarray:
        import xxhash
        if len(self.memo) > MEMO:
            self.memo = {}
        memo, out = self.memo, []
        for w in set(self.WORD.findall(raw.lower())):
            i = memo.get(w)
            if i is None:
                i = memo[w] = xxhash.xxh32_intdigest(w) >> (32 - HASH_BITS)
            out.append(i)
        return np.unique(np.array(out, np.int32))

    @staticmethod
    def cell(name) -> int:
        import xxhash
        return 0 if name is None else 1 + xxhash.xxh32_intdigest(str(name)) % (NAMES - 1)

    def metadata(self, raw: bytes, lang, source) -> list[float]:
        ws = raw.split()
        n, k = max(1, len(raw)), max(1, len(ws))
        lines = raw.split(b"\n")
        share = lambda chars: (n - len(raw.translate(None, chars))) / n
        return [float(self.cell(lang)), float(self.cell(source)), math.log1p(len(raw)), math.log1p(len(ws)), n / k,
                len(set(ws)) / k, sum(map(bytes.__eq__, ws, ws[1:])) / k, share(self.UPPER), share(self.DIGIT),
                math.log1p(len(lines)), math.log1p(n / len(lines)), len(set(lines)) / len(lines),
                *[raw.count(SYMBOLS[i:i + 1]) / k for i in range(len(SYMBOLS))]]


def metadata_cuts(rows: np.ndarray) -> list[np.ndarray]:
    """Bin edges of the metadata numbers (columns 2 and up) by quantiles."""
    return [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(2, rows.shape[1])]


def metadata_size(cuts: list[np.ndarray]) -> int:
    return 2 * NAMES + BINS * len(cuts)


def metadata_cells(cuts: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """One-hot cells: names as they are, numbers by their bins."""
    out = [rows[:, 0].astype(np.int64), NAMES + rows[:, 1].astype(np.int64)]
    for j, c in enumerate(cuts):
        # the lowest value (often 0) is a bin of its own: right side of the cut
        out.append(2 * NAMES + BINS * j + np.searchsorted(c, rows[:, j + 2], "left"))
    return np.stack(out, axis=1)


class Rows:
    """Sparse 0/1 rows.  Sums go over them some rows at a time, so they need
    little memory beside the indices."""

    TOGETHER = 1024

    def __init__(self, arrays, index=None, n=None):
        self.index = (np.concatenate(arrays) if len(arrays) else np.zeros(0)).astype(np.int32) if index is None else index
        self.n = np.array([len(a) for a in arrays], np.int64) if n is None else n

    def parts(self):
        """Slices of rows, their indices and which row of the slice each is of."""
        ends = np.concatenate([[0], np.cumsum(self.n)])
        for s in range(0, len(self.n), self.TOGETHER):
            e = min(s + self.TOGETHER, len(self.n))
            yield slice(s, e), self.index[ends[s]:ends[e]], np.repeat(np.arange(e - s), self.n[s:e])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *[np.bincount(row, weights=w[index], minlength=at.stop - at.start)
                                              for at, index, row in self.parts()]])

    def sums(self, values: np.ndarray, size: int) -> np.ndarray:
        """Per feature, the values of the rows that hold it."""
        out = np.zeros(size)
        for at, index, row in self.parts():
            out += np.bincount(index, weights=values[at][row], minlength=size)
        return out

    def only(self, live: np.ndarray) -> Rows:
        """The rows with only those features."""
        kept = [(index[live[index]], np.bincount(row[live[index]], minlength=at.stop - at.start)) for at, index, row in self.parts()]
        return Rows([], np.concatenate([np.zeros(0, np.int32), *[k[0] for k in kept]]),
                    np.concatenate([np.zeros(0, np.int64), *[k[1] for k in kept]]))


class Sums:
    """What a set of pseudo-labelled documents adds to the fit of one view, per
    feature (the last entry: all documents): documents, positive ones, gradient
    and curvature bound of the weighted loss at the weights they were taken at."""

    def __init__(self, size: int):
        self.held, self.w = np.zeros((4, size + 1)), np.zeros(size + 1)

    def add(self, x: Rows, y: np.ndarray, logit: np.ndarray, weight: np.ndarray) -> None:
        p = 1 / (1 + np.exp(-logit))
        r, h = (p - y) * weight, p * (1 - p) * weight * (x.n + 1)
        for total, v in zip(self.held, (np.ones(len(y)), y, r, h)):
            total[:-1] += x.sums(v, len(total) - 1)
            total[-1] += v.sum()


def evidence(x: Rows, y: np.ndarray, size: int, more: Sums | None) -> np.ndarray:
    """Features whose 2x2 table with the label has a chi-square of at least
    ``CHI2``; thousands of neutral words would otherwise outweigh a few telling
    ones in long texts."""
    n, pos = float(len(y)), float(y.sum())
    c, a = x.sums(np.ones(len(y)), size), x.sums(y, size)
    if more is not None:
        c, a, n, pos = c + more.held[0, :-1], a + more.held[1, :-1], n + more.held[0, -1], pos + more.held[1, -1]
    return n * (a * (n - pos) - (c - a) * pos) ** 2 / np.maximum(pos * (n - pos) * c * (n - c), 1e-9) >= CHI2


def class_weights(y: np.ndarray) -> tuple[float, float]:
    """Weight of a negative and of a positive document: classes balanced."""
    pos = y.mean()
    return 0.5 / max(1 - pos, 1e-9) / len(y), 0.5 / max(pos, 1e-9) / len(y)


class Logistic:
    """Logistic regression on 0/1 features: full-batch Adagrad with an L1 step."""

    def __init__(self, size: int, l1: float = 2e-5, rate: float = 0.5):
        self.w, self.b, self.l1, self.rate = np.zeros(size), 0.0, l1, rate

    def fit(self, x: Rows, y: np.ndarray, more: Sums | None = None, epochs: int = EPOCHS):
        size = len(self.w)
        live = evidence(x, y, size, more)
        x = x.only(live)
        w, b = np.zeros(size), 0.0
        g2, b2 = np.full(size, 1e-8), 1e-8
        weight = np.take(class_weights(y), (y > 0.5).astype(int))
        for _ in range(epochs):
            r = (1 / (1 + np.exp(-np.clip(x.dot(w) + b, -30, 30))) - y) * weight
            g, gb = x.sums(r, size), r.sum()
            if more is not None:    # the pseudo-labelled documents by their quadratic bound
                g = g + live * (more.held[2, :-1] + more.held[3, :-1] * (w - more.w[:-1]))
                gb += more.held[2, -1] + more.held[3, -1] * (b - more.w[-1])
            g2 += g * g
            step = self.rate / np.sqrt(g2)
            w = w - step * g
            w = np.sign(w) * np.maximum(np.abs(w) - step * self.l1, 0)
            b2 += gb ** 2
            b -= self.rate / math.sqrt(b2) * gb
        self.w, self.b = w, b
        return self

    def logit(self, x: Rows) -> np.ndarray:
        return np.clip(x.dot(self.w) + self.b, -30, 30)


def newton(columns: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 25) -> np.ndarray:
    """Logistic regression on a few columns (calibration, combination)."""
    x = np.column_stack([columns, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def probability(logit):
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def views_of(batch, cuts: list[np.ndarray], f: Features) -> tuple[Rows, Rows]:
    """Text and metadata rows of a batch with text, lang and source."""
    raws = [(t.as_py() or "").encode("utf-8") for t in batch.column("text")]
    meta = [f.metadata(r, x, s) for r, x, s in zip(raws, batch.column("lang").to_pylist(), batch.column("source").to_pylist())]
    return Rows([f.words(r) for r in raws]), Rows(list(metadata_cells(cuts, np.array(meta).reshape(len(raws), -1))))


def fit_views(views: tuple, y: np.ndarray, use: np.ndarray, held: np.ndarray, sizes: tuple, more: list) -> dict:
    """Both views fitted to the rows ``use`` and the sums ``more``, calibrated on
    ``held``; ``sides``: whether a view may pass on its negatives, positives."""
    models, scales, sides = [], [], []
    for x, size, m in zip(views, sizes, more):
        models.append(Logistic(size).fit(subset(x, use), y[use], m))
        s = newton(models[-1].logit(subset(x, held))[:, None], y[held])
        scales.append(s)
        p = probability(models[-1].logit(subset(x, held)) * s[0] + s[1])
        sure = [(p <= 1 - CONFIDENT, 0.0), (p >= CONFIDENT, 1.0)]
        sides.append([bool(t.sum() >= 20 and (y[held][t] == v).mean() >= CONFIDENT) for t, v in sure])
    return {"w": [m.w for m in models], "b": [m.b for m in models], "scale": scales, "sides": sides,
            "weights": class_weights(y[use]), "rows": int(use.sum())}


def exchange(pool: DataFrame, cuts: list[np.ndarray], fitted: dict) -> dict:
    """label -> the :class:`Sums` of each view, from the pseudo-labels that the
    other view passes on over all documents of the pool."""
    sizes = (FEATURES, metadata_size(cuts))
    shared = pool.sparkSession.sparkContext.broadcast((cuts, {
        k: {**m, "w": [w.astype(np.float32) for w in m["w"]]} for k, m in fitted.items()}))

    def run(batches):
        cuts, models = shared.value
        f = Features()
        sums = {(k, j): Sums(sizes[j]) for k in models for j in (0, 1)}
        for b in batches:
            if not b.num_rows:
                continue
            views = views_of(b, cuts, f)
            for k, m in models.items():
                logits = [np.clip(x.dot(w) + c, -30, 30) for x, w, c in zip(views, m["w"], m["b"])]
                for j in (0, 1):
                    p = probability(logits[1 - j] * m["scale"][1 - j][0] + m["scale"][1 - j][1])
                    no, yes = m["sides"][1 - j]
                    on = ((p >= CONFIDENT) & yes) | ((p <= 1 - CONFIDENT) & no)
                    if on.any():
                        y = (p[on] > 0.5).astype(float)
                        sums[k, j].add(subset(views[j], on), y, logits[j][on], np.take(m["weights"], y.astype(int)))
        out = {"label": [], "view": [], "block": [], "sums": []}
        for (k, j), s in sums.items():
            for at in range(0, s.held.shape[1], BLOCK):
                part = s.held[:, at:at + BLOCK]
                if part.any():
                    out["label"].append(k)
                    out["view"].append(j)
                    out["block"].append(at)
                    out["sums"].append(part.astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out["label"], pa.string()), pa.array(out["view"], pa.int32()),
                                          pa.array(out["block"], pa.int32()), pa.array(out["sums"], pa.binary())], names=list(out))

    def merge(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), "<f4").astype(float) for x in table.column("sums"))
        return table.slice(0, 1).set_column(3, "sums", pa.array([total.astype("<f4").tobytes()], pa.binary()))

    schema = "label string, view int, block int, sums binary"
    got = pool.mapInArrow(run, schema).groupBy("label", "view", "block").applyInArrow(lambda t: merge(t), schema).toArrow()
    out = {k: [Sums(n) for n in sizes] for k in fitted}
    for k, m in fitted.items():
        for s, w, c in zip(out[k], m["w"], m["b"]):
            s.w = np.append(w.astype(np.float32), c)
    keys = [got.column(c).to_pylist() for c in ("label", "view", "block")]
    for k, j, at, part in zip(*keys, got.column("sums")):
        part = np.frombuffer(part.as_buffer(), "<f4").reshape(4, -1)
        out[k][j].held[:, at:at + part.shape[1]] = part
    for k, m in fitted.items():     # together they weigh as much as the labelled rows at most, at every size
        for s in out[k]:
            s.held *= min(1.0, m["rows"] / max(s.held[0, -1], 1.0))
    return out


def combine(views: tuple, y: np.ndarray, held: np.ndarray, test: np.ndarray, m: dict) -> dict:
    """Weights, the combination of the calibrated views, and its accuracy on
    labels that nothing else has used."""
    logits = np.column_stack([np.clip(x.dot(w) + c, -30, 30) * s[0] + s[1]
                              for x, w, c, s in zip(views, m["w"], m["b"], m["scale"])])
    mix = newton(logits[held], y[held])
    right = (logits[test] @ mix[:2] + mix[2] > 0) == (y[test] > 0.5)
    return {"w": [w.astype(np.float32) for w in m["w"]], "b": m["b"], "scale": m["scale"], "mix": mix,
            "accuracy": float(right.mean()) if len(right) else float("nan")}


def subset(x: Rows, mask: np.ndarray) -> Rows:
    return Rows([], x.index[np.repeat(mask, x.n)], x.n[mask])


def labelled_rows(docs: DataFrame, lab: DataFrame, labelled: int = LABELLED) -> pa.Table:
    """Features of the bounded labelled sample."""
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    some = lab.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(labelled)
    some = some.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_quality"), F.col("toxic").cast("int").alias("_toxic"))
    rows = docs.select("doc_id", "text", "lang", "source").join(F.broadcast(some), F.col("doc_id") == F.col("_id"))  # bounded sample

    def run(batches):
        f = Features()
        for b in batches:
            raws = [(t.as_py() or "").encode("utf-8") for t in b.column("text")]
            ws = [f.words(r) for r in raws]
            meta = [f.metadata(r, x, s) for r, x, s in zip(raws, b.column("lang").to_pylist(), b.column("source").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_quality"), b.column("_toxic"), pa.array(ws, pa.list_(pa.int32())),
                 pa.array(meta, pa.list_(pa.float64()))], names=["doc_id", "quality", "toxic", "words", "meta"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", "_quality", "_toxic").mapInArrow(
        run, "doc_id long, quality int, toxic int, words array<int>, meta array<double>").toArrow()


def fit(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> dict:
    """The model as plain data: metadata cuts and, per label, weights (None where
    the labels have one class only)."""
    import xxhash
    lab = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    t = labelled_rows(docs, lab)
    out = {"cuts": None, **{k: None for k in LABELS}}
    if not t.num_rows:
        return out
    t = t.take(pa.array(np.argsort(t.column("doc_id").to_numpy(), kind="stable"), pa.int64()))
    ids = t.column("doc_id").to_pylist()
    meta = np.array(t.column("meta").to_pylist(), float).reshape(len(ids), -1)
    out["cuts"] = metadata_cuts(meta)
    views = (Rows([x.values.to_numpy() for x in t.column("words")]), Rows(list(metadata_cells(out["cuts"], meta))))
    sizes = (FEATURES, metadata_size(out["cuts"]))
    part = np.array([xxhash.xxh32_intdigest(str(i)) % 32 for i in ids])
    ys, masks = {}, {}
    for k in LABELS:
        y = np.array([np.nan if v is None else float(v > 0) for v in t.column(k).to_pylist()])
        known = ~np.isnan(y)
        use, held, test = known & (part > 8), known & (part < 8), known & (part == 8)
        if len(np.unique(y[use])) == 2 and len(np.unique(y[held])) == 2:
            ys[k], masks[k] = y, (use, held, test)
    pool = docs.select("text", "lang", "source")
    more = {k: [None, None] for k in ys}
    for r in range(rounds):
        fitted = {k: fit_views(views, ys[k], *masks[k][:2], sizes, more[k]) for k in ys}
        if r < rounds - 1 and any(any(map(any, m["sides"])) for m in fitted.values()):
            more = exchange(pool, out["cuts"], fitted)
    out.update({k: combine(views, ys[k], *masks[k][1:], fitted[k]) for k in ys})
    del t, views, more
    pa.default_memory_pool().release_unused()   # the driver gives back what the sample took
    return out


def score(docs: DataFrame, model: dict, keep_at: float = 0.5, columns: tuple = ("doc_id",)) -> DataFrame:
    """``columns`` plus quality_score, toxic_score, score, kept for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 labels x 2**18 weights
    columns = [c for c in columns if c not in SCORES]
    fields = [docs.schema[c] for c in columns]

    def run(batches):
        m, f = shared.value, Features()
        for b in batches:
            q, x = [], []
            raws = [(t.as_py() or "").encode("utf-8") for t in b.column("text")]
            full = np.array([bool(r.strip()) for r in raws])
            p = {"quality": np.ones(len(raws)), "toxic": np.zeros(len(raws))}
            if m["cuts"] is not None and len(raws):
                text, meta = views_of(b, m["cuts"], f)
                for name in p:
                    if m[name] is not None:
                        h = m[name]
                        z = [np.clip(v.dot(w) + c, -30, 30) * s[0] + s[1]
                             for v, w, c, s in zip((text, meta), h["w"], h["b"], h["scale"])]
                        p[name] = probability(np.column_stack(z) @ h["mix"][:2] + h["mix"][2])
            good = np.where(full, p["quality"] * (1 - p["toxic"]), 0.0)
            kept = full & (p["quality"] >= keep_at) & (p["toxic"] < keep_at)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in columns] + [pa.array(p["quality"]), pa.array(p["toxic"]), pa.array(good), pa.array(kept)],
                names=[*columns, *SCORES])

    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in fields) + ", " if fields else ""
    return docs.select(*columns, *[c for c in ("text", "lang", "source") if c not in columns]).mapInArrow(
        run, schema + "quality_score double, toxic_score double, score double, kept boolean")


def op9_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    return score(docs, fit(docs, load(spark, sf_dir, "labels")))
