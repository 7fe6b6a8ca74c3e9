"""Language-model scoring with a small causal self-attention model in numpy.

Learning (documents whose crc32 of the id, modulo 5, is not 1):

* One pass over all training documents counts their words (from the counts follow
  those of the subword ids) and writes their ids.  A text is the sequence of the
  ids of its words, then the end; a word of which the tokenizer keeps nothing is
  one more symbol.
* A one-layer causal attention model reads the ids before and predicts the next
  id, or the end, in two steps: the id's class, then the id by the turns of a
  Huffman tree over the class (hierarchical softmax, every turn from the attention
  output).  Classes cut the ids, ordered by text cluster and frequency, into parts
  of near equal mass (clusters: k-means rounds and id counts over all training
  documents).  It starts as the ids' smoothed frequencies.
* The model is trained on the windows of all training documents: each task trains
  a copy on its share and Spark averages the rows that the copies changed, for
  ``ROUNDS`` rounds; the driver holds tables of the vocabulary's size.

Scoring (all documents, whole texts): windows of ``2 * STEP`` positions overlap
by half; each scores its last ``STEP`` ids, so every id is scored once, with
``STEP`` to ``2 * STEP - 1`` ids of context, in batches with a causal and padding
mask.

The unigram base score looks words up in a table of the ``HEAD`` most frequent
words inside the task; the rarer words go through a join.

The loops over words, windows and targets run on the executors' JVM (``jvm.py``,
``Attention.java``), which leaves to Python the words whose letters need tables of
characters.  The Python code of the same loops is the plain form that the tests
compare with, and runs where the JVM's vectors are missing.

Defined cases: null and blank texts consist of the end token alone; a null
doc_id belongs to the training part; repeated rows are scored (and learned)
each; without training documents the counts are empty, the base score uses
V = 0 and the model is uniform; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import jvm
from staylens.llm.bitpack import WordEncoder, _Memo
from staylens.llm.common import cut, load, shuffle_parts

FOLDS, HELD = 5, 1
CLUSTERS = 8
CLASSES = 32
CELLS = 512             # hashed ids of a document, for k-means
KMEANS_ROUNDS = 6
DIM = 16
STEP = 16
ROUNDS = 2
BATCH = 256
HEAD = 1 << 19
COUNTED = 1 << 20      # distinct words a task counts before it writes them out
TOGETHER = 1 << 17     # words of the documents that a task looks up and scores at once
PASSES = 2             # over a task's share of windows, per round
TABLE_RATE = 0.1       # step of the id tables (Adagrad) in the first round


def is_held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


def lower_words(text) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()


def word_hash(w: bytes) -> int:
    import xxhash
    h = xxhash.xxh64_intdigest(w)
    return h - (1 << 64) if h >= 1 << 63 else h


# ---- the model ---------------------------------------------------------------------------

SHAPES = {"E": (CLASSES + 2, DIM), "Wq": (DIM, DIM), "Wk": (DIM, DIM), "Wv": (DIM, DIM), "Wc": (DIM, DIM),
          "Wo": (DIM, CLASSES + 1), "bo": (CLASSES + 1,), "R": (2 * STEP,)}
END, START, PAD = CLASSES, CLASSES, CLASSES + 1     # target class; input classes
_AHEAD = (np.arange(STEP)[:, None] + STEP) - np.arange(2 * STEP)[None, :]   # distance query - key
_CAUSAL = _AHEAD >= 0
_AHEAD_AT = np.maximum(_AHEAD, 0)


def split(flat: np.ndarray) -> dict:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = math.prod(shape)
        out[name], at = flat[at:at + n].reshape(shape), at + n
    return out


def size() -> int:
    return sum(math.prod(s) for s in SHAPES.values())


def initial(class_share: np.ndarray, seed: int = 7) -> np.ndarray:
    flat = (np.random.default_rng(seed).standard_normal(size()) * 0.15).astype(np.float32)
    p = split(flat)
    p["bo"][:] = np.log(class_share)
    p["R"][:] = 0
    return flat


def merged(p: dict) -> tuple[np.ndarray, np.ndarray]:
    """The products of weights that the attention needs: of scaled queries and keys
    ``Wq Wk^T``, and of values and their output ``Wv Wc``."""
    return p["Wq"] @ p["Wk"].T * np.float32(1 / math.sqrt(DIM)), p["Wv"] @ p["Wc"]


def attend(p: dict, e: np.ndarray, padded: np.ndarray):
    """Outputs at the last STEP positions of windows of inputs ``e``, and what the
    backward step needs: queries, keys' weights before they are divided by their
    sums, those sums, means of the inputs, and the query positions' inputs."""
    m, o = merged(p)
    last = e[:, STEP:].reshape(-1, DIM)
    q = (last @ m).reshape(-1, STEP, DIM)
    a = q @ e.transpose(0, 2, 1)
    a += np.where(_CAUSAL, p["R"][_AHEAD_AT], np.float32(-1e9))
    some = np.flatnonzero(padded.any(axis=1))
    a[some] += np.where(padded[some], np.float32(-1e9), np.float32(0))[:, None, :]
    a -= a.max(initial=-1e9)        # one shift for all rows
    low = a
    a = np.exp(low)
    ones = np.ones(2 * STEP, a.dtype)
    total = a.reshape(-1, 2 * STEP) @ ones
    if total.size and total.min() < 1e-12:     # too far below the greatest: a shift for each row
        low -= low.max(axis=2, keepdims=True)
        a = np.exp(low)
        total = a.reshape(-1, 2 * STEP) @ ones
    c = (a @ e).reshape(-1, DIM)
    c /= total[:, None]
    return last + c @ o, (e, q, a, total, c, last)


def class_logits(p: dict, h: np.ndarray) -> np.ndarray:
    """(classes and end, positions), less the greatest at each position."""
    logits = np.dot(p["Wo"].T, h.T)
    logits += p["bo"][:, None]
    logits -= logits.max(axis=0)
    return logits


def inputs(p: dict, x: np.ndarray, own: np.ndarray | None) -> np.ndarray:
    e = p["E"].take(x, axis=0)
    if own is not None:
        e += own
    return e


def forward(p: dict, x: np.ndarray, own: np.ndarray | None = None):
    """x: (windows, 2 * STEP) input classes, ``own``: what the inputs' ids add to
    them; log probabilities of the class at each of the last STEP positions, and
    what the backward step needs, the outputs last."""
    h, kept = attend(p, inputs(p, x, own), x == PAD)
    logits = class_logits(p, h)
    logits -= np.log(np.exp(logits).sum(axis=0))
    return logits.T, (*kept, h)


def gradient(p: dict, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Gradient of the mean cross entropy; y: (windows, STEP) target classes, -1 none."""
    logp, kept = forward(p, x)
    out, de = backward(p, y.ravel(), max(1, (y >= 0).sum()), np.exp(logp.T), kept)
    hot = np.zeros((x.size, CLASSES + 2), np.float32)
    hot[np.arange(x.size), x.ravel()] = 1
    split(out)["E"][:] = hot.T @ de.reshape(-1, DIM)
    return out


def backward(p: dict, t: np.ndarray, n: int, prob: np.ndarray, kept: tuple, more: np.ndarray | None = None):
    """Gradient of the cross entropy over ``n``, without that of E, and the
    gradient of the inputs.  t: target class of each position, -1 none; prob:
    (classes and end, positions), overwritten; ``more``: gradient of the outputs
    from elsewhere."""
    e, q, a, total, c, last, h = kept
    use = np.flatnonzero(t >= 0)
    prob[t[use], use] -= 1
    prob *= ((t >= 0) / n).astype(prob.dtype)
    g = split(out := np.zeros(size(), prob.dtype))
    g["Wo"][:] = np.dot(prob, h).T
    g["bo"][:] = prob.sum(axis=1)
    dh = np.dot(prob.T, p["Wo"].T)
    if more is not None:
        dh += more
    m, o = merged(p)
    d_o = c.T @ dh
    g["Wv"][:], g["Wc"][:] = d_o @ p["Wc"].T, p["Wv"].T @ d_o
    dc = dh @ o.T
    dc /= total[:, None]
    # of a softmax: weight * (gradient - mean gradient); both over ``total``, as ``a`` is not divided
    pair = np.empty((len(e), 2 * STEP, 2 * STEP), prob.dtype)      # rows: scores, weights
    ds = pair[:, :STEP]
    np.matmul(dc.reshape(-1, STEP, DIM), e.transpose(0, 2, 1), out=ds)
    ds -= np.einsum("ij,ij->i", dc, c).reshape(-1, STEP, 1)
    ds *= a
    pair[:, STEP:] = a
    g["R"][:] = np.bincount(_AHEAD_AT.ravel(), weights=(ds.sum(axis=0) * _CAUSAL).ravel(), minlength=2 * STEP)
    u = (ds @ e).reshape(-1, DIM)
    d_m = last.T @ u * np.float32(1 / math.sqrt(DIM))
    g["Wq"][:], g["Wk"][:] = d_m @ p["Wk"], d_m.T @ p["Wq"]
    de = pair.transpose(0, 2, 1) @ np.concatenate([q, dc.reshape(-1, STEP, DIM)], axis=1)
    dh += u @ m.T
    de[:, STEP:] += dh.reshape(-1, STEP, DIM)
    return out, de


def windows(sequences: list[np.ndarray], start: int = START, pad: int = PAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over sequences (each ends with the end): inputs,
    targets (-1 beyond the end), number of windows of each."""
    counts = np.array([-(-len(s) // STEP) for s in sequences], np.int64)
    x = np.full(int((counts + 1).sum()) * STEP, pad, np.int64)
    y = np.full(int(counts.sum()) * STEP, -1, np.int64)
    at = to = 0
    for s, c in zip(sequences, counts.tolist()):
        x[at + STEP] = start
        x[at + STEP + 1:at + STEP + len(s)] = s[:-1]
        y[to:to + len(s)] = s
        at, to = at + (c + 1) * STEP, to + c * STEP
    first = np.arange(int(counts.sum())) + np.repeat(np.arange(len(sequences)), counts)
    return x[first[:, None] * STEP + np.arange(2 * STEP)], y.reshape(-1, STEP), counts


def batch_gradient(p: dict, x: np.ndarray, y: np.ndarray, piece: int = 64) -> np.ndarray:
    """:func:`gradient` of a batch, summed over pieces that fit the cache."""
    g, n = np.zeros(size(), np.float32), max(1, (y >= 0).sum())
    for i in range(0, len(x), piece):
        some = y[i:i + piece]
        g += gradient(p, x[i:i + piece], some) * np.float32((some >= 0).sum() / n)
    return g


def turns(lang: Language, t: np.ndarray, h: np.ndarray):
    """Turns on the tree paths of the symbols ``t`` given the outputs ``h``: which
    of ``t`` have a path, their turns' first places, and of every turn the node, the
    side (1, -1), the logit, the node's weights and the output."""
    some = np.flatnonzero(lang.first[t + 1] > lang.first[t])
    at, n = lang.first[t[some]], lang.first[t[some] + 1] - lang.first[t[some]]
    begin = np.cumsum(n) - n
    place = np.repeat(some, n)
    path = np.arange(len(place)) + np.repeat(at - begin, n)
    node = lang.node[path]
    w, out = lang.turn.take(node, axis=0), h.take(place, axis=0)
    return some, begin, node, lang.side[path], np.einsum("ij,ij->i", w, out) + lang.bias[node], w, out


def levels(lang: Language, t: np.ndarray):
    """The turns of the symbols ``t``, one level of the trees at a time: an order of
    ``t`` by falling length of path, and for each level the node and the side of
    the turn there of the first of that order, as many as have one."""
    n = lang.first[t + 1] - lang.first[t]
    order = np.argsort((n.max(initial=0) - n).astype(np.uint16), kind="stable")    # 16 bits: radix sort
    begin = lang.first[t[order]]
    left = len(t) - np.cumsum(np.bincount(n, minlength=1))
    path = [begin[:k] + i for i, k in enumerate(left[:-1].tolist())]
    return order, [(lang.node.take(at), lang.side.take(at)) for at in path]


def row_sums(rows: np.ndarray, at: np.ndarray, values: np.ndarray, weight: np.ndarray | None = None, by: int = 8):
    """Distinct ``rows``, the sums of what they get, ``values[at]`` (times ``weight``),
    and how often they get some.  The last of ``values`` is zero: it fills blocks of
    ``by``, which are added in halves; that costs less than one by one."""
    if not len(rows):
        return np.zeros(0, np.int64), values[:0], np.zeros(0, np.int64)
    rows = rows.astype(np.uint16 if rows.max() < 1 << 16 else np.uint32)   # 16 bits: radix sort
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    begin = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    length = np.diff(begin, append=len(rows))
    blocks = -(-length // by)
    first = np.cumsum(blocks) - blocks
    to = np.arange(len(rows)) + np.repeat(first * by - begin, length)
    places = np.full(int(blocks.sum()) * by, len(values) - 1)
    places[to] = at[order]
    block = values.take(places, axis=0)
    if weight is not None:
        weights = np.zeros(len(places), values.dtype)
        weights[to] = weight[order]
        block *= weights[:, None]
    while by > 1:
        by //= 2
        block = block.reshape(-1, 2, by * values.shape[1])
        block = block[:, 0] + block[:, 1]
    sums, many = block.take(first, axis=0), blocks > 1
    if many.any():
        some = blocks[many]
        sums[many] = np.add.reduceat(block[np.repeat(many, blocks)], np.cumsum(some) - some, axis=0)
    return rows[begin].astype(np.int64), sums, length


def table_rate(rate: float) -> float:
    """Step of the id tables when that of the attention's weights is ``rate``."""
    return TABLE_RATE * rate / 0.02


def order_state(seed: int) -> np.ndarray:
    """Where numpy's generator of that seed begins: state and increment, in halves."""
    state = np.random.default_rng(seed).bit_generator.state["state"]
    return np.array([x >> shift & (1 << 64) - 1 for x in (state["state"], state["inc"]) for shift in (64, 0)], "<u8")


class Trainer:
    """One task's copy of the model: Adam for the attention's weights, Adagrad for
    the rows of the id tables, over a share of windows that arrive in pieces."""

    def __init__(self, lang: Language, rate: float, seed: int):
        self.start, self.rate, self.n, self.seen = lang, rate, 0, 0
        self.lang = lang.copy()
        self.m, self.v = np.zeros_like(lang.flat), np.zeros_like(lang.flat)
        self.steps = {name: np.full(len(getattr(lang, name)), 1e-12, np.float32) for name in ("own", "turn", "bias")}
        self.touched = {name: np.zeros(len(getattr(lang, name)), np.int64) for name in ("own", "turn")}
        self.order = np.random.default_rng(seed)

    def gradient(self, x: np.ndarray, y: np.ndarray, piece: int = 128):
        """Gradients of a batch of symbol windows: the attention's, and those of
        input rows, tree nodes and their biases (row, sum, number)."""
        lang, p = self.lang, split(self.lang.flat)
        n, t = max(1, int((y >= 0).sum())), y.ravel()
        kept = [attend(p, inputs(p, lang.cls.take(x[i:i + piece]), lang.own.take(x[i:i + piece], axis=0)), x[i:i + piece] == lang.pad)
                for i in range(0, len(x), piece)]
        h = np.concatenate([out for out, _ in kept])

        # the trees: the gradient of the outputs, and of every turn that of its node
        use = np.flatnonzero(t >= 0)
        order, path = levels(lang, t[use])
        use = use[order]
        mine = np.append(h.take(use, axis=0), np.zeros_like(h, shape=(1, DIM)), axis=0)
        more, slopes = np.zeros_like(h, shape=(len(use), DIM)), [np.zeros_like(h, shape=0)]
        for node, side in path:
            w = lang.turn.take(node, axis=0)
            z = np.einsum("ij,ij->i", w, mine[:len(node)])
            z += lang.bias.take(node)
            z *= side
            dz = -side / (1 + np.exp(np.minimum(z, 60))) / np.float32(n)
            w *= dz[:, None]
            more[:len(node)] += w
            slopes.append(dz)
        d_out = np.zeros_like(h)
        d_out[use] = more
        nodes = np.concatenate([np.zeros(0, np.int64), *[node for node, _ in path]])
        places = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(node)) for node, _ in path]])
        mine = np.append(mine, np.ones_like(h, shape=(len(mine), 1)), axis=1)      # 1: of the bias
        turned = row_sums(nodes, places, mine, np.concatenate(slopes))

        g, d_in = np.zeros_like(h, shape=size()), np.zeros_like(h, shape=(x.size + 1, DIM))
        target = np.where(t >= 0, lang.cls.take(t, mode="clip"), -1)
        for i, (out, before) in zip(range(0, len(x), piece), kept):
            prob = class_logits(p, out)
            np.exp(prob, out=prob)
            prob /= prob.sum(axis=0)
            here = slice(i * STEP, (i + piece) * STEP)
            one, de = backward(p, target[here], n, prob, (*before, out), d_out[here])
            g += one
            d_in[2 * i * STEP:2 * i * STEP + len(de) * 2 * STEP] = de.reshape(-1, DIM)
        full = np.flatnonzero(x.ravel() != lang.pad)
        own = row_sums(x.ravel()[full], full, d_in)
        hot = np.zeros((len(own[0]), CLASSES + 2), np.float32)
        hot[np.arange(len(hot)), lang.cls[own[0]]] = 1
        split(g)["E"][:] = hot.T @ own[1]
        return g, own, turned

    def _rows(self, name: str, rows: np.ndarray, g: np.ndarray, rate: float) -> None:
        """Adagrad with one step size per row."""
        table, steps = getattr(self.lang, name), self.steps[name]
        now = steps.take(rows) + (np.einsum("ij,ij->i", g, g) / DIM if g.ndim > 1 else np.square(g))
        steps[rows] = now
        by = np.float32(rate) / np.sqrt(now)
        table[rows] = table.take(rows, axis=0) - g * (by[:, None] if g.ndim > 1 else by)

    def train(self, x: np.ndarray, y: np.ndarray) -> None:
        rate = table_rate(self.rate)
        for _ in range(PASSES):
            turn = self.order.permutation(len(x))
            for i in range(0, len(x), BATCH):
                pick = turn[i:i + BATCH]
                g, (ins, d_in, n_in), (nodes, d_node, n_node) = self.gradient(x[pick], y[pick])
                self.n += 1
                self.m += 0.1 * (g - self.m)
                self.v += 0.01 * (g * g - self.v)
                self.lang.flat -= self.rate * (self.m / (1 - 0.9 ** self.n)) / (np.sqrt(self.v / (1 - 0.99 ** self.n)) + 1e-7)
                self._rows("own", ins, d_in, rate)
                self._rows("turn", nodes, d_node[:, :DIM], rate)
                self._rows("bias", nodes, d_node[:, DIM], rate)
                self.touched["own"][ins] += n_in
                self.touched["turn"][nodes] += n_node
        self.seen += len(x)

    def changes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers (of :meth:`Language.rows`), how often each was trained, and
        its change."""
        if not self.seen:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, DIM + 1))
        core = np.full(len(self.lang.core()), self.seen)
        n = np.concatenate([core, self.touched["own"], self.touched["turn"]])
        at = np.flatnonzero(n)
        return at, n[at], (self.lang.rows()[at] - self.start.rows()[at]).astype(float)


# ---- counts over the training documents --------------------------------------------------

def pair_tables(spec: str) -> dict:
    """What byte pair encoding needs of a tokenizer's file: the id of each byte
    within a piece and at its end, and of every merge the two ids and theirs
    together, by rank; no merges where the model has other rules."""
    model = json.loads(spec)["model"]
    none = {"single": np.zeros(256, "<i4"), "last": np.zeros(256, "<i4"), "merges": np.zeros((0, 3), "<i4")}
    if model.get("type", "BPE") != "BPE" or any(model.get(x) for x in (
            "dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        return none
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in shown]
    letters = [chr(x) if x in shown else chr(256 + rest.index(x)) for x in range(256)]
    ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if not all(x in ids for c in letters for x in (c, c + suffix)) or not all(a in ids and b in ids and a + b in ids for a, b in merges):
        return none
    return {"single": np.array([ids[c] for c in letters], "<i4"), "last": np.array([ids[c + suffix] for c in letters], "<i4"),
            "merges": np.array([(ids[a], ids[b], ids[a + b]) for a, b in merges], "<i4").reshape(-1, 3)}


def scanned(docs: DataFrame, spec: str, vocabulary: int, head: dict, schema: str) -> DataFrame:
    """The JVM's reading of the documents; column open: the words left to Python."""
    shared = jvm.share(docs.sparkSession, {
        **pair_tables(spec), **head, "sizes": np.array([vocabulary, FOLDS, HELD, COUNTED // 2], "<i8")})
    return jvm.run(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")),
                   "scan", shared, schema + ", open binary, sequence binary")


def completed(known: _Memo, lang: Language, sequence: bytes, left: bytes) -> bytes:
    """A sequence with the symbols of its left words in the places that hold the padding."""
    symbols = np.frombuffer(sequence, lang.ids_type())
    at = np.flatnonzero(symbols == lang.pad)
    parts, begin = [], 0
    for i, w in zip(at.tolist(), left.split(b"\n")):
        parts += [symbols[begin:i].tobytes(), known[w]]
        begin = i + 1
    return b"".join([*parts, symbols[begin:].tobytes()])


def distinct_ids(lang: Language, sequence: bytes) -> bytes | None:
    ids = np.unique(np.frombuffer(sequence, lang.ids_type()))
    ids = ids[ids < lang.none]
    return ids.astype("<u4").tobytes() if len(ids) else None


def complete(rows: DataFrame, spec: str, vocabulary: int) -> DataFrame:
    """The scanned rows without the column open, their sequences completed."""
    spec_b = rows.sparkSession.sparkContext.broadcast(spec)
    names = [c for c in rows.columns if c != "open"]

    def run(batches):
        lang, enc = Language.symbols(vocabulary), None
        for b in batches:
            left, columns = b.column("open"), {c: b.column(c) for c in names}
            if left.null_count < len(left):
                enc = enc or WordEncoder.shared(spec_b.value)
                known = lang.younger(enc)
                at = np.flatnonzero(left.is_valid().to_numpy(zero_copy_only=False)).tolist()
                new = {c: columns[c].to_pylist() for c in ("sequence", "ids") if c in columns}
                for i in at:
                    new["sequence"][i] = completed(known, lang, new["sequence"][i], left[i].as_py())
                    if "ids" in new:
                        new["ids"][i] = distinct_ids(lang, new["sequence"][i])
                columns.update({c: pa.array(x, pa.binary()) for c, x in new.items()})
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "open"))


def statistics(docs: DataFrame, spec: str, vocabulary: int) -> DataFrame:
    """kind 0: in ``sequence`` pairs of word hash and count, eight bytes each;
    kind 2: number of documents; kind 3, one row for every training document: its
    distinct ids (null: none), and the subword ids of its words and the end, two
    bytes each (four with a large vocabulary).  Counts are summed per task before
    they are written."""
    schema = "kind int, n long, ids binary, sequence binary"
    if jvm.loader(docs.sparkSession):
        return complete(scanned(docs, spec, vocabulary, {}, "kind int, n long, ids binary"), spec, vocabulary)
    spec_b = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        from collections import Counter
        lang, enc, words, n_docs = Language.symbols(vocabulary), WordEncoder.shared(spec_b.value), Counter(), 0
        end = np.array([lang.end], lang.ids_type()).tobytes()

        def out(kind, n, ids, sequence):
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(ids), pa.int32()), pa.array([n] * len(ids), pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(sequence, pa.binary())], names=["kind", "n", "ids", "sequence"])

        def flush():
            pairs = np.array([list(map(word_hash, words)), list(words.values())], "<i8").T
            words.clear()
            parts = [np.ascontiguousarray(pairs[i:i + (1 << 15)]).tobytes() for i in range(0, len(pairs), 1 << 15)]
            return out(0, 0, [None] * len(parts), parts)

        for b in batches:
            sequences, known = [], lang.younger(enc)
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                if is_held(d):
                    continue
                ws = lower_words(t.as_py())
                words.update(ws)
                sequences.append(b"".join(map(known.__getitem__, ws)) + end)
            if sequences:
                n_docs += len(sequences)
                yield out(3, 0, [distinct_ids(lang, x) for x in sequences], sequences)
            if len(words) >= COUNTED:
                yield flush()
        yield flush()
        yield out(2, n_docs, [None], [None])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def word_counts(stats: DataFrame) -> DataFrame:
    """hash, c: all training documents' words."""

    def run(batches):
        for b in batches:
            for x in b.column("sequence"):
                pairs = np.frombuffer(x.as_py(), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in pairs.T], names=["hash", "n"])

    return (stats.where("kind = 0").select("sequence").mapInArrow(run, "hash long, n long")
            .groupBy("hash").agg(F.sum("n").alias("c")))


def summed(df: DataFrame, columns: list[str], size: int, add) -> np.ndarray:
    """Sum over all rows of vectors of ``size`` numbers: ``add(total, *columns)``
    adds a batch to its task's total; Spark adds the tasks' totals."""

    def run(batches):
        total = np.zeros(size)
        for b in batches:
            add(total, *[b.column(c) for c in columns])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "v"])

    got = df.select(*columns).mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()  # size rows
    out = np.zeros(size)
    out[got.column("i").to_numpy()] = got.column("v").to_numpy()
    return out


def id_sets(column) -> tuple[np.ndarray, np.ndarray]:
    """Document number of each id, and the ids, of a column of id sets."""
    sets = column.to_pylist()
    n = np.fromiter(map(len, sets), np.int64, len(sets)) // 4
    return np.repeat(np.arange(len(sets)), n), np.frombuffer(b"".join(sets), "<u4").astype(np.int64)


def cell_counts(column) -> np.ndarray:
    """(documents, CELLS) square roots of the documents' hashed id counts."""
    doc, ids = id_sets(column)
    cell = (ids * 2654435761 % 2 ** 32) * CELLS >> 32
    return np.sqrt(np.bincount(doc * CELLS + cell, minlength=len(column) * CELLS).reshape(len(column), CELLS))


def unit(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)


def far_points(x: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` unit vectors of ``x``, each the farthest from those before."""
    at, near = [0], x @ x[0]
    while len(at) < min(n, len(x)):
        at.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[at[-1]])
    return x[at]


def cluster_ids(sets: DataFrame, vocabulary: int) -> np.ndarray:
    """(vocabulary, CLUSTERS) log probabilities of an id in the clusters found by
    k-means over all rows of ``sets`` (column data: a document's distinct ids).
    Each task offers its far points as seeds; rounds and id counts are sums."""

    def moments(total, data):
        x = cell_counts(data)
        total[:CELLS] += x.sum(axis=0)
        total[CELLS] += len(x)

    sums = summed(sets, ["data"], CELLS + 1, moments)
    if not sums[CELLS]:
        return np.full((vocabulary, CLUSTERS), -math.log(max(1, vocabulary)), np.float32)
    mean = sums[:CELLS] / sums[CELLS]

    def offer(batches):
        best = np.zeros((0, CELLS))
        for b in batches:
            if b.num_rows:
                best = far_points(np.concatenate([best, unit(cell_counts(b.column("data")) - mean)]), CLUSTERS)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in best], pa.binary())], names=["x"])

    seeds = sorted(sets.select("data").mapInArrow(offer, "x binary").toArrow().column("x").to_pylist())  # CLUSTERS a task
    centre = far_points(np.stack([np.frombuffer(x) for x in seeds]), CLUSTERS)

    def nearest(data):
        x = unit(cell_counts(data) - mean)
        return x, np.argmax(x @ centre.T, axis=1)

    for _ in range(KMEANS_ROUNDS):
        def add(total, data):
            x, at = nearest(data)
            part = total.reshape(len(centre), CELLS)
            for k in range(len(centre)):
                part[k] += x[at == k].sum(axis=0)

        moved = summed(sets, ["data"], centre.size, add).reshape(centre.shape)
        centre = np.where(np.any(moved, axis=1, keepdims=True), unit(moved), centre)

    def count(total, data):
        _, at = nearest(data)
        doc, ids = id_sets(data)
        total += np.bincount(ids * CLUSTERS + at[doc], minlength=len(total))

    out = summed(sets, ["data"], vocabulary * CLUSTERS, count).reshape(vocabulary, CLUSTERS)
    total = out.sum(axis=0, keepdims=True)
    return np.log((out + 0.1) / (total + 0.1 * vocabulary)).astype(np.float32)


def huffman(weight: np.ndarray, cls: np.ndarray):
    """Huffman trees over the symbols of each class: where a symbol's path begins
    (and the last ends), the paths' nodes and sides (1, -1), and every node's log
    odds of side 1."""
    n = len(weight)
    up, side, odds = np.full(2 * n, -1, np.int64), np.zeros(2 * n, np.float32), []
    members = np.split(np.argsort(cls, kind="stable"), np.cumsum(np.bincount(cls, minlength=CLASSES))[:-1])
    for some in members:
        heap = [(float(weight[i]), int(i)) for i in some]
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            inner = n + len(odds)
            up[i] = up[j] = inner
            side[i], side[j] = -1, 1
            odds.append(math.log(b / a))
            heapq.heappush(heap, (a + b, inner))
    leaf = at = np.arange(n)
    parts = []
    while len(at := at[(on := up[at] >= 0)]):
        leaf = leaf[on]
        parts.append((leaf, up[at] - n, side[at]))
        at = up[at]
    leaf, node, sides = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
    order = np.argsort(leaf, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(leaf, minlength=n))])
    return first, node[order].astype(np.int32), sides[order].astype(np.float32), np.array(odds, np.float32)


class Language:
    """What the tasks need to score: tables of the vocabulary's size.  Symbols:
    the ids, ``none`` (a word without ids), ``end`` (also the start), ``pad``."""

    def __init__(self, id_cluster: np.ndarray):
        self.id_cluster = id_cluster
        self.none = len(id_cluster)
        self.end, self.pad = self.none + 1, self.none + 2
        self.own = np.zeros((self.none + 3, DIM), np.float32)
        self.count(np.zeros(self.none + 1), 0)

    def count(self, counts: np.ndarray, n_docs: int) -> None:
        """Classes, trees and first weights from the counts of ids (and ``none``)."""
        weight = counts + 0.5
        cluster = np.append(np.argmax(self.id_cluster, axis=1), 0)
        order = np.lexsort((-weight, cluster))
        total = np.cumsum(weight[order])
        cut_at = np.searchsorted(total, total[-1] * np.arange(1, CLASSES) / CLASSES)
        k = np.arange(1, CLASSES)       # no class without an id
        cut_at = np.minimum(np.maximum.accumulate(np.maximum(cut_at, 1) - k) + k, np.maximum(0, len(order) - CLASSES + k))
        cls = np.zeros(len(order), np.int64)
        cls[order] = np.searchsorted(cut_at, np.arange(len(order)), side="right")
        self.cls = np.concatenate([cls, [END, PAD]])
        self.mass = np.maximum(np.bincount(cls, weight, CLASSES), 1e-9)
        first, self.node, self.side, self.bias = huffman(weight, cls)
        self.first = np.concatenate([first, first[-1:], first[-1:]])    # the end and the padding: no path
        self.turn = np.zeros((len(self.bias), DIM), np.float32)
        share = np.append(self.mass, n_docs + 0.5)
        self.flat = initial((share / share.sum()).astype(np.float32))

    @classmethod
    def of(cls, parts: dict) -> Language:
        """From ``vars`` of another: a broadcast holds arrays only, as workers
        need not have the package."""
        out = cls.__new__(cls)
        out.__dict__.update(parts)
        return out

    @classmethod
    def symbols(cls, vocabulary: int) -> Language:
        """The symbols alone."""
        return cls.of({"none": vocabulary, "end": vocabulary + 1, "pad": vocabulary + 2})

    def copy(self) -> Language:
        return Language.of({k: v.copy() if k in ("flat", "own", "turn", "bias") else v for k, v in vars(self).items()})

    def core(self) -> np.ndarray:
        """The attention's weights in rows, filled up with zeros."""
        return np.append(self.flat, np.zeros(-size() % (DIM + 1), np.float32)).reshape(-1, DIM + 1)

    def rows(self) -> np.ndarray:
        """All that is trained, as rows of ``DIM + 1`` numbers."""
        own = np.concatenate([self.own, np.zeros((len(self.own), 1), np.float32)], axis=1)
        return np.concatenate([self.core(), own, np.concatenate([self.turn, self.bias[:, None]], axis=1)])

    def take(self, rows: np.ndarray) -> None:
        """The reverse of :meth:`rows`."""
        a, b = len(self.core()), len(self.core()) + len(self.own)
        self.flat = rows[:a].ravel()[:size()].astype(np.float32)
        self.own = np.ascontiguousarray(rows[a:b, :DIM], np.float32)
        self.turn, self.bias = np.ascontiguousarray(rows[b:, :DIM], np.float32), rows[b:, DIM].astype(np.float32)

    def tables(self) -> dict:
        """What the JVM needs of the model."""
        kinds = {"flat": "<f4", "own": "<f4", "turn": "<f4", "bias": "<f4", "side": "<f4", "first": "<i8", "node": "<i4", "cls": "<i8"}
        return {name: np.ascontiguousarray(getattr(self, name), kind) for name, kind in kinds.items()}

    def ids_type(self) -> str:
        return "<u2" if self.pad < 1 << 16 else "<u4"

    def spell(self, enc: WordEncoder) -> _Memo:
        """word -> its symbols as bytes, kept beside the worker's encoder; call
        :func:`younger` on it between batches."""
        def make(w):
            ids = np.frombuffer(enc._word(w), "<u4")
            return (ids if len(ids) else np.array([none])).astype(kind).tobytes()

        none, kind = self.none, self.ids_type()
        return enc.__dict__.setdefault("_symbols", _Memo(make, {}))

    def younger(self, enc: WordEncoder) -> _Memo:
        known = self.spell(enc)
        if len(known) >= enc.cached:
            known.old = {}
            known = enc._symbols = _Memo(known.make, known)
        return known


def sequences_of(stats: DataFrame) -> DataFrame:
    return stats.where("kind = 3").select(F.col("sequence").alias("data"))


def class_sequences(docs: DataFrame, spec: str, lang: Language) -> DataFrame:
    """data: the subword ids of the words of a training document and the end, as
    :func:`statistics` writes them; one row for every training document."""
    return sequences_of(statistics(docs, spec, lang.none))


def learn(docs: DataFrame, spec: str, vocabulary: int) -> tuple[Language, DataFrame, dict]:
    """The model, the word counts (hash, c) and the totals N, V, documents."""
    spark = docs.sparkSession
    stats = cut(statistics(docs, spec, vocabulary), "lm-statistics")
    words = cut(word_counts(stats), "lm-words")
    n_docs = stats.where("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tokens, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    totals = {"N": tokens + n_docs, "V": distinct + (n_docs > 0), "docs": n_docs}
    lang = Language(cluster_ids(stats.where("kind = 3 and ids is not null").select(F.col("ids").alias("data")), vocabulary))
    sequences, kind = sequences_of(stats), lang.ids_type()

    def count(total, data):
        symbols = np.frombuffer(b"".join(data.to_pylist()), kind)
        total += np.bincount(symbols, minlength=vocabulary + 2)[:-1]       # without the end

    lang.count(summed(sequences, ["data"], vocabulary + 1, count), n_docs)
    columns = [f"c{i}" for i in range(DIM + 1)]
    schema = "i long, n double, " + ", ".join(f"{c} double" for c in columns)
    for r in range(ROUNDS):
        rate = 0.02 / (r + 1)
        start = None if jvm.loader(spark) else spark.sparkContext.broadcast(vars(lang))

        def run(batches, r=r, rate=rate, start=start):
            lang = Language.of(start.value)
            trainer, some, n = Trainer(lang, rate, r), [], 0
            for b in batches:
                for d in b.column("data"):
                    some.append(np.frombuffer(d.as_py(), lang.ids_type()).astype(np.int64))
                    n += len(some[-1])
                    if n >= TOGETHER:
                        trainer.train(*windows(some, lang.end, lang.pad)[:2])
                        some, n = [], 0
            if some:
                trainer.train(*windows(some, lang.end, lang.pad)[:2])
            at, n, change = trainer.changes()
            for i in range(0, len(at), 8192):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[i:i + 8192]), pa.array(n[i:i + 8192].astype(float)),
                     *[pa.array(np.ascontiguousarray(c[i:i + 8192])) for c in (change * n[:, None]).T]], names=["i", "n", *columns])

        if start is None:
            shared = jvm.share(spark, {**lang.tables(), "rates": np.array([rate, table_rate(rate)], "<f4"),
                                       "sizes": np.array([BATCH, PASSES, TOGETHER], "<i8"), "order": order_state(r)})
            changes = jvm.run(sequences, "train", shared, schema)
        else:
            changes = sequences.mapInArrow(run, schema)
        mean = changes.groupBy("i").agg(
            *[(F.sum(c) / F.sum("n")).alias(c) for c in columns]).toArrow()  # a row per id, node and DIM + 1 weights
        rows = lang.rows()
        rows[mean.column("i").to_numpy()] += np.stack([mean.column(c).to_numpy() for c in columns], axis=1).astype(np.float32)
        lang.take(rows)
    return lang, words.select("hash", "c"), totals


# ---- scoring -----------------------------------------------------------------------------

def class_scores(lang: Language, sequences: list[np.ndarray], batch: int = 256) -> np.ndarray:
    """log10 probability of each sequence of symbols; all end with the end."""
    if not sequences:
        return np.zeros(0)
    p = split(lang.flat)
    x, y, counts = windows(sequences, lang.end, lang.pad)
    entry = inputs(p, lang.cls, lang.own)      # of all symbols
    per = np.zeros(len(x))
    for i in range(0, len(x), batch):
        symbols = x[i:i + batch]
        h, _ = attend(p, entry.take(symbols, axis=0), symbols == lang.pad)
        logits = class_logits(p, h)
        t = y[i:i + batch].ravel()
        use = np.flatnonzero(t >= 0)
        own = np.zeros(len(t))
        own[use] = logits[lang.cls.take(t[use]), use]
        np.exp(logits, out=logits)
        own[use] -= np.log(logits.sum(axis=0))[use]
        order, path = levels(lang, t[use])
        use = use[order]
        mine, lost = h.take(use, axis=0), np.zeros(len(use))
        for node, side in path:
            z = np.einsum("ij,ij->i", lang.turn.take(node, axis=0), mine[:len(node)])
            z += lang.bias.take(node)
            z *= -side
            lost[:len(node)] += np.maximum(z, 0) + np.log(1 + np.exp(-np.abs(z)))
        own[use] -= lost
        per[i:i + batch] = own.reshape(-1, STEP).sum(axis=1)
    return np.add.reduceat(per, np.concatenate([[0], np.cumsum(counts)[:-1]])) / math.log(10)


def scored(docs: DataFrame, spec: str, vocabulary: int) -> DataFrame:
    spark = docs.sparkSession
    lang, words, totals = learn(docs, spec, vocabulary)
    top = words.orderBy(F.desc("c"), "hash").limit(HEAD).toArrow()  # HEAD rows
    h = top.column("hash").to_numpy()
    value = top.column("c").to_numpy()
    order = np.argsort(h)
    if jvm.loader(spark):
        head = {"head": h[order].astype("<i8"), "value": value[order].astype("<i8")}
        columns = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, rare "
        read = complete(scanned(docs, spec, vocabulary, head, columns + "binary"), spec, vocabulary)
        out = jvm.run(read, "score", jvm.share(spark, lang.tables()), columns + "array<long>, cls double")
        return with_rare(out, words, totals)
    shared = spark.sparkContext.broadcast((vars(lang), h[order], value[order], spec))

    def run(batches):
        parts, h, value, spec = shared.value
        lang, enc, known = Language.of(parts), WordEncoder.shared(spec), {}

        def look_up(texts: list[list[bytes]]) -> None:
            """Counts of all words of the texts; -1: not in the head table."""
            if len(known) > COUNTED // 2:
                known.clear()
            fresh = list({w for ws in texts for w in ws}.difference(known))
            if not fresh:
                return
            hashes = np.fromiter(map(word_hash, fresh), np.int64, len(fresh))
            at = np.minimum(np.searchsorted(h, hashes), max(0, len(h) - 1))
            head = h[at] == hashes if len(h) else np.zeros(len(fresh), bool)
            found = np.full(len(fresh), -1, np.int64)
            found[head] = value[at[head]]
            known.update(zip(fresh, found.tolist()))

        def score(doc_ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            look_up(texts)
            spelled, kind, sequences, rows = lang.younger(enc), lang.ids_type(), [], []
            for d, ws in zip(doc_ids, texts):
                n = np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))
                head = n >= 0
                rare = [word_hash(ws[i]) for i in np.flatnonzero(~head).tolist()]
                ids = np.frombuffer(b"".join(map(spelled.__getitem__, ws)), kind)
                sequences.append(np.append(ids.astype(np.int64), lang.end))
                rows.append((is_held(d), len(ws) + 1, int(head.sum()), float(np.log10(n[head] + 0.5).sum()), rare))
            s = class_scores(lang, sequences)
            cols = list(zip(*rows)) or [()] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(cols[0], pa.bool_()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.list_(pa.int64())), pa.array(s, pa.float64())],
                names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "rare", "cls"])

        for b in batches:
            ids, texts, n = [], [], 0
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids.append(d)
                texts.append(lower_words(t.as_py()))
                n += len(texts[-1])
                if n >= TOGETHER:
                    yield score(ids, texts)
                    ids, texts, n = [], [], 0
            yield score(ids, texts)

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, rare array<long>, cls double")
    return with_rare(out, words, totals)


def with_rare(out: DataFrame, words: DataFrame, totals: dict) -> DataFrame:
    """The scored documents with the words that the tasks did not know."""
    out = cut(out.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    rare = out.select("row", F.explode("rare").alias("r")).join(words, F.col("r") == F.col("hash"), "left")
    n = F.coalesce("c", F.lit(0))
    rest = cut(rare.groupBy("row").agg(F.sum(F.when(n > 0, 1).otherwise(0)).alias("k"),
                                       F.sum(F.log10(n + 0.5)).alias("s")), "lm-rare")
    base = math.log10(totals["N"] + 0.5 * (totals["V"] + 1))
    logs = F.col("logs") + F.coalesce("s", F.lit(0.0))  # sum of log10(c + 0.5) over the words
    return out.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("k", F.lit(0)) + F.lit(int(totals["docs"] > 0))).alias("n_known"),
        F.lit(totals["N"]).cast("long").alias("train_tokens"),
        (logs + F.lit(math.log10(totals["docs"] + 0.5)) - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        F.col("cls").alias("score"))


def op8_attention_lm(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, spec, Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True))
