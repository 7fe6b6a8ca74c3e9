"""Runs (maximal periodic stretches) of the words of each text.

A run is a stretch of words with smallest period q, at least ``MIN_LENGTH`` and
2 q words long, that neither neighbour extends.  Search by block convolution:

* at scale B = 4, 8, 16, ... the words are cut into blocks of B; a run whose
  period q lies in [2B, 4B) holds a whole block whose copy q words further on
  lies in the run too (at the base scale, periods 1 to 7, blocks start at every
  second word, so that stretches of ``MIN_LENGTH`` words hold one);
* the squared differences of a block and every window that starts B-aligned
  within reach come from one number-theoretic transform per block: the spectrum
  of two neighbouring blocks follows from theirs by a change of sign.  Sums are
  exact modulo ``PRIME``; matrices of at most 512 rows of balanced residues
  keep every dot product below 2**53, so float products are whole numbers;
* a zero is a seed.  Seeds are extended word by word in both directions, which
  also throws out the rare zero of a non-zero sum modulo the prime.  Seeds
  inside a found run whose period divides theirs give nothing new and are
  passed over; of stretches with the same ends the smallest period stays.

A block with a word that does not occur again within reach has no copy there
and is not transformed.  Texts are packed into batches with a separator that
occurs once, so no stretch crosses it; a text is never split.

Defined cases: null, empty and blank texts have no words and no run; repeated
rows and ids, also null ids, are each returned; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import load, words

MIN_LENGTH = 12
BASE = 4                    # words of the smallest block
BATCH_WORDS = 200_000       # words convolved together; one text is never split
SLAB = 1 << 17              # numbers of a transform slab
PRIME = 7 * (1 << 20) + 1   # NTT prime: roots of unity of every order up to 2**20
ROOT = 3                    # generates its multiplicative group
MAX_BLOCK = 1 << 17         # 2 * MAX_BLOCK = 512 * 512; longer periods compare more windows per block

RUN_TYPE = "array<struct<start:long,length:long,period:long>>"


def balanced(x: np.ndarray) -> np.ndarray:
    """Residues modulo ``PRIME`` in [-PRIME/2, PRIME/2], as whole floats."""
    return x - np.rint(x * (1.0 / PRIME)) * PRIME


class Transform:
    """Number-theoretic transform of ``size`` = rows * cols numbers as two
    matrix products with twiddle factors between them.  Position (k1, k2) of a
    spectrum belongs to frequency k1 + rows * k2."""

    def __init__(self, size: int):
        bits = size.bit_length() - 1
        self.size, self.rows = size, 1 << (bits - bits // 2 if bits > 7 else bits)
        self.cols = size // self.rows
        w = pow(ROOT, (PRIME - 1) // size, PRIME)
        powers = np.ones(size, dtype=np.int64)
        for k in range(1, size):
            powers[k] = powers[k - 1] * w % PRIME
        table = balanced(powers.astype(np.float64))
        r, c = np.arange(self.rows), np.arange(self.cols)
        outer = np.multiply.outer
        self.left = table[outer(r, r) * self.cols % size]
        self.twiddle = table[outer(r, c)]
        self.right = table[outer(c, c) * self.rows % size]
        self.left_back = table[-outer(r, r) * self.cols % size]
        self.twiddle_back = table[-outer(r, c) % size]
        self.right_back = table[-outer(c, c) * self.rows % size]
        self.scale = float(balanced(np.float64(pow(size, PRIME - 2, PRIME))))
        k = r[:, None] + self.rows * c[None, :]
        back = -k % size
        self.mirror = ((back % self.rows) * self.cols + back // self.rows).ravel()
        self.sign = np.where(r % 2, -1.0, 1.0)[:, None]    # spectrum factor of a shift by half the size

    def forward(self, x: np.ndarray) -> np.ndarray:
        if self.cols == 1:
            return balanced(x @ self.left)[:, :, None]
        y = balanced(balanced(self.left @ x.reshape(-1, self.rows, self.cols)) * self.twiddle)
        return balanced(y.reshape(-1, self.cols) @ self.right).reshape(y.shape)

    def backward(self, y: np.ndarray) -> np.ndarray:
        if self.cols == 1:
            return balanced(balanced(y[:, :, 0] @ self.left_back) * self.scale)
        y = balanced(y.reshape(-1, self.cols) @ self.right_back).reshape(y.shape)
        y = balanced(self.left_back @ balanced(y * self.twiddle_back))
        return balanced(y * self.scale).reshape(len(y), self.size)

    def mirrored(self, y: np.ndarray) -> np.ndarray:
        """Spectrum at the negative frequencies: products with it correlate."""
        return y.reshape(len(y), self.size)[:, self.mirror].reshape(y.shape)


def _zeros(corr: np.ndarray, squares: np.ndarray) -> np.ndarray:
    return balanced(squares - 2.0 * corr) == 0


class Batch:
    """Words of several texts as numbers, with a separator after each text."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray):
        self.w, self.starts = ids, starts          # starts[k] to starts[k+1]-1: text k and its separator
        n = len(ids)
        self.text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        self.end = starts[1:][self.text] - 1       # position after the text's last word
        order = np.argsort(ids, kind="stable")
        again = np.full(n, n * 4, dtype=np.int64)  # distance to the word's next occurrence
        same = ids[order[1:]] == ids[order[:-1]]
        again[order[:-1][same]] = (order[1:] - order[:-1])[same]
        self.again = again
        self.values = balanced(ids.astype(np.float64))
        self.squares = np.concatenate([[0.0], np.cumsum(balanced(self.values * self.values))])
        self.runs: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period
        self.reach: dict[int, int] = {}             # period -> end of the last stretch extended

    def norm(self, at: np.ndarray, size: int) -> np.ndarray:
        return self.squares[at + size] - self.squares[at]

    def extend(self, b: int, d: int, size: int) -> None:
        """The maximal stretch around block b that repeats d words further on."""
        w = self.w
        if b < self.reach.get(d, 0) - d or not np.array_equal(w[b:b + size], w[b + d:b + d + size]):
            return
        lo, step = b, 16
        while lo > 0:
            s = max(0, lo - step)
            differ = np.flatnonzero(w[s:lo] != w[s + d:lo + d])
            if len(differ):
                lo = s + int(differ[-1]) + 1
                break
            lo, step = s, step * 2
        hi, step, n = b + d + size, 16, len(w)
        while hi < n:
            e = min(n, hi + step)
            differ = np.flatnonzero(w[hi:e] != w[hi - d:e - d])
            if len(differ):
                hi += int(differ[0])
                break
            hi, step = e, step * 2
        self.reach[d] = hi
        if hi - lo >= max(MIN_LENGTH, 2 * d) and self.runs.get((lo, hi), d) >= d:
            self.runs[lo, hi] = d

    def take(self, b: np.ndarray, d: np.ndarray, size: int) -> None:
        """Extends the seeds (b, d) that no found run explains."""
        if not len(b):
            return
        period = np.zeros(len(self.w), dtype=np.int64)   # smallest found period over a position, and its run's end
        end = np.zeros(len(self.w), dtype=np.int64)
        for (lo, hi), q in sorted(self.runs.items(), key=lambda r: -r[1]):
            if hi - lo >= 2 * size:
                period[lo:hi], end[lo:hi] = q, hi
        q = period[b]
        known = (q > 0) & (end[b] >= b + d + size) & (d % np.maximum(q, 1) == 0)
        b, d = b[~known], d[~known]
        order = np.lexsort((b, d))
        self.reach = {}
        for x, y in zip(b[order].tolist(), d[order].tolist()):
            self.extend(x, y, size)

    def base(self) -> None:
        """Periods 1 to 7: blocks at every second word against the words 1 to 7 further on."""
        t, far = transform(4 * BASE), 2 * BASE - 1
        b = np.arange(0, len(self.w) - 2 * BASE + 1, 2)
        b = b[(b + 2 * BASE - 1 <= self.end[b]) & (self._live(b, BASE, far))]
        padded = np.concatenate([self.values, np.zeros(4 * BASE)])
        found = []
        for k in range(0, len(b), SLAB // t.size):
            at = b[k:k + SLAB // t.size]
            block, window = np.zeros((len(at), t.size)), np.zeros((len(at), t.size))
            block[:, :BASE] = padded[at[:, None] + np.arange(BASE)]
            window[:, :far + BASE - 1] = padded[at[:, None] + 1 + np.arange(far + BASE - 1)]
            corr = t.backward(balanced(t.mirrored(t.forward(block)) * t.forward(window)))[:, :far]
            to = at[:, None] + 1 + np.arange(far)
            inside = to + BASE <= self.end[at][:, None]
            to = np.where(inside, to, 0)
            zero = _zeros(corr, self.norm(at, BASE)[:, None] + self.norm(to, BASE)) & inside
            x, y = np.nonzero(zero)
            found.append((at[x], y + 1))
        self._take_all(found, BASE)

    def _live(self, b: np.ndarray, size: int, far: int) -> np.ndarray:
        """Blocks all of whose words occur again within ``far`` words."""
        lost = np.concatenate([[0], np.cumsum(self.again > far)])
        return lost[b + size] == lost[b]

    def _take_all(self, found: list, size: int) -> None:
        if found:
            self.take(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]), size)

    def scale(self, size: int, longest: int) -> None:
        """Periods from 2 to 4 blocks (to the longest possible one at ``MAX_BLOCK``)."""
        n, t = len(self.w), transform(2 * size)
        last = longest // 2 if size == MAX_BLOCK else 4 * size - 1
        blocks = n // size
        b = np.arange(blocks) * size
        use = b[(b + 3 * size <= self.end[b]) & self._live(b, size, last)] // size
        if not len(use):
            return
        found = []
        padded = np.concatenate([self.values, np.zeros(4 * size)])
        for k in range(0, len(use), max(1, SLAB // t.size)):
            mine = use[k:k + max(1, SLAB // t.size)]
            for near in range(2, last // size + 1):
                part = mine[(mine + near) * size + size <= self.end[mine * size]]
                if not len(part):
                    continue
                need, where = np.unique(np.concatenate([part, part + near, part + near + 1]), return_inverse=True)
                half = np.zeros((len(need), 2 * size))
                half[:, :size] = padded[np.minimum(need[:, None] * size + np.arange(size), len(padded) - 1)]
                spectra = t.forward(half)
                own, first, second = np.split(where, 3)
                window = balanced(spectra[first] + t.sign * spectra[second])
                corr = t.backward(balanced(t.mirrored(spectra[own]) * window))[:, :size]
                at = part * size
                to = (part + near)[:, None] * size + np.arange(size)
                inside = to + size <= self.end[at][:, None]
                to = np.where(inside, to, 0)
                zero = _zeros(corr, self.norm(at, size)[:, None] + self.norm(to, size)) & inside
                x, y = np.nonzero(zero)
                found.append((at[x], near * size + y))
        self._take_all(found, size)

    def search(self) -> list[list[tuple[int, int, int]]]:
        """(start, length, period) of every run, by text, in order of start and period."""
        out = [[] for _ in range(len(self.starts) - 1)]
        if len(self.w) >= 2 * BASE:
            longest = int(np.diff(self.starts).max()) - 1
            self.base()
            size = BASE
            while 4 * size <= longest and size <= MAX_BLOCK:
                self.scale(size, longest)
                size *= 2
        for (lo, hi), q in self.runs.items():
            if hi - lo >= max(MIN_LENGTH, 2 * q):
                k = int(self.text[lo])
                out[k].append((lo - int(self.starts[k]), hi - lo, q))
        return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


_TRANSFORMS: dict[int, Transform] = {}


def transform(size: int) -> Transform:
    if size not in _TRANSFORMS:
        _TRANSFORMS[size] = Transform(size)
    return _TRANSFORMS[size]


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each list of words."""
    number: dict[bytes, int] = {}
    ids, starts = [], [0]
    for ws in texts:
        ids.extend([number.setdefault(w, len(number)) for w in ws])
        ids.append(-1)
        starts.append(len(ids))
    out = np.array(ids, dtype=np.int64)
    marks = np.array(starts[1:], dtype=np.int64) - 1
    out[marks] = len(number) + np.arange(len(marks))
    return Batch(out, np.array(starts, dtype=np.int64)).search()


def collapse(ws: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those any run holds after its
    first period."""
    if not runs:
        return b" ".join(ws)
    depth = np.zeros(len(ws) + 1, dtype=np.int64)
    for s, n, q in runs:
        depth[s + q] += 1
        depth[s + n] -= 1
    keep = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return b" ".join([ws[i] for i in keep.tolist()])


def periodic_runs(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row: doc_id, runs (array of start, length, period, by start, then
    period), collapsed (the text without its repetitions)."""

    def emit(ids, texts):
        found = runs_of(texts)
        flat = [r for rs in found for r in rs]
        ends = np.concatenate([[0], np.cumsum([len(rs) for rs in found])]).astype(np.int32)
        parts = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
        runs = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
        joined = [collapse(ws, rs) for ws, rs in zip(texts, found)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), runs, pa.array(joined, pa.binary()).cast(pa.string())],
                                          names=["doc_id", "runs", "collapsed"])

    def run(batches):
        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary())):
                ws = (t.as_py() or b"").split()    # the six ASCII white-space bytes
                ids.append(i)
                texts.append(ws)
                size += len(ws) + 1
                if size >= BATCH_WORDS:
                    yield emit(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield emit(ids, texts)

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, f"doc_id long, runs {RUN_TYPE}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text, where one document in ten (h % 10 = 0, h the crc32 of its
    id) repeats p of its words from word a on; a and p follow from h."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    n, a, p = F.col("n"), F.col("a"), F.col("p")
    ws = F.when(F.pmod(h, F.lit(10)) == 0, words(F.col("text")))
    out = (docs.select("doc_id", "text", g.alias("g"), ws.alias("ws"))
           .withColumn("n", F.size("ws").cast("long"))
           .withColumn("a", F.when(n > 0, F.pmod("g", n)))
           .withColumn("p", 1 + F.floor((n - a) / (3 + F.pmod(F.col("g"), F.lit(8)))).cast("long")))
    moved = F.transform("ws", lambda w, i: F.when(i < a, w).otherwise(F.get("ws", (a + F.pmod(i - a, p)).cast("int"))))
    return out.select("doc_id", F.when(n > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted(load(spark, sf_dir, "documents"))
    runs = F.col("runs")
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                    r["period"].cast("string")))
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"),
                                                            r["period"].alias("period"))))
    out = periodic_runs(docs).select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                                     F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").alias("lines"),
                                     "collapsed")
    length = -F.col("best.shorter")
    return out.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
