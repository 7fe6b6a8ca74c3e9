"""N-gram Jaccard join by T-occurrence search.

Documents are sets of distinct 3-word shingles (64-bit hashes).  Two link when
``intersection >= 0.9 * union``; the result is the connected components.

1. *List lengths.*  Every token's document frequency is counted over all
   documents (sorted, pre-counted blobs per hash range instead of a row per
   token).  Two tables of fixed size order the tokens globally: a bitmap of the
   tokens in two documents or more, and the ``FREQUENT`` most frequent tokens.
   Tokens of one document come first, frequent ones last.  Any global order
   gives exact results; this one keeps long inverted lists out of the prefixes.
2. *Prefixes.*  Equal sets are collapsed to their smallest document.  A pair
   that reaches the overlap T must share tokens among the first
   ``n - ceil(0.9 n) + 1`` of both; those in two documents or more are posted.
3. *Stars.*  Every list links its members to its smallest document; verified
   star links are merged first, with work linear in the postings.
4. *DivideSkip.*  Lists whose members are still in several components are
   gathered by their smallest document and searched: within a group every
   document outside the largest component is a query against the inverted
   prefix lists of the group; the longest lists are set aside, the short ones
   are heap-merged, candidates are completed by binary search in the long ones,
   and those reaching the required overlap are retained.  Large groups are cut
   into blocks and each pair of blocks is one group, so no task holds an
   unbounded list and none is capped.
5. Retained pairs are verified on the whole sets.

Defined cases: null, blank and empty texts have the empty set and link with
nothing; one or two words form a single shingle; repeated rows of a document
id give one row each with the same component; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import cut, load, shuffle_parts

WORDS = 3
PERCENT = 90
FREQUENT = 1 << 20     # tokens in the table of frequent ones (12 MB), whatever the corpus
PROBE_COST = 0.01      # of a binary search step, against a merge step
SHARED_BITS = 1 << 27  # of the bitmap of tokens in two documents or more (16 MB), whatever the corpus
MIN_FREQUENT = 4       # a token in fewer documents is never frequent
FLUSH = 1 << 21        # tokens a task gathers before it writes its counted blobs
GROUP = 256            # documents of a block of a long list
CACHED_WORDS = 1 << 19

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class _WordHash(dict):
    def __missing__(self, w):
        import xxhash
        out = self[w] = xxhash.xxh64_intdigest(w)
        return out


class Shingler:
    """Distinct shingle hashes of a text, sorted."""

    def __init__(self, k: int = WORDS):
        self.k, self.known = k, _WordHash()

    def __call__(self, text: str | None) -> np.ndarray:
        ws = (text or "").encode("utf-8").lower().split()  # ASCII lower case, ASCII white space
        if not ws:
            return np.zeros(0, np.uint64)
        if len(self.known) > CACHED_WORDS:
            self.known = _WordHash()
        h = np.fromiter(map(self.known.__getitem__, ws), np.uint64, len(ws))
        k = min(self.k, len(h))
        with np.errstate(over="ignore"):
            out = np.full(len(h) - k + 1, np.uint64(k))
            for i in range(k):
                out = (out ^ h[i:len(h) - k + 1 + i]) * _M1
                out ^= out >> np.uint64(29)
            out = (out * _M2) ^ ((out * _M3) >> np.uint64(32))
        return np.unique(out)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Tokens of a set of n that must hold a shared one if the sets link:
    links need an intersection of at least percent % of either size."""
    return n - -(-percent * n // 100) + 1


def prefix_overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """Shared tokens that the prefixes of two linked sets hold at least.  With
    an overlap of T the prefix of a holds at least prefix - (a - T) of the first
    common tokens, that of b likewise, and the smaller number is in both."""
    t = needed_overlap(a, b, percent)
    return t - max(-(-percent * a // 100), -(-percent * b // 100)) + 1


def needed_overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """Smallest intersection with 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


# ---- 1. document frequencies -------------------------------------------------------------

def token_counts(docs: DataFrame, buckets: int, k: int = WORDS) -> DataFrame:
    """(bucket, tokens, counts): sorted tokens of a hash range with the number
    of documents seen, as binary columns, a few rows per task."""
    step = np.uint64((1 << 64) // buckets + 1)

    def run(batches):
        shingle, held, size = Shingler(k), [], 0

        def flush():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            edges = np.searchsorted(tokens, np.arange(1, buckets, dtype=np.uint64) * step)
            for i, (t, c) in enumerate(zip(np.split(tokens, edges), np.split(counts, edges))):
                if len(t):
                    low = (t - np.uint64(i) * step) >> np.uint64(_shift(buckets))
                    yield i, low.astype("<u4").tobytes(), np.minimum(c, 65535).astype("<u2").tobytes()

        def batch(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                names=["bucket", "tokens", "counts"])

        for b in batches:
            for t in b.column("text"):
                s = shingle(t.as_py())
                held.append(s)
                size += len(s)
                if size >= FLUSH:
                    yield batch(list(flush()))
                    held, size = [], 0
        if size:
            yield batch(list(flush()))

    return docs.select("text").mapInArrow(run, "bucket int, tokens binary, counts binary")


def _shift(buckets: int) -> int:
    """Low bits dropped so that a place within a bucket fits 32 bits."""
    return max(0, ((1 << 64) // buckets + 1).bit_length() - 32)


class TokenOrder:
    """Global order of tokens from tables of fixed size.  Tokens are looked up
    by bucketed short hashes; a clash only changes the order, or keeps a token
    that could have been left out, never a result."""

    def __init__(self, buckets: int):
        self.buckets, self.bits = buckets, SHARED_BITS // buckets // 8 * 8
        self.token, self.n = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.shared = np.zeros((buckets, self.bits // 8), np.uint8)

    @classmethod
    def of(cls, parts: dict) -> TokenOrder:
        """From ``vars`` of another: a broadcast holds arrays only, as workers
        need not have the package."""
        out = cls.__new__(cls)
        out.__dict__.update(parts)
        return out

    def rank(self, tokens: np.ndarray) -> np.ndarray:
        """0: in one document; 1: in several; the frequency for frequent tokens."""
        short = short_hash(tokens, self.buckets)
        at = ((short & 0xFFFFFFFF) * self.bits) >> 32
        rank = ((self.shared[short >> 32, at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64)
        if len(self.token):
            i = np.minimum(np.searchsorted(self.token, short), len(self.token) - 1)
            rank = np.where(self.token[i] == short, self.n[i], rank)
        return rank


def token_order(docs: DataFrame, k: int = WORDS, most: int = FREQUENT) -> TokenOrder:
    """Counts the document frequencies of all tokens of all documents."""
    spark = docs.sparkSession
    buckets = min(shuffle_parts(spark), SHARED_BITS // 64)
    order = TokenOrder(buckets)
    bits = order.bits

    def merge(key, table):
        t = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table.column("tokens")])
        c = np.concatenate([np.frombuffer(x.as_buffer(), "<u2") for x in table.column("counts")]).astype(np.int64)
        sort = np.argsort(t, kind="stable")
        t, c = t[sort], c[sort]
        first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        total, t = np.add.reduceat(c, first), t[first].astype(np.int64)
        seen = np.zeros(bits, np.uint8)
        seen[(t[total > 1] * bits) >> 32] = 1
        keep = total >= MIN_FREQUENT
        low, total = t[keep], total[keep]
        short = (np.int64(key[0].as_py()) << np.int64(32)) | low
        return pa.table({"token": pa.array(np.append(short, key[0].as_py()), pa.int64()),
                         "n": pa.array(np.append(total, 0), pa.int64()),
                         "bits": pa.array([None] * len(low) + [np.packbits(seen, bitorder="little").tobytes()], pa.binary())})

    counts = token_counts(docs, buckets, k).groupBy("bucket").applyInArrow(merge, "token long, n long, bits binary")
    counts = cut(counts, "token-counts")
    for r in counts.where("n = 0").select("token", "bits").toLocalIterator():  # SHARED_BITS in all
        order.shared[r[0]] = np.frombuffer(r[1], np.uint8)
    steps = counts.where("n > 0").groupBy(F.floor(F.log2("n") * 4).alias("step")).count().collect()
    total, least = 0, None
    for step, n in sorted(steps, reverse=True):
        if total + n > most:
            break
        total, least = total + n, step
    if least is not None:
        table = counts.where((F.col("n") > 0) & (F.floor(F.log2("n") * 4) >= least)).select("token", "n").toArrow()
        token, n = table.column("token").to_numpy(), table.column("n").to_numpy()
        sort = np.argsort(token)
        order.token, order.n = token[sort], np.minimum(n[sort], 2 ** 31 - 1).astype(np.int32)
    return order


def short_hash(tokens: np.ndarray, buckets: int) -> np.ndarray:
    step = np.uint64((1 << 64) // buckets + 1)
    bucket = tokens // step
    low = (tokens - bucket * step) >> np.uint64(_shift(buckets))
    return (bucket.astype(np.int64) << np.int64(32)) | low.astype(np.int64)


# ---- 2. prefixes -------------------------------------------------------------------------

def prefixes(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (128-bit digest of the set), prefix
    (its tokens that other documents may hold, sorted)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(token_order(docs, k)))

    def run(batches):
        import xxhash
        shingle, order = Shingler(k), TokenOrder.of(shared.value)
        for b in batches:
            size, a, z, prefix = [], [], [], []
            for t in b.column("text"):
                s = shingle(t.as_py())
                size.append(len(s))
                d = xxhash.xxh128_digest(s.tobytes())
                a.append(int.from_bytes(d[:8], "little", signed=True))
                z.append(int.from_bytes(d[8:], "little", signed=True))
                if len(s):
                    rank = order.rank(s)
                    first = np.lexsort((s, rank))[:prefix_size(len(s), percent)]
                    s = np.sort(s[first[rank[first] > 0]])
                prefix.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(a, pa.int64()), pa.array(z, pa.int64()),
                 pa.array(prefix, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_a", "set_b", "prefix"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, prefix array<long>")


# ---- 4. DivideSkip -----------------------------------------------------------------------

def divide_skip(lists: list[np.ndarray], least: int, long_lists: int) -> dict:
    """Ids that occur in at least ``least`` of the inverted lists of a query's
    tokens, with their counts.  The ``long_lists`` longest lists are set aside.
    The others are merged by a heap that skips: an id at the top that too few of
    them hold can be no answer, so as many lists are popped as an answer needs
    less one, and all of them jump, by binary search, to the id then at the top.
    An id that enough short lists hold is looked up in the long ones by binary
    search."""
    lists = sorted(lists, key=len, reverse=True)
    long_lists = max(0, min(long_lists, least - 1, len(lists)))
    long_, short = lists[:long_lists], [x.tolist() for x in lists[long_lists:]]
    enough = max(1, least - long_lists)     # short lists that hold every answer
    found = {}
    heap = [(x[0], i, 0) for i, x in enumerate(short) if x]
    heapq.heapify(heap)
    while len(heap) >= enough:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= enough:
            count = len(popped)
            need = least - count
            for j, x in enumerate(long_):
                if need > len(long_) - j and need > 0:
                    break  # too few lists left
                at = int(np.searchsorted(x, top))
                if at < len(x) and x[at] == top:
                    count += 1
                    need -= 1
            if count >= least:
                found[int(top)] = count
            ahead = top + 1
        else:
            while len(popped) < enough - 1 and heap:
                popped.append(heapq.heappop(heap))
            if not heap:
                break  # fewer lists than an answer needs
            ahead = heap[0][0]
        for _, i, at in popped:
            at = bisect.bisect_left(short[i], ahead, at)
            if at < len(short[i]):
                heapq.heappush(heap, (short[i][at], i, at))
    return found


def inverted_lists(sets: list[np.ndarray]) -> tuple[dict, list[np.ndarray]]:
    """Lists (token -> ascending set numbers) of the tokens in two sets or
    more, and each set's tokens that have a list."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.lexsort((owner, tokens))
    t, o = tokens[order], owner[order]
    same = t[1:] == t[:-1]
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    t, o = t[shared], o[shared]
    if not len(t):
        return {}, [t] * len(sets)
    first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    back = np.argsort(o, kind="stable")
    own = np.split(t[back], np.cumsum(np.bincount(o, minlength=len(sets)))[:-1])
    return (t, o, first, t[first], np.append(first, len(t))), own


def set_aside(least: int, longest: int) -> int:
    """How many of the longest lists to probe instead of merge: nearly as many as
    an answer needs less one, fewer the longer they are."""
    return min(least - 1, int(least / (PROBE_COST * math.log2(longest + 1) + 1)))


def candidates_within(prefix: list[np.ndarray], sizes: list[int], labels: list, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs (i, j), i < j, of differently labelled sets whose prefixes share
    as many tokens as a link needs, from one T-occurrence search per set outside
    the most frequent label."""
    main = Counter(labels).most_common(1)[0][0]
    index, own = inverted_lists(prefix)
    out = []
    for i, n in enumerate(sizes):
        if labels[i] == main or not len(own[i]):
            continue
        lo, hi = -(-percent * n // 100), n * 100 // percent  # sizes that can link
        fit = sorted({m for m in sizes if lo <= m <= hi})
        least = min((prefix_overlap(n, m, percent) for m in fit), default=1)
        if len(own[i]) < least:
            continue
        _, ids, _, names, edges = index
        lists = [ids[edges[x]:edges[x + 1]] for x in np.searchsorted(names, own[i]).tolist()]
        for j, count in divide_skip(lists, least, set_aside(least, max(map(len, lists)))).items():
            if labels[i] != labels[j] and (j > i or labels[j] == main) and lo <= sizes[j] <= hi \
                    and count >= prefix_overlap(n, sizes[j], percent):
                out.append((min(i, j), max(i, j)))
    return out


def pairwise(pairs: DataFrame, sets: DataFrame, keep) -> DataFrame:
    """Pairs (a, b) for which ``keep(set a, size a, set b, size b)`` holds.
    ``sets``: id, n, tokens (sorted)."""
    x = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    y = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(x, "a").join(y, "b")

    def run(batches):
        for t in batches:
            mask = [keep(p.values.to_numpy(), n, q.values.to_numpy(), m) for p, n, q, m in zip(
                t.column("ta"), t.column("na").to_pylist(), t.column("tb"), t.column("nb").to_pylist())]
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b")], names=["a", "b"]).filter(pa.array(mask, pa.bool_()))

    return both.select("a", "na", "ta", "b", "nb", "tb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, prefix: DataFrame | None, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose whole sets link.  With ``prefix``, pairs whose prefixes share
    too little are left out before whole sets are built and moved."""

    def enough(p, n, q, m):
        return len(np.intersect1d(p, q, assume_unique=True)) >= prefix_overlap(n, m, percent)

    def link(p, n, q, m):
        i = len(np.intersect1d(p, q, assume_unique=True))
        return 100 * i >= percent * (len(p) + len(q) - i)

    if prefix is not None:
        pairs = pairwise(pairs, prefix, enough).distinct()
    pairs = cut(pairs, "jaccard-pairs")
    ids = cut(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "jaccard-ids")
    return pairwise(pairs, text_sets(docs, ids, k), link).distinct()


def text_sets(docs: DataFrame, ids: DataFrame, k: int = WORDS) -> DataFrame:
    """id, n, tokens of the documents whose id is in ``ids`` (id, distinct)."""

    def run(batches):
        shingle = Shingler(k)
        for b in batches:
            sets = [shingle(t.as_py()).view(np.int64) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                names=["id", "n", "tokens"])

    some = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    return cut(some.mapInArrow(run, "id long, n long, tokens array<long>"), "jaccard-tokens")


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """id, label (smallest id reachable) for every id that has an edge (a, b).
    Each round writes its labels: smaller labels travel along the edges and
    labels are replaced by their own label, so paths halve."""
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), name)
    label = cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                .select("id", F.least("id", "m").alias("label")), name)
    for _ in range(rounds):
        near = (both.join(label.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id"))
                .agg(F.min("label").alias("near")))
        jump = label.select(F.col("id").alias("label"), F.col("label").alias("jump"))
        new = cut(label.join(near, "id").join(jump, "label", "left")
                  .select("id", "label", F.least("label", "near", "jump").alias("next")), name)
        changed = new.where("next < label").limit(1).count()
        label = new.select("id", F.col("next").alias("label"))
        if not changed:
            return label
    raise RuntimeError("components did not settle")


# ---- the join ----------------------------------------------------------------------------

def star_pairs(live: DataFrame, label: DataFrame | None, round_: int, percent: int = PERCENT) -> DataFrame:
    """(a, b): every list's members with one of them, the list's hub of this
    round, where they are not in one component yet."""
    order = F.struct("id") if round_ == 0 else F.struct(F.xxhash64(F.lit(round_), "id").alias("h"), "id")
    if label is not None:
        live = with_labels(live, label)
    else:
        live = live.withColumn("label", F.col("id"))
    live = cut(live, "jaccard-live")
    hubs = cut(live.groupBy("token").agg(F.min(F.struct(order.alias("o"), "id", "label", "n")).alias("m"),
                                         F.min("label").alias("lo"), F.max("label").alias("hi"))
               .where("lo < hi").select(F.col("token").alias("t"), F.col("m.id").alias("hub"),
                                        F.col("m.n").alias("hub_n"), F.col("m.label").alias("hub_label")), "jaccard-hubs")
    pairs = live.join(hubs, F.col("token") == F.col("t")).where("label != hub_label").where(
        100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
    return cut(pairs.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct(), "jaccard-stars")


def with_labels(rows: DataFrame, label: DataFrame) -> DataFrame:
    known = label.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
    return (rows.join(known, F.col("id") == F.col("_id"), "left")
            .withColumn("label", F.coalesce("_label", "id")).drop("_id", "_label"))


def open_groups(live: DataFrame, label: DataFrame, size: int = GROUP) -> DataFrame:
    """(gid, id, label): groups of about 2 * size documents that together hold
    every pair of documents that share a list and are in different components.
    Lists with the same smallest document form one group; a large group is cut
    into blocks by hash, and every pair of blocks is a group."""
    live = cut(with_labels(live, label), "jaccard-labelled")
    lists = (live.groupBy("token").agg(F.min("id").alias("hub"), F.min("label").alias("lo"), F.max("label").alias("hi"))
             .where("lo < hi").select(F.col("token").alias("t"), "hub"))
    rows = live.join(cut(lists, "jaccard-open"), F.col("token") == F.col("t"))
    rows = cut(rows.select("hub", "id", "label").distinct(), "jaccard-rows")
    sizes = cut(rows.groupBy("hub").count().select(F.col("hub").alias("h"), F.col("count").alias("c")), "jaccard-sizes")
    n = F.when(F.col("c") <= 2 * size, F.lit(1)).otherwise(F.ceil(F.col("c") / size)).cast("long")
    return (rows.join(sizes, F.col("hub") == F.col("h")).withColumn("blocks", n)
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select(F.concat_ws("/", F.col("hub").cast("string"), F.least("block", "other").cast("string"),
                                F.greatest("block", "other").cast("string")).alias("gid"), "id", "label"))


def search(groups: DataFrame, prefix: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Candidate pairs (a, b) found by DivideSkip inside the groups.  A task
    reads its groups one after the other and holds one at a time."""
    rows = groups.join(prefix, "id").select("gid", "id", "label", "n", "tokens")
    rows = rows.repartition(shuffle_parts(groups.sparkSession), "gid").sortWithinPartitions("gid")

    def run(batches):
        gid, ids, labels, sizes, sets = None, [], [], [], []

        def close():
            pairs = candidates_within(sets, sizes, labels, percent) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([min(ids[i], ids[j]) for i, j in pairs], pa.int64()),
                 pa.array([max(ids[i], ids[j]) for i, j in pairs], pa.int64())], names=["a", "b"])

        for b in batches:
            for g, i, lab, n, t in zip(*(b.column(c).to_pylist() for c in ("gid", "id", "label", "n")), b.column("tokens")):
                if g != gid:
                    yield close()
                    gid, ids, labels, sizes, sets = g, [], [], [], []
                ids.append(i)
                labels.append(lab)
                sizes.append(n)
                sets.append(t.values.to_numpy())
        yield close()

    return rows.mapInArrow(run, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, star_rounds: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).
    Rows that share a doc_id are one document with several texts; rows without
    an id have no component."""
    rows = cut(prefixes(docs, k, percent), "jaccard-prefixes")
    filled = rows.where("n_shingles > 0 and doc_id is not null")
    sets_ = cut(filled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"))
                .select(F.col("set_a").alias("a_"), F.col("set_b").alias("b_"), "rep"), "jaccard-sets")
    member = cut(filled.join(sets_, (F.col("set_a") == F.col("a_")) & (F.col("set_b") == F.col("b_"))).drop("a_", "b_"),
                 "jaccard-members")
    # documents with several texts join the classes of all of them
    several = (member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
               .select("doc_id", "a"))
    edges = member.join(several, "doc_id").select("a", F.col("rep").alias("b")).where("a != b")
    reps = member.where("doc_id = rep").dropDuplicates(["doc_id", "set_a", "set_b"])
    prefix = cut(reps.where(F.size("prefix") > 0).select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"),
                                                         F.col("prefix").alias("tokens")), "jaccard-reps")
    postings = prefix.select("id", "n", F.explode("tokens").alias("token"))
    shared = cut(postings.groupBy("token").count().where("count > 1").select(F.col("token").alias("t")), "jaccard-lists")
    live = cut(postings.join(shared, F.col("token") == F.col("t")).select("token", "id", "n"), "jaccard-shared")
    label = None
    for i in range(star_rounds):
        pairs = star_pairs(live, label, i, percent)
        edges = cut(edges.unionByName(verified(pairs, prefix, docs, k, percent)), "jaccard-links")
        label = components(edges, "jaccard-labels")
    found = search(cut(open_groups(live, label), "jaccard-groups"), prefix, percent)
    edges = edges.unionByName(verified(found, None, docs, k, percent))
    label = components(edges, "jaccard-labels").select(F.col("id").alias("rep"), "label")
    classes = (member.select("doc_id", "rep").distinct().join(label, "rep", "left")
               .groupBy("doc_id").agg(F.min(F.coalesce("label", "rep")).alias("c")))
    classes = cut(classes.select(F.col("doc_id").alias("d"), "c"), "jaccard-classes")
    return (rows.join(classes, F.col("doc_id") == F.col("d"), "left")
            .select("doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id")))


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """Documents that are the smallest of their component (same columns);
    equal rows of that document stay once (columns that Spark cannot compare,
    such as maps, by their JSON text)."""
    classes = jaccard_components(docs.select("doc_id", "text"), **options)
    drop = classes.where("doc_id != component_id").select(F.col("doc_id").alias("_drop")).distinct()
    kept = docs.join(drop, F.col("doc_id") == F.col("_drop"), "left_anti")
    odd = [f.name for f in docs.schema if any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    if not odd:
        return kept.dropDuplicates()
    keys = {f"_key{i}": F.to_json(F.struct(c)) for i, c in enumerate(odd)}
    return kept.withColumns(keys).dropDuplicates([*keys, *[c for c in docs.columns if c not in odd]]).select(docs.columns)


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents").select("doc_id", "text"))
