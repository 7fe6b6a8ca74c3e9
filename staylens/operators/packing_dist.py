"""Numbering and greedy packing of ordered groups over the whole cluster.

One path at every size.  Only numbers (row id, key, order, tokens) are range
partitioned and sorted; texts stay in the written table and meet the result
through an equi-join on the row id.

Packing walks each listing's items in order, so a listing cut by the range
partitioner makes one partition's result depend on the one before.  Each
partition therefore gives an *exit table*: for every place where the first new
chunk can begin (entry) the state it leaves behind (exit) -- tokens and items in
the open chunk, chunks begun.  Entries lie within one budget of the partition's
start (the table is written beside the numbers, by the task that sorts them), so a table is bounded by the budget, not by the partition.  Exit tables
compose (``compose``), and a scan over the partitions with ``FAN`` tables per
step, up and down a tree, gives every partition its entry state.  A second pass
over the numbers then packs all partitions independently.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.plans.common import written

FAN = 64            # exit tables composed by one task
ROW_BITS = 33       # monotonically_increasing_id: partition above, row below


def range_rows(df: DataFrame, key: str, order_cols: Sequence, partitions: int | None = None) -> DataFrame:
    """Rows sorted by (key, order) over range partitions, with ``_at``: the
    partition number and the row within it.  The range partitioner cuts a hot
    key by its order values."""
    n = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    return (df.repartitionByRange(n, key, *order_cols).sortWithinPartitions(key, *order_cols)
            .withColumn("_at", F.monotonically_increasing_id()))


def global_positions(df: DataFrame, key: str, order_cols: Sequence, weight: str | None = None,
                     partitions: int | None = None) -> DataFrame:
    """Adds ``gidx`` (0-based position inside the key in ``order_cols`` order)
    and, with ``weight``, ``pe`` (its sum over earlier rows) without a per-key
    task and without leaving the JVM.

    ``order_cols`` may be names or sort expressions (``F.col(c).desc()``).
    The sorted rows are written once; per (partition, key) counts give the
    offsets (one row per key and partition it spans)."""
    if key not in df.columns:
        raise ValueError(f"unknown key column {key}")
    rows = written(range_rows(df, key, order_cols, partitions), "positions").withColumn(
        "_pid", F.shiftright("_at", ROW_BITS))
    w = F.sum(weight) if weight else F.lit(0).cast("long")
    parts = rows.groupBy("_pid", key).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_c"),
                                          *([w.alias("_s")] if weight else []))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = ["_c"] + (["_s"] if weight else [])
    offsets = parts.select(F.col("_pid").alias("_opid"), F.col(key).alias("_key"), "_first",
                           *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in sums])
    out = rows.join(offsets, (F.col("_pid") == F.col("_opid")) & F.col(key).eqNullSafe(F.col("_key"))).withColumn(
        "gidx", F.col("_c_before") + F.col("_at") - F.col("_first"))
    if weight:
        within = Window.partitionBy("_pid", key).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("pe", F.col("_s_before") + F.coalesce(F.sum(weight).over(within), F.lit(0)))
    return out.drop("_pid", "_opid", "_key", "_at", "_first", "_c_before", "_s_before")


# ---------------------------------------------------------------- greedy packing
def pack_many(keys: np.ndarray, tokens: np.ndarray, budget: np.ndarray):
    """Vectorised packing of many whole listings at once.

    Rows are sorted by (key, order); ``budget`` is per row (constant within a
    listing).  One global prefix sum + one ``searchsorted`` give every row's
    chunk end; the chunk end is clamped to the listing end, so listings never
    mix.  Returns chunk_no, item_no (1-based) and the truncation flag.
    """
    n = len(tokens)
    idx = np.arange(n)
    brk = np.empty(n, dtype=bool)
    brk[0] = True
    brk[1:] = keys[1:] != keys[:-1]
    gstart = np.flatnonzero(brk)
    gid = np.cumsum(brk) - 1
    gend = np.r_[gstart[1:], n]
    nxt = next_starts(tokens, budget, gend[gid])
    is_start = np.zeros(n, dtype=bool)
    nx = nxt.tolist()
    for gs, ge in zip(gstart.tolist(), gend.tolist()):
        i = gs
        while i < ge:
            is_start[i] = True
            i = nx[i]
    cg = np.cumsum(is_start) - 1
    start_pos = np.flatnonzero(is_start)
    chunk_no = cg - cg[gstart][gid] + 1
    item_no = idx - start_pos[cg] + 1
    over = tokens > budget
    first_fit = np.minimum.reduceat(np.where(~over, idx, n), gstart)[gid]
    return chunk_no.astype("int64"), item_no.astype("int64"), over & (idx < first_fit)


def next_starts(tokens: np.ndarray, budget, end) -> np.ndarray:
    """Start of the chunk after the one that starts at each row (``end``: none)."""
    total = np.concatenate([[0], np.cumsum(tokens)])
    past = np.searchsorted(total, total[:-1] + budget, side="right") - 1
    # a listing may start later in the prefix sums; a budget below zero looks back
    return np.minimum(np.maximum(past, np.arange(len(tokens)) + 1), end)


FRESH = None    # state before a listing's first item


def exit_table(key, tokens: np.ndarray, budget: int) -> dict:
    """The exit table of rows of one listing, entered with an open chunk."""
    n = len(tokens)
    total = np.concatenate([[0], np.cumsum(tokens)])
    nxt = next_starts(tokens, budget, n)
    last, begun = np.where(nxt < n, nxt, np.arange(n)), (nxt < n).astype(np.int64)
    while True:     # last start of the chain from each row, doubling the hops
        far = last[last]
        if np.array_equal(far, last):
            break
        begun, last = begun + begun[last], far
    entry = np.flatnonzero((tokens > 0) & (total[:-1] <= budget))
    if not len(entry) or entry[0] != 0:
        entry = np.concatenate([[0], entry])
    return {"key": key, "budget": budget, "reset": False, "fits": bool((tokens <= budget).any()),
            "total": int(total[-1]), "rows": n, "bounds": total[entry + 1], "tokens": total[-1] - total[last[entry]],
            "chunks": begun[entry] + 1, "items": n - last[entry]}


def enter(table: dict, state):
    """State after the rows of ``table``, from the state before them: (key,
    tokens of the open chunk, chunks begun, items of the open chunk, whether any
    item of the listing fitted)."""
    if table["reset"]:
        return table["state"]
    if state is FRESH or state[0] != table["key"]:
        state = (table["key"], table["budget"] + 1, 0, 0, False)
    _, tokens, chunks, items, fits = state
    fits = fits or table["fits"]
    e = 0 if tokens > table["budget"] else int(np.searchsorted(table["bounds"], table["budget"] - tokens, side="right"))
    if e < len(table["bounds"]):
        return (table["key"], int(table["tokens"][e]), chunks + int(table["chunks"][e]), int(table["items"][e]), fits)
    return (table["key"], tokens + table["total"], chunks, items + table["rows"], fits)


def compose(a: dict, b: dict) -> dict:
    """The exit table of the rows of ``a`` followed by those of ``b``."""
    if b["reset"]:
        return b
    if a["reset"] or a["key"] != b["key"]:
        return {"reset": True, "state": enter(b, a["state"] if a["reset"] else (a["key"], 0, 0, 0, False))}
    budget = b["budget"]
    e = np.where(a["tokens"] > budget, 0, np.searchsorted(b["bounds"], budget - a["tokens"], side="right"))
    new, at = e < len(b["bounds"]), np.minimum(e, len(b["bounds"]) - 1)
    first = {"bounds": a["bounds"], "tokens": np.where(new, b["tokens"][at], a["tokens"] + b["total"]),
             "chunks": a["chunks"] + np.where(new, b["chunks"][at], 0),
             "items": np.where(new, b["items"][at], a["items"] + b["rows"])}
    # entries of b reached while a's rows all joined the open chunk
    reach = a["total"] + np.concatenate([[0], b["bounds"][:-1]]) <= budget
    then = {"bounds": a["total"] + b["bounds"], **{c: b[c] for c in ("tokens", "chunks", "items")}}
    out = {c: np.concatenate([first[c], then[c][reach]]) for c in first}
    return {"key": a["key"], "budget": budget, "reset": False, "fits": a["fits"] or b["fits"],
            "total": a["total"] + b["total"], "rows": a["rows"] + b["rows"], **out}


def _sorted(table: pa.Table):
    """Keys (as text), tokens and budgets of a partition's rows, in order."""
    table = table.sort_by("_at")
    key = table.column("_ks").combine_chunks().dictionary_encode()
    codes = key.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    names = key.dictionary.to_pylist()
    return (table, codes, [names[c] if c >= 0 else None for c in (codes[0], codes[-1])],
            table.column("tokens").to_numpy(), table.column("budget").to_numpy())


def _summary(table: pa.Table) -> pa.Table:
    table, codes, (first, last), tokens, budget = _sorted(table)
    start = int(np.flatnonzero(codes != codes[-1])[-1]) + 1 if (codes != codes[-1]).any() else 0
    node = exit_table((last,), tokens[start:], int(budget[-1]))
    if start:
        node = {"reset": True, "state": enter(node, FRESH)}
    return pa.table({"_at": table.column("_at")[:1], "node": [pickle.dumps(node)]},
                    schema=pa.schema([("_at", pa.int64()), ("node", pa.binary())]))


def _noted(batches):
    """The rows of a partition, and one more that holds its exit table."""
    kept = []
    for b in batches:
        if b.num_rows:
            kept.append(b)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.nulls(b.num_rows, pa.binary())], schema=NOTED)
    if kept:
        node = _summary(pa.Table.from_batches(kept))
        yield pa.RecordBatch.from_arrays(
            [node.column(c).combine_chunks() if c in node.column_names else pa.nulls(1, t) for c, t in zip(NOTED.names, NOTED.types)],
            schema=NOTED)


def _nodes(table: pa.Table) -> list[tuple[int, dict]]:
    return sorted(((p, pickle.loads(n)) for p, n in zip(table.column("_pid").to_pylist(), table.column("node").to_pylist())),
                  key=lambda x: x[0])


def _parent(table: pa.Table) -> pa.Table:
    nodes = _nodes(table)
    out = nodes[0][1]
    for _, n in nodes[1:]:
        out = compose(out, n)
    return pa.table({"_pid": [nodes[0][0] // FAN], "node": [pickle.dumps(out)]},
                    schema=pa.schema([("_pid", pa.int64()), ("node", pa.binary())]))


def _walk(nodes: pa.Table, parents: pa.Table) -> pa.Table:
    state = pickle.loads(parents.column("state")[0].as_py()) if parents.num_rows else FRESH
    pids, states = [], []
    for p, n in _nodes(nodes):
        pids.append(p)
        states.append(pickle.dumps(state))
        state = enter(n, state)
    return pa.table({"_pid": pids, "state": states}, schema=pa.schema([("_pid", pa.int64()), ("state", pa.binary())]))


def entry_states(nodes: DataFrame, partitions: int) -> DataFrame:
    """_pid, state before the partition's first row; ``FAN`` tables per task
    on the way up (composed) and down (walked)."""
    up = nodes.withColumn("_up", F.floor(F.col("_pid") / FAN))
    groups = up.groupBy("_up")
    if partitions <= FAN:
        parents = nodes.sparkSession.createDataFrame([], "_pid long, state binary")
    else:
        above = written(groups.applyInArrow(lambda t: _parent(t), "_pid long, node binary"), "exit-tables")
        parents = entry_states(above, -(-partitions // FAN))
    return groups.cogroup(parents.groupBy("_pid")).applyInArrow(
        lambda n, p: _walk(n, p), "_pid long, state binary")


def _assign(rows: pa.Table, states: pa.Table) -> pa.Table:
    if not rows.num_rows:
        return pa.table({c: [] for c in ASSIGNED.names}, schema=ASSIGNED)
    rows, codes, (first, _), tokens, budget = _sorted(rows)
    chunk, item, cut = pack_many(codes, tokens, budget)
    state = pickle.loads(states.column("state")[0].as_py())
    if state is not FRESH and state[0] == (first,):     # the first rows go on with an open chunk
        n = int(np.flatnonzero(codes != codes[0])[0]) if (codes != codes[0]).any() else len(codes)
        _, open_tokens, chunks, items, fits = state
        limit, total = int(budget[0]), np.cumsum(tokens[:n])
        e = 0 if open_tokens > limit else int(np.searchsorted(total, limit - open_tokens, side="right"))
        chunk[:e], item[:e] = chunks, items + 1 + np.arange(e)
        if e < n:
            c, i, _ = pack_many(codes[e:n], tokens[e:n], budget[e:n])
            chunk[e:n], item[e:n] = chunks + c, i
        if fits:
            cut[:n] = False
    return pa.table({"_id": rows.column("_id"), "chunk_no": chunk, "item_no": item, "truncated": cut}, schema=ASSIGNED)


NOTED = pa.schema([("_id", pa.int64()), ("_ks", pa.string()), ("tokens", pa.int64()), ("budget", pa.int64()),
                   ("_at", pa.int64()), ("node", pa.binary())])
ASSIGNED = pa.schema([("_id", pa.int64()), ("chunk_no", pa.int64()), ("item_no", pa.int64()), ("truncated", pa.bool_())])


def chunk_numbers(staged: DataFrame, key: str, order_cols: Sequence, partitions: int | None = None) -> DataFrame:
    """``_id, chunk_no, item_no, truncated`` of the rows of a written table
    (``_id``, key, order, ``tokens``, ``budget``); rows of equal order go by ``_id``."""
    rows = range_rows(staged, key, [*order_cols, "_id"], partitions)
    rows = written(rows.select("_id", F.col(key).cast("string").alias("_ks"), "tokens", "budget", "_at").mapInArrow(
        lambda batches: _noted(batches), "_id long, _ks string, tokens long, budget long, _at long, node binary"), "pack-numbers")
    rows = rows.withColumn("_pid", F.shiftright("_at", ROW_BITS))
    n = partitions or max(int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    nodes, rows = rows.where("node IS NOT NULL").select("_pid", "node"), rows.where("node IS NULL").drop("node")
    return rows.groupBy("_pid").cogroup(entry_states(nodes, n).groupBy("_pid")).applyInArrow(
        lambda r, s: _assign(r, s), "_id long, chunk_no long, item_no long, truncated boolean")


__all__ = ["chunk_numbers", "global_positions", "pack_many", "range_rows"]
