"""Hilbert-curve sharding: several metadata dimensions are quantised, rows are
ordered by their index on the Hilbert curve, and the order is cut into runs of
equal row counts.  Neighbouring metadata lands in the same shard, so files can
be skipped by the min / max of any of the dimensions.

Law: ``rows`` -- shard sizes differ by at most one row.

Defined cases: null texts have size 8 and the checksum of the empty text;
null metadata is the lowest cell; equal rows stay neighbours; an empty table
gives no rows; clashing column names are replaced by the computed ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import load, ranked

BITS = 10
SHARDS = 24


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of each row of ``cells`` (n x d, ints below 2**bits) on the
    d-dimensional Hilbert curve (transpose form: undo the excess rotations
    from the top bit down, Gray-encode, then interleave)."""
    x = cells.astype(np.int64).T.copy()
    d = x.shape[0]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            hit = (x[i] & q) != 0
            t = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(hit, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[d - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def hilbert(*cells: Column, bits: int = BITS) -> Column:
    """Column form of :func:`hilbert_index`; Arrow batches, no shuffle."""
    if bits * len(cells) > 62:
        raise ValueError("bits * dimensions must stay within 62")

    def index(*arrays: pd.Series) -> pd.Series:
        m = np.stack([a.to_numpy(dtype=np.int64) for a in arrays], axis=1)
        return pd.Series(hilbert_index(m, bits))

    return F.pandas_udf(index, "long")(*cells)


def log_cell(value: Column, bits: int = BITS, top: float = 32.0) -> Column:
    """Logarithmic quantisation of a size: 2**bits cells up to 2**top."""
    v = F.log2(F.greatest(F.coalesce(value, F.lit(0)), F.lit(0)) + 1) / top
    return F.least(F.lit((1 << bits) - 1), F.floor(v * (1 << bits))).cast("int")


def name_cell(value: Column, bits: int = BITS) -> Column:
    """Quantisation of a name: its first bytes as a binary fraction, so that
    names that sort together stay together; null: 0."""
    head = F.rpad(F.hex(F.encode(F.coalesce(value, F.lit("")), "UTF-8")), 12, "0")
    return F.shiftright(F.conv(F.substring(head, 1, 12), 16, 10).cast("long"), 48 - bits).cast("int")


def hash_cell(value: Column, bits: int = BITS) -> Column:
    return F.when(value.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(value), F.lit(1 << bits))).cast("int")


def document_curve(docs: DataFrame) -> DataFrame:
    """Slim document rows with ``size``, ``text_crc32`` and the curve index over
    (source, language, size)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = F.encode(text, "UTF-8")
    d = docs.withColumn("size", (F.octet_length(text) + 8).cast("long")).withColumn("text_crc32", F.crc32(raw))
    return d.withColumn("hilbert", hilbert(hash_cell(F.col("source")), name_cell(F.col("lang")), log_cell(F.col("size"))))


def shard(df: DataFrame, order: list[str], shards: int = SHARDS) -> DataFrame:
    """Cut the global ``order`` into ``shards`` runs whose row counts differ by
    at most one; ``shard`` and ``slot`` (row number in the shard)."""
    out, total = ranked(df, order, "shards", "_rank")
    base, extra = divmod(total, shards)
    wide = extra * (base + 1)  # rows of the shards that hold one more
    r = F.col("_rank")
    if base:
        s = F.when(r < wide, F.floor(r / (base + 1))).otherwise(extra + F.floor((r - wide) / base))
        slot = F.when(r < wide, r % (base + 1)).otherwise((r - wide) % base)
    else:
        s, slot = r, F.lit(0)
    return out.withColumn("shard", s.cast("int")).withColumn("slot", slot.cast("long")).drop("_rank")


ORDER = ["hilbert", "doc_id", "text_crc32"]


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = document_curve(load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    out = shard(docs.select("doc_id", "size", "text_crc32", "source", "lang", "hilbert"), ORDER)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source", "lang", "hilbert")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Documents, all their columns, with ``shard`` and ``slot``, clustered by
    shard so that a Parquet write gives files with tight min / max ranges."""
    cols = [c for c in docs.columns if c not in ("shard", "slot", "size", "text_crc32", "hilbert")]
    out = shard(document_curve(docs), ORDER, shards)
    return out.select(*[F.col(f"`{c}`") for c in cols], "size", "text_crc32", "hilbert", "shard", "slot")
