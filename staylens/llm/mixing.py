"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws the key ``u ** (1 / quality)`` (equivalently an
exponential variate divided by its weight) from a hash of its id, so reruns
agree.  A source whose target is ``e`` whole epochs and a rest takes each
document ``e`` times; the rest is filled in descending key order until the
running word count reaches it.  The document on the boundary gives only the
words still missing, so a source meets its target to the word.

The order is exact without sorting a source: keys fall into fixed slices, the
slices' word sums are prefix-summed, and only the one slice per source that
holds the boundary is sorted.

Defined cases: null texts have size 0 and are never taken; the null source is
a source of its own, last; repeated rows are ordinary rows; an empty table
gives an empty result; columns named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylens.llm.common import cut, load, word_count

SEED = 17
SLICES = 1024          # key slices per source; one of them is sorted
MAX_EPOCHS = 3.0       # a target stops at so many times its source
CYCLE = (1.0, 2.0, 3.0)
SYMBOLS = "#*$%&|<>!"


def symbol_free_share(text: Column) -> Column:
    """Default document quality in (0, 1]: the share of characters that are not
    list, markup or shouting symbols."""
    n = F.length(text)
    return F.when(n > 0, F.greatest(F.lit(0.05), F.length(F.translate(text, SYMBOLS, "")) / n)).otherwise(F.lit(1.0))


def targets(sizes: dict, weights: dict, budget: float | None = None, cap: float = MAX_EPOCHS) -> dict:
    """Share ``budget`` (default: all sizes) by weight; what a source cannot
    hold (``cap`` times its size) is shared again among the others."""
    rest = float(sum(sizes.values()) if budget is None else budget)
    open_, out = {s for s in sizes}, {}
    while open_:
        w = sum(weights[s] for s in open_)
        share = {s: rest * weights[s] / w for s in open_}
        full = {s for s in open_ if share[s] > cap * sizes[s]}
        if not full:
            return out | share
        for s in full:
            out[s] = cap * sizes[s]
            rest -= out[s]
        open_ -= full
    return out


def cycled_weights(sources, cycle=CYCLE) -> dict:
    """Weights 1, 2, 3, repeating over the sources in code point order, null last."""
    order = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: cycle[i % len(cycle)] for i, s in enumerate(order)}


def mix(docs: DataFrame, weights=cycled_weights, budget: float | None = None, cap: float = MAX_EPOCHS,
        quality=symbol_free_share, seed: int = SEED, keep: tuple = ("doc_id", "source")) -> DataFrame:
    """Documents (columns ``keep``) with ``size``, ``source_size``, ``target``
    and ``taken`` (words the mix takes, repeats counted).

    ``weights``: function from the list of sources to a dict.  One row per
    source reaches the driver."""
    spark = docs.sparkSession
    text = F.col("text")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")), 11) + 0.5) / F.lit(2.0 ** 53)
    # larger is earlier; in (0, 1)
    key = F.pow(u, F.lit(1.0) / quality(text))
    base = docs.select(*[F.col(c) for c in keep], word_count(text).alias("size"), key.alias("_key"),
                       F.xxhash64(text).alias("_tie"))
    base = base.withColumn("_slice", F.least(F.lit(SLICES - 1), F.floor((F.lit(1.0) - F.col("_key")) * SLICES)).cast("int"))
    base = cut(base, "mix-keys")
    sums = base.groupBy("source", "_slice").agg(F.sum("size").alias("w"))
    sums = cut(sums, "mix-slices")
    sizes = {r[0]: int(r[1]) for r in sums.groupBy("source").agg(F.sum("w")).collect()}
    goal = targets(sizes, weights(list(sizes)), budget, cap) if sizes else {}
    plan = []
    for s, t in goal.items():
        full = int(t // sizes[s]) if sizes[s] else 0
        plan.append((s, sizes[s], float(t), full, int(round(t)) - full * sizes[s]))
    plan = spark.createDataFrame(plan, "p_source string, source_size long, target double, _full long, _rest long")
    # words of the slices before, per source: at most SLICES rows each
    before = F.sum("w").over(Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    edge = (sums.withColumn("b", F.coalesce(before, F.lit(0)))
            .join(plan, F.col("source").eqNullSafe(F.col("p_source")))
            .where((F.col("b") <= F.col("_rest")) & (F.col("b") + F.col("w") > F.col("_rest")))
            .select(F.col("source").alias("e_source"), F.col("_slice").alias("_edge"), F.col("b").alias("_words")))
    plan = cut(plan.join(edge, F.col("p_source").eqNullSafe(F.col("e_source")), "left").drop("e_source"), "mix-plan")
    all_ = (base.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("p_source")))  # one row per source
            if len(sizes) <= 100_000 else base.join(plan, F.col("source").eqNullSafe(F.col("p_source"))))
    edge_row = F.coalesce(F.col("_slice") == F.col("_edge"), F.lit(False))
    first = Window.partitionBy("source").orderBy(F.desc("_key"), F.asc("doc_id"), F.asc("_tie")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    within = F.col("_words") + F.coalesce(F.sum("size").over(first), F.lit(0))
    split = all_.where(edge_row).withColumn(
        "_part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - within)))
    plain = all_.where(~edge_row).withColumn(
        "_part", F.when(F.col("_edge").isNull(), F.when(F.col("_rest") > 0, F.col("size")).otherwise(0))
        .when(F.col("_slice") < F.col("_edge"), F.col("size")).otherwise(F.lit(0)))
    return split.unionByName(plain).select(
        *keep, "size", "source_size", "target",
        (F.col("_full") * F.col("size") + F.col("_part")).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document once per epoch that takes it, the
    boundary document where at least half of it is taken.  Columns of ``docs``."""
    cols = docs.columns
    tagged = cut(docs.withColumn("_row", F.monotonically_increasing_id()), "mix-rows")
    taken = mix(tagged, keep=("doc_id", "source", "_row"), **options)
    copies = F.floor(F.col("taken") / F.col("size") + F.lit(0.5)).cast("int")
    taken = taken.where(F.col("size") > 0).select("_row", copies.alias("_copies")).where("_copies > 0")
    return (tagged.join(taken, "_row").withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*[F.col(f"`{c}`") for c in cols]))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")
