"""Quality rules: per-document base rules and cross-document line frequency.

Base rules (one pass over whole texts, expressions only): word and symbol
counts, repeated lines, words inside repeated 8-word windows.

Line frequency: lines are normalised and hashed, the distinct documents that
hold a line are counted per host (``source`` for documents), lines above the
limit are removed, and documents depleted by that are rejected.  "Distinct"
means different texts: exact copies count once, so a document is not rejected
for having copies.  The limit is a number of documents, the same for every host and
size of the table: ``MIN_DOCS``, or ``LONG_DOCS`` for lines of more than
``LONG_WORDS`` words, which do not repeat by chance.

Defined cases: null or empty text has no words and fails the base rules; a
null host is a host of its own; repeated rows get equal verdicts; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import SPACES, cut, load, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
MIN_DOCS = 20          # a line in at most so many documents of a host stays
LONG_WORDS = 50        # a line of more words is a passage
LONG_DOCS = 5          # and stays in at most so many documents
MIN_LEFT_SHARE = 0.3   # of a document's words, after removal
MIN_LEFT_WORDS = 5


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(_without(x, SPACES)) > 0)


def base_rules(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(*keep, text.alias("_text")).withColumn("_w", words(F.col("_text")))
    d = d.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    d = d.withColumn("n_words", F.size("_h").cast("long")).drop("_w")
    count = F.size("_h") - (WINDOW - 1)
    wins = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice("_h", i, WINDOW)))
    d = d.withColumn("_g", F.when(count >= 2, wins))
    # window hashes are compared as a set first; only texts with a repeat sort
    # (hash, position) pairs: starts of repeated windows, in ascending order
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.sort_array(
        F.transform("_g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    at = lambda a, i: F.get(a, i)  # noqa: E731 -- null outside the array
    twice = lambda e, i: (e["x"].eqNullSafe(at(F.col("_s"), i + 1)["x"])
                          | e["x"].eqNullSafe(at(F.col("_s"), i - 1)["x"]))
    d = d.withColumn("_p", F.sort_array(F.transform(F.filter("_s", twice), lambda e: e["i"])))
    # each start covers the words up to the next one, a whole window at most
    spread = F.transform("_p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(at(F.col("_p"), i + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(spread, F.lit(0), lambda a, x: a + x)
    lines = lines_with_words(F.col("_text"))
    d = d.select(
        *[c for c in d.columns if not c.startswith("_")],
        F.length(_without(F.col("_text"), SPACES)).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), r"[\x20\x09-\x0D]+", " "))


def document_lines(docs: DataFrame, host: Column) -> DataFrame:
    """One row per document and distinct normalised line: key (stable identity
    of the row), host, content (hash of the text), line, n (words of all its
    occurrences), long (whether the line is a passage)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    line = F.transform(lines_with_words(text), lambda x: F.struct(
        F.xxhash64(normalised(x)).alias("line"), F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).alias("n")))
    one = docs.select(F.xxhash64("doc_id", host, text).alias("key"), host.alias("host"),
                      F.xxhash64(text, F.lit(1)).alias("content"), F.explode(line).alias("l"))
    return one.select("key", "host", "content", "l.line", "l.n", (F.col("l.n") > LONG_WORDS).alias("long"))


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS, long_docs: int = LONG_DOCS) -> DataFrame:
    """(host, line) held by more distinct texts of the host than the limit."""
    once = lines.select("host", "line", "content", "long").distinct()
    counts = once.groupBy("host", "line").agg(F.count("*").alias("n_texts"), F.max("long").alias("long"))
    limit = F.when(F.col("long"), F.lit(min(min_docs, long_docs))).otherwise(F.lit(min_docs))
    return counts.where(F.col("n_texts") > limit).select("host", "line", "n_texts")


def line_rules(docs: DataFrame, host_col: str = "source", min_docs: int = MIN_DOCS, long_docs: int = LONG_DOCS,
               min_left_share: float = MIN_LEFT_SHARE, min_left_words: int = MIN_LEFT_WORDS) -> DataFrame:
    """doc_id, the base counts, ``removed_words``, ``base_failed`` and ``kept``."""
    host = F.col(host_col)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = cut(base_rules(docs, [F.col("doc_id"), host.alias("host"),
                                 F.xxhash64("doc_id", host, text).alias("key"),
                                 F.xxhash64(text, F.lit(1)).alias("content")]), "line-base")
    lines = cut(document_lines(docs, host), "lines")
    hot = cut(frequent_lines(lines, min_docs, long_docs), "lines-hot")
    hits = (lines.join(hot.select(F.col("host").alias("h"), F.col("line").alias("l")),
                       (F.col("line") == F.col("l")) & F.col("host").eqNullSafe(F.col("h")), "left_semi")
            .groupBy("key").agg(F.sum("n").alias("removed")))
    copies = base.groupBy("key").agg(F.count("*").alias("copies"))  # equal rows share one key
    hits = cut(hits.join(copies, "key").select("key", (F.col("removed") / F.col("copies")).cast("long").alias("removed_words")),
               "lines-removed")
    out = base.join(hits, "key", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & ((left < min_left_share * F.col("n_words")) | (left < min_left_words))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def remove_lines(docs: DataFrame, hot: DataFrame, host_col: str = "source") -> DataFrame:
    """The documents with their frequent lines taken out of ``text``.  ``hot``:
    host, line as from :func:`frequent_lines`.  A document meets only the
    frequent lines it holds itself; texts without one stay as they are."""
    host = F.col(host_col)
    mine = (document_lines(docs, host).join(hot.select(F.col("host").alias("h"), F.col("line").alias("l")),
                                            (F.col("line") == F.col("l")) & F.col("host").eqNullSafe(F.col("h")), "left_semi")
            .groupBy(F.col("key").alias("_of")).agg(F.collect_set("line").alias("_hot")))
    key = F.xxhash64("doc_id", host, F.coalesce(F.col("text"), F.lit("")))
    kept = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("_hot", F.xxhash64(normalised(x))))
    return (docs.withColumn("_key", key).join(mine, F.col("_key") == F.col("_of"), "left")
            .withColumn("text", F.when(F.col("_hot").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
            .drop("_key", "_of", "_hot"))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_rules(load(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "removed_words")
