"""Sinks (section 2.2).  Every writer is a DataFrame write -- partitioned by
area where the reference writes one file per zip / listing -- never a
collect-and-loop on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_matrix(raw: DataFrame, clean: DataFrame, path: str, fmt: str = "parquet", key: str = "listing_id") -> None:
    """Raw matrix (sorted by ADR desc, missing last) and clean matrix."""
    from staylens.operators.market import matrix_sort
    w = matrix_sort(raw, key).write.mode("overwrite")
    c = clean.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(f"{path}/raw")
        c.option("header", True).csv(f"{path}/clean")
    else:
        w.parquet(f"{path}/raw")
        c.parquet(f"{path}/clean")


def write_matrices(raw: DataFrame, path: str, min_days: int = 100, key: str = "listing_id") -> None:
    """Raw matrix, and the clean matrix made from the written raw one, so the
    plan behind ``raw`` runs once (Parquet)."""
    from staylens.operators.market import matrix_sort
    from staylens.operators.matrix import clean_matrix
    matrix_sort(raw, key).write.mode("overwrite").parquet(f"{path}/raw")
    back = raw.sparkSession.read.schema(raw.schema).parquet(f"{path}/raw")
    clean_matrix(back, min_days, key).write.mode("overwrite").parquet(f"{path}/clean")


SIDE_TABLES = ("descriptions", "house_rules", "neighborhood_highlights")


def write_side_tables(details: DataFrame, path: str, key: str = "listing_id") -> None:
    """Descriptions, house rules and neighbourhood highlights as JSON lines
    (``key, text``), one folder ``table=<name>`` each, from one pass over the
    details; a listing without the text has no line."""
    from staylens.operators.matrix import parse_details_columns
    from staylens.sources.files import normalize_description_value
    parsed = parse_details_columns()
    description = F.col("description")
    if details.schema["description"].dataType.typeName() == "variant":
        description = F.to_json(description)
    texts = dict(zip(SIDE_TABLES, (normalize_description_value(description), parsed["house_rules"],
                                   parsed["neighborhood_highlight"])))
    rows = details.select(key, F.inline(F.array(*[F.struct(F.lit(n).alias("table"), t.alias("text")) for n, t in texts.items()])))
    rows.where(F.col("text").isNotNull()).write.mode("overwrite").partitionBy("table").json(path)


def read_side_tables(spark, path: str, key: str = "listing_id") -> DataFrame:
    """table, key, text of all side tables."""
    return spark.read.schema(f"{key} string, text string, table string").json(path)


def write_summaries(summaries: DataFrame, path: str, area: str = "area", key: str = "listing_id",
                    summary: str = "summary") -> None:
    """One ``{listing: summary}`` document per line, one folder per area (a NULL
    summary is written as null)."""
    doc = F.to_json(F.create_map(F.col(key).cast("string"), F.col(summary)), {"ignoreNullFields": "false"})
    summaries.select(area, doc.alias("value")).write.mode("overwrite").partitionBy(area).text(path)


def write_market_master(metrics: DataFrame, path: str, area: str | None = "area") -> None:
    """Merged metrics, partitioned by area when the column exists."""
    if area and area in metrics.columns:
        write_by_area(metrics, path, area)
    else:
        metrics.write.mode("overwrite").parquet(path)


def write_by_area(df: DataFrame, path: str, area: str = "area", fmt: str = "parquet") -> None:
    """Reviews / summaries: one directory per area instead of one file per listing.
    Rows are rebalanced by area first -- few files per area, and AQE splits an
    area too big for one."""
    df.hint("rebalance", area).write.mode("overwrite").partitionBy(area).format(fmt).save(path)


def write_json_record(df: DataFrame, path: str) -> None:
    """Tier / quality stats records (one JSON object per row)."""
    df.write.mode("overwrite").json(path)


def render_report(report: DataFrame, path: str, name_cols=("metric",), text: str = "report") -> None:
    """One Markdown text per report row, written as text partitioned by the
    name columns (each report lands in its own directory)."""
    report.select(*name_cols, F.col(text).alias("value")).write.mode("overwrite").partitionBy(*name_cols).text(path)


def write_request_log(sessions: DataFrame, path: str) -> None:
    """Append this run's sessions; readers keep the last N (see ``read_request_log``)."""
    sessions.write.mode("append").parquet(path)


def read_request_log(spark, path: str, order_col: str = "session_start", n: int = 100, tie: str | None = None) -> DataFrame:
    from staylens.operators.costs import last_n_sessions
    return last_n_sessions(spark.read.parquet(path), order_col, n, tie)
