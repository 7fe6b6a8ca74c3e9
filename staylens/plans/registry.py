"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Each query runs its operator over the whole driver tables (through the
bindings); results carry the same column names as the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.operators import reviews as rv
from staylens.sources import bindings as b

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def q(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            # timestamps in the tables are zone-less; evaluate them as UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ---------------------------------------------------------------- reviews
@q("listing_mean_rating")
def _(spark, sf):
    return rv.listing_mean_rating(b.b_reviews(spark, sf))


@q("overall_mean_rating")
def _(spark, sf):
    return rv.overall_mean_rating(b.b_reviews(spark, sf))


@q("above_mean_listings")
def _(spark, sf):
    return rv.above_mean_listings(b.b_reviews(spark, sf))


@q("review_counts")
def _(spark, sf):
    return rv.review_counts(b.b_reviews(spark, sf))


@q("min_reviews_filter")
def _(spark, sf):
    kept = rv.min_reviews_filter(b.b_reviews(spark, sf), threshold=5)
    return kept.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("n_kept"),
        rv.fixed_round(F.sum(F.coalesce(F.col("rating").cast("double"), F.lit(0.0))), 4).alias("rating_sum"))


@q("combined_review")
def _(spark, sf):
    return rv.with_combined_review(b.b_reviews(spark, sf)).select(
        "listing_id", "l_orderkey", "l_linenumber", "combined_review")


@q("limit_listings")
def _(spark, sf):
    return rv.limit_listings(b.b_reviews(spark, sf), 100)


@q("empty_summary_filter")
def _(spark, sf):
    return rv.empty_summary_filter(b.b_summaries(spark, sf)).select(
        "area", "listing_id", F.length("summary").alias("summary_chars"))


@q("incomplete_summary_filter")
def _(spark, sf):
    """One summary in five carries the mark of an incomplete one."""
    marked = F.when((F.col("listing_id") % 5 == 0) & (F.length("summary") > 0), F.concat("summary", F.lit(" ?")))
    s = b.b_summaries(spark, sf).withColumn("summary", F.coalesce(marked, F.regexp_replace("summary", "[?]", ".")))
    return rv.incomplete_summary_filter(s).select("area", "listing_id", F.length("summary").alias("summary_chars"))


# ---------------------------------------------------------------- tiers (pipeline C)
from staylens.functions.scalar import display_name, fixed_round  # noqa: E402
from staylens.operators import market as mk  # noqa: E402
from staylens.operators import matrix as mx  # noqa: E402
from staylens.operators import tiers as tr  # noqa: E402
from staylens.plans import tiers as tp  # noqa: E402


def _tiers(spark, sf):
    return tp.tier_analysis(tp.binding_matrix(spark, sf), tp.BINDING_METRICS, b.BINDING_ICONS,
                            tr.NUMERIC_COLUMNS)


@q("tier_thresholds")
def _(spark, sf):
    th = _tiers(spark, sf)["thresholds"]
    return th.select("metric", fixed_round("high_threshold", 6).alias("high_threshold"),
                     fixed_round("low_threshold", 6).alias("low_threshold"), "n_valid")


@q("tier_assign")
def _(spark, sf):
    return _tiers(spark, sf)["tiered"].select("listing_id", "metric", "tier", "value")


@q("tier_counts")
def _(spark, sf):
    return tr.tier_counts(_tiers(spark, sf)["tiered"])


@q("amenity_prevalence")
def _(spark, sf):
    return _tiers(spark, sf)["prevalence"].select("metric", "amenity", "high_tier_pct", "low_tier_pct",
                                                  "difference", "rank")


@q("rank_by_abs_difference")
def _(spark, sf):
    return _tiers(spark, sf)["prevalence"].select("metric", "rank", "amenity", "difference")


@q("top_features")
def _(spark, sf):
    return tr.top_features(_tiers(spark, sf)["prevalence"]).select("metric", "rank", "amenity", "difference")


@q("numeric_tier_stats")
def _(spark, sf):
    return _tiers(spark, sf)["numeric"].select("metric", "attribute", "high_tier_avg", "low_tier_avg",
                                               "difference")


@q("tier_sample")
def _(spark, sf):
    return tr.tier_sample(_tiers(spark, sf)["tiered"], k=3).select("metric", "tier", "sample_rank", "listing_id")


@q("comparison_table_text")
def _(spark, sf):
    r = _tiers(spark, sf)
    return tr.comparison_table_text(r["prevalence"], r["numeric"])


@q("tier_analysis")
def _(spark, sf):
    return tp.tier_report(_tiers(spark, sf), metric_columns=tp.BINDING_METRICS)


@q("display_name")
def _(spark, sf):
    icons = b.b_feature_icons(spark, sf)
    return icons.groupBy("icon").agg(F.count(F.lit(1)).alias("n_listings")) \
        .withColumn("display_name", display_name("icon"))


# ---------------------------------------------------------------- market / matrix
@q("occupancy_metrics")
def _(spark, sf):
    return mk.occupancy_metrics(b.b_market(spark, sf)).select(
        "listing_id", "Occ_Rate_Based_on_Avail", "Days_Avail", "Abs_Occ_Rate", "Avail_Rate")


@q("valid_metric_filter")
def _(spark, sf):
    return tr.valid_metric_filter(b.b_market(spark, sf), "ADR").select("listing_id", "ADR")


@q("min_days_filter")
def _(spark, sf):
    return mk.min_days_filter(mk.occupancy_metrics(b.b_market(spark, sf)), 100).select("listing_id", "Days_Avail")


@q("empty_metrics_filter")
def _(spark, sf):
    return mk.empty_metrics_filter(b.b_market(spark, sf)).select("listing_id")


@q("join_market_metrics")
def _(spark, sf):
    return tp.binding_matrix(spark, sf).select("listing_id", "area", "ADR", "Occupancy", "Days_Available",
                                               "has_airdna_data")


@q("has_market_data_filter")
def _(spark, sf):
    return mk.has_market_data_filter(tp.binding_matrix(spark, sf)).select("listing_id", "ADR")


@q("matrix_sort")
def _(spark, sf):
    from staylens.operators.packing_dist import global_positions
    m = tp.binding_matrix(spark, sf).select("listing_id", "ADR").withColumn("_all", F.lit(0))
    # the rank materialises the global order so it survives an unordered compare;
    # it is computed over range partitions (no single-task window)
    r = global_positions(m, "_all", [F.col("ADR").desc_nulls_last(), F.col("listing_id")])
    return r.select("listing_id", "ADR", (F.col("gidx") + 1).alias("sort_rank"))


@q("amenity_matrix")
def _(spark, sf):
    return mx.amenity_matrix(b.b_icon_rows(spark, sf), b.BINDING_ICONS)


@q("amenity_flags")
def _(spark, sf):
    return mx.amenity_flags(tp.binding_matrix(spark, sf)).select("listing_id", *b.BINDING_ICONS)


@q("clean_matrix")
def _(spark, sf):
    m = tp.binding_matrix(spark, sf).drop("Abs_Occ_Rate", "Avail_Rate", "Occ_Rate_Based_on_Avail")
    return mx.clean_matrix(m, min_days=100)


@q("first_wins")
def _(spark, sf):
    from staylens.sources.tables import table
    return mk.first_wins(table(spark, sf, "lineitem"), "l_partkey", b.LINEITEM_ORDER)


@q("latest_wins")
def _(spark, sf):
    from staylens.sources.tables import table
    return mk.latest_wins(table(spark, sf, "lineitem"), "l_partkey", b.LINEITEM_ORDER)


@q("market_merge_audit")
def _(spark, sf):
    from staylens.sources.tables import table
    return mk.market_merge_audit(table(spark, sf, "lineitem"), "l_partkey")


# ---------------------------------------------------------------- premium (pipeline D)
from staylens.operators import packing as pk  # noqa: E402
from staylens.operators import premium as pm  # noqa: E402
from staylens.operators import prompts as pr  # noqa: E402
from staylens.functions.scalar import estimate_tokens, normalize_description, truncate_sample, word_count  # noqa: E402,E501
from staylens.sources.tables import table  # noqa: E402

OLS_FEATURES = ["capacity", "retail_price"]


def _ols_frame(spark, sf):
    feats = b.b_part_features(spark, sf).select("listing_id", "capacity", "retail_price")
    return feats.join(b.b_market(spark, sf).select("listing_id", "ADR"), "listing_id")


def _ols(spark, sf):
    frame = _ols_frame(spark, sf)
    model = pm.ols_fit(frame, "ADR", OLS_FEATURES)
    return frame, model, pm.ols_residuals(frame, model)


@q("ols_fit")
def _(spark, sf):
    _f, model, _r = _ols(spark, sf)
    return model.coefficient_df(spark).select("term", fixed_round("coefficient", 4).alias("coefficient"))


@q("ols_residuals")
def _(spark, sf):
    return _ols(spark, sf)[2].select("listing_id", fixed_round("residual", 4).alias("residual"))


@q("r_squared")
def _(spark, sf):
    return pm.r_squared(_ols(spark, sf)[2]).select("n", fixed_round("r_squared", 6).alias("r_squared"))


@q("residual_stats")
def _(spark, sf):
    return pm.residual_stats(_ols(spark, sf)[2])


@q("regression_moments")
def _(spark, sf):
    frame, feats = pm.regression_frame(_ols_frame(spark, sf), "ADR", OLS_FEATURES)
    n, _means, m = pm.regression_moments(frame, "ADR", feats)
    names = feats + ["ADR"]
    rows = [(names[i], names[j], float(m[i, j] / n)) for i in range(len(names)) for j in range(i, len(names))]
    return spark.createDataFrame(rows, "row_term string, col_term string, covariance double") \
        .select("row_term", "col_term", fixed_round("covariance", 3).alias("covariance"))


@q("complete_rows_filter")
def _(spark, sf):
    return pm.complete_rows_filter(b.b_part_features(spark, sf), ["capacity", "bedrooms"]) \
        .select("listing_id", "capacity", "bedrooms")


@q("top_bottom_premium")
def _(spark, sf):
    return pm.top_bottom_premium(_ols(spark, sf)[2]).select(
        "side", "rank", "listing_id", fixed_round("residual", 4).alias("residual"))


@q("premium_analysis")
def _(spark, sf):
    _frame, model, res = _ols(spark, sf)
    return _premium_record(pm.r_squared(res), pm.residual_stats(res), len(model.features))


def _premium_record(r2, st, p):
    """One record from two one-row aggregates: tagged union + one global agg (no join)."""
    tagged = r2.select(F.col("n").alias("n_properties"), F.col("r_squared"),
                       *[F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", "max")]) \
        .unionByName(st.select(F.lit(None).cast("long").alias("n_properties"),
                               F.lit(None).cast("double").alias("r_squared"), "mean", "std", "min", "max"))
    return tagged.groupBy().agg(fixed_round(F.max("r_squared"), 4).alias("r_squared"),
                                F.lit(p).alias("n_features"), F.max("n_properties").alias("n_properties"),
                                F.max("mean").alias("mean"), F.max("std").alias("std"),
                                F.max("min").alias("min"), F.max("max").alias("max"))


# ---------------------------------------------------------------- description scores
SCORE_DIMS = ["quality", "toxic", "word_count"]


def _premium(spark, sf):
    """Pipeline D over the clean matrix: every numeric column is a feature (two of them are the same)."""
    from staylens.plans.premium import premium_pipeline
    matrix = tp.binding_matrix(spark, sf).drop("Abs_Occ_Rate", "Avail_Rate", "Occ_Rate_Based_on_Avail")
    clean = mx.clean_matrix(mk.has_market_data_filter(matrix), min_days=100)
    return premium_pipeline(clean, b.b_scores(spark, sf), SCORE_DIMS)


def _flat_record(rec):
    """The nested record as plain columns."""
    corr = F.transform("dimension_correlations", lambda x: F.concat(
        x["dimension"], F.lit("="), F.format_string("%.4f", x["correlation"]), F.lit(" n="), x["n"].cast("string")))
    return rec.select("zipcode", "analysis_type", "regression_r_squared",
                      F.array_join("regression_features_used", ",").alias("regression_features_used"),
                      "num_properties_analyzed", "num_descriptions_scored",
                      F.array_join("score_dimensions", ",").alias("score_dimensions"),
                      F.array_join(corr, ";").alias("dimension_correlations"), "residual_stats.*")


@q("premium_pipeline")
def _(spark, sf):
    return _flat_record(_premium(spark, sf)["record"])


@q("premium_pipeline_lists")
def _(spark, sf):
    return _premium(spark, sf)["top_bottom"].select("side", "rank", "listing_id", fixed_round("residual", 4).alias("residual"))


@q("dimension_correlation")
def _(spark, sf):
    return pm.dimension_correlation(b.b_scores(spark, sf), b.b_residuals(spark, sf), dimensions=SCORE_DIMS) \
        .select("dimension", "correlation", "n", "rank")


@q("rank_by_abs_correlation")
def _(spark, sf):
    return pm.dimension_correlation(b.b_scores(spark, sf), b.b_residuals(spark, sf), dimensions=SCORE_DIMS) \
        .select("rank", "dimension")


@q("join_score_residual")
def _(spark, sf):
    j = pr.join_score_residual(b.b_scores(spark, sf), b.b_residuals(spark, sf))
    return j.select("listing_id", *SCORE_DIMS, fixed_round("residual", 4).alias("residual"))


@q("id_intersection")
def _(spark, sf):
    return pr.id_intersection(b.b_scores(spark, sf), b.b_residuals(spark, sf))


@q("word_count")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", word_count("text").alias("word_count"))


@q("join_residual_description")
def _(spark, sf):
    j = b.b_residuals(spark, sf).join(b.b_descriptions(spark, sf), "listing_id")
    return j.select("listing_id", fixed_round("residual", 4).alias("residual"),
                    F.length("description").alias("description_chars"))


@q("join_topk_scores")
def _(spark, sf):
    from staylens.plans.common import reuse
    tb = pm.top_bottom_premium(reuse(b.b_residuals(spark, sf)))  # read by both top-k branches
    j = pr.join_topk_scores(tb, b.b_scores(spark, sf), b.b_descriptions(spark, sf))
    return j.select("side", "rank", "listing_id", *SCORE_DIMS, F.length("description").alias("description_chars"))


@q("sample_tier_descriptions")
def _(spark, sf):
    samples = tr.tier_sample(_tiers(spark, sf)["tiered"], k=3)
    return pr.sample_descriptions(samples, b.b_descriptions(spark, sf), k=3)


from staylens.plans.templates import SCORE_TEMPLATE  # noqa: E402


@q("description_score_prompts")
def _(spark, sf):
    return pr.description_score_prompts(b.b_residuals(spark, sf), b.b_descriptions(spark, sf), SCORE_TEMPLATE)


@q("fill_template")
def _(spark, sf):
    d = table(spark, sf, "documents")
    from staylens.functions.scalar import fill_template
    t = fill_template("Area {ZIP_CODE_HERE} ({ISO_CODE_HERE}) listing {PROPERTY_ID}: {DESCRIPTION}",
                      {"ZIP_CODE_HERE": F.col("source"), "ISO_CODE_HERE": F.col("lang"),
                       "PROPERTY_ID": F.col("doc_id"), "DESCRIPTION": F.col("text")})
    return d.select(F.col("doc_id").alias("listing_id"), t.alias("prompt"))


@q("normalize_description")
def _(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("listing_id"),
                    normalize_description(F.split("text", "\n")).alias("description"))


@q("truncate_sample")
def _(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("listing_id"), truncate_sample("text").alias("sample"))


@q("parse_score_json")
def _(spark, sf):
    lab = table(spark, sf, "labels")
    txt = F.concat(F.lit('```json {"quality":'), F.col("quality").cast("string"), F.lit(',"toxic":'),
                   F.col("toxic").cast("string"), F.lit("} ```"))
    return pr.parse_score_json(lab.select(F.col("doc_id").alias("listing_id"), txt.alias("response")))


@q("synthesis_prompt")
def _(spark, sf):
    from staylens.plans.common import reuse
    # both feed several branches (correlation, r2, top / bottom, score join)
    scores, res = reuse(b.b_scores(spark, sf)), reuse(b.b_residuals(spark, sf))
    corr = pm.dimension_correlation(scores, res, dimensions=SCORE_DIMS)
    # the residual table is a mean-only fit of n_chars: its r-squared comes from the data
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("listing_id"),
                                                F.col("n_chars").cast("double").alias("actual"))
    r2 = pm.r_squared(docs.join(res, "listing_id"))
    tb = pm.top_bottom_premium(res)
    topk = pr.join_topk_scores(tb, scores, b.b_descriptions(spark, sf))
    tmpl = ("Area {ZIPCODE}: R2={R_SQUARED} over {NUM_PROPERTIES} properties\n\n{CORRELATION_TABLE}\n\n"
            "Top:\n{HIGH_PREMIUM_DESCRIPTIONS}\n\nBottom:\n{LOW_PREMIUM_DESCRIPTIONS}")
    return pr.synthesis_prompt(r2, corr, topk, tmpl, SCORE_DIMS)


# ---------------------------------------------------------------- review packing (pipeline B)
from staylens.plans.templates import BASE_PROMPT  # noqa: E402
TIGHT_LIMIT = 100  # the reference's own small-limit chunking case


def _review_items(spark, sf):
    r = b.b_reviews(spark, sf)
    return r.withColumn("text", F.col("review"))


@q("chunk_reviews")
def _(spark, sf):
    pt = len(BASE_PROMPT) // 4
    return pk.chunk_reviews(_review_items(spark, sf), "listing_id", b.LINEITEM_ORDER, "text", pt)


@q("chunk_reviews_tight")
def _(spark, sf):
    pt = len(BASE_PROMPT) // 4
    return pk.chunk_reviews(_review_items(spark, sf), "listing_id", b.LINEITEM_ORDER, "text", pt, TIGHT_LIMIT)


@q("chunk_reviews_hot")
def _(spark, sf):
    """A third of all reviews on one listing."""
    items = _review_items(spark, sf).withColumn(
        "listing_id", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("listing_id")).cast("long"))
    return pk.chunk_reviews(items, "listing_id", b.LINEITEM_ORDER, "text", len(BASE_PROMPT) // 4, TIGHT_LIMIT)


@q("needs_chunking")
def _(spark, sf):
    return pk.needs_chunking(_review_items(spark, sf), prompt_tokens=len(BASE_PROMPT) // 4, limit=TIGHT_LIMIT)


@q("review_numbering")
def _(spark, sf):
    ch = pk.chunk_reviews(_review_items(spark, sf), "listing_id", b.LINEITEM_ORDER, "text",
                          len(BASE_PROMPT) // 4, TIGHT_LIMIT)
    return pk.review_numbering(ch).select("listing_id", "chunk_no", "item_no", "numbered")


@q("chunk_prompt")
def _(spark, sf):
    pt = len(BASE_PROMPT) // 4
    ch = pk.chunk_reviews(_review_items(spark, sf), "listing_id", b.LINEITEM_ORDER, "text", pt, TIGHT_LIMIT)
    return pk.chunk_prompt(ch, BASE_PROMPT, prompt_tokens=pt, limit=TIGHT_LIMIT)


def _partials(spark, sf):
    """All turns; each conversation's turns of a role are the partial analyses of one listing."""
    return table(spark, sf, "conversations").select(
        F.concat_ws("/", F.col("conv_id").cast("string"), "role").alias("listing_id"), F.col("turn").alias("chunk_no"),
        F.col("text").alias("summary"))


@q("merge_prompt")
def _(spark, sf):
    return pk.merge_prompt(_partials(spark, sf), BASE_PROMPT)


@q("merge_prompt_groups")
def _(spark, sf):
    """At most three consecutive chunks per request."""
    return pk.merge_prompt(_partials(spark, sf), BASE_PROMPT, max_parts=3)


# ---------------------------------------------------------------- costs
from staylens.operators import costs as cs  # noqa: E402
from staylens.operators import freshness as fr  # noqa: E402
from staylens.operators import grid as gd  # noqa: E402


def _costed(spark, sf):
    return cs.request_costs(b.b_requests(spark, sf))


@q("estimate_tokens")
def _(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", estimate_tokens("text").alias("tokens"))


@q("request_cost")
def _(spark, sf):
    return _costed(spark, sf).select("session", "listing_id", "turn", "input_tokens", "output_tokens", "cost")


@q("request_cost_session")
def _(spark, sf):
    return cs.request_cost_session(_costed(spark, sf))


def _event_sessions(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy(F.col("user_id").alias("session")).agg(
        F.min("ts").alias("session_start"), (F.sum("value") / 1000.0).alias("total_cost"),
        F.count_distinct("event_type").alias("listings"), F.count(F.lit(1)).alias("total_requests"))


AS_OF = "2024-01-31 00:00:00"
TTL_HOURS = 72


@q("historical_cost")
def _(spark, sf):
    return cs.historical_cost(_event_sessions(spark, sf), AS_OF, days=30)


@q("last_n_sessions")
def _(spark, sf):
    """Sessions by the hundreds of their id: many share a place, the id decides."""
    s = b.b_requests(spark, sf).groupBy(F.col("listing_id").alias("session")).agg(
        F.count(F.lit(1)).alias("n_requests")).withColumn("start", F.floor(F.col("session") / 100))
    return cs.last_n_sessions(s, "start", 100, tie="session")


# ---------------------------------------------------------------- freshness
STAGES = ["click", "error", "purchase", "signup", "view"]


def _users(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("listing_id"))


@q("is_fresh")
def _(spark, sf):
    return fr.with_freshness(b.b_manifest(spark, sf), AS_OF, TTL_HOURS).select("stage", "listing_id", "fresh")


@q("expected_outputs")
def _(spark, sf):
    return fr.expected_outputs(_users(spark, sf), STAGES)


@q("missing_outputs")
def _(spark, sf):
    exp = fr.expected_outputs(_users(spark, sf), STAGES)
    return fr.missing_outputs(exp, b.b_manifest(spark, sf), AS_OF, TTL_HOURS)


@q("stage_freshness")
def _(spark, sf):
    """Also asks for a stage that has no expected output: it is not fresh."""
    exp = fr.expected_outputs(_users(spark, sf), STAGES)
    groups = table(spark, sf, "region").select(F.explode(F.array(*[F.lit(s) for s in [*STAGES, "report"]])).alias("stage"))
    return fr.stage_freshness(exp, b.b_manifest(spark, sf), AS_OF, TTL_HOURS, groups=groups)


def _by_rule(spark, sf):
    return fr.expected_by_rule(b.b_stage_areas(spark, sf), b.b_stage_sources(spark, sf))


@q("expected_outputs_by_rule")
def _(spark, sf):
    return _by_rule(spark, sf)


@q("missing_outputs_by_rule")
def _(spark, sf):
    return fr.missing_outputs(_by_rule(spark, sf), b.b_stage_manifest(spark, sf), AS_OF, TTL_HOURS, key="output") \
        .select("stage", "area", "listing_id", "output")


@q("stage_freshness_by_area")
def _(spark, sf):
    """Every stage of every area, also of the one where no listing was found."""
    groups = b.b_stage_areas(spark, sf).select("area", F.explode(F.array(*[F.lit(s) for s in fr.STAGES])).alias("stage"))
    return fr.stage_freshness(_by_rule(spark, sf), b.b_stage_manifest(spark, sf), AS_OF, TTL_HOURS, key="output", groups=groups) \
        .select("stage", "area", "expected", "fresh_outputs", "stage_fresh")


def _per_stage(df, *cols):
    return df.select(F.explode(F.array(*[F.lit(s) for s in STAGES])).alias("stage"), *cols)


@q("unprocessed_or_stale")
def _(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("user_id").alias("listing_id"))
    return fr.unprocessed_or_stale(_per_stage(ev, "event_id", "listing_id"), b.b_manifest(spark, sf), AS_OF, TTL_HOURS,
                                   key=["stage", "listing_id"]).select("stage", "event_id", "listing_id")


def _listing_universe(spark, sf):
    """Every listing id the area has (customers), once per stage; event users have outputs."""
    return _per_stage(table(spark, sf, "customer"), F.col("c_custkey").alias("listing_id"))


@q("resolved_prescan")
def _(spark, sf):
    return fr.resolved_prescan(_listing_universe(spark, sf), b.b_manifest(spark, sf), ["stage", "listing_id"])


@q("id_difference")
def _(spark, sf):
    return fr.id_difference(_listing_universe(spark, sf), b.b_manifest(spark, sf), ["stage", "listing_id"])


@q("coverage_gate")
def _(spark, sf):
    exp = fr.expected_outputs(_users(spark, sf), STAGES)
    done = fr.with_freshness(b.b_manifest(spark, sf), AS_OF, TTL_HOURS).where("fresh")
    return fr.coverage_gate(exp, done, fr.REVIEW_RETRY_THRESHOLD).select(
        "stage", "total", "missing", fixed_round("missing_rate", 6).alias("missing_rate"), "retry")


# ---------------------------------------------------------------- grid
GRID_HALF = 140.0  # binding coordinates are milli-degrees


def _cells(spark, sf):
    return gd.bbox_grid(gd.area_bbox(b.b_centroids(spark, sf), half_width=GRID_HALF))


def _hits(spark, sf):
    return gd.grid_range_join(b.b_grid(spark, sf), _cells(spark, sf))


@q("area_bbox")
def _(spark, sf):
    return gd.area_bbox(b.b_centroids(spark, sf), half_width=GRID_HALF)


@q("bbox_grid")
def _(spark, sf):
    return _cells(spark, sf).select("area", "cell_no", "cell_row", "cell_col",
                                    *[fixed_round(c, 7).alias(c) for c in
                                      ("box_sw_lat", "box_sw_lon", "box_ne_lat", "box_ne_lon")])


@q("grid_range_join")
def _(spark, sf):
    return _hits(spark, sf).select("listing_id", "area", "cell_no")


@q("grid_range_join_fine")
def _(spark, sf):
    """A grid of 16 x 16 cells per area."""
    cells = gd.bbox_grid(gd.area_bbox(b.b_centroids(spark, sf), half_width=GRID_HALF), 16)
    return gd.grid_range_join(b.b_grid(spark, sf), cells, 16).select("listing_id", "area", "cell_no")


@q("grid_saturation")
def _(spark, sf):
    return gd.grid_saturation(_hits(spark, sf), threshold=15)


@q("union_cells")
def _(spark, sf):
    from staylens.plans.common import reuse
    hits = reuse(_hits(spark, sf).select("listing_id", "area", "cell_no"))  # read once per cell
    parts = [hits.where(F.col("cell_no") == k) for k in range(gd.GRID_DIMENSIONS ** 2)]
    return gd.union_cells(*parts)


# ---------------------------------------------------------------- market page text
@q("extract_kpis")
def _(spark, sf):
    k = mk.extract_kpis(b.b_page_text(spark, sf))
    return k.select("listing_id", fixed_round("Revenue", 2).alias("Revenue"), "ADR", "Occupancy",
                    "Days_Available")


@q("extract_header")
def _(spark, sf):
    return mk.extract_header(b.b_page_text(spark, sf)).select(
        "listing_id", "Rating", "Review_Count", "Bedrooms", "Bathrooms", "Max_Guests")


def _kpi_strings(spark, sf):
    t = F.col("page_text")
    return b.b_page_text(spark, sf).select(
        "listing_id",
        F.regexp_extract(t, mk.KPI_REVENUE, 1).alias("rev_s"), F.regexp_extract(t, mk.KPI_ADR, 1).alias("adr_s"),
        F.regexp_extract(t, mk.KPI_OCCUPANCY, 1).alias("occ_s"), F.regexp_extract(t, mk.KPI_DAYS, 1).alias("days_s"),
        F.regexp_extract(F.substring(t, 1, mk.HEADER_CHARS), mk.HDR_BATH, 1).alias("bath_s"))


@q("parse_currency")
def _(spark, sf):
    from staylens.functions.scalar import parse_currency
    return _kpi_strings(spark, sf).select("listing_id", "adr_s", parse_currency("adr_s").alias("value"))


@q("parse_revenue")
def _(spark, sf):
    from staylens.functions.scalar import parse_revenue
    return _kpi_strings(spark, sf).select("listing_id", "rev_s", fixed_round(parse_revenue("rev_s"), 2).alias("value"))


@q("parse_percentage")
def _(spark, sf):
    from staylens.functions.scalar import parse_percentage
    return _kpi_strings(spark, sf).select("listing_id", "occ_s", parse_percentage("occ_s").alias("value"))


@q("parse_days")
def _(spark, sf):
    from staylens.functions.scalar import parse_days
    return _kpi_strings(spark, sf).select("listing_id", "days_s", parse_days("days_s").alias("value"))


@q("parse_decimal")
def _(spark, sf):
    from staylens.functions.scalar import parse_decimal
    return _kpi_strings(spark, sf).select("listing_id", "bath_s", parse_decimal("bath_s").alias("value"))


@q("listing_link")
def _(spark, sf):
    from staylens.functions.scalar import listing_link
    return table(spark, sf, "part").select(F.col("p_partkey").alias("listing_id"),
                                           listing_link("p_partkey").alias("link"))


# ---------------------------------------------------------------- listing details -> matrix (pipeline A)
from staylens.sources import files as fl  # noqa: E402
from staylens.session import scratch_path  # noqa: E402


def _details(spark, sf):
    return b.b_details(spark, sf)


def _metrics_str(spark, sf):
    return b.b_market(spark, sf).withColumn("listing_id", F.col("listing_id").cast("string"))


@q("read_listing_details")
def _(spark, sf):
    """Derived details as JSON lines in the shared scratch folder, read back."""
    path = scratch_path(spark, "details")
    b.b_details(spark, sf).select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
    d = fl.read_listing_details(spark, path, lines=True)
    return d.select("listing_id", "room_type", "person_capacity", "title",
                    F.size(F.flatten(F.transform("amenities", lambda g: g["values"]))).alias("n_amenity_icons"),
                    fl.normalize_description_value(F.col("description")).alias("description"))


@q("amenity_long")
def _(spark, sf):
    return mx.amenity_long(_details(spark, sf))


@q("parse_sub_description")
def _(spark, sf):
    sub = mx.parse_sub_description()
    return _details(spark, sf).select("listing_id", *[sub[c].alias(c) for c in ("bedrooms", "beds", "bathrooms")])


@q("entire_home_filter")
def _(spark, sf):
    return mk.entire_home_filter(_details(spark, sf)).select("listing_id", "is_entire_home")


@q("house_rules_text")
def _(spark, sf):
    return mx.parse_details(_details(spark, sf)).select("listing_id", "house_rules")


@q("neighborhood_highlight")
def _(spark, sf):
    return mx.parse_details(_details(spark, sf)).select("listing_id", "neighborhood_highlight")


def _built(spark, sf):
    return mx.build_matrix(_details(spark, sf), _metrics_str(spark, sf), b.BINDING_ICONS,
                           rating_keys=["guest_satisfaction"])


@q("build_matrix")
def _(spark, sf):
    return _built(spark, sf)


@q("drop_columns")
def _(spark, sf):
    return mx.drop_columns(_built(spark, sf))


@q("fill_missing")
def _(spark, sf):
    m = mx.drop_columns(_built(spark, sf))
    return mx.fill_missing(m, ["bedrooms", "beds", "bathrooms", *b.BINDING_ICONS])


@q("clean_built_matrix")
def _(spark, sf):
    return mx.clean_matrix(_built(spark, sf), min_days=100)


@q("read_market_metrics")
def _(spark, sf):
    path = scratch_path(spark, "metrics")
    m = b.b_market(spark, sf)
    doc = F.to_json(F.create_map(F.col("listing_id").cast("string"),
                                 F.struct("ADR", "Occupancy", "Revenue", "Days_Available")))
    m.select(doc.alias("value")).write.mode("overwrite").text(path)
    r = fl.read_market_metrics(spark, path, glob=None, wholetext=False)
    return r.select("listing_id", "ADR", "Occupancy", fixed_round("Revenue", 2).alias("Revenue"), "Days_Available")


@q("read_descriptions")
def _(spark, sf):
    path = scratch_path(spark, "descriptions")
    d = b.b_details(spark, sf)
    doc = F.to_json(F.create_map(F.col("listing_id"), F.col("description")))
    d.select(doc.alias("value")).write.mode("overwrite").text(path)
    return fl.read_descriptions(spark, path, wholetext=False)


# ---------------------------------------------------------------- review / area packs, labels, streams
from staylens.plans import reviews as rp  # noqa: E402
from staylens.streaming import incremental as st  # noqa: E402


@q("review_pack")
def _(spark, sf):
    areas = table(spark, sf, "part").select(F.col("p_partkey").alias("listing_id"), F.col("p_type").alias("area"))
    return rp.review_pack(b.b_reviews(spark, sf), b.LINEITEM_ORDER, areas)


@q("review_pack_tight")
def _(spark, sf):
    """A limit that cuts listings into several requests."""
    areas = table(spark, sf, "part").select(F.col("p_partkey").alias("listing_id"), F.col("p_type").alias("area"))
    return rp.review_pack(b.b_reviews(spark, sf), b.LINEITEM_ORDER, areas, limit=80)


@q("area_prompts_tight")
def _(spark, sf):
    """A limit that cuts areas into several requests, and summaries longer than it."""
    overall = rv.overall_mean_rating(b.b_reviews(spark, sf)).first()["overall_mean"]
    return rp.area_prompts(b.b_summaries(spark, sf), overall, limit=1000)


@q("area_summary_pack")
def _(spark, sf):
    return pr.area_summary_pack(b.b_summaries(spark, sf)).select(
        "area", "pack_pos", "listing_id", "n_properties", "rendered")


@q("area_prompts")
def _(spark, sf):
    overall = rv.overall_mean_rating(b.b_reviews(spark, sf)).first()["overall_mean"]
    return rp.area_prompts(b.b_summaries(spark, sf), overall)


@q("threshold_label")
def _(spark, sf):
    from staylens.functions.scalar import threshold_label
    th = _tiers(spark, sf)["thresholds"]
    unit = F.when(F.col("metric") == "adr", threshold_label("high_threshold", "$")) \
        .otherwise(threshold_label("high_threshold", "%"))
    lunit = F.when(F.col("metric") == "adr", threshold_label("low_threshold", "$")) \
        .otherwise(threshold_label("low_threshold", "%"))
    return th.select("metric", unit.alias("high_label"), lunit.alias("low_label"))


def _review_feed(spark, sf):
    """Reviews in one file per month of the ship date; months arrive in three
    steps that do not follow their order, so files overwrite or come too late."""
    r = b.b_reviews(spark, sf).withColumn("file", F.date_format("l_shipdate", "yyyy-MM"))
    month = F.year("l_shipdate") * 12 + F.month("l_shipdate")
    return r.withColumn("arrival", (month * 5 % 3).cast("int"))


@q("stream_review_ratings")
def _(spark, sf):
    return st.stream_review_ratings(spark, _review_feed(spark, sf))[1]


@q("stream_overall_mean")
def _(spark, sf):
    """The mean over all listings from the stream's updates and retractions."""
    return st.running_overall_mean(st.stream_review_ratings(spark, _review_feed(spark, sf))[0])


def _request_feed(spark, sf):
    """Requests in four arrivals by time; every seventh conversation's come one arrival late."""
    c = _costed(spark, sf)
    lo, hi = c.agg(F.min(F.unix_timestamp("ts")), F.max(F.unix_timestamp("ts"))).first()
    step = F.floor((F.unix_timestamp("ts") - F.lit(lo)) * 4 / F.lit(hi - lo + 1 if hi else 1))
    return c.withColumn("arrival", F.least(F.lit(3), step + F.when(F.col("listing_id") % 7 == 0, 1).otherwise(0)).cast("int"))


@q("stream_request_cost")
def _(spark, sf):
    return st.stream_request_cost(spark, _request_feed(spark, sf), "20 minutes", "1 hour", "arrival", 4, "append")


# ---------------------------------------------------------------- sources / sinks round trips
from staylens.sources import sinks as sk  # noqa: E402


@q("read_search_results")
def _(spark, sf):
    path = scratch_path(spark, "search")
    g = b.b_grid(spark, sf)
    rid = F.when(F.col("listing_id") % 4 == 0, F.lit("")).otherwise(F.col("listing_id").cast("string"))
    g.select("area", rid.alias("room_id"), F.col("listing_id").cast("string").alias("id"), "lat", "lon") \
        .write.mode("overwrite").partitionBy("area").json(path)
    return fl.read_search_results(spark, path, lines=True)


@q("read_summaries")
def _(spark, sf):
    path = scratch_path(spark, "summaries")
    s = b.b_summaries(spark, sf)
    s.select("area", F.to_json(F.create_map(F.col("listing_id").cast("string"), F.col("summary"))).alias("value")) \
        .write.mode("overwrite").partitionBy("area").text(path)
    r = fl.read_summaries(spark, path, glob="*.txt", wholetext=False)
    return r.select("area", "listing_id", F.length("summary").alias("summary_chars"))


@q("write_matrix")
def _(spark, sf):
    path = scratch_path(spark, "matrix")
    sk.write_matrices(_built(spark, sf), path)
    return fl.read_matrix(spark, f"{path}/clean")


@q("read_matrix")
def _(spark, sf):
    path = scratch_path(spark, "matrix-csv")
    raw = _built(spark, sf).select("listing_id", "ADR", "Days_Avail", "capacity", "bedrooms", *b.BINDING_ICONS)
    sk.write_matrix(raw, raw, path, fmt="csv")
    return fl.read_matrix(spark, f"{path}/raw", schema=raw.schema, fmt="csv")


@q("write_side_tables")
def _(spark, sf):
    path = scratch_path(spark, "side")
    sk.write_side_tables(_details(spark, sf), path)
    return sk.read_side_tables(spark, path)


@q("write_summaries")
def _(spark, sf):
    path = scratch_path(spark, "summaries-out")
    sk.write_summaries(b.b_summaries(spark, sf), path)
    back = fl.read_summaries(spark, path, glob="*", wholetext=False)
    return back.select("area", "listing_id", F.length("summary").alias("summary_chars"), F.md5("summary").alias("summary_md5"))


@q("render_area_report")
def _(spark, sf):
    """Each area's response stands in by its first non-empty summary."""
    path = scratch_path(spark, "area-reports")
    s = b.b_summaries(spark, sf)
    filled = rv.empty_summary_filter(s)
    counts = filled.groupBy("area").agg(F.count(F.lit(1)).alias("n_properties"))
    responses = filled.groupBy("area").agg(F.min_by("summary", "listing_id").alias("response"))
    sk.render_report(rp.area_report_markdown(responses, counts), path, ("area",), "report")
    back = spark.read.text(path, wholetext=True)
    return back.select("area", F.regexp_replace("value", "\n$", "").alias("report"))


@q("write_market_master")
def _(spark, sf):
    path = scratch_path(spark, "market")
    m = b.b_market(spark, sf).join(table(spark, sf, "part").select(F.col("p_partkey").alias("listing_id"),
                                                                    F.col("p_type").alias("area")), "listing_id")
    sk.write_market_master(m, path)
    r = spark.read.parquet(path)
    return r.select("area", "listing_id", "ADR", "Occupancy", "Days_Available")


@q("write_reviews")
def _(spark, sf):
    path = scratch_path(spark, "reviews")
    r = b.b_reviews(spark, sf).join(table(spark, sf, "part").select(F.col("p_partkey").alias("listing_id"),
                                                                     F.col("p_type").alias("area")), "listing_id")
    sk.write_by_area(r.select("area", "listing_id", "rating", "review"), path)
    back = spark.read.parquet(path)
    return rv.listing_mean_rating(back, by="area")


@q("write_tier_stats")
def _(spark, sf):
    path = scratch_path(spark, "tier-stats")
    rec = tp.tier_record(_tiers(spark, sf), metric_columns=tp.BINDING_METRICS)
    sk.write_json_record(rec, path)
    back = spark.read.schema(rec.schema).json(path)

    def text(col, name, hi, lo):
        return F.array_join(F.transform(col, lambda x: F.concat_ws(
            ":", x[name], x[hi].cast("string"), x[lo].cast("string"), x["difference"].cast("string"))), ";").alias(col)
    return back.select("zipcode", "metric", "metric_column", "high_tier_threshold", "low_tier_threshold",
                       "high_tier_count", "low_tier_count", "top_percentile", "bottom_percentile",
                       text("amenity_comparison", "amenity", "high_tier_pct", "low_tier_pct"),
                       text("numeric_comparison", "attribute", "high_tier_avg", "low_tier_avg"))


@q("write_quality_stats")
def _(spark, sf):
    path = scratch_path(spark, "quality-stats")
    rec = _premium(spark, sf)["record"]
    sk.write_json_record(rec, path)
    return _flat_record(spark.read.schema(rec.schema).json(path))


@q("render_report")
def _(spark, sf):
    path = scratch_path(spark, "reports")
    rep = tp.tier_report_markdown(tp.tier_report(_tiers(spark, sf), metric_columns=tp.BINDING_METRICS), "all")
    sk.render_report(rep, path, ("metric",), "report")
    back = spark.read.text(path, wholetext=True)
    return back.select("metric", F.regexp_replace("value", "\n$", "").alias("report"))


@q("write_request_log")
def _(spark, sf):
    path = scratch_path(spark, "request-log")
    sessions = _event_sessions(spark, sf).withColumn("session_start", F.date_trunc("day", "session_start"))
    sk.write_request_log(sessions, path)
    return sk.read_request_log(spark, path, "session_start", 100, tie="session").select("session", "recency")


@q("normalize_reviews")
def _(spark, sf):
    return rv.normalize_reviews(b.b_review_records(spark, sf)).select(
        "listing_id", "l_orderkey", "l_linenumber", "review", "rating")


@q("read_reviews")
def _(spark, sf):
    path = scratch_path(spark, "review-documents")
    b.b_review_documents(spark, sf).write.partitionBy("file").text(path)
    return fl.read_reviews(spark, path, glob=None, wholetext=False).select("listing_id", "pos", "review", "rating")


@q("missing_file")
def _(spark, sf):
    """Every reader over a path that does not exist: empty, with its columns."""
    path = scratch_path(spark, "nothing")
    readers = {"search_results": fl.read_search_results, "listing_details": fl.read_listing_details,
               "market_metrics": fl.read_market_metrics, "reviews": fl.read_reviews, "summaries": fl.read_summaries,
               "descriptions": fl.read_descriptions, "matrix": fl.read_matrix}
    regions = table(spark, sf, "region")
    out = None
    for name, read in readers.items():
        got = read(spark, path)
        n = regions.select(F.lit(name).alias("source"), F.lit("listing_id" in got.columns).alias("has_key")) \
            .join(got.select(F.lit(name).alias("source"), F.lit(1).alias("row")), "source", "left") \
            .groupBy("source", "has_key").agg(F.count("row").alias("rows"))
        out = n if out is None else out.unionByName(n)
    return out


@q("select_numeric_features")
def _(spark, sf):
    clean = mx.clean_matrix(_built(spark, sf), 100)
    feats = mx.select_numeric_features(clean, "ADR", exclude=["listing_id"])
    return clean.select("listing_id", *feats)


@q("tier_thresholds_by_area")
def _(spark, sf):
    m = mk.has_market_data_filter(tp.binding_matrix(spark, sf))
    th = tr.tier_thresholds(m, tp.BINDING_METRICS, by="area")
    counts = tr.tier_counts(tr.tier_assign(m, tp.BINDING_METRICS, th, by="area"), by="area")
    return th.join(counts, ["area", "metric"]).select(
        "area", "metric", fixed_round("high_threshold", 6).alias("high_threshold"),
        fixed_round("low_threshold", 6).alias("low_threshold"), "n_valid", "tier", "n")


@q("overall_mean_rating_by_area")
def _(spark, sf):
    areas = table(spark, sf, "part").select(F.col("p_partkey").alias("listing_id"), F.col("p_type").alias("area"))
    return rv.overall_mean_rating(b.b_reviews(spark, sf).join(areas, "listing_id"), by="area")


@q("extract_kpis_pages")
def _(spark, sf):
    """The page-text job over raw pages: tags stripped, whole pages scanned."""
    p = table(spark, sf, "pages").select(F.col("page_id").alias("listing_id"),
                                         F.regexp_replace("html", "<[^>]+>", " ").alias("page_text"))
    k = mk.extract_header(mk.extract_kpis(p))
    return k.select("listing_id", fixed_round("Revenue", 2).alias("Revenue"), "ADR", "Occupancy", "Days_Available",
                    "Rating", "Review_Count", "Bedrooms", "Bathrooms", "Max_Guests")


@q("tier_insight_prompts")
def _(spark, sf):
    from staylens.plans.templates import INSIGHT_TEMPLATE
    res = _tiers(spark, sf)
    rep = tp.tier_report(res, metric_columns=tp.BINDING_METRICS, raw_thresholds=True)
    samples = pr.sample_descriptions(tr.tier_sample(res["tiered"], k=3), b.b_descriptions(spark, sf), k=3)
    return tp.tier_insight_prompts(rep, samples, INSIGHT_TEMPLATE, "all")


@q("render_quality_report")
def _(spark, sf):
    from staylens.plans import premium as pp
    frame, model, res = _ols(spark, sf)
    from staylens.plans.common import reuse
    res = reuse(res)  # read by r2, top/bottom and the scored count
    scored = pr.join_score_residual(b.b_scores(spark, sf), res.select("listing_id")).agg(
        F.count(F.lit(1)).alias("n_scored"))
    corr = pm.dimension_correlation(b.b_scores(spark, sf), b.b_residuals(spark, sf), dimensions=SCORE_DIMS)
    body = corr.select(F.col("rank").alias("o"), F.format_string("| %s | %+.3f | %d |", F.col("dimension"),
                                                                  fixed_round("correlation", 3), F.col("n")).alias("t"))
    path = scratch_path(spark, "quality-report")
    rep = pp.quality_report_markdown(pm.r_squared(res), pm.top_bottom_premium(res), scored, model.features, "all",
                                     body)
    sk.render_report(rep.withColumn("name", F.lit("description_quality")), path, ("name",), "report")
    back = spark.read.text(path, wholetext=True)
    return back.select(F.regexp_replace("value", "\n$", "").alias("report"))
