"""DuckDB SQL twins of the registered queries (the correctness oracle).

Every statement reads only the driver's pre-registered views and spells out
the same semantics as the Spark operator; computed columns carry the same
aliases.  ``R(x, n)`` is the shared half-up decimal rounding.
"""

from __future__ import annotations

# ---------------------------------------------------------------- texts and patterns the queries are checked against
LISTING_URL_PREFIX = "https://www.airbnb.com/rooms/"
SCORE_TEMPLATE = ("Score the description of property {PROPERTY_ID}.\n"
                  "\n"
                  "Description:\n"
                  "{DESCRIPTION}\n"
                  "\n"
                  "Return JSON.")
BASE_PROMPT = "Summarize what guests say about this listing in five sections."
INSIGHT_TEMPLATE = ("Area {ZIPCODE}: listings at or above {HIGH_THRESHOLD} (top {TOP_PERCENTILE}%) versus at or below "
                    "{LOW_THRESHOLD} (bottom {BOTTOM_PERCENTILE}%).\n"
                    "\n"
                    "{FEATURE_COMPARISON}\n"
                    "\n"
                    "High tier examples:\n"
                    "{HIGH_TIER_DESCRIPTIONS}\n"
                    "\n"
                    "Low tier examples:\n"
                    "{LOW_TIER_DESCRIPTIONS}")
NO_DESCRIPTIONS = "No descriptions available."
MERGE_HEAD = ("\n"
              "You have received multiple partial analyses of Airbnb reviews for the same listing. Please combine "
              "them into a single comprehensive summary following the original format requirements.\n"
              "\n"
              "Original format requirements:\n")
MERGE_TAIL = ("\n"
              "Please provide a single unified analysis that:\n"
              "1. Maintains the exact 5-section format from the original requirements\n"
              "2. Combines and reconciles the data from all partial analyses\n"
              "3. Provides accurate overall percentages and mention counts\n"
              "4. Creates a coherent final summary\n"
              "\n"
              "Unified Analysis:")
AREA_TEMPLATE = ("Summarize the listings of area {ZIP_CODE_HERE} ({ISO_CODE_HERE}); the overall mean rating is "
                 "{OVERALL_MEAN}.")
LISTING_TEMPLATE = ("Summarize the guest reviews of a listing in {ZIP_CODE_HERE} ({ISO_CODE_HERE}). The listing's mean "
                    "rating is {RATING_AVERAGE_HERE}; the area mean is {OVERALL_MEAN}.")
HDR_BATH = "(?i)(?:bath|bathroom)s?\\s*[:.]?\\s*(\\d+\\.?\\d*)"
HDR_BED = "(?i)(?:bed|bedroom)s?\\s*[:.]?\\s*(\\d+)"
HDR_GUEST = "(?i)(?:guest|max.?guest)s?\\s*[:.]?\\s*(\\d+)"
HDR_RATING = "★?\\s*([\\d.]+)\\s*\\((\\d+)\\)"
KPI_ADR = "([\\$\\d,.]+)\\s*\\n?\\s*Average Daily Rate"
KPI_DAYS = "(\\d+)\\s*\\n?\\s*Days Available"
KPI_OCCUPANCY = "(\\d+%?)\\s*\\n?\\s*Occupancy"
KPI_REVENUE = "([\\$\\d,.]+[KkMm]?)\\s*\\n?\\s*Annual Revenue"
# Python's white space, as a character class
PY_WS = '\\t\\n\\x0b\\x0c\\r\\x1c\\x1d\\x1e\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}'



def R(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


B_REVIEWS = """
  SELECT l_partkey AS listing_id,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL
              ELSE 1 + CAST(l_quantity AS INTEGER) % 5 END AS rating,
         'qty ' || CAST(l_quantity AS VARCHAR) || ' flag ' || l_returnflag AS review,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem"""

SQL: dict[str, str] = {}


def q(name: str):
    def deco(fn):
        SQL[name] = fn()
        return fn
    return deco


@q("listing_mean_rating")
def _():
    return f"""
WITH r AS ({B_REVIEWS})
SELECT listing_id, {R('SUM(COALESCE(CAST(rating AS DOUBLE), 0.0)) / COUNT(*)', 4)} AS mean_rating,
       COUNT(*) AS n_reviews
FROM r GROUP BY listing_id"""


@q("overall_mean_rating")
def _():
    return f"""
WITH r AS ({B_REVIEWS}),
per AS (SELECT listing_id, {R('SUM(COALESCE(CAST(rating AS DOUBLE), 0.0)) / COUNT(*)', 4)} AS m
        FROM r GROUP BY listing_id)
SELECT {R('AVG(m)', 4)} AS overall_mean, COUNT(*) AS n_listings FROM per"""


@q("above_mean_listings")
def _():
    return f"""
WITH r AS ({B_REVIEWS}),
per AS (SELECT listing_id, {R('SUM(COALESCE(CAST(rating AS DOUBLE), 0.0)) / COUNT(*)', 4)} AS mean_rating,
               COUNT(*) AS n_reviews FROM r GROUP BY listing_id),
o AS (SELECT {R('AVG(mean_rating)', 4)} AS overall_mean FROM per)
SELECT listing_id, mean_rating, n_reviews, overall_mean FROM per, o WHERE mean_rating > overall_mean"""


@q("review_counts")
def _():
    return f"WITH r AS ({B_REVIEWS}) SELECT listing_id, COUNT(*) AS review_count FROM r GROUP BY listing_id"


@q("min_reviews_filter")
def _():
    return f"""
WITH r AS ({B_REVIEWS}),
c AS (SELECT listing_id FROM r GROUP BY listing_id HAVING COUNT(*) >= 5)
SELECT listing_id, COUNT(*) AS n_kept, {R('SUM(COALESCE(CAST(rating AS DOUBLE), 0.0))', 4)} AS rating_sum
FROM r WHERE listing_id IN (SELECT listing_id FROM c) GROUP BY listing_id"""


@q("combined_review")
def _():
    return f"""
WITH r AS ({B_REVIEWS})
SELECT listing_id, l_orderkey, l_linenumber,
       CAST(rating AS VARCHAR) || ' ' || review AS combined_review FROM r"""


@q("limit_listings")
def _():
    return f"""
WITH r AS ({B_REVIEWS})
SELECT DISTINCT listing_id FROM r ORDER BY listing_id LIMIT 100"""


@q("empty_summary_filter")
def _():
    return """
SELECT source AS area, doc_id AS listing_id, CAST(length(text) AS INTEGER) AS summary_chars
FROM documents WHERE doc_id % 11 <> 0 AND length(text) > 0"""


@q("incomplete_summary_filter")
def _():
    return """
SELECT source AS area, doc_id AS listing_id, CAST(length(text) + 2 AS INTEGER) AS summary_chars
FROM documents WHERE doc_id % 11 <> 0 AND doc_id % 5 = 0 AND text IS NOT NULL"""


# ---------------------------------------------------------------- market / matrix / tiers
B_MARKET = f"""
  SELECT l_partkey AS listing_id,
         {R('CAST(SUM(l_extendedprice) / SUM(l_quantity) AS DECIMAL(18,8))', 2)} AS ADR,
         CAST(FLOOR(CAST(100.0 AS DOUBLE) * SUM(CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END) / COUNT(*)) AS INTEGER)
           AS Occupancy,
         {R('SUM(l_extendedprice)', 2)} AS Revenue,
         CAST(LEAST(365, 10 * COUNT(DISTINCT CAST(l_shipdate AS DATE))) AS INTEGER) AS Days_Available
  FROM lineitem GROUP BY l_partkey"""

ICONS = [f"SYSTEM_{f}_{d:02d}" for f in "ANR" for d in range(11)]


def _occ(alias: str = "") -> str:
    p = alias
    return (f"{p}Occupancy AS Occ_Rate_Based_on_Avail, {p}Days_Available AS Days_Avail, "
            f"CAST(CEIL(((CAST({p}Occupancy AS DOUBLE) / 100.0) * CAST({p}Days_Available AS DOUBLE)) * 100.0 / 365.0)"
            f" AS BIGINT) AS Abs_Occ_Rate, "
            f"{R(f'(CAST({p}Days_Available AS DOUBLE) / 365.0) * 100.0', 2)} AS Avail_Rate")


B_ICONS = """
  SELECT DISTINCT l_partkey AS listing_id, 'SYSTEM_' || l_returnflag || '_'
         || lpad(CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR), 2, '0') AS icon
  FROM lineitem"""

B_WIDE = ("SELECT listing_id, " + ", ".join(
    f"MAX(CASE WHEN icon = '{i}' THEN 'Feature ' || icon END) AS \"{i}\"" for i in ICONS)
    + f" FROM ({B_ICONS}) GROUP BY listing_id")

B_PARTF = """
  SELECT p_partkey AS listing_id, p_type AS area, p_size AS capacity,
         CASE WHEN p_size % 7 = 0 THEN 'False' ELSE CAST(CAST(FLOOR(p_size / 4) AS BIGINT) AS VARCHAR) END AS bedrooms
  FROM part"""

B_MATRIX = f"""
  SELECT pf.*, mo.* EXCLUDE (listing_id), (mo.listing_id IS NOT NULL) AS has_airdna_data,
         fw.* EXCLUDE (listing_id)
  FROM ({B_PARTF}) pf
  LEFT JOIN (SELECT m.*, {_occ('m.')} FROM ({B_MARKET}) m) mo USING (listing_id)
  LEFT JOIN ({B_WIDE}) fw USING (listing_id)"""

_ICON_COLS = ", ".join(f'"{i}"' for i in ICONS)

TIER_CTES = f"""
mat AS ({B_MATRIX}),
lng AS (SELECT listing_id, area, capacity, bedrooms, ADR, {_ICON_COLS}, 'adr' AS metric, CAST(ADR AS DOUBLE) AS value
        FROM mat WHERE has_airdna_data AND ADR > 0
        UNION ALL
        SELECT listing_id, area, capacity, bedrooms, ADR, {_ICON_COLS}, 'occupancy' AS metric,
               CAST(Occ_Rate_Based_on_Avail AS DOUBLE) AS value
        FROM mat WHERE has_airdna_data AND Occ_Rate_Based_on_Avail > 0),
th AS (SELECT metric, quantile_cont(value, 0.75) AS hi, quantile_cont(value, 0.25) AS lo, COUNT(*) AS n_valid
       FROM lng GROUP BY metric HAVING COUNT(*) >= 4),
tiered AS (SELECT lng.*, 'high' AS tier FROM lng JOIN th USING (metric) WHERE value >= hi
           UNION ALL
           SELECT lng.*, 'low' AS tier FROM lng JOIN th USING (metric) WHERE value <= lo),
st AS (SELECT metric, tier, COUNT(*) AS n,
              {", ".join(f"SUM(CASE WHEN lower(CAST({chr(34)}{i}{chr(34)} AS VARCHAR)) NOT IN ('false', '') THEN 1 ELSE 0 END) AS a{k}" for k, i in enumerate(ICONS))},
              AVG(TRY_CAST(CAST(capacity AS VARCHAR) AS DOUBLE)) AS m0,
              AVG(TRY_CAST(CAST(bedrooms AS VARCHAR) AS DOUBLE)) AS m1
       FROM tiered GROUP BY metric, tier),
hl AS (SELECT h.metric, h.n AS hn, l.n AS ln,
              {", ".join(f"h.a{k} AS ha{k}, l.a{k} AS la{k}" for k in range(len(ICONS)))},
              h.m0 AS hm0, l.m0 AS lm0, h.m1 AS hm1, l.m1 AS lm1
       FROM (SELECT * FROM st WHERE tier = 'high') h JOIN (SELECT * FROM st WHERE tier = 'low') l USING (metric)),
pv0 AS ({" UNION ALL ".join(f"SELECT metric, '{i}' AS amenity, {k} AS amenity_pos, CAST(ha{k} AS DOUBLE) / hn * 100.0 AS hp, CAST(la{k} AS DOUBLE) / ln * 100.0 AS lp FROM hl" for k, i in enumerate(ICONS))}),
pv AS (SELECT metric, amenity, amenity_pos, {R('hp', 1)} AS high_tier_pct, {R('lp', 1)} AS low_tier_pct,
              {R('hp - lp', 1)} AS difference FROM pv0),
pvr AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY metric ORDER BY abs(difference) DESC, amenity_pos) AS INTEGER) AS rank FROM pv),
nm AS (SELECT metric, 'capacity' AS attribute, 0 AS attribute_pos, {R('COALESCE(hm0, 0.0)', 2)} AS high_tier_avg,
              {R('COALESCE(lm0, 0.0)', 2)} AS low_tier_avg, {R('COALESCE(hm0, 0.0) - COALESCE(lm0, 0.0)', 2)} AS difference FROM hl
       UNION ALL
       SELECT metric, 'bedrooms', 1, {R('COALESCE(hm1, 0.0)', 2)}, {R('COALESCE(lm1, 0.0)', 2)},
              {R('COALESCE(hm1, 0.0) - COALESCE(lm1, 0.0)', 2)} FROM hl)"""


@q("tier_thresholds")
def _():
    return f"WITH {TIER_CTES} SELECT metric, {R('hi', 6)} AS high_threshold, {R('lo', 6)} AS low_threshold, n_valid FROM th"


@q("tier_assign")
def _():
    return f"WITH {TIER_CTES} SELECT listing_id, metric, tier, value FROM tiered"


@q("tier_counts")
def _():
    return f"WITH {TIER_CTES} SELECT metric, tier, COUNT(*) AS n FROM tiered GROUP BY metric, tier"


@q("amenity_prevalence")
def _():
    return f"WITH {TIER_CTES} SELECT metric, amenity, high_tier_pct, low_tier_pct, difference, rank FROM pvr"


@q("rank_by_abs_difference")
def _():
    return f"WITH {TIER_CTES} SELECT metric, rank, amenity, difference FROM pvr"


@q("top_features")
def _():
    return f"WITH {TIER_CTES} SELECT metric, rank, amenity, difference FROM pvr WHERE rank <= 15"


@q("numeric_tier_stats")
def _():
    return f"WITH {TIER_CTES} SELECT metric, attribute, high_tier_avg, low_tier_avg, difference FROM nm"


@q("tier_sample")
def _():
    return f"""WITH {TIER_CTES},
s AS (SELECT metric, tier, listing_id,
             CAST(ROW_NUMBER() OVER (PARTITION BY metric, tier ORDER BY ADR DESC NULLS LAST, listing_id) AS INTEGER) AS sample_rank
      FROM tiered)
SELECT metric, tier, sample_rank, listing_id FROM s WHERE sample_rank <= 3"""


def _initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1:1]) || w[2:]), ' ')")


def _signed(x: str, d: int, suffix: str = "") -> str:
    return f"printf('%+.{d}f{suffix}', {R(x, d)})"


COMPARISON_SQL = f"""
al AS (SELECT metric, string_agg('| ' || {_initcap("replace(replace(amenity, 'SYSTEM_', ''), '_', ' ')")} || ' | '
                 || CAST(high_tier_pct AS VARCHAR) || '% | ' || CAST(low_tier_pct AS VARCHAR) || '% | '
                 || {_signed('difference', 1, '%%')} || ' |', chr(10) ORDER BY rank) AS t
       FROM pvr WHERE rank <= 15 GROUP BY metric),
nl AS (SELECT metric, string_agg('| ' || {_initcap("replace(attribute, '_', ' ')")} || ' | '
                 || CAST(high_tier_avg AS VARCHAR) || ' | ' || CAST(low_tier_avg AS VARCHAR) || ' | '
                 || {_signed('difference', 2)} || ' |', chr(10) ORDER BY attribute_pos) AS t
       FROM nm GROUP BY metric),
ct AS (SELECT metric,
              '### Amenity Prevalence (% of properties with feature)' || chr(10) || chr(10)
              || '| Amenity | High Tier | Low Tier | Difference |' || chr(10)
              || '|---------|-----------|----------|------------|' || chr(10) || al.t || chr(10) || chr(10)
              || '### Numeric Averages' || chr(10) || chr(10)
              || '| Attribute | High Tier Avg | Low Tier Avg | Difference |' || chr(10)
              || '|-----------|---------------|--------------|------------|' || chr(10) || nl.t AS comparison_text
       FROM al JOIN nl USING (metric))"""


@q("comparison_table_text")
def _():
    return f"WITH {TIER_CTES}, {COMPARISON_SQL} SELECT metric, comparison_text FROM ct"


@q("tier_analysis")
def _():
    return f"""WITH {TIER_CTES}, {COMPARISON_SQL},
cnt AS (SELECT metric, SUM(CASE WHEN tier = 'high' THEN 1 ELSE 0 END) AS high_tier_count,
               SUM(CASE WHEN tier = 'low' THEN 1 ELSE 0 END) AS low_tier_count FROM tiered GROUP BY metric)
SELECT th.metric,
       CASE th.metric WHEN 'adr' THEN 'ADR' WHEN 'occupancy' THEN 'Occ_Rate_Based_on_Avail' END AS metric_column,
       {R('hi', 2)} AS high_tier_threshold, {R('lo', 2)} AS low_tier_threshold,
       CAST(high_tier_count AS BIGINT) AS high_tier_count, CAST(low_tier_count AS BIGINT) AS low_tier_count,
       25 AS top_percentile, 25 AS bottom_percentile, comparison_text
FROM th JOIN cnt USING (metric) JOIN ct USING (metric)"""


@q("display_name")
def _():
    return f"""WITH i AS ({B_ICONS})
SELECT icon, {_initcap("replace(replace(icon, 'SYSTEM_', ''), '_', ' ')")} AS display_name, COUNT(*) AS n_listings
FROM i GROUP BY icon"""


@q("occupancy_metrics")
def _():
    return f"SELECT listing_id, {_occ()} FROM ({B_MARKET})"


@q("valid_metric_filter")
def _():
    return f"SELECT listing_id, ADR FROM ({B_MARKET}) WHERE TRY_CAST(ADR AS DOUBLE) > 0"


@q("min_days_filter")
def _():
    return f"SELECT listing_id, Days_Avail FROM (SELECT listing_id, {_occ()} FROM ({B_MARKET})) WHERE COALESCE(CAST(Days_Avail AS DOUBLE), 0.0) >= 100"


@q("empty_metrics_filter")
def _():
    return f"""SELECT listing_id FROM ({B_MARKET})
WHERE NOT (COALESCE(ADR, 0) = 0 AND COALESCE(Revenue, 0) = 0 AND COALESCE(Occupancy, 0) = 0
           AND COALESCE(Days_Available, 0) = 0)"""


@q("join_market_metrics")
def _():
    return f"""SELECT listing_id, area, ADR, Occupancy, Days_Available, has_airdna_data FROM ({B_MATRIX})"""


@q("has_market_data_filter")
def _():
    return f"SELECT listing_id, ADR FROM ({B_MATRIX}) WHERE has_airdna_data"


@q("matrix_sort")
def _():
    return f"""SELECT listing_id, ADR, ROW_NUMBER() OVER (ORDER BY ADR DESC NULLS LAST, listing_id) AS sort_rank
FROM ({B_MATRIX})"""


@q("amenity_matrix")
def _():
    return f"SELECT * FROM ({B_WIDE})"


@q("amenity_flags")
def _():
    cols = ", ".join(f"CASE WHEN lower(CAST(\"{i}\" AS VARCHAR)) NOT IN ('false', '') THEN 1 ELSE 0 END AS \"{i}\""
                     for i in ICONS)
    return f"SELECT listing_id, {cols} FROM ({B_MATRIX})"


@q("clean_matrix")
def _():
    flags = ", ".join(f"CASE WHEN lower(CAST(\"{i}\" AS VARCHAR)) NOT IN ('false', '') THEN 1 ELSE 0 END AS \"{i}\""
                      for i in ICONS)
    return f"""SELECT listing_id, area, capacity,
       CAST(COALESCE(TRY_CAST(bedrooms AS DOUBLE), 0.0) AS INTEGER) AS bedrooms,
       ADR, Occupancy, Revenue, Days_Available, Days_Avail, has_airdna_data, {flags}
FROM ({B_MATRIX}) WHERE COALESCE(CAST(Days_Avail AS DOUBLE), 0.0) >= 100"""


@q("first_wins")
def _():
    order = ", ".join(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                       "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"])
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY {order}) AS rn
FROM lineitem) WHERE rn = 1"""


@q("latest_wins")
def _():
    order = ", ".join(f"{c} DESC" for c in ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                             "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                                             "l_linestatus", "l_shipdate"])
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY {order}) AS rn
FROM lineitem) WHERE rn = 1"""


@q("market_merge_audit")
def _():
    return """SELECT COUNT(*) AS records, COUNT(DISTINCT l_partkey) AS merged,
       COUNT(*) - COUNT(DISTINCT l_partkey) AS duplicates_skipped FROM lineitem"""


# ---------------------------------------------------------------- premium (OLS, closed form for two features)
OLS_CTES = f"""
f AS (SELECT p.p_partkey AS listing_id, CAST(p.p_size AS DOUBLE) AS capacity,
             CAST(p.p_retailprice AS DOUBLE) AS retail_price, m.ADR
      FROM part p JOIN ({B_MARKET}) m ON m.listing_id = p.p_partkey WHERE m.ADR > 0),
mo AS (SELECT covar_pop(capacity, capacity) AS s11, covar_pop(retail_price, retail_price) AS s22,
              covar_pop(capacity, retail_price) AS s12, covar_pop(capacity, ADR) AS s1y,
              covar_pop(retail_price, ADR) AS s2y, covar_pop(ADR, ADR) AS syy,
              AVG(ADR) AS ay, AVG(capacity) AS a1, AVG(retail_price) AS a2, COUNT(*) AS n FROM f),
co AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
              (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM mo),
cf AS (SELECT *, ay - b1 * a1 - b2 * a2 AS a FROM co),
res AS (SELECT f.listing_id, f.ADR AS actual, f.ADR - (cf.a + cf.b1 * f.capacity + cf.b2 * f.retail_price) AS residual
        FROM f, cf),
tb AS (SELECT * FROM (SELECT 'top' AS side, listing_id, residual,
                             ROW_NUMBER() OVER (ORDER BY residual DESC, listing_id) AS o FROM res) WHERE o <= 15
       UNION ALL
       SELECT * FROM (SELECT 'bottom' AS side, listing_id, residual,
                             ROW_NUMBER() OVER (ORDER BY residual ASC, listing_id DESC) AS o FROM res) WHERE o <= 15),
tbr AS (SELECT side, listing_id, residual,
               CAST(ROW_NUMBER() OVER (PARTITION BY side ORDER BY residual DESC, listing_id) AS INTEGER) AS rank FROM tb)"""


@q("ols_fit")
def _():
    return f"""WITH {OLS_CTES}
SELECT 'intercept' AS term, {R('a', 4)} AS coefficient FROM cf
UNION ALL SELECT 'capacity', {R('b1', 4)} FROM cf
UNION ALL SELECT 'retail_price', {R('b2', 4)} FROM cf"""


@q("ols_residuals")
def _():
    return f"WITH {OLS_CTES} SELECT listing_id, {R('residual', 4)} AS residual FROM res"


@q("r_squared")
def _():
    return f"""WITH {OLS_CTES}
SELECT COUNT(*) AS n,
       {R('CASE WHEN var_samp(actual) * (COUNT(*) - 1) > 0 THEN 1.0 - SUM(residual * residual) / (var_samp(actual) * (COUNT(*) - 1)) ELSE 0.0 END', 6)}
       AS r_squared FROM res"""


RESID_STATS = f"""{R('AVG(residual)', 2)} AS mean, {R('stddev_samp(residual)', 2)} AS std,
       {R('MIN(residual)', 2)} AS min, {R('MAX(residual)', 2)} AS max"""


@q("residual_stats")
def _():
    return f"WITH {OLS_CTES} SELECT {RESID_STATS} FROM res"


@q("regression_moments")
def _():
    return f"""WITH {OLS_CTES}
SELECT 'capacity' AS row_term, 'capacity' AS col_term, {R('s11', 3)} AS covariance FROM mo
UNION ALL SELECT 'capacity', 'retail_price', {R('s12', 3)} FROM mo
UNION ALL SELECT 'capacity', 'ADR', {R('s1y', 3)} FROM mo
UNION ALL SELECT 'retail_price', 'retail_price', {R('s22', 3)} FROM mo
UNION ALL SELECT 'retail_price', 'ADR', {R('s2y', 3)} FROM mo
UNION ALL SELECT 'ADR', 'ADR', {R('syy', 3)} FROM mo"""


@q("complete_rows_filter")
def _():
    return f"""SELECT listing_id, CAST(capacity AS DOUBLE) AS capacity, TRY_CAST(bedrooms AS DOUBLE) AS bedrooms
FROM ({B_PARTF}) WHERE TRY_CAST(bedrooms AS DOUBLE) IS NOT NULL AND capacity IS NOT NULL"""


@q("top_bottom_premium")
def _():
    return f"WITH {OLS_CTES} SELECT side, rank, listing_id, {R('residual', 4)} AS residual FROM tbr"


@q("premium_analysis")
def _():
    return f"""WITH {OLS_CTES}
SELECT {R('CASE WHEN var_samp(actual) * (COUNT(*) - 1) > 0 THEN 1.0 - SUM(residual * residual) / (var_samp(actual) * (COUNT(*) - 1)) ELSE 0.0 END', 4)} AS r_squared,
       2 AS n_features, COUNT(*) AS n_properties, {RESID_STATS} FROM res"""





def WC(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '[^{PY_WS}]+')) AS BIGINT)"


# ---------------------------------------------------------------- pipeline D: every numeric column, by elimination
WIDE_FEATURES = ["capacity", "bedrooms", "Occupancy", "Revenue", "Days_Available", "Days_Avail", *ICONS]


def wide_residuals(clean: str, features: list[str]) -> str:
    """CTEs ending in wres(listing_id, actual, residual): least squares by
    orthogonal elimination.  Columns are centred and brought to unit length;
    each in turn is taken out of the later ones and of the label, unless nothing
    of it is left (a dependent column)."""
    n = len(features)
    ctes = ["w0 AS (SELECT listing_id, ADR AS actual, ADR - AVG(ADR) OVER () AS y, " + ", ".join(
        f'CAST("{f}" AS DOUBLE) - AVG(CAST("{f}" AS DOUBLE)) OVER () AS x{k}' for k, f in enumerate(features))
        + f" FROM ({clean}) WHERE ADR > 0)",
        "w1 AS (SELECT listing_id, actual, y, " + ", ".join(
            f"COALESCE(x{k} / NULLIF(SQRT(SUM(x{k} * x{k}) OVER ()), 0), 0) AS x{k}" for k in range(n)) + " FROM w0)"]
    for k in range(n):
        rest = ["y", *[f"x{j}" for j in range(k + 1, n)]]
        sums = ", ".join(f"SUM(x{k} * {c}) AS s{i}" for i, c in enumerate(rest))
        ctes.append(f"c{k} AS (SELECT SUM(x{k} * x{k}) AS ss, {sums} FROM w{k + 1})")
        ctes.append(f"w{k + 2} AS MATERIALIZED (SELECT listing_id, actual, " + ", ".join(
            f"CASE WHEN ss > 1e-10 THEN {c} - x{k} * s{i} / ss ELSE {c} END AS {c}" for i, c in enumerate(rest))
            + f" FROM w{k + 1}, c{k})")
    ctes.append(f"wres AS (SELECT listing_id, actual, y AS residual FROM w{n + 1})")
    return ",\n".join(ctes)


def premium_ctes() -> str:
    clean = SQL["clean_matrix"].replace("WHERE COALESCE(", "WHERE has_airdna_data AND COALESCE(")
    return wide_residuals(clean, WIDE_FEATURES)


@q("premium_pipeline_lists")
def _():
    return f"""WITH {premium_ctes()},
t AS (SELECT 'top' AS side, * FROM (SELECT listing_id, residual FROM wres ORDER BY residual DESC, listing_id LIMIT 15)
      UNION ALL
      SELECT 'bottom', * FROM (SELECT listing_id, residual FROM wres ORDER BY residual, listing_id DESC LIMIT 15))
SELECT side, CAST(ROW_NUMBER() OVER (PARTITION BY side ORDER BY residual DESC, listing_id) AS INTEGER) AS rank,
       listing_id, {R('residual', 4)} AS residual FROM t"""


@q("premium_pipeline")
def _():
    r2 = "CASE WHEN var_samp(actual) * (COUNT(*) - 1) > 0 THEN 1.0 - SUM(residual * residual) / (var_samp(actual) * (COUNT(*) - 1)) ELSE 0.0 END"
    return f"""WITH {premium_ctes()},
sc AS (SELECT l.doc_id AS listing_id, CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic,
              CAST({WC('d.text')} AS DOUBLE) AS word_count, residual
       FROM labels l JOIN documents d ON d.doc_id = l.doc_id JOIN wres ON wres.listing_id = l.doc_id),
cr AS (SELECT 'quality' AS dimension, 0 AS o, corr(quality, residual) AS r, COUNT(quality) AS n FROM sc
       UNION ALL SELECT 'toxic', 1, corr(toxic, residual), COUNT(toxic) FROM sc
       UNION ALL SELECT 'word_count', 2, corr(word_count, residual), COUNT(word_count) FROM sc),
ct AS (SELECT string_agg(dimension || '=' || printf('%.4f', c) || ' n=' || n, ';' ORDER BY abs(c) DESC, o) AS t
       FROM (SELECT dimension, o, {R('CASE WHEN isnan(r) OR r IS NULL THEN 0.0 ELSE r END', 4)} AS c, n FROM cr WHERE n >= 3))
SELECT 'all' AS zipcode, 'description_quality' AS analysis_type, {R(r2, 4)} AS regression_r_squared,
       '{",".join(WIDE_FEATURES)}' AS regression_features_used, COUNT(*) AS num_properties_analyzed,
       (SELECT COUNT(*) FROM sc) AS num_descriptions_scored, 'quality,toxic,word_count' AS score_dimensions,
       COALESCE((SELECT t FROM ct), '') AS dimension_correlations, {RESID_STATS} FROM wres"""


# ---------------------------------------------------------------- description scores
SCORE_CTES = f"""
sc AS (SELECT l.doc_id AS listing_id, CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic,
              CAST({WC('d.text')} AS DOUBLE) AS word_count
       FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
rs AS (SELECT doc_id AS listing_id, n_chars - AVG(n_chars) OVER () AS residual FROM documents),
sl AS (SELECT listing_id, 'quality' AS dimension, 0 AS dimension_pos, quality AS score FROM sc
       UNION ALL SELECT listing_id, 'toxic', 1, toxic FROM sc
       UNION ALL SELECT listing_id, 'word_count', 2, word_count FROM sc),
dc0 AS (SELECT dimension, dimension_pos,
               {R('COALESCE(covar_pop(score, residual) / NULLIF(stddev_pop(score) * stddev_pop(residual), 0), 0.0)', 4)}
               AS correlation, COUNT(*) AS n
        FROM sl JOIN rs USING (listing_id) WHERE score IS NOT NULL GROUP BY dimension, dimension_pos HAVING COUNT(*) >= 3),
dc AS (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY abs(correlation) DESC, dimension_pos) AS INTEGER) AS rank FROM dc0),
rtb0 AS (SELECT * FROM (SELECT 'top' AS side, listing_id, residual,
                               ROW_NUMBER() OVER (ORDER BY residual DESC, listing_id) AS o FROM rs) WHERE o <= 15
         UNION ALL
         SELECT * FROM (SELECT 'bottom' AS side, listing_id, residual,
                               ROW_NUMBER() OVER (ORDER BY residual ASC, listing_id DESC) AS o FROM rs) WHERE o <= 15),
rtb AS (SELECT side, listing_id, residual,
               CAST(ROW_NUMBER() OVER (PARTITION BY side ORDER BY residual DESC, listing_id) AS INTEGER) AS rank FROM rtb0)"""


@q("dimension_correlation")
def _():
    return f"WITH {SCORE_CTES} SELECT dimension, correlation, n, rank FROM dc"


@q("rank_by_abs_correlation")
def _():
    return f"WITH {SCORE_CTES} SELECT rank, dimension FROM dc"


@q("join_score_residual")
def _():
    return f"""WITH {SCORE_CTES}
SELECT listing_id, quality, toxic, word_count, {R('residual', 4)} AS residual FROM sc JOIN rs USING (listing_id)"""


@q("id_intersection")
def _():
    return f"WITH {SCORE_CTES} SELECT listing_id FROM sc INTERSECT SELECT listing_id FROM rs"


@q("word_count")
def _():
    return f"SELECT doc_id, {WC('text')} AS word_count FROM documents"


@q("join_residual_description")
def _():
    return f"""WITH {SCORE_CTES}
SELECT rs.listing_id, {R('residual', 4)} AS residual, CAST(length(d.text) AS INTEGER) AS description_chars
FROM rs JOIN documents d ON d.doc_id = rs.listing_id"""


@q("join_topk_scores")
def _():
    return f"""WITH {SCORE_CTES}
SELECT side, rank, rtb.listing_id, quality, toxic, word_count, CAST(length(d.text) AS INTEGER) AS description_chars
FROM rtb LEFT JOIN sc USING (listing_id) JOIN documents d ON d.doc_id = rtb.listing_id"""


@q("sample_tier_descriptions")
def _():
    return f"""WITH {TIER_CTES},
s AS (SELECT * FROM (SELECT metric, tier, listing_id,
             CAST(ROW_NUMBER() OVER (PARTITION BY metric, tier ORDER BY ADR DESC NULLS LAST, listing_id) AS INTEGER) AS sample_rank
      FROM tiered) WHERE sample_rank <= 3)
SELECT metric, tier, sample_rank, listing_id,
       'Property ' || CAST(listing_id AS VARCHAR) || ': ' ||
       CASE WHEN length(d.text) > 500 THEN substring(d.text, 1, 500) || '...' ELSE d.text END AS sample
FROM s JOIN documents d ON d.doc_id = s.listing_id"""




def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


@q("description_score_prompts")
def _():
    t = _sql_str(SCORE_TEMPLATE)
    return f"""SELECT doc_id AS listing_id,
       replace(replace({t}, '{{DESCRIPTION}}', COALESCE(text, '')), '{{PROPERTY_ID}}', CAST(doc_id AS VARCHAR)) AS prompt,
       {WC('text')} AS word_count
FROM documents"""


@q("fill_template")
def _():
    return """SELECT doc_id AS listing_id,
       replace(replace(replace(replace('Area {ZIP_CODE_HERE} ({ISO_CODE_HERE}) listing {PROPERTY_ID}: {DESCRIPTION}',
               '{ZIP_CODE_HERE}', COALESCE(source, '')), '{ISO_CODE_HERE}', COALESCE(lang, '')),
               '{PROPERTY_ID}', CAST(doc_id AS VARCHAR)), '{DESCRIPTION}', COALESCE(text, '')) AS prompt
FROM documents"""


@q("normalize_description")
def _():
    return "SELECT doc_id AS listing_id, array_to_string(string_split(text, chr(10)), ' ') AS description FROM documents"


@q("truncate_sample")
def _():
    return """SELECT doc_id AS listing_id,
       CASE WHEN length(text) > 500 THEN substring(text, 1, 500) || '...' ELSE text END AS sample FROM documents"""


@q("parse_score_json")
def _():
    return """WITH t AS (SELECT doc_id AS listing_id,
              regexp_replace(regexp_replace(trim('```json {"quality":' || CAST(quality AS VARCHAR) || ',"toxic":'
                || CAST(toxic AS VARCHAR) || '} ```'), '^```(?:json)?\\s*', ''), '\\s*```\\s*$', '') AS body
           FROM labels)
SELECT listing_id, j.key AS dimension, CAST(j.value AS DOUBLE) AS score
FROM t, json_each(t.body) AS j WHERE j.type IN ('UBIGINT', 'BIGINT', 'DOUBLE')"""


# ---------------------------------------------------------------- review packing
NA_LIST = "('nan', 'na', 'none', '<na>')"


def _tok(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' OR lower({x}) IN {NA_LIST} THEN 0 ELSE length({x}) // 4 END"


ORDER_ALL = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
             "l_returnflag, l_linestatus, l_shipdate")


def chunk_ctes(limit: int) -> str:
    budget = limit - len(BASE_PROMPT) // 4
    return f"""RECURSIVE r AS (
  SELECT listing_id, review AS text, CAST({_tok('review')} AS BIGINT) AS tokens,
         ROW_NUMBER() OVER (PARTITION BY listing_id ORDER BY {ORDER_ALL}) AS pos
  FROM ({B_REVIEWS})),
w(listing_id, pos, s, cnt, chunk_no, item_no, truncated) AS (
  SELECT listing_id, pos, CASE WHEN tokens > {budget} THEN 0 ELSE tokens END,
         CASE WHEN tokens > {budget} THEN 0 ELSE 1 END, 1, 1, tokens > {budget}
  FROM r WHERE pos = 1
  UNION ALL
  SELECT r.listing_id, r.pos,
         CASE WHEN w.s + r.tokens > {budget} THEN (CASE WHEN w.cnt > 0 THEN r.tokens ELSE 0 END) ELSE w.s + r.tokens END,
         CASE WHEN w.s + r.tokens > {budget} THEN (CASE WHEN w.cnt > 0 THEN 1 ELSE 0 END) ELSE w.cnt + 1 END,
         CASE WHEN w.s + r.tokens > {budget} OR w.cnt = 0 THEN w.chunk_no + 1 ELSE w.chunk_no END,
         CASE WHEN w.s + r.tokens > {budget} OR w.cnt = 0 THEN 1 ELSE w.cnt + 1 END,
         (w.s + r.tokens > {budget} AND w.cnt = 0)
  FROM w JOIN r ON r.listing_id = w.listing_id AND r.pos = w.pos + 1),
ch AS (SELECT r.listing_id, CAST(w.chunk_no AS BIGINT) AS chunk_no, CAST(w.item_no AS BIGINT) AS item_no,
              CASE WHEN w.truncated THEN substring(r.text, 1, 2000) || '... [truncated]' ELSE r.text END AS text,
              r.tokens, w.truncated
       FROM w JOIN r ON r.listing_id = w.listing_id AND r.pos = w.pos)"""


@q("chunk_reviews")
def _():
    return f"WITH {chunk_ctes(120000)} SELECT * FROM ch"


@q("chunk_reviews_tight")
def _():
    return f"WITH {chunk_ctes(100)} SELECT * FROM ch"


@q("chunk_reviews_hot")
def _():
    """Chunk starts by a fold over each listing's tokens (no recursion over a hot listing's positions)."""
    budget = 100 - len(BASE_PROMPT) // 4
    return f"""WITH r AS (
  SELECT listing_id, review AS text, CAST({_tok('review')} AS BIGINT) AS tokens,
         ROW_NUMBER() OVER (PARTITION BY listing_id ORDER BY {ORDER_ALL}) AS pos
  FROM (SELECT * REPLACE (CAST(CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE listing_id END AS BIGINT) AS listing_id) FROM ({B_REVIEWS}))),
f AS (SELECT listing_id, MIN(CASE WHEN tokens <= {budget} THEN pos END) AS first_fit,
             list_reduce(list({{'t': tokens, 'p': pos, 'starts': []::BIGINT[]}} ORDER BY pos),
               lambda a, x: CASE WHEN a.t + x.t > {budget}
                                 THEN {{'t': x.t, 'p': x.p, 'starts': list_append(a.starts, x.p)}}
                                 ELSE {{'t': a.t + x.t, 'p': x.p, 'starts': a.starts}} END).starts AS starts
      FROM r GROUP BY listing_id),
s AS (SELECT listing_id, first_fit, unnest(list_prepend(1, starts)) AS pos,
             generate_subscripts(list_prepend(1, starts), 1) AS chunk_no FROM f),
j AS (SELECT r.listing_id, s.chunk_no, r.pos - s.pos + 1 AS item_no, r.text, r.tokens,
             r.tokens > {budget} AND r.pos < COALESCE(s.first_fit, r.pos + 1) AS truncated
      FROM r ASOF JOIN s ON r.listing_id = s.listing_id AND r.pos >= s.pos)
SELECT listing_id, CAST(chunk_no AS BIGINT) AS chunk_no, CAST(item_no AS BIGINT) AS item_no,
       CASE WHEN truncated THEN substring(text, 1, 2000) || '... [truncated]' ELSE text END AS text, tokens, truncated
FROM j"""


@q("needs_chunking")
def _():
    return f"""WITH r AS ({B_REVIEWS})
SELECT listing_id, CAST(SUM({_tok('review')}) AS BIGINT) AS review_tokens,
       ({len(BASE_PROMPT) // 4} + SUM({_tok('review')})) > 100 AS needs_chunking
FROM r GROUP BY listing_id"""


@q("review_numbering")
def _():
    return f"""WITH {chunk_ctes(100)}
SELECT listing_id, chunk_no, item_no, 'Review ' || CAST(item_no AS VARCHAR) || ': ' || COALESCE(text, '<NA>') AS numbered
FROM ch"""


@q("chunk_prompt")
def _():
    pt = len(BASE_PROMPT) // 4
    return f"""WITH {chunk_ctes(100)},
per AS (SELECT listing_id, chunk_no, COUNT(*) AS n_items, SUM(tokens) AS chunk_tokens,
               string_agg('Review ' || CAST(item_no AS VARCHAR) || ': ' || COALESCE(text, '<NA>'), chr(10) ORDER BY item_no) AS body
        FROM ch GROUP BY listing_id, chunk_no),
per2 AS (SELECT *, MAX(chunk_no) OVER (PARTITION BY listing_id) AS n_chunks,
                SUM(chunk_tokens) OVER (PARTITION BY listing_id) + {pt} AS total_tokens FROM per)
SELECT listing_id, chunk_no, n_chunks, n_items,
       {_sql_str(BASE_PROMPT)} || chr(10) || chr(10)
       || CASE WHEN total_tokens > 100 THEN printf('Processing chunk %d of %d (%d reviews)', chunk_no, n_chunks, n_items)
               || chr(10) || chr(10) ELSE '' END
       || 'Reviews to analyze:' || chr(10) || body || chr(10) || chr(10)
       || 'Please provide the analysis following the exact format specified above.' AS prompt
FROM per2"""




def merge_sql(group: str) -> str:
    return f"""WITH p AS (SELECT conv_id || '/' || role AS listing_id, turn AS chunk_no, text AS summary,
                  CAST({group} AS BIGINT) AS merge_group FROM conversations
           WHERE text IS NOT NULL AND length(text) > 0),
g AS (SELECT listing_id, merge_group, COUNT(*) AS n_parts, MIN(summary) AS only_one,
             string_agg(printf(chr(10) || '--- Analysis %d ---' || chr(10) || '%s' || chr(10), rn, summary), ''
                        ORDER BY chunk_no) AS body
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY listing_id, merge_group ORDER BY chunk_no) AS rn FROM p)
      GROUP BY listing_id, merge_group),
ng AS (SELECT listing_id, COUNT(*) AS n_groups FROM g GROUP BY listing_id)
SELECT listing_id, merge_group, n_groups, n_parts, n_groups = 1 AS final,
       CASE WHEN n_parts = 1 THEN only_one
            ELSE {_sql_str(MERGE_HEAD)} || trim(split_part({_sql_str(BASE_PROMPT)}, 'Reviews to analyze:', 1))
                 || chr(10) || chr(10) || 'Partial analyses to merge:' || chr(10) || body || {_sql_str(MERGE_TAIL)} END AS prompt
FROM g JOIN ng USING (listing_id)"""


@q("merge_prompt")
def _():
    return merge_sql("0")


@q("merge_prompt_groups")
def _():
    return merge_sql("FLOOR((turn - 1) / 3)")


# ---------------------------------------------------------------- costs
B_REQUESTS = """
  SELECT conv_id % 10 AS session, conv_id AS listing_id, turn, prompt, text AS response,
         prompt IS NOT NULL AS success, turn % 7 = 0 AS cached
  FROM (SELECT *, LAG(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prompt FROM conversations)
  WHERE role = 'assistant'"""

COSTED = f"""
  SELECT *, CASE WHEN cached THEN 0.0 ELSE
           {R('(CAST(input_tokens AS DOUBLE) / 1000000.0) * 0.4 + (CAST(output_tokens AS DOUBLE) / 1000000.0) * 1.6', 6)}
         END AS cost
  FROM (SELECT *, CAST(length(COALESCE(prompt, '')) // 4 AS BIGINT) AS input_tokens,
               CAST(CASE WHEN response IS NOT NULL AND length(response) > 0 THEN length(response) // 4 ELSE 0 END
                    AS BIGINT) AS output_tokens
        FROM ({B_REQUESTS}))"""


@q("estimate_tokens")
def _():
    return f"SELECT conv_id, turn, CAST({_tok('text')} AS BIGINT) AS tokens FROM conversations"


@q("request_cost")
def _():
    return f"SELECT session, listing_id, turn, input_tokens, output_tokens, cost FROM ({COSTED})"


@q("request_cost_session")
def _():
    return f"""WITH c AS ({COSTED}),
a AS (SELECT session, COUNT(*) AS total_requests,
             SUM(CASE WHEN success THEN 1 ELSE 0 END) AS successful_requests,
             SUM(CASE WHEN success THEN 0 ELSE 1 END) AS failed_requests,
             SUM(CASE WHEN cached THEN 1 ELSE 0 END) AS cache_hits,
             COUNT(DISTINCT listing_id) AS unique_listings,
             SUM(CASE WHEN NOT cached THEN input_tokens ELSE 0 END) AS total_input_tokens,
             SUM(CASE WHEN NOT cached THEN output_tokens ELSE 0 END) AS total_output_tokens,
             SUM(CASE WHEN NOT cached THEN cost ELSE 0.0 END) AS c
      FROM c GROUP BY session)
SELECT session, total_requests, CAST(successful_requests AS BIGINT) AS successful_requests,
       CAST(failed_requests AS BIGINT) AS failed_requests, CAST(cache_hits AS BIGINT) AS cache_hits,
       {R('CAST(cache_hits AS DOUBLE) / GREATEST(1, total_requests) * 100.0', 1)} AS cache_hit_rate,
       unique_listings, CAST(total_input_tokens AS BIGINT) AS total_input_tokens,
       CAST(total_output_tokens AS BIGINT) AS total_output_tokens,
       CAST(total_input_tokens + total_output_tokens AS BIGINT) AS total_tokens,
       {R('c', 4)} AS total_cost, {R('c / GREATEST(1, unique_listings)', 4)} AS average_cost_per_listing,
       {R('c * 100.0 / GREATEST(1, unique_listings)', 2)} AS estimated_cost_per_100_listings
FROM a"""


AS_OF = "2024-01-31 00:00:00"


@q("historical_cost")
def _():
    return f"""WITH s AS (SELECT user_id AS session, MIN(ts) AS session_start, SUM(value) / 1000.0 AS total_cost,
                  COUNT(DISTINCT event_type) AS listings, COUNT(*) AS total_requests FROM events GROUP BY user_id),
r AS (SELECT * FROM s WHERE session_start >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY),
a AS (SELECT COUNT(*) AS sessions, SUM(total_cost) AS c, SUM(listings) AS tl, SUM(total_requests) AS tr FROM r)
SELECT 30 AS days, sessions = 0 AS no_data, sessions, {R('COALESCE(c, 0.0)', 4)} AS total_cost,
       CAST(COALESCE(tl, 0) AS BIGINT) AS total_listings, CAST(COALESCE(tr, 0) AS BIGINT) AS total_requests,
       {R('COALESCE(c, 0.0) / GREATEST(1, COALESCE(tl, 0))', 4)} AS average_cost_per_listing,
       {R('COALESCE(c, 0.0) / GREATEST(1, sessions)', 4)} AS average_cost_per_session
FROM a"""


@q("last_n_sessions")
def _():
    return f"""WITH s AS (SELECT listing_id AS session, COUNT(*) AS n_requests, CAST(FLOOR(listing_id / 100) AS BIGINT) AS start
           FROM ({B_REQUESTS}) GROUP BY listing_id)
SELECT * FROM (SELECT session, n_requests, start, CAST(ROW_NUMBER() OVER (ORDER BY start DESC, session DESC) AS INTEGER) AS recency FROM s)
WHERE recency <= 100"""


# ---------------------------------------------------------------- freshness
STAGES = ["click", "error", "purchase", "signup", "view"]
B_MANIFEST = "SELECT event_type AS stage, user_id AS listing_id, MAX(ts) AS mtime FROM events GROUP BY 1, 2"
FRESH = f"(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(mtime)) / 3.6e9 < 72"
EXPECTED = ("SELECT s.stage, u.listing_id FROM (SELECT DISTINCT user_id AS listing_id FROM events) u, "
            "(SELECT unnest([" + ", ".join(f"'{s}'" for s in STAGES) + "]) AS stage) s")
FRESH_MANIFEST = f"SELECT stage, listing_id FROM ({B_MANIFEST}) WHERE {FRESH}"


@q("is_fresh")
def _():
    return f"SELECT stage, listing_id, COALESCE({FRESH}, false) AS fresh FROM ({B_MANIFEST})"


@q("expected_outputs")
def _():
    return EXPECTED


@q("missing_outputs")
def _():
    return f"SELECT stage, listing_id FROM ({EXPECTED}) e ANTI JOIN ({FRESH_MANIFEST}) f USING (stage, listing_id)"


@q("stage_freshness")
def _():
    return f"""SELECT stage, COUNT(*) AS expected, CAST(SUM(CASE WHEN f.listing_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS fresh_outputs,
       COUNT(*) > 0 AND bool_and(f.listing_id IS NOT NULL) AS stage_fresh
FROM ({EXPECTED}) e LEFT JOIN ({FRESH_MANIFEST}) f USING (stage, listing_id) GROUP BY stage
UNION ALL SELECT 'report', 0, 0, false"""


RULE_AREAS = "SELECT CAST(n_nationkey AS VARCHAR) AS area FROM nation UNION ALL SELECT 'empty'"
RULE_LISTINGS = "SELECT CAST(c_nationkey AS VARCHAR) AS area, c_custkey AS k FROM customer"
AREA_OUTPUTS = [
    ("search_results", ["'search_results_' || area || '.json'"]),
    ("details_results", ["'property_amenities_matrix_' || area || '.csv'", "'property_amenities_matrix_cleaned_' || area || '.csv'",
                         "'house_rules_details_' || area || '.json'", "'property_descriptions_' || area || '.json'",
                         "'neighborhood_highlights_' || area || '.json'"]),
    ("area_summary", ["'area_summary_' || area || '.md'"]),
    ("correlation_results", [f"'correlation_{k}_{m}_' || area || '.{e}'" for m in ("adr", "occupancy")
                             for k, e in (("stats", "json"), ("insights", "md"))]),
    ("description_analysis", ["'description_quality_stats_' || area || '.json'", "'description_quality_' || area || '.md'"]),
]
LISTING_OUTPUTS = [("comp_sets", "'listing_' || k || '.json'"), ("reviews_scrape", "'reviews_' || area || '_' || k || '.json'"),
                   ("details_scrape", "'property_details_' || k || '.json'")]
SUMMARY_OUTPUT = "'listing_summary_' || area || '_' || k || '.json'"
RULE_EXPECTED = " UNION ALL ".join(
    [f"SELECT '{s}' AS stage, area, CAST(NULL AS VARCHAR) AS listing_id, {o} AS output FROM ({RULE_AREAS})"
     for s, outs in AREA_OUTPUTS for o in outs]
    + [f"SELECT DISTINCT 'comp_sets', area, CAST(NULL AS VARCHAR), 'comp_set_' || area || '.json' FROM ({RULE_LISTINGS})"]
    + [f"SELECT '{s}', area, CAST(k AS VARCHAR), {o} FROM ({RULE_LISTINGS})" for s, o in LISTING_OUTPUTS]
    + [f"SELECT 'listing_summaries', area, CAST(k AS VARCHAR), {SUMMARY_OUTPUT} FROM ({RULE_LISTINGS}) "
       "WHERE k IN (SELECT user_id FROM events)"])
_SEEN = f"(SELECT m.stage AS kind, m.mtime, l.area, l.k FROM ({B_MANIFEST}) m JOIN ({RULE_LISTINGS}) l ON l.k = m.listing_id)"
RULE_MANIFEST = " UNION ALL ".join(
    [f"SELECT '{s}' AS stage, {o} AS output, mtime FROM {_SEEN} WHERE kind = '{e}'" for s, o, e in [
        ("comp_sets", LISTING_OUTPUTS[0][1], "signup"), ("reviews_scrape", LISTING_OUTPUTS[1][1], "view"),
        ("details_scrape", LISTING_OUTPUTS[2][1], "click"), ("listing_summaries", SUMMARY_OUTPUT, "purchase")]]
    + [f"SELECT '{s}', {o}, MAX(mtime) FROM {_SEEN} WHERE kind = '{e}' GROUP BY area" for s, o, e in [
        ("search_results", "'search_results_' || area || '.json'", "view"), ("comp_sets", "'comp_set_' || area || '.json'", "signup"),
        ("area_summary", "'area_summary_' || area || '.md'", "error")]])
RULE_FRESH = f"(SELECT DISTINCT stage, output FROM ({RULE_MANIFEST}) WHERE {FRESH})"


@q("expected_outputs_by_rule")
def _():
    return RULE_EXPECTED


@q("missing_outputs_by_rule")
def _():
    return f"SELECT e.* FROM ({RULE_EXPECTED}) e ANTI JOIN {RULE_FRESH} f USING (stage, output)"


@q("stage_freshness_by_area")
def _():
    stages = ", ".join(f"'{s}'" for s in ["comp_sets", "reviews_scrape", "details_scrape", "listing_summaries"]
                       + [s for s, _ in AREA_OUTPUTS])
    return f"""WITH g AS (SELECT a.area, s.stage FROM ({RULE_AREAS}) a, (SELECT unnest([{stages}]) AS stage) s),
e AS (SELECT e.stage, e.area, COUNT(*) AS n, COUNT(f.output) AS fr
      FROM ({RULE_EXPECTED}) e LEFT JOIN {RULE_FRESH} f ON f.stage = e.stage AND f.output = e.output GROUP BY e.stage, e.area)
SELECT g.stage, g.area, COALESCE(n, 0) AS expected, COALESCE(fr, 0) AS fresh_outputs,
       COALESCE(n > 0 AND fr = n, false) AS stage_fresh
FROM g LEFT JOIN e ON e.stage = g.stage AND e.area = g.area"""


_STAGE_LIST = "(SELECT unnest([" + ", ".join(f"'{s}'" for s in STAGES) + "]) AS stage) s"


@q("unprocessed_or_stale")
def _():
    return f"""SELECT s.stage, event_id, user_id AS listing_id FROM events, {_STAGE_LIST}
WHERE NOT EXISTS (SELECT 1 FROM ({FRESH_MANIFEST}) f WHERE f.stage = s.stage AND f.listing_id = user_id)"""


@q("resolved_prescan")
def _():
    return f"""SELECT s.stage, c_custkey AS listing_id FROM customer, {_STAGE_LIST}
WHERE EXISTS (SELECT 1 FROM ({B_MANIFEST}) m WHERE m.stage = s.stage AND m.listing_id = c_custkey)"""


@q("id_difference")
def _():
    return f"""SELECT s.stage, c_custkey AS listing_id FROM customer, {_STAGE_LIST}
WHERE NOT EXISTS (SELECT 1 FROM ({B_MANIFEST}) m WHERE m.stage = s.stage AND m.listing_id = c_custkey)"""


@q("coverage_gate")
def _():
    return f"""WITH g AS (SELECT stage, COUNT(*) AS total, SUM(CASE WHEN f.listing_id IS NULL THEN 1 ELSE 0 END) AS missing
           FROM ({EXPECTED}) e LEFT JOIN ({FRESH_MANIFEST}) f USING (stage, listing_id) GROUP BY stage)
SELECT stage, total, CAST(missing AS BIGINT) AS missing, {R('CAST(missing AS DOUBLE) / GREATEST(1, total)', 6)} AS missing_rate,
       CAST(missing AS DOUBLE) / GREATEST(1, total) > 0.2 AS retry FROM g"""


# ---------------------------------------------------------------- grid
BBOX = f"""SELECT n_nationkey AS area,
       {R('CAST(n_nationkey * 1000 AS DOUBLE) + 140.0', 7)} AS ne_lat, {R('CAST(n_nationkey * 1000 AS DOUBLE) - 140.0', 7)} AS sw_lat,
       {R('CAST(-n_nationkey * 1000 AS DOUBLE) + 140.0', 7)} AS ne_lon, {R('CAST(-n_nationkey * 1000 AS DOUBLE) - 140.0', 7)} AS sw_lon
FROM nation"""
def cells_sql(d: int) -> str:
    return f"""SELECT area, CAST(i AS INTEGER) AS cell_row, CAST(j AS INTEGER) AS cell_col, CAST(i * {d} + j AS INTEGER) AS cell_no,
       sw_lat + i * ((ne_lat - sw_lat) / {d}) AS box_sw_lat, sw_lon + j * ((ne_lon - sw_lon) / {d}) AS box_sw_lon,
       sw_lat + i * ((ne_lat - sw_lat) / {d}) + (ne_lat - sw_lat) / {d} AS box_ne_lat,
       sw_lon + j * ((ne_lon - sw_lon) / {d}) + (ne_lon - sw_lon) / {d} AS box_ne_lon
FROM ({BBOX}) b, range({d}) r1(i), range({d}) r2(j)"""


CELLS = cells_sql(2)
PTS = """SELECT c_custkey AS listing_id, c_nationkey AS area,
       CAST(c_nationkey * 1000 + (c_custkey * 37) % 281 - 140 AS DOUBLE) AS lat,
       CAST(-c_nationkey * 1000 + (c_custkey * 53) % 281 - 140 AS DOUBLE) AS lon FROM customer"""


def hits_sql(d: int) -> str:
    return f"""SELECT p.listing_id, p.area, c.cell_no FROM ({PTS}) p JOIN ({cells_sql(d)}) c ON c.area = p.area
WHERE p.lat >= c.box_sw_lat AND p.lat < c.box_ne_lat AND p.lon >= c.box_sw_lon AND p.lon < c.box_ne_lon"""


HITS = hits_sql(2)


@q("grid_range_join_fine")
def _():
    return hits_sql(16)


@q("area_bbox")
def _():
    return BBOX


@q("bbox_grid")
def _():
    return f"""SELECT area, CAST(cell_no AS INTEGER) AS cell_no, CAST(cell_row AS INTEGER) AS cell_row,
       CAST(cell_col AS INTEGER) AS cell_col, {R('box_sw_lat', 7)} AS box_sw_lat, {R('box_sw_lon', 7)} AS box_sw_lon,
       {R('box_ne_lat', 7)} AS box_ne_lat, {R('box_ne_lon', 7)} AS box_ne_lon FROM ({CELLS})"""


@q("grid_range_join")
def _():
    return HITS


@q("grid_saturation")
def _():
    return f"SELECT area, cell_no, COUNT(*) AS hits, COUNT(*) >= 15 AS saturated FROM ({HITS}) GROUP BY area, cell_no"


@q("union_cells")
def _():
    return HITS


# ---------------------------------------------------------------- market page text
PAGE = f"""SELECT m.listing_id,
  '★ ' || printf('%.1f', {R('3 + (p.p_size % 20) / CAST(10.0 AS DOUBLE)', 1)}) || ' (' || CAST(p.p_size AS VARCHAR) || ')'
  || chr(10) || 'Bedrooms: ' || CAST(CAST(FLOOR(p.p_size / 4) AS BIGINT) AS VARCHAR) || ' Baths: '
  || printf('%.1f', {R('1 + (p.p_size % 4) / CAST(2.0 AS DOUBLE)', 1)}) || ' Guests: ' || CAST(p.p_size % 16 + 1 AS VARCHAR)
  || chr(10) || '$' || printf('%.1f', {R('m.Revenue / 1000.0', 1)}) || 'K' || chr(10) || 'Annual Revenue' || chr(10)
  || '$' || printf('%.2f', m.ADR) || chr(10) || 'Average Daily Rate' || chr(10) || CAST(m.Occupancy AS VARCHAR) || '%'
  || chr(10) || 'Occupancy' || chr(10) || CAST(m.Days_Available AS VARCHAR) || chr(10) || 'Days Available' AS page_text
FROM ({B_MARKET}) m JOIN part p ON p.p_partkey = m.listing_id"""


def _x(text: str, pat: str, i: int = 1) -> str:
    return f"CASE WHEN regexp_matches({text}, '{pat}') THEN regexp_extract({text}, '{pat}', {i}) END"


def _money(x: str) -> str:
    return f"TRY_CAST(trim(regexp_replace({x}, '[$,]', '', 'g')) AS DOUBLE)"


def _revenue(x: str) -> str:
    c = f"trim(regexp_replace({x}, '[$,]', '', 'g'))"
    return (f"TRY_CAST(regexp_replace({c}, '[KkMm]$', '') AS DOUBLE) * CASE WHEN upper({c}) LIKE '%K' THEN 1000.0 "
            f"WHEN upper({c}) LIKE '%M' THEN 1000000.0 ELSE 1.0 END")


def _pct(x: str) -> str:
    return f"CAST(TRUNC(TRY_CAST(trim(replace({x}, '%', '')) AS DOUBLE)) AS INTEGER)"


def _days(x: str) -> str:
    return f"CASE WHEN regexp_extract({x}, '(\\d+)', 1) <> '' THEN TRY_CAST(regexp_extract({x}, '(\\d+)', 1) AS INTEGER) END"


@q("extract_kpis")
def _():
    return f"""SELECT listing_id,
       {R(f"COALESCE({_revenue(_x('page_text', KPI_REVENUE))}, 0.0)", 2)} AS Revenue,
       COALESCE({_money(_x('page_text', KPI_ADR))}, 0.0) AS ADR,
       COALESCE({_pct(_x('page_text', KPI_OCCUPANCY))}, 0) AS Occupancy,
       COALESCE({_days(_x('page_text', KPI_DAYS))}, 0) AS Days_Available
FROM ({PAGE})"""


@q("extract_header")
def _():
    h = "substring(page_text, 1, 500)"
    return f"""SELECT listing_id, TRY_CAST({_x('page_text', HDR_RATING, 1)} AS DOUBLE) AS Rating,
       TRY_CAST({_x('page_text', HDR_RATING, 2)} AS INTEGER) AS Review_Count,
       TRY_CAST({_x(h, HDR_BED)} AS INTEGER) AS Bedrooms, TRY_CAST({_x(h, HDR_BATH)} AS DOUBLE) AS Bathrooms,
       TRY_CAST({_x(h, HDR_GUEST)} AS INTEGER) AS Max_Guests
FROM ({PAGE})"""


KPI_STRINGS = f"""SELECT listing_id, regexp_extract(page_text, '{KPI_REVENUE}', 1) AS rev_s,
       regexp_extract(page_text, '{KPI_ADR}', 1) AS adr_s, regexp_extract(page_text, '{KPI_OCCUPANCY}', 1) AS occ_s,
       regexp_extract(page_text, '{KPI_DAYS}', 1) AS days_s,
       regexp_extract(substring(page_text, 1, 500), '{HDR_BATH}', 1) AS bath_s FROM ({PAGE})"""


@q("parse_currency")
def _():
    return f"SELECT listing_id, adr_s, {_money('adr_s')} AS value FROM ({KPI_STRINGS})"


@q("parse_revenue")
def _():
    return f"SELECT listing_id, rev_s, {R(_revenue('rev_s'), 2)} AS value FROM ({KPI_STRINGS})"


@q("parse_percentage")
def _():
    return f"SELECT listing_id, occ_s, {_pct('occ_s')} AS value FROM ({KPI_STRINGS})"


@q("parse_days")
def _():
    return f"SELECT listing_id, days_s, {_days('days_s')} AS value FROM ({KPI_STRINGS})"


@q("parse_decimal")
def _():
    return f"SELECT listing_id, bath_s, TRY_CAST(trim(bath_s) AS DOUBLE) AS value FROM ({KPI_STRINGS})"


@q("listing_link")
def _():
    return f"SELECT p_partkey AS listing_id, '{LISTING_URL_PREFIX}' || CAST(p_partkey AS VARCHAR) AS link FROM part"


# ---------------------------------------------------------------- listing details -> matrix
DET = """SELECT CAST(p_partkey AS VARCHAR) AS listing_id, p_partkey, p_size, p_name, p_brand, p_type,
       CASE WHEN p_size % 5 = 0 THEN 'Private room' ELSE 'Entire home/apt' END AS room_type,
       CASE WHEN p_size % 4 <> 0 THEN p_name || ' ' || p_brand ELSE p_name END AS description
FROM part"""
LONG = f"""SELECT listing_id, icon, arg_max(title, src) AS title, MAX(src) AS source FROM (
  SELECT CAST(listing_id AS VARCHAR) AS listing_id, icon, 'Feature ' || icon AS title, 0 AS src FROM ({B_ICONS})
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'SYSTEM_A_03', 'No pets', 1 FROM part WHERE p_size % 3 = 0
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'SYSTEM_N_05', 'Guest favourite', 2 FROM part WHERE p_size % 4 = 0
) GROUP BY listing_id, icon"""


@q("read_listing_details")
def _():
    return f"""SELECT d.listing_id, room_type, CAST(p_size AS BIGINT) AS person_capacity, p_name AS title,
       CAST(COALESCE(c.n, 0) AS INTEGER) AS n_amenity_icons, description
FROM ({DET}) d LEFT JOIN (SELECT listing_id, COUNT(*) AS n FROM ({B_ICONS}) GROUP BY listing_id) c
  ON c.listing_id = d.p_partkey"""


@q("amenity_long")
def _():
    return f"SELECT listing_id, icon, title, CAST(source AS INTEGER) AS source FROM ({LONG})"


SUB = """CAST(CAST(FLOOR(p_size / 4) AS BIGINT) AS VARCHAR) AS bedrooms,
       CAST(CAST(FLOOR(p_size / 3) AS BIGINT) AS VARCHAR) AS beds, CAST(1 + p_size % 3 AS VARCHAR) AS bathrooms"""


@q("parse_sub_description")
def _():
    return f"SELECT listing_id, {SUB} FROM ({DET})"


@q("entire_home_filter")
def _():
    return f"SELECT listing_id, room_type = 'Entire home/apt' AS is_entire_home FROM ({DET})"


@q("house_rules_text")
def _():
    return f"SELECT listing_id, 'Quiet hours for ' || p_brand AS house_rules FROM ({DET})"


@q("neighborhood_highlight")
def _():
    return f"SELECT listing_id, CASE WHEN p_size % 2 = 0 THEN p_type END AS neighborhood_highlight FROM ({DET})"


_WIDE_BUILT = ", ".join(f"MAX(CASE WHEN icon = '{i}' THEN title END) AS \"{i}\"" for i in ICONS)
BUILT = f"""SELECT d.listing_id, '{LISTING_URL_PREFIX}' || d.listing_id AS link,
       m.ADR, m.Occupancy AS Occ_Rate_Based_on_Avail, m.Days_Available AS Days_Avail,
       CAST(CEIL(((CAST(m.Occupancy AS DOUBLE) / 100.0) * CAST(m.Days_Available AS DOUBLE)) * 100.0 / 365.0) AS BIGINT)
         AS Abs_Occ_Rate,
       {R('(CAST(m.Days_Available AS DOUBLE) / 365.0) * 100.0', 2)} AS Avail_Rate,
       m.listing_id IS NOT NULL AS has_airdna_data,
       CASE WHEN e THEN CAST(p_size AS BIGINT) END AS capacity, CASE WHEN e THEN p_name END AS title,
       CASE WHEN e THEN CAST(CAST(FLOOR(p_size / 4) AS BIGINT) AS VARCHAR) END AS bedrooms,
       CASE WHEN e THEN CAST(CAST(FLOOR(p_size / 3) AS BIGINT) AS VARCHAR) END AS beds,
       CASE WHEN e THEN CAST(1 + p_size % 3 AS VARCHAR) END AS bathrooms,
       CASE WHEN e THEN 3 + (p_size % 20) / CAST(10.0 AS DOUBLE) END AS guest_satisfaction,
       {", ".join(f'w."{i}"' for i in ICONS)}
FROM (SELECT *, room_type = 'Entire home/apt' AS e FROM ({DET})) d
LEFT JOIN ({B_MARKET}) m ON m.listing_id = d.p_partkey
LEFT JOIN (SELECT l.listing_id, {_WIDE_BUILT} FROM ({LONG}) l JOIN ({DET}) dd USING (listing_id)
           WHERE dd.room_type = 'Entire home/apt' GROUP BY l.listing_id) w ON w.listing_id = d.listing_id"""


@q("build_matrix")
def _():
    return BUILT


@q("drop_columns")
def _():
    return f"SELECT * EXCLUDE (link, Occ_Rate_Based_on_Avail, Abs_Occ_Rate, Avail_Rate, title, guest_satisfaction) FROM ({BUILT})"


def _fill(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR lower({c}) = 'false' THEN '0' ELSE {c} END AS {c}"


@q("fill_missing")
def _():
    icons = ", ".join(_fill(f'"{i}"') for i in ICONS)
    return f"""SELECT listing_id, ADR, Days_Avail, has_airdna_data, capacity, {_fill('bedrooms')}, {_fill('beds')},
       {_fill('bathrooms')}, {icons} FROM ({BUILT})"""


@q("clean_built_matrix")
def _():
    flags = ", ".join(f"CASE WHEN \"{i}\" IS NOT NULL AND lower(\"{i}\") NOT IN ('false', '') THEN 1 ELSE 0 END AS \"{i}\""
                      for i in ICONS)
    return f"""SELECT listing_id, ADR, Days_Avail, has_airdna_data, capacity,
       CAST(COALESCE(TRY_CAST(bedrooms AS DOUBLE), 0.0) AS INTEGER) AS bedrooms,
       CAST(COALESCE(TRY_CAST(beds AS DOUBLE), 0.0) AS INTEGER) AS beds,
       COALESCE(TRY_CAST(bathrooms AS DOUBLE), 0.0) AS bathrooms, {flags}
FROM ({BUILT}) WHERE COALESCE(CAST(Days_Avail AS DOUBLE), 0.0) >= 100"""


@q("read_market_metrics")
def _():
    return f"""SELECT CAST(listing_id AS VARCHAR) AS listing_id, ADR, Occupancy, {R('Revenue', 2)} AS Revenue, Days_Available
FROM ({B_MARKET})"""


@q("read_descriptions")
def _():
    return f"SELECT listing_id, description FROM ({DET})"


# ---------------------------------------------------------------- review / area packs
def chunk_generic(items: str, key: str, order: str, budget: str) -> str:
    """Recursive greedy packing over ``items`` (columns: key, text, tokens, budget + order columns)."""
    return f"""r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) AS pos FROM ({items})),
w({key}, pos, s, cnt, chunk_no, item_no, truncated) AS (
  SELECT {key}, pos, CASE WHEN tokens > {budget} THEN 0 ELSE tokens END,
         CASE WHEN tokens > {budget} THEN 0 ELSE 1 END, 1, 1, tokens > {budget}
  FROM r WHERE pos = 1
  UNION ALL
  SELECT r.{key}, r.pos,
         CASE WHEN w.s + r.tokens > r.{budget} THEN (CASE WHEN w.cnt > 0 THEN r.tokens ELSE 0 END) ELSE w.s + r.tokens END,
         CASE WHEN w.s + r.tokens > r.{budget} THEN (CASE WHEN w.cnt > 0 THEN 1 ELSE 0 END) ELSE w.cnt + 1 END,
         CASE WHEN w.s + r.tokens > r.{budget} OR w.cnt = 0 THEN w.chunk_no + 1 ELSE w.chunk_no END,
         CASE WHEN w.s + r.tokens > r.{budget} OR w.cnt = 0 THEN 1 ELSE w.cnt + 1 END,
         (w.s + r.tokens > r.{budget} AND w.cnt = 0)
  FROM w JOIN r ON r.{key} = w.{key} AND r.pos = w.pos + 1),
ch AS (SELECT r.*, CAST(w.chunk_no AS BIGINT) AS chunk_no, CAST(w.item_no AS BIGINT) AS item_no,
              CASE WHEN w.truncated THEN substring(r.text, 1, 2000) || '... [truncated]' ELSE r.text END AS ctext
       FROM w JOIN r ON r.{key} = w.{key} AND r.pos = w.pos)"""


def prompt_from_chunks(key: str, limit: int) -> str:
    return f"""per AS (SELECT {key}, chunk_no, COUNT(*) AS n_items, SUM(tokens) AS chunk_tokens,
               MIN(base_prompt) AS base_prompt, MIN(prompt_tokens) AS prompt_tokens,
               string_agg('Review ' || CAST(item_no AS VARCHAR) || ': ' || COALESCE(ctext, '<NA>'), chr(10) ORDER BY item_no) AS body
        FROM ch GROUP BY {key}, chunk_no),
per2 AS (SELECT *, MAX(chunk_no) OVER (PARTITION BY {key}) AS n_chunks,
                SUM(chunk_tokens) OVER (PARTITION BY {key}) + prompt_tokens AS total_tokens FROM per),
pr AS (SELECT {key}, chunk_no, n_chunks, n_items,
       base_prompt || chr(10) || chr(10)
       || CASE WHEN total_tokens > {limit} THEN printf('Processing chunk %d of %d (%d reviews)', chunk_no, n_chunks, n_items)
               || chr(10) || chr(10) ELSE '' END
       || 'Reviews to analyze:' || chr(10) || body || chr(10) || chr(10)
       || 'Please provide the analysis following the exact format specified above.' AS prompt
FROM per2)"""


MEAN4 = R('SUM(COALESCE(CAST(rating AS DOUBLE), 0.0)) / COUNT(*)', 4)


def review_pack_sql(limit: int) -> str:
    items = f"""SELECT rv.listing_id, {ORDER_ALL.replace('l_', 'rv.l_')},
         CASE WHEN f.floaty THEN CAST(CAST(rv.rating AS DOUBLE) AS VARCHAR) ELSE CAST(CAST(rv.rating AS BIGINT) AS VARCHAR) END
           || ' ' || rv.review AS text, h.base_prompt, h.prompt_tokens, {limit} - h.prompt_tokens AS budget
  FROM ({B_REVIEWS}) rv
  JOIN (SELECT listing_id, bool_or(rating IS NULL OR CAST(rating AS DOUBLE) <> floor(CAST(rating AS DOUBLE))) AS floaty
        FROM ({B_REVIEWS}) GROUP BY listing_id) f USING (listing_id)
  JOIN heads h USING (listing_id)"""
    items = f"SELECT *, CAST({_tok('text')} AS BIGINT) AS tokens FROM ({items})"
    return f"""WITH RECURSIVE per0 AS (SELECT listing_id, {MEAN4} AS m, COUNT(*) AS n FROM ({B_REVIEWS}) GROUP BY listing_id),
o AS (SELECT {R('AVG(m)', 4)} AS overall FROM per0),
heads0 AS (SELECT per0.listing_id,
                  replace(replace(replace(replace({_sql_str(LISTING_TEMPLATE)}, '{{ZIP_CODE_HERE}}', COALESCE(p.p_type, '')),
                          '{{ISO_CODE_HERE}}', 'us'), '{{RATING_AVERAGE_HERE}}', CAST(per0.m AS VARCHAR)),
                          '{{OVERALL_MEAN}}', CAST(o.overall AS VARCHAR)) AS base_prompt
           FROM per0 CROSS JOIN o LEFT JOIN part p ON p.p_partkey = per0.listing_id WHERE per0.n >= 5),
heads AS (SELECT *, CAST({_tok('base_prompt')} AS BIGINT) AS prompt_tokens FROM heads0),
{chunk_generic(items, 'listing_id', ORDER_ALL, 'budget')},
{prompt_from_chunks('listing_id', limit)}
SELECT * FROM pr"""


@q("review_pack")
def _():
    return review_pack_sql(120000)


@q("review_pack_tight")
def _():
    return review_pack_sql(80)


SUMMARIES = "SELECT source AS area, doc_id AS listing_id, CASE WHEN doc_id % 11 = 0 THEN '' ELSE text END AS summary FROM documents"
PACK = f"""SELECT area, pack_pos, listing_id, COUNT(*) OVER (PARTITION BY area) AS n_properties,
       'Listing ' || CAST(listing_id AS VARCHAR) || ':' || chr(10) || summary AS rendered
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY area ORDER BY listing_id) AS pack_pos FROM ({SUMMARIES})
      WHERE summary IS NOT NULL AND length(summary) > 0) WHERE pack_pos <= 100000"""


@q("area_summary_pack")
def _():
    return PACK


def area_prompts_sql(limit: int) -> str:
    items = f"""SELECT p.*, p.rendered AS text, CAST({_tok('p.rendered')} AS BIGINT) AS tokens, h.base_prompt, h.prompt_tokens,
         {limit} - h.prompt_tokens AS budget
  FROM ({PACK}) p JOIN heads h USING (area)"""
    return f"""WITH RECURSIVE o AS (SELECT {R('AVG(m)', 4)} AS overall FROM (SELECT {MEAN4} AS m FROM ({B_REVIEWS}) GROUP BY listing_id)),
heads0 AS (SELECT DISTINCT area, replace(replace(replace({_sql_str(AREA_TEMPLATE)}, '{{ZIP_CODE_HERE}}', area),
                  '{{ISO_CODE_HERE}}', 'us'), '{{OVERALL_MEAN}}', CAST(o.overall AS VARCHAR)) AS base_prompt
           FROM ({PACK}) CROSS JOIN o),
heads AS (SELECT *, CAST({_tok('base_prompt')} AS BIGINT) AS prompt_tokens FROM heads0),
{chunk_generic(items, 'area', 'pack_pos', 'budget')},
{prompt_from_chunks('area', limit)}
SELECT pr.*, c.n_properties FROM pr JOIN (SELECT DISTINCT area, n_properties FROM ({PACK})) c USING (area)"""


@q("area_prompts")
def _():
    return area_prompts_sql(120000)


@q("area_prompts_tight")
def _():
    return area_prompts_sql(1000)



@q("threshold_label")
def _():
    return f"""WITH {TIER_CTES}
SELECT metric,
       CASE WHEN metric = 'adr' THEN printf('$%.2f', {R('hi', 2)}) ELSE printf('%.1f%%', {R('hi', 1)}) END AS high_label,
       CASE WHEN metric = 'adr' THEN printf('$%.2f', {R('lo', 2)}) ELSE printf('%.1f%%', {R('lo', 1)}) END AS low_label
FROM th"""


LAST_FILE = f"""SELECT listing_id, {R('SUM(COALESCE(CAST(rating AS DOUBLE), 0.0)) / COUNT(*)', 4)} AS mean_rating, COUNT(*) AS n_reviews
FROM (SELECT *, strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS file,
             MAX(strftime(CAST(l_shipdate AS DATE), '%Y-%m')) OVER (PARTITION BY listing_id) AS last FROM ({B_REVIEWS}))
WHERE file = last GROUP BY listing_id"""


@q("stream_review_ratings")
def _():
    return LAST_FILE


@q("stream_overall_mean")
def _():
    return f"SELECT {R('AVG(mean_rating)', 4)} AS overall_mean FROM ({LAST_FILE})"


@q("stream_request_cost")
def _():
    """Windows closed by the watermark (latest time seen less 20 minutes), without rows that arrived after that."""
    return f"""WITH c AS (SELECT *, 1704067200 + listing_id * 600 + turn * 30 AS s FROM ({COSTED})),
a AS (SELECT *, s // 3600 * 3600 + 3600 AS w_end, LEAST(3, CAST(FLOOR((s - MIN(s) OVER ()) * 4 / (MAX(s) OVER () - MIN(s) OVER () + 1)) AS INTEGER)
             + CASE WHEN listing_id % 7 = 0 THEN 1 ELSE 0 END) AS arrival FROM c),
m AS (SELECT arrival, MAX(s) AS seen FROM a GROUP BY arrival),
wm AS (SELECT x.arrival, MAX(y.seen) - 1200 AS mark FROM (SELECT DISTINCT arrival FROM a) x LEFT JOIN m y ON y.arrival < x.arrival GROUP BY x.arrival),
k AS (SELECT a.* FROM a JOIN wm USING (arrival) WHERE mark IS NULL OR w_end > mark)
SELECT session, to_timestamp(w_end - 3600) AT TIME ZONE 'UTC' AS window_start, COUNT(*) AS total_requests,
       CAST(SUM(CASE WHEN cached THEN 1 ELSE 0 END) AS BIGINT) AS cache_hits,
       CAST(SUM(CASE WHEN NOT cached THEN input_tokens ELSE 0 END) AS BIGINT) AS total_input_tokens,
       CAST(SUM(CASE WHEN NOT cached THEN output_tokens ELSE 0 END) AS BIGINT) AS total_output_tokens,
       {R('SUM(CASE WHEN NOT cached THEN cost ELSE 0.0 END)', 4)} AS total_cost
FROM k WHERE w_end <= (SELECT MAX(s) - 1200 FROM a) GROUP BY session, w_end"""


# ---------------------------------------------------------------- source / sink round trips
@q("read_search_results")
def _():
    return f"SELECT CAST(area AS VARCHAR) AS area, CAST(listing_id AS VARCHAR) AS listing_id, lat, lon FROM ({PTS})"


@q("read_summaries")
def _():
    return """SELECT source AS area, CAST(doc_id AS VARCHAR) AS listing_id,
       CAST(length(CASE WHEN doc_id % 11 = 0 THEN '' ELSE text END) AS INTEGER) AS summary_chars FROM documents"""


@q("write_matrix")
def _():
    return SQL["clean_built_matrix"]


@q("read_matrix")
def _():
    return f"SELECT listing_id, ADR, Days_Avail, capacity, bedrooms, {_ICON_COLS} FROM ({BUILT})"


@q("write_side_tables")
def _():
    return f"""SELECT listing_id, text, "table" FROM (
  SELECT listing_id, description AS text, 'descriptions' AS "table" FROM ({DET})
  UNION ALL SELECT listing_id, 'Quiet hours for ' || p_brand, 'house_rules' FROM ({DET})
  UNION ALL SELECT listing_id, p_type, 'neighborhood_highlights' FROM ({DET}) WHERE p_size % 2 = 0) WHERE text IS NOT NULL"""


@q("write_summaries")
def _():
    t = "CASE WHEN doc_id % 11 = 0 THEN '' ELSE text END"
    return f"""SELECT source AS area, CAST(doc_id AS VARCHAR) AS listing_id, CAST(length({t}) AS INTEGER) AS summary_chars,
       md5({t}) AS summary_md5 FROM documents"""


@q("render_area_report")
def _():
    return """WITH f AS (SELECT source AS area, doc_id, text FROM documents WHERE doc_id % 11 <> 0 AND length(text) > 0)
SELECT area, '# Area Summary: ' || area || chr(10) || chr(10) || '**ISO Code:** us' || chr(10) || chr(10)
       || '**Properties Analyzed:** ' || COUNT(*) || chr(10) || chr(10) || '---' || chr(10) || chr(10) || arg_min(text, doc_id) AS report
FROM f WHERE area IS NOT NULL GROUP BY area"""


@q("write_market_master")
def _():
    return f"""SELECT p.p_type AS area, m.listing_id, m.ADR, m.Occupancy, m.Days_Available
FROM ({B_MARKET}) m JOIN part p ON p.p_partkey = m.listing_id"""


@q("write_reviews")
def _():
    return f"""SELECT p.p_type AS area, r.listing_id, {MEAN4} AS mean_rating, COUNT(*) AS n_reviews
FROM ({B_REVIEWS}) r JOIN part p ON p.p_partkey = r.listing_id GROUP BY p.p_type, r.listing_id"""


@q("write_tier_stats")
def _():
    return f"""WITH ta AS ({SQL["tier_analysis"]}),
x AS (WITH {TIER_CTES}
      SELECT p.metric, p.t AS amenity_comparison, n.t AS numeric_comparison FROM
        (SELECT metric, string_agg(amenity || ':' || high_tier_pct || ':' || low_tier_pct || ':' || difference, ';' ORDER BY rank) AS t
         FROM pvr GROUP BY metric) p JOIN
        (SELECT metric, string_agg(attribute || ':' || high_tier_avg || ':' || low_tier_avg || ':' || difference, ';' ORDER BY attribute_pos) AS t
         FROM nm GROUP BY metric) n USING (metric))
SELECT 'all' AS zipcode, ta.* EXCLUDE (comparison_text), x.amenity_comparison, x.numeric_comparison FROM ta JOIN x USING (metric)"""


@q("write_quality_stats")
def _():
    return SQL["premium_pipeline"]


@q("render_report")
def _():
    hi = f"CASE WHEN th.metric = 'adr' THEN printf('$%.2f', {R(R('hi', 2), 2)}) ELSE printf('%.1f%%', {R(R('hi', 2), 1)}) END"
    lo = f"CASE WHEN th.metric = 'adr' THEN printf('$%.2f', {R(R('lo', 2), 2)}) ELSE printf('%.1f%%', {R(R('lo', 2), 1)}) END"
    nl = "chr(10)"
    return f"""WITH {TIER_CTES}, {COMPARISON_SQL},
cnt AS (SELECT metric, SUM(CASE WHEN tier = 'high' THEN 1 ELSE 0 END) AS hc,
               SUM(CASE WHEN tier = 'low' THEN 1 ELSE 0 END) AS lc FROM tiered GROUP BY metric)
SELECT th.metric,
       '# ' || CASE th.metric WHEN 'adr' THEN 'Average Daily Rate' WHEN 'occupancy' THEN 'Occupancy Rate' END
       || ' Correlation Analysis' || {nl} || {nl} || '**Zipcode:** all' || {nl} || {nl}
       || '**High Tier:** ' || {hi} || ' (top 25%, n=' || CAST(hc AS VARCHAR) || ')' || {nl} || {nl}
       || '**Low Tier:** ' || {lo} || ' (bottom 25%, n=' || CAST(lc AS VARCHAR) || ')' || {nl} || {nl}
       || '---' || {nl} || {nl} || comparison_text AS report
FROM th JOIN cnt USING (metric) JOIN ct USING (metric)"""


@q("write_request_log")
def _():
    return """SELECT session, recency FROM (
  SELECT user_id AS session, CAST(ROW_NUMBER() OVER (ORDER BY date_trunc('day', MIN(ts)) DESC, user_id DESC) AS INTEGER) AS recency
  FROM events GROUP BY user_id)
WHERE recency <= 100"""


@q("normalize_reviews")
def _():
    k = "(l_orderkey + l_linenumber)"
    return f"""SELECT listing_id, l_orderkey, l_linenumber,
       CASE WHEN {k} % 5 = 0 THEN '' WHEN {k} % 7 = 0 THEN NULL ELSE review END AS review,
       CASE WHEN {k} % 3 = 0 THEN 0.0 ELSE CAST(rating AS DOUBLE) END AS rating FROM ({B_REVIEWS})"""


@q("read_reviews")
def _():
    return f"""WITH r AS (SELECT *, strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS file FROM ({B_REVIEWS})),
w AS (SELECT *, MAX(file) OVER (PARTITION BY listing_id) AS last FROM r)
SELECT CAST(listing_id AS VARCHAR) AS listing_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY listing_id ORDER BY {ORDER_ALL}) - 1 AS INTEGER) AS pos,
       review, CAST(rating AS DOUBLE) AS rating FROM w WHERE file = last"""


@q("missing_file")
def _():
    names = ["search_results", "listing_details", "market_metrics", "reviews", "summaries", "descriptions", "matrix"]
    return " UNION ALL ".join(f"SELECT '{n}' AS source, true AS has_key, CAST(0 AS BIGINT) AS rows" for n in names)


@q("select_numeric_features")
def _():
    return f"SELECT listing_id, Days_Avail, capacity, bedrooms, beds, bathrooms, {_ICON_COLS} FROM ({SQL['clean_built_matrix']})"


@q("synthesis_prompt")
def _():
    tmpl = ("Area {ZIPCODE}: R2={R_SQUARED} over {NUM_PROPERTIES} properties\n\n{CORRELATION_TABLE}\n\n"
            "Top:\n{HIGH_PREMIUM_DESCRIPTIONS}\n\nBottom:\n{LOW_PREMIUM_DESCRIPTIONS}")
    scores = "concat_ws(', ', " + ", ".join(f"CASE WHEN {d} IS NOT NULL THEN '{d}: ' || CAST({d} AS VARCHAR) END"
                                            for d in ("quality", "toxic", "word_count")) + ")"
    line = (f"printf('**Property %s** ([Airbnb listing](%s)) (ADR premium: $%+.0f/night)', CAST(listing_id AS VARCHAR), "
            f"'{LISTING_URL_PREFIX}' || CAST(listing_id AS VARCHAR), {R('residual', 0)}) || "
            f"CASE WHEN {scores} <> '' THEN chr(10) || '  Scores: ' || {scores} ELSE '' END || chr(10) || description || chr(10)")
    head = "| Dimension | Correlation | n |\n|-----------|-------------|---|\n"
    fills = [("ZIPCODE", "'all'"), ("R_SQUARED", "r2"), ("CORRELATION_TABLE", "ct"), ("HIGH_PREMIUM_DESCRIPTIONS", "tt"),
             ("LOW_PREMIUM_DESCRIPTIONS", "bt"), ("NUM_PROPERTIES", "np")]
    text = _sql_str(tmpl)
    for name, col in fills:
        text = f"replace({text}, '{{{name}}}', {col})"
    return f"""WITH {SCORE_CTES},
r2 AS (SELECT CASE WHEN var_samp(d.n_chars) * (COUNT(*) - 1) > 0
                   THEN 1.0 - SUM(rs.residual * rs.residual) / (var_samp(d.n_chars) * (COUNT(*) - 1)) ELSE 0.0 END AS v, COUNT(*) AS n
       FROM rs JOIN documents d ON d.doc_id = rs.listing_id),
tk AS (SELECT rtb.*, sc.quality, sc.toxic, sc.word_count, d.text AS description
       FROM rtb LEFT JOIN sc USING (listing_id) JOIN documents d ON d.doc_id = rtb.listing_id),
parts AS (SELECT (SELECT printf('%.3f', {R('v', 3)}) FROM r2) AS r2, (SELECT CAST(n AS VARCHAR) FROM r2) AS np,
                 {_sql_str(head)} || (SELECT string_agg(printf('| %s | %+.3f | %d |', {_initcap("replace(dimension, '_', ' ')")}, {R('correlation', 3)}, n), chr(10) ORDER BY rank) FROM dc) AS ct,
                 (SELECT string_agg({line}, chr(10) ORDER BY rank) FROM tk WHERE side = 'top') AS tt,
                 (SELECT string_agg({line}, chr(10) ORDER BY rank) FROM tk WHERE side = 'bottom') AS bt)
SELECT {text} AS prompt FROM parts"""


@q("tier_thresholds_by_area")
def _():
    return f"""WITH {TIER_CTES},
tha AS (SELECT area, metric, quantile_cont(value, 0.75) AS hi, quantile_cont(value, 0.25) AS lo, COUNT(*) AS n_valid
        FROM lng GROUP BY area, metric HAVING COUNT(*) >= 4),
ta AS (SELECT lng.area, lng.metric, 'high' AS tier FROM lng JOIN tha USING (area, metric) WHERE value >= hi
       UNION ALL
       SELECT lng.area, lng.metric, 'low' AS tier FROM lng JOIN tha USING (area, metric) WHERE value <= lo)
SELECT tha.area, tha.metric, {R('hi', 6)} AS high_threshold, {R('lo', 6)} AS low_threshold, n_valid, tier, COUNT(*) AS n
FROM tha JOIN ta USING (area, metric) GROUP BY tha.area, tha.metric, hi, lo, n_valid, tier"""


@q("overall_mean_rating_by_area")
def _():
    return f"""WITH per AS (SELECT p.p_type AS area, r.listing_id, {MEAN4} AS m
             FROM ({B_REVIEWS}) r JOIN part p ON p.p_partkey = r.listing_id GROUP BY p.p_type, r.listing_id)
SELECT area, {R('AVG(m)', 4)} AS overall_mean, COUNT(*) AS n_listings FROM per GROUP BY area"""


@q("extract_kpis_pages")
def _():
    h = "substring(page_text, 1, 500)"
    return f"""WITH pg AS (SELECT page_id AS listing_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS page_text FROM pages)
SELECT listing_id,
       {R(f"COALESCE({_revenue(_x('page_text', KPI_REVENUE))}, 0.0)", 2)} AS Revenue,
       COALESCE({_money(_x('page_text', KPI_ADR))}, 0.0) AS ADR,
       COALESCE({_pct(_x('page_text', KPI_OCCUPANCY))}, 0) AS Occupancy,
       COALESCE({_days(_x('page_text', KPI_DAYS))}, 0) AS Days_Available,
       TRY_CAST({_x('page_text', HDR_RATING, 1)} AS DOUBLE) AS Rating,
       TRY_CAST({_x('page_text', HDR_RATING, 2)} AS INTEGER) AS Review_Count,
       TRY_CAST({_x(h, HDR_BED)} AS INTEGER) AS Bedrooms, TRY_CAST({_x(h, HDR_BATH)} AS DOUBLE) AS Bathrooms,
       TRY_CAST({_x(h, HDR_GUEST)} AS INTEGER) AS Max_Guests
FROM pg"""


@q("tier_insight_prompts")
def _():
    hi = f"CASE WHEN th.metric = 'adr' THEN printf('$%.2f', {R('hi', 2)}) ELSE printf('%.1f%%', {R('hi', 1)}) END"
    lo = f"CASE WHEN th.metric = 'adr' THEN printf('$%.2f', {R('lo', 2)}) ELSE printf('%.1f%%', {R('lo', 1)}) END"
    fills = [("ZIPCODE", "'all'"), ("HIGH_THRESHOLD", hi), ("LOW_THRESHOLD", lo), ("TOP_PERCENTILE", "'25'"),
             ("BOTTOM_PERCENTILE", "'25'"), ("FEATURE_COMPARISON", "comparison_text"),
             ("HIGH_TIER_DESCRIPTIONS", f"COALESCE(NULLIF(shi, ''), {_sql_str(NO_DESCRIPTIONS)})"),
             ("LOW_TIER_DESCRIPTIONS", f"COALESCE(NULLIF(slo, ''), {_sql_str(NO_DESCRIPTIONS)})")]
    expr = _sql_str(INSIGHT_TEMPLATE)
    for k, v in fills:
        expr = f"replace({expr}, '{{{k}}}', {v})"
    return f"""WITH {TIER_CTES}, {COMPARISON_SQL},
s AS (SELECT * FROM (SELECT metric, tier, listing_id,
             ROW_NUMBER() OVER (PARTITION BY metric, tier ORDER BY ADR DESC NULLS LAST, listing_id) AS sample_rank
      FROM tiered) WHERE sample_rank <= 3),
sd AS (SELECT s.metric, s.tier, s.sample_rank,
              'Property ' || CAST(s.listing_id AS VARCHAR) || ': ' ||
              CASE WHEN length(d.text) > 500 THEN substring(d.text, 1, 500) || '...' ELSE d.text END AS sample
       FROM s JOIN documents d ON d.doc_id = s.listing_id),
sb AS (SELECT metric,
              string_agg(CASE WHEN tier = 'high' THEN sample END, chr(10) || chr(10) ORDER BY sample_rank) AS shi,
              string_agg(CASE WHEN tier = 'low' THEN sample END, chr(10) || chr(10) ORDER BY sample_rank) AS slo
       FROM sd GROUP BY metric)
SELECT th.metric, {expr} AS prompt
FROM th JOIN ct USING (metric) LEFT JOIN sb USING (metric)"""


@q("render_quality_report")
def _():
    nl = "chr(10)"
    line = (f"CAST(rank AS VARCHAR) || '. **' || CAST(listing_id AS VARCHAR) || '** — ADR premium $' || "
            f"printf('%+.0f', {R('residual', 0)}) || '/night — [View on Airbnb](' || '{LISTING_URL_PREFIX}' || "
            f"CAST(listing_id AS VARCHAR) || ')'")
    r2 = ("CASE WHEN var_samp(actual) * (COUNT(*) - 1) > 0 THEN 1.0 - SUM(residual * residual) / "
          "(var_samp(actual) * (COUNT(*) - 1)) ELSE 0.0 END")
    return f"""WITH {OLS_CTES}, {SCORE_CTES.strip().lstrip(',')},
agg AS (SELECT printf('%.3f', {R(r2, 3)}) AS r2, CAST(COUNT(*) AS VARCHAR) AS n FROM res),
sc_n AS (SELECT CAST(COUNT(*) AS VARCHAR) AS s FROM sc JOIN res USING (listing_id)),
tops AS (SELECT string_agg({line}, {nl} ORDER BY rank) AS top FROM tbr WHERE side = 'top'),
bots AS (SELECT string_agg({line}, {nl} ORDER BY rank) AS bottom FROM tbr WHERE side = 'bottom'),
body AS (SELECT string_agg(printf('| %s | %+.3f | %d |', dimension, {R('correlation', 3)}, n), {nl} ORDER BY rank) AS b FROM dc)
SELECT '# Listing Description Quality Analysis' || {nl} || {nl} || '**Zipcode:** all' || {nl} || {nl}
       || '**Feature-Adjustment R²:** ' || r2 || ' (proportion of ADR variance explained by 2 features: capacity, retail_price)'
       || {nl} || {nl} || '**Properties Analyzed:** ' || n || ' (' || s || ' descriptions scored)' || {nl} || {nl}
       || '## Property Links' || {nl} || {nl} || '### Top 15 — Highest ADR Premium' || {nl} || {nl} || top || {nl}
       || '### Bottom 15 — Lowest ADR Premium' || {nl} || {nl} || bottom || {nl} || '---' || {nl} || {nl} || b AS report
FROM agg, sc_n, tops, bots, body"""
