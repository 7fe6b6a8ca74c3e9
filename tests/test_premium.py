import numpy as np

from staylens.operators import premium as pm
from staylens.operators import prompts as pr


def _fixture(spark):
    cols = ["ADR", "capacity", "bedrooms", "beds", "bathrooms", "SYSTEM_POOL", "SYSTEM_PETS", "Days_Avail"]
    data = [[350, 4, 2, 3, 1, 1, 0, 200], [500, 6, 3, 5, 2, 1, 1, 300], [250, 2, 1, 2, 1, 0, 0, 150],
            [700, 10, 5, 8, 3, 1, 1, 350], [300, 4, 2, 3, 1, 0, 1, 180], [450, 6, 3, 4, 2, 0, 0, 250],
            [600, 8, 4, 6, 2, 1, 1, 320], [200, 2, 1, 2, 1, 0, 0, 100]]
    rows = [(f"prop_{i + 1}", *map(float, r)) for i, r in enumerate(data)]
    return spark.createDataFrame(rows, ", ".join(["listing_id string"] + [f"{c} double" for c in cols])), data


def test_residuals_sum_to_zero_and_match_numpy(spark):
    df, data = _fixture(spark)
    model = pm.ols_fit(df)
    assert model.ok and len(model.features) == 7
    res = pm.ols_residuals(df, model).orderBy("listing_id").collect()
    assert abs(sum(r["residual"] for r in res)) < 1e-6
    a = np.asarray(data, dtype=float)
    x = np.column_stack([np.ones(len(a)), a[:, 1:]])
    coef, *_ = np.linalg.lstsq(x, a[:, 0], rcond=None)
    expected = a[:, 0] - x @ coef
    assert np.allclose([r["residual"] for r in res], expected, atol=1e-6)
    r2 = pm.r_squared(pm.ols_residuals(df, model)).collect()[0]["r_squared"]
    assert 0.0 <= r2 <= 1.0


def test_exact_collinear_data(spark):
    rows = [(c, 200.0 * (i + 1), 2.0 * (i + 1), float(i + 1), float(i + 1), float(i + 1))
            for i, c in enumerate("abcdef")]
    df = spark.createDataFrame(rows, "listing_id string, ADR double, capacity double, bedrooms double, "
                                     "beds double, bathrooms double")
    model = pm.ols_fit(df)
    res = pm.ols_residuals(df, model)
    assert all(abs(r["residual"]) < 1e-6 for r in res.collect())
    assert pm.r_squared(res).collect()[0]["r_squared"] > 0.99


def test_too_few_rows_and_nulls_dropped_zero_kept(spark):
    df = spark.createDataFrame([("a", 100.0, 0.0), ("b", 200.0, None), ("c", None, 1.0)],
                               "listing_id string, ADR double, capacity double")
    frame, feats = pm.regression_frame(df)
    assert [r["listing_id"] for r in frame.collect()] == ["a"]
    assert not pm.ols_fit(df).ok


def test_pearson_signs_and_zero_variance(spark):
    scores = spark.createDataFrame([(f"p{i}", float(i + 1), float(8 - i), 5.0) for i in range(8)],
                                   "listing_id string, evocativeness double, specificity double, flat double")
    res = spark.createDataFrame([(f"p{i}", float(i + 1)) for i in range(8)], "listing_id string, residual double")
    out = {r["dimension"]: r for r in pm.dimension_correlation(scores, res).collect()}
    assert out["evocativeness"]["correlation"] > 0.99 and out["specificity"]["correlation"] < -0.99
    assert out["flat"]["correlation"] == 0.0 and out["flat"]["n"] == 8


def test_parse_score_json(spark):
    df = spark.createDataFrame([("a", '```json\n{"evocativeness": 5, "specificity": 3}\n```'),
                                ("b", "This is not JSON at all"), ("c", None),
                                ("d", '{"x": true, "y": "7", "z": 2.5}')], "listing_id string, response string")
    out = sorted((r["listing_id"], r["dimension"], r["score"]) for r in pr.parse_score_json(df).collect())
    assert out == [("a", "evocativeness", 5.0), ("a", "specificity", 3.0), ("d", "z", 2.5)]


def test_top_bottom_premium_overlap_when_small(spark):
    res = spark.createDataFrame([(f"p{i}", float(i)) for i in range(20)], "listing_id string, residual double")
    tb = pm.top_bottom_premium(res, k=15).collect()
    top = sorted((r["rank"], r["listing_id"]) for r in tb if r["side"] == "top")
    bottom = sorted((r["rank"], r["listing_id"]) for r in tb if r["side"] == "bottom")
    assert top[0] == (1, "p19") and len(top) == 15
    assert bottom[0] == (1, "p14") and bottom[-1] == (15, "p0")


def test_wide_rank_deficient_design_matches_numpy(spark):
    rng = np.random.default_rng(5)
    n, p = 200, 30
    x = rng.normal(size=(n, p))
    x[:, 7] = 2.0 * x[:, 3] - x[:, 11]  # exact collinearity -> rank p - 1
    y = 300 + x @ rng.normal(size=p) * 10 + rng.normal(size=n)
    y = y - y.min() + 1.0  # valid (positive) labels
    cols = [f"f{i}" for i in range(p)]
    rows = [(f"l{i}", float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(["listing_id string", "ADR double"] + [f"{c} double" for c in cols]))
    model = pm.ols_fit(df, "ADR", cols)
    got = {r["listing_id"]: r["residual"] for r in pm.ols_residuals(df, model).collect()}
    design = np.column_stack([np.ones(n), x])
    coef, *_ = np.linalg.lstsq(design, y, rcond=None)
    exp = y - design @ coef
    assert np.allclose([got[f"l{i}"] for i in range(n)], exp, atol=1e-6)


def test_ols_keeps_a_rare_flag_beside_a_large_scale(spark):
    import numpy as np
    from staylens.operators import premium as pm
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1e5, 4000)
    flag = (np.arange(4000) % 400 == 0).astype(float)
    y = 10 + 0.002 * x + 300 * flag + rng.normal(0, 1, 4000)
    df = spark.createDataFrame([(f"l{i}", float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, flag, y))],
                               "listing_id string, x double, flag double, y double")
    model = pm.ols_fit(df, "y", ["x", "flag"])
    got = dict(zip(model.features, model.coefficients))
    assert abs(got["flag"] - 300) < 2 and abs(got["x"] - 0.002) < 1e-6


def test_premium_pipeline_on_a_wide_matrix_with_dependent_columns(spark):
    """70 features (three Gram tiles a side), among them a copy, a sum and a
    constant: fit, correlations, lists and record against numpy."""
    from staylens.plans.premium import premium_pipeline
    rng = np.random.default_rng(8)
    n, p = 300, 70
    x = rng.normal(size=(n, p)) * 10.0 ** rng.integers(-2, 4, size=p)
    x[:, 10], x[:, 40], x[:, 65] = x[:, 3], x[:, 5] + x[:, 60], 7.0
    y = 500 + x[:, :20] @ (rng.normal(size=20) / 10.0 ** np.log10(np.abs(x[:, :20]).max(axis=0))) * 40 + rng.normal(size=n)
    feats = [f"f{i}" for i in range(p)]
    rows = [(i, float(y[i]), *map(float, x[i]), "text") for i in range(n)]
    matrix = spark.createDataFrame(rows, "listing_id long, ADR double, " + ", ".join(f"{f} double" for f in feats) + ", note string")
    score = [(i, float(rng.integers(1, 6)), None if i % 3 else float(i)) for i in range(0, n + 50, 2)]
    out = premium_pipeline(matrix, spark.createDataFrame(score, "listing_id long, a double, b double"), ["a", "b"], "97067")
    design = np.column_stack([np.ones(n), x / np.abs(x).max(axis=0)])
    want = y - design @ np.linalg.lstsq(design, y, rcond=None)[0]
    assert out["model"].rank == p - 3 and out["model"].features == feats
    got = {r["listing_id"]: r["residual"] for r in out["residuals"].collect()}
    assert np.allclose([got[i] for i in range(n)], want, atol=1e-6)
    rec = out["record"].collect()[0]
    assert rec["regression_features_used"] == feats and rec["zipcode"] == "97067"
    assert rec["num_properties_analyzed"] == n and rec["num_descriptions_scored"] == n // 2
    assert abs(rec["regression_r_squared"] - (1 - (want ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-4
    pairs = {d: [(s[k], want[s[0]]) for s in score if s[0] < n and s[k] is not None] for d, k in (("a", 1), ("b", 2))}
    corr = {c["dimension"]: (c["correlation"], c["n"]) for c in rec["dimension_correlations"]}
    for d, xy in pairs.items():
        assert corr[d][1] == len(xy) and abs(corr[d][0] - np.corrcoef(np.array(xy).T)[0, 1]) < 1e-4
    assert [abs(c["correlation"]) for c in rec["dimension_correlations"]] == sorted((abs(c) for c, _ in corr.values()), reverse=True)
    top = [r["listing_id"] for r in sorted(out["top_bottom"].collect(), key=lambda r: r["rank"]) if r["side"] == "top"]
    assert top == np.argsort(-want)[:15].tolist()
    few = premium_pipeline(matrix.limit(20), spark.createDataFrame(score, "listing_id long, a double, b double"), ["a", "b"])
    assert not few["model"].ok and few["record"].count() == 0 and few["top_bottom"].count() == 0
