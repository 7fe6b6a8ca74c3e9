import pytest

from conftest import SF_SMALL, has_data


@pytest.mark.skipif(not has_data(), reason="driver tables not present")
def test_entry_and_registry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 100


@pytest.mark.skipif(not has_data(), reason="driver tables not present")
@pytest.mark.parametrize("name", ["tier_analysis", "chunk_reviews_tight", "ols_fit", "stage_freshness",
                                  "build_matrix", "stream_request_cost"])
def test_queries_run_on_smallest_tables(spark, name):
    import __spark_entry__ as e
    assert e.queries()[name](spark, SF_SMALL).count() >= 0
