"""Plan guards: pushdown, no Python on the data path, no whole-table single-task steps."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["cl_profile_full", "cl_profile_masked", "cl_profile_cyr", "tx_first_word",
                                  "vz_tfidf", "sq_pad_pre", "cl_lemma_join"])
def test_text_has_no_python_udf(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    assert "EvalPython" not in p and "PythonUDF" not in p


@pytest.mark.parametrize("name", ["bk_features", "agg_conditional", "agg_all_stats6", "ts_trail_site_forecast",
                                  "enc_target_smooth", "jn_index_left", "win_cumcount"])
def test_no_single_partition_window(spark, name):
    """No window runs over a whole table in one task (one-row global
    aggregates may still merge their partial rows in one partition)."""
    lines = _plan(E.queries()[name](spark, SF)).splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            below = next((x for x in lines[i + 1:] if "Exchange" in x), "")
            assert "SinglePartition" not in below, line


def test_filter_and_projection_reach_the_scan(spark):
    df = E.queries()["flt_predicate"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double" in p


def test_conditional_aggregation_scans_once(spark):
    p = _plan(E.queries()["agg_conditional"](spark, SF))
    assert p.count("FileScan parquet") == 1


@pytest.mark.parametrize("name", ["bk_features", "enc_target_smooth", "vz_tfidf", "nm_scale", "jn_three_way",
                                  "fs_drift", "mt_auc"])
def test_no_cartesian_product(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
