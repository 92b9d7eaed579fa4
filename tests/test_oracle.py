"""Every named query against its SQL; ``TEST_SF_DIR`` picks the data."""

import pytest
from conftest import SMALL, plan_of
from oracle import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    assert compare(spark, duck, SMALL, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n.startswith("dt_")))
def test_dates_do_not_depend_on_the_zone(spark, duck, setting, name):
    setting("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare(spark, duck, SMALL, QUERIES[name], ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


SCALED = (
    "enc_count_union_nulls agg_uid_stats agg_mode_dist pred_isin_flag flagship prof_describe prof_describe_by_class "
    "cv_group_folds enc_label prof_category_counts join_lookup ev_auc_by_fold filter_rows_head_tail"
).split()


@pytest.mark.parametrize("name", SCALED)
def test_results_hold_with_the_plans_for_large_tables(spark, duck, no_broadcast, setting, name):
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    setting("spark.ledgerloom.rowsPerTask", 300)
    assert compare(spark, duck, SMALL, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", ["flagship", "agg_uid_stats", "agg_period_zscore", "enc_label", "fn_contains_rules"])
def test_plans_stay_in_the_jvm_without_products(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert not any(bad in plan for bad in ("PythonUDF", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"))
