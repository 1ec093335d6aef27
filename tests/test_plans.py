"""Plan properties of the main queries, planned as for large tables."""

import re

import pytest

from basketry.operators import fills, quantiles, summaries
from basketry.plans.queries import REGISTRY
from conftest import SF_SMALL

QUERIES = ["customer_rfm", "customer_lifetime_value", "customer_features", "items_per_customer",
           "returns_per_customer", "cohort_retention", "return_drivers", "revenue_by_day", "purchase_summary",
           "churn_labels", "chi_square", "welch_t", "order_kpis", "num_orders_histogram", "customer_describe"]


@pytest.fixture(scope="module")
def big_table_planning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(spark, name):
    return REGISTRY[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, table, scans", [
    ("customer_features", "orders", 1), ("customer_features", "lineitem", 1), ("revenue_by_day", "orders", 1),
    ("revenue_by_month", "orders", 1), ("orders_by_day", "orders", 1), ("customer_describe", "orders", 1),
    # filled summaries: fill values and join read the same written sides (items and returns both stand in
    # lineitem; distinct types and texts of interactions are two aggregates of events)
    ("order_summary", "events", 2), ("order_summary", "supplier", 1), ("order_summary", "lineitem", 2),
    ("customer_summary", "events", 2), ("customer_summary", "supplier", 1), ("customer_summary", "lineitem", 2)])
def test_one_scan_per_table(spark, big_table_planning, monkeypatch, name, table, scans):
    """Scans of the result's plan and of all tables written while it is built."""
    plans = []
    for module in (summaries, fills, quantiles):
        real = module.materialise

        def spy(df, label, real=real):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return real(df, label)

        monkeypatch.setattr(module, "materialise", spy)
    plans.append(_plan(spark, name))
    assert sum(len(re.findall(rf"FileScan.*/{table}\.parquet", p)) for p in plans) == scans


@pytest.mark.parametrize("name, absent", [
    ("order_kpis", ["customer", "part", "events", "supplier"]), ("welch_t", ["lineitem", "part", "events", "supplier"]),
    ("num_orders_histogram", ["lineitem", "part", "events", "supplier"]), ("returns_by_reason", ["customer", "part", "events"]),
    ("revenue_pivot", ["lineitem", "part", "events", "supplier"])])
def test_summaries_read_only_their_tables(spark, big_table_planning, name, absent):
    plan = _plan(spark, name)
    assert not [t for t in absent if f"/{t}.parquet" in plan]


@pytest.mark.parametrize("name", QUERIES)
def test_no_cartesian_and_pruned_scans(spark, big_table_planning, name):
    plan = _plan(spark, name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    for cols in re.findall(r"FileScan parquet \[([^\]]*)\].*?lineitem\.parquet", plan):
        # lineitem has 11 columns; no query needs all of them
        assert len(cols.split(",")) < 11


def test_revenue_by_day_reads_orders_only(spark, big_table_planning):
    plan = REGISTRY["revenue_by_day"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" in plan and "customer.parquet" not in plan and "lineitem.parquet" not in plan
