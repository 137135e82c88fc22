"""What the optimizer makes of the plans, on stored silver."""

from __future__ import annotations

import pytest

from tillroll.layers import SILVER
from tillroll.operators.upsert import matched_keys, upsert
from tillroll.plans.customers import customer_latest, customers
from tillroll.plans.sales import sales
from tillroll.workload import inputs


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shape") / "silver")
    inputs.silver(spark, "/root/testdata/sf0.001").write.parquet(path)
    return spark.read.schema(SILVER).parquet(path)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_customers_scan_silver_once_without_expand(silver):
    text = plan(customers(silver, inputs.ANCHOR))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert "Expand" not in text
    assert "ship_mode" not in text.split("ReadSchema")[1]


def test_aggregates_run_before_the_shuffle(silver):
    assert "partial_min" in plan(sales(silver))
    assert "partial_max" in plan(customers(silver, inputs.ANCHOR))
    assert "WindowGroupLimit" in plan(customer_latest(silver))


def test_filters_and_columns_reach_the_scan(silver):
    text = plan(sales(silver.filter("order_id = 'ORD-1'")))
    assert "EqualTo(order_id,ORD-1)" in text
    assert "segment" not in text.split("ReadSchema")[1]


def test_matched_keys_read_only_the_key(silver):
    text = plan(matched_keys(silver, silver.filter("row_id % 13 = 0"), "row_id"))
    assert text.count("ReadSchema: struct<row_id:int>") == 2


def test_upsert_has_no_cross_join(silver):
    text = plan(upsert(silver, silver.filter("row_id % 13 = 0"), "row_id"))
    assert "Cartesian" not in text and "NestedLoop" not in text
