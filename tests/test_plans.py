from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tillroll.layers import CUSTOMER_KEY, GOLD_CUSTOMER, GOLD_SALES, SILVER
from tillroll.plans.customers import customer_latest, customer_metrics, customers
from tillroll.plans.sales import sales
from tillroll.plans import silver as silver_plan
from tillroll.plans.silver import conform, keyed_rows, keyed_rows_by_count, keyless_rows
from tillroll.workload import inputs

TINY = "/root/testdata/sf0.001"
ANCHOR = date(2018, 12, 30)
FIELDS = ["customer_id", "order_id", "order_date", "row_id", "segment"]


def silver_of(spark, rows, fields=FIELDS):
    """Silver rows from a few fields; the rest is NULL."""
    given = spark.createDataFrame(
        rows, ", ".join(f"{f} {SILVER[f].dataType.simpleString()}" for f in fields)
    )
    return given.select(
        *(
            F.col(f.name) if f.name in fields else F.lit(None).cast(f.dataType).alias(f.name)
            for f in SILVER
        )
    )


def test_conform_types_columns_and_missing_sources(spark, any_ansi):
    bronze = spark.createDataFrame(
        [(" 5 ", " O ", "1/2/2018", "C ", " Ann Mary Van Dyk ", 2018, 1, 2),
         ("1.5", None, "2018-01-02", "C", "Cher", None, None, None)],
        "row_id string, order_id string, order_date string, customer_id string, "
        "customer_name string, year int, month int, day int",
    )
    frame = conform(bronze)
    assert frame.columns == SILVER.names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in SILVER]
    assert [tuple(r) for r in frame.collect()] == [
        (5, "O", date(2018, 1, 2), None, None, "C", "Ann", "Mary Van Dyk", None, None, None, 2018, 1, 2),
        (None, None, None, None, None, "C", "Cher", None, None, None, None, None, None, None),
    ]


def test_keyed_rows_keep_the_latest_ingest_and_split_off_keyless_rows(spark):
    bronze = spark.createDataFrame(
        [("1", "A", "t1"), ("1", "B", "t2"), ("x", "C", "t1"), ("x", "C", "t1")],
        "row_id string, city string, _ingested_at string",
    ).withColumns({name: F.lit(None).cast("int") for name in ("year", "month", "day")})
    assert [(r.row_id, r.city) for r in keyed_rows(bronze).collect()] == [(1, "B")]
    assert keyless_rows(bronze).count() == 2


def test_sales_take_the_lowest_line_and_one_row_for_orders_without_id(spark):
    rows = [
        ("C", "O1", date(2018, 1, 3), 2, None), ("C", "O1", date(2018, 1, 1), 1, None),
        ("C", "O1", date(2018, 1, 2), None, None), ("C", None, None, 9, None),
        ("C", None, date(2018, 5, 5), 8, None),
    ]
    frame = sales(silver_of(spark, rows))
    assert frame.columns == GOLD_SALES.names
    assert rows_of(frame.select("order_id", "order_date")) == [
        ("O1", date(2018, 1, 1)), (None, date(2018, 5, 5)),
    ]


WINDOW_ROWS = [
    ("C", "at anchor", date(2018, 12, 30), 1, "a"),
    ("C", "after anchor", date(2018, 12, 31), 2, "b"),
    ("C", "month start", date(2018, 11, 30), 3, "c"),
    ("C", "in month", date(2018, 12, 1), 4, "d"),
    ("C", "in month", date(2018, 12, 2), 5, "e"),
    ("C", "half-year start", date(2018, 6, 30), 6, "f"),
    ("C", "in half-year", date(2018, 7, 1), 7, "g"),
    ("C", "no date", None, 8, "h"),
    ("C", None, date(2018, 12, 1), 9, "i"),
    (None, "no customer", date(2018, 12, 1), 10, "j"),
]


def customers_by_join(silver, anchor):
    """The customer rows from the latest attributes joined to the counts: two scans."""
    joined = customer_latest(silver).join(customer_metrics(silver, anchor), CUSTOMER_KEY)
    return joined.withColumnRenamed("segment", "customer_segment").select(*GOLD_CUSTOMER.names)


@pytest.mark.parametrize("form", [customers, customers_by_join])
def test_customer_windows(spark, form):
    frame = form(silver_of(spark, WINDOW_ROWS), ANCHOR)
    assert frame.schema.names == GOLD_CUSTOMER.names
    assert [tuple(r) for r in frame.collect()] == [("C", None, None, "b", None, 2, 4, 7)]


def test_customer_metrics_keep_the_group_without_customer(spark):
    frame = customer_metrics(silver_of(spark, WINDOW_ROWS), ANCHOR)
    assert rows_of(frame) == [("C", 2, 4, 7), (None, 1, 1, 1)]


@pytest.mark.parametrize("form", [customers, customers_by_join])
def test_latest_attributes_break_ties_by_row_id_and_survive_missing_dates(spark, form):
    rows = [
        ("tie", "O", date(2018, 1, 1), 1, "low"), ("tie", "O", date(2018, 1, 1), 2, "high"),
        ("tie", "P", None, 99, "undated"),
        ("undated", "O", None, 1, "first"), ("undated", "O", None, 2, "second"),
        ("keyless", "O", None, None, None), ("keyless", "O", None, None, "some"),
    ]
    frame = form(silver_of(spark, rows), ANCHOR)
    assert rows_of(frame.select("customer_id", "customer_segment")) == [
        ("keyless", "some"), ("tie", "high"), ("undated", "second"),
    ]


def test_both_customer_forms_agree_and_ignore_partitioning(spark):
    silver = inputs.silver(spark, TINY)
    expected = rows_of(customers_by_join(silver, inputs.ANCHOR))
    assert len(expected) == 150
    assert rows_of(customers(silver, inputs.ANCHOR)) == expected
    assert rows_of(customers(silver.repartition(7), inputs.ANCHOR)) == expected
    assert rows_of(sales(silver.repartition(7))) == rows_of(sales(silver))


def test_one_customer_with_a_third_of_all_rows(spark):
    rows = [("hot", f"O{i % 400}", date(2018, 12, 1 + i % 28), i, "s") for i in range(2000)]
    rows += [(f"C{i}", f"P{i}", date(2018, 12, 1), 10_000 + i, "s") for i in range(300)]
    silver = silver_of(spark, rows)
    assert rows_of(customers(silver, ANCHOR)) == rows_of(customers_by_join(silver, ANCHOR))


BRONZE = "row_id string, order_date string, city string, year int, month int, day int, _place int, _ingested_at string"


def bronze_with_copies(spark):
    once = [(str(i), "1/2/2018", f"c{i}", 2018, 1, 2, i % 3, "now") for i in range(20)]
    copies = [
        ("3", "1/2/2018", "B", 2018, 1, 2, 1, "now"), ("3", "1/3/2018", "A", 2018, 1, 3, 1, "now"),
        ("5", None, None, None, None, None, 2, "now"), (" 7 ", "1/2/2018", "A", 2018, 1, 2, 0, None),
        ("7", "1/2/2018", "Z", 2018, 1, 2, None, "now"), ("8", "1/2/2018", "c8", 2018, 1, 2, 2, "now"),
        ("x", "1/2/2018", "A", 2018, 1, 2, 0, "now"), (None, None, None, None, None, None, 0, "now"),
    ]
    return spark.createDataFrame(once + copies, BRONZE)


@pytest.mark.parametrize("few", [silver_plan.FEW_KEYS, 0], ids=["few", "many"])
def test_keys_counted_first_pick_the_same_rows(spark, monkeypatch, few):
    monkeypatch.setattr(silver_plan, "FEW_KEYS", few)
    bronze, order = bronze_with_copies(spark), ("_place", "_ingested_at")
    found = keyed_rows_by_count(bronze, *order)
    expected = keyed_rows(bronze, *order)
    assert found.columns == expected.columns == SILVER.names
    assert rows_of(found) == rows_of(expected) and found.count() == 20


def test_rows_whose_keys_come_once_are_not_sorted_or_shuffled(spark):
    bronze = bronze_with_copies(spark).filter("city like 'c%' and row_id != '8'")
    found = keyed_rows_by_count(bronze, "_place", "_ingested_at")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Sort" not in text
    assert rows_of(found) == rows_of(keyed_rows(bronze, "_place", "_ingested_at")) and found.count() == 19
