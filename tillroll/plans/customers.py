"""Customer dimension: latest attributes and distinct order counts over trailing windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.dates import in_trailing_months
from tillroll.layers import CUSTOMER_KEY, GOLD_CUSTOMER, LATEST_DAY, SALES_KEY, SILVER_KEY
from tillroll.operators.pick import highest

# Column of the published table -> trailing months, None for all time.
TRAILING_COUNTS = {"orders_last_month": 1, "orders_last_6_months": 6, "orders_all_time": None}

ATTRIBUTES = ["customer_first_name", "customer_last_name", "segment", "country"]

# Latest row first; every field DESC NULLS LAST.
LATEST_ORDER = [
    "order_date", SILVER_KEY, "segment", "customer_first_name", "customer_last_name", "country",
]


def _trailing_count(anchor: date, months: int | None) -> Column:
    """Orders in the window. An order is one row here, so no distinct is needed."""
    order = F.col(SALES_KEY)
    if months is None:
        return F.count(order)
    return F.count(F.when(in_trailing_months(F.col("order_date"), anchor, months), order))


def _trailing_counts(anchor: date) -> list[Column]:
    return [_trailing_count(anchor, n).alias(name) for name, n in TRAILING_COUNTS.items()]


def customer_metrics(silver: DataFrame, anchor: date = LATEST_DAY) -> DataFrame:
    """Order counts per customer; the rows without a customer form one group."""
    orders = silver.groupBy(CUSTOMER_KEY, SALES_KEY).agg(F.max("order_date").alias("order_date"))
    return orders.groupBy(CUSTOMER_KEY).agg(*_trailing_counts(anchor))


def customer_latest(silver: DataFrame) -> DataFrame:
    """Attributes of each customer's latest row."""
    latest = Window.partitionBy(CUSTOMER_KEY).orderBy(
        *(F.col(name).desc_nulls_last() for name in LATEST_ORDER)
    )
    ranked = silver.select(CUSTOMER_KEY, *LATEST_ORDER, F.row_number().over(latest).alias("rn"))
    return ranked.filter(F.col("rn") == 1).select(CUSTOMER_KEY, *ATTRIBUTES)


def customers(silver: DataFrame, anchor: date = LATEST_DAY) -> DataFrame:
    """The published rows from one scan and two aggregates; rows without a customer drop out."""
    known = silver.filter(F.col(CUSTOMER_KEY).isNotNull())
    orders = known.groupBy(CUSTOMER_KEY, SALES_KEY).agg(highest(LATEST_ORDER).alias("latest"))
    # The date leads the struct, so the highest struct carries the order's latest date.
    orders = orders.withColumn("order_date", F.col("latest.order_date"))
    rolled = orders.groupBy(CUSTOMER_KEY).agg(
        *_trailing_counts(anchor), F.max("latest").alias("latest")
    )
    attributes = rolled.select("*", *(F.col(f"latest.{name}").alias(name) for name in ATTRIBUTES))
    return attributes.withColumnRenamed("segment", "customer_segment").select(*GOLD_CUSTOMER.names)
