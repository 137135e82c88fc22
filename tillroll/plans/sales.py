"""Order fact: one row per order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.layers import GOLD_SALES, SALES_KEY, SILVER_KEY
from tillroll.operators.pick import lowest_per_key

RENAMED = {"shipment_date": "ship_date", "shipment_mode": "ship_mode"}

# The line that speaks for an order; the remaining columns settle what is left.
LINE_ORDER = [SILVER_KEY, "shipment_date", "shipment_mode", "city"]


def sales(silver: DataFrame) -> DataFrame:
    lines = silver.select(
        *(F.col(RENAMED.get(name, name)).alias(name) for name in GOLD_SALES.names), SILVER_KEY
    )
    return lowest_per_key(lines, SALES_KEY, LINE_ORDER).select(*GOLD_SALES.names)
