"""Raw layer: source text as it came, plus lineage and partition columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.cleaning import landing_date
from tillroll.functions.dates import day_parts
from tillroll.layers import INGESTED_AT, ORDER_DATE_PARSED, SOURCE_FILE
from tillroll.sources.landing import check_landing_columns


def bronze_rows(landing: DataFrame, key: str, ingested_at: str) -> DataFrame:
    """Rows of one landing file, stamped with the file's key and one time per run."""
    check_landing_columns(landing)
    return dated(landing.withColumns({SOURCE_FILE: F.lit(key), INGESTED_AT: F.lit(ingested_at)}))


def dated(rows: DataFrame) -> DataFrame:
    parsed = rows.withColumn(ORDER_DATE_PARSED, landing_date(F.col("order_date")))
    return parsed.withColumns(day_parts(F.col(ORDER_DATE_PARSED)))


def bronze_slice(bronze: DataFrame, key: str) -> DataFrame:
    """The rows that one landing file brought."""
    return bronze.filter(F.col(SOURCE_FILE) == key)
