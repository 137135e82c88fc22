"""Conformed layer: typed, trimmed, fixed columns, one row per `row_id`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.cleaning import landing_date, name_part, whole_number
from tillroll.layers import DAY_COLUMNS, INGESTED_AT, ORDER_DATE_PARSED, SILVER, SILVER_KEY
from tillroll.operators.pick import highest_per_key
from tillroll.sinks.staging import stage

# Repeated keys up to which only their rows are grouped; with more, all rows are.
FEW_KEYS = 1_000_000

DATES = {"order_date", "ship_date"}
NAME_PARTS = {"customer_first_name": 0, "customer_last_name": 1}


def _conformed(name: str, available: list[str]) -> Column:
    """The expression for one silver column; a source column the file lacks is NULL."""
    origin = "customer_name" if name in NAME_PARTS else name
    if origin not in available:
        return F.lit(None).cast(SILVER[name].dataType)
    text = F.col(origin)
    if name in DAY_COLUMNS:
        return text
    if name in NAME_PARTS:
        return name_part(text, NAME_PARTS[name])
    if name == "order_date" and ORDER_DATE_PARSED in available:
        # Ingest has parsed this very text; parsing dates is the dearest step here.
        return F.col(ORDER_DATE_PARSED)
    if name in DATES:
        return landing_date(text)
    return whole_number(text) if name == SILVER_KEY else F.trim(text)


def conform(bronze: DataFrame, *extra: str) -> DataFrame:
    """Bronze rows as silver columns, in one projection; `extra` bronze columns ride along."""
    conformed = [_conformed(name, bronze.columns).alias(name) for name in SILVER.names]
    return bronze.select(*conformed, *extra)


def keyed_rows(bronze: DataFrame, *order: str) -> DataFrame:
    """Conformed rows ready for the upsert: of the copies of a `row_id`, the last by `order` wins.

    `order` names bronze columns; by default that is the latest ingest.
    """
    order = order or (INGESTED_AT,)
    return highest_per_key(_with_key(bronze, *order), SILVER_KEY, list(order)).drop(*order)


def keyed_rows_by_count(bronze: DataFrame, *order: str) -> DataFrame:
    """The same rows as `keyed_rows`, for stored bronze rows, of which few have copies.

    The keys are counted first, from their one column. Rows of a key that comes once then pass as they
    are, and only the others are sorted and shuffled with all their columns.
    """
    order = order or (INGESTED_AT,)
    rows = _with_key(bronze, *order)
    counted = rows.groupBy(SILVER_KEY).agg(F.count(F.lit(1)).alias("n"))
    repeated, seen = stage(bronze.sparkSession, counted.filter("n > 1").select(SILVER_KEY), "repeated")
    if not seen["rows"]:
        return rows.drop(*order)
    if seen["rows"] > FEW_KEYS:
        return keyed_rows(bronze, *order)
    copies = highest_per_key(rows.join(repeated, SILVER_KEY, "left_semi"), SILVER_KEY, list(order))
    return rows.join(repeated, SILVER_KEY, "left_anti").unionByName(copies).drop(*order)


def _with_key(bronze: DataFrame, *order: str) -> DataFrame:
    return conform(bronze, *order).filter(F.col(SILVER_KEY).isNotNull())


def keyless_rows(bronze: DataFrame, *extra: str) -> DataFrame:
    """Conformed rows that no later run could match, kept apart so that a replay is stable."""
    return conform(bronze, INGESTED_AT, *extra).filter(F.col(SILVER_KEY).isNull())
