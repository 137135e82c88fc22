"""The raw layer: a slice per landing file that came lately, and the settled rows by day.

A slice is named after its file's bucket and key, so reading one file's rows touches its folder
alone, and ingesting a file again replaces its rows instead of doubling them. Settled slices move
into day partitions (`sinks/day_store.py`); readers see every file once, wherever it lies.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from tillroll.layers import INGEST_ID
from tillroll.sinks.day_store import read_rows
from tillroll.sinks.slices import SliceTable


def ingest_id(bucket: str, key: str) -> str:
    # The leading letter keeps partition discovery from reading a number.
    return "f" + sha256(f"{bucket}/{key}".encode()).hexdigest()


def read_slice(spark: SparkSession, bronze: SliceTable, bucket: str, key: str) -> DataFrame:
    return read_rows(spark, bronze, [ingest_id(bucket, key)]).drop(INGEST_ID)


def read_bronze(spark: SparkSession, bronze: SliceTable) -> DataFrame:
    """Every row with the columns of every file; a column that a file lacks is NULL there."""
    return read_rows(spark, bronze).drop(INGEST_ID)
