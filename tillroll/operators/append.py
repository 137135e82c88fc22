"""Appending rows whose columns drift from file to file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def append_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column a frame lacks is NULL in its rows."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
