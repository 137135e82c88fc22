"""Calendar expressions: partition days and trailing windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_parts(day: Column) -> dict[str, Column]:
    return {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}


def in_trailing_months(day: Column, anchor: date, months: int) -> Column:
    """True inside (anchor - months, anchor]; the far edge clamps to the month's end."""
    end = F.lit(anchor)
    return (day > F.add_months(end, -months)) & (day <= end)
