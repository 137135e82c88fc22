"""One row per key, picked by a total order so that the input's partitioning cannot show.

Both forms are plain min/max aggregates over a struct: rows of a hot key shrink to one per
task before the shuffle, and no task ever holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def highest(order: list[str], *payload: str) -> Column:
    """The struct of the row that is first by `order` DESC NULLS LAST.

    NULL is the lowest value of a struct field, so max() already puts it last. The payload
    takes part in the order, after the named columns.
    """
    return F.max(F.struct(*order, *payload))


def lowest(order: list[str], *payload: str) -> Column:
    """The struct of the row that is first by `order` ASC NULLS LAST."""
    ranked = []
    for name in [*order, *payload]:
        ranked += [F.isnull(name).alias(f"{name}_missing"), F.col(name)]
    return F.min(F.struct(*ranked))


def lowest_per_key(frame: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key; NULL is a key like any other."""
    payload = [name for name in frame.columns if name != key and name not in order]
    picked = frame.groupBy(key).agg(lowest(order, *payload).alias("row"))
    return picked.select(
        *(key if name == key else F.col(f"row.{name}").alias(name) for name in frame.columns)
    )


def highest_per_key(frame: DataFrame, key: str, order: list[str]) -> DataFrame:
    payload = [name for name in frame.columns if name != key and name not in order]
    picked = frame.groupBy(key).agg(highest(order, *payload).alias("row"))
    return picked.select(
        *(key if name == key else F.col(f"row.{name}").alias(name) for name in frame.columns)
    )
