"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sinks.staging import stage

# The five separators below a plain space: tab, line feed, vertical tab, form feed, return.
SEPARATORS = "\t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send the module's functions with each task, so executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over a value that is computed once per row, however often `body` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text, in order; none for NULL."""
    spaced = F.coalesce(text, F.lit(""))
    for separator in SEPARATORS:
        spaced = F.replace(spaced, F.lit(separator), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def unused_name(columns: list[str], wish: str) -> str:
    """A column name that isn't taken yet, whatever columns an input brings."""
    taken = {name.lower() for name in columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def text_key(text: Column) -> Column:
    """128 bits that stand for a text, so that rows can be told apart without carrying it."""
    return F.struct(
        F.xxhash64(text).alias("low"), F.xxhash64(F.lit("second"), text).alias("high")
    )


def staged(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame as read back from the shared folder: its lineage is its files."""
    return stage(spark, frame, label)[0]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
