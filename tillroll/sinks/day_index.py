"""A secondary index: the days in which the rows of a key may lie.

An index is a table of its own with the distinct (key, day) pairs of a table with day partitions,
in hash buckets. It holds every pair that the table holds, and may hold pairs that it no longer
does: a writer adds pairs before it changes the table and never removes any. So a reader who takes
the days of its keys from here misses no row, whatever step a writer was lost at.

Looking keys up reads only their buckets, and of these only the row groups between the lowest and
the highest key. Each write adds a file per bucket; once there are many, buckets are rewritten
without repeated pairs.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sinks.catalog import LayerTable, Partition, create_table, partition_folder, point_partitions
from tillroll.sinks.staging import clustered, write_counted

BUCKET = "_bucket"
# Fixed for the life of an index: its rows lie where this number put them.
BUCKETS = 32
FILES_PER_BUCKET = 16


def index_of(table: LayerTable, key: str) -> LayerTable:
    """The index of the table's days by `key`."""
    fields = [T.StructField(name, table.schema[name].dataType) for name in (key, *table.partition_by)]
    schema = T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())])
    return LayerTable(f"{table.name}_days_by_{key}", f"{table.path}-days-by-{key}", schema, key, (BUCKET,))


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _entries(index: LayerTable, rows: DataFrame) -> DataFrame:
    pairs = [name for name in index.schema.names if name != BUCKET]
    known = rows.filter(F.col(index.key).isNotNull()).select(*pairs).distinct()
    return known.withColumn(BUCKET, _bucket(index.key)).select(*index.schema.names)


def exists(spark: SparkSession, index: LayerTable) -> bool:
    return spark.catalog.tableExists(index.name)


def build(spark: SparkSession, index: LayerTable, rows: DataFrame) -> None:
    """Make the index from all rows of its table, if there is none."""
    version = f"{index.path}/v-{uuid4().hex}"
    write_counted(_entries(index, rows), version, index.partition_by, index.key)
    create_table(spark, index, version)


def add(spark: SparkSession, index: LayerTable, rows: DataFrame) -> None:
    """Add the pairs of rows that are about to be written."""
    clustered(_entries(index, rows), index.partition_by, index.key).write.insertInto(index.name)
    if len(spark.table(index.name).inputFiles()) > FILES_PER_BUCKET * BUCKETS:
        compact(spark, index)


def compact(spark: SparkSession, index: LayerTable) -> None:
    """Rewrite all buckets without repeated pairs; each switches to its new folder by itself, with equal content."""
    version = f"{index.path}/v-{uuid4().hex}"
    write_counted(_entries(index, spark.table(index.name)), version, index.partition_by, index.key)
    held = spark.table(index.name).select(BUCKET).distinct().collect()
    point_partitions(spark, index, {(row[0],): f"{version}/{partition_folder(index, (row[0],))}" for row in held})


def days_of(spark: SparkSession, index: LayerTable, keys: DataFrame) -> list[Partition]:
    """Every day that holds a row of one of the keys: as many as there are days, whatever the keys' number."""
    wanted = keys.select(index.key).filter(F.col(index.key).isNotNull())
    found = wanted.agg(
        F.collect_set(_bucket(index.key)).alias("buckets"), F.min(index.key).alias("low"), F.max(index.key).alias("high")
    ).first()
    if not found.buckets:
        return []
    near = spark.table(index.name).filter(F.col(BUCKET).isin(found.buckets) & F.col(index.key).between(found.low, found.high))
    days = [name for name in index.schema.names if name not in (index.key, BUCKET)]
    return [tuple(row) for row in near.join(wanted, index.key, "left_semi").select(*days).distinct().collect()]
