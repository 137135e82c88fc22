"""External tables: their definition, and which folder each table or partition reads."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = "_range"

# Fixed value: the folder name that stands for a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

Partition = tuple[int | None, ...]

CALLS_AT_ONCE = 16
CALLS_PER_TEXT = 100

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@dataclass(frozen=True)
class LayerTable:
    """A published table. `path` holds one folder per version, and the catalog says which counts.

    With `manifest`, every write keeps the file lists for external readers in step. For each column in
    `indexed`, every merge keeps the index of the days that its values lie in, once there is one. With
    `buckets`, `name` is a view of a table of hash buckets, which only `sinks/buckets.py` writes. With
    `range_rows`, `name` is a view of a table whose partitions are cut into ranges of about that many rows.
    """

    name: str
    path: str
    schema: T.StructType
    key: str
    partition_by: tuple[str, ...] = ()
    manifest: bool = False
    indexed: tuple[str, ...] = ()
    buckets: int = 0
    range_rows: int = 0

    @property
    def stored(self) -> str:
        """The table that holds the rows and the properties."""
        if self.range_rows:
            database, _, name = self.name.rpartition(".")
            return f"{database}.ranges_of_{name}" if database else f"ranges_of_{name}"
        return f"{self.name}_parts" if self.buckets else self.name

    @property
    def placed_by(self) -> tuple[str, ...]:
        """The partition columns of `stored`; those that readers see come first."""
        return (*self.partition_by, RANGE) if self.range_rows else self.partition_by

    @property
    def stored_schema(self) -> T.StructType:
        fields = [T.StructField(RANGE, T.IntegerType())] if self.range_rows else []
        return T.StructType([*self.schema.fields, *fields])


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def create_table(spark: SparkSession, table: LayerTable, location: str) -> None:
    """Register the files below `location`, partitions included."""
    define_table(spark, table, location)
    if table.partition_by:
        repair(spark, table)


def is_view(spark: SparkSession, table: LayerTable) -> bool:
    return spark.catalog.tableExists(table.name) and spark.catalog.getTable(table.name).tableType == "VIEW"


def partitions_of(spark: SparkSession, table: LayerTable) -> list[Partition]:
    """Every partition that the catalog knows."""
    specs = spark.sql(f"SHOW PARTITIONS {table.stored}").collect()
    values = [[part.partition("=")[2] for part in row[0].split("/")] for row in specs]
    return [tuple(None if one in (NULL_PARTITION, "null") else int(one) for one in spec) for spec in values]


def define_table(spark: SparkSession, table: LayerTable, location: str) -> None:
    """Register a table, as yet without partitions if it has any."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.stored_schema)
    partitioned = f"PARTITIONED BY ({', '.join(table.placed_by)})" if table.placed_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.stored} ({columns}) USING parquet {partitioned} "
        f"LOCATION '{location}'"
    )


def repair(spark: SparkSession, table: LayerTable) -> None:
    """Make the partitions that lie in the table's folder visible; drop those whose files are gone."""
    spark.sql(f"MSCK REPAIR TABLE {table.stored} SYNC PARTITIONS")


def point_table(spark: SparkSession, table: LayerTable, location: str) -> None:
    spark.sql(f"ALTER TABLE {table.stored} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table.stored)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """List folders in some tasks per core, where Spark starts a task per folder, up to 10,000.

    Listing a folder takes less time than starting a task, so many folders share one.
    """
    before, few = spark.conf.get(LISTING_TASKS), 4 * spark.sparkContext.defaultParallelism
    if int(before) <= few:
        yield
        return
    spark.conf.set(LISTING_TASKS, few)
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def point_partitions(
    spark: SparkSession, table: LayerTable, partitions: dict[Partition, str]
) -> None:
    """Let each partition read its new folder. One catalog call per partition, no data is moved.

    The calls mostly wait for the catalog and don't depend on each other, so several run at once. Each
    thread sends many as one text, since sending takes longer than the call.
    """
    calls = [
        f"ALTER TABLE {table.stored} PARTITION ({_spec(table, values)}) SET LOCATION '{folder}';"
        for values, folder in partitions.items()
    ]
    size = max(1, min(CALLS_PER_TEXT, ceil(len(calls) / CALLS_AT_ONCE)))
    texts = [f"BEGIN {' '.join(calls[i : i + size])} END" for i in range(0, len(calls), size)]
    with ThreadPoolExecutor(CALLS_AT_ONCE) as threads:
        list(threads.map(spark.sql, texts))
    spark.catalog.refreshTable(table.stored)


def add_partitions(spark: SparkSession, table: LayerTable, partitions: dict[Partition, str]) -> None:
    """Let the table read new partitions, in one catalog call."""
    if partitions:
        specs = " ".join(f"PARTITION ({_spec(table, values)}) LOCATION '{folder}'" for values, folder in partitions.items())
        spark.sql(f"ALTER TABLE {table.stored} ADD IF NOT EXISTS {specs}")
        spark.catalog.refreshTable(table.stored)


def drop_partitions(spark: SparkSession, table: LayerTable, partitions: list[Partition]) -> None:
    """Forget partitions, in one catalog call; their files stay."""
    specs = ", ".join(f"PARTITION ({_spec(table, values)})" for values in partitions)
    spark.sql(f"ALTER TABLE {table.stored} DROP IF EXISTS {specs}")
    spark.catalog.refreshTable(table.stored)


def _spec(table: LayerTable, values: Partition) -> str:
    return ", ".join(
        f"{name}={'null' if value is None else value}"
        for name, value in zip(table.placed_by, values)
    )


def partition_folder(table: LayerTable, values: Partition) -> str:
    return "/".join(
        f"{name}={NULL_PARTITION if value is None else value}"
        for name, value in zip(table.placed_by, values)
    )


def in_partitions(table: LayerTable, partitions: list[Partition]) -> Column:
    """A condition on the partition columns alone, so that it prunes the scan. NULL equals NULL.

    Partitions may leave out the range; they then stand for all of theirs. The plain condition per column is what a metastore can evaluate; the exact one follows.
    """
    names = table.placed_by[: len(partitions[0])]
    folder = ", ".join(f"concat('{name}=', coalesce(cast(`{name}` AS string), '{NULL_PARTITION}'))" for name in names)
    # Lists go to the parser as one text: each literal that Python makes is a call of its own.
    among = ", ".join(f"'{partition_folder(table, values)}'" for values in partitions)
    exact = F.expr(f"concat_ws('/', {folder}) IN ({among})")
    for name, values in zip(names, zip(*partitions, strict=True), strict=True):
        if None not in values:
            exact = F.expr(f"`{name}` IN ({', '.join(map(str, sorted(set(values))))})") & exact
    return exact


def property_of(spark: SparkSession, table: LayerTable, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table.stored}").collect()
    return next((row.value for row in rows if row.key == name), None)


def set_property(spark: SparkSession, table: LayerTable, name: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table.stored} SET TBLPROPERTIES ('{name}' = '{value}')")
