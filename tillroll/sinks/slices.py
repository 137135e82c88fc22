"""Tables of slices: one partition per landing file or run, whose columns may grow.

A slice is written to a new folder, and the partition then points to it, so a slice that is
written again keeps its old rows until the new ones are complete. Columns are added to the
table as slices bring them; older slices read as NULL there, without looking into any file.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.layers import INGEST_ID
from tillroll.sinks.catalog import CALLS_AT_ONCE


@dataclass(frozen=True)
class SliceTable:
    name: str
    path: str


def write_slices(
    spark: SparkSession, table: SliceTable, rows: DataFrame, ids: list[str], keep: frozenset[str] = frozenset()
) -> dict[str, int]:
    """Replace the slices `ids` by the rows, which hold their id in `ingest_id`; rows per slice.

    A slice without rows loses its partition, unless it is in `keep`: then it stays as an empty one.
    """
    version = f"{table.path}/v-{uuid4().hex}"
    seen = Observation()
    observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    if len(ids) == 1:
        # Into the one folder as they come: by partition, each task would sort its rows first.
        observed.drop(INGEST_ID).write.parquet(f"{version}/{INGEST_ID}={ids[0]}")
    else:
        observed.write.partitionBy(INGEST_ID).parquet(version)
    add_columns(spark, table, rows.drop(INGEST_ID).schema)
    if len(ids) == 1:
        counts = {ids[0]: seen.get["rows"]}
    else:
        # The id is in the folder names: this count reads no column of any file.
        fields = [*rows.drop(INGEST_ID).schema, T.StructField(INGEST_ID, T.StringType())]
        written = spark.read.schema(T.StructType(fields)).parquet(version)
        counts = dict(written.groupBy(INGEST_ID).agg(F.count(F.lit(1))).collect())
    filled = [one for one in ids if counts.get(one)]
    empty = [one for one in ids if not counts.get(one)]
    kept = [one for one in empty if one in keep]
    for one in kept:
        nothing = spark.createDataFrame([], rows.drop(INGEST_ID).schema)
        nothing.write.mode("overwrite").parquet(f"{version}/{INGEST_ID}={one}")
    _point(spark, table, {one: f"{version}/{INGEST_ID}={one}" for one in [*filled, *kept]})
    drop_slices(spark, table, [one for one in empty if one not in keep])
    spark.catalog.refreshTable(table.name)
    return {one: counts.get(one, 0) for one in ids}


def read_slices(spark: SparkSession, table: SliceTable, ids: list[str] | None = None) -> DataFrame:
    rows = spark.table(table.name)
    return rows if ids is None else rows.filter(F.col(INGEST_ID).isin(ids))


def slice_ids(spark: SparkSession, table: SliceTable) -> list[str]:
    if not spark.catalog.tableExists(table.name):
        return []
    return [row.partition.split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table.name}").collect()]


def drop_slices(spark: SparkSession, table: SliceTable, ids: list[str]) -> None:
    """Forget slices; their files stay."""
    if ids:
        specs = ", ".join(f"PARTITION ({INGEST_ID}='{one}')" for one in ids)
        spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS {specs}")


def add_columns(spark: SparkSession, table: SliceTable, schema: T.StructType) -> None:
    if not spark.catalog.tableExists(table.name):
        columns = [*schema, T.StructField(INGEST_ID, T.StringType())]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table.name} ({_columns(columns)}) USING parquet "
            f"PARTITIONED BY ({INGEST_ID}) LOCATION '{table.path}/none'"
        )
    known = set(spark.table(table.name).columns)
    added = [field for field in schema if field.name not in known]
    if added:
        spark.sql(f"ALTER TABLE {table.name} ADD COLUMNS ({_columns(added)})")


def _columns(fields: list[T.StructField]) -> str:
    return ", ".join(f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}" for field in fields)


def _point(spark: SparkSession, table: SliceTable, folders: dict[str, str]) -> None:
    """Let each slice read its folder: new ones in one catalog call, others by one call each, several at once."""
    known = set(slice_ids(spark, table)) if folders else set()
    specs = {one: f"PARTITION ({INGEST_ID}='{one}')" for one in folders}
    new = " ".join(f"{specs[one]} LOCATION '{folder}'" for one, folder in folders.items() if one not in known)
    if new:
        spark.sql(f"ALTER TABLE {table.name} ADD IF NOT EXISTS {new}")

    def move(one: str) -> None:
        spark.sql(f"ALTER TABLE {table.name} {specs[one]} SET LOCATION '{folders[one]}'")

    with ThreadPoolExecutor(CALLS_AT_ONCE) as calls:
        list(calls.map(move, [one for one in folders if one in known]))
