"""Settled slices by day: the lasting form of a slice table, partitioned by year, month and day.

`compact` moves slices into day partitions. A slice that exists always wins: rows of the day store
whose slice is (still, or again) there do not count. So a move is committed by the one catalog
call that drops the slices, and a file that is ingested again replaces its rows at once; its old
rows leave the day store when its new slice is moved. An index of the days by slice tells
which days those are.

A day that a move touches is rewritten, so slices are best moved many at a time.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.layers import DAY_COLUMNS, INGEST_ID
from tillroll.operators.append import append_by_name
from tillroll.sinks import day_index
from tillroll.sinks.catalog import (
    LayerTable,
    add_partitions,
    create_table,
    drop_partitions,
    in_partitions,
    partition_folder,
    point_partitions,
)
from tillroll.sinks.slices import SliceTable, add_columns, drop_slices, read_slices, slice_ids
from tillroll.sinks.staging import write_counted


def _store(slices: SliceTable, schema: T.StructType) -> LayerTable:
    """The table of settled rows; partition columns come last, as the catalog has them."""
    fields = [field for field in schema if field.name not in DAY_COLUMNS]
    days = [T.StructField(name, T.IntegerType()) for name in DAY_COLUMNS]
    return LayerTable(f"{slices.name}_by_day", f"{slices.path}-by-day", T.StructType([*fields, *days]), INGEST_ID, tuple(DAY_COLUMNS))


def store_of(spark: SparkSession, slices: SliceTable) -> LayerTable | None:
    """The day store, if there is one yet."""
    name = f"{slices.name}_by_day"
    return _store(slices, spark.table(name).schema) if spark.catalog.tableExists(name) else None


def settled_ids(spark: SparkSession, slices: SliceTable, ids: list[str]) -> set[str]:
    """Those of the slices' ids that have rows in the day store."""
    store = store_of(spark, slices)
    if store is None or not ids:
        return set()
    index = day_index.index_of(store, INGEST_ID)
    wanted = spark.createDataFrame([(one,) for one in ids], f"{INGEST_ID} string")
    held = spark.table(index.name).join(F.broadcast(wanted), INGEST_ID).select(INGEST_ID).distinct()
    return {row[0] for row in held.collect()}


def read_rows(spark: SparkSession, slices: SliceTable, ids: list[str] | None = None) -> DataFrame:
    """The rows of all slices, or of `ids`, wherever they lie. Of the day store, only days that hold them are read."""
    store, live = store_of(spark, slices), slice_ids(spark, slices)
    fresh = read_slices(spark, slices, ids)
    if store is None:
        return fresh
    settled = spark.table(store.name)
    if live:
        settled = settled.filter(~F.col(INGEST_ID).isin(live))
    if ids is not None:
        old = [one for one in ids if one not in set(live)]
        if not old:
            return fresh
        wanted = spark.createDataFrame([(one,) for one in old], f"{INGEST_ID} string")
        days = day_index.days_of(spark, day_index.index_of(store, INGEST_ID), wanted)
        settled = settled.filter(in_partitions(store, days) if days else F.lit(False)).filter(F.col(INGEST_ID).isin(old))
    return append_by_name(fresh, settled)


def compact(spark: SparkSession, slices: SliceTable, ids: list[str]) -> int:
    """Move the slices `ids` into the day store; returns how many days were written.

    At most as many slices as a batch has files are named at once, so lists of ids stay short.
    """
    if not ids:
        return 0
    fresh = read_slices(spark, slices, ids)
    store = store_of(spark, slices)
    if store is None:
        store = _store(slices, fresh.schema)
        empty = f"{store.path}/v-{uuid4().hex}"
        write_counted(spark.createDataFrame([], store.schema), empty, store.partition_by)
        create_table(spark, store, empty)
        day_index.build(spark, day_index.index_of(store, INGEST_ID), spark.table(store.name))
    add_columns(spark, SliceTable(store.name, store.path), fresh.schema)
    store = _store(slices, spark.table(store.name).schema)
    index = day_index.index_of(store, INGEST_ID)

    held = spark.table(store.name)
    moved = spark.createDataFrame([(one,) for one in ids], f"{INGEST_ID} string")
    new_days = {tuple(row) for row in fresh.select(*DAY_COLUMNS).distinct().collect()}
    touched = list(new_days | set(day_index.days_of(spark, index, moved)))
    day_index.add(spark, index, fresh)
    if touched:
        staying = held.filter(in_partitions(store, touched)).filter(~F.col(INGEST_ID).isin(ids))
        version = f"{store.path}/v-{uuid4().hex}"
        merged = append_by_name(staying, fresh).select(*store.schema.names)
        write_counted(merged, version, store.partition_by, INGEST_ID)
        written = spark.read.schema(store.schema).parquet(version)
        present = {tuple(row) for row in written.select(*DAY_COLUMNS).distinct().collect()}
        known = {tuple(row) for row in held.select(*DAY_COLUMNS).distinct().collect()}
        folders = {day: f"{version}/{partition_folder(store, day)}" for day in present}
        add_partitions(spark, store, {day: folder for day, folder in folders.items() if day not in known})
        point_partitions(spark, store, {day: folder for day, folder in folders.items() if day in known})
        emptied = [day for day in touched if day not in present]
        if emptied:
            drop_partitions(spark, store, emptied)
    drop_slices(spark, slices, ids)
    spark.catalog.refreshTable(slices.name)
    return len(touched)
