"""Landing files through all layers."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.layers import (
    CUSTOMER_KEY,
    DATABASE,
    DAY_COLUMNS,
    GOLD_CUSTOMER,
    GOLD_SALES,
    INGEST_ID,
    INGESTED_AT,
    LATEST_DAY,
    SALES_KEY,
    SILVER,
    SILVER_KEY,
)
from tillroll.operators.append import append_by_name
from tillroll.plans.bronze import bronze_rows
from tillroll.plans.customers import customers
from tillroll.plans.sales import sales
from tillroll.plans.silver import keyed_rows_by_count, keyless_rows
from tillroll.sinks import buckets, day_index, day_store
from tillroll.sinks.catalog import LayerTable, create_database, in_partitions, property_of, set_property
from tillroll.sinks.merge import Match, apply_match, match, merge_into
from tillroll.sinks.slices import SliceTable, drop_slices, read_slices, slice_ids, write_slices
from tillroll.sources.bronze_files import ingest_id
from tillroll.sources.landing import LANDING_ID, LANDING_KEY, scan_files

# The customer table's property that holds the anchor day of its counts.
ANCHOR = "anchor"


@dataclass(frozen=True)
class Layers:
    """Where the layers live, and the day that ends the trailing windows.

    Once the raw layer has `settle_at` slices, a run moves them into its day partitions. Customers lie
    in `customer_buckets` hash buckets, some GB each at most; with another number they are dealt anew.
    Days of silver and sales are cut into ranges of about `range_rows` rows, the unit of rewriting.
    """

    root: str
    database: str = DATABASE
    anchor: date = LATEST_DAY
    settle_at: int = 200
    customer_buckets: int = 64
    range_rows: int = 4_000_000

    @property
    def bronze(self) -> SliceTable:
        return self._slices("bronze_orders", "bronze/orders")

    @property
    def rejects(self) -> SliceTable:
        return self._slices("rejected_orders", "rejects/orders")

    @property
    def unsettled(self) -> SliceTable:
        """The files whose rows a run is bringing into silver, per run that has not done so."""
        return self._slices("unsettled_files", "pending/files")

    def pending(self, key: str) -> SliceTable:
        """The keys whose gold rows a run has put out of date, per run that has not ended."""
        return self._slices(f"pending_{key}", f"pending/{key}")

    @property
    def silver(self) -> LayerTable:
        table = self._table("silver_orders", "silver/orders", SILVER, SILVER_KEY, DAY_COLUMNS)
        return replace(table, indexed=(SALES_KEY, CUSTOMER_KEY), range_rows=self.range_rows)

    @property
    def sales(self) -> LayerTable:
        table = self._table("gold_sales", "gold/sales", GOLD_SALES, SALES_KEY, DAY_COLUMNS, True)
        return replace(table, range_rows=self.range_rows)

    @property
    def customers(self) -> LayerTable:
        table = self._table("gold_customer", "gold/customer", GOLD_CUSTOMER, CUSTOMER_KEY, [], True)
        return replace(table, buckets=self.customer_buckets)

    def _slices(self, name: str, folder: str) -> SliceTable:
        return SliceTable(f"{self.database}.{name}", f"{self.root}/{folder}")

    def _table(self, name, folder, schema, key, partition_by, manifest=False) -> LayerTable:
        return LayerTable(
            f"{self.database}.{name}", f"{self.root}/{folder}", schema, key,
            tuple(partition_by), manifest,
        )


@dataclass
class Report:
    """Rows written per layer by one run."""

    bronze: int = 0
    rejected: int = 0
    silver: int = 0
    sales: int = 0
    customers: int = 0


@dataclass(frozen=True)
class LandingFile:
    """Where a file can be read, and the bucket and key that name it."""

    uri: str
    bucket: str
    key: str

    @property
    def id(self) -> str:
        return ingest_id(self.bucket, self.key)


def ingest(
    spark: SparkSession, layers: Layers, files: list[LandingFile], ingested_at: str | None = None
) -> dict[str, int]:
    """Landing files into the raw layer, each by its own header; rows per file's id."""
    create_database(spark, layers.database)
    ingested_at = ingested_at or datetime.now(timezone.utc).isoformat()
    named = [(file.uri, file.key, file.id) for file in {file.id: file for file in files}.values()]
    scans = [
        bronze_rows(rows, F.col(LANDING_KEY), ingested_at).withColumnRenamed(LANDING_ID, INGEST_ID).drop(LANDING_KEY)
        for rows in scan_files(spark, named)
    ]
    ids = [one for _, _, one in named]
    # A file that comes again without rows must hide those that it has in the day partitions.
    settled = frozenset(day_store.settled_ids(spark, layers.bronze, ids))
    return write_slices(spark, layers.bronze, append_by_name(*scans), ids, keep=settled)


def settle_bronze(spark: SparkSession, layers: Layers) -> int:
    """Move every slice of the raw layer whose rows silver has into day partitions; returns the days written."""
    lost = set(_unsettled(spark, layers)[1])
    return day_store.compact(spark, layers.bronze, [one for one in slice_ids(spark, layers.bronze) if one not in lost])


def run_files(
    spark: SparkSession, layers: Layers, files: list[LandingFile], ingested_at: str | None = None
) -> Report:
    """Ingest landing files and bring every layer up to date. Running them again changes nothing.

    However many files there are, silver is merged once and read once for both gold tables.
    Files are taken in the given order: of the rows with one key, the last file's wins, as if
    the files had come one by one. (An order or customer that a later file of the same batch
    leaves without rows is never published, where one by one its row would stay.)
    """
    if not files:
        return Report()
    counts = ingest(spark, layers, files, ingested_at)
    report = Report(bronze=sum(counts.values()))
    lost, left = _unsettled(spark, layers)
    # The same file twice counts where it comes last; files of lost runs come before all others.
    places = {one: place for place, one in enumerate([*left, *(file.id for file in files)])}
    run = _record_unsettled(spark, layers, places)
    order = spark.createDataFrame(list(places.items()), f"{INGEST_ID} string, _place int")
    arrived = read_slices(spark, layers.bronze, list(places)).join(F.broadcast(order), INGEST_ID)
    rejected = write_slices(spark, layers.rejects, keyless_rows(arrived, INGEST_ID), list(places))
    report.rejected = sum(rejected[one] for one in counts)

    source = keyed_rows_by_count(arrived, "_place", INGESTED_AT)
    found = match(spark, layers.silver, source, (SALES_KEY, CUSTOMER_KEY))
    report.silver = found.rows
    if found.rows:
        _record_pending(spark, layers, found)
        apply_match(spark, layers.silver, found)
    drop_slices(spark, layers.unsettled, [*lost, run])
    if spark.catalog.tableExists(layers.silver.name):
        report.sales, report.customers = _settle_gold(spark, layers)
    if len(slice_ids(spark, layers.bronze)) >= layers.settle_at:
        settle_bronze(spark, layers)
    return report


def run_file(
    spark: SparkSession,
    layers: Layers,
    uri: str,
    bucket: str,
    key: str,
    ingested_at: str | None = None,
) -> Report:
    return run_files(spark, layers, [LandingFile(uri, bucket, key)], ingested_at)


def refresh_gold(spark: SparkSession, layers: Layers) -> Report:
    """Recompute both gold tables from all of silver."""
    silver, report = spark.table(layers.silver.name), Report()
    pending = {key: slice_ids(spark, layers.pending(key)) for key in (SALES_KEY, CUSTOMER_KEY)}
    report.sales = merge_into(spark, layers.sales, sales(_keyed(silver, SALES_KEY)))
    report.customers = _merge_customers(spark, layers, silver)
    for key, ids in pending.items():
        drop_slices(spark, layers.pending(key), ids)
    return report


def _keyed(silver: DataFrame, key: str) -> DataFrame:
    return silver.filter(silver[key].isNotNull())


def _merge_customers(spark: SparkSession, layers: Layers, silver: DataFrame) -> int:
    rows = merge_into(spark, layers.customers, customers(silver, layers.anchor))
    if rows:
        set_property(spark, layers.customers, ANCHOR, layers.anchor.isoformat())
    return rows


def _unsettled(spark: SparkSession, layers: Layers) -> tuple[list[str], list[str]]:
    """The runs that were lost before their files were in silver, and those files in order."""
    runs = slice_ids(spark, layers.unsettled)
    if not runs:
        return [], []
    files = read_slices(spark, layers.unsettled, runs).orderBy("started", "place").collect()
    return runs, list(dict.fromkeys(row.file for row in files))


def _record_unsettled(spark: SparkSession, layers: Layers, places: dict[str, int]) -> str:
    """Note the files before silver changes: should this run be lost, the next one takes them up."""
    run, started = f"r{uuid4().hex}", datetime.now(timezone.utc).isoformat()
    files = [(one, place, started, run) for one, place in places.items()]
    rows = spark.createDataFrame(files, f"file string, place int, started string, {INGEST_ID} string")
    write_slices(spark, layers.unsettled, rows, [run])
    return run


def _record_pending(spark: SparkSession, layers: Layers, found: Match) -> None:
    """Store the orders and the customers whose gold rows the upsert may change, by key column.

    Both the new rows and the ones they replace count: a line that moves to another customer
    changes the old customer's numbers too. The keys are stored before silver changes and
    stay until some run, this or a later one, has brought their gold rows up to date. A gold table
    that is not there yet is made from all of silver, whichever run makes it, so it needs no keys.
    """
    run = f"r{uuid4().hex}"
    held = {
        SALES_KEY: spark.catalog.tableExists(layers.sales.name),
        CUSTOMER_KEY: buckets.exists(spark, layers.customers),
    }
    for key in (key for key, exists in held.items() if exists):
        keys = found.source.select(key)
        if found.matched is not None:
            keys = keys.union(found.matched.select(key))
        keys = keys.filter(F.col(key).isNotNull()).distinct()
        write_slices(spark, layers.pending(key), keys.withColumn(INGEST_ID, F.lit(run)), [run])


def touched_rows(spark: SparkSession, layers: Layers, key: str, pending: list[str]) -> DataFrame:
    """The silver rows of the pending keys. Only days that the index names for them are read.

    The first run that needs the index makes it from all of silver; from then on merges keep it. Rows
    are dealt by the key that they are then aggregated by, if at all: a small set of keys is broadcast.
    """
    keys = read_slices(spark, layers.pending(key), pending).select(key).distinct()
    silver, index = spark.table(layers.silver.name), day_index.index_of(layers.silver, key)
    if not day_index.exists(spark, index):
        day_index.build(spark, index, silver)
    days = day_index.days_of(spark, index, keys)
    if not days:
        return silver.limit(0)
    return silver.filter(in_partitions(layers.silver, days)).join(keys, key, "left_semi")


def _settle_gold(spark: SparkSession, layers: Layers) -> tuple[int, int]:
    """Recompute the gold rows of all pending keys, also those that a lost run left behind.

    Any other key's row stays what it is, unless there is no table yet, or the customers were
    counted up to another anchor day: then all rows are computed.
    """
    silver = spark.table(layers.silver.name)
    pending = {key: slice_ids(spark, layers.pending(key)) for key in (SALES_KEY, CUSTOMER_KEY)}
    all_sales = not spark.catalog.tableExists(layers.sales.name)
    all_customers = not buckets.exists(spark, layers.customers) or (
        property_of(spark, layers.customers, ANCHOR) != layers.anchor.isoformat()
    )
    whole = {key for key, every in ((SALES_KEY, all_sales), (CUSTOMER_KEY, all_customers)) if every}
    partial = [key for key in (SALES_KEY, CUSTOMER_KEY) if key not in whole and pending[key]]
    rows = {key: silver for key in whole}
    rows |= {key: touched_rows(spark, layers, key, pending[key]) for key in partial}
    counts = {SALES_KEY: 0, CUSTOMER_KEY: 0}
    if SALES_KEY in rows:
        counts[SALES_KEY] = merge_into(spark, layers.sales, sales(_keyed(rows[SALES_KEY], SALES_KEY)))
    if CUSTOMER_KEY in rows:
        counts[CUSTOMER_KEY] = _merge_customers(spark, layers, rows[CUSTOMER_KEY])
    for key, ids in pending.items():
        drop_slices(spark, layers.pending(key), ids)
    return counts[SALES_KEY], counts[CUSTOMER_KEY]
