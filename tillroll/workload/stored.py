"""Queries that go through files and tables below the shared folder."""

from __future__ import annotations

from dataclasses import replace
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.cleaning import landing_date
from tillroll.layers import CUSTOMER_KEY, DAY_COLUMNS, INGEST_ID, SILVER_KEY, SOURCE_FILE
from tillroll.plans.bronze import bronze_slice
from tillroll.plans.customers import customers
from tillroll.plans.run import LandingFile, Layers, Report, run_files
from tillroll.plans.sales import sales
from tillroll.session import scratch_path
from tillroll.sinks.catalog import LayerTable, create_database
from tillroll.sinks.manifest import read_manifest
from tillroll.sinks.day_store import compact
from tillroll.sinks.merge import merge_into
from tillroll.sinks.slices import SliceTable, write_slices
from tillroll.sinks.staging import stage
from tillroll.sources.bronze_files import ingest_id, read_bronze
from tillroll.sources.landing import scan_csv
from tillroll.streaming.event_stream import EventBatch
from tillroll.streaming.event_stream import start as start_from_events
from tillroll.streaming.landing_stream import start
from tillroll.workload import inputs

BUCKET = "b"


def _write_csv(rows: DataFrame, path: str) -> str:
    """Landing rows as CSV text with headers such as `Row Id`, padding kept."""
    headers = [name if name.startswith("_") else name.replace("_", " ").title() for name in rows.columns]
    rows.toDF(*headers).write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing rows as stored files, so that they are derived once for all that reads them."""
    return stage(spark, inputs.landing(spark, sf_dir), "landing")[0]


def _keyed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver rows with a key, stored likewise."""
    return stage(spark, inputs.silver(spark, sf_dir).filter(F.col(SILVER_KEY).isNotNull()), "silver")[0]


def _write_landing_files(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str]:
    """Key -> folder of its CSV text, for the two landing files.

    Each part covers its own stretch of days, as files that land one after the other do.
    """
    rows = _landing(spark, sf_dir).repartitionByRange(landing_date(F.col("order_date")), "row_id")
    return {
        key: _write_csv(bronze_slice(rows, key).drop(SOURCE_FILE), f"{folder}/{key}")
        for key in (inputs.FIRST_FILE, inputs.SECOND_FILE)
    }


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_csv(inputs.landing(spark, sf_dir), scratch_path(spark, "csv"))
    return scan_csv(spark, path)


def _new_layers(spark: SparkSession) -> Layers:
    """Layers of their own, so that queries never meet each other's tables."""
    layers = Layers(
        scratch_path(spark, "layers"), database=f"retail_{uuid4().hex[:12]}", anchor=inputs.ANCHOR
    )
    create_database(spark, layers.database)
    return layers


def _published_sales(spark: SparkSession, sf_dir: str, manifest: bool) -> LayerTable:
    table = replace(_new_layers(spark).sales, manifest=manifest)
    merge_into(spark, table, sales(inputs.silver(spark, sf_dir)))
    return table


def catalog_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact as an external table serves it."""
    return spark.table(_published_sales(spark, sf_dir, manifest=False).name)


def gold_sales_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of the order fact: only that month's folders are read."""
    return catalog_gold(spark, sf_dir).filter((F.col("year") == 2000) & (F.col("month") == 6))


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day in the files that the manifest lists."""
    table = _published_sales(spark, sf_dir, manifest=True)
    return (
        _with_listing(spark, table)
        .filter("listed")
        .groupBy(*DAY_COLUMNS)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _published_late(
    spark: SparkSession, target: DataFrame, late: DataFrame, table: LayerTable, stored: bool = False
) -> LayerTable:
    merge_into(spark, table, target, stored)
    merge_into(spark, table, late)
    return table


def _with_listing(spark: SparkSession, table: LayerTable) -> DataFrame:
    """The table's rows, each with whether the manifest lists its file under its partition."""
    place = F.struct("file_path", *(F.col(name).cast("int").alias(name) for name in DAY_COLUMNS))
    listed = read_manifest(spark, table).select(place.alias("place")).distinct()
    rows = spark.table(table.stored).select(*table.schema.names, F.col("_metadata.file_path").alias("file_path"))
    # Structs compare their NULL fields as equal, so undated rows find their list too. One row per file,
    # which the driver lists anyway: by size, all rows of the table might be shuffled by their file.
    joined = rows.withColumn("place", place).join(F.broadcast(listed.withColumn("listed", F.lit(True))), "place", "left")
    return joined.select(*table.schema.names, F.coalesce("listed", F.lit(False)).alias("listed"))


def merge_silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored silver table after late rows: they move days, empty one, blank a city, meet undated rows."""
    rows = _keyed_silver(spark, sf_dir)
    table = replace(_new_layers(spark).silver, manifest=True)
    return _with_listing(spark, _published_late(spark, inputs.early(rows), inputs.late(rows), table, stored=True))


def merge_ranges_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored silver table after late rows, where few partitions hold all rows and the undated one a third."""
    rows = _keyed_silver(spark, sf_dir)
    table = replace(_new_layers(spark).silver, manifest=True, range_rows=2000)
    target, late = inputs.crowded(inputs.early(rows)), inputs.crowded(inputs.late(rows))
    return _with_listing(spark, _published_late(spark, target, late, table, stored=True))


def merge_sales_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored order fact after the orders of the late rows were merged."""
    rows = _keyed_silver(spark, sf_dir)
    target, late = sales(inputs.early(rows)), sales(inputs.late(rows))
    return _with_listing(spark, _published_late(spark, target, late, _new_layers(spark).sales))


def merge_customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored customer table after some customers' later orders, with its buckets dealt anew on the way."""
    rows, _ = stage(spark, inputs.silver(spark, sf_dir).filter(F.col("customer_id").isNotNull()), "silver")
    table = _new_layers(spark).customers
    merge_into(spark, table, customers(rows.filter(F.col("order_date") < "1999-01-01"), inputs.ANCHOR))
    late = customers(rows, inputs.ANCHOR).filter(F.col("customer_id").endswith("7"))
    merge_into(spark, table, late.filter(F.col("customer_id").endswith("17")))
    fewer = replace(table, buckets=16)
    merge_into(spark, fewer, late.filter(~F.col("customer_id").endswith("17")))
    held = spark.table(fewer.stored).select(CUSTOMER_KEY, F.col("_metadata.file_path").alias("file_path"))
    listed = held.join(read_manifest(spark, fewer).distinct(), "file_path", "left_semi")
    shown = listed.select(CUSTOMER_KEY, F.lit(True).alias("listed"))
    return spark.table(fewer.name).join(shown, CUSTOMER_KEY, "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored raw layer after two files, of which the first lacks a column."""
    bronze = _new_layers(spark).bronze
    rows = _landing(spark, sf_dir)
    first = bronze_slice(rows, inputs.FIRST_FILE).drop("city")
    _write_slice(spark, bronze, inputs.FIRST_FILE, first)
    _write_slice(spark, bronze, inputs.SECOND_FILE, bronze_slice(rows, inputs.SECOND_FILE))
    return read_bronze(spark, bronze)


def _write_slice(spark: SparkSession, bronze: SliceTable, key: str, rows: DataFrame) -> str:
    one = ingest_id(BUCKET, key)
    write_slices(spark, bronze, rows.withColumn(INGEST_ID, F.lit(one)), [one])
    return one


def bronze_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer with both files in day partitions, after the first came again with a column that it lacked."""
    bronze = _new_layers(spark).bronze
    rows, _ = stage(spark, inputs.bronze(spark, sf_dir), "bronze")
    first = bronze_slice(rows, inputs.FIRST_FILE)
    ids = [
        _write_slice(spark, bronze, inputs.FIRST_FILE, first.filter(F.col("order_date").isNotNull()).drop("city")),
        _write_slice(spark, bronze, inputs.SECOND_FILE, bronze_slice(rows, inputs.SECOND_FILE)),
    ]
    compact(spark, bronze, ids)
    _write_slice(spark, bronze, inputs.FIRST_FILE, first)
    compact(spark, bronze, ids[:1])
    return read_bronze(spark, bronze)


def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per landing folder of the raw layer after a stream took its files through all layers."""
    layers = _streamed(spark, sf_dir)
    return read_bronze(spark, layers.bronze).groupBy(
        F.substring_index(SOURCE_FILE, "/", 2).alias(SOURCE_FILE)
    ).agg(F.count(F.lit(1)).alias("n"), F.count("_order_date_parsed").alias("dated"))


def stream_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table after a stream took its files through all layers."""
    return spark.table(_streamed(spark, sf_dir).customers.name)


def _streamed(spark: SparkSession, sf_dir: str) -> Layers:
    folder = scratch_path(spark, "stream")
    _write_landing_files(spark, sf_dir, folder)
    layers = _new_layers(spark)

    def on_files(files: list[LandingFile]) -> None:
        run_files(spark, layers, files, inputs.INGESTED)

    start(spark, f"{folder}/landing", f"{folder}/checkpoint", BUCKET, on_files).awaitTermination()
    return layers


def event_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table after notifications started the runs: copies, damaged bodies, a file that came half and then whole."""
    folder, layers = scratch_path(spark, "events"), _new_layers(spark)
    rows = _landing(spark, sf_dir)
    second = bronze_slice(rows, inputs.SECOND_FILE).drop(SOURCE_FILE)
    first = _write_csv(bronze_slice(rows, inputs.FIRST_FILE).drop(SOURCE_FILE), f"{folder}/{BUCKET}/{inputs.FIRST_FILE}")
    half = _write_csv(second.filter(F.col("customer_id").endswith("1")), f"{folder}/{BUCKET}/half.csv")
    whole = _write_csv(second, f"{folder}/{BUCKET}/whole.csv")
    # The store would hold a file's last state under one name; here a folder per state stands for that.
    states = [{inputs.FIRST_FILE: first, inputs.SECOND_FILE: half}, {inputs.SECOND_FILE: whole}]

    def on_batch(batch: EventBatch) -> None:
        for files in batch.portions():
            run_files(spark, layers, files, inputs.INGESTED)

    for number, state in enumerate(states):
        for key in state:
            inputs.file_notifications(spark, BUCKET, key, str(number)).write.mode("append").text(f"{folder}/notes")
        start_from_events(
            spark, f"{folder}/notes", f"{folder}/checkpoint", on_batch, lambda bucket, key, state=state: state[key]
        ).awaitTermination()
    return spark.table(layers.customers.name)


def _run(spark: SparkSession, sf_dir: str) -> tuple[Layers, Report]:
    """Both landing files through all layers, in one batch."""
    layers = _new_layers(spark)
    written = _write_landing_files(spark, sf_dir, scratch_path(spark, "run"))
    files = [LandingFile(uri, BUCKET, key) for key, uri in written.items()]
    return layers, run_files(spark, layers, files, inputs.INGESTED)


def layered_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table after both landing files went through all layers."""
    return spark.table(_run(spark, sf_dir)[0].customers.name)


def layered_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_run(spark, sf_dir)[0].silver.name)


def layered_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_run(spark, sf_dir)[0].sales.name)


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per layer as the writes of a run observed them."""
    report = _run(spark, sf_dir)[1]
    return spark.createDataFrame(list(vars(report).items()), "layer string, n long")
