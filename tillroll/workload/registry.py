"""Each query as a function of the session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.layers import CUSTOMER_KEY, INGESTED_AT, SALES_KEY, SILVER_KEY
from tillroll.operators.upsert import matched_keys, upsert
from tillroll.plans.bronze import bronze_slice
from tillroll.plans.customers import customer_latest, customer_metrics, customers
from tillroll.plans.sales import sales
from tillroll.plans.silver import conform
from tillroll.sinks.staging import stage
from tillroll.sources.events import malformed_count, runnable_keys, started_count
from tillroll.workload import inputs, stored

Query = Callable[[SparkSession, str], DataFrame]


def _bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.bronze(spark, sf_dir).withColumn(INGESTED_AT, F.lit(inputs.INGESTED))


def _bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.bronze(spark, sf_dir)
    return rows.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


def _bronze_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_slice(inputs.bronze(spark, sf_dir), inputs.SECOND_FILE)


def _upserted(spark: SparkSession, target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The upsert of stored frames, so that neither side is derived again for each of its joins."""
    target, _ = stage(spark, target, "target")
    source, _ = stage(spark, source, "source")
    return upsert(target, source, key, stage(spark, matched_keys(target, source, key), "matched")[0])


def _silver_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col(SILVER_KEY)
    return inputs.silver(spark, sf_dir).filter((key % 7 != 0) | key.isNull())


def _upsert_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col(SILVER_KEY)
    late = inputs.silver(spark, sf_dir).filter((key % 13 == 0) | key.isNull())
    source = late.withColumns(
        {
            "ship_mode": F.lit("Same Day"),
            "city": F.when(key.isNull() | (key % 26 != 0), F.col("city")),
            "year": F.lit(2002),
            "month": F.lit(1),
            "day": F.lit(1),
        }
    )
    return _upserted(spark, _silver_target(spark, sf_dir), source, SILVER_KEY)


def _upsert_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _ = stage(spark, _silver_target(spark, sf_dir), "target")
    return upsert(target, target.limit(0), SILVER_KEY)


def _gold_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(inputs.silver(spark, sf_dir))


def _upsert_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = stage(spark, inputs.silver(spark, sf_dir), "silver")
    day = F.col("order_date")
    earlier = rows.filter((day < "2000-01-01") | day.isNull())
    return _upserted(spark, sales(earlier), sales(rows), SALES_KEY)


def _customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_metrics(inputs.silver(spark, sf_dir), inputs.ANCHOR)


def _customer_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_latest(inputs.silver(spark, sf_dir))


def gold_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(inputs.silver(spark, sf_dir), inputs.ANCHOR)


def _upsert_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.silver(spark, sf_dir)
    earlier = rows.filter(F.col("order_date") < "1999-01-01")
    target = customers(earlier, inputs.ANCHOR)
    return _upserted(spark, target, customers(rows, inputs.ANCHOR), CUSTOMER_KEY)


def _layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per layer as the write of each layer observed them, each computed once from the one before."""
    bronze, brought = stage(spark, inputs.bronze(spark, sf_dir), "bronze")
    silver, conformed = stage(spark, conform(bronze), "silver")
    counts = {
        "bronze": brought["rows"],
        "silver": conformed["rows"],
        "gold_sales": stage(spark, sales(silver), "sales")[1]["rows"],
        "gold_customer": stage(spark, customers(silver, inputs.ANCHOR), "customers")[1]["rows"],
    }
    return spark.createDataFrame(list(counts.items()), "layer string, n long")


def _trigger_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runnable_keys(inputs.notifications(spark, sf_dir))


def _trigger_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return started_count(_trigger_keys(spark, sf_dir))


def _trigger_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return malformed_count(inputs.damaged_notifications(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "csv_scan": stored.csv_scan,
        "bronze_rows": _bronze_rows,
        "bronze_partitions": _bronze_partitions,
        "bronze_append": stored.bronze_append,
        "bronze_settled": stored.bronze_settled,
        "bronze_slice": _bronze_slice,
        "silver_rows": lambda spark, sf_dir: inputs.silver(spark, sf_dir),
        "upsert_silver": _upsert_silver,
        "upsert_empty": _upsert_empty,
        "gold_sales": _gold_sales,
        "upsert_sales": _upsert_sales,
        "gold_sales_pruned": stored.gold_sales_pruned,
        "customer_metrics": _customer_metrics,
        "customer_latest": _customer_latest,
        "gold_customer": gold_customer,
        "upsert_customer": _upsert_customer,
        "layer_counts": _layer_counts,
        "catalog_gold": stored.catalog_gold,
        "manifest_files": stored.manifest_files,
        "trigger_keys": _trigger_keys,
        "trigger_count": _trigger_count,
        "trigger_malformed": _trigger_malformed,
        "merge_silver_table": stored.merge_silver_table,
        "merge_ranges_table": stored.merge_ranges_table,
        "merge_sales_table": stored.merge_sales_table,
        "merge_customer_table": stored.merge_customer_table,
        "event_run": stored.event_run,
        "run_counts": stored.run_counts,
        "layered_silver": stored.layered_silver,
        "layered_sales": stored.layered_sales,
        "stream_customers": stored.stream_customers,
        "stream_files": stored.stream_files,
        "layered_run": stored.layered_run,
    }
