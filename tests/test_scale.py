"""Work per task and per row that must not grow with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from test_ranges import ALL, orders
from test_run import Landing, line
from tillroll.layers import CUSTOMER_KEY, INGEST_ID, SALES_KEY
from tillroll.sinks.slices import SliceTable, read_slices, slice_ids, write_slices
from tillroll.sinks.staging import clustered
from tillroll.sources.landing import header_lines, listed_files, scan_files
from tillroll.workload import inputs, registry, stored

TINY = "/root/testdata/sf0.001"


def test_a_task_derives_a_bounded_number_of_landing_rows(spark, monkeypatch):
    monkeypatch.setattr(inputs, "LINES_PER_TASK", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = inputs.landing(spark, TINY).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(row["count"] for row in held) == 4599
    assert max(row["count"] for row in held) < 300


def test_landing_rows_are_derived_once(spark, monkeypatch):
    labels = []
    staged = stored.stage
    for module in (stored, registry):
        monkeypatch.setattr(module, "stage", lambda spark, rows, label, **kw: labels.append(label) or staged(spark, rows, label, **kw))
    assert stored.bronze_append(spark, TINY).count() == 4599
    assert labels == ["landing"]
    registry.queries()["upsert_sales"](spark, TINY)
    assert labels[1] == "silver"


def test_short_stretches_share_a_task(spark):
    rows = orders(spark, ALL)
    dealt = clustered(rows, ("year", "month", "day"), "order_id", "_stretch", 3000, 10)
    dealt = dealt.withColumn("_task", F.spark_partition_id()).localCheckpoint()
    assert dealt.select("_task").distinct().count() <= spark.sparkContext.defaultParallelism
    sizes = dealt.groupBy("_stretch").agg(F.count("*").alias("n"), F.countDistinct("_task").alias("tasks")).collect()
    assert len(sizes) >= 300 and {row.tasks for row in sizes} == {1}
    assert max(row.n for row in sizes) == 10
    # A stretch is one of the order: those of a day don't overlap.
    bounds = dealt.groupBy("day", "_stretch").agg(F.min("order_id").alias("low"), F.max("order_id").alias("high")).collect()
    for day in {row.day for row in bounds}:
        ordered = sorted((row.low, row.high) for row in bounds if row.day == day)
        assert all(one[1] < two[0] for one, two in zip(ordered, ordered[1:]))
    assert dealt.drop("_stretch", "_task").exceptAll(rows).isEmpty() and dealt.count() == 3000


def test_a_header_is_read_from_the_first_part_that_has_one(spark, tmp_path):
    folder = tmp_path / "f.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text("\n \n")
    for n in (1, 2):
        (folder / f"part-{n}.csv").write_text(f"Row ID,Order ID\n{n},O{n}\n")
    uri = str(folder)
    files = listed_files(spark, [uri])[uri]
    assert len(files) == 3 and header_lines(spark, [uri], files[:1]) == {}
    assert header_lines(spark, [uri], files[1:2]) == {files[1]: "Row ID,Order ID"}
    (rows,) = scan_files(spark, [(uri, "k", "i")])
    assert rows.columns[:2] == ["row_id", "order_id"] and rows.filter("row_id in ('1', '2')").count() == 2


def test_one_slice_is_written_without_a_sort_and_may_be_empty(spark, tmp_path, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_one_slice")
    table = SliceTable("t_one_slice.s", str(tmp_path / "s"))
    rows = spark.range(5).withColumn(INGEST_ID, F.lit("a"))
    sorts = []
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.partitionBy", lambda self, *names: sorts.append(names) or self)
    assert write_slices(spark, table, rows, ["a"]) == {"a": 5}
    assert write_slices(spark, table, rows.limit(0), ["a"], frozenset(["a"])) == {"a": 0}
    assert slice_ids(spark, table) == ["a"] and read_slices(spark, table).isEmpty()
    assert write_slices(spark, table, rows.limit(0), ["a"]) == {"a": 0}
    assert slice_ids(spark, table) == [] and sorts == []


def test_keys_are_kept_only_for_gold_tables_that_exist(spark, tmp_path):
    landing = Landing(spark, tmp_path, "t_no_keys")
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line(2, "O2", "12/2/2018", "C2"))
    pending = [landing.layers.pending(key).name for key in (SALES_KEY, CUSTOMER_KEY)]
    assert not any(spark.catalog.tableExists(name) for name in pending)
    landing.check_gold()
    landing.run("b.csv", line(2, "O2", "12/3/2018", "C2"))
    assert all(spark.catalog.tableExists(name) for name in pending)
    landing.check_gold()
