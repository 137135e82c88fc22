"""Landing files through all layers."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tillroll.plans.customers import customers
from tillroll.plans.run import LandingFile, Layers, refresh_gold, run_file, run_files
from tillroll.plans.sales import sales
from tillroll.sinks.catalog import repair
from tillroll.sinks.manifest import manifest_path, read_manifest
from tillroll.sinks.merge import merge_into
from tillroll.sinks.slices import slice_ids
from tillroll.sources.bronze_files import read_bronze, read_slice

HEADER = "Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,City"


class Landing:
    """Layers of their own plus a folder to drop CSV files into."""

    def __init__(self, spark, folder, database):
        self.spark, self.folder = spark, folder
        self.layers = Layers(str(folder / "lake"), database=database)

    def run(self, name, *lines, header=HEADER, at="2019-01-01T00:00:00+00:00"):
        path = self.folder / name
        path.write_text("\n".join([header, *lines]) + "\n")
        return run_file(self.spark, self.layers, str(path), "bucket", f"landing/{name}", at)

    def run_all(self, files, at="2019-01-01T00:00:00+00:00"):
        """`files` maps names to lines; all come in one batch."""
        landed = []
        for name, lines in files.items():
            path = self.folder / name
            path.write_text("\n".join([HEADER, *lines]) + "\n")
            landed.append(LandingFile(str(path), "bucket", f"landing/{name}"))
        return run_files(self.spark, self.layers, landed, at)

    def tables(self):
        return self.silver("*"), self.sales("*"), self.customers("*")

    def silver(self, *columns):
        return rows_of(self.spark.table(self.layers.silver.name).select(*columns))

    def sales(self, *columns):
        return rows_of(self.spark.table(self.layers.sales.name).select(*columns))

    def customers(self, *columns):
        return rows_of(self.spark.table(self.layers.customers.name).select(*columns))

    def check_gold(self):
        """The incrementally kept tables equal a full recomputation, the manifests list their files."""
        silver = self.spark.table(self.layers.silver.name)
        keyed = sales(silver.filter("order_id is not null"))
        assert self.sales("*") == rows_of(keyed)
        assert self.customers("*") == rows_of(customers(silver, self.layers.anchor))
        for table in (self.layers.sales, self.layers.customers):
            listed = {row.file_path for row in read_manifest(self.spark, table).collect()}
            rows = self.spark.table(table.stored).select("_metadata.file_path").distinct()
            holding = {row.file_path for row in rows.collect()}
            assert holding <= listed
            extra = [path for path in listed - holding]
            assert not extra or self.spark.read.parquet(*extra).isEmpty()


@pytest.fixture
def landing(spark, tmp_path, request):
    database = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    return Landing(spark, tmp_path, database)


def line(row_id, order, day, customer="C1", city="Rome", name="Ann Lee", segment="Home"):
    return f"{row_id},{order},{day},12/5/2018,Air,{customer},{name},{segment},Italy,{city}"


def test_first_file_fills_every_layer(landing):
    report = landing.run(
        "a.csv", line(1, "O1", "12/1/2018"), line(2, "O1", "12/1/2018", city="Oslo"),
        line(3, "O2", "7/1/2018"), line("x", "O3", "12/1/2018"), line(4, "O4", "bad"),
    )
    assert (report.bronze, report.rejected, report.silver) == (5, 1, 4)
    assert (report.sales, report.customers) == (3, 1)
    assert landing.sales("order_id", "city", "year") == [
        ("O1", "Rome", 2018), ("O2", "Rome", 2018), ("O4", "Rome", None),
    ]
    assert landing.customers("customer_id", "customer_last_name", "orders_last_month",
                             "orders_last_6_months", "orders_all_time") == [("C1", "Lee", 1, 2, 3)]
    landing.check_gold()


def test_replay_changes_nothing(landing, spark):
    lines = [line(1, "O1", "12/1/2018"), line(2, "O2", "12/2/2018", "C2"), line("x", "O3", "1/1/2018")]
    landing.run("a.csv", *lines)
    before = landing.silver("*"), landing.sales("*"), landing.customers("*")
    report = landing.run("a.csv", *lines, at="2019-02-02T00:00:00+00:00")
    assert report.rejected == 1
    assert (landing.silver("*"), landing.sales("*"), landing.customers("*")) == before
    assert read_bronze(spark, landing.layers.bronze).count() == 3
    landing.check_gold()


def test_late_update_moves_a_row_and_empties_its_day(landing, spark):
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line(2, "O2", "12/2/2018"))
    landing.run("b.csv", line(1, "O1", "12/3/2018", city="Oslo"))
    assert landing.silver("row_id", "city", "day") == [(1, "Oslo", 3), (2, "Rome", 2)]
    assert landing.sales("order_id", "day") == [("O1", 3), ("O2", 2)]
    landing.check_gold()

    # The emptied day takes rows again, and its old files stay out, repair or not.
    repair(spark, landing.layers.silver)
    landing.run("c.csv", line(3, "O3", "12/1/2018"))
    repair(spark, landing.layers.silver)
    assert landing.silver("row_id", "day") == [(1, 3), (2, 2), (3, 1)]
    landing.check_gold()


def test_update_into_a_day_that_is_kept(landing):
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line(2, "O2", "12/2/2018"), line(3, "O3", "12/1/2018"))
    landing.run("b.csv", line(1, "O1", "12/2/2018", city="Oslo"), line(4, "O4", "12/2/2018"))
    assert landing.silver("row_id", "city", "day") == [
        (1, "Oslo", 2), (2, "Rome", 2), (3, "Rome", 1), (4, "Rome", 2),
    ]
    landing.check_gold()


def test_row_that_changes_customer_updates_both(landing):
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line(2, "O2", "12/2/2018"))
    landing.run("b.csv", line(2, "O2", "12/2/2018", "C2"))
    assert landing.customers("customer_id", "orders_all_time") == [("C1", 1), ("C2", 1)]
    landing.check_gold()


def test_undated_rows_share_the_null_partition(landing):
    landing.run("a.csv", line(1, "O1", "bad"), line(2, "O2", ""))
    landing.run("b.csv", line(2, "O2", "", city="Oslo"), line(3, "O3", "worse"))
    assert landing.silver("row_id", "city", "year") == [
        (1, "Rome", None), (2, "Oslo", None), (3, "Rome", None),
    ]
    landing.check_gold()


def test_columns_may_come_and_go(landing, spark):
    landing.run("a.csv", line(1, "O1", "12/1/2018"))
    landing.run("b.csv", line(2, "O2", "12/1/2018") + ",9.5", header=HEADER + ",Profit")
    landing.run("c.csv", "3,O3,12/1/2018,C1", header="Row ID,Order ID,Order Date,Customer ID")
    bronze = read_bronze(spark, landing.layers.bronze)
    assert rows_of(bronze.select("row_id", "profit", "city")) == [
        ("1", None, "Rome"), ("2", "9.5", "Rome"), ("3", None, None),
    ]
    assert landing.silver("row_id", "city") == [(1, "Rome"), (2, "Rome"), (3, None)]
    assert read_slice(spark, landing.layers.bronze, "bucket", "landing/b.csv").count() == 1
    landing.check_gold()


def test_copies_inside_one_file_count_once(landing):
    report = landing.run("a.csv", *[line(1, "O1", "12/1/2018")] * 5)
    assert (report.bronze, report.silver) == (5, 1)
    report = landing.run("a.csv", *[line(1, "O1", "12/1/2018")] * 5)
    assert landing.silver("row_id") == [(1,)]


def test_empty_file_and_file_without_keys_change_nothing(landing, spark):
    report = landing.run("empty.csv")
    assert report.bronze == 0
    assert landing.run("keyless.csv", line("x", "O1", "12/1/2018")).rejected == 1
    assert not spark.catalog.tableExists(landing.layers.silver.name)
    landing.run("a.csv", line(1, "O1", "12/1/2018"))
    assert landing.run("keyless2.csv", line("y", "O1", "12/1/2018")).silver == 0
    assert landing.silver("row_id") == [(1,)]


def test_same_key_in_two_buckets_is_two_files(landing, spark):
    path = landing.folder / "a.csv"
    for bucket, row in (("b1", 1), ("b2", 2)):
        path.write_text(f"{HEADER}\n{line(row, 'O1', '12/1/2018')}\n")
        run_file(spark, landing.layers, str(path), bucket, "landing/a.csv")
    assert read_bronze(spark, landing.layers.bronze).count() == 2
    assert landing.silver("row_id") == [(1,), (2,)]


def test_refresh_gold_with_a_new_anchor(landing, spark):
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line(2, "O2", "1/15/2019"))
    assert landing.customers("orders_last_month") == [(1,)]
    later = Layers(landing.layers.root, landing.layers.database, date(2019, 2, 1))
    refresh_gold(spark, later)
    assert landing.customers("orders_last_month", "orders_last_6_months") == [(1, 2)]
    landing.layers = later
    landing.check_gold()


def test_merge_refuses_keyless_rows(landing, spark):
    landing.run("a.csv", line(1, "O1", "12/1/2018"))
    table = landing.layers.silver
    keyless = spark.table(table.name).withColumn("row_id", F.lit(None).cast("int"))
    with pytest.raises(ValueError, match="have no row_id"):
        merge_into(spark, table, keyless)


STEPS = [
    "plans.run.merge_into", "sinks.merge.write_manifest", "sinks.merge.point_partitions",
    "sinks.merge._append", "sinks.merge.point_table",
]
MORE_STEPS = [
    "plans.run.keyless_rows", "plans.run._record_pending", "plans.run._settle_gold", "sinks.merge.drop_partitions",
]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_lost_at_any_step_is_completed_by_a_repeat(landing, monkeypatch, step):
    """The repeat may no longer see the replaced rows, yet mends customer, order and manifest."""
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line(2, "O2", "12/2/2018"))
    update = line(2, "O2", "12/3/2018", "C2")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(f"tillroll.{step}", lost)
        with pytest.raises(RuntimeError):
            landing.run("b.csv", update)
    landing.run("b.csv", update)
    assert landing.customers("customer_id", "orders_all_time") == [("C1", 1), ("C2", 1)]
    landing.check_gold()


def test_first_gold_table_covers_files_whose_runs_died(landing, monkeypatch):
    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr("tillroll.plans.run.merge_into", lost)
        with pytest.raises(RuntimeError):
            landing.run("a.csv", line(1, "O1", "12/1/2018"))
    landing.run("b.csv", line(2, "O2", "12/2/2018", "C2"))
    assert landing.sales("order_id") == [("O1",), ("O2",)]
    landing.check_gold()


@pytest.mark.parametrize("step", [*STEPS, *MORE_STEPS])
def test_a_lost_run_is_mended_by_the_next_file(landing, monkeypatch, step):
    """Gold follows silver after any later run, though the lost file's run is never repeated."""
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line(2, "O2", "12/2/2018"))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(f"tillroll.{step}", lost)
        with pytest.raises(RuntimeError):
            landing.run("b.csv", line(2, "O2", "12/3/2018", "C2"), line(4, "O4", "12/4/2018", "C4"))
    landing.run("c.csv", line(3, "O3", "12/2/2018", "C3"), line(4, "O4", "12/5/2018", "C4"))
    assert landing.silver("row_id", "day") == [(1, 1), (2, 3), (3, 2), (4, 5)]
    landing.check_gold()
    assert slice_ids(landing.spark, landing.layers.unsettled) == []


def test_a_changed_anchor_counts_all_customers_anew(landing):
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line(2, "O2", "12/2/2018", "C2"))
    landing.layers = Layers(landing.layers.root, landing.layers.database, date(2019, 6, 1))
    landing.run("b.csv", line(3, "O3", "1/2/2018"))
    assert landing.customers("customer_id", "orders_last_month") == [("C1", 0), ("C2", 0)]
    landing.check_gold()


def test_a_batch_equals_its_files_one_by_one(spark, tmp_path, request):
    files = {
        "a.csv": [line(1, "O1", "12/1/2018"), line(2, "O2", "12/2/2018", "C2")],
        "b.csv": [line(1, "O1", "12/3/2018", city="Oslo"), line(3, "O3", "12/2/2018", "C3"), line("x", "O9", "1/1/2018")],
        "c.csv": [line(3, "O3", "bad", "C3", city=""), line(4, "O1", "12/1/2018", city="Bonn")],
    }
    (tmp_path / "one").mkdir()
    (tmp_path / "all").mkdir()
    apart, batch = (Landing(spark, tmp_path / name, f"t_batch_{name}") for name in ("one", "all"))
    for name, lines in files.items():
        apart.run(name, *lines)
    report = batch.run_all(files)
    assert batch.tables() == apart.tables()
    assert (report.bronze, report.rejected, report.silver) == (7, 1, 4)
    batch.check_gold()
    # Again, and on top of what is there.
    batch.run_all(dict(reversed(files.items())))
    assert batch.silver("row_id", "city") == [(1, "Rome"), (2, "Rome"), (3, "Rome"), (4, "Bonn")]
    batch.check_gold()


def test_a_failed_replay_keeps_the_raw_rows(landing, spark, monkeypatch):
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line("x", "O2", "12/1/2018"))
    bronze, rejects = landing.layers.bronze, landing.layers.rejects
    before = rows_of(read_bronze(spark, bronze)), spark.table(rejects.name).count()

    def failing(rows, key, at):
        from tillroll.plans.bronze import bronze_rows

        return bronze_rows(rows, key, at).withColumn("city", F.raise_error(F.lit("disk lost")))

    with monkeypatch.context() as patch:
        patch.setattr("tillroll.plans.run.bronze_rows", failing)
        with pytest.raises(Exception, match="disk lost"):
            landing.run("a.csv", line(1, "O1", "12/1/2018"))
    assert (rows_of(read_bronze(spark, bronze)), spark.table(rejects.name).count()) == before


def test_a_replay_with_fewer_rows_drops_the_others(landing, spark):
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line("x", "O2", "12/1/2018"))
    landing.run("a.csv", line(1, "O1", "12/1/2018"))
    assert read_bronze(spark, landing.layers.bronze).count() == 1
    assert spark.table(landing.layers.rejects.name).count() == 0


def test_emptied_days_cost_no_job_each(landing, spark):
    def jobs_for(days):
        tracker, group = spark.sparkContext.statusTracker(), f"move-{days}"
        landing.run(f"a{days}.csv", *(line(1000 * days + i, f"O{days}-{i}", f"{1 + i % 9}/{1 + i // 9}/201{days % 8}") for i in range(days)))
        spark.sparkContext.setJobGroup(group, "moves rows out of their days")
        landing.run(f"b{days}.csv", *(line(1000 * days + i, f"O{days}-{i}", "12/24/2018") for i in range(days)))
        spark.sparkContext.setJobGroup("", "")
        return len(tracker.getJobIdsForGroup(group))

    few, many = jobs_for(3), jobs_for(27)
    assert many <= few + 8
    landing.check_gold()


def test_pruned_read_touches_one_month(landing, spark):
    landing.run("a.csv", *(line(i, f"O{i}", f"{1 + i % 12}/1/2018") for i in range(24)))
    frame = spark.table(landing.layers.sales.name).filter("year = 2018 and month = 3")
    assert len(frame.inputFiles()) == 1 and frame.count() == 2
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_manifest_hides_from_table_scans(landing, spark):
    landing.run("a.csv", line(1, "O1", "12/1/2018"))
    path = manifest_path(landing.layers.customers)
    assert path.endswith("/_symlink_format_manifest")
    assert spark.read.text(path).count() == 1
