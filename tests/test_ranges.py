"""Days cut into ranges: a late row rewrites one range, whatever else its day holds."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from test_run import Landing, line
from tillroll.layers import GOLD_SALES, SILVER
from tillroll.plans.run import Layers
from tillroll.sinks import ranges
from tillroll.sinks.catalog import LayerTable, create_database, create_table, is_view, partitions_of
from tillroll.sinks.manifest import read_manifest
from tillroll.sinks.merge import merge_into


def orders(spark, ids, city="Rome", undated=3, day=None):
    """Orders of which every `undated`-th has no day; `day` puts all into one day of January."""
    n = F.col("n")
    dated = F.lit(day is not None) | (n % undated != 0)
    rows = spark.createDataFrame([(one,) for one in ids], "n int").select(
        F.format_string("O%06d", "n").alias("order_id"), F.lit(None).cast("date").alias("order_date"),
        F.lit(None).cast("date").alias("shipment_date"), F.lit("Air").alias("shipment_mode"), F.lit(city).alias("city"),
        F.when(dated, 2018).alias("year"), F.when(dated, 1).alias("month"),
        F.when(dated, F.lit(day) if day else 1 + n % 5).cast("int").alias("day"),
    )
    return rows.select(*GOLD_SALES.names)


@pytest.fixture
def table(spark, tmp_path, request):
    database = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    create_database(spark, database)
    return Layers(str(tmp_path / "lake"), database=database, range_rows=50).sales


def held(spark, table):
    return {row.order_id: (row.city, row.day) for row in spark.table(table.name).collect()}


def files(spark, table):
    return {path.replace("file:///", "file:/") for path in spark.table(table.stored).inputFiles()}


def check(spark, table, expected):
    rows = spark.table(table.name)
    assert rows.schema.names == GOLD_SALES.names
    assert rows.count() == len(expected) and held(spark, table) == expected
    listed = read_manifest(spark, table)
    assert files(spark, table) <= {row.file_path for row in listed.collect()}
    # Under every day lie the files of its rows and no others, except for empty ones.
    place = ["year", "month", "day"]
    per_day = spark.table(table.stored).select(*place, F.col("_metadata.file_path").alias("file_path")).distinct()
    assert per_day.exceptAll(listed.select(*per_day.columns)).isEmpty()
    extra = [row.file_path for row in listed.exceptAll(per_day.select(*listed.columns)).collect()]
    assert not extra or spark.read.parquet(*extra).isEmpty()


def plain(ids, city="Rome", undated=3):
    return {f"O{n:06d}": (city, None if n % undated == 0 else 1 + n % 5) for n in ids}


ALL = range(3000)


def test_a_late_row_rewrites_less_than_a_tenth_of_the_undated_third(spark, table):
    merge_into(spark, table, orders(spark, ALL))
    undated = spark.table(table.stored).filter("year is null")
    assert undated.count() == 1000
    sizes = [row["count"] for row in undated.groupBy("_range").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 100
    before = files(spark, table)
    merge_into(spark, table, orders(spark, [1500], city="Oslo"))
    after = files(spark, table)
    gone = spark.read.parquet(*(before - after))
    assert gone.count() < 100 and len(before - after) < len(before) / 10
    check(spark, table, {**plain(ALL), **plain([1500], "Oslo")})


def test_without_ranges_the_whole_day_is_rewritten(spark, table):
    """The plain layout, for comparison."""
    table = replace(table, range_rows=0)
    merge_into(spark, table, orders(spark, ALL))
    before = files(spark, table)
    merge_into(spark, table, orders(spark, [1500], city="Oslo"))
    assert spark.read.parquet(*(before - files(spark, table))).count() == 1000
    check(spark, table, {**plain(ALL), **plain([1500], "Oslo")})


def test_new_rows_fill_the_highest_range_and_then_open_the_next(spark, table):
    merge_into(spark, table, orders(spark, range(10), day=1))
    numbers = []
    for start in range(100, 200, 20):
        before = files(spark, table)
        merge_into(spark, table, orders(spark, range(start, start + 20), day=1))
        assert before < files(spark, table)
        numbers.append(len(partitions_of(spark, table)))
    # The first ten rows lie in one or more ranges, by the number of tasks; then fifty fit in one.
    assert numbers[-1] - numbers[0] in (1, 2)
    top = spark.table(table.stored).groupBy("_range").count()
    assert max(row["count"] for row in top.collect()) <= 50
    check(spark, table, {f"O{n:06d}": ("Rome", 1) for n in [*range(10), *range(100, 200)]})


def test_a_batch_too_large_for_one_range_is_dealt(spark, table):
    merge_into(spark, table, orders(spark, range(10)))
    merge_into(spark, table, orders(spark, range(1000, 2000), undated=1))
    undated = spark.table(table.stored).filter("year is null").groupBy("_range").count().collect()
    assert len(undated) > 10 and max(row["count"] for row in undated) < 100
    check(spark, table, {**plain(range(10)), **plain(range(1000, 2000), undated=1)})


def test_rows_move_between_days_and_ranges(spark, table):
    merge_into(spark, table, orders(spark, ALL))
    expected = plain(ALL)
    # All of the undated rows get a day, so their ranges and their day are emptied.
    late = [n for n in ALL if n % 3 == 0]
    merge_into(spark, table, orders(spark, late, city="Bonn", day=2))
    expected |= {f"O{n:06d}": ("Bonn", 2) for n in late}
    assert all(p[0] is not None for p in partitions_of(spark, table))
    check(spark, table, expected)
    # Some lose it again, beside new ones.
    merge_into(spark, table, orders(spark, [0, 3, 6, 9000], city="Oslo"))
    expected |= plain([0, 3, 6, 9000], "Oslo")
    check(spark, table, expected)


def test_a_replay_changes_nothing(spark, table):
    merge_into(spark, table, orders(spark, ALL))
    late = orders(spark, [*range(100), *range(5000, 5100)], city="Oslo")
    for _ in range(2):
        merge_into(spark, table, late)
        check(spark, table, {**plain(ALL), **plain([*range(100), *range(5000, 5100)], "Oslo")})
    places = len(partitions_of(spark, table))
    merge_into(spark, table, late)
    assert len(partitions_of(spark, table)) == places


@pytest.mark.parametrize("step", ["write_manifest", "point_partitions", "point_table", "drop_partitions", "_append"])
def test_a_lost_merge_is_completed_by_a_repeat(spark, table, step, monkeypatch):
    merge_into(spark, table, orders(spark, ALL))
    # Rows 0 to 299 leave their ranges, of which some empty; others change in place or are new.
    late = orders(spark, range(300), city="Bonn", day=4).union(orders(spark, [1500, 1501, 7000, 7001], city="Oslo"))
    with monkeypatch.context() as patch:
        patch.setattr(f"tillroll.sinks.merge.{step}", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            merge_into(spark, table, late)
    merge_into(spark, table, late)
    moved = {f"O{n:06d}": ("Bonn", 4) for n in range(300)}
    check(spark, table, {**plain(ALL), **moved, **plain([1500, 1501, 7000, 7001], "Oslo")})


@pytest.mark.parametrize("step", ["write_first", "define_table", "repair", "set_property", "show"])
def test_a_lost_first_write_leaves_nothing_behind(spark, table, step, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(ranges, step, lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            merge_into(spark, table, orders(spark, range(100)))
    assert not spark.catalog.tableExists(table.name)
    merge_into(spark, table, orders(spark, range(50, 150), city="Oslo"))
    shown = {**(plain(range(100)) if step == "show" else {}), **plain(range(50, 150), "Oslo")}
    check(spark, table, shown)


@pytest.mark.parametrize("step", ["write_first", "define_table", "repair", "set_property", "show", None])
def test_a_table_without_ranges_is_dealt_into_ranges(spark, table, step, monkeypatch):
    old = replace(table, range_rows=0)
    merge_into(spark, old, orders(spark, ALL))
    before = files(spark, old)
    if step:
        with monkeypatch.context() as patch:
            patch.setattr(ranges, step, lambda *_: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError, match="lost"):
                merge_into(spark, table, orders(spark, [5], city="Oslo"))
        assert held(spark, table) == plain(ALL)
    merge_into(spark, table, orders(spark, [5], city="Oslo"))
    assert is_view(spark, table) and len(partitions_of(spark, table)) > 10
    check(spark, table, {**plain(ALL), **plain([5], "Oslo")})
    assert spark.read.parquet(*before).count() == 3000


def test_a_key_that_the_table_holds_twice_is_updated_twice(spark, table):
    twice = orders(spark, range(10)).union(orders(spark, [4], city="Bonn", day=4))
    merge_into(spark, table, twice)
    merge_into(spark, table, orders(spark, [4], city="Oslo"))
    rows = spark.table(table.name).filter("order_id = 'O000004'").collect()
    assert [(row.city, row.day) for row in rows] == [("Oslo", 5)] * 2


def test_defined_cases(spark, table):
    nothing = orders(spark, [1]).limit(0)
    assert merge_into(spark, table, nothing) == 0
    merge_into(spark, table, orders(spark, [1, 2]).withColumn("_range", F.lit(77)).withColumn("_stretch", F.lit("x")))
    assert merge_into(spark, table, nothing) == 0
    check(spark, table, plain([1, 2]))
    with pytest.raises(ValueError, match="1 source rows .* have no order_id"):
        merge_into(spark, table, orders(spark, [1]).withColumn("order_id", F.lit(None).cast("string")))
    with pytest.raises(Exception, match="several source rows match order_id"):
        merge_into(spark, table, orders(spark, [1, 1]))


def test_runs_keep_silver_and_sales_in_ranges(spark, tmp_path):
    landing = Landing(spark, tmp_path, "t_run_ranges")
    landing.layers = replace(landing.layers, range_rows=10)
    landing.run("a.csv", *(line(i, f"O{i:03d}", "bad" if i % 3 == 0 else "12/1/2018", f"C{i % 7}") for i in range(300)))
    tables = landing.layers.silver, landing.layers.sales
    before = [files(spark, table) for table in tables]
    landing.run("b.csv", line(150, "O150", "worse", "C3", city="Oslo"), line(900, "O900", "12/2/2018"))
    for table, old in zip(tables, before, strict=True):
        assert 0 < spark.read.parquet(*(old - files(spark, table))).count() < 30
        assert spark.table(table.name).columns == (SILVER if table.key == "row_id" else GOLD_SALES).names
    assert spark.table(tables[0].name).filter("city = 'Oslo'").count() == 1
    landing.check_gold()


def test_an_old_lake_goes_on_with_ranges(spark, tmp_path):
    """Silver and sales from before there were ranges."""
    landing = Landing(spark, tmp_path, "t_before_ranges")
    landing.layers = replace(landing.layers, range_rows=0)
    landing.run("a.csv", line(1, "O1", "12/1/2018"), line(2, "O2", "bad", "C2"))
    landing.layers = replace(landing.layers, range_rows=10)
    landing.run("b.csv", line(2, "O2", "12/1/2018", "C2"), line(3, "O1", "12/1/2018"))
    assert landing.silver("row_id", "day") == [(1, 1), (2, 1), (3, 1)]
    landing.check_gold()
    assert rows_of(spark.table(landing.layers.sales.name).select("order_id", "day")) == [("O1", 1), ("O2", 1)]


def test_a_plain_table_under_the_name_is_told_from_a_view(spark, tmp_path):
    create_database(spark, "t_told")
    table = LayerTable("t_told.s", str(tmp_path / "s"), GOLD_SALES, "order_id", ("year", "month", "day"))
    assert not is_view(spark, table)
    orders(spark, [1]).write.partitionBy("year", "month", "day").parquet(f"{tmp_path}/s/v")
    create_table(spark, table, f"{tmp_path}/s/v")
    assert not is_view(spark, table)
    assert ranges.ready(spark, replace(table, range_rows=5)) and is_view(spark, table)
