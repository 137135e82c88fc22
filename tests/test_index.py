"""Touched silver rows are found through the index of days, never by reading all of silver."""

from __future__ import annotations

import pytest

from test_run import Landing, line
from tillroll.plans import run as plans_run
from tillroll.sinks import day_index


@pytest.fixture
def landing(spark, tmp_path, request):
    return Landing(spark, tmp_path, "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower())


@pytest.fixture
def touched(monkeypatch):
    """(key, files read, plan, rows) of every look-up of touched rows."""
    seen = []

    def watched(spark, layers, key, pending):
        rows = touched_rows(spark, layers, key, pending)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        seen.append((key, len(rows.inputFiles()), plan, rows.count()))
        return rows

    touched_rows = plans_run.touched_rows
    monkeypatch.setattr(plans_run, "touched_rows", watched)
    return seen


def days(n, start=0):
    return [line(i, f"O{i // 2}", f"{1 + i // 25}/{1 + i % 25}/2018", f"C{i % 7}") for i in range(start, start + n)]


def test_a_batch_reads_only_the_days_of_its_keys(landing, spark, touched):
    landing.run("a.csv", *days(60))
    assert not touched
    landing.run("b.csv", line(1000, "O1000", "12/1/2018", "C1000"))
    landing.run("c.csv", line(1001, "O1000", "12/2/2018", "C1000"), line(4, "O2", "12/3/2018", "C1001"))
    every = len(spark.table(landing.layers.silver.name).inputFiles())
    assert every > 50
    # Orders O1000 and O2 had three days and get one more; customers C1000, C1001 and C4 had at most ten.
    reads = {key: (files, rows) for key, files, _, rows in touched[2:]}
    assert reads["order_id"][0] <= 5 and reads["order_id"][1] == 4
    assert reads["customer_id"][0] <= 14 and reads["customer_id"][1] < 14
    for _, _, plan, _ in touched[2:]:
        scan = next(text for text in plan.splitlines() if "silver_orders[" in text)
        assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
        # The silver side goes to the join as it is read: the keys are broadcast.
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    landing.check_gold()


def test_the_index_covers_moved_rows_undated_rows_and_its_own_compaction(landing, spark, monkeypatch):
    monkeypatch.setattr(day_index, "FILES_PER_BUCKET", 0)
    landing.run("a.csv", *days(12), line(100, "O50", "bad", "C50"))
    landing.run("b.csv", line(2, "O1", "", "C50"), line(3, "O1", "6/6/2018", "C8"))
    landing.run("c.csv", line(100, "O50", "7/7/2018", "C51"), line(2, "O9", "7/7/2018", "C50"))
    landing.check_gold()
    for key in landing.layers.silver.indexed:
        index = day_index.index_of(landing.layers.silver, key)
        held = spark.table(landing.layers.silver.name).select(key, "year", "month", "day").distinct()
        listed = spark.table(index.name).drop("_bucket")
        assert held.subtract(listed).isEmpty()
        assert listed.count() == listed.distinct().count()


@pytest.mark.parametrize("step", ["sinks.day_index.add", "sinks.day_index.write_counted"])
def test_a_run_lost_while_it_keeps_the_index_is_mended_by_the_next(landing, monkeypatch, step):
    landing.run("a.csv", *days(6))
    if step.endswith("add"):
        landing.run("b.csv", line(50, "O50", "5/5/2018"))

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(f"tillroll.{step}", lost)
        with pytest.raises(RuntimeError):
            landing.run("c.csv", line(1, "O0", "9/9/2018", "C77"))
    landing.run("d.csv", line(51, "O51", "5/5/2018"))
    assert landing.silver("row_id", "day")[1] == (1, 9)
    landing.check_gold()


def test_a_replay_adds_nothing_to_the_index(landing, spark):
    landing.run("a.csv", *days(4))
    landing.run("b.csv", line(50, "O50", "5/5/2018"))
    indexes = [day_index.index_of(landing.layers.silver, key) for key in landing.layers.silver.indexed]
    before = [spark.table(index.name).count() for index in indexes]
    landing.run("b.csv", line(50, "O50", "5/5/2018"))
    assert [spark.table(index.name).count() for index in indexes] == before
