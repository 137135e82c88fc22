"""The upsert of rows that lie in places, as ranges of days are."""

from __future__ import annotations

import pytest

from conftest import rows_of
from tillroll.operators.upsert import upsert
from tillroll.sinks import merge
from tillroll.workload import stored

TARGET = [(1, 1, "a"), (1, 2, "b"), (None, 3, "c"), (2, 3, "d"), (2, 3, "d"), (2, None, "e"), (None, None, "f"), (3, 7, "g")]
SOURCE = [(1, 1, "A"), (2, 2, "B"), (None, 3, None), (2, 4, "D"), (2, 4, "D"), (4, None, "E"), (4, None, "E")]


def frames(spark, source=SOURCE):
    """Target, source, and the place and key of each target row that has a source row."""
    columns = "place int, k int, v string"
    target, source = spark.createDataFrame(TARGET, columns), spark.createDataFrame(source, columns)
    return target, source, target.join(source.select("k"), "k", "left_semi").select("k", "place")


def test_it_returns_what_the_upsert_by_key_does(spark):
    target, source, matched = frames(spark)
    placed = upsert(target, source, "k", matched, ("place",), 3)
    assert rows_of(placed) == rows_of(upsert(target, source, "k", matched))
    # Key 3 was there three times: each copy moved to its source row's place.
    assert placed.filter("k = 3").select("place", "v").collect() == [(None, None)] * 3
    assert placed.count() == len(TARGET) + 4


def test_several_rows_for_a_held_key_are_an_error(spark):
    target, source, matched = frames(spark, [*SOURCE, (9, 1, "Z")])
    with pytest.raises(Exception, match="several source rows match k 1"):
        upsert(target, source, "k", matched, ("place",), 3).collect()


def test_the_target_is_shuffled_once_and_by_place(spark, tmp_path):
    for name, frame in zip(("target", "source", "matched"), frames(spark)):
        frame.write.parquet(str(tmp_path / name))
    target, source, matched = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source", "matched"))
    text = upsert(target, source, "k", matched, ("place",), 3)._jdf.queryExecution().executedPlan().toString()
    above_union = text.split("Union")[0]
    assert above_union.count("Exchange") == 1 and "hashpartitioning(place" in above_union
    of_target = text.split("Union")[1].split("FileScan")[0]
    assert "Exchange" not in of_target and "Join" not in of_target
    assert "rangepartitioning" not in text


def test_late_rows_are_not_dealt_by_ranges_and_stored_rows_not_copied(spark, monkeypatch):
    copied, dealt = [], []
    staged, laid = merge.stage, merge.write_counted
    monkeypatch.setattr(merge, "stage", lambda spark, rows, label, **kw: copied.append(label) or staged(spark, rows, label, **kw))
    monkeypatch.setattr(merge, "write_counted", lambda *args, **kw: dealt.append(kw.get("dealt")) or laid(*args, **kw))
    assert stored.merge_ranges_table(spark, "/root/testdata/sf0.001").filter("listed").count() > 0
    assert copied == ["source", "matched"] and dealt == [True]
