from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows_of
from tillroll.operators.append import append_by_name
from tillroll.operators.pick import highest_per_key, lowest_per_key
from tillroll.operators.upsert import upsert

DDL = "k int, a string, b int"
ROW = st.tuples(
    st.one_of(st.none(), st.integers(0, 6)),
    st.one_of(st.none(), st.sampled_from("xyz")),
    st.one_of(st.none(), st.integers(0, 3)),
)
PROPERTY = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def expected_rows(rows):
    return sorted(rows, key=repr)


def unique_keys(rows):
    keyed = {row[0]: row for row in rows if row[0] is not None}
    return [*keyed.values(), *(row for row in rows if row[0] is None)]


def expected_upsert(target, source):
    by_key = {row[0]: row for row in source if row[0] is not None}
    held = {row[0] for row in target}
    updated = [by_key.get(row[0], row) for row in target]
    return sorted(updated + [r for r in source if r[0] is None or r[0] not in held], key=repr)


@PROPERTY
@given(st.lists(ROW, max_size=12), st.lists(ROW, max_size=12).map(unique_keys))
def test_upsert_matches_brute_force(spark, target, source):
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    assert rows_of(upsert(t, s, "k")) == expected_upsert(target, source)


@PROPERTY
@given(st.lists(ROW, max_size=10).map(unique_keys), st.lists(ROW, max_size=10).map(unique_keys))
def test_upsert_is_idempotent_on_keyed_rows(spark, target, source):
    source = [row for row in source if row[0] is not None]
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    once = upsert(t, s, "k")
    assert rows_of(upsert(once, s, "k")) == rows_of(once)


def test_upsert_with_a_third_of_all_rows_on_one_key_and_a_third_without_key(spark):
    target = [(7, "old", i) for i in range(300)] + [(None, "kept", 0)] * 300 + [(i, "o", i) for i in range(100, 400)]
    source = [(7, "new", None), (150, None, 1), (999, "added", 2)] + [(None, "added", 0)] * 100
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    assert rows_of(upsert(t, s, "k")) == expected_upsert(target, source)


def test_upsert_rejects_two_source_rows_for_one_target_row(spark):
    t = spark.createDataFrame([(1, "a", 1)], DDL)
    twice = spark.createDataFrame([(1, "b", 1), (1, "c", 1)], DDL)
    with pytest.raises(Exception, match="several source rows match k 1"):
        upsert(t, twice, "k").collect()
    # Unmatched copies are two inserts, not an error.
    other = spark.createDataFrame([(2, "b", 1), (2, "c", 1)], DDL)
    merged = upsert(t, other, "k")
    assert rows_of(merged) == [(1, "a", 1), (2, "b", 1), (2, "c", 1)]
    # Filters on the result must not carry the check to rows it is not about.
    assert rows_of(merged.filter("k = 2 and b = 1")) == [(2, "b", 1), (2, "c", 1)]
    assert merged.filter("k is null").isEmpty()


def test_a_source_of_copies_is_added_whole_when_unmatched(spark):
    t = spark.createDataFrame([(1, "a", 1)], DDL)
    copies = [(5, "copy", 0)] * 200 + [(None, "copy", 0)] * 200
    assert rows_of(upsert(t, spark.createDataFrame(copies, DDL), "k")) == expected_rows(
        [(1, "a", 1), *copies]
    )


def test_append_by_name_fills_missing_columns(spark):
    first = spark.createDataFrame([("1", "x")], "a string, b string")
    second = spark.createDataFrame([("y", "2")], "b string, c string")
    both = append_by_name(first, second)
    assert both.columns == ["a", "b", "c"]
    assert rows_of(both) == [("1", "x", None), (None, "y", "2")]


@PROPERTY
@given(st.lists(ROW, max_size=15), st.randoms())
def test_picks_match_sorting_and_ignore_input_order(spark, rows, rng: random.Random):
    shuffled = list(rows)
    rng.shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, DDL).repartition(3)

    def last_if_null(value):
        return (value is None, value if value is not None else "" if isinstance(value, str) else 0)

    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    low = [min(g, key=lambda r: (last_if_null(r[2]), r[1] is None, r[1] or "")) for g in groups.values()]
    high = [
        max(g, key=lambda r: (r[2] is not None, r[2] or 0, r[1] is not None, r[1] or ""))
        for g in groups.values()
    ]
    assert rows_of(lowest_per_key(frame, "k", ["b"])) == sorted(low, key=repr)
    assert rows_of(highest_per_key(frame, "k", ["b"])) == sorted(high, key=repr)
