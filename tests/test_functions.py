from __future__ import annotations

from datetime import date
from urllib.parse import quote_plus, unquote_plus

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.cleaning import form_decoded, landing_date, name_part, whole_number
from tillroll.functions.dates import day_parts, in_trailing_months


def evaluate(spark, column, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row.y for row in frame.select("i", column.alias("y")).orderBy("i").collect()]


DATES = {
    "1/2/2018": date(2018, 1, 2),
    "01/02/2018": date(2018, 1, 2),
    "12/30/2018": date(2018, 12, 30),
    "1/2/18": None,
    " 1/2/2018": None,
    "1/2/2018 ": None,
    "1/2/2018 10:00": None,
    "2018-01-02": None,
    "13/1/2018": None,
    "2/30/2018": None,
    "": None,
    None: None,
}
NUMBERS = {
    "12": 12, " 12 ": 12, "1.5": None, "abc": None, "3000000000": None, "1e3": None, "": None,
    None: None,
}
NAMES = {
    "Claire Gute": ("Claire", "Gute"),
    "Ann Mary Van Dyk": ("Ann", "Mary Van Dyk"),
    "Mary  Ann": ("Mary", " Ann"),
    "Cher": ("Cher", None),
    "": ("", None),
    " A B ": ("A", "B"),
    "\tA B": ("\tA", "B"),
    None: (None, None),
}
KEYS = {
    "a+b%20c.csv": "a b c.csv",
    "a%2Fb.csv": "a/b.csv",
    "bad%zz.csv": "bad%zz.csv",
    "x%2": "x%2",
    "mixed%20%zz+%2": "mixed %zz %2",
    "caf%C3%A9": "café",
    None: None,
}


def test_landing_date(spark, any_ansi):
    assert evaluate(spark, landing_date(F.col("x")), DATES) == list(DATES.values())


def test_whole_number(spark, any_ansi):
    assert evaluate(spark, whole_number(F.col("x")), NUMBERS) == list(NUMBERS.values())


@pytest.mark.parametrize("position", [0, 1])
def test_name_part(spark, any_ansi, position):
    expected = [parts[position] for parts in NAMES.values()]
    assert evaluate(spark, name_part(F.col("x"), position), NAMES) == expected


def test_form_decoded(spark, any_ansi):
    assert evaluate(spark, form_decoded(F.col("x")), KEYS) == list(KEYS.values())


def test_form_decoded_agrees_with_the_standard_library(spark):
    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.text(alphabet="a+%2F zé/.", max_size=8), min_size=1, max_size=20))
    def check(texts):
        keys = texts + [quote_plus(text) for text in texts]
        assert evaluate(spark, form_decoded(F.col("x")), keys) == [unquote_plus(k) for k in keys]

    check()


@pytest.mark.parametrize(
    ("anchor", "months", "start"),
    [
        (date(2018, 12, 30), 1, date(2018, 11, 30)),
        (date(2018, 12, 30), 6, date(2018, 6, 30)),
        (date(2018, 12, 31), 1, date(2018, 11, 30)),
        (date(2018, 8, 31), 6, date(2018, 2, 28)),
    ],
)
def test_trailing_months_exclude_the_start_and_include_the_anchor(spark, anchor, months, start):
    after_start = date.fromordinal(start.toordinal() + 1)
    after_anchor = date.fromordinal(anchor.toordinal() + 1)
    days = [start, after_start, anchor, after_anchor, None]
    inside = evaluate(spark, in_trailing_months(F.col("x"), anchor, months), days, "date")
    assert inside == [False, True, True, False, None]


def test_day_parts(spark):
    frame = spark.createDataFrame([(date(2018, 1, 2),), (None,)], "d date")
    parts = frame.select(*(c.alias(n) for n, c in day_parts(F.col("d")).items()))
    assert parts.columns == ["year", "month", "day"]
    assert [tuple(r) for r in parts.collect()] == [(2018, 1, 2), (None, None, None)]
