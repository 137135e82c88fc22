"""Filter interaction audit: what each filter removes under every order of the filters.

Five filters judge every document: A too few words, B too few distinct words, C too many
capitals, D a symbol, E a copy of a document with a smaller id. A and B read row sums and nonzero
counts of a sparse document-term matrix (`term_matrix`); the other flags ride along as columns of its
rows. A document then is a set of failed filters. Counts per part and set are enough for
every order: a filter removes those whose set holds it and no filter before it.

Scale: after the matrix, one narrow row per document is stored. Copies are found by the smallest id per
128-bit text key, aggregated per task before the shuffle; only keys of several rows are joined
back, with the documents, where a hot key may be, on the left for AQE to split. Everything after the
counts works on at most 32 sets per part.

Defined cases: NULL text is empty; NULL and empty parts are one. A NULL id is no copy's
smaller id, is itself never a copy, and has no labels. Rows of one id are not copies of each
other; labels of a repeated id count if any of its rows has them. Empty documents pass B and C.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import term_matrix
from tillroll.llm.common import ship, staged, text_key

ship(__name__)

FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}


_NOT_CAPITALS = bytes(byte for byte in range(256) if not ord("A") <= byte <= ord("Z"))
_CONTINUATION = bytes(range(0x80, 0xC0))


def _capitals(text: bytes) -> int:
    return len(text.translate(None, _NOT_CAPITALS))


def _code_points(text: bytes) -> int:
    return len(text.translate(None, _CONTINUATION))


def _symbols(text: bytes) -> int:
    return len(text) - len(text.translate(None, SYMBOLS))


MEASURES = {"capitals": _capitals, "points": _code_points, "symbols": _symbols}


def _bit(letter: str, failed: Column) -> Column:
    return F.when(failed, BIT[letter]).otherwise(0)


def failures(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, n_words, n_terms, failed): `failed` is the sum of BIT over the failed filters."""
    keep = {
        "doc_id": F.col(f"`{doc_id}`"),
        "part": F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")),
        "key": text_key(F.coalesce(F.col(f"`{text}`"), F.lit(""))),
    }
    shards, _ = term_matrix.build(spark, docs, text, keep, MEASURES)
    totals = term_matrix.row_totals(shards)
    own = (
        _bit("A", F.col("n_words") < LEAST_WORDS)
        + _bit("B", 100 * F.col("n_terms") < DISTINCT_PERCENT * F.col("n_words"))
        + _bit("C", 100 * F.col("doc.capitals") > CAPITAL_PERCENT * F.col("doc.points"))
        + _bit("D", F.col("doc.symbols") > 0)
    )
    rows = staged(
        spark, totals.select("doc.doc_id", "doc.part", F.col("doc.key.low").alias("low"), F.col("doc.key.high").alias("high"), "n_words", "n_terms", own.alias("own")), "flags"
    )
    several = (
        rows.groupBy("low", "high").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.join(several, ["low", "high"], "left").select(
        "doc_id", "part", "n_words", "n_terms", (F.col("own") + _bit("E", copy)).alias("failed")
    )


def _steps() -> Column:
    """Every (filter_order, step, bit of its filter, bits of the filters before)."""
    made = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            made.append((order, step, BIT[letter], before))
            before |= BIT[letter]
    fields = "array<struct<filter_order:string,step:int,own:int,before:int>>"
    rows = [f"{order},{step},{own},{before}" for order, step, own, before in made]
    cut = F.split(F.lit(";".join(rows)), ";")
    return F.transform(
        cut, lambda row: F.struct(*(F.split(row, ",")[i].alias(f"f{i}") for i in range(4)))
    ).cast(fields)


def audit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    `labels` holds (doc_id, quality, toxic). The Shapley count is a filter's removals over all orders: a
    document that fails k filters falls to each of them in one k-th of the orders.
    """
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    judged = failures(spark, docs, doc_id, text, part).join(marks, F.col("doc_id") == F.col("id"), "left")
    sets = judged.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic")
    )
    parts = sets.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "n_good", "n_toxic")).alias("sets"))
    placed = parts.select("part", "sets", F.explode(_steps()).alias("at"))
    own, before = F.col("at.own"), F.col("at.before")

    def total(name: str, holds) -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate("sets", zero, lambda sum_, one: sum_ + F.when(holds(one["failed"]), one[name]).otherwise(zero))

    def fails(failed: Column) -> Column:
        return failed.bitwiseAND(own) != 0

    def gone(failed: Column) -> Column:
        return failed.bitwiseAND(before) != 0

    def falls(failed: Column) -> Column:
        return fails(failed) & ~gone(failed)

    share = F.aggregate(
        "sets",
        F.lit(0).cast("long"),
        lambda sum_, one: sum_
        + F.when(fails(one["failed"]), F.lit(len(ORDERS)) / F.bit_count(one["failed"]) * one["n"]).otherwise(F.lit(0)).cast("long"),
    )
    return placed.select(
        "part",
        "at.filter_order",
        "at.step",
        total("n", lambda failed: ~gone(failed) & ~fails(failed)).alias("kept"),
        total("n", falls).alias("removed"),
        total("n", lambda failed: fails(failed) & gone(failed)).alias("redundant"),
        total("n", lambda failed: failed == own).alias("unique_fails"),
        total("n_good", falls).alias("good_lost"),
        total("n_toxic", falls).alias("toxic_lost"),
        share.alias("shapley"),
    )
