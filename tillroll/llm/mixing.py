"""Mixing sources to target weights by entropy balancing.

Sources, ordered by code point with NULL last, weigh 1, 2, 3, repeating, and share the corpus
size; a target stops at CAP times its source's size and the excess is shared anew. Among all
document rates between 0 and CAP that meet the token constraints, entropy balancing takes the
one nearest to "every document once" in relative entropy: rate = min(CAP, exp(slope * size)),
with one slope, the dual variable, per source. Newton steps on the convex dual, kept inside a
bracket, find the slopes. Rates become whole copies by a hash of the document, and a few
last copies per source are added or taken back to meet the target closely.

Scale: rates depend on source and size only, so documents shrink once to counts per (source,
size) and every Newton step is an aggregate of that table; a hot source is spread over its
sizes. Sums are of whole numbers, so reruns agree to the last digit. Tables of one row per
source or size are joined by whatever join their measured size allows. Only the ranking of the
sources, one row each, meets in one task. The driver sees one number per step.

A source that has not settled after STEPS steps is an error.

Defined cases: the size is the number of words (NULL text: 0). NULL is a source like any other.
Rows that agree in id, text and source get the same copies. A document of size 0 is taken once and counts nothing. An
empty table gives an empty mix. Other columns stay as they are.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import WORD, staged, text_key
from tillroll.sinks.staging import stage

CAP = 3
WEIGHTS = 3
STEPS = 60
TOLERANCE = 1e-7
REPAIRS = 8
LANES = 8
_UNIT = 1e6


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_of(doc_id: str, text: str) -> Column:
    key = text_key(F.col(text))
    return F.struct(F.col(doc_id).alias("id"), key["low"].alias("low"), key["high"].alias("high"))


def measured_columns(doc_id: str, source: str, text: str) -> list[Column]:
    """document, origin and size of a row. Keys are structs, whose NULL fields equal each other."""
    return [
        document_of(doc_id, text).alias("document"),
        F.struct(F.col(source).alias("source")).alias("origin"),
        size_of(F.col(text)).alias("size"),
    ]


def measured(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    return docs.select(*measured_columns(doc_id, source, text))


def _exact(value: Column) -> Column:
    """A sum that doesn't depend on the order of its rows."""
    return F.sum(F.round(value * _UNIT).cast("decimal(38,0)")).cast("double") / _UNIT


def targets(sizes: DataFrame) -> DataFrame:
    """(origin, smallest, source_size, target) from counts per origin and size."""
    sources = sizes.groupBy("origin").agg(
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("smallest"),
        F.sum(F.col("n") * F.col("size")).alias("source_size"),
    )
    by_name = Window.orderBy(F.col("origin.source").asc_nulls_last())
    weighed = sources.withColumn("weight", F.pmod(F.row_number().over(by_name) - 1, F.lit(WEIGHTS)) + 1)
    # Sources fill up in the order of room per weight. Before each, the rest is shared by the
    # weights of those not yet full; this level rises as sources fill up and falls after that.
    room = CAP * F.col("source_size")
    filling = Window.orderBy(room / F.col("weight"), F.col("origin.source").asc_nulls_last())
    before = F.coalesce(F.sum(room).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.withColumn("level", (F.sum("source_size").over(whole) - before) / weights)
    return levels.select(
        "origin",
        "smallest",
        "source_size",
        F.least(room.cast("double"), F.col("weight") * F.max("level").over(whole)).alias("target"),
    )


def _rate(slope: Column, size: Column) -> Column:
    return F.least(F.lit(float(CAP)), F.exp(slope * size))


def slopes(spark: SparkSession, sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """(origin, source_size, target, slope): the dual solution per source."""
    share = F.col("target") / F.col("source_size")
    shrinks = F.col("target") <= F.col("source_size")
    state = staged(
        spark,
        goals.filter("source_size > 0").select(
            "origin",
            "source_size",
            "target",
            F.lit(0.0).alias("slope"),
            F.when(shrinks, F.log(share) / F.col("smallest")).otherwise(F.lit(0.0)).alias("low"),
            F.when(shrinks, F.lit(0.0)).otherwise(log(CAP) / F.col("smallest")).alias("high"),
        ),
        "slopes",
    )
    full = F.col("target") >= CAP * F.col("source_size")
    for _ in range(STEPS):
        rate = _rate(F.col("slope"), F.col("size"))
        tokens = F.col("n") * F.col("size") * rate
        sums = (
            sizes.filter("size > 0")
            .join(state, "origin")
            .groupBy("origin")
            .agg(
                _exact(tokens).alias("tokens"),
                _exact(F.when(rate < CAP, tokens * F.col("size")).otherwise(0.0)).alias("curve"),
            )
        )
        over = F.col("tokens") > F.col("target")
        # Newton on the log of the constraint: the same root, and far fewer steps where the
        # longest documents alone make up the gradient.
        gap = F.log("tokens") - F.log("target")
        newton = F.col("slope") - F.try_divide(gap * F.col("tokens"), F.col("curve"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        stepped = (
            state.join(sums, "origin")
            .withColumn("high", F.when(over, F.col("slope")).otherwise(F.col("high")))
            .withColumn("low", F.when(over, F.col("low")).otherwise(F.col("slope")))
            .withColumn("gap", F.when(full, 0.0).otherwise(F.abs(F.col("tokens") / F.col("target") - 1)))
            .select(
                "origin",
                "source_size",
                "target",
                F.when(F.col("gap") <= TOLERANCE, F.col("slope"))
                .when(inside, newton)
                .otherwise((F.col("low") + F.col("high")) / 2)
                .alias("slope"),
                "low",
                "high",
                "gap",
            )
        )
        staged_step, seen = stage(spark, stepped, "slopes", gap=F.max("gap"))
        state = staged_step.drop("gap")
        if (seen["gap"] or 0.0) <= TOLERANCE:
            break
    else:
        raise ValueError(f"after {STEPS} steps a source is still off its target by a factor of {1 + seen['gap']}")
    # A full source takes every document CAP times.
    final = state.withColumn("slope", F.when(full, F.lit(1e300)).otherwise(F.col("slope")))
    return (
        goals.select("origin", "source_size", "target")
        .join(final.select("origin", "slope"), "origin", "left")
        .fillna(0.0, ["slope"])
    )


def _first_copies(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Rows with `copies`: the rate, rounded up or down by a hash of the document."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("copies"), "document"), 11) * F.lit(2.0**-53)
    copies = F.floor(_rate(F.col("slope"), F.col("size")) + draw)
    return rows.join(solved, "origin").withColumn("copies", F.least(F.lit(CAP), copies).cast("long"))


def repairs(spark: SparkSession, rows: DataFrame, solved: DataFrame) -> DataFrame:
    """(document, origin, change): copies to add or take back, at most REPAIRS documents per source.

    For each size up to LANES documents that may gain a copy, and as many that may lose one,
    stand by; each round picks, per source, the one that brings the taken words nearest to the
    target.
    """
    units = rows.groupBy("document", "origin", "size").agg(F.count(F.lit(1)).alias("n"))
    taken = staged(
        spark,
        _first_copies(units, solved).filter("size > 0").select(
            "document", "origin", "size", "n", "copies", "target"
        ),
        "copies",
    )
    moves = F.explode(F.array(F.lit(1), F.lit(-1)))
    standby = staged(
        spark,
        taken.select("document", "origin", "size", "n", "copies", moves.alias("change"))
        .filter((F.col("copies") + F.col("change")).between(0, CAP))
        .groupBy("origin", "size", "n", "change", F.pmod(F.xxhash64("document"), F.lit(LANES)))
        .agg(F.min("document").alias("document"))
        .select("origin", "document", "change", (F.col("change") * F.col("size") * F.col("n")).alias("words")),
        "standby",
    )
    words = F.sum(F.col("size") * F.col("n") * F.col("copies"))
    state = staged(
        spark,
        taken.groupBy("origin").agg((F.max("target") - words).alias("missing")),
        "missing",
    )
    picked, found = [], None
    for _ in range(REPAIRS):
        left = standby
        for earlier in picked:
            left = left.join(earlier, ["document", "origin"], "left_anti")
        best = (
            left.join(state, "origin")
            .groupBy("origin")
            .agg(
                F.max("missing").alias("missing"),
                F.min(
                    F.struct(
                        F.abs(F.col("missing") - F.col("words")).alias("gap"), "document", "change", "words"
                    )
                ).alias("best"),
            )
        )
        helps = F.col("best.gap") < F.abs("missing")
        step = staged(
            spark,
            best.select(
                "origin",
                F.when(helps, F.col("missing") - F.col("best.words")).otherwise(F.col("missing")).alias("missing"),
                F.when(helps, F.col("best.document")).alias("document"),
                F.when(helps, F.col("best.change")).alias("change"),
            ),
            "repairs",
        )
        state = step.select("origin", "missing")
        changes = step.filter("document IS NOT NULL").select("document", "origin", "change")
        picked.append(changes.drop("change"))
        found = changes if found is None else found.union(changes)
    return staged(spark, found, "repairs")


def copies(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The solution: (origin, source_size, target, slope) and (document, origin, change)."""
    sizes = staged(
        spark, rows.groupBy("origin", "size").agg(F.count(F.lit(1)).alias("n")), "sizes"
    )
    solved = staged(spark, slopes(spark, sizes, staged(spark, targets(sizes), "targets")), "solved")
    return solved, repairs(spark, rows, solved)


def with_copies(rows: DataFrame, solved: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows that hold document, origin and size, with source_size, target and copies."""
    first = _first_copies(rows, solved).drop("slope")
    return first.join(changes, ["document", "origin"], "left").withColumn(
        "copies", F.col("copies") + F.coalesce("change", F.lit(0))
    ).drop("change")


def mix(
    spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """`docs` with each row repeated as often as the mix takes it; columns as they were."""
    solved, changes = copies(spark, staged(spark, measured(docs, doc_id, source, text), "sizes"))
    # The row travels as one struct, so its columns can have any names.
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    keys = measured_columns(doc_id, source, text)
    taken = with_copies(docs.select(row, *keys), solved, changes).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
