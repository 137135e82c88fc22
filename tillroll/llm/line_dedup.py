"""Line dedup: overlapping three-line windows, repeated ones found over the whole corpus.

Lines are hashed in windows of three. The first occurrence of a window, by document and then
by place, stays; every later one covers its three lines, and all covered lines go. A removed
line always has an equal line further ahead that stays, so no line is lost from the corpus.

Defined cases: documents are ordered by id (NULL first), then by a 128-bit key of the text.
Rows that agree in id and text are one document and keep the same lines. A text of fewer than
three lines, and a window without any word, are left alone; NULL stays NULL. A document all of
whose lines go keeps its row with an empty text. All other columns stay as they are.

Hot windows: counts and first places are plain aggregates, so a passage that a third of the
corpus shares shrinks to one row per task before the shuffle; in the join back it is the large
side, which AQE splits. Only (hash, document, place) is shuffled for it, and whole texts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import WORD, let, text_key, unused_name

WINDOW = 3


def _window_keys(lines: Column, size: int) -> Column:
    """One 128-bit key per window, NULL for one without a word."""

    def key(i: Column) -> Column:
        members = [F.get(lines, i + k) for k in range(size)]
        worded = members[0].rlike(WORD)
        for line in members[1:]:
            worded = worded | line.rlike(WORD)
        pair = F.struct(
            F.xxhash64(*members).alias("low"), F.xxhash64(F.lit("second"), *members).alias("high")
        )
        return F.when(worded, pair)

    keys = F.transform(F.sequence(F.lit(0), F.size(lines) - size), key)
    return F.when(F.size(lines) >= size, keys)


def _document(docs: DataFrame, doc_id: str, text: str) -> Column:
    key = text_key(F.col(text))
    return F.struct(F.col(doc_id).alias("id"), key["low"].alias("low"), key["high"].alias("high"))


def covered_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW
) -> DataFrame:
    """(document, covered): the places, from 0, of the lines that go, per document that loses any."""
    windows = (
        docs.filter(F.col(text).contains("\n"))
        .select(
            _document(docs, doc_id, text).alias("document"),
            F.posexplode(
                let(F.split(F.col(text), "\n"), lambda lines: _window_keys(lines, size))
            ).alias("place", "window"),
        )
        .filter(F.col("window").isNotNull())
    )
    firsts = (
        windows.groupBy("window")
        .agg(
            F.min(F.struct("document", "place")).alias("first"),
            F.max(F.struct("document", "place")).alias("last"),
        )
        .filter(F.col("first") != F.col("last"))
        .select("window", "first")
    )
    later = windows.join(firsts, "window").filter(F.struct("document", "place") != F.col("first"))
    places = later.groupBy("document").agg(F.collect_set("place").alias("places"))
    spread = F.transform(
        F.col("places"), lambda place: F.sequence(place, place + F.lit(size - 1))
    )
    return places.select("document", F.array_distinct(F.flatten(spread)).alias("covered"))


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW
) -> DataFrame:
    """`docs` with the repeated lines taken out of `text`, and the number of them as a last column.

    That column is named `n_removed`, with underscores added if `docs` has one of that name.
    """
    document, covered = unused_name(docs.columns, "document"), unused_name(docs.columns, "covered")
    lost = covered_lines(docs, doc_id, text, size).toDF(document, covered)
    keyed = docs.withColumn(document, _document(docs, doc_id, text))

    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(covered))
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    cut = F.when(F.col(covered).isNull(), F.col(text)).otherwise(let(F.split(F.col(text), "\n"), kept))
    # Structs compare their NULL fields as equal, so a NULL id finds its rows too.
    return keyed.join(lost, document, "left").select(
        *(cut.alias(name) if name == text else F.col(f"`{name}`") for name in docs.columns),
        F.coalesce(F.size(covered), F.lit(0)).cast("long").alias(unused_name(docs.columns, "n_removed")),
    )
