"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as the
assistant and the others as named users. Masks are the character spans, in the rendered text,
of what the assistant says and its end mark: the part to learn from.

A rendering comes in blocks of BLOCK turn numbers, and a block in parts of at most BLOCK turns, cut
by rank in the one order of all turns: however many turns share a number, parts in order, joined
without a separator, are the whole dialogue. An endless conversation never meets in one task, and
most conversations have one block of one part. Ranks are taken only where a block holds more than
BLOCK turns: those rows are sorted by ranges, which also part equal rows.

Defined cases: every row is a turn, also one that equals another. Turns come by number (NULL first,
as block -1), speaker (NULL first) and text. A NULL speaker is a participant of its own, shown
without a name; a NULL text is empty; rows with a NULL conversation id form one conversation. So that
neither can pass for a mark, `<|` is written `<||` in texts and names (and read back the other
way), and line breaks in names are shown as spaces. Other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import let
from tillroll.llm.places import numbered

BLOCK = 64
# Fixed marks of the rendered format.
ASSISTANT = "<|assistant|>\n"
USER = "<|user|>"
END = "<|end|>\n"
OPENING, DOUBLED = "<|", "<||"


def turns(rows: DataFrame, conversation: str, turn: str, speaker: str, text: str) -> DataFrame:
    """(dialogue, turn, speaker, text); the dialogue is a struct, so that NULL ids meet."""
    return rows.select(
        F.struct(F.col(f"`{conversation}`").alias("id")).alias("dialogue"),
        F.col(f"`{turn}`").alias("turn"),
        F.col(f"`{speaker}`").alias("speaker"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )


def ranked(said: DataFrame, size: int) -> DataFrame:
    """`said`, which has blocks, with each turn's part of its block: its rank there by `size`."""
    names = ["dialogue", "block", "turn", "speaker", "text"]
    homed = said.withColumn("home", F.struct("dialogue", "block"))
    crowded = homed.groupBy("home").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > size).select("home")
    full = homed.join(crowded, "home", "left_semi")
    placed = numbered(said.sparkSession, full, ["home", "turn", "speaker", "text"])
    first = placed.groupBy("home").agg(F.min("place").alias("first"))
    part = F.floor((F.col("place") - F.col("first")) / size).cast("long").alias("part")
    rest = homed.join(crowded, "home", "left_anti").select(*names, F.lit(0).cast("long").alias("part"))
    return rest.unionByName(placed.join(first, "home").select(*names, part))


def blocks(said: DataFrame, size: int = BLOCK) -> DataFrame:
    """(dialogue, block, part, turns): each part's turns in order."""
    block = F.coalesce(F.floor(F.col("turn") / size), F.lit(-1)).cast("long")
    return ranked(said.withColumn("block", block), size).groupBy("dialogue", "block", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns")
    )


def _rendered(turn: Column, participant: Column) -> tuple[Column, Column]:
    """What comes before the text of a turn, and the text with its end mark."""
    name = F.translate(_shown(turn["speaker"]), "\n", " ")
    user = F.concat(F.lit(USER), F.coalesce(F.concat(F.lit(" "), name), F.lit("")), F.lit("\n"))
    head = F.when(turn["speaker"].eqNullSafe(participant), F.lit(ASSISTANT)).otherwise(user)
    return head, F.concat(_shown(turn["text"]), F.lit(END))


def _shown(text: Column) -> Column:
    return F.replace(text, F.lit(OPENING), F.lit(DOUBLED))


def _drawn(turns: Column, me: Column) -> Column:
    """(rendered, masks) of a few turns."""
    rendered = F.array_join(F.transform(turns, lambda turn: F.concat(*_rendered(turn, me))), "")

    def step(state: Column, turn: Column) -> Column:
        head, body = _rendered(turn, me)
        start = state["length"] + F.length(head)
        end = start + F.length(body)
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        none = F.array().cast("array<struct<start:int,end:int>>")
        masks = F.concat(state["masks"], F.when(turn["speaker"].eqNullSafe(me), own).otherwise(none))
        return F.struct(end.alias("length"), masks.alias("masks"))

    begun = F.struct(
        F.lit(0).alias("length"), F.array().cast("array<struct<start:int,end:int>>").alias("masks")
    )
    return F.struct(
        rendered.alias("rendered"), F.aggregate(turns, begun, step, lambda state: state["masks"]).alias("masks")
    )


def _joined(pieces: Column) -> Column:
    """(rendered, masks) of pieces of those, in order."""

    def moved(starts: Column) -> Column:
        return F.flatten(
            F.zip_with(
                pieces,
                F.slice(starts, 1, F.size(pieces)),
                lambda piece, start: F.transform(
                    piece["masks"],
                    lambda mask: F.struct((mask["start"] + start).alias("start"), (mask["end"] + start).alias("end")),
                ),
            )
        )

    starts = F.aggregate(
        pieces,
        F.array(F.lit(0)),
        lambda starts, piece: F.concat(starts, F.array(F.element_at(starts, -1) + F.length(piece["rendered"]))),
    )
    rendered = F.array_join(F.transform(pieces, lambda piece: piece["rendered"]), "")
    return F.struct(rendered.alias("rendered"), let(starts, moved).alias("masks"))


def rotate(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    size: int = BLOCK,
) -> DataFrame:
    """(conversation, participant, block, part, n_turns, rendered, masks).

    `masks` is an array of (start, end) in characters of `rendered`, ends exclusive. Views of a
    participant in order of block and part are the whole dialogue.
    """
    said = turns(rows, conversation, turn, speaker, text)
    people = said.select("dialogue", F.col("speaker").alias("participant")).distinct()
    views = blocks(said, size).join(people, "dialogue")
    # Masks are gathered over BLOCK turns at a time, as each step copies those before.
    steps = F.sequence(F.lit(0), F.floor((F.size("turns") - 1) / BLOCK).cast("int"))
    pieces = F.transform(steps, lambda i: _drawn(F.slice("turns", i * BLOCK + 1, F.lit(BLOCK)), F.col("participant")))
    return views.withColumn("view", let(pieces, _joined)).select(
        F.col("dialogue.id").alias(conversation),
        "participant",
        "block",
        "part",
        F.size("turns").cast("long").alias("n_turns"),
        "view.rendered",
        "view.masks",
    )
