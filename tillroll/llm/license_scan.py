"""License detection by ordered signature rules.

A text is read as words. A rule is tried only if the text holds a word of each of its gates. What the
rules find is resolved by priority and containment: taken by tier, then the longer first, then by
the order of the rules, a detection is dropped if it lies within a kept one, or if it
spans a kept one of a higher tier, which names the license more exactly. Detections that only overlap
at their ends both stay. Base phrases are found apart; they are always kept and suppress nothing.

Scale: a projection without a shuffle; the rules are a few hundred kB of code. Texts pass through
Python in slices of Arrow batches, whole, so memory follows the longest text.

Defined cases: NULL and empty texts have no words and no detections. Only A-Z are folded; words are
runs of ASCII letters, digits and anything beyond ASCII. Rows are independent, so ties, repeated rows
and empty tables need no rule; all columns stay, and clashing names get new ones.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import license_rules
from tillroll.llm.common import ship, unused_name
from tillroll.llm.license_rules import Rule, rules

ship(__name__)
ship(license_rules.__name__)

SLICE = 256
# The base phrases and their labels; with the confidence of each.
PHRASES = {
    "cc by": ("cc-by", 0.6),
    "general public license": ("gpl", 0.6),
    "all rights reserved": ("reserved", 0.3),
}
BASE = 0
_KEPT = bytes(
    ord(chr(byte).lower()) if byte < 128 and chr(byte).isalnum() else byte if byte >= 128 else 32 for byte in range(256)
)
DETECTION = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("tier", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


class Detection(NamedTuple):
    """Words `start` to `end` (exclusive). Tier 0 is a base phrase; `rule` is the rule's place."""

    label: str
    tier: int
    confidence: float
    start: int
    end: int
    rule: int = 0


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_KEPT).split()


@cache
def _by_word() -> dict[bytes, list[int]]:
    """Rules by the words of their smallest gate."""
    found = defaultdict(list)
    for i, rule in enumerate(rules()):
        for word in min(rule.gates, key=len):
            found[word.encode()].append(i)
    return dict(found)


@cache
def _gates(rule: Rule) -> list[set[bytes]]:
    return [{word.encode() for word in gate} for gate in rule.gates]


@cache
def _compiled(pattern: str) -> re.Pattern[bytes]:
    return re.compile(pattern.encode() + b"(?= )")


def candidates(vocabulary: set[bytes]) -> list[int]:
    """The rules that a text of these words may match."""
    by_word = _by_word()
    near = {i for word in vocabulary & by_word.keys() for i in by_word[word]}
    return sorted(i for i in near if all(not gate.isdisjoint(vocabulary) for gate in _gates(rules()[i])))


def resolve(found: list[Detection]) -> list[Detection]:
    """What priority and containment leave, in order of place."""
    # No kept span contains another, so their starts and ends rise together.
    starts, ends, kept = [], [], []
    for one in sorted(found, key=lambda one: (one.tier, one.start - one.end, one.rule, one.start)):
        before = bisect_right(starts, one.start)
        if before and ends[before - 1] >= one.end:
            continue
        after = bisect_left(starts, one.start)
        if after < len(ends) and ends[after] <= one.end:
            # It is longer, so what it spans is of a higher tier.
            continue
        starts.insert(after, one.start)
        ends.insert(after, one.end)
        kept.append(one)
    return sorted(kept, key=lambda one: (one.start, one.end, one.label))


def _phrases(spaced: bytes) -> list[tuple[int, int, str, float]]:
    found = []
    for phrase, (label, confidence) in PHRASES.items():
        wanted = f" {phrase} ".encode()
        at = spaced.find(wanted)
        while at >= 0:
            found.append((at, phrase.count(" ") + 1, label, confidence))
            at = spaced.find(wanted, at + 1)
    return found


def scan(text: str | None) -> tuple[int, list[Detection]]:
    """The number of words, and all detections by place, base phrases included."""
    words = words_of(text or "")
    vocabulary = set(words)
    spaced = b" ".join([b"", *words, b""])
    # Character places first; they become word numbers in one pass over the text.
    raw = [(at, length, label, BASE, confidence, 0) for at, length, label, confidence in _phrases(spaced)]
    for i in candidates(vocabulary):
        rule = rules()[i]
        for match in _compiled(rule.pattern).finditer(spaced):
            raw.append((match.start(), match[0].count(b" "), rule.label, rule.tier, rule.confidence, i))
    found, at, number = [], 0, 0
    for place, length, label, tier, confidence, i in sorted(raw):
        number += spaced.count(b" ", at, place)
        at = place
        found.append(Detection(label, tier, confidence, number, number + length, i))
    base = [one for one in found if one.tier == BASE]
    rest = resolve([one for one in found if one.tier != BASE])
    return len(words), sorted(base + rest, key=lambda one: (one.start, one.end, one.tier, one.label))


def score(found: list[Detection]) -> float:
    """How sure it is that the text names a license: each label's best detection as an independent witness."""
    best: dict[str, float] = {}
    for one in found:
        best[one.label] = max(best.get(one.label, 0.0), one.confidence)
    doubt = 1.0
    for label in sorted(best):
        doubt *= 1.0 - best[label]
    return 1.0 - doubt


def find_licenses(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns in `keep`) with `n_words`, `score` and `detections`.

    `detections` is an array of (label, tier, confidence, start, end), places counted in words.
    """
    columns = docs.columns if keep is None else keep
    same = [F.col(f"`{name}`").alias(f"kept_{i}") for i, name in enumerate(columns)]
    fields = docs.select(*same).schema.add("n_words", "long").add("sure", "double").add("found", T.ArrayType(DETECTION))
    names = DETECTION.names
    kind = pa.list_(pa.struct(zip(names, (pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.int64()))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                *kept, texts = batch.slice(start, SLICE).columns
                scanned = [scan(text.as_py()) for text in texts]
                made = [
                    pa.array([n for n, _ in scanned], pa.int64()),
                    pa.array([score(found) for _, found in scanned], pa.float64()),
                    pa.array([[dict(zip(names, one)) for one in found] for _, found in scanned], kind),
                ]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=fields.names)

    made = docs.select(*same, F.col(f"`{text}`").alias("given")).mapInArrow(run, fields)
    return made.toDF(*columns, *(unused_name(columns, wish) for wish in ("n_words", "score", "detections")))
