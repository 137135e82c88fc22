"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Each rule bounds a ratio of two counts of the text. All counts come from one expression over
the whole text, so the operator is a projection (or a filter) with no shuffle.

Defined cases: a NULL or empty text has no word, all counts are 0, and it is rejected. Ratios
over nothing are not judged. Rows are judged one by one, so ties, repeated rows and empty
tables need no rule, and all columns of the input stay, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SEPARATORS, WORD, let, unused_name, words

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by",
    "are", "this", "at", "from", "or", "an", "not", "have", "you", "he", "she", "they", "we", "but",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "que", "une", "pour", "est", "qui", "dans",
    "sur", "par", "pas", "au", "avec", "il", "ne", "se", "ce",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "für", "im", "ist", "dem",
    "nicht", "ein", "eine", "als", "auch", "es",
    "el", "y", "los", "las", "del", "por", "con", "no", "su", "una", "para", "al", "lo", "como",
]


@dataclass(frozen=True)
class Rule:
    """`low` <= `part` / `whole` <= `high`; a bound may be missing."""

    name: str
    part: str
    whole: str | None = None
    low: float | None = None
    high: float | None = None


# The table: a text is kept if it breaks no rule.
RULES = (
    Rule("length", "n_words", low=50),
    Rule("word_length", "word_chars", "n_words", low=2.5, high=12),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.06),
    Rule("wordless", "n_wordless", "n_words", high=0.3),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.4),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=0.4),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.5),
)


def _without(text: Column, parts: str) -> Column:
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(""))
    return text


def _repeat_words(tokens: Column) -> Column:
    """Words in three-word windows that the text holds twice or more, the first included.

    Windows are compared by a 64-bit hash within one text. Only texts that repeat a window
    sort theirs to find which words these cover.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 3),
        lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)),
    )

    def covered(keys: Column) -> Column:
        order = F.sort_array(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("at"))))

        def repeated(ranked: Column) -> Column:
            return F.filter(
                ranked,
                lambda row, i: (row["key"] == F.get(ranked, i - 1)["key"])
                | (row["key"] == F.get(ranked, i + 1)["key"]),
            )

        places = F.transform(
            let(order, repeated), lambda row: F.array(row["at"], row["at"] + 1, row["at"] + 2)
        )
        return F.size(F.array_distinct(F.flatten(places)))

    def count(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), 0).otherwise(covered(keys))

    return F.when(F.size(tokens) < 3, 0).otherwise(let(windows, count))


def _counts(parts: Column) -> dict[str, Column]:
    text, tokens, lines = parts["text"], parts["words"], parts["lines"]
    bare = F.transform(tokens, lambda word: F.rtrim(F.lower(word), F.lit(".,;:!?")))
    counts = {
        "n_words": F.size(tokens),
        "word_chars": F.length(_without(text, " " + SEPARATORS)),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(tokens),
        "n_stop_words": F.size(F.filter(bare, lambda word: word.isin(STOP_WORDS))),
        "n_wordless": F.size(F.filter(tokens, lambda word: ~word.rlike(r"[\p{L}\p{N}]"))),
        "n_lines": F.size(lines),
        "n_ellipsis_lines": F.size(
            F.filter(lines, lambda line: line.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))
        ),
    }
    return {name: count.cast("long") for name, count in counts.items()}


def _breaks(counts: Column, rule: Rule) -> Column:
    part, whole = counts[rule.part], F.lit(1) if rule.whole is None else counts[rule.whole]
    breaks = F.lit(False)
    if rule.low is not None:
        breaks = breaks | (part < whole * rule.low)
    if rule.high is not None:
        breaks = breaks | (part > whole * rule.high)
    return breaks


def verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """A struct of all counts, of a boolean `breaks_<rule>` per rule, and of `kept`."""
    whole = F.coalesce(text, F.lit(""))
    parts = F.struct(
        whole.alias("text"),
        words(text).alias("words"),
        F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )

    def judged(counts: Column) -> Column:
        broken = {rule.name: _breaks(counts, rule) for rule in rules}
        kept = F.lit(True)
        for breaks in broken.values():
            kept = kept & ~breaks
        return F.struct(
            counts.alias("counts"),
            *(breaks.alias(f"breaks_{name}") for name, breaks in broken.items()),
            kept.alias("kept"),
        )

    def counted(values: Column) -> Column:
        return F.struct(*(count.alias(name) for name, count in _counts(values).items()))

    return let(let(parts, counted), judged)


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text breaks no rule, with their columns as they were."""
    name = unused_name(docs.columns, "quality")
    return docs.withColumn(name, verdict(F.col(text), rules)).filter(F.col(name)["kept"]).drop(name)
