"""Secret scans: patterns of known secrets, and a battery of randomness tests for the rest.

Runs of TOKEN characters are cut at the patterns' matches and at `=` (what pads a run's end stays).
Of what is left, the stretch between signs that is the likeliest to be random, in any of ALPHABETS,
is a string, and the parts before and after it are searched alike; its encoding is the narrowest
alphabet that holds it. The battery tests that its characters are drawn evenly from that alphabet:
chi-squared uniformity, runs above and below the middle of the alphabet, and serial correlation of
neighbours. The three p-values combine into one (Fisher), p, which is even for even draws and is
taken to crowd at 0 for text, with density CROWDED * p ** (CROWDED - 1); the ratio of the two is the
battery's evidence. A test that rejects by itself (P_RANDOM, shared among the three) leaves none.
Short strings pass such tests whatever they are. So the battery's evidence is multiplied by how much
likelier even draws from the alphabet make the string than text does. Text changes
between lower case, upper case, digits and signs at the rate TEXT_CHANGES and draws letters after
the letter before, by counts over all documents or by a fixed table, whichever makes the string
likelier. The product is taken for an e-value (the tests look at places in the alphabet, the text
model at letters in words), so the strings of a text go through false-discovery control with it
(Benjamini-Hochberg for e-values at FALSE_DISCOVERIES, each weighted by its share of the tested
length). What passes is a `random` span.

Scale: one pass that counts letter pairs (729 numbers per task) and a projection without a shuffle;
memory follows the longest text. Patterns run only over texts that can hold them, which never
changes what they find.

Defined cases: a NULL or empty text has no span. Offsets are code points, ends exclusive. Spans
come by start, then kind in the order of KINDS. Rows share the letter counts only; all columns stay.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.bpe import SLICE
from tillroll.llm.common import ship, unused_name

ship(__name__)

KINDS = ("assign", "access", "hex", "random")
# Fixed patterns. The last two hold the least length, since a run is matched whole anyway.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST = 20
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# What `=` parts in a run, the last with what pads it, and what signs part in that.
PIECE = re.compile(r"[^=]+(?:=+\Z)?")
ATOM = re.compile(r"[^+/_-]+")
ASSIGNED = 6
KEYWORDS = ("password", "passwd", "secret", "token", "api")

P_RANDOM = 0.001
CROWDED = 0.5
FALSE_DISCOVERIES = 0.01
# How often neighbouring characters of identifiers, words and paths change their class.
TEXT_CHANGES = 0.15
# Letters a to z per 1,000 of common text: what is believed, as PRIOR letters, before any are counted.
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
PRIOR = 100
# The share of letters that follow no counts, such as those of names and abbreviations.
ODD = 0.1

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "upper hex": _DIGITS + "ABCDEF",
    "lower letters": _LOWER,
    "upper letters": _UPPER,
    "base 32": _UPPER + "234567",
    "lower base 36": _DIGITS + _LOWER,
    "upper base 36": _DIGITS + _UPPER,
    "base 62": _DIGITS + _UPPER + _LOWER,
    "base 64": _UPPER + _LOWER + _DIGITS + "+/",
    "url base 64": _UPPER + _LOWER + _DIGITS + "-_",
}
_MEMBERS = {name: frozenset(letters) for name, letters in ALPHABETS.items()}
_RANKS = {name: {letter: i for i, letter in enumerate(letters)} for name, letters in ALPHABETS.items()}


def encoding_of(string: str) -> str | None:
    """The narrowest alphabet that holds all characters."""
    used = set(string)
    return next((name for name, members in _MEMBERS.items() if used <= members), None)


def _tail(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def _uniformity(places: list[int], k: int) -> float:
    """Upper tail of chi-squared, by the cube-root normal form, with the variance that n gives."""
    n, counts = len(places), {}
    for place in places:
        counts[place] = counts.get(place, 0) + 1
    statistic = sum(count * count for count in counts.values()) * k / n - n
    spread = math.sqrt(2 * (k - 1) * (n - 1) / n)
    scaled = max(0.0, (k - 1) + (statistic - (k - 1)) * math.sqrt(2 * (k - 1)) / spread)
    z = ((scaled / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    return _tail(z)


def _runs(places: list[int], k: int) -> float:
    n = len(places)
    high = [2 * place >= k for place in places]
    ups = sum(high)
    downs = n - ups
    if not ups or not downs:
        return 2.0 ** (1 - n)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    mean = 2 * ups * downs / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return 2 * _tail(abs(runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0


def _serial(places: list[int]) -> float:
    n = len(places)
    mean = sum(places) / n
    gaps = [place - mean for place in places]
    total = sum(gap * gap for gap in gaps)
    if not total:
        return 0.0
    correlation = sum(a * b for a, b in zip(gaps, gaps[1:], strict=False)) / total
    return 2 * _tail(abs(correlation + 1 / n) * math.sqrt(n))


def battery(string: str, encoding: str) -> float:
    """Log of how much likelier even draws than text make the three tests together; none if one rejects."""
    ranks = _RANKS[encoding]
    places = [ranks[letter] for letter in string]
    k = len(ranks)
    chances = _uniformity(places, k), _runs(places, k), _serial(places)
    if min(chances) < P_RANDOM / 3:
        return -math.inf
    # Fisher: the upper tail of chi-squared with six degrees of freedom, at twice `lost`.
    lost = -sum(math.log(chance) for chance in chances)
    combined = math.log(1 + lost + lost * lost / 2) - lost
    return (1 - CROWDED) * combined - math.log(CROWDED)


def _class(letter: str) -> int:
    return 0 if "a" <= letter <= "z" else 1 if "A" <= letter <= "Z" else 2 if "0" <= letter <= "9" else 3


def letter_logs(counts: list[int]) -> list[list[float]]:
    """Log chances of a letter after each letter, from counts of pairs; row 0 is for a first letter.

    `counts` has 27 numbers per letter before, of which the first (no letter after) is unused.
    """
    total = sum(LETTERS)
    logs = []
    for before in range(27):
        own = counts[27 * before + 1 : 27 * before + 27]
        whole = sum(own) + PRIOR
        logs.append(
            [
                math.log((1 - ODD) * (n + PRIOR * usual / total) / whole + ODD / 26)
                for n, usual in zip(own, LETTERS, strict=True)
            ]
        )
    return logs


UNTAUGHT = letter_logs([0] * 729)
_STAY, _CHANGE = math.log1p(-TEXT_CHANGES), math.log(TEXT_CHANGES / 3)


def text_logs(string: str, logs: list[list[float]]) -> list[float]:
    """The log chance in text of each character after the one before."""
    found, before, last = [], -1, 0
    for letter in string:
        kind = _class(letter)
        # After a sign, as at the start, a word of any class may begin.
        chance = math.log(1 / 4) if before in (-1, 3) else _STAY if kind == before else _CHANGE
        if kind < 2:
            place = ord(letter.lower()) - 96
            # A capital after anything but a capital begins a word.
            chance += logs[0 if kind == 1 and before != 1 else last][place - 1]
            last = place
        else:
            chance += math.log(1 / 10 if kind == 2 else 1 / 4)
            last = 0
        found.append(chance)
        before = kind
    return found


def evidence(string: str, encoding: str, logs: list[list[float]]) -> float:
    """Log of how much likelier even draws are than text; one alphabet in all was to be guessed."""
    tested = battery(string, encoding)
    if tested == -math.inf:
        return tested
    even = -len(string) * math.log(len(ALPHABETS[encoding])) - math.log(len(ALPHABETS))
    # The fixed table also counts, for words of languages that are rare in the documents.
    return tested + even - max(sum(text_logs(string, taught)) for taught in (logs, UNTAUGHT))


def _stretch(
    string: str, atoms: list[tuple[int, int]], used: list[frozenset[str]], sums: list[float], first: int, last: int
) -> tuple[float, int, int]:
    """The stretch of `atoms` from `first` up to `last` that even draws from one alphabet favour most.

    `atoms` are the (start, end) between signs, `used` their characters, and `sums` the text_logs
    before each place. The result is (log ratio, first, last) with the last included.
    """
    best = -math.inf, first, first
    for name, members in _MEMBERS.items():
        each = math.log(len(ALPHABETS[name]))
        # `heads` are the atoms where a stretch can begin; `low` is the best that is SHORTEST long.
        heads, low = deque(), None
        for i in range(first, last):
            start, end = atoms[i]
            if i == first or not members.issuperset(string[atoms[i - 1][1] : start]) or not used[i - 1] <= members:
                heads, low = deque(), None
            if not used[i] <= members:
                continue
            heads.append(i)
            while heads and end - atoms[heads[0]][0] >= SHORTEST:
                place = atoms[heads[0]][0]
                low = max(low or (-math.inf, 0), (sums[place] + place * each, heads.popleft()))
            if low is not None:
                best = max(best, (low[0] - sums[end] - end * each, low[1], i))
    return best


def strings_in(string: str, logs: list[list[float]]) -> list[tuple[int, int, float]]:
    """(start, end, evidence) of the strings of a run without `=`; those of no evidence are left out.

    Half of what is believed goes to the whole run, a quarter evenly to its parts between signs, the
    rest evenly to all stretches of those.
    """
    atoms = [match.span() for match in ATOM.finditer(string)]
    if not atoms:
        return []
    used = [frozenset(string[start:end]) for start, end in atoms]
    sums = [0.0, *accumulate(text_logs(string, logs))]
    whole = encoding_of(string)
    n = len(atoms)
    weight = evidence(string, whole, logs) - math.log(min(2, n)) if whole else -math.inf
    found, parts = [], [(0, n)]
    while parts:
        first, last = parts.pop()
        gain, a, b = _stretch(string, atoms, used, sums, first, last)
        if gain <= 0:
            continue
        start, end = atoms[a][0], atoms[b][1]
        own = evidence(string[start:end], encoding_of(string[start:end]), logs)
        own -= math.log(4 * n) if a == b else math.log(2 * n * (n + 1))
        if (first, last) == (0, n) and weight > max(0, own):
            return [(0, len(string), weight)]
        if own > -math.inf:
            found.append((start, end, own))
        elif a < b:
            # The battery rejects the whole stretch: each part by itself.
            parts += [(i, i + 1) for i in range(a, b + 1)]
        parts += [(first, a), (b + 1, last)]
    return sorted(part for part in found if part[2] > 0)


def discoveries(strings: list[str], logs: list[list[float]] = UNTAUGHT) -> list[tuple[int, int, int]]:
    """(number, start, end) of what is random in a text's runs, by weighted false-discovery control."""
    tested, spans = 0, []
    for i, string in enumerate(strings):
        bare = string.rstrip("=")
        if len(bare) >= SHORTEST:
            own = strings_in(bare, logs)
            # What pads the end of a run belongs to its last string.
            spans += [(i, a, len(string) if b == len(bare) else b, b - a, weight) for a, b, weight in own]
            tested += max(1, len(own))
    if not spans:
        return []
    mean = sum(length for _, _, _, length, _ in spans) / len(spans)
    ranked = sorted(((weight + math.log(length / mean), i, a, b) for i, a, b, length, weight in spans), reverse=True)
    last = 0
    for rank, (weighed, *_) in enumerate(ranked, 1):
        if weighed >= math.log(tested / (FALSE_DISCOVERIES * rank)):
            last = rank
    return sorted((i, a, b) for _, i, a, b in ranked[:last])


def scan(text: str, logs: list[list[float]] = UNTAUGHT) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every span, in order."""
    found: list[tuple[int, int, int]] = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= ASSIGNED:
                found.append((match.start(), 0, match.end()))
    if "AKIA" in text:
        found += [(match.start(), 1, match.end()) for match in ACCESS.finditer(text)]
    if max(map(len, text.split()), default=0) >= SHORTEST:
        found += [(match.start(), 2, match.end()) for match in HEX.finditer(text)]
        found += [(start, 3, end) for start, end in _random(text, found, logs)]
    return [(KINDS[kind], start, end) for start, kind, end in sorted(found)]


def _random(text: str, known: list[tuple[int, int, int]], logs: list[list[float]]) -> Iterator[tuple[int, int]]:
    ends = sorted((start, end) for start, _, end in known)
    candidates, at, reach = [], 0, 0
    for match in TOKEN.finditer(text):
        place = max(match.start(), reach)
        while at < len(ends) and ends[at][0] < match.end():
            candidates += _pieces(text, place, ends[at][0])
            reach = max(reach, ends[at][1])
            place = max(place, reach)
            at += 1
        candidates += _pieces(text, place, match.end())
    for i, start, end in discoveries([text[a:b] for a, b in candidates], logs):
        yield candidates[i][0] + start, candidates[i][0] + end


def _pieces(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [match.span() for match in PIECE.finditer(text, start, end) if len(match[0]) >= SHORTEST]


_LONG = re.compile(TOKEN.pattern.encode())
_CODES = bytes(ord(chr(i).lower()) - 96 if chr(i).isascii() and chr(i).isalpha() else 0 for i in range(256))


def pair_counts(text: bytes) -> np.ndarray:
    """How often each letter (0 for none, case ignored) follows each, outside runs that are tested."""
    codes = np.frombuffer(b"\0" + _LONG.sub(b" ", text).translate(_CODES), dtype=np.uint8)
    counts = np.zeros(729, dtype=np.int64)
    for start in range(0, len(codes) - 1, 1 << 20):
        part = codes[start : start + (1 << 20) + 1].astype(np.int64)
        counts += np.bincount(part[:-1] * 27 + part[1:], minlength=729)
    return counts


def learn(docs: DataFrame, text: str = "text") -> list[list[float]]:
    """`letter_logs` of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(729, dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                texts = batch.column(0).slice(start, SLICE).to_pylist()
                counts += pair_counts("\n".join(text or "" for text in texts).encode())
        yield pa.RecordBatch.from_arrays([pa.array(range(729), pa.int64()), pa.array(counts)], names=["place", "n"])

    counted = docs.select(F.col(f"`{text}`").alias("given")).mapInArrow(run, "place long, n long")
    counts = [0] * 729
    for row in counted.groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[row["place"]] = row["n"]
    return letter_logs(counts)


SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    )
)


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets", keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns in `keep`) with an array of (kind, start, end) as a last column."""
    names = docs.columns if keep is None else keep
    logs = learn(docs, text)
    same = [F.col(f"`{name}`").alias(f"kept_{i}") for i, name in enumerate(names)]
    fields = docs.select(*same).schema.add("made", SPANS)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                *kept, texts = batch.slice(start, SLICE).columns
                spans = [
                    [{"kind": kind, "start": a, "end": b} for kind, a, b in scan(text or "", logs)]
                    for text in texts.to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(spans, kind)], names=fields.names)

    made = docs.select(*same, F.col(f"`{text}`").alias("given")).mapInArrow(run, fields)
    return made.toDF(*names, unused_name(names, into))
