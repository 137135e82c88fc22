"""Language ID by multilingual mixture inference.

A language is a distribution over hashed byte trigrams of lower-cased letters, learned by
counting. Each document is taken as a mixture of languages: expectation-maximisation estimates
their proportions from the trigrams' likelihoods, and the languages are those of the nested
sets (by falling proportion) with the best penalised likelihood. Overlapping trigrams tell each
letter about three times, so their log-likelihood counts a third.

Scale: learning is one pass that counts per task and language before it shuffles, so each task
sends at most BUCKETS rows per language; an executor packs each language's into one array,
so that the driver holds no more than the model; prediction is a projection. The model holds BUCKETS
counts per learned language; more than LANGUAGES learned languages are an error before anything is
counted, which bounds what a worker holds (512 KB per language of its rows) and what is sent to the
executors (256 languages: 64 MB).

Defined cases: rows with a NULL language or text teach nothing. A NULL text, or one without a
letter, is `und` with score 0, and so is every text if nothing was learned. Equal proportions
go to the language that sorts first. Rows are independent; all columns stay. `gap` is the greatest
move of a proportion in the last step: above SETTLED, the steps ended before the mixture settled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.bpe import SLICE
from tillroll.llm.common import ship, unused_name

ship(__name__)

BUCKETS = 1 << 16
LANGUAGES = 256
SMOOTHING = 0.1
STEPS = 20
SETTLED = 1e-3
OVERLAP = 3.0
UNKNOWN = "und"
CHUNK = 1 << 20

# ASCII that isn't a letter parts words; other bytes stay as they are.
_SPACED = bytes(
    byte if byte >= 128 or chr(byte).isalpha() else 32 for byte in range(256)
)


def _trigrams(text: str) -> Iterator[np.ndarray]:
    """Hashed trigrams, in chunks of bounded size."""
    for start in range(0, len(text), CHUNK):
        words = text[start : start + CHUNK].lower().encode("utf-8", "replace").translate(_SPACED).split()
        letters = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint32)
        codes = (letters[:-2] << np.uint32(16)) | (letters[1:-1] << np.uint32(8)) | letters[2:]
        yield (codes * np.uint32(2654435761)) >> np.uint32(16)


def _counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams that a text holds, and how often."""
    parts = list(_trigrams(text))
    if sum(map(len, parts)) < BUCKETS // 8:
        return np.unique(np.concatenate([np.empty(0, np.uint32), *parts]), return_counts=True)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for part in parts:
        counts += np.bincount(part, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _count_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            for lang, text in zip(*(column.to_pylist() for column in part.columns), strict=True):
                own = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for trigrams in _trigrams(text):
                    np.add.at(own, trigrams, 1)
    for lang, own in counts.items():
        found = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found)), pa.array(found), pa.array(own[found])], names=["lang", "bucket", "n"]
        )


def _packed(counts: pa.Table) -> pa.Table:
    """One row for one language: the log-probabilities of all trigrams as bytes."""
    own = np.full(BUCKETS, SMOOTHING)
    own[counts["bucket"].to_numpy()] += counts["n"].to_numpy()
    logs = np.log(own / own.sum()).astype(np.float32)
    return pa.table({"lang": counts["lang"].slice(0, 1), "logs": pa.array([logs.tobytes()], pa.binary())})


def learn(docs: DataFrame, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """The learned languages in order, and the log-probability of each trigram in each."""
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")).dropna()
    if rows.select("lang").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    counts = (
        rows.mapInArrow(_count_languages, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    packed = counts.groupBy("lang").applyInArrow(_packed, "lang string, logs binary")
    found = sorted(packed.collect(), key=lambda row: row["lang"])
    model = np.empty((len(found), BUCKETS), dtype=np.float32)
    for i, row in enumerate(found):
        model[i] = np.frombuffer(row["logs"], dtype=np.float32)
    return [row["lang"] for row in found], model


def _mixture(chances: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Proportions that expectation-maximisation settles on, the log-likelihood there, and the last move."""
    total = counts.sum()
    for _ in range(STEPS):
        mixed = shares @ chances
        fresh = shares * (chances @ (counts / mixed)) / total
        moved = np.abs(fresh - shares).max()
        shares = fresh
        if moved < SETTLED:
            break
    return shares, float(counts @ np.log(shares @ chances)), float(moved)


def infer(logs: np.ndarray, found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(languages, proportions, gap) of a text, the largest proportion first."""
    own = logs[:, found].astype(np.float64)
    # Likelihoods relative to the best language per trigram can't all vanish.
    top = own.max(axis=0)
    chances = np.exp(own - top)
    counts = counts.astype(np.float64)
    k = len(logs)
    shares, _, gap = _mixture(chances, counts, np.full(k, 1 / k))
    order = np.argsort(-shares, kind="stable")
    penalty = np.log(counts.sum() + 1) / 2
    single = int(order[0])
    best = (np.array([single]), np.ones(1), gap)
    score = float(counts @ np.log(np.maximum(chances[single], 1e-300))) / OVERLAP - penalty
    for size in range(2, int((shares > SETTLED).sum()) + 1):
        chosen = order[:size]
        part, likelihood, moved = _mixture(chances[chosen], counts, shares[chosen] / shares[chosen].sum())
        penalised = likelihood / OVERLAP - size * penalty
        if penalised <= score:
            break
        ranked = np.argsort(-part, kind="stable")
        best, score = (chosen[ranked], part[ranked], max(gap, moved)), penalised
    return best


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(
    docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """`docs` (or its columns in `keep`) with `lang_pred`, `score`, the array `languages` and `gap`.

    The score is the predicted language's proportion of the text; `languages` lists all found.
    """
    names, logs = model
    columns = docs.columns if keep is None else keep
    same = [F.col(f"`{name}`").alias(f"kept_{i}") for i, name in enumerate(columns)]
    fields = docs.select(*same).schema.add("first", "string").add("score", "double").add("all", T.ArrayType(T.StringType())).add("gap", "double")

    def one(text: str | None) -> tuple[str, float, list[str], float]:
        if not names or not text or not _has_letter(text):
            return UNKNOWN, 0.0, [], 0.0
        chosen, shares, gap = infer(logs, *_counted(text))
        return names[chosen[0]], min(1.0, float(shares[0])), [names[i] for i in chosen], gap

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                *kept, texts = batch.slice(start, SLICE).columns
                first, score, every, gap = zip(*(one(text) for text in texts.to_pylist()), strict=True)
                made = [pa.array(first), pa.array(score, pa.float64()), pa.array(every, pa.list_(pa.string())), pa.array(gap, pa.float64())]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=fields.names)

    made = docs.select(*same, F.col(f"`{text}`").alias("given")).mapInArrow(run, fields)
    return made.toDF(*columns, *(unused_name(columns, wish) for wish in ("lang_pred", "score", "languages", "gap")))
