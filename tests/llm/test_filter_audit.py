"""The filter audit and its document-term matrix against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from conftest import rows_of
from tillroll.llm import filter_audit, oracle, queries, term_matrix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LONG = " ".join(f"word{i}" for i in range(60_000))
DOC_SCHEMA = "lang string, doc_id long, shard string, n_words string, text string, `a.b` string"


def texts():
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(400)]
    found = [(1, None, "en"), (2, "", None), (3, " \t\n\x0b\x0c\r", ""), (4, LONG, "fr"), (None, LONG, "fr"), (None, None, None), (4, LONG, "fr")]
    for doc in range(10, 70):
        words = rng.choices(pool[: rng.choice([20, 400])], k=rng.choice([5, 150, 199, 200, 201, 400]))
        capital = rng.choice([0, 0, 30])
        text = rng.choice([" ", "\n", "  "]).join(w.upper() if i < capital else w for i, w in enumerate(words)) + rng.choice(["", " #", " é€"])
        found += [(doc, text, rng.choice(["en", "de", None]))] * rng.choice([1, 1, 2])
        if rng.random() < 0.4:
            found.append((doc + rng.choice([-9, 100]), text, "en"))
    return found


LABELS = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60)] + [(11, 1, 1), (11, None, None), (None, 1, 1), (12, None, 1)]


def failed(doc, text, first):
    words = WORD.findall(text)
    hits = {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": doc is not None and first.get(text, doc) < doc,
    }
    return {letter for letter, hit in hits.items() if hit}


def plain_audit(docs, labels):
    """Every document through every order, one filter after the other."""
    first, good, toxic = {}, set(), set()
    for doc, text, _ in docs:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    for doc, quality, bad in labels:
        good |= {doc} if quality == 1 and doc is not None else set()
        toxic |= {doc} if bad == 1 and doc is not None else set()
    judged = [(lang or "", doc in good, doc in toxic, failed(doc, text or "", first)) for doc, text, lang in docs]
    rows, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for part in {lang for lang, *_ in judged}:
            left = [one for one in judged if one[0] == part]
            everyone = list(left)
            for step, letter in enumerate(order, 1):
                gone = [one for one in left if letter in one[3]]
                before = len(everyone) - len(left)
                left = [one for one in left if letter not in one[3]]
                redundant = sum(letter in one[3] for one in everyone) - len(gone)
                assert redundant <= before
                unique = sum(one[3] == {letter} for one in everyone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), redundant, unique, sum(one[1] for one in gone), sum(one[2] for one in gone),
                ]
                shapley[part, letter] += len(gone)
    return sorted(((*key, *counts, shapley[key[0], key[1][key[2] - 1]]) for key, counts in rows.items()), key=repr)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("audit")
    rows = [(lang, doc, "x", "y", text, "z") for doc, text, lang in texts()]
    spark.createDataFrame(rows, DOC_SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_audit_equals_brute_force_and_its_oracle(spark, folder):
    frame = queries.queries()["op13_filter_audit"](spark, str(folder))
    found = rows_of(frame.select(*COLUMNS))
    assert found == plain_audit(texts(), LABELS)
    with duckdb.connect() as connection:
        for name in ("documents", "labels"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
        assert found == sorted(connection.sql(oracle.oracles()["op13_filter_audit"]).select(*COLUMNS).fetchall(), key=repr)


@pytest.mark.parametrize("limit", [("SHARD_DOCS", 5), ("SHARD_BYTES", 2000), ("SLICE", 3)])
def test_matrix_holds_every_word_of_every_row(spark, folder, monkeypatch, limit):
    monkeypatch.setattr(term_matrix, *limit)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    shards, dictionary = term_matrix.build(spark, docs)
    words = {row.term: bytes(row.word) for row in dictionary.collect()}
    every = sorted({word.encode() for _, text, _ in texts() for word in WORD.findall(text or "")})
    assert sorted(words.values()) == every and min(words) >= 0
    rebuilt, given = [], []
    for shard in shards.collect():
        starts, terms, counts = map(term_matrix.unpacked, (shard.starts, shard.terms, shard.counts))
        assert len(starts) == len(shard.docs) + 1 and starts[-1] == len(terms) == len(counts)
        for i, doc in enumerate(shard.docs):
            span = slice(starts[i], starts[i + 1])
            entries = {words[term]: int(n) for term, n in zip(terms[span], counts[span], strict=True)}
            rebuilt.append((doc["doc_id"], doc["shard"], doc["a.b"], sorted(entries.items())))
    for doc, text, _ in texts():
        given.append((doc, "x", "z", sorted(Counter(word.encode() for word in WORD.findall(text or "")).items())))
    assert sorted(rebuilt, key=repr) == sorted(given, key=repr)
    totals = rows_of(term_matrix.row_totals(shards).select("doc.doc_id", "n_words", "n_terms"))
    assert totals == sorted(((doc, len(w := WORD.findall(text or "")), len(set(w))) for doc, text, _ in texts()), key=repr)


def test_a_bucket_is_numbered_with_one_row_per_task():
    held = [(7, 0, b"b"), (2, 5, b"a"), (7, 3, b"a"), (7, 1, b"\xff"), (2, 2, b"c"), (7, 2, b"")]
    tasks, slots, words = map(list, zip(*held, strict=True))
    columns = {"task": pa.array(tasks, pa.int32()), "slot": pa.array(slots, pa.int32()), "word": pa.array(words, pa.binary())}
    bucket = pa.table(columns | {"bucket": pa.array([3] * len(held), pa.int32())})
    terms = {row["word"]: row["term"] for row in term_matrix._speller(10)(bucket).to_pylist()}
    assert terms == {b"": 3, b"a": 13, b"b": 23, b"c": 33, b"\xff": 43}
    rows = term_matrix._numberer(10)(bucket).to_pylist()
    assert [row["task"] for row in rows] == [2, 7]
    for row in rows:
        found = dict(zip(np.frombuffer(row["slots"], np.int32).tolist(), np.frombuffer(row["terms"], np.int64).tolist(), strict=True))
        assert found == {slot: terms[word] for task, slot, word in held if task == row["task"]}
    numbers = term_matrix._scattered(pa.table({"task": [7, 7], "slots": [np.array([1, 2], np.int32).tobytes(), np.array([0], np.int32).tobytes()], "terms": [np.array([5, 6]).tobytes(), np.array([4]).tobytes()]}))
    assert np.frombuffer(numbers["numbers"][0].as_py(), np.int64).tolist() == [4, 5, 6]


@given(st.lists(st.integers(-(2**62), 2**62)))
def test_packed_numbers_come_back(numbers):
    assert term_matrix.unpacked(term_matrix.packed(np.array(numbers, np.int64))).tolist() == numbers


def test_empty_tables(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    assert filter_audit.audit(spark, docs.limit(0), labels).count() == 0
    found = filter_audit.audit(spark, docs, labels.limit(0))
    assert rows_of(found.select(*COLUMNS)) == plain_audit(texts(), [])
