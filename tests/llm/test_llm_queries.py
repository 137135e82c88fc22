"""The registered queries on the smallest tables: against their SQL, or against brute force."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import brute_force
import corpus_pipeline
from conftest import rows_of
from tillroll.llm import oracle, quality, queries

TINY = Path("/root/testdata/sf0.001")
SMALL = Path("/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in TINY.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def documents(duck):
    return duck.sql("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def run(spark, name: str, folder: Path = TINY):
    return queries.queries()[name](spark, str(folder))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", list(oracle.oracles()))
def test_query_equals_oracle(spark, duck, name):
    frame = run(spark, name)
    columns = sorted(frame.columns)
    expected = duck.sql(oracle.oracles()[name])
    assert columns == sorted(expected.columns)
    assert rows_of(frame.select(*columns)) == sorted(expected.select(*columns).fetchall(), key=repr)


def test_chat_query_equals_oracle_on_crowded_turns(spark, tmp_path):
    rows = [(c, t, f"s{i % 3}", f"{c} {t} {i}") for c in (1, 2) for t in (0, 1, 70) for i in range(1 if t == 0 else 150 * c)]
    rows += [(3, None, "a" if i % 2 else None, f"{i}") for i in range(100)] + [(3, 5, "b", None)] * 3 + [(None, 1, "unknown", "<|end|>")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    frame = run(spark, "op3_chat_rotation", tmp_path)
    columns = sorted(frame.columns)
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
        expected = connection.sql(oracle.oracles()["op3_chat_rotation"]).select(*columns).fetchall()
    assert rows_of(frame.select(*columns)) == sorted(expected, key=repr)


def test_rules_part_good_from_junk(spark):
    kept = {row.doc_id: row for row in run(spark, "op1_quality_rules", Path("/root/testdata/sf0.1")).collect()}
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.1/labels.parquet'").fetchall()
    rate = {q: np.mean([kept[doc].kept for doc, label in labels if label == q and not kept[doc].base_failed]) for q in (0, 1)}
    assert rate[1] > 0.99 and rate[0] < 0.05


def test_mix(spark, documents):
    sources = {doc: source for doc, _, _, source in documents}
    words = {doc: len(brute_force.WORD.findall(text or "")) for doc, text, _, _ in documents}
    totals, taken = Counter(), Counter()
    for doc, size in words.items():
        totals[sources[doc]] += size
    goals = brute_force.targets(totals)
    rows = run(spark, "op2_source_mix").collect()
    assert len(rows) == len(documents)
    for row in rows:
        assert row["size"] == words[row.doc_id] and row.source_size == totals[sources[row.doc_id]]
        assert row.target == pytest.approx(goals[sources[row.doc_id]])
        assert row.taken <= 3 * row["size"]
        taken[sources[row.doc_id]] += row.taken
    assert all(taken[source] == pytest.approx(goal, rel=0.05) for source, goal in goals.items())


def test_bpe(spark, documents, library):
    expected = []
    for doc, text, *_ in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert rows_of(run(spark, "op4_bpe")) == sorted(expected, key=repr)


def test_secrets(spark, documents):
    found = {row.doc_id: row for row in run(spark, "op5_secrets").collect()}
    assert len(found) == len(documents)
    for doc, text, *_ in documents:
        base = brute_force.base_secrets(text)
        kinds = Counter(kind for kind, _, _ in base)
        joined = [f"{kind}:{start}:{end}" for kind, start, end in base]
        row = found[doc]
        assert (row.n_assign, row.n_access, row.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert row.base_sha256 == sha(",".join(joined))
        assert set(joined) <= set(row.spans.split(",")) | {""}


def test_token_blocks(spark, documents, library):
    start, expected = 0, []
    for doc, text, *_ in documents:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        expected.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows_of(run(spark, "op6_token_blocks")) == sorted(expected, key=repr)


def test_embedding_groups(spark, duck):
    ids, vectors, labels = zip(*duck.sql("SELECT vec_id, embedding, label FROM embeddings ORDER BY vec_id").fetchall(), strict=True)
    links = brute_force.cosine_links(vectors, labels)
    roots = brute_force.components(len(ids), lambda i: np.flatnonzero(links[i]).tolist())
    expected = [(ids[i], int(links[i].sum()), ids[roots[i]], roots[i] == i) for i in range(len(ids))]
    assert rows_of(run(spark, "op7_lattice")) == sorted(expected, key=repr)


def test_embedding_query_on_planted_links(spark, tmp_path):
    """The registered parameters on pairs just above 0.93, pairs just below it, copies, and a hot group of near copies."""
    rng = np.random.default_rng(11)

    def beside(vector, cosine):
        other = rng.normal(size=len(vector))
        other -= vector * (other @ vector) / (vector @ vector)
        return (cosine * vector / np.linalg.norm(vector) + math.sqrt(1 - cosine**2) * other / np.linalg.norm(other)).tolist()

    vectors, labels, planted = [], [], 0
    for i in range(400):
        vector, cosine = rng.normal(size=64), 0.9301 if i % 4 else 0.9299
        vectors += [vector.tolist(), beside(vector, cosine)]
        labels += [i % 3] * 2
        planted += cosine > 0.93
    centre = rng.normal(size=64)
    vectors += [(centre + rng.normal(size=64) * 0.08).tolist() for _ in range(60)] + [centre.tolist()] * 40 + [centre.tolist(), None]
    labels += [1] * 100 + [2, 1]
    rows = [(i, vector, label) for i, (vector, label) in enumerate(zip(vectors, labels, strict=True))]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    links = brute_force.cosine_links(vectors, labels)
    found = {row.vec_id: row for row in run(spark, "op7_lattice", tmp_path).collect()}
    assert len(found) == len(rows) and links[:800].sum() == 2 * planted
    hits = 0
    for i in range(800):
        assert found[i].n_links <= links[i].sum()
        hits += found[i].n_links
    assert hits >= 0.98 * 2 * planted
    # The hot group is whole: each of its vectors meets the others in some cell.
    assert sum(found[i].n_links for i in range(800, len(rows))) >= 0.999 * links[800:].sum()
    assert {found[i].component_id for i in range(800, 900)} == {800}
    assert [found[i].component_id for i in (900, 901)] == [900, 901]


def test_languages(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SMALL}/documents.parquet'").fetchall())
    rows = run(spark, "op8_languages", SMALL).collect()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in rows)
    held = [row for row in rows if row.held_out]
    assert np.mean([row.lang_pred == truth[row.doc_id] for row in held]) > 0.98
    assert all(0 <= row.score <= 1 for row in rows)


def test_simhash_groups(spark, documents):
    prints = [brute_force.fingerprint(text) for _, text, *_ in documents]
    roots = brute_force.near_prints(prints)
    expected = [(doc, f"{prints[i]:016x}", documents[roots[i]][0]) for i, (doc, *_) in enumerate(documents)]
    assert rows_of(run(spark, "op9_simhash")) == sorted(expected, key=repr)


def test_pipeline(spark, documents, library):
    """The pipeline stage by stage: what each keeps of what the stage before it kept."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def stage(name, frame):
        found = stages[name](spark, frame, str(TINY))
        return spark.createDataFrame(found.collect(), found.schema)

    good = stage("quality rules", docs)
    judged = docs.select("doc_id", quality.verdict(docs.text)["kept"].alias("kept")).filter("kept")
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in judged.collect())
    assert good.schema == docs.schema

    cut = stage("line dedup", good)
    ordered = sorted(good.collect(), key=lambda row: row.doc_id)
    texts = brute_force.without_repeats([row.text for row in ordered])
    assert [(row.doc_id, row.text, row.n_chars) for row in sorted(cut.collect(), key=lambda row: row.doc_id)] == [
        (row.doc_id, text, len(text)) for row, text in zip(ordered, texts, strict=True)
    ]
    assert cut.schema == docs.schema

    single = stage("SimHash near-dedup", cut)
    roots = brute_force.near_prints([brute_force.fingerprint(text) for text in texts])
    assert sorted(row.doc_id for row in single.collect()) == sorted({ordered[root].doc_id for root in roots})
    assert single.schema == docs.schema

    mixed = stage("mixing sources to target weights", single)
    times = Counter(row.doc_id for row in mixed.collect())
    assert max(times.values()) <= 3 and mixed.schema == docs.schema
    totals, taken = Counter(), Counter()
    for row in single.collect():
        size = len(brute_force.WORD.findall(row.text))
        totals[row.source] += size
        taken[row.source] += size * times[row.doc_id]
    for source, goal in brute_force.targets(totals).items():
        assert taken[source] == pytest.approx(goal, rel=0.1, abs=100)

    tokens = stage("BPE encoding and decoding", mixed)
    by_id = {row.doc_id: row.text for row in mixed.collect()}
    for row in tokens.collect():
        assert row.n_tokens == len(library.encode(by_id[row.doc_id], add_special_tokens=False).ids)
        assert row.decoded_sha256 == sha(by_id[row.doc_id])
    assert rows_of(corpus_pipeline.run(spark, str(TINY)).select("doc_id", "n_tokens")) == rows_of(tokens.select("doc_id", "n_tokens"))


def test_pipeline_runs_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(TINY))
    assert docs.count() == 0
