"""The queries of this subpackage: thin, over whole tables, with the columns of their contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    bpe,
    chat,
    filter_audit,
    language,
    lattice,
    license_scan,
    line_dedup,
    mixing,
    prefix_trie,
    quality,
    secrets,
    simhash,
    token_file,
)
from tillroll.llm.common import documents, staged
from tillroll.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = documents(spark, sf_dir).select(
        "doc_id", quality.verdict(F.col("text")).alias("verdict")
    )
    counts = F.col("verdict.counts")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
    return judged.select(
        "doc_id",
        *(counts[name].alias(name) for name in names),
        failed.alias("base_failed"),
        (~failed & F.col("verdict.kept")).alias("kept"),
        *(counts[name].alias(name) for name in ("n_stop_words", "n_wordless", "n_lines", "n_ellipsis_lines")),
    )


def line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.without_repeats(docs).select("doc_id", "n_removed", "text")


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(spark, mixing.measured(documents(spark, sf_dir)), "sizes")
    solved, changes = mixing.copies(spark, rows)
    return mixing.with_copies(rows, solved, changes).select(
        F.col("document.id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def token_digests(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Digests of each text's ids and of the text that they decode to."""
    return bpe.round_trip(docs, TOKENIZER, keep=keep).select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(documents(spark, sf_dir), ["doc_id"])


def token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_file.write(documents(spark, sf_dir), path, TOKENIZER)
    return token_file.documents_in(spark, path)


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("secrets")
    base = F.filter(spans, lambda span: span["kind"] != "random")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])), ",")

    def number(kind: str):
        return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")

    return secrets.find_secrets(documents(spark, sf_dir), keep=["doc_id"]).select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        number("random").alias("n_random"),
    )


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    number = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    held_out = F.coalesce(number == 2, F.lit(False))
    model = language.learn(docs.filter(~held_out))
    found = language.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model, keep=["doc_id", "held_out"])
    return found.withColumn("languages", F.array_join("languages", ","))


def chat_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    masks = F.transform("masks", lambda mask: F.concat_ws(":", mask["start"], mask["end"]))
    return chat.rotate(rows).withColumn("masks", F.array_join(masks, ","))


def embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, documents(spark, sf_dir), shingle=3, max_bits=3)
    fingerprint = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


def license_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.find_licenses(documents(spark, sf_dir), keep=["doc_id"])
    base = F.filter("detections", lambda one: one["tier"] == license_scan.BASE)
    starts = F.transform(base, lambda one: one["start"])

    def labels(detections):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda one: one["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels("detections").alias("labels"),
        "score",
        F.size("detections").cast("long").alias("n_detections"),
    )


def prefix_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    said, sizes = prefix_trie.turns(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    lender = F.col("conv") - F.col("conv") % 5
    return prefix_trie.trie(spark, prefix_trie.with_borrowed_heads(said, sizes, head, lender, longest=8))


def audited_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": quality_rules,
        "op2_source_mix": source_mix,
        "op3_chat_rotation": chat_views,
        "op7_lattice": embedding_groups,
        "op4_bpe": bpe_round_trip,
        "op5_secrets": secret_spans,
        "op8_languages": languages,
        "op6_token_blocks": token_blocks,
        "op9_simhash": simhash_groups,
        "op10_line_dedup": line_windows,
        "op11_license_scan": license_labels,
        "op12_prefix_trie": prefix_nodes,
        "op13_filter_audit": audited_filters,
    }
