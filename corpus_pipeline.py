"""A training corpus from `documents`: rules, line dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but
the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import line_dedup, mixing, quality, simhash
from tillroll.llm.common import documents, staged
from tillroll.llm.queries import token_digests


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of three-line windows that came up before."""
    cut = line_dedup.without_repeats(docs)
    return cut.select(*docs.columns).withColumn("n_chars", F.length("text").cast("long"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(spark, docs, shingle=3, max_bits=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(spark, docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of the text they decode to."""
    return token_digests(docs, ["doc_id", "source"])


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", token_stage),
]

# Fingerprints, dual solutions and tokens are beyond SQL: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
