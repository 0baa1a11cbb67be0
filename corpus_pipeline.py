"""From raw documents to a tokenised mix, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its
result is written as Parquet and read again as the next stage's documents. All but the
last return the columns of documents.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from lodestone.llm import bpe, common, langid, lines, mixing, queries, simhash  # noqa: E402
from lodestone.session import Workspace  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go: no letters, or a calibrated score below its level."""
    model = langid.trained(docs.where(~queries.held_out()))
    return langid.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose 5-word shingles are 0.8 alike the one with the smallest id stays."""
    return simhash.without_copies(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from all but their first document."""
    return lines.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeated(mixing.mixed(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix, and digests of the ids and of what they decode to."""
    return bpe.tokenized(docs, queries.RANKS, queries.PATTERN, ("n_tokens", "ids", "ids_sha256", "decoded_sha256"), ("doc_id", "lang", "source"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("source_mix", mix_sources),
    ("byte_bpe", tokenize),
]

# The stages' models, hashes and merges are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = ws.table(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
