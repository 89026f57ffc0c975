"""The corpus pipeline: quality classifier, SimHash near-dedup, source mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet in the shared checkpoint folder and rereads it
as the next stage's documents.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from voxelframe.llm import bpe, mixing, quality_mil, queries, simhash  # noqa: E402
from voxelframe.llm.common import prepare, staged  # noqa: E402
from voxelframe.tables import table  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, does not reject."""
    prepare(spark)
    docs = docs.select(*COLUMNS)
    model = quality_mil.fit(docs, table(spark, sf_dir, "labels"))
    return quality_mil.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs.select(*COLUMNS), shingle=3, max_bits=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the target weights, one row per epoch."""
    prepare(spark)
    return mixing.mix(docs.select(*COLUMNS), queries.mix_path(), queries.MIX_WEIGHTS, queries.MIX_PER_MILLE,
                      queries.MIX_EPOCHS, queries.MIX_SEED)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes they decode to."""
    prepare(spark)
    return bpe.encode_decode(docs, public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]

# a learned classifier has no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
