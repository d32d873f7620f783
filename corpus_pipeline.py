"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing, packing.

Each stage works on all rows that its predecessor kept and is written as
Parquet before the next one reads it, so a lost executor repeats at most one
stage. All stages but the last return the columns of ``documents``:

1. quality  -- drops texts that fail the base rules or are outliers of their
   language and source;
2. exact    -- of equal texts the row with the largest doc_id stays;
3. near     -- of each class of near copies the row with the least doc_id stays;
4. mix      -- sources weighted 1, 2, 3, ...: a row for each reading of a
   document, up to three, the last one of a source cut at its target;
5. pack     -- pieces of sequences of 2048 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kiln.llm import exact, mix, neardup, pack, quality
from kiln.llm.common import prepare, work_dir, written
from kiln.llm.registry import query
from kiln.sources.tables import load


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.good_documents(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return neardup.near_dedup(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mix.mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack.pieces(pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), "space", 2048))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mix_stage),
    ("packing", pack_stage),
]

#: Signatures, robust estimates and tokenisation have no SQL form; the stages
#: are tested against brute-force versions (tests/llm).
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), work_dir(spark, name.replace(" ", "-")))
    return docs
