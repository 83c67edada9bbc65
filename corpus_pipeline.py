"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows its predecessor kept and returns the columns of ``documents``; the last returns packed pieces. Stages
are written as Parquet in the shared folder and read again, so each starts from files, not from lineage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from tidemark.llm.common import documents, free_names, labels, staged
from tidemark.llm.queries import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labels outside the held-out fifth."""
    ship(spark)
    (score,) = free_names(docs, "tox_score")
    return toxicity.scored(docs, toxicity.fit(docs, labels(spark, sf_dir)), score).filter(F.col(score) < 0.5).drop(score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest ``doc_id`` stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest ``doc_id`` stays."""
    ship(spark)
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weights of the sources say."""
    return mixing.emit_copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows filled with lexical neighbours."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Models and hashing make the result inexpressible in SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
