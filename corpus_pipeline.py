"""The corpus pipeline: documents through quality rules to token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import bpe, jaccard, lines, mixing, queries, repetition
from claimlens.llm.frames import free_name, remove_folder, work_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return repetition.filter_by_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sources stay in their first document only; ``n_chars`` follows the text."""
    out = lines.remove_boilerplate(docs, queries.SPREAD, free_name(docs, "removed_lines"))
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return jaccard.one_per_class(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the mix takes them."""
    return mixing.repeat_by_mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left."""
    return bpe.encode_documents(docs, queries.vocabulary(), public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("mixing sources", mixing_sources),
    ("byte-level BPE", byte_bpe),
]

# no SQL can state the merges, the joins by similarity and the token ids
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again; a stage's rows go once the next one is written."""
    folder = f"{work_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        if k:
            remove_folder(spark, f"{folder}/{k - 1}")
        docs = spark.read.parquet(out)
    return docs
