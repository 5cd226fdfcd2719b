"""From raw documents to packed training sequences.

Each stage reads what the one before wrote, decides row by row or group by group, and returns the
columns of documents; the last one returns where every piece of token ids goes. Stages are written as
Parquet in the shared scratch folder, so a lost executor or a failed stage repeats one stage only.

Rows with null texts or empty texts go through every stage: the classifier judges them as empty, no
near duplicate or benchmark passage is found in them, and each becomes an end id. Further columns of
documents are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestar.llm.common import documents, labels, scope, staged
from lakestar.llm.decontaminate import drop_contaminated
from lakestar.llm.jaccard_join import keep_one_of_each
from lakestar.llm.packing import pack
from lakestar.llm.quality import keep_good, train_quality
from lakestar.llm.queries import BYTE_BPE
from lakestar.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the co-trained classifier rejects go; it learns from ``docs`` and their labels."""
    return keep_good(docs, train_quality(docs, labels(spark, sf_dir)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least doc_id."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with a mark in place of each secret. ``n_chars`` keeps its value."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 1024 ids."""
    return pack(docs, BYTE_BPE)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

# A trained classifier and a tokenizer have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage. What a stage leaves behind goes when the next one is written."""
    docs, before = documents(spark, sf_dir), None
    for number, (_, stage) in enumerate(STAGES):
        with scope(spark) as paths:
            docs = staged(stage(spark, docs, sf_dir), f"stage-{number}")
            kept = paths.pop()  # the result itself, staged last
            paths.extend([before] if before else [])
            before = kept
    return docs
