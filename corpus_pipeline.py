"""Corpus pipeline: quality rules, exact dedup, near-duplicate dedup, substring dedup, packing.

Every stage is written as Parquet in the shared checkpoint folder and reread as the next one's input, so
a lost executor costs at most the running stage's tasks.  All but the last return the columns of documents.

Defined cases: null and empty texts have no words, so the quality rules reject them; of equal rows, and of rows with
equal texts or near-equal ones, one stays (no id counts as the largest); rows of a repeated id are judged one by one;
an empty table gives no pieces; other columns go through all stages but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from designlab.llm import digest_index, jaccard, packing, quality, stored, substring
from designlab.session import checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.filter_quality(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return digest_index.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.dedup(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one holds."""
    return substring.remove(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_stage), ("exact_dedup", exact_stage), ("jaccard_join", near_stage),
          ("substring_dedup", substring_stage), ("packing", packing_stage)]

# a packing has many right forms; tests compare the pipeline with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, run_id: str | None = None) -> DataFrame:
    """All stages over ``documents``; the last one's rows.

    A run that is called again with its ``run_id`` reads the stages that it had finished.  What a stage wrote for
    itself goes when its output is written, and its input with it, unless that is ``documents``.
    """
    base = f"{checkpoint_dir(spark)}/pipeline_{run_id or uuid.uuid4().hex}"
    paths = [f"{base}/{i}_{name}" for i, (name, _) in enumerate(STAGES)]
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    done = [i for i, path in enumerate(paths) if stored.has_folder(spark, f"{path}/_SUCCESS")]
    if done:
        docs = spark.read.parquet(paths[done[-1]])
    for i in range(done[-1] + 1 if done else 0, len(STAGES)):
        with stored.steps_removed():
            out = STAGES[i][1](spark, docs, sf_dir)
            out.write.mode("overwrite").parquet(paths[i])
        docs = spark.read.schema(out.schema).parquet(paths[i])
        if i:
            stored.remove_folder(spark, paths[i - 1])
    return docs
