"""Corpus preparation: stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flight_engine.files import delete
from flight_engine.llm.store import lean_batches, pipeline_stage
from flight_engine.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    from flight_engine.llm.quality_rules import keep_documents
    lean_batches(spark)
    with pipeline_stage(spark):
        return keep_documents(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8)."""
    from flight_engine.llm.ngram_join import one_per_group
    lean_batches(spark)
    with pipeline_stage(spark):
        return one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    from flight_engine.llm.decontaminate import clean_documents
    lean_batches(spark)
    with pipeline_stage(spark):
        return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text."""
    from flight_engine.llm.pii import redact
    lean_batches(spark)
    with pipeline_stage(spark):
        return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the toxic and low-quality ones, at the target weights, with mix_rate and mix_copies."""
    from flight_engine.llm.mixing import CLEAN_TARGETS, mix_documents
    lean_batches(spark)
    with pipeline_stage(spark):
        return mix_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), CLEAN_TARGETS, keep_rest=True)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", pii),
    ("mixing sources to target weights", mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each one's rows are written and reread.

    A stage's rows are deleted when the next one's are written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, step) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        step(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
