"""A training corpus from raw documents: good ones, one of each group of near copies, without benchmark
passages and personal data, as token ids. Each stage reads what the one before it has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontaminate, jaccard, lines, pieces, surrogates
from pulsegrid.llm.registry import SURROGATE_KEY, VOCABULARY
from pulsegrid.llm.tables import saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model scores 0.7 or more; it learns from the labelled rows outside the held-out
    quarter."""
    model = lines.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return lines.keep_good(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by a similarity of 0.8 or more over
    five-word shingles. Rows without an id stay."""
    groups = jaccard.jaccard_groups(docs, n=5, percent=80)
    others = groups.where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; ``n_chars`` follows the text."""
    return surrogates.with_surrogates(docs, SURROGATE_KEY).withColumn("n_chars", F.length("text").cast("long")).select(
        docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``n_ids`` of every document."""
    return pieces.encoded(docs, pieces.load(VOCABULARY))


STAGES = [("quality", quality), ("near_copies", near_copies), ("benchmark_free", benchmark_free),
          ("without_pii", without_pii), ("token_ids", token_ids)]

#: the fitted model of the first stage cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
