"""The corpus pipeline: stages over `documents`, each written and read again before the next.

Every stage works on all rows the one before kept and returns the columns of `documents`; the last adds how often the
mix takes a document. Rows without an id or a text pass through the filters, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import decontaminate, jaccard_join, line_templates, mixing, quality
from cardwatch.llm.work import staged

LEAST_SCORE = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; without a text there is nothing to reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, usable=~quality.held_out())
    good = (F.col("_score") >= LEAST_SCORE) | F.col("text").isNull()
    return quality.scored(docs, model, score="_score").where(good).select(*docs.columns)


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of templates that recur; n_chars follows the text."""
    return line_templates.drop_recurring(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity from 0.8."""
    return jaccard_join.keep_one(docs, size=5, share=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often (repeats) and how many words in all (taken)."""
    return mixing.mix(docs, mixing.n_words("text")).where("repeats > 0")


STAGES = [("quality", good_quality), ("lines", without_recurring_lines), ("near-copies", one_of_each),
          ("benchmark", without_benchmark), ("mixing", mixed)]

#: The first stage trains a classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
