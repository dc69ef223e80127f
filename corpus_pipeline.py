"""Corpus pipeline: documents through five of the text operators.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and gives a DataFrame; ``run`` writes each as Parquet under the shared
checkpoint folder and reads it back for the next, so that a lost executor costs
a stage's tasks and never an earlier stage.  All but the last return the columns
of ``documents``.

* ``toxicity``: the ordinal model fitted on ``labels`` rejects toxic documents.
* ``simhash_near_dedup``: 3-word shingles, 3 bits; one document of each group
  stays, the one of the smallest id.
* ``decontaminate``: documents that an item of ``benchmark`` leaked into go.
* ``pii``: personal data is replaced by its kind; every document stays and
  ``n_chars`` follows the text.
* ``packing``: what is left is packed into sequences of 2048 tokens, a row per
  piece.

Rows without id, empty and null texts pass every filter like any clean
document; an empty table stays empty.  SQL cannot express fitted models or
byte-pair encoding: there is no ``ORACLE_SQL``, and ``tests/llm`` holds ``run``
against the stages' brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylens.llm import decontaminate, packing, pii, simhash, toxicity
from citylens.llm.common import keep, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return toxicity.reject_toxic(docs, toxicity.train(docs, toxicity.grades_from_labels(docs, labels)))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_two_fit(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontaminate_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over ``documents``: the packed pieces of what the stages kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
