"""From raw documents to packed training sequences: five stages, and all of them in a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import curriculum, exact_dedup, minhash, packing, toxicity
from sluice.llm.common import Stage, table


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 1/2, by a model learned from the labelled ones among ``docs``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic")
    return toxicity.predict(docs, model, carry=("*",)).filter("score < 0.5").select("doc.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return minhash.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    plan = curriculum.plan_mix(docs, curriculum.word_count())
    return curriculum.in_training_order(plan).select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces with their token ids; a repeated document is packed as often."""
    return packing.pack(docs).select(
        "doc.doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "bucket"
    )


STAGES = [
    ("toxicity", not_toxic),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("mixing", mixing),
    ("packing", packed),
]

#: The first stage learns a classifier, which SQL cannot state; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input.

    A stage's input is removed once its output is written; the last one's stays for the lazy result.
    """
    docs, written = table(spark, sf_dir, "documents"), Stage(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = written.write(stage(spark, docs, sf_dir))
        written.clear(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
