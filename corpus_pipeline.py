"""From raw documents to training tokens: quality rules, toxicity, near duplicates, benchmark leaks, token ids.

Every stage but the last returns the columns of its documents, whatever they are called. Null and empty texts fail the
quality rules; an empty table stays empty; of repeated rows one stays, and rows with a null key are never duplicates or
leaks. Long texts are worked on whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seatplan.llm import bpe, common, decontaminate, jaccard, perplexity, queries, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A score from which a document counts as toxic.
TOXIC = 0.7


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside their language's perplexity band."""
    return perplexity.passing(docs)


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below ``TOXIC``; the labels teach through the documents that are still there."""
    weights, settings = toxicity.fit(docs, queries.table(spark, sf_dir, "labels"), common.fold("doc_id", 3) != 1)
    return toxicity.below(docs, weights, settings, TOXIC)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id."""
    return jaccard.one_of_each(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, asked with whatever numbers and names."""
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, with digests of the ids and of what they decode to."""
    return bpe.digests(bpe.encode(docs, queries.tokenizer()))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("toxicity", non_toxic),
    ("near_duplicates", distinct_documents),
    ("decontamination", without_leaks),
    ("encoding", encoded),
]

#: The stages fit models; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
