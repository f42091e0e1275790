"""Corpus pipeline: from raw documents to packed sequences.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns a frame that is written and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from courierlens.llm.blocks import scratch_table
from courierlens.llm.langid import learn_languages, predict_languages
from courierlens.llm.mixing import mixed_rows
from courierlens.llm.packing import pack_documents
from courierlens.llm.queries import MIX, table, vocabulary_file
from courierlens.llm.setjoin import first_of_each
from courierlens.llm.toxicity import learn_toxicity, score_toxicity

# a text is of no known language if no language reaches this mean probability over its bytes
LEAST_LANGUAGE_SCORE = 0.3
# each document at most once, so that a sequence never holds a text twice
PIPELINE_MIX = replace(MIX, epochs=1)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters and a language the network is sure enough of."""
    return predict_languages(docs, learn_languages(docs), keep_from=LEAST_LANGUAGE_SCORE)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return score_toxicity(docs, learn_toxicity(docs, table(spark, sf_dir, "labels")), keep=True)


def shingle_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near duplicates."""
    return first_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fill each source's quota of the token budget."""
    return mixed_rows(docs, PIPELINE_MIX)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return pack_documents(docs, vocabulary_file())


STAGES = [
    ("language ID", language_id),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", shingle_join),
    ("mixing", mixing),
    ("packing", packing),
]

# learned models decide the first two stages, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
