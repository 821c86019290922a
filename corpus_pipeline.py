"""A training corpus from documents, in stages that are each written and read again.

Toxic texts go, then texts without a recognisable language, then all but the first
of each group of near copies. What is left is mixed to the sources' target weights
(a document appears as often as the mix takes it) and packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import kept, remainder
from podium.llm.language import fit_language_model, keep_identified
from podium.llm.mixing import mixed_documents
from podium.llm.ngram_join import drop_near_copies
from podium.llm.packing import pack_documents
from podium.llm.toxicity import drop_toxic, fit_toxicity

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels.filter(remainder(F.col("doc_id"), 5) != 0))
    return drop_toxic(docs, model, 0.5)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which one of the languages stands out.

    Few texts have none: those without a letter, or with no more of one language
    than of another. Mixed texts stay.
    """
    model = fit_language_model(docs.filter(remainder(F.col("doc_id"), 4) != 2))
    return keep_identified(docs, model, 0.35)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more."""
    return drop_near_copies(docs, width=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as its source's budget reaches it."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 1024 tokens."""
    return pack_documents(docs, TOKENIZER, 1024)


STAGES = [
    ("toxicity", toxicity),
    ("language_id", language),
    ("ngram_jaccard_join", ngram_join),
    ("source_mixing", mixing),
    ("best_fit_packing", packing),
]

#: SQL has neither the networks nor the tokenizer; a test runs each stage by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *early, (_, last) = STAGES
    for name, stage in early:
        docs = kept(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
