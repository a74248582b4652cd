"""The corpus pipeline: documents in, packed sequences out."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import keyfold
from keyfold.llm import language, ngram_join, packing, pii, quality
from keyfold.llm.queries import PII_KEY, WORDS
from keyfold.llm.store import staged

# Workers may start in another folder, so ship the functions they run by value.
cloudpickle.register_pickle_by_value(keyfold)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one language that holds at least half of their words."""
    return language.keep(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule and whose host is not rejected."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of those that near copies connect."""
    return ngram_join.keep_one(docs, ngram_join.Likeness(n=5, part=80, over=100))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced and ``n_chars`` counted anew."""
    return pii.replace(docs, PII_KEY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4,096 tokens."""
    return packing.pack_documents(docs, WORDS, end_id=2, capacity=4096)


STAGES = [
    ("language ID", languages),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("pseudonyms", pseudonyms),
    ("packing", packed),
]

# Learned labels and vocabulary files are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
