"""A training corpus from documents: classify, deduplicate, mix, pack.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; each result is written as Parquet and read again as the next one's docs.

Defined cases: a null text counts as empty; texts without words are copies of
nothing, and no mix takes them; a null doc_id is a document like others, last
among copies; one id on several texts is several documents; of repeated rows
one stays; a null source is a source of its own; other columns stay as they
are up to the last stage; empty tables give no sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siftline.llm import mixing, near_duplicates, packing, quality, work


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ratings = quality.rate(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rated = quality.classify(docs, quality.train(docs, ratings))
    return rated.filter("keep").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_duplicates.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_classifier", classify), ("ngram_jaccard_join", deduplicate), ("mixing", mix), ("packing", pack)]

#: The classifier and the tokenizer are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = work.folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = work.stored(stage(spark, docs, sf_dir), f"{path}/{k}-{name}")
    return docs
