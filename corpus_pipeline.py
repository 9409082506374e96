"""A corpus from raw documents to token ids, in five stages.

Each stage reads what the stage before it wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetmart.llm import classifier, jaccard, linededup, mixing, pieces
from fleetmart.llm.common import table
from fleetmart.operators.scale import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good; the others go."""
    return classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier line of the corpus."""
    return linededup.dedup_lines(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: word 5-grams, similarity 0.8 or more."""
    return jaccard.keep_one(docs, n=5, threshold=0.8, repeats=True)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time a document is read: small sources up to twice, all at least once.

    Rows are written in the order of the block permutations.
    """
    return mixing.mix(docs, repetitions=2.0, places=False, ordered=True)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids; few words are remembered, since earlier stages leave executors large heaps."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_documents(docs, model, remember=200_000)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("line dedup", distinct_lines),
    ("n-gram Jaccard join", distinct_documents),
    ("mixing sources to target weights", mixed_sources),
    ("SentencePiece encoding and decoding", token_ids),
]

# A learned classifier and hashed orders: SQL can't express the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
