"""The operators as queries over their whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.llm import (
    chat,
    classifier,
    jaccard,
    linededup,
    mixing,
    nearest,
    periods,
    pieces,
    quality,
    tokens,
    topk,
    warc,
    whitening,
)
from fleetmart.llm.common import stored, table
from fleetmart.llm.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]

BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), n=5, threshold=0.8)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Words are counted once; a hash stands for the text.
    sized = stored(
        docs.select(
            "doc_id", "source", mixing.word_tokens().alias("n_tokens"), F.xxhash64("text").alias("text")
        ),
        "sized",
    )
    mixed = mixing.mix(sized, repetitions=2.0, tokens=F.col("n_tokens"))
    return mixed.select(
        "doc_id",
        "source",
        "n_tokens",
        F.col("_epoch").alias("epoch"),
        F.col("_block").alias("block"),
        F.col("_block_order").alias("block_order"),
        F.col("_doc_order").alias("doc_order"),
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality.quality_rules(
        table(spark, sf_dir, "documents"), labels.where("quality = 1").select("doc_id")
    )


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = "</s>[INST] ok [/INST]"
    one = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(told).alias("text"),
    )
    return chat.digest(chat.format_conversations(one.unionByName(more)))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"), repeats=True)


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE), limit=512)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    archives = warc.write_archives(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc.read_archives(archives, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth id by hash gets a text that repeats itself from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    found = F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    marked = docs.select(
        "doc_id", "text", F.when(h % 10 == 0, found).alias("w"), F.expr("crc32(cast(doc_id as string)) div 10").alias("g")
    )
    placed = marked.withColumn("n", F.size("w")).withColumn("a", F.expr("if(n > 0, g % n, 0L)"))
    period = F.expr("1 + (n - a) div (3 + g % 8)")
    repeated = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[a + (i - a) % p])), ' ')")
    return placed.withColumn("p", period).select(
        "doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text")
    )


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = planted_periods(table(spark, sf_dir, "documents"))
    found = periods.periodic_runs(texts, min_length=6, exponent=4)
    # Runs come by start, then period: of equal exponents the first stays.
    best = F.expr(
        "reduce(_runs, _runs[0], (b, r) -> if(r.length * b.period > b.length * r.period, r, b))"
    )
    lines = F.expr(
        "array_join(transform(_runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    )
    return found.select(
        "doc_id",
        F.size("_runs").cast("long").alias("n_runs"),
        F.when(F.size("_runs") > 0, best).alias("best"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("_collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        F.col("best.start"),
        F.col("best.length"),
        F.col("best.period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), scale=256, components=4)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_topk,
        op2_jaccard,
        op3_mixing,
        op4_sentencepiece,
        op5_quality,
        op6_chat,
        op7_lines,
        op8_tokens,
        op9_warc,
        op10_classifier,
        op11_periods,
        op12_nearest,
        op13_whitening,
    )
}

__all__ = ["ORACLE", "QUERIES"]
