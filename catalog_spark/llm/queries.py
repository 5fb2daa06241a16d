"""The queries opN_<name> over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, langid, mixing, negatives, neighbours, pieces, pii, repeats, secrets, simhash, urls, warc, weighted
from .tables import materialise, read, small_batches


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pii.digest(read(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return urls.digest(read(spark, sf_dir, "pages"))


def op3_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return weighted.digest(read(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return langid.digest(read(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secrets.digest(read(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.digest(read(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return repeats.digest(read(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = materialise(read(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))  # words are counted once
    return mixing.mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pieces.digest(read(spark, sf_dir, "documents"), pieces.model_bytes(pieces.default_model()))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return warc.digest(read(spark, sf_dir, "pages"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return conversations.digest(read(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return negatives.digest(read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_url_filters": op2_url_filters,
    "op3_weighted_fingerprints": op3_weighted_fingerprints,
    "op4_language_id": op4_language_id,
    "op5_secrets": op5_secrets,
    "op6_simhash": op6_simhash,
    "op7_repeats": op7_repeats,
    "op8_mixing": op8_mixing,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_warc": op11_warc,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": urls.SQL,
    "op8_mixing": mixing.SQL,
    "op11_warc": warc.SQL,
    "op12_conversation_repair": conversations.SQL,
    "op13_hard_negatives": negatives.SQL,
}
