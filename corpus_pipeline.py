"""From raw documents to token ids: STAGES are applied in order, each to all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``, and
other columns than doc_id, text, lang, source and n_chars pass through unread. A null text is an empty one, so the
first stage rejects it. Repeated rows are near-duplicates of each other. Empty tables pass through. Each text crosses
to Python once a stage, in batches whose size the stages set on the session (``tables.small_batches``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_spark.llm import langid, mixing, pieces, pii, simhash
from catalog_spark.llm.tables import forget, materialise, small_batches


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier rejects go; ``lang`` itself stays as it was."""
    small_batches(spark)
    model = langid.fit(docs.filter(langid.fold(F.col("doc_id")) != 2))
    return langid.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the least doc_id stays (of repeated ids one row of the group's least fingerprint)."""
    small_batches(spark)
    found = simhash.near_duplicates(docs)
    kept = found.filter(F.col("id").eqNullSafe(F.col("component"))).groupBy("root").agg(F.count("*").alias("n"), F.first("component").alias("component"), F.min("fp").alias("fp"))
    kept = materialise(kept)
    repeated = not (kept.filter("n > 1").isEmpty() and found.groupBy("id").count().filter("count > 1").isEmpty())
    forget(found)
    if not repeated:
        name = "_kept"
        while name in docs.columns:
            name += "_"
        return docs.join(kept.select(F.col("component").alias(name)).hint("shuffle_hash"), docs["doc_id"].eqNullSafe(F.col(name)), "left_semi")
    # Repeated ids: tell their rows apart by fingerprint, and leave one of each group.
    prints = simhash.fingerprints(docs.select(F.struct("*").alias("row"), "text"), "row", "text")
    rows = prints.join(kept, F.col("id.doc_id").eqNullSafe(kept.component) & (prints.fp == kept.fp)).select(F.col("id").alias("row"), F.col("root").alias("_root"))
    return rows.groupBy("_root").agg(F.first("row").alias("row")).select("row.*")


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are masked; ``n_chars`` follows the text."""
    small_batches(spark)
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.resample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian unsigned 32-bit integers) and the text they decode to."""
    small_batches(spark)
    model = pieces.model_bytes(pieces.default_model())
    coded = pieces.encode(docs, model)
    return coded.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("PII", sanitise),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        last, docs = docs, stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs)
            forget(last)
    return docs
