"""Crawl state and checkpoints as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import hashing, times
from ..sources.documents import state_key
from . import events, sinks
from .keyed import KeyedTable


def seen_courses(snapshots: DataFrame, dims: DataFrame) -> DataFrame:
    """(course_id, locale, source_url, fetched_at, seq) of a bundle: snapshots come before dimension rows."""
    a = snapshots.select("course_id", "locale", "source_url", "fetched_at", F.lit(0).alias("seq"))
    return a.unionByName(dims.select("course_id", "locale", F.lit("").alias("source_url"), "fetched_at", F.lit(1).alias("seq")))


def upsert(state: DataFrame, seen: DataFrame) -> DataFrame:
    """State (course_id, locale, source_url, first_seen_at, last_fetched_at) after rows seen in the order of ``seq``.

    The URL is the last that is not blank; the first sight stays; the last fetch is the last written, not the latest.
    Ids up to 0 are ignored. Ties of ``seq`` go by time, then URL, so splitting a batch changes nothing.
    """
    course_id, locale = state_key(F.col("course_id"), F.col("locale"))
    rows = seen.select(course_id.alias("course_id"), locale.alias("locale"), "source_url", "fetched_at", "seq").filter("course_id > 0")
    order = F.struct("seq", "fetched_at", "source_url")
    named = F.when(F.trim("source_url") != "", order)
    fresh = rows.groupBy("course_id", "locale").agg(
        F.max_by("source_url", named).alias("_url"), F.min_by("fetched_at", order).alias("_first"), F.max_by("fetched_at", order).alias("_last")
    )
    joined = state.join(fresh, ["course_id", "locale"], "full_outer")
    return joined.select(
        "course_id", "locale", F.coalesce("_url", "source_url", F.lit("")).alias("source_url"),
        F.coalesce("first_seen_at", "_first").alias("first_seen_at"), F.coalesce("_last", "last_fetched_at").alias("last_fetched_at"),
    )


STATE = ["source_url", "first_seen_at", "last_fetched_at"]
KEYS = ["course_id", "locale"]
DELTAS = 16  # as many are merged on read before a new base is written


def state_table(spark: SparkSession, root: str, buckets: int | None = None) -> KeyedTable:
    """The crawl state below ``root``: a base in buckets of the key, and a delta for each write since."""
    return KeyedTable(spark, f"{root}/course_state", schemas.schema("course_state"), KEYS, "written_at", buckets)


def read_state_table(spark: SparkSession, root: str) -> DataFrame:
    """The crawl state below ``root``: the latest version of each course."""
    return state_table(spark, root).read().select(*KEYS, *STATE)


def append_state(spark: SparkSession, root: str, seen: DataFrame, commit_id: str | None = None) -> None:
    """Add new versions of the courses seen to the crawl state below ``root``; other courses are neither read from the
    deltas nor written again, and the base is not shuffled. A ``commit_id`` that is known already changes nothing."""
    table = state_table(spark, root)
    course_id, locale = state_key(F.col("course_id"), F.col("locale"))
    prior = table.lookup(seen.select(course_id.alias("course_id"), locale.alias("locale"))).select(*KEYS, *STATE)
    table.append(upsert(prior, seen).withColumn("written_at", F.current_timestamp()), commit_id)
    table.compact_if(DELTAS)


def read_checkpoints(spark: SparkSession, root: str) -> DataFrame:
    return sinks.read_or_empty(spark, root, "crawl_checkpoint")


def append_checkpoint(spark: SparkSession, root: str, source: str, sitemap_index: int, url_index: int) -> None:
    sinks.append_table(checkpoint_row(spark, source, sitemap_index, url_index), root, "crawl_checkpoint")


def checkpoint_event(points: DataFrame, namespace: str = "catalog", **settings) -> DataFrame:
    """Rows of crawl_checkpoint as events; each has an identifier of its own, in the payload, too."""
    rows = points.withColumn("checkpoint_uuid", hashing.uuid7(F.col("updated_at"))).withColumn("updated_at", times.format_ts(F.col("updated_at")))
    made = F.to_json(F.struct("checkpoint_uuid", "source", "updated_at", "sitemap_index", "url_index"))
    out = rows.select(F.explode(F.array(F.struct("*", made.alias("payload")))).alias("r"))  # one draw for both places
    return events.enveloped(out, F.col("r.checkpoint_uuid"), F.lit(""), f"{namespace}.crawl_checkpoint.v1", F.col("r.payload"), F.col("r.updated_at"), **settings)


def checkpoint_row(spark, source: str, sitemap_index: int, url_index: int) -> DataFrame:
    row = spark.createDataFrame([(source, sitemap_index, url_index)], "source string, sitemap_index int, url_index int")
    return row.select("source", F.current_timestamp().alias("updated_at"), "sitemap_index", "url_index")


def latest_checkpoint(checkpoints: DataFrame, source: str) -> tuple[int, int]:
    """The last position written for a source; (0, 0) for a new one."""
    row = checkpoints.filter(F.col("source") == source).agg(F.max_by(F.struct("sitemap_index", "url_index"), F.struct("updated_at", "sitemap_index", "url_index")).alias("p")).first()
    return (row["p"]["sitemap_index"], row["p"]["url_index"]) if row["p"] else (0, 0)
