"""URL lists, state documents and NDJSON chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import manifests


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A target table; with ``columns`` only these reach the scan. Where bundles are committed by manifests, only
    committed files are read."""
    root, _, name = path.rstrip("/").rpartition("/")
    table = manifests.read_table(spark, root, name) if manifests.has_manifests(spark, root) else spark.read.parquet(path)
    return table.select(*columns) if columns else table


def url_list(texts: DataFrame, value: str = "value") -> DataFrame:
    """(url) from texts that hold URLs between commas and white space."""
    return texts.select(F.explode(F.split(value, r"[,\s]+")).alias("url")).filter("url <> ''")


def required_urls(texts: DataFrame, value: str = "value") -> DataFrame:
    urls = url_list(texts, value)
    if urls.isEmpty():
        raise ValueError("no URLs given")
    return urls


STATE = (
    "schema_version int, updated_at string, checkpoints map<string, struct<SitemapIndex:int, URLIndex:int>>, "
    "courses map<string, struct<course_id:long, locale:string, source_url:string, first_seen_at:string, last_fetched_at:string>>"
)


def read_state(documents: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(courses, checkpoints) of JSON state documents; a blank or broken document gives no rows."""
    state = documents.select(F.from_json(value, STATE).alias("s"))
    courses = state.select(F.explode("s.courses").alias("state_key", "c")).select("state_key", "c.*")
    points = state.select(F.explode("s.checkpoints").alias("source", "p"))
    return courses, points.select("source", F.col("p.SitemapIndex").alias("sitemap_index"), F.col("p.URLIndex").alias("url_index"))


def ndjson_rows(chunks: DataFrame, schema: T.StructType, rows: str = "rows_json") -> DataFrame:
    """The rows of NDJSON texts, by a schema."""
    return chunks.select(F.explode(F.split(rows, "\n")).alias("line")).filter("line <> ''").select(F.from_json("line", schema).alias("r")).select("r.*")


def state_key(course_id: Column, locale: Column) -> tuple[Column, Column]:
    """(course_id, lower-cased locale, ``ko`` if blank): the key of the crawl state."""
    name = F.lower(F.trim(F.coalesce(locale, F.lit(""))))
    return course_id, F.when(name == "", F.lit("ko")).otherwise(name)
