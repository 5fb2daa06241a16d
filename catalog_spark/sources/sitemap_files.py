"""Sitemaps read as files, plain or gzip, without any body as one string; indexes may name further indexes.

Files are split by Spark's text reader, whose records end with ``>`` here, so a record holds one tag at most and the text
before it. A location is the text before a closing ``loc``. Only records that matter are put in order, a file at a time:
a sitemap has 50,000 locations by its format, and the sort spills if it has more.

A file counts if its last record closes its first element and all its locations can be read, as the body of a file
that was cut off would not parse either; others are ``broken`` and give nothing. Unlike a parser this takes elements
inside a ``loc`` for its end, does not look for other errors of form, and needs an encoding that keeps ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..operators import sinks
from .sitemaps import is_xml

CLOSED = r"(?is)^(.*)</(?:[\w.-]+:)?loc\s*$"
OPENS = r"(?is)<(?:[\w.-]+:)?loc(?:\s[^<]*)?$"
OPENED = r"(?s)^[^<]*<(?:[\w.-]+:)?([\w.-]+)"
CDATA = r"(?s)<!\[CDATA\[(.*)\]\]$"


def records(spark: SparkSession, path: str | list[str], name: Column | None = None) -> DataFrame:
    """(sitemap, at, value) of files: the file's name (or ``name``, an expression over ``_metadata``), the record's place
    in the file, and the record without its ``>``."""
    raw = spark.read.option("lineSep", ">").option("recursiveFileLookup", True).text(path)
    name = F.col("_metadata.file_name") if name is None else name
    return raw.select(name.alias("sitemap"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("k")).alias("at"), "value")


def _unescaped(x: Column) -> Column:
    """A text without references to entities; null if it has a wrong one."""
    whole = F.concat(F.lit("<a>"), x, F.lit("</a>"))
    return F.when(~x.contains("&"), x).when(is_xml(whole), F.xpath_string(whole, F.lit("/a")))


def read_files(spark: SparkSession, path: str | list[str], name: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(files, locations): (sitemap, root, broken) with the lower-case name of the first element, and (sitemap, url_index,
    url) of the files that are not broken, in their order, blank ones left out."""
    rows = records(spark, path, name)
    opened = F.regexp_extract("value", OPENED, 1)
    blank = F.trim(F.regexp_replace("value", r"\s+", " ")) == ""
    ends = rows.groupBy("sitemap").agg(
        F.min_by(opened, F.when(opened != "", F.col("at"))).alias("first"), F.max_by(F.trim(F.regexp_replace("value", r"\s+", " ")), F.when(~blank, F.col("at"))).alias("last"))
    closes = F.regexp_extract("last", r"^</(?:[\w.-]+:)?([\w.-]+) ?$", 1)
    files = ends.select("sitemap", F.lower("first").alias("root"), F.coalesce((F.col("first") != closes) | (closes == ""), F.lit(True)).alias("cut"))

    value = F.col("value")
    into, out, data = value.contains("<!--"), value.endswith("--"), value.endswith("]]")
    is_loc = value.rlike(CLOSED)
    kept = rows.filter(is_loc | into | out | data | value.rlike(OPENS))  # an opening tag keeps other elements' data apart
    order = Window.partitionBy("sitemap").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.last(F.when(out, False).when(into, True), ignorenulls=True).over(before), F.lit(False))
    told = kept.withColumns({"_inside": inside, "_data": F.lag(F.regexp_extract("value", CDATA, 1)).over(order)})
    text = _unescaped(F.regexp_extract("value", CLOSED, 1))
    own = F.trim(F.concat(F.coalesce("_data", F.lit("")), text))
    locations = told.filter(is_loc & ~F.col("_inside")).select("sitemap", "at", F.regexp_replace(own, r"^\s+|\s+$", "").alias("url"))

    wrong = locations.filter("url IS NULL").select("sitemap").distinct().withColumn("_wrong", F.lit(True))
    files = files.join(wrong, "sitemap", "left").select("sitemap", "root", (F.col("cut") | F.col("_wrong").isNotNull()).alias("broken"))
    good = locations.filter("url <> ''").join(files.filter("NOT broken").select("sitemap"), "sitemap", "left_semi")
    return files, good.withColumn("url_index", F.row_number().over(order) - 1).select("sitemap", "url_index", "url")


def walk(spark: SparkSession, path: str | list[str], captured: DataFrame, roots: list[str], name: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(locations, missing) of all sitemaps that ``roots`` (addresses) are or lead to through indexes of any depth.

    ``captured`` (url, sitemap) tells from which address each file came. Locations: (sitemap, url_index, url) of files
    that are no indexes, each once, however often it is named. Missing: (url, reason) of addresses that were named but
    ``not captured``, or whose file is ``broken``. The tables of files and locations are written to the shared folder
    once; indexes are followed level by level, by joins, and a circle of indexes ends.
    """
    root = sinks.scratch(spark)
    files, locations = read_files(spark, path, name)
    locations.write.parquet(f"{root}/locations")
    files.write.parquet(f"{root}/files")
    locations, files = spark.read.parquet(f"{root}/locations"), spark.read.parquet(f"{root}/files")
    indexes = files.filter("root = 'sitemapindex' AND NOT broken").select("sitemap")
    named = locations.join(indexes, "sitemap", "left_semi").select("sitemap", "url")
    level = spark.createDataFrame([(u,) for u in dict.fromkeys(roots)], "url string")
    seen, depth = None, 0
    while True:
        level.write.parquet(f"{root}/level={depth}")
        now = spark.read.parquet(f"{root}/level={depth}")
        if now.isEmpty():
            break
        seen = now if seen is None else seen.unionByName(now)
        step = now.join(captured, "url").select("sitemap").distinct()
        level = named.join(step, "sitemap", "left_semi").select("url").distinct().join(seen, "url", "left_anti")
        depth += 1
    if seen is None:
        seen = spark.createDataFrame([], "url string")
    reached = seen.join(captured.select("url", "sitemap"), "url", "left").join(files, "sitemap", "left")
    plain = reached.filter("NOT broken AND root <> 'sitemapindex'").select("sitemap").distinct()
    reason = F.when(F.col("root").isNull() & F.col("broken").isNull(), "not captured").when(F.col("broken"), "broken")
    missing = reached.select("url", reason.alias("reason")).filter("reason IS NOT NULL").distinct()
    return locations.join(plain, "sitemap", "left_semi"), missing
