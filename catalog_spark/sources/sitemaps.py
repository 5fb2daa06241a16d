"""Sitemap bodies that were captured before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCS = '//*[translate(local-name(), "LOC", "loc") = "loc"]'


def clean_xml(body: Column) -> Column:
    """Without byte order mark and leading white space."""
    return F.regexp_replace(body, r"^[\x{FEFF}\s]+", "")


def is_xml(body: Column) -> Column:
    """Whether a body parses; malformed bodies would fail the job in ``xpath``."""
    parsed = F.from_xml(body, "_corrupt_record string", {"mode": "PERMISSIVE"})
    return F.coalesce((F.trim(body) != "") & parsed.isNotNull() & parsed["_corrupt_record"].isNull(), F.lit(False))


def locs(body: Column) -> Column:
    """The texts of all ``loc`` elements in document order, whatever their case and namespace; empty if malformed."""
    x = clean_xml(body)
    found = F.when(is_xml(x), F.xpath(x, F.lit(f"{LOCS}/text()")))
    return F.filter(F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda u: u != "")


def is_denied(body: Column) -> Column:
    """An error document with the code AccessDenied."""
    x = clean_xml(body)
    head = F.left(x, F.lit(4096))
    root = F.lower(F.regexp_extract(x, r"^(?s)(?:<\?.*?\?>|<!.*?>|\s)*<(?:[\w.-]+:)?([\w.-]+)", 1))
    return F.coalesce((head.contains("<Error") & head.contains("<Code>AccessDenied</Code>")) | ((root == "error") & x.rlike(r"(?is)<(?:[\w.-]+:)?code[^>]*>\s*(?-i:AccessDenied)\s*</")), F.lit(False))


def sitemap_locs(sitemaps: DataFrame) -> DataFrame:
    """(sitemap_index, url_index, url) of (sitemap_index, body)."""
    return sitemaps.select("sitemap_index", F.posexplode(locs(F.col("body"))).alias("url_index", "url"))


def resolve_sitemaps(responses: DataFrame, bases: int = 2) -> DataFrame:
    """(sitemap_index, outcome, body) of captured (sitemap_index, base_rank, status, body).

    The first good body in the order of bases wins (``ok``); 404 from all configured bases is the ``end``; else a 403
    or a denied body makes it ``unavailable``; all else is an ``error``.
    """
    denied = (F.col("status") == 200) & is_denied(F.col("body"))
    good = (F.col("status") == 200) & ~denied & (F.size(locs(F.col("body"))) > 0)
    seen = responses.withColumns({"_good": F.coalesce(good, F.lit(False)), "_denied": F.coalesce(denied | (F.col("status") == 403), F.lit(False))})
    told = seen.groupBy("sitemap_index").agg(
        F.min_by("body", F.when(F.col("_good"), F.col("base_rank"))).alias("body"),
        F.max("_good").alias("ok"), F.max("_denied").alias("denied"), F.count_if(F.col("status") == 404).alias("missing"),
    )
    outcome = F.when(F.col("ok"), "ok").when(F.col("missing") == bases, "end").when(F.col("denied"), "unavailable").otherwise("error")
    return told.select("sitemap_index", outcome.alias("outcome"), F.when(F.col("ok"), F.col("body")).alias("body"))
