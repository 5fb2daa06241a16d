"""From captured pages and API answers to one row of five documents for each course."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coerce as C
from ..functions import hashing, links

KINDS = ("online", "meta", "curriculum", "discounts", "contents")
# The addresses of the documents; {id} stands for the course id.
NEEDLES = {
    "online": r"/client/api/v1/course/{id}/online/info",
    "meta": r"/client/api/v1/course/{id}/meta",
    "curriculum": r"/client/api/v2/courses/{id}/curriculum",
    "discounts": r"/client/api/v1/discounts/best\?courseIds={id}",
    "contents": r"/client/api/v1/course/{id}/contents",
}
ONLINE_ID = r"/client/api/v1/course/(\d+)/online/info"


def first_match(rows: DataFrame, keys: list[str], value: str, pos: str, matches: dict[str, Column]) -> DataFrame:
    """For each key and name, ``value`` of the first row by ``pos`` that matches (null values included)."""
    picks = [F.min_by(F.struct(value), F.when(cond, F.col(pos))).alias(name) for name, cond in matches.items()]
    found = rows.groupBy(*keys).agg(*picks)
    return found.select(*keys, *[F.col(name)[value].alias(name) for name in matches])


def resolve_course_id(queries: DataFrame, page: str = "url") -> DataFrame:
    """(page, course_id) of cached queries: the id in the first key that names one."""
    found = F.regexp_extract("query_key", ONLINE_ID, 1)
    return queries.groupBy(page).agg(F.min_by(found, F.when(found != "", F.col("pos"))).try_cast("bigint").alias("course_id"))


def find_payloads(queries: DataFrame, page: str = "url", course_id: str = "course_id") -> DataFrame:
    """(page, course_id, one column for each kind): the first cached query of each kind. The id must end where the
    needle ends, so that 12 does not match 123."""
    mine = F.col(course_id).cast("string")
    matches = {k: F.array_contains(F.regexp_extract_all("query_key", F.lit(_with_id(n)), F.lit(1)), mine) for k, n in NEEDLES.items()}
    return first_match(queries, [page, course_id], "payload_json", "pos", matches)


def _with_id(needle: str) -> str:
    """One pattern for all rows, as a pattern with a row's id would be compiled for each row."""
    return needle.replace("{id}", r"(-?\d+)") + r"(?=\D|$)"


def merge_payloads(pages: DataFrame, api: DataFrame, keys: list[str]) -> DataFrame:
    """Page documents first, API answers where a page has none.

    ``pages``: keys and one column for each kind; ``api``: keys, kind, api_rank (lower is tried first), payload_json.
    """
    best = api.groupBy(*keys).pivot("kind", list(KINDS)).agg(F.min_by("payload_json", "api_rank"))
    best = best.select(*keys, *[F.col(k).alias(f"_{k}") for k in KINDS])
    joined = pages.join(best, keys, "left")
    return joined.select(*pages.columns[: len(keys)], *[c for c in pages.columns if c not in (*keys, *KINDS)], *[F.coalesce(k, f"_{k}").alias(k) for k in KINDS])


def snapshot_rows(payloads: DataFrame) -> DataFrame:
    """Rows of course_snapshot_raw from (fetched_at, course_id, locale, source_url, query_key, payload_json)."""
    v = F.try_parse_json("payload_json")
    canonical = F.coalesce(F.to_json(v), F.lit("{}"))
    return payloads.select(
        hashing.uuid7(F.col("fetched_at")).alias("uuid"), "fetched_at", "course_id", "locale", "source_url", "query_key",
        hashing.h64(F.col("query_key")).alias("query_key_hash"),
        C.first_non_empty(C.as_string(v, "$.statusCode"), F.lit("OK")).alias("status_code"),
        C.nullable_str(C.text_at(v, "$.errorCode")).alias("error_code"),
        canonical.alias("payload_json"), hashing.h64(canonical).alias("payload_hash"),
    )


def capture(pages: DataFrame, queries: DataFrame, api: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(captured, snapshots, errors) of pages (url, fetched_at), their cached queries (url, pos, query_key,
    payload_json) and API answers (url, kind, api_rank, path, payload_json).

    A page's id is the one in its queries, else the one in its URL; pages without either are errors.
    """
    hint = pages.select("url", "fetched_at", links.locale_from_url(F.col("url")).alias("locale"), links.course_id_from_url(F.col("url")).alias("hint"))
    known = hint.join(resolve_course_id(queries), "url", "left").withColumn("course_id", F.coalesce("course_id", "hint")).drop("hint")
    errors = known.filter("course_id = 0").select("url", F.lit("unable to resolve course_id").alias("error"))
    known = known.filter("course_id > 0")
    cached = queries.join(known, "url")
    docs = known.join(find_payloads(cached), ["url", "course_id"], "left")
    merged = merge_payloads(docs.select("url", "course_id", "fetched_at", "locale", *KINDS), api.join(known.select("url", "course_id"), "url"), ["url", "course_id"])
    used = api.join(docs.select("url", "course_id", "locale", "fetched_at", *KINDS), "url")
    missing = C.any_of([(F.col("kind") == k) & F.col(k).isNull() for k in KINDS])
    first = Window.partitionBy("url", "kind").orderBy("api_rank")
    used = used.filter(missing).withColumn("_at", F.row_number().over(first)).filter("_at = 1")
    shots = cached.select("fetched_at", "course_id", "locale", F.col("url").alias("source_url"), "query_key", "payload_json", F.lit(0).alias("_from"))
    shots = shots.unionByName(used.select("fetched_at", "course_id", "locale", F.col("url").alias("source_url"), F.col("path").alias("query_key"), "payload_json", F.lit(1).alias("_from")))
    once = Window.partitionBy("source_url", "query_key").orderBy("_from")
    shots = shots.withColumn("_seen", F.min("_from").over(once)).filter("_from = 0 OR _seen = 1").drop("_from", "_seen")
    return merged.withColumnRenamed("url", "source_url"), snapshot_rows(shots), errors
