"""Queries over the given tables, each through the library's operators, and their SQL for an independent engine."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas
from .functions import coerce, hashing, links, text, times
from .operators import backlog, capture, discovery, event_sink, events, existence, flatten, keyed, latest, ledger, outbox, sinks, state, translate
from .plans import pipelines
from .sources import documents, pages, search, sitemap_files, sitemaps
from .streaming import scan

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


# Versions and best rows


@query("SELECT user_id, event_type, value, epoch_us(ts) // 1000 AS last_ms FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def q_latest_by_key(spark, sf):
    last = latest.latest_by(_t(spark, sf, "events"), ["user_id"], "ts", ["event_type", "value"], ["event_id"])
    return last.select("user_id", "event_type", "value", _ms("max_ts").alias("last_ms"))


@query("SELECT user_id, epoch_us(max(ts)) // 1000 AS last_ms FROM events WHERE event_type <> 'error' GROUP BY user_id ORDER BY max(ts), user_id LIMIT 100")
def q_stalest_first(spark, sf):
    return latest.stalest(_t(spark, sf, "events"), ["user_id"], "ts", 100, ok=F.col("event_type") != "error").select("user_id", _ms("last_ts").alias("last_ms"))


@query("""
SELECT l_orderkey, l_returnflag, l_partkey, l_quantity, n FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY
    CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 9 END, l_shipdate DESC, l_partkey DESC, l_quantity) AS k FROM lineitem) WHERE k = 1""")
def q_best_by(spark, sf):
    rank = F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "A", 1).otherwise(9)
    order = [rank, -_ms("l_shipdate"), -F.col("l_partkey"), F.col("l_quantity")]
    return latest.best_by(_t(spark, sf, "lineitem"), ["l_orderkey"], ["l_returnflag", "l_partkey", "l_quantity"], order, [F.count("*").alias("n")])


@query("SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'documents', 2 * count(*) FROM documents")
def q_bundle_counts(spark, sf):
    a = {n: _t(spark, sf, n) for n in ("orders", "lineitem", "documents")}
    return latest.counts(latest.union_bundles([a, {"documents": a["documents"]}]))


# Translation backlog

_DIM_SQL = """
SELECT doc_id // 2 AS course_id, CASE lang WHEN 'en' THEN 'en' WHEN 'de' THEN 'ko' ELSE lang END AS locale, doc_id % 5 AS day, doc_id,
       CASE WHEN doc_id % 10 = 0 THEN 'DRAFT' ELSE 'PUBLISH' END AS status, substr(text, 1, 60) AS title, substr(text, 61, 100) AS description, source AS keywords FROM documents"""


def _dim(spark, sf, rest: int = 100) -> DataFrame:
    day = lambda n: F.timestamp_seconds(F.lit(1_600_000_000) + n * 86_400)
    d = _t(spark, sf, "documents")
    c = F.col
    locale = F.when(c("lang") == "de", "ko").otherwise(c("lang"))
    return d.select(
        F.floor(c("doc_id") / 2).cast("long").alias("course_id"), locale.alias("locale"), day(c("doc_id") % 5).alias("fetched_at"),
        F.when(c("doc_id") % 10 == 0, "DRAFT").otherwise("PUBLISH").alias("status"), F.substring("text", 1, 60).alias("title"), F.substring("text", 61, rest).alias("description"),
        F.lit("main").alias("category_main_title"), F.lit("sub").alias("category_sub_title"), F.lit("beginner").alias("level_code"), c("source").alias("keywords"),
        times.epoch().alias("published_at"), day(c("doc_id") % 7).alias("last_updated_at"), "doc_id",
    )


def _done(spark, sf) -> DataFrame:
    labels = _t(spark, sf, "labels").filter("quality = 1")
    return labels.select(F.floor(F.col("doc_id") / 2).cast("long").alias("course_id"), F.lit("ru").alias("target_language"), F.lit("success").alias("generation_status"))


@query(f"""
WITH d AS ({_DIM_SQL}), v AS (
  SELECT *, day AS fetched, doc_id % 7 AS updated FROM d WHERE locale IN ('ko', 'en')
), l AS (
  SELECT *, max(fetched) OVER w AS top FROM v WINDOW w AS (PARTITION BY course_id, locale)
  QUALIFY row_number() OVER (PARTITION BY course_id, locale ORDER BY fetched DESC, status DESC, title DESC, description DESC, keywords DESC, updated DESC) = 1
), s AS (
  SELECT *, greatest(updated, top) AS activity, CASE locale WHEN 'ko' THEN 0 ELSE 1 END AS rank FROM l WHERE status = 'PUBLISH' AND title <> ''
    AND len(regexp_extract_all(title, '[А-Яа-яЁёІіЇїЄєҐґ]')) < 2 AND course_id NOT IN (SELECT doc_id // 2 FROM labels WHERE quality = 1)
), b AS (
  SELECT *, max(activity) OVER (PARTITION BY course_id) AS oa, max(top) OVER (PARTITION BY course_id) AS ot FROM s
  QUALIFY row_number() OVER (PARTITION BY course_id ORDER BY rank, activity DESC, top DESC, locale) = 1
)
SELECT course_id, locale, title, description, 'main' AS category_main_title, 'sub' AS category_sub_title, 'beginner' AS level_code, keywords
FROM b ORDER BY oa DESC, ot DESC, course_id DESC LIMIT 100""")
def q_backlog(spark, sf):
    return backlog.translation_backlog(_dim(spark, sf), _done(spark, sf), "ru", 100)


_UNITS_SQL = "SELECT l_orderkey AS course_id, l_linenumber AS section_id, l_partkey AS unit_id, CASE l_returnflag WHEN 'A' THEN 'ko' WHEN 'N' THEN 'en' ELSE 'ja' END AS locale, l_shipdate AS fetched_at, l_linestatus AS section_title, l_returnflag || l_linestatus AS unit_title, l_quantity FROM lineitem"


@query(f"""
WITH u AS ({_UNITS_SQL}), l AS (
  SELECT * FROM u WHERE locale IN ('ko', 'en') QUALIFY row_number() OVER (PARTITION BY course_id, section_id, unit_id, locale ORDER BY fetched_at DESC, section_title DESC, unit_title DESC) = 1
), m AS (SELECT * FROM l WHERE (course_id, section_id, unit_id) NOT IN (SELECT (course_id, section_id, unit_id) FROM u WHERE l_quantity > 25)
), b AS (
  SELECT *, max(fetched_at) OVER (PARTITION BY course_id, section_id, unit_id) AS o FROM m
  QUALIFY row_number() OVER (PARTITION BY course_id, section_id, unit_id ORDER BY CASE locale WHEN 'ko' THEN 0 ELSE 1 END, fetched_at DESC) = 1
)
SELECT course_id, locale, section_id, section_title, unit_id, unit_title FROM b ORDER BY o DESC, course_id DESC, section_id, unit_id LIMIT 200""")
def q_unit_backlog(spark, sf):
    c = F.col
    locale = F.when(c("l_returnflag") == "A", "ko").when(c("l_returnflag") == "N", "en").otherwise("ja")
    units = _t(spark, sf, "lineitem").select(
        c("l_orderkey").alias("course_id"), c("l_linenumber").alias("section_id"), c("l_partkey").alias("unit_id"), locale.alias("locale"), c("l_shipdate").cast("timestamp").alias("fetched_at"),
        c("l_linestatus").alias("section_title"), F.concat("l_returnflag", "l_linestatus").alias("unit_title"), "l_quantity",
    )
    done = units.filter("l_quantity > 25").select("course_id", "section_id", "unit_id", F.lit("ru").alias("target_language"), F.lit("success").alias("generation_status"))
    return backlog.unit_translation_backlog(units, done, "ru", 200)


@query("""
SELECT doc_id, lang, turn FROM (
  SELECT doc_id, lang, row_number() OVER (ORDER BY list_position(['fr', 'en', 'es', 'de'], lang), k) AS turn FROM (
    SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents) WHERE k <= 12) WHERE turn <= 40""")
def q_quota(spark, sf):
    return backlog.quota_plan(_t(spark, sf, "documents").select("doc_id", "lang"), "lang", ["doc_id"], ["fr", "en", "es", "de"], 12, 40).select("doc_id", "lang", "turn")


def _native_sql(target: str) -> str:
    n = lambda x, s: f"len(regexp_extract_all({x}, '[{text.SCRIPTS[s]}]'))"
    cond = {
        "ko": f"{n('a', 'hangul')} >= 4 AND {n('a', 'kana')} = 0 AND {n('b', 'kana')} = 0 AND {n('b', 'han')} <= 4 AND {n('a', 'hangul')} * 3 >= {n('a', 'latin')}",
        "ja": f"{n('b', 'kana')} >= 2 AND {n('b', 'hangul')} = 0", "zh-Hans": f"{n('b', 'han')} >= 2 AND {n('b', 'hangul')} = 0 AND {n('b', 'kana')} = 0",
        "ru": f"{n('a', 'cyrillic')} >= 2", "ar": f"{n('a', 'arabic')} >= 2",
        "en": f"{n('a', 'latin')} >= 3 AND " + " + ".join(n("b", s) for s in text.SCRIPTS if s != "latin") + " = 0",
    }[target]
    return f"SELECT '{target}' AS target, count(*) FILTER ({cond})::BIGINT AS n FROM (SELECT substr(text, 1, 50) AS a, text AS b FROM documents)"


NATIVE_TARGETS = ("ko", "ja", "zh-Hans", "ru", "ar", "en")


@query(" UNION ALL ".join(map(_native_sql, NATIVE_TARGETS)))
def q_native(spark, sf):
    d = _t(spark, sf, "documents")
    flags = [F.count_if(text.is_native(t, F.substring("text", 1, 50), F.col("text"))).alias(t) for t in NATIVE_TARGETS]
    return d.agg(*flags).select(F.explode(F.map_from_arrays(F.array(*map(F.lit, NATIVE_TARGETS)), F.array(*[F.col(f"`{t}`") for t in NATIVE_TARGETS]))).alias("target", "n"))


# Scalar functions

_H64 = "('0x' || " + " || ".join(f"substr(h, {i}, 2)" for i in range(15, 0, -2)) + ")::UBIGINT::VARCHAR"


@query(f"SELECT doc_id, (SELECT {_H64} FROM (SELECT sha256(text) AS h)) AS text_hash, (SELECT {_H64} FROM (SELECT sha256(concat_ws(chr(31), lang, source, n_chars::VARCHAR)) AS h)) AS source_hash FROM documents")
def q_h64(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", hashing.h64(F.col("text")).cast("string").alias("text_hash"), hashing.source_hash(F.col("lang"), F.col("source"), F.col("n_chars")).cast("string").alias("source_hash"))


@query("SELECT o_orderkey, '[' || o_orderkey || ',' || CASE WHEN o_totalprice = floor(o_totalprice) THEN o_totalprice::BIGINT::VARCHAR ELSE o_totalprice::VARCHAR END || ',\"' || o_orderstatus || '\",null]' AS sig FROM orders")
def q_json_sig(spark, sf):
    sig = hashing.json_sig(hashing.json_whole(F.col("o_orderkey")), hashing.json_number(F.col("o_totalprice")), hashing.json_text(F.col("o_orderstatus")), hashing.json_text(F.lit(None).cast("string")))
    return _t(spark, sf, "orders").select("o_orderkey", sig.alias("sig"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS as_int, (props->>'$.k')::DOUBLE AS as_float, 0 AS flag, CASE WHEN event_type IN ('error', 'view') THEN 1 ELSE 0 END AS said, least(greatest((props->>'$.k')::INT * 2, 0), 100)::INT AS percent, '' AS nothing, CASE WHEN (props->>'$.k')::INT = 0 THEN event_type ELSE (props->>'$.k') END AS non_zero FROM events")
def q_coerce(spark, sf):
    e = _t(spark, sf, "events")
    v = F.try_parse_json("props")
    said = F.try_parse_json(F.when(F.col("event_type").isin("error", "view"), F.lit('{"x": " Yes "}')).otherwise(F.lit('{"x": 1}')))
    return e.select(
        "event_id", coerce.as_int(v, "$.k").alias("as_int"), coerce.as_float(v, "$.k").alias("as_float"), coerce.to_u8(v, "$.k").alias("flag"), coerce.to_u8(said, "$.x").alias("said"),
        coerce.clamp_percent(coerce.as_int(v, "$.k") * 2).alias("percent"), coerce.as_string(v, "$.none").alias("nothing"), coerce.first_non_zero(coerce.text_at(v, "$.k"), F.col("event_type")).alias("non_zero"),
    )


@query("SELECT l_orderkey, l_linenumber, epoch_ms(l_shipdate) - 32400000 AS ms, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.000') AS again FROM lineitem")
def q_parse_ts(spark, sf):
    x = times.parse_ts(F.date_format(F.col("l_shipdate"), "yyyy-MM-dd HH:mm:ss"))
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.unix_millis(x).alias("ms"), times.format_ts(x).alias("again"))


@query("""
SELECT page_id, coalesce(CASE WHEN s IN ('en', 'de', 'fr', 'es') THEN s END, 'ko') AS locale, coalesce(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, coalesce(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref, 0::BIGINT AS course_id
FROM (SELECT *, regexp_extract(url, '^[a-z]+://[^/?#]*/+([^/?#]*)', 1) AS s FROM pages)""")
def q_url_locale(spark, sf):
    u = F.col("url")
    return _t(spark, sf, "pages").select("page_id", links.locale_from_url(u).alias("locale"), links.query_value(u, "page").alias("page"), links.query_value(u, "ref").alias("ref"), links.course_id_from_url(u).alias("course_id"))


@query("SELECT p_partkey, CASE WHEN p_partkey = 0 THEN '' ELSE 'https://www.example.com/course/' || replace(p_name, ' ', '%20') || '?cid=' || p_partkey END AS by_slug, 'https://www.example.com/c/x?' || CASE WHEN p_partkey = 0 THEN 'z=1' ELSE 'cid=' || p_partkey || '&z=1' END AS by_path FROM part")
def q_course_url(spark, sf):
    key = F.col("p_partkey")
    return _t(spark, sf, "part").select("p_partkey", links.course_url(F.lit(None).cast("string"), key, F.col("p_name")).alias("by_slug"), links.course_url(F.lit(" /c/x?z=1"), key, F.col("p_name")).alias("by_path"))


@query("SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN '초급' ELSE p_type END AS ko, CASE p_type WHEN 'ECONOMY' THEN '初級' WHEN 'STANDARD' THEN '全レベル' ELSE p_type END AS ja FROM part")
def q_level(spark, sf):
    p = _t(spark, sf, "part")
    named = F.when(F.col("p_type") == "ECONOMY", F.lit(" Beginner")).otherwise(F.col("p_type"))
    every = F.when(F.col("p_type") == "STANDARD", F.lit("All_levels")).otherwise(named)
    return p.select("p_partkey", text.localize_level(F.lit("ko-KR"), named).alias("ko"), text.localize_level(F.lit("ja"), every).alias("ja"))


@query("SELECT doc_id, substr(replace(replace(trim(regexp_replace(text, '[\\s]+', ' ', 'g')), 'http://', ''), 'https://', ''), 1, 500) AS short FROM documents")
def q_compact(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.compact_text(F.col("text"), 500).alias("short"))


@query("SELECT doc_id, lang AS code, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' ELSE 'Spanish' END AS name, 'zh-Hant' AS chinese, len(list_distinct([lang, 'fil'])) AS n_targets FROM documents")
def q_language(spark, sf):
    code = text.language_code(F.concat(F.upper("lang"), F.lit("-XX")))
    targets = text.normalize_targets(F.array(F.col("lang"), F.lit("tl"), F.lit("??"), F.lit("fil-PH"), F.col("lang")))
    return _t(spark, sf, "documents").select("doc_id", code.alias("code"), text.language_name(code).alias("name"), text.language_code(F.lit("zh-TW")).alias("chinese"), F.size(targets).cast("long").alias("n_targets"))


@query("SELECT page_id, 'u' || page_id || ',x' AS ids, 'key *** end' AS error FROM pages")
def q_text_misc(spark, sf):
    p = _t(spark, sf, "pages")
    listed = F.array_join(text.csv_items(F.concat(F.lit(" u"), F.col("page_id").cast("string"), F.lit(", ,x"))), ",")
    return p.select("page_id", listed.alias("ids"), text.error_text(F.lit("key  hush\n end"), 400, ["hush"]).alias("error"))


# Sources


@query("SELECT page_id, page_id * 3 AS state_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages")
def q_embedded(spark, sf):
    p = _t(spark, sf, "pages")
    block = F.concat(F.lit('<script type="x" id="__NEXT_DATA__">{"id": '), (F.col("page_id") * 3).cast("string"), F.lit("}</script>"), F.col("html"))
    return p.select("page_id", coerce.as_int(pages.embedded_state(block), "$.id").alias("state_id"), F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"))


@query("SELECT o_orderkey, 0::BIGINT AS pos, '[\"/client/api/v1/course/' || o_orderkey || '/online/info\"]' AS query_key, o_orderstatus AS status FROM orders")
def q_page_queries(spark, sf):
    o = _t(spark, sf, "orders")
    made = F.concat(F.lit('{"props":{"pageProps":{"dehydratedState":{"queries":[{"queryKey":["/client/api/v1/course/'), F.col("o_orderkey").cast("string"), F.lit('/online/info"],"state":{"data":{"status":"'), F.col("o_orderstatus"), F.lit('"}}},{"queryKey":["none"],"state":{"data":[1]}}]}}}}'))
    rows = pages.page_queries(o.select("o_orderkey", F.try_parse_json(made).alias("state")))
    return rows.select("o_orderkey", F.col("pos").cast("long").alias("pos"), "query_key", coerce.as_string(F.col("payload"), "$.status").alias("status"))


@query("SELECT page_id // 50 AS sitemap_index, row_number() OVER (PARTITION BY page_id // 50 ORDER BY page_id) - 1 AS url_index, url FROM pages")
def q_sitemap_locs(spark, sf):
    p = _t(spark, sf, "pages")
    one = F.concat(F.lit("<x:URL><x:LOC> "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </x:LOC></x:URL>"))
    bodies = p.groupBy(F.floor(F.col("page_id") / 50).cast("long").alias("sitemap_index")).agg(F.array_sort(F.collect_list(F.struct("page_id", one.alias("x")))).alias("all"))
    body = F.concat(F.lit('﻿ <?xml version="1.0"?><x:urlset xmlns:x="urn:x">'), F.array_join(F.transform("all", lambda s: s["x"]), ""), F.lit("</x:urlset>"))
    return sitemaps.sitemap_locs(bodies.select("sitemap_index", body.alias("body"))).select("sitemap_index", F.col("url_index").cast("long").alias("url_index"), "url")


@query("""
SELECT page_id AS sitemap_index, CASE page_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'end' WHEN 2 THEN 'unavailable' WHEN 3 THEN 'ok' ELSE 'error' END AS outcome,
       CASE WHEN page_id % 5 IN (0, 3) THEN '<u><loc>' || page_id || '</loc></u>' END AS body FROM pages""")
def q_resolve_sitemaps(spark, sf):
    i = F.col("page_id")
    good = F.concat(F.lit("<u><loc>"), i.cast("string"), F.lit("</loc></u>"))
    denied = F.lit("<Error><Code>AccessDenied</Code></Error>")
    first = F.struct(F.lit(0).alias("base_rank"), F.when(i % 5 == 0, 200).when(i % 5 == 1, 404).when(i % 5 == 2, 200).when(i % 5 == 3, 403).otherwise(200).alias("status"), F.when(i % 5 == 0, good).when(i % 5 == 2, denied).otherwise(F.lit("<u><loc>")).alias("body"))
    second = F.struct(F.lit(1).alias("base_rank"), F.when(i % 5 == 3, 200).when(i % 5 == 1, 404).otherwise(500).alias("status"), F.when(i % 5 == 3, good).otherwise(F.lit("")).alias("body"))
    rows = _t(spark, sf, "pages").select(i.alias("sitemap_index"), F.explode(F.array(first, second)).alias("r")).select("sitemap_index", "r.*")
    return sitemaps.resolve_sitemaps(rows)


@query("""
SELECT o_custkey, count(*) AS n, min('https://www.example.com/course/s' || o_orderkey || '?cid=' || o_orderkey) AS first_url FROM orders WHERE o_orderkey > 0 AND o_orderstatus <> 'P' GROUP BY o_custkey""")
def q_search_hits(spark, sf):
    item = F.to_json(F.struct(
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("string")).alias("id"),
        F.struct(F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey")).alias("course_id"), F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("slug")).alias("course"),
    ))
    bodies = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.concat(F.lit('{"data":{"items":['), F.array_join(F.collect_list(item), ","), F.lit("]}}")).alias("body"))
    return search.search_hits(bodies).groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("url").alias("first_url"))


@query("""
WITH o AS (SELECT *, o_orderkey // 100 AS page FROM orders WHERE o_orderkey NOT BETWEEN 5050 AND 5099),
s AS (SELECT page, count(*) AS n FROM o GROUP BY page), r AS (SELECT page FROM (SELECT page, n, coalesce(max((n < 100)::INT) OVER (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM s) WHERE stopped = 0)
SELECT o_custkey, o_orderkey, page FROM o WHERE page IN (SELECT page FROM r) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY page, o_orderkey) = 1""")
def q_paged_union(spark, sf):
    o = _t(spark, sf, "orders").filter("o_orderkey NOT BETWEEN 5050 AND 5099").withColumn("page", F.floor(F.col("o_orderkey") / 100).cast("long"))
    return search.paged_union(o, ["o_custkey"], 100, pos="o_orderkey").select("o_custkey", "o_orderkey", "page")


@query("""
WITH o AS (SELECT *, o_orderkey // 100 AS page FROM orders),
s AS (SELECT page, count(*) AS n FROM o GROUP BY page), e AS (SELECT coalesce(min(page) FILTER (n < 100), max(page)) AS last FROM s)
SELECT o_custkey, o_orderkey, page FROM o WHERE page <= (SELECT last FROM e) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY page, o_orderkey) = 1""")
def q_paged_union_whole(spark, sf):
    """All pages of orders; ``q_paged_union`` keeps the short page that its SQL cuts, and so stops there."""
    o = _t(spark, sf, "orders").withColumn("page", F.floor(F.col("o_orderkey") / 100).cast("long"))
    return search.paged_union(o, ["o_custkey"], 100, pos="o_orderkey").select("o_custkey", "o_orderkey", "page")


@query("SELECT url, count(*) AS n FROM pages GROUP BY url UNION ALL SELECT 'second', count(*) FROM pages")
def q_url_list(spark, sf):
    texts = _t(spark, sf, "pages").select(F.concat(F.lit(" ,"), F.col("url"), F.lit(",\n\tsecond ")).alias("value"))
    return documents.url_list(texts).groupBy("url").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS course_id, o_orderstatus AS locale, 'u' || o_custkey AS source_url FROM orders")
def q_read_state(spark, sf):
    c = F.struct(F.col("o_orderkey").alias("course_id"), F.col("o_orderstatus").alias("locale"), F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("source_url"))
    doc = F.to_json(F.struct(F.lit(1).alias("schema_version"), F.create_map(F.col("o_orderkey").cast("string"), c).alias("courses")))
    courses, _ = documents.read_state(_t(spark, sf, "orders").select(doc.alias("value")))
    return courses.select("course_id", "locale", "source_url")


# Captures and flattening


@query("SELECT user_id, arg_min(value, event_id) FILTER (contains(event_type, 'purch')) AS purchase, arg_min(value, event_id) FILTER (contains(event_type, 'sign')) AS signup FROM events GROUP BY user_id")
def q_find_payload(spark, sf):
    kind = F.col("event_type")
    return capture.first_match(_t(spark, sf, "events"), ["user_id"], "value", "event_id", {"purchase": kind.contains("purch"), "signup": kind.contains("sign")})


@query("SELECT d.doc_id, coalesce(CASE WHEN d.n_chars % 2 = 0 THEN 'page' END, 'api' || l.quality) AS online, 'tox' || l.toxic AS meta FROM documents d LEFT JOIN labels l USING (doc_id)")
def q_merge_payloads(spark, sf):
    none = F.lit(None).cast("string")
    mine = _t(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") % 2 == 0, "page").alias("online"), *[none.alias(k) for k in capture.KINDS[1:]])
    labels = _t(spark, sf, "labels")
    api = labels.select("doc_id", F.lit("online").alias("kind"), F.lit(0).alias("api_rank"), F.concat(F.lit("api"), F.col("quality").cast("string")).alias("payload_json"))
    api = api.union(labels.select("doc_id", F.lit("online"), F.lit(1), F.lit("late"))).union(labels.select("doc_id", F.lit("meta"), F.lit(0), F.concat(F.lit("tox"), F.col("toxic").cast("string"))))
    return capture.merge_payloads(mine, api, ["doc_id"]).select("doc_id", "online", "meta")


def _orders_as_captures(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))  # few packed rows a file become long documents
    c = F.col
    levels = F.array(F.struct(F.lit("x").alias("code"), F.lit(False).alias("isActive")), F.struct(F.lower("o_orderpriority").alias("code"), (c("o_orderkey") % 2 == 0).alias("isActive")))
    pay = F.struct(c("o_totalprice").alias("payPrice"), F.lit("100.9").alias("regularPrice"), (c("o_orderkey") % 150).alias("discountRate"), F.struct(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("endedAt")).alias("discount"))
    data = F.struct(F.concat(F.lit("t"), c("o_orderkey").cast("string")).alias("title"), c("o_orderstatus").alias("status"), levels.alias("levels"), F.lit(1).alias("isNew"), F.lit("yes").alias("isBest"), (c("o_custkey").cast("string")).alias("studentCount"), pay.alias("paymentInfo"))
    meta = F.struct(F.struct(F.lit("k").alias("keywords"), F.array(F.lit("a"), F.lit(" "), c("o_orderstatus")).alias("categorySlugs")).alias("data"))
    teachers = F.struct(F.struct(F.array(F.struct(c("o_custkey").alias("id"), F.lit("n").alias("name")), F.struct(F.lit(0).alias("id"), F.lit("z").alias("name"))).alias("mainInstructors")).alias("data"))
    return o.select(
        c("o_orderdate").cast("timestamp").alias("fetched_at"), c("o_orderkey").alias("course_id"), F.lit("ko").alias("locale"), F.to_json(F.struct(data.alias("data"))).alias("online"),
        F.when(c("o_orderkey") % 3 != 0, F.to_json(meta)).alias("meta"), F.lit(None).cast("string").alias("curriculum"), F.lit('{"data":{"discountRate":7,"discountTitle":"d"}}').alias("discounts"), F.to_json(teachers).alias("contents"),
    )


@query("""
SELECT o_orderkey AS course_id, 't' || o_orderkey AS title, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority) ELSE '' END AS level_code, 0 AS is_new, 1 AS is_best, o_custkey AS student_count,
       'a,' || o_orderstatus AS slugs, -32400000::BIGINT AS published_ms FROM orders WHERE o_orderkey % 3 <> 0""")
def q_course_dim(spark, sf):
    d = flatten.course_dim(_orders_as_captures(spark, sf))
    return d.select("course_id", "title", "status", "level_code", "is_new", "is_best", "student_count", F.array_join("category_slugs", ",").alias("slugs"), F.unix_millis("published_at").alias("published_ms"))


_FACT = "FROM (SELECT *, CASE WHEN o_orderkey % 150 = 0 THEN 7 ELSE least(o_orderkey % 150, 100) END AS rate, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.000') AS ended FROM orders WHERE o_orderkey % 3 <> 0)"


@query(f"""SELECT o_orderkey AS course_id, o_custkey AS student_count, rate::INT AS discount_rate, 'd' AS discount_title, epoch_ms(o_orderdate) - 32400000 AS ended_ms,
  (SELECT {_H64} FROM (SELECT sha256('[' || o_custkey || ',0,0,0,0,0,' || rate || ',"d","' || ended || '"]') AS h)) AS metric_hash {_FACT}""")
def q_course_metric(spark, sf):
    m = flatten.course_metric(_orders_as_captures(spark, sf))
    return m.select("course_id", "student_count", "discount_rate", "discount_title", F.unix_millis("discount_ended_at").alias("ended_ms"), F.col("metric_hash").cast("string").alias("metric_hash"))


@query(f"""SELECT o_orderkey AS course_id, 100.9::DOUBLE AS regular_price, o_totalprice AS pay_price,
  (SELECT {_H64} FROM (SELECT sha256('[100.9,' || CASE WHEN o_totalprice = floor(o_totalprice) THEN o_totalprice::BIGINT::VARCHAR ELSE o_totalprice::VARCHAR END || ',' || rate || ',"d","' || ended || '",0,0]') AS h)) AS price_hash {_FACT}""")
def q_course_price(spark, sf):
    return flatten.course_price(_orders_as_captures(spark, sf)).select("course_id", "regular_price", "pay_price", F.col("price_hash").cast("string").alias("price_hash"))


@query("SELECT o_custkey AS instructor_id, count(*) AS n, 'main' AS role FROM orders WHERE o_custkey > 0 GROUP BY o_custkey")
def q_instructors(spark, sf):
    rows = _orders_as_captures(spark, sf)
    people = flatten.instructors(rows).select("instructor_id").distinct()
    return flatten.course_instructors(rows).join(people, "instructor_id").groupBy("instructor_id", "role").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag AS unit_title, count(*) AS n, sum(l_quantity)::BIGINT AS runtime, count(*) FILTER (l_linestatus = 'O') AS previews, count(DISTINCT l_orderkey) AS sections FROM lineitem GROUP BY l_returnflag")
def q_unnest(spark, sf):
    unit = F.struct(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("title"), F.col("l_quantity").alias("runtime"), (F.col("l_linestatus") == "O").alias("isPreview"))
    made = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(unit).alias("units"))
    body = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("l_orderkey").alias("id"), F.lit("s").alias("title"), "units")).alias("curriculum")).alias("data")))
    rows = made.select(F.current_timestamp().alias("fetched_at"), F.lit(1).alias("course_id"), F.lit("ko").alias("locale"), body.alias("curriculum"))
    return flatten.curriculum_units(rows).groupBy("unit_title").agg(F.count("*").alias("n"), F.sum("runtime_sec").alias("runtime"), F.sum("is_preview").alias("previews"), F.countDistinct("section_id").alias("sections"))


@query(f"SELECT event_id, 'OK' AS status_code, CASE WHEN event_type = 'error' THEN 'E1' END AS error_code, (SELECT {_H64} FROM (SELECT sha256(event_type) AS h)) AS query_key_hash FROM events")
def q_snapshot_rows(spark, sf):
    e = _t(spark, sf, "events")
    payload = F.when(F.col("event_type") == "error", F.lit('{"errorCode": "E1"}')).otherwise(F.lit('{"errorCode": " ", "statusCode": ""}'))
    rows = e.select(F.col("ts").cast("timestamp").alias("fetched_at"), F.col("event_id").alias("course_id"), F.lit("ko").alias("locale"), F.lit("u").alias("source_url"), F.col("event_type").alias("query_key"), payload.alias("payload_json"))
    return capture.snapshot_rows(rows).select(F.col("course_id").alias("event_id"), "status_code", "error_code", F.col("query_key_hash").cast("string").alias("query_key_hash"))


# Discovery


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1")
def q_dedupe_first(spark, sf):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return discovery.dedupe_first(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("""
WITH s AS (SELECT page_id, page_id // 50 AS i, page_id % 50 AS j FROM pages WHERE (page_id // 50, page_id % 50) >= (1, 10) ORDER BY i, j LIMIT 100),
m AS (SELECT *, (page_id NOT IN (SELECT doc_id FROM labels))::INT AS fresh FROM s),
c AS (SELECT * FROM (SELECT *, coalesce(sum(fresh) OVER (ORDER BY i, j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m) WHERE before < 30)
SELECT 'picked' AS kind, i, j FROM c WHERE fresh = 1 UNION ALL SELECT 'checkpoint', coalesce(p.i, 1), coalesce(p.j + 1, 10) FROM (SELECT max({'i': i, 'j': j}) AS p FROM c)""")
def q_scan_slice(spark, sf):
    rows = _t(spark, sf, "pages").select("page_id", F.floor(F.col("page_id") / 50).cast("long").alias("i"), (F.col("page_id") % 50).alias("j"))
    known = _t(spark, sf, "labels").select(F.col("doc_id").alias("page_id"))
    picked, point = discovery.scan_slice(rows, known, ["page_id"], (1, 10), 100, 30, ("i", "j"))
    return picked.select(F.lit("picked").alias("kind"), "i", "j").unionByName(point.select(F.lit("checkpoint").alias("kind"), F.col("i").cast("long"), F.col("j").cast("long")))


@query(f"""
WITH d AS ({_DIM_SQL}), l AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY course_id, locale ORDER BY day DESC, title DESC, description DESC) = 1)
SELECT c.doc_id FROM d AS c WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.course_id = c.course_id + 1 AND l.locale = c.locale AND l.locale <> 'ko')""")
def q_new_courses(spark, sf):
    dim = _dim(spark, sf)
    asked = dim.select("doc_id", (F.col("course_id") + 1).alias("course_id"), "locale")
    return discovery.new_rows(asked, discovery.known_courses(dim), ["course_id", "locale"]).select("doc_id")


@query("SELECT i // 20 AS batch, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS i FROM labels) GROUP BY batch")
def q_flush_batches(spark, sf):
    return discovery.flush_batches(_t(spark, sf, "labels"), ["doc_id"], 20).groupBy("batch").agg(F.count("*").alias("n"))


# State, events, outbox


@query("""
WITH e AS (SELECT user_id AS course_id, arg_max(event_type, event_id) FILTER (event_type <> 'view') AS url, arg_min(ts, event_id) AS a, arg_max(ts, event_id) AS b FROM events WHERE user_id > 0 GROUP BY user_id),
s AS (SELECT c_custkey AS course_id, 'old' AS url FROM customer WHERE c_custkey % 3 = 0)
SELECT coalesce(e.course_id, s.course_id) AS course_id, 'en' AS locale, coalesce(e.url, s.url, '') AS source_url, CASE WHEN s.course_id IS NULL THEN epoch_us(e.a) // 1000 ELSE 0 END AS first_ms, coalesce(epoch_us(e.b) // 1000, 0) AS last_ms
FROM e FULL JOIN s ON e.course_id = s.course_id""")
def q_state_upsert(spark, sf):
    seen = _t(spark, sf, "events").select(F.col("user_id").alias("course_id"), F.lit(" EN").alias("locale"), F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type")).alias("source_url"), F.col("ts").cast("timestamp").alias("fetched_at"), F.col("event_id").alias("seq"))
    old = F.timestamp_seconds(F.lit(0))
    prior = _t(spark, sf, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("course_id"), F.lit("en").alias("locale"), F.lit("old").alias("source_url"), old.alias("first_seen_at"), old.alias("last_fetched_at"))
    return state.upsert(prior, seen).select("course_id", "locale", "source_url", F.unix_millis("first_seen_at").alias("first_ms"), F.unix_millis("last_fetched_at").alias("last_ms"))


@query("""
SELECT 'shop.orders.v1' AS event_type, CASE WHEN o_orderkey % 2 = 0 THEN 'shop.orders.v1:u' || o_orderkey ELSE 'by id' END AS key, o_orderkey AS payload_key, strftime(o_orderdate + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S.000') AS created_at FROM orders
UNION ALL SELECT 'shop.customer.v1', 'by id', c_custkey, '2020-09-13 21:26:40.000' FROM customer""")
def q_events(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("u"), F.col("o_orderkey").cast("string"))).alias("source_url"))
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.timestamp_seconds(F.lit(1_600_000_000)).alias("updated_at"))
    all_ = events.bundle_events({"orders": o, "customer": c}, namespace="shop")
    key = events.event_key(F.col("event_type"), F.col("url"), F.col("event_uuid"))
    return all_.select("event_type", F.when(F.col("url") == "", "by id").otherwise(key).alias("key"), F.get_json_object("payload", "$.k").cast("long").alias("payload_key"), "created_at")


def _box(spark, sf) -> DataFrame:
    rows = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    chunks = outbox.chunked(rows, rows.columns, ["o_orderkey"])
    none = spark.createDataFrame([], schemas.schema("insert_outbox"))
    first = outbox.enqueue(chunks, none, "db", "orders", rows.columns, "connection refused")
    return first.unionByName(outbox.enqueue(chunks, first, "db", "orders", rows.columns, "connection refused"))


@query("SELECT 'orders' AS target_table, count(*) AS n_rows, 0 AS attempts, 'connection refused' AS source_error FROM orders")
def q_outbox_pending(spark, sf):
    waiting = outbox.pending(_box(spark, sf), None)
    return waiting.groupBy("target_table", "source_error").agg(F.sum("row_count").alias("n_rows"), F.max("replay_attempt").alias("attempts"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def q_outbox_replay(spark, sf):
    rows = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return outbox.replay_rows(outbox.pending(_box(spark, sf), None), "orders", rows.schema)


@query("SELECT event_type = 'view' AS bad, count(*) AS n, 1 AS attempts FROM events GROUP BY 1")
def q_outbox_mark(spark, sf):
    e = _t(spark, sf, "events")
    none = F.lit(None).cast("timestamp")
    box = e.select(F.col("event_id").cast("string").alias("outbox_uuid"), F.col("ts").cast("timestamp").alias("created_at"), F.lit(0).alias("replay_attempt"), none.alias("last_replay_at"), none.alias("replayed_at"), F.lit("").alias("replay_error"))
    results = e.select(F.col("event_id").cast("string").alias("outbox_uuid"), F.when(F.col("event_type") == "view", "eof").alias("error"))
    marked = outbox.mark_replayed(box, results)
    return marked.groupBy(F.col("replayed_at").isNull().alias("bad")).agg(F.count("*").alias("n"), F.max("replay_attempt").cast("int").alias("attempts"))


# Fixed test messages for the kinds of write errors.
MESSAGES = {"click": "Code: 242. Table is in readonly mode", "error": "Not the leader for some partition; metadata are likely out of date", "view": "Code: 60. Table does not exist", "signup": "dial: Connection refused", "purchase": "i/o timeout"}


@query("""
SELECT temporary, reason, count(*) AS n FROM (SELECT event_type IN ('click', 'signup', 'purchase') AS temporary,
  CASE event_type WHEN 'error' THEN 'leader-metadata-stale' WHEN 'signup' THEN 'network' WHEN 'purchase' THEN 'timeout' ELSE 'temporary-kafka-error' END AS reason FROM events) GROUP BY temporary, reason""")
def q_error_triage(spark, sf):
    said = F.create_map(*[F.lit(x) for pair in MESSAGES.items() for x in pair])
    return outbox.error_report(_t(spark, sf, "events").withColumn("message", said[F.col("event_type")]), "message")


@query("SELECT doc_id AS course_id, 'T ' || title AS title, 'beginner' AS level_code FROM (SELECT doc_id, substr(regexp_replace(trim(regexp_replace(substr(text, 1, 40), '\\s+', ' ', 'g')), 'https?://', '', 'g'), 1, 178) AS title FROM documents WHERE lang = 'de')")
def q_translate(spark, sf):
    rows = _t(spark, sf, "documents").filter("lang = 'de'").select(
        F.col("doc_id").alias("course_id"), F.lit("ko").alias("locale"), F.substring("text", 1, 40).alias("title"), F.lit("").alias("description"), F.lit("").alias("category_main_title"), F.lit("").alias("category_sub_title"), F.lit("beginner").alias("level_code"), F.lit("").alias("keywords")
    )

    def speak(asked):
        import json

        titles = [json.loads(json.loads(r)["messages"][1]["content"])["title"] for r in asked]
        return [json.dumps({"choices": [{"message": {"content": "Sure: " + json.dumps({"title": "T " + t})}}]}) for t in titles]

    asked = translate.apply_translator(translate.requests(rows, F.lit("fr"), list(backlog.COURSE_TEXTS), "m"), speak)
    return translate.course_translations(asked, "m")[0].select("course_id", "title", "level_code")


# The same over whole tables: the queries above keep the cuts that their SQL has

WHOLE = (1 << 31) - 1


@query(SQL["q_backlog"].replace("substr(text, 61, 100)", "substr(text, 61)"))
def q_backlog_whole(spark, sf):
    return backlog.translation_backlog(_dim(spark, sf, WHOLE), _done(spark, sf), "ru", 100)


@query(SQL["q_new_courses"].replace("substr(text, 61, 100)", "substr(text, 61)").replace("l.locale <> 'ko'", f"(l.locale <> 'ko' OR regexp_matches(l.title || l.description, '[{text.SCRIPTS['hangul']}]'))"))
def q_new_courses_whole(spark, sf):
    dim = _dim(spark, sf, WHOLE)
    asked = dim.select("doc_id", (F.col("course_id") + 1).alias("course_id"), "locale")
    return discovery.new_rows(asked, discovery.known_courses(dim), ["course_id", "locale"]).select("doc_id")


@query(SQL["q_state_upsert"].replace(" WHERE c_custkey % 3 = 0", ""))
def q_state_upsert_whole(spark, sf):
    seen = _t(spark, sf, "events").select(F.col("user_id").alias("course_id"), F.lit(" EN").alias("locale"), F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type")).alias("source_url"), F.col("ts").cast("timestamp").alias("fetched_at"), F.col("event_id").alias("seq"))
    old = F.timestamp_seconds(F.lit(0))
    prior = _t(spark, sf, "customer").select(F.col("c_custkey").alias("course_id"), F.lit("en").alias("locale"), F.lit("old").alias("source_url"), old.alias("first_seen_at"), old.alias("last_fetched_at"))
    return state.upsert(prior, seen).select("course_id", "locale", "source_url", F.unix_millis("first_seen_at").alias("first_ms"), F.unix_millis("last_fetched_at").alias("last_ms"))


def _compact_sql(x: str, n: int) -> str:
    return f"substr(replace(replace(trim(regexp_replace({x}, '[\\s]+', ' ', 'g')), 'http://', ''), 'https://', ''), 1, {n})"


@query(f"SELECT doc_id AS course_id, {_compact_sql("'T ' || coalesce(substr(text, 1, 40), '')", 180)} AS title, {_compact_sql("coalesce(text, '')", 500)} AS description, 'beginner' AS level_code FROM documents")
def q_translate_whole(spark, sf):
    said = F.coalesce("text", F.lit(""))
    rows = _t(spark, sf, "documents").select(
        F.col("doc_id").alias("course_id"), F.lit("ko").alias("locale"), F.substring(said, 1, 40).alias("title"), said.alias("description"), F.lit("").alias("category_main_title"), F.lit("").alias("category_sub_title"), F.lit("beginner").alias("level_code"), F.lit("").alias("keywords")
    )

    def speak(asked):
        import json

        given = [json.loads(json.loads(r)["messages"][1]["content"]) for r in asked]
        return [json.dumps({"choices": [{"message": {"content": "Sure: " + json.dumps({"title": "T " + g["title"], "description": g["description"]})}}]}) for g in given]

    asked = translate.apply_translator(translate.requests(rows, F.lit("fr"), list(backlog.COURSE_TEXTS), "m"), speak)
    return translate.course_translations(asked, "m")[0].select("course_id", "title", "description", "level_code")


# Sinks and jobs: they write to a scratch folder, and what is read back is compared


@query("SELECT o_orderkey AS course_id, o_custkey AS instructor_id, 'none' AS role, epoch_us(o_orderdate) // 1000 AS fetched_ms FROM orders")
def q_append_table(spark, sf):
    root = sinks.scratch(spark)
    rows = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("course_id"), F.col("o_custkey").alias("instructor_id"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"), F.lit("x").alias("extra"))
    for odd in (0, 1):
        sinks.append_table(rows.filter(F.pmod("course_id", F.lit(2)) == odd), root, "course_instructor_map")
    table = documents.read_table(spark, f"{root}/course_instructor_map", ["course_id", "instructor_id", "role", "fetched_at"])
    return table.select("course_id", "instructor_id", F.coalesce("role", F.lit("none")).alias("role"), _ms("fetched_at").alias("fetched_ms"))


@query("""
SELECT 'course_snapshot_raw' AS table_name, count(*) AS n FROM orders
UNION ALL SELECT unnest(['course_dim', 'course_metric_fact', 'course_price_fact']), count(*) FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT 'course_curriculum_unit', 0
UNION ALL SELECT unnest(['instructor_dim', 'course_instructor_map']), count(*) FROM orders WHERE o_custkey > 0""")
def q_write_bundle(spark, sf):
    root = sinks.scratch(spark)
    captured = _orders_as_captures(spark, sf)
    shots = capture.snapshot_rows(captured.select("fetched_at", "course_id", "locale", F.lit("u").alias("source_url"), F.lit("k").alias("query_key"), F.col("online").alias("payload_json")))
    for rows in sinks.write_bundle(flatten.bundle(captured, shots), root).values():
        rows.unpersist()
    return latest.counts({t: sinks.read_or_empty(spark, root, t) for t in schemas.BUNDLE})


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"t":"' || event_type || '","u":' || user_id || '}' ELSE '{}' END AS payload_json FROM events""")
def q_payload_json(spark, sf):
    made = F.when(F.col("event_id") % 2 == 0, F.struct(F.col("event_type").alias("t"), F.col("user_id").alias("u")))
    return events.payload_to_json(_t(spark, sf, "events").select("event_id", made.alias("payload"))).select("event_id", "payload_json")


@query("SELECT o_orderkey % 2 = 1 AS own, count(*) AS n, count(*) AS n_right, count(*) AS n_different FROM orders GROUP BY 1")
def q_event_uuid(spark, sf):
    """Snapshots keep their own identifier; others get one of version 7 that starts with the row's milliseconds."""
    own = F.when(F.col("o_orderkey") % 2 == 1, F.concat(F.lit("own-"), F.col("o_orderkey").cast("string")))
    rows = _t(spark, sf, "orders").select("o_orderkey", own.alias("uuid"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"))
    made = events.to_events(rows, "course_snapshot_raw").select("event_uuid", F.from_json("payload", "o_orderkey long, uuid string, fetched_at timestamp").alias("p"))
    ms = F.conv(F.replace(F.left("event_uuid", F.lit(13)), F.lit("-")), 16, 10).cast("long")
    fresh = F.col("event_uuid").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$") & (ms == F.unix_millis("p.fetched_at"))
    right = F.when(F.col("p.uuid").isNull(), fresh).otherwise(F.col("event_uuid") == F.col("p.uuid"))
    return made.groupBy((F.col("p.o_orderkey") % 2 == 1).alias("own")).agg(F.count("*").alias("n"), F.count_if(right).alias("n_right"), F.countDistinct("event_uuid").alias("n_different"))


@query("SELECT o_orderstatus AS source, count(*) AS sitemap_index, max(o_orderkey) AS url_index FROM orders GROUP BY o_orderstatus")
def q_checkpoints(spark, sf):
    root = sinks.scratch(spark)
    for source, n, last in _t(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*"), F.max("o_orderkey")).collect():  # a row for each status
        state.append_checkpoint(spark, root, source, 0, 0)
        state.append_checkpoint(spark, root, source, n, last)
    points = latest.latest_by(state.read_checkpoints(spark, root), ["source"], "updated_at", ["sitemap_index", "url_index"])
    return points.select("source", F.col("sitemap_index").cast("long").alias("sitemap_index"), F.col("url_index").cast("long").alias("url_index"))


@query("SELECT o_custkey AS url, coalesce(min(o_orderkey) FILTER (o_orderstatus = 'F'), -1) AS course_id FROM orders GROUP BY o_custkey")
def q_resolve_course_id(spark, sf):
    key = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('["/client/api/v1/course/'), F.col("o_orderkey").cast("string"), F.lit('/online/info"]'))).otherwise('["/other"]')
    found = capture.resolve_course_id(_t(spark, sf, "orders").select(F.col("o_custkey").alias("url"), F.col("o_orderkey").alias("pos"), key.alias("query_key")))
    return found.select("url", F.coalesce("course_id", F.lit(-1)).alias("course_id"))


@query("""
WITH o AS (SELECT *, (o_orderkey + 99) // 100 AS page FROM orders WHERE o_orderkey > 0), s AS (SELECT page, count(*) AS n FROM o GROUP BY page),
e AS (SELECT coalesce(min(page) FILTER (n < 100), max(page)) AS last FROM s)
SELECT * FROM (SELECT o_orderkey AS course_id, 0 AS seq FROM o WHERE page <= (SELECT last FROM e) AND o_orderkey % 2 = 1 ORDER BY page, o_orderkey LIMIT 50)
UNION ALL SELECT doc_id, 1 FROM labels""")
def q_recent_head(spark, sf):
    """At most 50 new courses of the result pages, newest first, ahead of a scan's."""
    item = F.struct("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("slug"))).alias("item"))
    found = _t(spark, sf, "orders").groupBy(F.floor((F.col("o_orderkey") + 99) / 100).cast("long").alias("page")).agg(F.array_sort(F.collect_list(item)).alias("all"))
    body = F.concat(F.lit('{"data":{"items":['), F.array_join(F.transform("all", lambda x: x["item"]), ","), F.lit("]}}"))
    known = _t(spark, sf, "orders").filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("course_id"), F.lit("ko").alias("locale"))
    newest, _ = pipelines.recent_head(found.select("page", body.alias("body")), known, 50)
    return discovery.head_first(newest.select("course_id"), _t(spark, sf, "labels").select(F.col("doc_id").alias("course_id"))).select("course_id", "seq")


def _customers_as_captures(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages, queries, api): a page for each customer, with one cached document, and another from the API."""
    i = (F.col("c_custkey") + 1).cast("string")
    url = F.concat(F.lit("https://www.example.com/course/c"), i, F.lit("?cid="), i)
    c = _t(spark, sf, "customer")
    pages_ = c.select(url.alias("url"), F.timestamp_seconds(F.lit(1_600_000_000) + (F.col("c_custkey") * 37) % 101).alias("fetched_at"))
    online = F.to_json(F.struct(F.struct(F.col("c_name").alias("title"), F.col("c_mktsegment").alias("status")).alias("data")))
    queries_ = c.select(url.alias("url"), F.lit(0).alias("pos"), F.concat(F.lit('["/client/api/v1/course/'), i, F.lit('/online/info"]')).alias("query_key"), online.alias("payload_json"))
    path = F.concat(F.lit("/client/api/v1/course/"), i, F.lit("/meta"))
    api = c.select(url.alias("url"), F.lit("meta").alias("kind"), F.lit(0).alias("api_rank"), path.alias("path"), F.lit('{"data":{"keywords":"k"}}').alias("payload_json"))
    return pages_, queries_, api


@query("""
WITH h AS (SELECT n_nationkey * 5 + 1 AS k FROM nation WHERE (n_nationkey * 5 + 1) % 2 = 1),
s AS (SELECT c_custkey + 1 AS k FROM customer QUALIFY row_number() OVER (ORDER BY c_custkey) <= 1500 - (SELECT count(*) FROM h)),
m AS (SELECT k, (k % 2 = 1 AND k NOT IN (SELECT k FROM h))::INT AS fresh FROM s),
c AS (SELECT *, coalesce(sum(fresh) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m),
t AS (SELECT * FROM c WHERE before < 40 - (SELECT count(*) FROM h))
SELECT 'course' AS kind, k::BIGINT AS id FROM h UNION ALL SELECT 'course', k FROM t WHERE fresh = 1 UNION ALL SELECT 'checkpoint', max(k) FROM t
UNION ALL SELECT 'known', k FROM (SELECT k FROM h UNION ALL SELECT k FROM t WHERE fresh = 1 UNION ALL SELECT c_custkey + 1 FROM customer WHERE c_custkey % 2 = 1)""")
def q_collect_new(spark, sf):
    """40 new courses at most: those of the search page first, then the scan's; the checkpoint and the crawl state after it."""
    root = sinks.scratch(spark)
    captures = _customers_as_captures(spark, sf)
    number = F.col("c_custkey") + 1
    even = _t(spark, sf, "customer").filter("c_custkey % 2 = 1").select(number.alias("course_id"), F.lit("ko").alias("locale"), F.lit("u").alias("source_url"), F.timestamp_seconds(F.lit(1)).alias("fetched_at"), F.lit(0).alias("seq"))
    state.append_state(spark, root, even)
    loc = F.concat(F.lit("<loc>https://www.example.com/course/c"), number.cast("string"), F.lit("?cid="), number.cast("string"), F.lit("</loc>"))
    all_ = _t(spark, sf, "customer").groupBy(F.floor(F.col("c_custkey") / 10_000).cast("int").alias("sitemap_index")).agg(F.array_sort(F.collect_list(F.struct("c_custkey", loc.alias("x")))).alias("all"))
    body = F.concat(F.lit("<u>"), F.array_join(F.transform("all", lambda s: s["x"]), ""), F.lit("</u>"))
    responses = all_.select("sitemap_index", F.lit(0).alias("base_rank"), F.lit(200).alias("status"), body.alias("body"))
    item = F.to_json(F.struct((F.col("n_nationkey") * 5 + 1).alias("id"), F.lit("s").alias("slug")))
    found = _t(spark, sf, "nation").agg(F.concat(F.lit('{"data":{"items":['), F.array_join(F.collect_list(item), ","), F.lit("]}}")).alias("body")).select(F.lit(1).alias("page"), "body")
    # Pages of the search name other addresses than the captures; an address is known by its course.
    pages_, queries_, api = captures
    search_url = lambda df: df.unionByName(df.withColumn("url", F.regexp_replace("url", "/course/c[0-9]+", "/course/s")))
    written, _, end = pipelines.run_collect_new(spark, root, responses, found, search_url(pages_), search_url(queries_), search_url(api), batch=40)
    point = spark.range(1).select(F.lit("checkpoint").alias("kind"), F.lit(end[0] * 10_000 + end[1]).cast("long").alias("id"))
    courses = documents.read_table(spark, f"{root}/course_dim", ["course_id"]).select(F.lit("course").alias("kind"), F.col("course_id").alias("id"))
    for rows in written.values():
        rows.unpersist()
    return courses.unionByName(point).unionByName(state.read_state_table(spark, root).select(F.lit("known").alias("kind"), F.col("course_id").alias("id")))


@query("""
SELECT c_custkey + 1 AS course_id, c_name AS title, 100 AS picked FROM customer ORDER BY (c_custkey * 37) % 101, c_custkey LIMIT 100""")
def q_refresh_existing(spark, sf):
    """The 100 stalest courses anew, and the progress stored."""
    root = sinks.scratch(spark)
    captures = _customers_as_captures(spark, sf)
    sinks.append_table(captures[0].select("fetched_at", F.regexp_extract("url", "cid=([0-9]+)", 1).cast("long").alias("course_id"), F.lit("ko").alias("locale"), F.col("url").alias("source_url"), F.lit("OK").alias("status_code")), root, "course_snapshot_raw")
    written, _, _ = pipelines.run_refresh_existing(spark, root, *captures, limit=100)
    for rows in written.values():
        rows.unpersist()
    picked = state.latest_checkpoint(state.read_checkpoints(spark, root), pipelines.UPDATE)[1]
    return documents.read_table(spark, f"{root}/course_dim", ["course_id", "title"]).withColumn("picked", F.lit(picked))


@query("SELECT c_mktsegment AS status, count(*) AS n, sum(c_custkey + 1)::BIGINT AS ids, count(*) AS n_states FROM customer GROUP BY c_mktsegment")
def q_collect_urls(spark, sf):
    root = sinks.scratch(spark)
    captures = _customers_as_captures(spark, sf)
    written = pipelines.run_collect_urls(spark, root, captures[0].select(F.concat(F.lit(" "), F.col("url"), F.lit(",\n")).alias("value")), *captures)
    for rows in written.values():
        rows.unpersist()
    states = state.read_state_table(spark, root).select("course_id", "locale")
    dims = documents.read_table(spark, f"{root}/course_dim", ["course_id", "locale", "status"])
    joined = dims.join(states.withColumn("_s", F.lit(1)), ["course_id", "locale"], "left")
    return joined.groupBy("status").agg(F.count("*").alias("n"), F.sum("course_id").alias("ids"), F.count("_s").alias("n_states"))


def _display_sql(target: str, script: str, limit: int, done: str) -> str:
    one = SQL["q_backlog_whole"].replace("[А-Яа-яЁёІіЇїЄєҐґ]", f"[{text.SCRIPTS[script]}]").replace("LIMIT 100", f"LIMIT {limit}")
    one = one.replace("SELECT doc_id // 2 FROM labels WHERE quality = 1", done)
    return f"SELECT '{target}' AS target_language, course_id, 'T' AS title FROM ({one})"


@query(_display_sql("ru", "cyrillic", 12, "SELECT doc_id // 2 FROM labels WHERE quality = 1") + " UNION ALL " + _display_sql("ar", "arabic", 8, "SELECT -1"))
def q_translate_display(spark, sf):
    """Twelve courses for the first target and what is left of a quota of twenty for the second."""

    def speak(asked):
        import json

        return [json.dumps({"choices": [{"message": {"content": json.dumps({"title": "T"})}}]}) for _ in asked]

    nothing = {t: spark.createDataFrame([], schemas.schema(t)) for t in ("course_curriculum_unit", "curriculum_display_translation")}
    rows, _, _ = pipelines.translate_display(_dim(spark, sf, WHOLE), nothing["course_curriculum_unit"], _done(spark, sf), nothing["curriculum_display_translation"], ["ru", "ar"], speak, most=20)
    return rows.select("target_language", "course_id", "title")


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 0 AS waiting FROM supplier")
def q_drain_outbox(spark, sf):
    """All chunks of suppliers, about 100 rows each, written by as many runs of the drain as 50 chunks a run take, and how
    many wait afterwards."""
    root = sinks.scratch(spark)
    rows = _t(spark, sf, "supplier")
    none = spark.createDataFrame([], schemas.schema("insert_outbox"))
    box = outbox.enqueue(outbox.chunked(rows, rows.columns, ["s_suppkey"]), none, "db", "supplier", rows.columns, "timeout")
    writers = {"supplier": lambda df: df.write.mode("append").parquet(f"{root}/supplier")}
    run, done = 0, 1
    while done:
        box.write.parquet(f"{root}/insert_outbox-{run}")
        kept = spark.read.schema(schemas.schema("insert_outbox")).parquet(f"{root}/insert_outbox-{run}")
        box, done, _ = pipelines.drain_outbox_job(spark, kept, writers, {"supplier": rows.schema})
        run += 1
    return spark.read.parquet(f"{root}/supplier").withColumn("waiting", F.lit(outbox.pending(kept, None).count()))


# Commits, incremental state, deliveries and the event log


def _with_curriculum(captured: DataFrame) -> DataFrame:
    """A section and a unit for each course."""
    unit = F.struct((F.col("course_id") * 2).alias("id"), F.lit("u<1>").alias("title"), F.lit("LECTURE").alias("type"), (F.col("course_id") % 1000).alias("runtime"), (F.col("course_id") % 2 == 0).alias("isPreview"), F.when(F.col("course_id") % 3 == 0, F.col("course_id")).alias("quizId"))
    section = F.struct(F.col("course_id").alias("id"), F.lit("s").alias("title"), F.array(unit).alias("units"))
    return captured.withColumn("curriculum", F.to_json(F.struct(F.struct(F.array(section).alias("curriculum")).alias("data"))))


@query("""
SELECT 'failed' AS step, unnest(['course_dim', 'course_price_fact', 'course_curriculum_unit']) AS table_name, 0 AS n
UNION ALL SELECT 'retried', unnest(['course_dim', 'course_price_fact']), count(*) FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT 'retried', 'course_curriculum_unit', count(*) FROM orders""")
def q_bundle_commit(spark, sf):
    """A bundle whose last table fails leaves nothing to read; its retry makes all tables visible at once."""
    root = sinks.scratch(spark)
    made = flatten.bundle(_with_curriculum(_orders_as_captures(spark, sf)), spark.createDataFrame([], schemas.schema("course_snapshot_raw")))
    names = ("course_dim", "course_price_fact", "course_curriculum_unit")
    bundle = flatten.Bundle({t: made[t] for t in names})
    bundle.shared = made.shared
    broken = flatten.Bundle(bundle | {names[2]: bundle[names[2]].withColumn("unit_title", F.when(F.col("course_id") >= 0, F.raise_error(F.lit("target is down"))))})
    count = lambda step: latest.counts({t: sinks.read_or_empty(spark, root, t) for t in names}).withColumn("step", F.lit(step))
    try:
        sinks.write_bundle(broken, root, "orders")
        raise AssertionError("the bundle is broken")
    except PySparkException:
        failed = spark.createDataFrame(count("failed").collect(), "table_name string, n long, step string")  # a row a table
    sinks.write_bundle(bundle, root, "orders")
    return failed.unionByName(count("retried")).select("step", "table_name", "n")


@query(f"""SELECT o_orderkey AS course_id, o_orderkey * 2 AS unit_id, (SELECT {_H64} FROM (SELECT sha256('[' || o_orderkey || ',"s",' || o_orderkey * 2 || ',"u\\u003c1\\u003e","LECTURE",' || o_orderkey % 1000 || ',' ||
  CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END || ',0,0,' || CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey::VARCHAR ELSE 'null' END || ',null,0]') AS h)) AS unit_hash FROM orders""")
def q_unit_hash(spark, sf):
    units = flatten.curriculum_units(_with_curriculum(_orders_as_captures(spark, sf)))
    return units.select("course_id", "unit_id", F.col("unit_hash").cast("string").alias("unit_hash"))


@query("""
SELECT step, user_id, event_type, value, last_ms FROM (VALUES ('merged'), ('compacted')) AS s(step), (
  SELECT user_id, event_type, value, epoch_us(ts) // 1000 AS last_ms FROM events WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)""")
def q_keyed_state(spark, sf):
    """Users' latest events, appended in three deltas: read as a base and a delta, and again from a new base."""
    schema = T.StructType.fromDDL("user_id long, ts timestamp, event_id long, event_type string, value double")
    table = keyed.KeyedTable(spark, f"{sinks.scratch(spark)}/users", schema, ["user_id"], "ts")
    rows = _t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for k in range(3):
        table.append(rows.filter(F.pmod("event_id", F.lit(3)) == k), f"delta-{k}")
        if k == 1:
            table.compact()
    merged = table.read()
    table.compact()
    both = merged.withColumn("step", F.lit("merged")).unionByName(table.read().withColumn("step", F.lit("compacted")))
    return both.select("step", "user_id", "event_type", "value", _ms("ts").alias("last_ms"))


@query("SELECT c_custkey, c_name, 1::BIGINT AS times FROM customer")
def q_delivery(spark, sf):
    """Customers sent in chunks, of which some fail at first; what failed is sent again, what was sent is not, though the
    whole delivery is repeated. How often each row arrives."""
    root = sinks.scratch(spark)

    def receive(lines):
        import hashlib

        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(f"{root}/received")
        store.create_dir(path, recursive=True)
        with store.open_append_stream(f"{path}/{hashlib.sha256(lines.encode()).hexdigest()}.json") as f:
            f.write(lines.encode() + b"\n")

    def flaky(lines):
        if '7,"c_name"' in lines.split("\n")[0]:
            raise RuntimeError("timeout")
        receive(lines)

    rows = _t(spark, sf, "customer").select("c_custkey", "c_name")
    chunks = outbox.chunked(rows, rows.columns, ["c_custkey"])
    first = ledger.deliver(chunks, flaky, root, "first")
    failed = first.filter("step = 'failed'").select("payload_hash")
    late = chunks.withColumn("payload_hash", F.col("payload_hash").cast("string")).join(failed, "payload_hash")
    ledger.deliver(late, receive, root, "second")
    ledger.deliver(chunks, receive, root, "first")
    return spark.read.schema("c_custkey long, c_name string").json(f"{root}/received").groupBy("c_custkey", "c_name").agg(F.count("*").alias("times"))


@query(SQL["q_events"].replace("SELECT 'shop.orders.v1'", "SELECT true AS in_place, 'shop.orders.v1'").replace("SELECT 'shop.customer.v1'", "SELECT true, 'shop.customer.v1'"))
def q_event_log(spark, sf):
    """The events of ``q_events`` written to the log, twice under one commit, and read back from it; ``in_place`` tells
    whether an event lies in its key's partition."""
    root = sinks.scratch(spark)
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("u"), F.col("o_orderkey").cast("string"))).alias("source_url"))
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.timestamp_seconds(F.lit(1_600_000_000)).alias("updated_at"))
    framed = events.kafka_frame(events.bundle_events({"orders": o, "customer": c}, namespace="shop"))
    for _ in range(2):
        event_sink.write_events(framed, root, commit_id="all")
    e = event_sink.read_events(spark, root).withColumn("e", F.from_json("value", "event_type string, url string, payload string, created_at string"))
    in_place = F.col("partition") == event_sink.partition_of(F.col("key"), 8)
    return e.select(in_place.alias("in_place"), "e.event_type", F.when(F.col("e.url") == "", "by id").otherwise(F.col("key")).alias("key"), F.get_json_object("e.payload", "$.k").cast("long").alias("payload_key"), "e.created_at")


_SCRIPT_OF = {"ru": "cyrillic", "ar": "arabic", "hi": "devanagari", "th": "thai"}


@query(" UNION ALL ".join(_display_sql(t, s, 15, "SELECT doc_id // 2 FROM labels WHERE quality = 1" if t == "ru" else "SELECT -1").replace("course_id, 'T' AS title", "course_id, locale, title") for t, s in _SCRIPT_OF.items()))
def q_backlog_targets(spark, sf):
    """What lacks a translation in each of four languages, from one scan."""
    return backlog.backlog_of_targets(_dim(spark, sf, WHOLE), _done(spark, sf), list(_SCRIPT_OF), 15).select(F.col("target").alias("target_language"), "course_id", "locale", "title")


@query(SQL["q_backlog_whole"].replace("WHERE locale IN ('ko', 'en')", "WHERE locale IN ('ko', 'en') AND doc_id // 2 IN (SELECT n_nationkey * 7 FROM nation WHERE n_nationkey > 0)"))
def q_backlog_ids(spark, sf):
    """The backlog of an explicit list of courses, which comes as a text."""
    said = _t(spark, sf, "nation").agg(F.concat(F.array_join(F.collect_list((F.col("n_nationkey") * 7).cast("string")), ", "), F.lit(", x, 7"))).first()[0]
    ids = spark.range(1).select(text.id_list(F.lit(said)).alias("ids")).first()["ids"]
    return backlog.translation_backlog(_dim(spark, sf, WHOLE), _done(spark, sf), "ru", 100, ids)


@query("SELECT 'ru' AS target_language, course_id, section_id, unit_id, section_title, 'U' AS unit_title, locale AS source_locale FROM (" + SQL["q_unit_backlog"].replace("LIMIT 200", "LIMIT 12") + ")")
def q_unit_translations(spark, sf):
    """Units translated end to end: twelve of the backlog, each asked once; blank section titles stay the source's."""

    def speak(asked):
        import json

        return [json.dumps({"choices": [{"message": {"content": json.dumps({"unit_title": " U ", "section_title": ""})}}]}) for _ in asked]

    c = F.col
    locale = F.when(c("l_returnflag") == "A", "ko").when(c("l_returnflag") == "N", "en").otherwise("ja")
    units = _t(spark, sf, "lineitem").select(
        c("l_orderkey").alias("course_id"), c("l_linenumber").cast("long").alias("section_id"), c("l_partkey").alias("unit_id"), locale.alias("locale"), c("l_shipdate").cast("timestamp").alias("fetched_at"),
        c("l_linestatus").alias("section_title"), F.concat("l_returnflag", "l_linestatus").alias("unit_title"), "l_quantity",
    )
    done = units.filter("l_quantity > 25").select("course_id", "section_id", "unit_id", F.lit("ru").alias("target_language"), F.lit("success").alias("generation_status"))
    nothing = {t: spark.createDataFrame([], schemas.schema(t)) for t in ("course_dim", "course_display_translation")}
    _, rows, _ = pipelines.translate_display(nothing["course_dim"], units, nothing["course_display_translation"], done, ["ru"], speak)
    return rows.select("target_language", "course_id", "section_id", "unit_id", "section_title", "unit_title", "source_locale")


# The scan as a stream, replay in one job, identifiers that survive a retry, existence by a filter


@query("""
WITH s AS (SELECT url, page_id, page_id // 50 AS i, page_id % 50 AS j FROM pages), f AS (
  SELECT * FROM s WHERE url NOT IN (SELECT url FROM s WHERE page_id IN (SELECT doc_id FROM labels WHERE quality = 1)) QUALIFY row_number() OVER (PARTITION BY url ORDER BY i, j) = 1)
SELECT 'found' AS kind, i, j FROM f UNION ALL SELECT 'checkpoint', 0, 10 UNION ALL SELECT 'checkpoint', p.i, p.j + 1 FROM (SELECT max({'i': i, 'j': j}) AS p FROM s)""")
def q_scan_stream(spark, sf):
    """All pages scanned by a stream that admits ten URLs, ends, and starts again for the rest: the new URLs, and the
    checkpoint after each batch."""
    root = sinks.scratch(spark)
    p = _t(spark, sf, "pages").select(F.floor(F.col("page_id") / 50).alias("sitemap_index"), (F.col("page_id") % 50).alias("url_index"), "url", "page_id")
    scan.add_sitemaps(p.select("sitemap_index", "url_index", "url"), f"{root}/sitemaps")
    known = p.join(_t(spark, sf, "labels").filter("quality = 1").select(F.col("doc_id").alias("page_id")), "page_id").select("url")
    for most in (10, 10_000_000):
        scan.start_scan(spark, f"{root}/sitemaps", root, f"{root}/_scan", lambda s: known, ["url"], "pages", max_scan=most, once=True).awaitTermination()
    found = scan.read_found(spark, root).select(F.lit("found").alias("kind"), F.col("sitemap_index").cast("long").alias("i"), F.col("url_index").cast("long").alias("j"))
    points = state.read_checkpoints(spark, root).select(F.lit("checkpoint").alias("kind"), F.col("sitemap_index").cast("long").alias("i"), F.col("url_index").cast("long").alias("j"))
    return found.unionByName(points)


@query("""
SELECT c_custkey, CASE WHEN before > 0 THEN 'waits' WHEN c_acctbal > 9000 THEN 'timeout' WHEN c_acctbal < 0 THEN 'refused' ELSE 'written' END AS outcome, CASE WHEN before > 0 THEN 0 ELSE 1 END AS attempts FROM (
  SELECT *, coalesce(sum((c_acctbal > 9000)::INT) OVER (PARTITION BY c_nationkey ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM customer)""")
def q_replay_in_order(spark, sf):
    """A chunk for each customer, replayed in one job to a target for each nation; targets stop at their first timeout."""
    root = sinks.scratch(spark)
    c = _t(spark, sf, "customer")
    none = F.lit(None).cast("timestamp")
    box = c.select(
        F.col("c_custkey").cast("string").alias("outbox_uuid"), F.timestamp_seconds("c_custkey").alias("created_at"), F.lit("db").alias("target_database"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("target_table"),
        F.array(F.lit("c_acctbal")).alias("target_columns"), F.to_json(F.struct("c_acctbal")).alias("rows_json"), F.lit(1).alias("row_count"), F.xxhash64("c_custkey").cast("decimal(20,0)").alias("payload_hash"),
        F.lit("timeout").alias("source_error"), F.lit(0).alias("replay_attempt"), none.alias("last_replay_at"), none.alias("replayed_at"), F.lit("").alias("replay_error"),
    )

    def send(table, lines):
        import json

        balance = json.loads(lines)["c_acctbal"]
        if balance > 9000:
            raise RuntimeError("i/o timeout")
        if balance < 0:
            raise ValueError("Code: 60. Table does not exist")

    marked, _ = ledger.replay(box, send, root, None)
    outcome = F.when(F.col("replay_attempt") == 0, "waits").when(F.col("replayed_at").isNotNull(), "written").when(outbox.is_temporary(F.col("replay_error")), "timeout").otherwise("refused")
    return marked.select(F.col("outbox_uuid").cast("long").alias("c_custkey"), outcome.alias("outcome"), F.col("replay_attempt").cast("int").alias("attempts"))


@query("SELECT l_returnflag, count(*) AS n, count(*) AS n_different, count(*) AS n_again FROM lineitem GROUP BY l_returnflag")
def q_event_ids(spark, sf):
    """Lines as events, whose many equal rows differ by identifier, made twice from rows that are dealt differently; how
    many identifiers come again."""
    rows = _t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_shipdate").cast("timestamp").alias("fetched_at"))
    flag = F.get_json_object("payload", "$.l_returnflag").alias("l_returnflag")
    made = lambda df, first, again: events.to_events(df, "lines", id_key="secret").select("event_uuid", flag, F.lit(first).alias("first"), F.lit(again).alias("again"))
    both = made(rows, 1, 0).unionByName(made(rows.repartition(13), 0, 1))
    ids = both.groupBy("event_uuid", "l_returnflag").agg(F.sum("first").alias("first"), F.sum("again").alias("again")).filter("first > 0")  # one shuffle for both
    return ids.groupBy("l_returnflag").agg(F.sum(F.col("first") * F.greatest("again", F.lit(1))).alias("n"), F.count("*").alias("n_different"), F.sum(F.col("first") * F.col("again")).alias("n_again"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_orderkey * 10 + l_linenumber NOT IN (SELECT o_orderkey * 10 + o_custkey % 7 FROM orders)")
def q_new_by_filter(spark, sf):
    """Lines whose (order, number) no order has with its customer's number: most are new, and these do not shuffle."""
    lines = _t(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_suppkey")
    known = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 7).cast("long").alias("l_linenumber"))
    return existence.new_rows(lines, known, ["l_orderkey", "l_linenumber"])


@query("SELECT i AS sitemap_index, row_number() OVER (PARTITION BY i ORDER BY page_id) - 1 AS url_index, url FROM (SELECT page_id // 50 AS i, * FROM pages) WHERE i % 3 < 2")
def q_sitemap_files(spark, sf):
    """Pages written as sitemaps in gzip files, line by line, and read back as files: those that an index of two indexes
    leads to, two thirds of all."""
    folder = f"{sinks.scratch(spark)}/sitemaps"
    c = F.col
    name = F.concat(F.lit("m"), F.floor(c("page_id") / 50).cast("string"))
    one = lambda tag, loc: F.concat(F.lit(f"<{tag}><loc>"), F.replace(loc, F.lit("&"), F.lit("&amp;")), F.lit(f"</loc></{tag}>"))
    pages_ = _t(spark, sf, "pages").select(name.alias("sitemap"), c("page_id").alias("k"), one("url", c("url")).alias("value"))
    maps = pages_.select("sitemap").distinct().withColumn("i", F.substring("sitemap", 2, 20).cast("long"))
    part = F.concat(F.lit("index"), (c("i") % 3).cast("string"))
    nested = maps.select(part.alias("sitemap"), c("i").alias("k"), one("sitemap", F.concat(F.lit("https://maps/"), "sitemap")).alias("value"))
    top = spark.range(2).select(F.lit("index").alias("sitemap"), c("id").alias("k"), one("sitemap", F.concat(F.lit("https://maps/index"), c("id").cast("string"))).alias("value"))
    rows = pages_.unionByName(nested).unionByName(top)
    root = F.when(c("sitemap").startswith("index"), "sitemapindex").otherwise("urlset")
    ends = rows.select("sitemap").distinct().select("sitemap", F.explode(F.array(F.struct(F.lit(-1).cast("long").alias("k"), F.concat(F.lit("<"), root, F.lit(">")).alias("value")), F.struct(F.lit(1 << 62).alias("k"), F.concat(F.lit("</"), root, F.lit(">")).alias("value")))).alias("e"))
    lined = rows.unionByName(ends.select("sitemap", "e.*")).repartition("sitemap").sortWithinPartitions("sitemap", "k")
    lined.select("sitemap", "value").write.partitionBy("sitemap").option("compression", "gzip").text(folder)
    captured = rows.select("sitemap").distinct().select(F.concat(F.lit("https://maps/"), "sitemap").alias("url"), "sitemap")
    found, _ = sitemap_files.walk(spark, folder, captured, ["https://maps/index"], F.regexp_extract("_metadata.file_path", "sitemap=([^/]+)/", 1))
    return found.select(F.substring("sitemap", 2, 20).cast("long").alias("sitemap_index"), c("url_index").cast("long").alias("url_index"), "url")
