"""Fixed vectors of the scalar functions, and payloads with wrong kinds."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from catalog_spark.functions import coerce, hashing, links, text, times
from catalog_spark.operators import backlog, events, flatten, outbox
from catalog_spark.sources import pages, search, sitemaps


def one(spark, column, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v))
    return df.select(column).first()[0]


def test_locale_from_url(spark):
    host = "https://www.example.com"
    cases = {"/course/r?cid=1": "ko", "/en/course/r?cid=1": "en", "/ja/course/r": "ja", "/zh-Hans/course/r": "zh-Hans", "/pt-BR/course/r": "pt-BR", "/course/r?cid=1&locale=ja": "ja"}
    for tail, want in cases.items():
        assert one(spark, links.locale_from_url(F.lit(host + tail))) == want
    assert one(spark, links.course_id_from_url(F.lit(f"{host}/x?cid=&courseId=12&course_id=3"))) == 12
    assert one(spark, links.course_id_from_url(F.lit(None).cast("string"))) == 0


def test_search_hits(spark):
    items = [{"id": 342604, "course": {"slug": "mastering-en"}}, {"course": {"id": 342533, "slug": "무료 타입"}}, {"id": "341961", "course": {"url": "/course/guide"}}, {"id": 0}, {"id": 5}, [1]]
    got = search.search_hits(spark.createDataFrame([(1, json.dumps({"data": {"items": items}}))], "page int, body string")).orderBy("pos").collect()
    base = "https://www.example.com/course/"
    assert [r["url"] for r in got] == [f"{base}mastering-en?cid=342604", f"{base}%EB%AC%B4%EB%A3%8C%20%ED%83%80%EC%9E%85?cid=342533", f"{base}guide?cid=341961"]
    assert search.search_hits(spark.createDataFrame([(1, "broken")], "page int, body string")).count() == 0


def test_search_url(spark):
    got = one(spark, links.search_url(F.lit(2)))
    for part in ("pageNumber=2", "pageSize=100", "sort=RECENT", "types=ONLINE", "isBot=false"):
        assert part in got


def test_temporary_errors(spark):
    cases = [("Code: 242. Table is in readonly mode (TABLE_IS_READ_ONLY)", True), ("Code: 667. Table is not initialized yet.", True), ("KEEPER_EXCEPTION Coordination error", True), ("Code: 210. Connection refused", True), ("context deadline exceeded", True), ("Code: 60. Table does not exist", False), ("Code: 497. Not enough privileges", False)]
    for message, want in cases:
        assert one(spark, outbox.is_temporary(F.lit(message))) is want
    assert one(spark, outbox.retry_reason(F.lit("not the leader for some partition"))) == "leader-metadata-stale"
    assert one(spark, outbox.is_retryable(F.lit("permission denied"))) is False


def test_levels_ids_and_languages(spark):
    assert one(spark, text.localize_level(F.lit("ko"), F.lit("Beginner"))) == "초급"
    assert one(spark, text.localize_level(F.lit("zh-TW"), F.lit("Advanced"))) == "高級"
    assert one(spark, text.id_list(F.lit("324573, 324573, bad, 0, 326644"))) == [324573, 326644]
    assert [one(spark, text.language_code(F.lit(x))) for x in ("zh-HK", "zh", "pt-PT", "tl", "EN-us", "xx", "")] == ["zh-Hant", "zh-Hans", "pt-BR", "fil", "en", "", ""]


def test_native(spark):
    assert one(spark, text.is_native("ko", F.lit("한국어 강의"), F.lit("한국어 강의 설명"))) is True
    assert one(spark, text.is_native("ko", F.lit("한국어 강의"), F.lit("かな"))) is False
    assert one(spark, text.is_native("ru", F.lit("Курс"), F.lit(""))) is True


def test_coercion(spark):
    v = F.try_parse_json(F.lit('{"a":"12","b":1.9,"c":true,"d":1,"e":"1.9","f":null,"g":" YES ","h":{"x":1},"l":["a",""," ",3]}'))
    assert [one(spark, coerce.as_int(v, f"$.{k}")) for k in "abcdefh"] == [12, 1, 1, 1, 1, 0, 0]
    assert [one(spark, coerce.to_u8(v, f"$.{k}")) for k in "cdgf"] == [1, 0, 1, 0]
    assert one(spark, coerce.string_array(v, "$.l")) == ["a", "3"]
    assert one(spark, coerce.as_string(v, "$.zz")) == ""
    assert one(spark, coerce.nullable_int(v, "$.f")) is None


def test_hash_and_times(spark):
    assert one(spark, hashing.h64(F.lit("abc"))) == Decimal("16919744041952114874")
    good = ["2024-01-01 10:00:00", "2024-01-01 10:00:00.000", "2024-01-01T01:00:00Z", " 2024-01-01T10:00:00.0009+09:00 "]
    assert {one(spark, times.format_ts(times.parse_ts(F.lit(x)))) for x in good} == {"2024-01-01 10:00:00.000"}
    assert one(spark, times.parse_ts(F.lit("2024-01-01"))) is None
    uuid = one(spark, hashing.uuid7(F.timestamp_seconds(F.lit(1_600_000_000))))
    assert uuid[14] == "7" and uuid[19] in "89ab" and int(uuid.replace("-", "")[:12], 16) == 1_600_000_000_000 and len(uuid) == 36


def test_sitemaps(spark):
    body = '﻿  <?xml version="1.0"?><s:urlset xmlns:s="urn:x"><s:url><s:LOC> https://a </s:LOC></s:url><loc></loc><loc>b</loc></s:urlset>'
    assert one(spark, sitemaps.locs(F.lit(body))) == ["https://a", "b"]
    assert one(spark, sitemaps.locs(F.lit("<a><loc>x</a>"))) == []
    assert one(spark, sitemaps.is_denied(F.lit("<Error><Code>AccessDenied</Code></Error>"))) is True
    assert one(spark, sitemaps.is_denied(F.lit("<u><loc>x</loc></u>"))) is False


def test_embedded_state(spark):
    html = '<script id="__NEXT_DATA__">[1]</script><script>window.__NEXT_DATA__ = {"a": 7};</script>'
    assert one(spark, coerce.as_int(pages.embedded_state(F.lit(html)), "$.a")) == 7
    assert one(spark, pages.embedded_state(F.lit("<p>none</p>")).isNull()) is True


def test_payload_json(spark):
    df = spark.sql("SELECT 'u' AS uuid, named_struct('statusCode', 'OK') AS payload, 42 AS payload_hash")
    got = events.payload_to_json(df)
    assert "payload" not in got.columns and got.first()["payload_json"] == '{"statusCode":"OK"}'


def test_flatten_defaults(spark):
    online = {"data": {"title": "t", "levels": [{"code": "x", "isActive": 0}, {"code": " ", "title": "Mid", "isActive": "true"}], "paymentInfo": {"discountRate": 0, "discount": {"endedAt": " "}}}}
    row = (1, "ko", json.dumps(online), json.dumps({"data": {}}), json.dumps({"data": {"curriculum": [{"id": 1, "units": [{"id": 2, "isPreview": 1, "quizId": ""}, 5]}, "no"]}}), json.dumps({"data": {"discountRate": 130}}), None)
    df = spark.createDataFrame([row, (2, "ko", json.dumps(online), None, None, None, "[]")], "course_id long, locale string, online string, meta string, curriculum string, discounts string, contents string").withColumn("fetched_at", F.current_timestamp())
    dim, metric, units = flatten.course_dim(df).collect(), flatten.course_metric(df).collect(), flatten.curriculum_units(df).orderBy(F.desc("unit_id")).collect()
    assert len(dim) == 1 and dim[0]["level_code"] == "Mid" and dim[0]["category_slugs"] == []
    assert metric[0]["discount_rate"] == 100 and metric[0]["discount_ended_at"] is None
    assert [(u["unit_id"], u["is_preview"], u["quiz_id"]) for u in units] == [(2, 0, None), (0, 0, None)]
    assert flatten.instructors(df).count() == 0


def test_source_rank(spark):
    assert [one(spark, backlog.source_rank(t, F.lit(x))) for t, x in (("en", "en"), ("en", "ko"), ("fr", "ko"), ("fr", "ja"))] == [0, 1, 0, 9]
