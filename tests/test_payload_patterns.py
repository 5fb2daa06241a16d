"""Cached queries are told by patterns that are the same for all rows."""

from catalog_spark.operators import capture


def test_one_pattern_for_all_rows(spark):
    online, found = "/client/api/v1/course/{}/online/info", "/client/api/v1/discounts/best?courseIds={}"
    keys = [
        (0, online.format(123), "longer"), (1, online.format(12) + "7", "goes on"), (2, online.format(5) + online.format(12), "second of two"),
        (3, online.format(12), "late"), (4, found.format(123), "longer"), (5, found.format(12) + "&x=12", "ends"), (6, None, "no key"),
        (7, found.format("012"), "zero"), (8, "/client/api/v2/courses/12/curriculums", None), (9, "/client/api/v1/course/12/metas", "letter"),
    ]
    rows = spark.createDataFrame([("u", 12, *k) for k in keys] + [("n", -5, 0, online.format(-5), "below")], "url string, course_id long, pos int, query_key string, payload_json string")
    told = capture.find_payloads(rows)
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE(" not in plan.upper() or "concat(" not in plan
    got = {r["url"]: r.asDict() for r in told.collect()}
    assert got["u"] == {"url": "u", "course_id": 12, "online": "second of two", "meta": "letter", "curriculum": None, "discounts": "ends", "contents": None}
    assert got["n"]["online"] == "below"
