"""Jobs end to end on a small catalogue, the outbox, the state and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from catalog_spark import schemas
from catalog_spark.operators import events, latest, outbox, sinks, state
from catalog_spark.plans import pipelines
from catalog_spark.streaming import ingest

HOST = "https://www.example.com"


def url(i):
    return f"{HOST}/course/c{i}?cid={i}"


@pytest.fixture(scope="module")
def captures(spark):
    pages, queries, api = [], [], []
    for i in range(1, 9):
        pages.append((url(i), 1_600_000_000 + i))
        online = json.dumps({"data": {"title": f"강의 {i} 한국어", "status": "PUBLISH"}})
        queries.append((url(i), 0, f'["/client/api/v1/course/{i}/online/info"]', online))
        queries.append((url(i), 1, f'["/client/api/v1/course/{i}9/meta"]', '{"data":{"keywords":"wrong"}}'))
        api.append((url(i), "meta", 0, f"/client/api/v1/course/{i}/meta", '{"data":{"keywords":"k"}}'))
        api.append((url(i), "online", 0, f"/client/api/v1/course/{i}/online/info", '{"data":{}}'))
    pages.append((f"{HOST}/course/none", 1))
    p = spark.createDataFrame(pages, "url string, s long").select("url", F.timestamp_seconds("s").alias("fetched_at"))
    return p, spark.createDataFrame(queries, "url string, pos int, query_key string, payload_json string"), spark.createDataFrame(api, "url string, kind string, api_rank int, path string, payload_json string")


def test_flattened_bundle(captures):
    bundle, errors = pipelines.flattened(*captures)
    dims = bundle["course_dim"].orderBy("course_id").collect()
    assert [d["course_id"] for d in dims] == list(range(1, 9)) and {d["keywords"] for d in dims} == {"k"}
    assert bundle["course_snapshot_raw"].count() == 8 * 3
    assert [r["url"] for r in errors.collect()] == [f"{HOST}/course/none"]
    assert list(bundle) == list(schemas.BUNDLE)


def test_collect_new(spark, captures):
    body = "<u>" + "".join(f"<loc>{url(i)}</loc>" for i in range(1, 6)) + "</u>"
    responses = spark.createDataFrame([(1, 0, 403, ""), (1, 1, 200, body), (2, 0, 404, ""), (2, 1, 404, "")], "sitemap_index int, base_rank int, status int, body string")
    found = spark.createDataFrame([(1, json.dumps({"data": {"items": [{"id": 8, "slug": "c8"}, {"id": 2, "slug": "c2"}]}}))], "page int, body string")
    known = spark.createDataFrame([(2, "ko")], "course_id long, locale string")
    bundle, errors, point = pipelines.collect_new(responses, found, known, (1, 0), *captures, batch=3)
    assert sorted(r["course_id"] for r in bundle["course_dim"].collect()) == [1, 3, 8]
    assert tuple(point.first()) == (1, 3)
    with pytest.warns(UserWarning, match="newest courses left out"):  # a head that fails is no more than a warning
        bundle, errors, point = pipelines.collect_new(responses, found.select("page"), known, (1, 0), *captures, batch=50)
    assert sorted(r["course_id"] for r in bundle["course_dim"].collect()) == [1, 3, 4, 5]
    bundle, errors, point = pipelines.collect_new(responses, found, known, (1, 0), *captures, batch=50)
    assert sorted(r["course_id"] for r in bundle["course_dim"].collect()) == [1, 3, 4, 5, 8]
    assert tuple(point.first()) == (0, 0)


def test_refresh_and_lists(spark, captures):
    bundle, _ = pipelines.flattened(*captures)
    again, errors, picked = pipelines.refresh_existing(bundle["course_snapshot_raw"], *captures, limit=2)
    assert [r["course_id"] for r in picked.orderBy("course_id").collect()] == [1, 2]
    assert again["course_dim"].count() == 2 and errors.count() == 0
    listed = pipelines.collect_urls(spark.createDataFrame([(f" {url(3)},\n{url(4)} ",)], "value string"), *captures)
    assert sorted(r["course_id"] for r in listed["course_dim"].collect()) == [3, 4]
    with pytest.raises(ValueError):
        pipelines.collect_urls(spark.createDataFrame([(f"{HOST}/course/none",)], "value string"), *captures)
    with pytest.raises(ValueError):
        pipelines.collect_urls(spark.createDataFrame([(" ,",)], "value string"), *captures)


def test_translate_display(spark, captures, tmp_path):
    """Each row is asked once, no more than the quota and the failures are, and only successes use the quota."""
    bundle, _ = pipelines.flattened(*captures)
    none = [spark.createDataFrame([], schemas.schema(t)) for t in ("course_display_translation", "curriculum_display_translation")]
    log = str(tmp_path / "asked")

    def speak(asked):
        with open(log, "a") as f:
            f.writelines(str(json.loads(json.loads(r)["messages"][1]["content"])["title"]) + "\n" for r in asked)
        return [None if "강의 3 " in r else json.dumps({"choices": [{"message": {"content": '{"title": "T", "description": "D"}'}}]}) for r in asked]

    def run(targets, most, batch=12):
        open(log, "w").close()
        courses, units, failed = pipelines.translate_display(bundle["course_dim"], bundle["course_curriculum_unit"], *none, targets, speak, batch=batch, most=most)
        rows = [(r["target_language"], r["course_id"]) for r in courses.collect()]
        assert courses.count() == len(rows) and units.count() == 0
        return rows, sorted((r["target_language"], r["course_id"]) for r in failed.collect()), len(open(log).readlines())

    got, failed, asked = run(["ko", "fr"], 5)  # the most active first: course 3 is not reached
    assert sorted(got) == [("fr", i) for i in range(4, 9)] and failed == [] and asked == 5
    got, failed, asked = run(["ko", "fr"], 7)
    assert sorted(got) == [("fr", i) for i in (2, 4, 5, 6, 7, 8)] and failed == [("fr", 3)] and asked == 7
    got, failed, asked = run(["fr", "de", "es"], 9, batch=6)  # 5 of fr, 4 of de
    assert [t for t, _ in got].count("fr") == 5 and [t for t, _ in got].count("de") == 4 and asked == 10 and failed == [("fr", 3)]


def test_state(spark):
    empty = spark.createDataFrame([], "course_id long, locale string, source_url string, first_seen_at timestamp, last_fetched_at timestamp")
    seen = spark.createDataFrame([(1, "KO", "a", 10, 0), (1, "ko", " ", 5, 1), (0, "ko", "x", 1, 2), (2, None, "b", 3, 3)], "course_id long, locale string, source_url string, s long, seq long").select("course_id", "locale", "source_url", F.timestamp_seconds("s").alias("fetched_at"), "seq")
    whole = sorted(map(tuple, state.upsert(empty, seen).collect()))
    split = state.upsert(state.upsert(empty, seen.filter("seq < 1")), seen.filter("seq >= 1"))
    assert sorted(map(tuple, split.collect())) == whole
    assert [(r[0], r[1], r[2]) for r in whole] == [(1, "ko", "a"), (2, "ko", "b")]
    points = state.checkpoint_row(spark, "s", 3, 4)
    assert state.latest_checkpoint(points, "s") == (3, 4) and state.latest_checkpoint(points, "other") == (0, 0)


def test_jobs_that_write(spark, captures, tmp_path):
    root = str(tmp_path)
    body = "<u>" + "".join(f"<loc>{url(i)}</loc>" for i in range(1, 6)) + "</u>"
    responses = spark.createDataFrame([(0, 0, 200, body), (1, 0, 404, ""), (1, 1, 404, "")], "sitemap_index int, base_rank int, status int, body string")
    found = spark.createDataFrame([(1, json.dumps({"data": {"items": [{"id": 8, "slug": "c8"}]}}))], "page int, body string")
    written, errors, end = pipelines.run_collect_new(spark, root, responses, found, *captures, batch=3)
    assert end == (0, 2) and sorted(r["course_id"] for r in written["course_dim"].collect()) == [1, 2, 8]
    written, errors, end = pipelines.run_collect_new(spark, root, responses, found, *captures, batch=9)
    assert end == (0, 0) and sorted(r["course_id"] for r in written["course_dim"].collect()) == [3, 4, 5]
    assert sorted(r["course_id"] for r in state.read_state_table(spark, root).collect()) == [1, 2, 3, 4, 5, 8]
    assert state.read_checkpoints(spark, root).count() == 2
    for progress in ((2, 2), (4, 2)):
        _, _, got = pipelines.run_refresh_existing(spark, root, *captures, limit=2)
        assert got == progress
    assert state.latest_checkpoint(state.read_checkpoints(spark, root), pipelines.UPDATE) == (4, 2)
    pipelines.run_collect_urls(spark, root, spark.createDataFrame([(url(7),)], "value string"), *captures)
    assert sorted(r["course_id"] for r in state.read_state_table(spark, root).collect()) == [1, 2, 3, 4, 5, 7, 8]
    snapshots = spark.read.parquet(f"{root}/course_snapshot_raw")
    assert snapshots.select("uuid").distinct().count() == snapshots.count()

    def speak(asked):
        return [json.dumps({"choices": [{"message": {"content": '{"title": "T"}'}}]}) for _ in asked]

    assert pipelines.run_translate_display(spark, root, ["fr"], speak)[:2] == (7, 0)
    assert pipelines.run_translate_display(spark, root, ["fr"], speak)[:2] == (0, 0)
    event = state.checkpoint_event(state.read_checkpoints(spark, root), namespace="c").first()
    payload = json.loads(event["payload"])
    assert event["event_type"] == "c.crawl_checkpoint.v1" and payload["checkpoint_uuid"] == event["event_uuid"] and event["event_uuid"][14] == "7"
    assert set(payload) == {"checkpoint_uuid", "source", "updated_at", "sitemap_index", "url_index"} and event["created_at"] == payload["updated_at"]


def test_only_failed_chunks_are_kept(spark, tmp_path):
    rows = spark.range(300).select(F.col("id").alias("course_id"), (F.col("id") + 1).alias("instructor_id"), F.lit("main").alias("role"), F.timestamp_seconds("id").alias("fetched_at"))
    root, log = str(tmp_path), str(tmp_path / "sent")

    def send(lines):
        with open(log, "a") as f:
            f.write(lines + "\n")
        if '"course_id":7,' in lines:
            raise RuntimeError("Connection refused")

    assert sinks.send_with_outbox(rows, "course_instructor_map", send, root, "db", chunk=50) == 1
    kept = spark.read.parquet(f"{root}/insert_outbox").collect()
    assert len(kept) == 1 and '"course_id":7,' in kept[0]["rows_json"] and kept[0]["row_count"] < 100 and kept[0]["source_error"] == "Connection refused"
    assert len(open(log).read().splitlines()) == 300
    assert sinks.send_with_outbox(rows, "course_instructor_map", send, root, "db", chunk=50) == 0  # an equal chunk is pending

    def broken(lines):
        raise RuntimeError("Code: 60. Table does not exist" if '"course_id":7,' in lines else "timeout")

    with pytest.raises(RuntimeError, match="does not exist"):
        sinks.send_with_outbox(rows, "course_instructor_map", broken, root, "db", chunk=50)
    assert spark.read.parquet(f"{root}/insert_outbox").count() > 3  # the others are kept all the same


def test_outbox_round_trip(spark, tmp_path):
    rows = spark.range(250).select(F.col("id").alias("course_id"), (F.col("id") + 1).alias("instructor_id"), F.lit("main").alias("role"), F.timestamp_seconds("id").alias("fetched_at"))
    empty = spark.createDataFrame([], schemas.schema("insert_outbox"))

    def broken(_):
        raise RuntimeError("Connection refused")

    kept = sinks.write_with_outbox(rows, "course_instructor_map", broken, empty, "db")
    kept.write.parquet(str(tmp_path / "box"))
    box = spark.read.parquet(str(tmp_path / "box"))
    twice = sinks.write_with_outbox(rows, "course_instructor_map", broken, box, "db")
    assert box.agg(F.sum("row_count")).first()[0] == 250 and twice.count() == 0
    target = str(tmp_path / "out")
    writers = {"course_instructor_map": lambda df: sinks.append_table(df, target, "course_instructor_map")}
    marked, n = outbox.drain(spark, box, writers, {"course_instructor_map": schemas.schema("course_instructor_map")})
    assert n == box.count() and spark.read.parquet(f"{target}/course_instructor_map").count() == 250
    marked.write.parquet(str(tmp_path / "marked"))
    assert outbox.pending(spark.read.parquet(str(tmp_path / "marked"))).count() == 0
    failed, n = outbox.drain(spark, box, {"course_instructor_map": broken}, {"course_instructor_map": schemas.schema("course_instructor_map")})
    assert n == 0 and failed.filter("replay_attempt = 1").count() == 1  # the unwritable target's later chunks wait
    with pytest.raises(ZeroDivisionError):
        sinks.write_with_outbox(rows, "course_instructor_map", lambda _: 1 / 0, empty)


def test_sinks_and_events(spark, captures, tmp_path):
    bundle, _ = pipelines.flattened(*captures)
    sinks.write_bundle(bundle, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/course_dim").columns == schemas.schema("course_dim").names
    framed = events.kafka_frame(events.bundle_events(bundle, namespace="c"))
    assert framed.columns == ["key", "value"] and framed.count() == sum(r["n"] for r in latest.counts(bundle).collect())
    lines = [json.loads(r[0]) for r in events.to_ndjson(bundle["course_instructor_map"], ["course_id", "extra"]).collect()]
    assert all(set(x) == {"course_id", "extra"} for x in lines)


def test_stream(spark, tmp_path):
    row = {"fetched_at": "2024-01-01T00:00:00Z", "course_id": 1, "locale": "ko", "source_url": "u", "online": '{"data":{"title":"t"}}', "meta": "{}", "curriculum": None, "discounts": None, "contents": None}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(row))
    root, point = str(tmp_path / "out"), str(tmp_path / "point")
    for _ in range(2):  # a second run finds nothing new
        ingest.start(ingest.captured_stream(spark, str(tmp_path / "in")), root, point, once=True).awaitTermination()
    assert ingest.read_stream_table(spark, root, "course_dim").count() == 1
    shots = ingest.read_stream_table(spark, root, "course_snapshot_raw").orderBy("query_key").collect()
    assert [r["query_key"] for r in shots] == ["/client/api/v1/course/1/meta", "/client/api/v1/course/1/online/info"]
    assert [r["source_url"] for r in ingest.read_stream_table(spark, root, "course_state").collect()] == ["u"]
    assert ingest.read_stream_table(spark, root, "insert_outbox").count() == 0
    # The same batch again, with a target that is down: its rows go to the outbox, nothing is doubled.
    def down(rows, folder):
        if "course_dim" in folder:
            raise RuntimeError("Connection refused")
        rows.write.mode("overwrite").parquet(folder)

    batch = spark.read.schema(ingest.CAPTURED).json(str(tmp_path / "in"))
    ingest.write_batch(root, down, "db")(batch, 0)
    ingest.write_batch(root, down, "db")(batch, 1)
    assert ingest.read_stream_table(spark, root, "insert_outbox").filter("target_table = 'course_dim'").count() == 2
    assert ingest.read_stream_table(spark, root, "course_snapshot_raw").count() == 4
    with pytest.raises(ZeroDivisionError):
        ingest.write_batch(root, lambda rows, folder: 1 / 0)(batch, 2)
