"""Bundles that become visible at once, state kept incrementally, deliveries with a ledger, and the event log."""

import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_spark import schemas
from catalog_spark.operators import event_sink, events, keyed, ledger, outbox, sinks, state
from catalog_spark.sources import documents, manifests
from catalog_spark.streaming import ingest

MAP = ["fetched_at", "course_id", "instructor_id", "role"]


def people(spark, start, end):
    return spark.range(start, end).select(F.col("id").alias("course_id"), (F.col("id") + 1).alias("instructor_id"), F.lit("main").alias("role"), F.timestamp_seconds("id").alias("fetched_at"))


# Manifests


def test_a_bundle_is_seen_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path)
    broken = F.udf(lambda x: 1 // 0, "string")
    good = {t: spark.createDataFrame([(1,)], "course_id long") for t in schemas.BUNDLE}
    bad = good | {"course_price_fact": spark.range(3).withColumn("discount_title", broken("id"))}
    sinks.append_table(people(spark, 0, 5), root, "course_instructor_map")  # what was there before stays visible
    with pytest.raises(Exception, match="ZeroDivisionError|integer division"):
        sinks.write_bundle(bad, root, "one")
    assert [sinks.read_or_empty(spark, root, t).count() for t in schemas.BUNDLE] == [0] * 6 + [5]
    assert not any("bundle-one" in name for _, _, names in os.walk(root) for name in names)
    written = sinks.write_bundle(good, root, "one")
    assert [sinks.read_or_empty(spark, root, t).count() for t in schemas.BUNDLE] == [1] * 6 + [6]
    assert all(rows.count() == 1 for rows in written.values())
    again = sinks.write_bundle(good, root, "one")  # a retry of what is committed
    assert [sinks.read_or_empty(spark, root, t).count() for t in schemas.BUNDLE] == [1] * 6 + [6] and again["course_dim"].count() == 1
    assert documents.read_table(spark, f"{root}/course_dim", ["course_id"]).collect() == [(1,)]


def test_uncommitted_files_are_not_read_and_go(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_bundle({"course_instructor_map": people(spark, 0, 5)}, root, "a")
    people(spark, 5, 9).coalesce(1).write.parquet(f"{root}/aside")
    os.rename(next((tmp_path / "aside").glob("*.parquet")), f"{root}/course_instructor_map/bundle-lost-0.parquet")  # a driver that died before the manifest
    assert sinks.read_or_empty(spark, root, "course_instructor_map").count() == 5
    assert manifests.vacuum(spark, root, ["course_instructor_map"], older_than_s=3600) == []
    assert [p.rsplit("/", 1)[1] for p in manifests.vacuum(spark, root, ["course_instructor_map"], older_than_s=-1)] == ["bundle-lost-0.parquet"]
    for k in range(3):
        sinks.write_bundle({"course_instructor_map": people(spark, 10 * k, 10 * k + 2)}, root, f"m{k}")
    manifests.merge(spark, root)
    assert len(manifests.commits(spark, root)) == 1 and sinks.read_or_empty(spark, root, "course_instructor_map").count() == 11
    assert manifests.is_committed(spark, root, "m1") and not manifests.commit(spark, root, {}, "m1")  # still known


# State


def test_versions_before_and_after_compaction(spark, tmp_path):
    r = random.Random(1)
    schema = T.StructType.fromDDL("k long, name string, v string, at long")
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), schema, ["k", "name"], "at", buckets=3)
    assert table.read().count() == 0 and not table.compact()
    want = {}
    for step in range(6):
        rows = [(r.randint(0, 40), r.choice("ab"), f"v{step}-{i}", step * 100 + r.randint(0, 30)) for i in range(50)] + [(None, "a", "x", 1), (1, None, "x", 1)]
        assert table.append(spark.createDataFrame(rows, schema), f"step-{step}")
        assert not table.append(spark.createDataFrame([(0, "a", "never", 10**9)], schema), f"step-{step}")  # a retry
        for k, n, v, at in rows:
            if k is not None and n is not None:
                want[k, n] = max(want.get((k, n), (-1, "")), (at, v))
        if step in (1, 3):
            assert table.compact() and table.deltas() == 0
            assert not table.append(spark.createDataFrame([(0, "a", "never", 10**9)], schema), f"step-{step}")  # known after it, too
        assert {(x["k"], x["name"]): (x["at"], x["v"]) for x in table.read().collect()} == want
    some = spark.createDataFrame([(k, "a") for k in range(5)], "k long, name string")
    assert {(x["k"], x["name"]): x["v"] for x in table.lookup(some).collect()} == {key: v for key, (_, v) in want.items() if key[1] == "a" and key[0] < 5}
    assert table.deltas() == 2
    spark.sql(f"DROP TABLE {[t.name for t in spark.catalog.listTables() if t.name.startswith('keyed_')][0]}")  # as in a new session
    assert table.read().count() == len(want)


def test_a_merge_does_not_shuffle_the_base(spark, tmp_path):
    schema = T.StructType.fromDDL("k long, v string, at long")
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], "at", buckets=4)
    rows = lambda n, at: spark.range(n).select(F.col("id").alias("k"), F.lit("v").alias("v"), F.lit(at).cast("long").alias("at"))
    table.append(rows(2000, 1))
    table.compact()
    table.append(rows(100, 2))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.read()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    base = next(x for x in plan.split("\n") if "Bucketed: true" in x)
    depth = len(base) - len(base.lstrip(" :+-|"))
    above = [x for x in plan.split("\n")[: plan.split("\n").index(base)] if len(x) - len(x.lstrip(" :+-|")) < depth]
    assert "Join" in plan and not any("Exchange" in x for x in above)
    assert plan.count("Exchange") == 1  # the deltas'


def test_the_crawl_state_is_compacted_now_and_then(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "DELTAS", 2)
    seen = lambda k: spark.createDataFrame([(k, "ko", f"u{k}", k), (1, "ko", " ", 10 + k)], "course_id long, locale string, source_url string, s long").select("course_id", "locale", "source_url", F.timestamp_seconds("s").alias("fetched_at"), F.lit(0).alias("seq"))
    for k in range(1, 6):
        state.append_state(spark, str(tmp_path), seen(k), f"b{k}")
        state.append_state(spark, str(tmp_path), seen(k), f"b{k}")
    assert state.state_table(spark, str(tmp_path)).deltas() < 2
    got = {r["course_id"]: (r["source_url"], r["first_seen_at"].timestamp(), r["last_fetched_at"].timestamp()) for r in state.read_state_table(spark, str(tmp_path)).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5] and got[1] == ("u1", 1, 15) and got[3] == ("u3", 3, 3)


# Deliveries


def chunks(spark, n=40):
    return outbox.chunked(people(spark, 0, n * 10), MAP, ["course_id"], 10)


def test_a_cut_off_delivery_goes_on_where_it_was(spark, tmp_path):
    root, log, flag = str(tmp_path), tmp_path / "sent", tmp_path / "die"
    flag.touch()

    def send(lines):
        with open(log, "a") as f:
            f.write(lines.split("\n")[0] + "\n")
        if flag.exists() and sum(1 for _ in open(log)) > 12:
            flag.unlink()
            os._exit(1)  # the worker dies between sending a chunk and saying so

    made = chunks(spark)
    with pytest.raises(Exception):
        ledger.deliver(made, send, root, "d").count()
    early = open(log).read().splitlines()
    assert len(early) > 12 and ledger.outcomes(spark, root, "d").count() < made.count()
    out = ledger.deliver(made, send, root, "d")
    spark.catalog.clearCache()  # whatever was cached is lost, and nothing is sent again for it
    n = made.dropDuplicates(["payload_hash"]).count()
    assert out.count() == n == out.filter("step = 'sent'").count() == out.count()
    sent = open(log).read().splitlines()
    doubt = ledger.entries(spark, root, "d").filter("step = 'again'").count()
    assert len(sent) == n + doubt and doubt <= 4 and len(set(sent)) == n  # at most the chunk in hand of each worker
    ledger.deliver(made, send, root, "d")
    assert len(open(log).read().splitlines()) == len(sent)


def test_failed_chunks_keep_their_errors(spark, tmp_path):
    def send(lines):
        if '"course_id":7,' in lines:
            raise RuntimeError("Connection refused")

    out = ledger.deliver(chunks(spark), send, str(tmp_path), "d").collect()
    assert sorted({(r["step"], r["error"]) for r in out}, key=str) == [("failed", "Connection refused"), ("sent", None)]
    assert sum(r["step"] == "failed" for r in out) == 1
    assert ledger.deliver(chunks(spark).limit(0), send, str(tmp_path), "none").count() == 0


def test_a_resumed_sending_queues_once(spark, tmp_path):
    log = tmp_path / "sent"

    def send(lines):
        with open(log, "a") as f:
            f.write(lines + "\n")
        raise RuntimeError("timeout")

    assert sinks.send_with_outbox(people(spark, 0, 100), "course_instructor_map", send, str(tmp_path), "db", 10, "d") > 5
    n = len(open(log).read().splitlines())
    assert n == 100
    assert sinks.send_with_outbox(people(spark, 0, 100), "course_instructor_map", send, str(tmp_path), "db", 10, "d") == 0  # pending already
    assert len(open(log).read().splitlines()) == n


def test_a_repeated_batch_of_a_stream_sends_nothing_twice(spark, tmp_path):
    rows = [(k, k, "ko", f"u{k}", '{"data":{"title":"t"}}', "{}") for k in range(1, 31)]
    none = F.lit(None).cast("string")
    batch = spark.createDataFrame(rows, "s long, course_id long, locale string, source_url string, online string, meta string").select(
        F.timestamp_seconds("s").alias("fetched_at"), "course_id", "locale", "source_url", "online", "meta", none.alias("curriculum"), none.alias("discounts"), none.alias("contents"))
    log = str(tmp_path / "sent")

    def send(table, lines):
        with open(log, "a") as f:
            f.writelines(f"{table} {line}\n" for line in lines.split("\n"))
        if table == "course_price_fact" and '"course_id":7,' in lines:
            raise RuntimeError("connection refused")

    root = str(tmp_path / "out")
    for _ in range(2):
        ingest.send_batch(root, send, "db", 10)(batch, 0)
    sent = [x.split(" ", 1)[0] for x in open(log).read().splitlines()]
    assert {t: sent.count(t) for t in set(sent)} == {"course_snapshot_raw": 60, "course_dim": 30, "course_metric_fact": 30, "course_price_fact": 30}
    late = sinks.read_or_empty(spark, root, "insert_outbox").collect()
    assert len(late) == 1 and late[0]["target_table"] == "course_price_fact" and late[0]["row_count"] < 30
    assert state.read_state_table(spark, root).count() == 30


def test_equal_rows_spread_over_chunks(spark):
    rows = spark.range(5000).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    made = outbox.chunked(rows, ["a", "b"], ["a"])
    sizes = [r["row_count"] for r in made.collect()]
    assert sum(sizes) == 5000 and max(sizes) < 200 and len(sizes) >= 45
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, outbox.chunked(rows.repartition(7), ["a", "b"], ["a"]).collect()))


# Event log


def framed(spark, n=500):
    rows = spark.range(n).select(F.concat(F.lit("k"), (F.col("id") % 40).cast("string")).alias("key"), F.col("id").cast("string").alias("value"), "id")
    return rows


def test_events_keep_their_order_by_key(spark, tmp_path):
    root = str(tmp_path)
    event_sink.write_events(framed(spark), root, ["id"], partitions=5, commit_id="a")
    event_sink.write_events(framed(spark), root, ["id"], partitions=5, commit_id="a")  # a retry
    got = event_sink.read_events(spark, root)
    assert sorted(int(r["value"]) for r in got.collect()) == list(range(500))
    assert got.filter(F.col("partition") != event_sink.partition_of(F.col("key"), 5)).count() == 0
    for f in manifests.table_files(spark, root, event_sink.TABLE):
        lines = [json.loads(x) for x in open(f)]
        assert [int(x["value"]) for x in lines] == sorted(int(x["value"]) for x in lines) and len({x["partition"] for x in lines}) == 1
    assert manifests.commits(spark, root)[0]["events"] == 500


def test_a_partition_has_many_tasks_and_a_key_one(spark, tmp_path):
    root = str(tmp_path)
    event_sink.write_events(framed(spark), root, partitions=2)
    files = manifests.table_files(spark, root, event_sink.TABLE)
    keys = [{json.loads(x)["key"] for x in open(f)} for f in files]
    assert len(files) == 4 and sum(map(len, keys)) == len(set.union(*keys)) == 40  # before: a task for each of both partitions
    got = event_sink.read_events(spark, root)
    assert got.count() == 500 and got.filter(F.col("partition") != event_sink.partition_of(F.col("key"), 2)).isEmpty()


def test_only_failed_events_are_tried_again(spark, tmp_path):
    log = str(tmp_path / "tries")

    def flaky(partition, some):
        tried = open(log).read().splitlines() if os.path.exists(log) else []
        with open(log, "a") as f:
            f.writelines(v + "\n" for _, v in some)
        return ["Not Leader For Partition" if int(v) % 10 == 3 and v not in tried else None for _, v in some]

    event_sink.write_events(framed(spark, 60).coalesce(1), str(tmp_path / "log"), partitions=1, publish=flaky, least=0.01, batch=20)
    tries = open(log).read().splitlines()
    assert len(tries) == 66 and all(tries.count(str(k)) == 1 + (k % 10 == 3) for k in range(60))
    assert event_sink.read_events(spark, str(tmp_path / "log")).count() == 60
    assert manifests.commits(spark, str(tmp_path / "log"))[0]["repeated"] == 6


def test_lasting_errors_end_the_write_and_nothing_shows(spark, tmp_path):
    root, log = str(tmp_path / "log"), str(tmp_path / "tries")

    def broken(message):
        def publish(partition, some):
            with open(log, "a") as f:
                f.write("x\n")
            return [message if v == "7" else None for _, v in some]
        return publish

    with pytest.raises(Exception, match="SASL"):
        event_sink.write_events(framed(spark, 20), root, partitions=1, publish=broken("SASL Authentication Failed"), least=0.01)
    assert len(open(log).readlines()) == 1 and event_sink.read_events(spark, root).count() == 0
    with pytest.raises(Exception, match="refused"):
        event_sink.write_events(framed(spark, 20), root, partitions=1, publish=broken("connection refused"), attempts=3, least=0.01)
    assert len(open(log).readlines()) == 4 and event_sink.read_events(spark, root).count() == 0
    assert event_sink.delays(5, 1, 5) == [1, 2, 4, 5]


def test_a_stream_of_events_is_written_once(spark, tmp_path):
    source, root, point = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "point")
    framed(spark, 30).select("key", "value").write.json(str(source))
    stream = lambda: spark.readStream.schema("key string, value string").json(str(source))
    for _ in range(2):
        event_sink.start_events(stream(), root, point, "s", once=True).awaitTermination()
    framed(spark, 45).filter("id >= 30").select("key", "value").write.mode("append").json(str(source))
    event_sink.start_events(stream(), root, point, "s", once=True).awaitTermination()
    assert sorted(int(r["value"]) for r in event_sink.read_events(spark, root).collect()) == list(range(45))
    assert [m["id"] for m in manifests.commits(spark, root)] == ["s-0", "s-1"]
