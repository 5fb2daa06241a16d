"""Replay in one job against the chunk-wise drain, and identifiers that survive a retry."""

import json
import re

from pyspark.sql import functions as F

from catalog_spark import schemas
from catalog_spark.operators import events, ledger, outbox


def boxed(spark, said):
    """An outbox of (uuid, seconds, table, text)."""
    rows = [(u, s, t, x) for u, s, t, x in said]
    base = spark.createDataFrame(rows, "outbox_uuid string, s long, target_table string, rows_json string")
    kept = {"outbox_uuid", "target_table", "rows_json"}
    made = {"created_at": F.timestamp_seconds("s"), "target_database": F.lit("db"), "target_columns": F.array(F.lit("x")), "replay_attempt": F.lit(0), "replay_error": F.lit(""), "source_error": F.lit("timeout"), "row_count": F.lit(1)}
    return base.select(*[(F.col(f.name) if f.name in kept else made.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in schemas.schema("insert_outbox")])


SAID = [(f"u{k:02}", (k * 7) % 23, "abc"[k % 3], json.dumps({"x": k})) for k in range(23)]
LASTING, TEMPORARY = {4, 9}, {10, 18}


def speaker():
    lasting, temporary = LASTING, TEMPORARY

    def speak(table, lines):
        import json

        x = json.loads(lines.split("\n")[0])["x"]
        if x in lasting:
            raise ValueError("Code: 60. no such table")
        if x in temporary:
            raise RuntimeError("connection refused")

    return speak


def marks(box):
    return sorted((r["outbox_uuid"], r["replay_attempt"], r["replayed_at"] is not None, r["replay_error"]) for r in box.collect())


def test_one_job_gives_the_marks_of_the_drain(spark, tmp_path):
    speak = speaker()
    box = boxed(spark, [*SAID, ("blank", 1, "a", " "), ("other", 2, "", "{}")])
    schema = spark.createDataFrame([], "x long").schema

    def writer(table):
        return lambda df: [speak(table, json.dumps({"x": r["x"]})) for r in df.collect()]

    want, n = outbox.drain(spark, box, {t: writer(t) for t in "abc"}, dict.fromkeys("abc", schema))
    got, done = ledger.replay(box, speak, str(tmp_path), delivery="one")
    assert marks(got) == marks(want) and done.filter("step = 'sent'").count() == n
    few, _ = outbox.drain(spark, box, {t: writer(t) for t in "abc"}, dict.fromkeys("abc", schema), 6)
    assert marks(ledger.replay(box, speak, str(tmp_path), 6)[0]) == marks(few)
    log = ledger.entries(spark, str(tmp_path), "one").filter("step = 'begin'").orderBy("at").collect()
    when = {u: (s, u) for u, s, _, _ in SAID}
    for table in "abc":  # each target's chunks went out oldest first
        mine = [when[r["payload_hash"]] for r in log if r["payload_hash"] in {u for u, _, t, _ in SAID if t == table}]
        assert mine == sorted(mine) and mine


def test_a_drain_writes_a_target_once_and_splits_only_what_fails(spark):
    box = boxed(spark, [(f"u{k:02}", k, "a", json.dumps({"x": k})) for k in range(40)])
    schema = spark.createDataFrame([], "x long").schema
    taken, calls = [], []

    def write(df, bad):
        xs = [r["x"] for r in df.collect()]
        calls.append(len(xs))
        for x in xs:
            if x in bad:
                raise bad[x]
        taken.extend(xs)

    _, n = outbox.drain(spark, box, {"a": lambda df: write(df, {})}, {"a": schema})
    assert n == 40 and taken == list(range(40)) and calls == [40]  # before: a write for each chunk
    taken.clear(), calls.clear()
    marked, n = outbox.drain(spark, box, {"a": lambda df: write(df, {7: ValueError("Code: 60"), 30: RuntimeError("connection refused")})}, {"a": schema})
    assert n == 29 and taken == [x for x in range(30) if x != 7] and len(calls) < 25
    assert [(u, a, e) for u, a, w, e in marks(marked) if not w and a] == [("u07", 1, "Code: 60"), ("u30", 1, "connection refused")]


def test_a_replay_that_was_cut_off_goes_on(spark, tmp_path):
    root, box, speak = str(tmp_path), boxed(spark, SAID), speaker()
    store = tmp_path / "sent.txt"

    def note(table, lines):
        speak(table, lines)
        with open(store, "a") as f:
            f.write(lines + "\n")

    first, _ = ledger.replay(box, note, root, delivery="again")
    before = marks(first)
    second, _ = ledger.replay(box, note, root, delivery="again")  # nothing is sent, and stopped targets stay so
    assert marks(second) == before and len(store.read_text().splitlines()) == len(set(store.read_text().splitlines()))
    assert ledger.replay(boxed(spark, []), note, root)[0].count() == 0


def test_identifiers_are_the_same_again_and_differ(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("course_id"), F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("kind"), F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") % 3).alias("fetched_at"))
    ids = lambda df, **kw: sorted(r["event_uuid"] for r in events.to_events(df, "t", **kw).collect())
    one, two = ids(rows, id_key="k"), ids(rows.repartition(7).orderBy(F.rand(3)), id_key="k")
    assert one == two and len(set(one)) == 300
    assert all(re.fullmatch("[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", x) for x in one)
    assert {int(x.replace("-", "")[:12], 16) for x in one} == {1_600_000_000_000 + 1000 * k for k in range(3)}
    assert not set(one) & set(ids(rows, id_key="other")) and not set(one) & set(ids(rows))
    payloads = {r["payload"] for r in events.to_events(rows, "t", id_key="k").collect()}
    assert payloads == {r["payload"] for r in events.to_events(rows, "t").collect()}
    assert ids(rows.limit(0), id_key="k") == []
    odd = spark.createDataFrame([("a", None), ("a", None), (None, None)], "`a.b` string, uuid string").withColumn("fetched_at", F.timestamp_seconds(F.lit(1)))
    assert len(set(ids(odd, id_key="k"))) == 3


def test_hot_rows_are_numbered_in_blocks(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 700, F.lit("hot")).otherwise(F.concat(F.lit("x"), (F.col("id") % 150).cast("string"))).alias("a.b"), F.lit(None).cast("string").alias("n"))
    for block in (1, 2, 99, 700, 10_000):
        got = sorted((r[0], r["_equal"]) for r in events.numbered(rows, block=block).collect())
        assert got == sorted([("hot", k) for k in range(1, 701)] + [(f"x{k}", j) for k in range(150) for j in (1, 2)])


def test_copies_of_few_rows_are_dealt_to_all_tasks(spark):
    rows = spark.range(40_000).select((F.col("id") % 10).alias("k"))
    got = events.numbered(rows, made={"line": F.concat(F.lit("x"), F.col("k"))})
    assert got.filter(F.col("line") != F.concat(F.lit("x"), F.col("k"))).isEmpty() and got.groupBy("k").agg(F.count_distinct("_equal").alias("n"), F.max("_equal").alias("m")).filter("n = 4000 AND m = 4000").count() == 10
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 20_000  # before: all of them in one task
