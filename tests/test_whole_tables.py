"""Queries over whole tables: nothing of the input is left out."""

from pyspark.sql import functions as F

from catalog_spark import queries
from catalog_spark.operators import discovery, translate
from catalog_spark.sources import search

SF = "/root/testdata/sf0.01"


def test_paged_union_reads_all_orders(spark):
    customers = spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey").distinct().count()
    assert queries.QUERIES["q_paged_union_whole"](spark, SF).count() == customers
    assert queries.QUERIES["q_paged_union"](spark, SF).count() < customers  # its SQL cuts a page short


def test_paged_union_stops_after_a_short_page(spark):
    rows = [(i, i // 10) for i in range(40) if i != 15]
    hits = spark.createDataFrame(rows, "pos long, page long")
    got = search.paged_union(hits, ["pos"], 10)
    assert sorted(r["pos"] for r in got.collect()) == [i for i in range(20) if i != 15]


def test_translation_takes_all_documents_with_their_texts(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.QUERIES["q_translate_whole"](spark, SF)
    assert got.count() == documents.count()
    assert got.filter("length(description) > 400").count() >= documents.filter("length(trim(text)) > 1000").count() > 0


def test_prior_state_holds_all_customers(spark):
    keys = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey")
    got = queries.QUERIES["q_state_upsert_whole"](spark, SF).select("course_id")
    assert keys.subtract(got).filter("c_custkey > 0").isEmpty()


def test_descriptions_hold_the_rest_of_the_texts(spark):
    longest = queries._dim(spark, SF, queries.WHOLE).selectExpr("max(length(title) + length(description))").first()[0]
    assert longest == spark.read.parquet(f"{SF}/documents.parquet").selectExpr("max(length(text))").first()[0]


def test_outbox_queries_have_no_row_cap(spark):
    for name in ("q_outbox_pending", "q_outbox_replay"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "Limit" not in plan and "Sort [created_at" not in plan


def test_flush_batches_in_ranges(spark):
    rows = spark.createDataFrame([(i * 7919 % 1009 if i % 50 else None, i) for i in range(1009)], "k long, i long")
    flushed = discovery.flush_batches(rows, ["k", "i"], 20, 8)
    got = sorted((r["k"] is not None, r["k"] or 0, r["i"], r["batch"]) for r in flushed.collect())
    assert [r[3] for r in got] == [n // 20 for n in range(1009)]
    assert discovery.flush_batches(rows.limit(0), ["k"], 20).count() == 0
    plan = discovery.flush_batches(rows, ["k", "i"], 20)._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number() windowspecdefinition(k" not in plan  # no window over all rows


def test_a_translator_gets_few_long_requests_at_a_time(spark):
    long = "x" * 100_000

    def count(asked):
        return [f"{len(asked)},{sum(len(x or "") for x in asked)}" if r else None for r in asked]

    rows = spark.range(0, 300, 1, 1).select("id", F.timestamp_seconds("id").alias("at"), F.when(F.col("id") != 7, F.lit(long)).alias("request"))
    got = translate.apply_translator(rows, count).collect()
    assert [(r["id"], r["at"].second, r["request"]) for r in got] == [(k, k % 60, None if k == 7 else long) for k in range(300)]
    assert [r["id"] for r in got if r["response"] is None] == [7]
    assert max(int(r["response"].split(",")[1]) for r in got if r["response"]) <= 1_200_000  # before: all 30 MB in one call
    assert max(int(r["response"].split(",")[0]) for r in got if r["response"]) > 1
