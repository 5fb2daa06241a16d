"""New rows by a filter first against the anti join alone."""

import pytest
from pyspark.sql import functions as F

from catalog_spark.operators import discovery, existence


def some(spark, start, end, step=1):
    return spark.range(start, end, step).select(F.col("id").alias("course_id"), F.when(F.col("id") % 11 > 0, F.concat(F.lit("l"), (F.col("id") % 3).cast("string"))).alias("locale"))


def rows(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("most", [existence.WORDS, 40, 1])
def test_the_result_is_exact_and_the_rate_as_expected(spark, most):
    known, asked = some(spark, 0, 3000), some(spark, 1500, 9000).withColumn("title", F.lit("t"))
    keys = ["course_id", "locale"]
    held = existence.key_filter(known, keys, most=most)
    got = existence.new_rows(asked, known, keys, held)
    want = discovery.new_rows(asked, known, keys)
    assert got.columns == asked.columns and rows(got) == rows(want.select(*asked.columns))
    assert {r["course_id"] for r in got.collect() if r["locale"] is None} >= {x for x in range(1500, 9000) if x % 11 == 0}  # a null equals nothing
    fresh = some(spark, 10_000, 110_000)
    rate = fresh.agg(F.avg(held.maybe(*keys).cast("int"))).first()[0]
    assert rate == pytest.approx(held.expected_rate(), rel=0.25, abs=0.002)
    if most == existence.WORDS:
        assert 0 < rate < 0.012
        twice = existence.key_filter(known.unionByName(known), keys, most=most)  # repeated keys only make it roomier
        assert fresh.filter(twice.maybe(*keys)).count() < rate * fresh.count()
        assert rows(existence.new_rows(asked, known, keys, twice)) == rows(got)
    assert known.filter(~held.maybe(*keys)).count() == 0  # no known key is called new


def test_what_is_surely_new_does_not_shuffle(spark, tmp_path):
    spark.range(4000).write.parquet(str(tmp_path / "asked"))
    asked, known = spark.read.parquet(str(tmp_path / "asked")), spark.range(100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = existence.new_rows(asked, known, ["id"])
        assert made.count() == 3900
        plan = made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("Initial Plan")[0]
    sure, rest = final.split("Union", 1)[1].split("SortMergeJoin", 1) if "SortMergeJoin" in final else (final.split("Join", 1) + [""])[:2]
    assert "Exchange" not in sure


def test_odd_keys(spark):
    none = spark.createDataFrame([], "course_id long, locale string")
    asked = some(spark, 0, 20)
    assert rows(existence.new_rows(asked, none, ["course_id", "locale"])) == rows(asked)
    assert existence.new_rows(none, asked, ["course_id", "locale"]).count() == 0
    with pytest.raises(TypeError):
        existence.new_rows(asked, none.withColumn("course_id", F.col("course_id").cast("int")), ["course_id"])
    with pytest.raises(TypeError):
        existence.key_filter(asked.withColumn("x", F.lit(0.5)), ["x"])
