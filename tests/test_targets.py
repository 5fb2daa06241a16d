"""Backlogs of all targets in one scan against the backlog of each target."""

import random

import pytest
from pyspark.sql import functions as F

from catalog_spark.functions import text
from catalog_spark.operators import backlog

TITLES = ["Docker 입문 강의 과정", "Learn Spark", "スパーク入門のコース", "学习大数据处理", "Курс по данным", "دورة البيانات", "डेटा पाठ्यक्रम", "หลักสูตรข้อมูล", "x", ""]


@pytest.fixture(scope="module")
def courses(spark):
    r = random.Random(6)
    rows = [(r.randint(1, 60), r.choice(["ko", "en", "ja"]), r.randint(0, 50), r.choice(["PUBLISH", "PUBLISH", "DRAFT"]), r.choice(TITLES), r.choice([*TITLES, None]), r.randint(0, 9)) for _ in range(400)]
    dim = spark.createDataFrame(rows, "course_id long, locale string, s long, status string, title string, description string, p long").select(
        "course_id", "locale", F.timestamp_seconds("s").alias("fetched_at"), "status", "title", "description", *[F.lit("c").alias(c) for c in backlog.COURSE_TEXTS[2:5]], F.lit(None).cast("string").alias("keywords"),
        F.timestamp_seconds(F.col("p") + 100_000_000).alias("published_at"), F.timestamp_seconds("p").alias("last_updated_at"))
    done = spark.createDataFrame([(r.randint(1, 60), r.choice(list(text.LANGUAGES)), r.choice(["success", "error"])) for _ in range(300)], "course_id long, target_language string, generation_status string")
    return dim, done


def test_all_targets_equal_each_target(spark, courses):
    dim, done = courses
    targets = list(text.LANGUAGES)
    got = backlog.backlog_of_targets(dim, done, [*targets, targets[0]], 7).collect()
    assert len({r["target"] for r in got}) == len(targets)
    for t in ("ko", "en", "ja", "zh-Hans", "fr", "ru", "uk", "ar", "hi", "th"):
        want = [tuple(r) for r in backlog.translation_backlog(dim, done, t, 7).collect()]
        mine = sorted((r for r in got if r["target"] == t), key=lambda r: r["rn"])
        assert [tuple(r)[2:] for r in mine] == want, t
        assert [r["rn"] for r in mine] == list(range(1, len(want) + 1))
    some = backlog.backlog_of_targets(dim, done, ["fr"], 50, [3, 5]).select("course_id").collect()
    assert {r[0] for r in some} <= {3, 5}


def test_one_scan_serves_all_targets(spark, courses, tmp_path):
    dim, done = courses
    dim.write.parquet(str(tmp_path / "dim"))
    made = backlog.backlog_of_targets(spark.read.parquet(str(tmp_path / "dim")), done, list(text.LANGUAGES), 5)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "WindowGroupLimit" in plan


def test_unit_targets_equal_each_target(spark):
    r = random.Random(2)
    rows = [(r.randint(1, 9), r.randint(1, 2), r.randint(1, 4), r.choice(["ko", "en"]), r.randint(0, 99), r.choice([*TITLES, None]), r.choice(TITLES)) for _ in range(200)]
    units = spark.createDataFrame(rows, "course_id long, section_id long, unit_id long, locale string, s long, section_title string, unit_title string").withColumn("fetched_at", F.timestamp_seconds("s")).drop("s")
    done = units.filter("unit_id = 1").select("course_id", "section_id", "unit_id", F.lit("fr").alias("target_language"), F.lit("success").alias("generation_status"))
    got = backlog.unit_backlog_of_targets(units, done, ["en", "fr", "ru"], 6).collect()
    for t in ("en", "fr", "ru"):
        want = [tuple(x) for x in backlog.unit_translation_backlog(units, done, t, 6).select("course_id", "section_id", "unit_id", "locale", "section_title", "unit_title").collect()]
        assert [tuple(x)[2:] for x in sorted((x for x in got if x["target"] == t), key=lambda x: x["rn"])] == want
