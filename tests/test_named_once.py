"""Costly expressions stand once in a plan, and give what they gave."""

import hashlib
import json

from pyspark.sql import functions as F

from catalog_spark.functions import coerce, hashing
from catalog_spark.operators import flatten


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_hashes(spark):
    texts = ["", "a", "é}", '"}', "}}", "a<b>&\\", "\n", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", hashing.h64(F.col("t")).alias("h"), hashing.json_text(F.col("t")).alias("j"))
    assert plan(rows.select("h")).count("sha2(") == 1
    assert plan(rows.select("j")).count("StructsToJson") + plan(rows.select("j")).count("to_json") == 1
    for r in rows.collect():
        t = texts[r["i"]]
        if t is None:
            assert r["h"] is None and r["j"] == "null"
            continue
        assert int(r["h"]) == int.from_bytes(hashlib.sha256(t.encode()).digest()[:8], "little")
        told = json.dumps(t, ensure_ascii=False).replace("<", "\\u003c").replace(">", "\\u003e").replace("&", "\\u0026")
        assert r["j"] == told


def test_blanks(spark):
    blanks = spark.createDataFrame([(" x ",), ("  ",), ("",), (None,)], "t string")
    numbers = blanks.select(F.try_parse_json("t").alias("v")).select(coerce.nullable_int(F.col("v"), "$.a"))
    assert "_common_expr" not in plan(numbers)
    assert [r[0] for r in blanks.select(coerce.nullable_str(F.col("t"))).collect()] == ["x", None, None, None]


def test_coercions(spark):
    cases = {
        '{"a":["x"," ",null,1,1.50,true,{"k":1,"b":2},[1],"y"]}': ["x", "1", "1.5", "true", '{"b":2,"k":1}', "[1]", "y"],
        '{"a":"x, ,y"}': ["x", "y"], '{"a":5}': [], '{"a":null}': [], '{"a":{}}': [], "{}": [], '{"a":[]}': [],
    }
    df = spark.createDataFrame([(c,) for c in cases], "c string").select("c", F.parse_json("c").alias("v"))
    rows = df.select("c", coerce.string_array(F.col("v"), "$.a").alias("a"))
    assert "transform(try_variant_get" not in plan(rows)
    assert {r["c"]: r["a"] for r in rows.collect()} == cases


def test_levels(spark):
    cases = {
        '{"data":{"levels":[{"code":"a","isActive":false},{"code":" ","title":"t","isActive":true},{"code":"b","isActive":true}]}}': "t",
        '{"data":{"levels":[{"isActive":true},{"code":"b","isActive":true}]}}': "",
        '{"data":{"levels":[null,5,{"code":"c","isActive":"yes"}]}}': "c", '{"data":{"levels":[]}}': "", '{"data":{"levels":"x"}}': "", "{}": "", "[]": "",
    }
    df = spark.createDataFrame([(c,) for c in cases], "c string").select("c", F.parse_json("c").alias("v"))
    rows = df.select("c", flatten.active_level(F.col("v")).alias("l"))
    assert plan(rows).count("filter(") == 1
    assert {r["c"]: r["l"] for r in rows.collect()} == cases
