"""URL aliases, connected components, nearest neighbours and the pipeline."""

import random

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from catalog_spark.llm import neighbours, urls
from catalog_spark.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def test_components_against_union_find(spark):
    r = random.Random(2)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(220)] + [(1, i) for i in range(400, 460)] + [(500 + i, 501 + i) for i in range(70)] + [(7, 7), (None, 3)]
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(edges + edges[:20], "a long, b long"), "a", "b").collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_url_verdicts(spark):
    link = '<html><link rel="canonical" href="{}"></html>'
    rows = [
        (1, "https://a.com/de/x", ""), (2, "http://b.net/x", link.format("https://a.com/de/x?utm_source=z")), (3, "http://c.net/y", '<meta http-equiv="refresh" content="0; url=http://b.net/x/">'),
        (4, "http://d.org/q", link.format("//c.net/y")), (5, "http://e.net/", ""), (6, "https://www.f.net/p.html#t", ""), (7, "http://f.net/p", link.format("http://a.com/de/zz")), (8, None, None), (9, "no scheme", ""),
        (10, "HTTP://Sub.Example.ORG/en/12?x", ""), (11, "http://example.org/es", ""), (12, "http://example.org/es/q", ""), (12, "http://example.org/es/q", ""), (None, "http://xcom/fr/", ""),
    ]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.digest(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("id", F.lit(0)), guesses=True).collect()}
    assert got[1][2:] == ("com/de/", "block") and got[4][2:] == ("org/", "allow")
    assert got[2][2:] == (None, "allow") and got[3][3] == "allow"  # an alias is allowed explicitly
    assert got[6][2:] == (None, "allow") and got[7][2:] == (None, "allow")
    assert got[8] == got[9] == ("", "", None, "allow") and got[5][3] == "allow"
    assert got[10] == ("sub.example.org", "/en/12", "example.org/en/1", "block")
    assert got[11][2] == "org/" and got[12][3] == "block" and got[None][2] is None
    blocked = rows[:3] + rows[4:]
    got = {r["page_id"]: r["verdict"] for r in urls.digest(spark.createDataFrame(blocked, "page_id long, url string, html string"), guesses=True).collect()}
    assert got[2] == got[3] == "block"
    assert urls.digest(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_only_links_and_equal_addresses_make_aliases(spark):
    link = '<html><link rel="canonical" href="{}"></html>'
    rows = [
        (1, "https://a.com/de/x", ""), (2, "http://b.net/x", link.format("HTTPS://A.com:443/de/x#part")), (3, "http://b.net/x.html?ref=1", ""), (4, "http://www.b.net/x", ""), (5, "http://b.net:80/x#y", ""), (6, "https://b.net/x", ""),
        (7, "http://c.net", link.format("//b.net/x")), (8, "http://C.net/?", ""), (9, "http://c.net/", ""), (10, "http://d.net/p/q", '<meta http-equiv="refresh" content="0; url=../r">'), (11, "http://d.net/p/../r", ""),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.digest(df).collect()}
    assert {i for i, v in got.items() if v == "block"} == {1, 2, 5, 7, 9}
    component = {r["id"]: r["component"] for r in urls.judge(df).collect()}
    assert component[10] == component[11] and component[8] != component[9]
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    assert {(r[0], r[-1]) for r in con.sql(urls.SQL).fetchall()} == set(got.items())


def test_repeated_query_ids_ask_with_one_vector(spark):
    rows = [(i, [float(i), 1.0, 0.5]) for i in range(1, 40)] + [(20, [-3.0, 2.0, 1.0]), (20, [50.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    both = [sorted(map(tuple, neighbours.nearest(d, F.col("vec_id") == 20, k=5, certainty=0.999999).collect())) for d in (df, df.repartition(7).orderBy(F.desc("embedding")))]
    others = {i: np.array(v) for i, v in rows if i != 20}
    want = sorted(((float(v @ [-3.0, 2.0, 1.0]), -i) for i, v in others.items()), reverse=True)[:5]
    assert both[0] == both[1] == [(20, k + 1, -i, s) for k, (s, i) in enumerate(want)]


def exact(vectors, queries, k=20):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids])
    for q in queries:
        s = (x * vectors[q]).sum(axis=1)
        s[ids == q] = -np.inf
        best = np.lexsort((ids, -s))[: min(k, len(ids) - 1)]
        yield q, ids[best].tolist(), s[best].tolist()


def test_nearest_neighbours(spark):
    got = neighbours.nearest(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"), F.col("vec_id") % 20 == 0, cell_rows=100).toPandas()
    rows = pd.read_parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = {i: np.asarray(v, float) for i, v in zip(rows.vec_id, rows.embedding)}
    recalls = []
    for q, ids, scores in exact(vectors, [i for i in vectors if i % 20 == 0]):
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        recalls.append(len(set(ids) & set(mine.vec_id)) / 20)
        assert all(s == (vectors[q] * vectors[i]).sum() for i, s in zip(mine.vec_id, mine.score))
    assert np.mean(recalls) >= 0.9


def test_recall_and_rows_verified_with_the_settings_of_the_query(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    seen = spark.sparkContext.accumulator(0)
    got = neighbours.nearest(spark.read.parquet(path), F.col("vec_id") % 20 == 0, verified=seen).toPandas()
    rows = pd.read_parquet(path)
    vectors = {i: np.asarray(v, float) for i, v in zip(rows.vec_id, rows.embedding)}
    found = got.groupby("query_id").vec_id.apply(set)
    asked = [i for i in vectors if i % 20 == 0]
    recall = np.mean([len(set(ids) & found[q]) / 20 for q, ids, _ in exact(vectors, asked)])
    share = seen.value / (len(asked) * len(vectors))
    print(f"recall {recall:.3f}, rows verified {share:.2f} of {len(vectors)}")
    assert recall >= 0.93 and share < 0.9


def test_nearest_neighbours_odd_rows(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=6) * (1 + i % 7)]) for i in range(60)] + [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(60, 130)]
    bad = [(200, None), (220, [0.0] * 6), (240, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (260, [float("nan")] * 6), (280, [float("inf")] + [1.0] * 5), (300, [1.0]), (None, [1.0] * 6), (320, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("cell", F.lit("clash")).withColumn("rank", F.lit(1))
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, certainty=0.9999, cell_rows=16).toPandas()
    vectors = {i: np.array(v) for i, v in rows}
    for q, ids, scores in exact(vectors, [i for i in vectors if i % 20 == 0]):
        mine = got[got.query_id == q].sort_values("rank")
        assert mine.vec_id.tolist() == ids  # ties among the equal vectors go to smaller ids
    assert set(got.query_id) == {i for i in vectors if i % 20 == 0}
    few = neighbours.nearest(df.filter("vec_id IN (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert len(few) == 2 and neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_chi_square():
    assert abs(neighbours.chi_square(neighbours.chi_square_at(0.95, 8), 8) - 0.95) < 1e-9
    assert abs(neighbours.chi_square_at(0.95, 8) - 15.507) < 1e-3


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert len(corpus_pipeline.STAGES) == 5
    names = [n for n, _ in corpus_pipeline.STAGES]
    kept = stages[names[0]](spark, docs, SF)
    assert kept.columns == columns and kept.count() >= 0.98 * docs.count()
    odd = docs.unionByName(docs.filter("doc_id < 3")).unionByName(docs.filter("doc_id = 1").withColumn("text", F.lit("a wholly different text of some words")))
    single = stages[names[1]](spark, odd, SF)
    assert single.columns == columns and single.count() == single.select("doc_id").distinct().count() + 1  # id 1 has two unrelated texts
    assert single.filter("doc_id < 3").count() >= 1
    clean = stages[names[2]](spark, docs, SF)
    assert clean.columns == columns and clean.filter(F.col("text").rlike(r"[a-z]+\.\d+@mail")).count() == 0 and clean.count() == docs.count()
    assert clean.filter(F.length("text") != F.col("n_chars")).count() == 0
    mixed = stages[names[3]](spark, docs, SF)
    assert mixed.columns == columns and 0.8 < mixed.count() / (1.5 * docs.count()) < 1.2
    coded = corpus_pipeline.run(spark, SF)
    assert coded.columns == ["doc_id", "n_tokens", "ids", "decoded"] and coded.count() > docs.count()
    for name in names[:4]:
        assert stages[name](spark, docs.limit(0), SF).count() == 0


def test_entry_has_all_queries():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names}
