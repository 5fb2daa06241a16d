"""WARC captures, conversation repair and hard negatives against SQL in an independent engine, brute force and odd tables."""

import gzip
import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalog_spark.llm import conversations, negatives, queries, warc
from catalog_spark.llm.tables import spread_join

SF = "/root/testdata/sf0.001"
TABLES = {"op11_warc": "pages", "op12_conversation_repair": "conversations", "op13_hard_negatives": "embeddings"}


def plain(df, columns):
    return sorted(str(tuple("~" if pd.isna(x) else x if isinstance(x, str) else int(x) for x in r)) for r in df[columns].astype(object).values.tolist())


def by_sql(name, path):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {TABLES[name]} AS SELECT * FROM '{path}'")
    return con.sql(queries.ORACLE_SQL[name]).df()


@pytest.mark.parametrize("name", TABLES)
def test_query_against_sql(spark, name):
    want = by_sql(name, f"{SF}/{TABLES[name]}.parquet")
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and len(want) > 0
    assert plain(got, list(want.columns)) == plain(want, list(want.columns))


# WARC


def odd_pages(spark):
    inside = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0 WARC/1."
    rows = [(100 + i, f"http://a.com/{i}", "same") for i in range(1500)]
    rows += [(5000, "http://z/\r\nX: 1", inside), (5001, None, None), (5002, "u", ""), (None, "u", "only"), (None, "u", "only"), (5003, "q", "rep"), (5003, "q", "rep"), (5003, "q", "rep"), (5003, "r", "rep")]
    rows += [(7, "q", "ü☃" * 10), (8, "q", "ü☃" * 10), (9, "https://h.org/p?q#f", "long " * 400_000), (10, "", "\r\n\r\n"), (11, "x", inside * 50)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("id", "payload", "digest", "size", "value", "best", "record_id")})


def test_pages_come_back_from_archives(spark, tmp_path):
    odd = odd_pages(spark)
    odd.select("page_id", "url", "html").toPandas().astype({"page_id": "Int64"}).to_parquet(tmp_path / "pages.parquet")
    got, want = warc.digest(odd).toPandas(), by_sql("op11_warc", tmp_path / "pages.parquet")
    assert plain(got, list(want.columns)) == plain(want, list(want.columns))
    assert warc.digest(odd.limit(0)).count() == 0


def test_archives_hold_whole_records(spark, tmp_path):
    odd = odd_pages(spark).filter("page_id IS NULL OR page_id > 1500 OR page_id < 20")
    path = f"file://{tmp_path}/archives"
    warc.write(odd, path)
    files = sorted((tmp_path / "archives").glob("*.gz"))
    seen = []
    for f in files:  # a strict reader: by Content-Length, each record followed by one blank line
        data = gzip.open(f).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            n = int(re.search(rb"(?m)^Content-Length: (\d+)\r?$", head)[1])
            seen.append((head, rest[:n]))
            assert rest[n : n + 4] == b"\r\n\r\n"
            data = rest[n + 4 :]
    assert len(seen) == 3 * odd.count()
    ids = [re.search(rb"WARC-Record-ID: (\S+)", h)[1] for h, _ in seen]
    assert len(set(ids)) == len(ids)
    payloads = {b.partition(b"\r\n\r\n")[2] for h, b in seen if b"WARC-Type: response" in h}
    assert payloads == {(r["html"] or "").encode() for r in odd.select("html").collect()}
    back = warc.captures(warc.records(spark, path))
    rows = back.collect()
    assert len(rows) == odd.count() and all(r["request"]["type"] == "request" and len(r["metadata"]) == 1 and r["response"]["complete"] for r in rows)


def test_shorter_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "a", b"xy"), (2, "b", b"xy"), (3, "c", b"xyz"), (4, "d", b"xyz")], "id long, url string, payload binary")
    got = {r["id"]: r["role"] for r in warc.planned(pages, least=3).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_chains_and_orphans(spark, tmp_path):
    def record(kind, me, to=(), body=b"x", length=None):
        lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {me}", *(f"WARC-Concurrent-To: {t}" for t in to), f"Content-Length: {len(body) if length is None else length}"]
        return b"WARC/1.0\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"

    data = record("warcinfo", "i") + record("response", "r1") + record("request", "q1", ["r1"]) + record("metadata", "m1", ["q1"])  # a chain
    data += record("response", "r2", ["q2"]) + record("request", "q2") + record("metadata", "m2", ["r2"]) + record("metadata", "m3", ["gone"])  # the other direction, and a lost one
    data += record("response", "r1")
    with gzip.open(tmp_path / "a.warc.gz", "wb") as f:
        f.write(data)
    with gzip.open(tmp_path / "b.warc.gz", "wb") as f:
        f.write(record("metadata", "m4", ["r2"]) + record("response", "cut", length=500)[:-4])
    found = warc.records(spark, f"file://{tmp_path}/*.gz").cache()
    assert {r["record_id"]: r["complete"] for r in found.collect()}["cut"] is False
    got = sorted((r["record_id"], r["response"] is not None, r["request"]["record_id"] if r["request"] else None, sorted(m["record_id"] for m in r["metadata"])) for r in warc.captures(found).collect())
    assert got == [("cut", True, None, []), ("i", False, None, ["i"]), ("m3", False, None, ["m3"]), ("r1", True, "q1", ["m1"]), ("r1", True, "q1", ["m1"]), ("r2", True, "q2", ["m2", "m4"])]
    (tmp_path / "plain.warc").write_bytes(data * 200)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        with pytest.raises(Exception, match="compress archives"):
            warc.records(spark, f"file://{tmp_path}/plain.warc").count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_spread_join_keeps_every_row(spark):
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"), "id")
    keyed = left.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")).filter("k IS NOT NULL")
    got = spread_join(left, keyed, "k", "n", left.count).toPandas()
    want = left.join(keyed.drop("n"), "k", "left").select("k", "id", "top").toPandas()
    assert plain(got, ["k", "id", "top"]) == plain(want, ["k", "id", "top"])


# Conversations


def brute(rows):
    """(cost, audit, repaired rows) of the cheapest edits, by trying all; ``rows``: (role, text, must go, truncated)."""
    best = None
    todo = [(0, "", "", ())]
    while todo:
        cost, audit, initials, out = todo.pop()
        if best is not None and cost > best[0] or not re.fullmatch("s?(ua)*u?", initials):
            continue
        at = sum(c != "I" for c in audit)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, out)
        if not audit.endswith("II"):
            todo += [(cost + 3, audit + "I", initials + r[0], (*out, (r, ""))) for r in ("user", "assistant")]
        if at < len(rows):
            role, text, gone, short = rows[at]
            todo.append((cost + 4, audit + "D", initials, out))
            if not gone:
                extra = 3 * short
                todo.append((cost + extra, audit + "K", initials + (role[:1] or "-"), (*out, (role, text))))
                todo += [(cost + 3 + extra, audit + "R", initials + r[0], (*out, (r, text))) for r in ("user", "assistant")]
    return best


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repaired(spark, rows, **limits):
    edits = conversations.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit("clash")).withColumn("kind", F.lit("clash"))).orderBy("conv", "piece", "place").collect()
    out = {}
    for e in edits:
        audit, kept = out.setdefault(e["conv"], ([], []))
        audit.append(e["op"])
        if e["op"] != "D":
            kept.append((e["role"], e["text"]))
    return out


@pytest.mark.parametrize("piece_rows", [1, 2, 4096])
def test_repair_against_all_edits(spark, monkeypatch, piece_rows):
    monkeypatch.setattr(conversations, "PIECE_ROWS", piece_rows)
    r = random.Random(5)
    texts = ["Hello.", "So?", "cut off", " \t", "a.", "b!"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool", "user", "assistant"]), r.choice(texts)) for c in range(60) for t in range(r.randint(1, 5))]
    got = repaired(spark, rows)
    assert set(got) == set(range(60))
    for c in range(60):
        mine = [(role, text) for k, _, role, text in rows if k == c]
        cost, audit, out = brute([(role, text, f in ("blank", "duplicate"), f == "truncated") for (role, text), f in zip(mine, faults(mine))])
        assert ("".join(got[c][0]), tuple(got[c][1])) == (audit, out), (c, mine)


def trace(kinds):
    """Costs from the back over all rows, then the least letters that keep to them: a table of rows by states."""
    back = [[t[0] for t in conversations.TAIL]]
    for kind in reversed(kinds):
        back.append(conversations.backward(bytes([kind]), back[-1]))
    back.reverse()
    state, audit = conversations.START, ""
    for i, kind in enumerate(kinds):
        ways = [(letters, s) for s, way in enumerate(conversations.steps(kind)[state]) if way for cost, letters in [way] if cost + back[i + 1][s] == back[i][state]]
        letters, state = min(ways)
        audit += letters
    return audit + conversations.TAIL[state][1], back[0][0]


def test_halving_equals_the_whole_table():
    r = random.Random(1)
    for n in [0, 1, 2, 3, 7, 50, 333]:
        kinds = bytes(r.choice((0, 1, 1, 2, 2, 3, 5, 6, 9, 10)) for _ in range(n))
        last = conversations.ends(kinds)
        got = "".join(conversations.solve(kinds, conversations.START, last)) + conversations.TAIL[last][1]
        assert got == trace(kinds)[0]
        cuts = sorted(r.sample(range(1, n), min(5, n - 1))) if n > 1 else []
        pieces = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, n])]
        states = conversations.states_between([conversations.matrix(p) for p in pieces])
        assert "".join(x for p, a, b in zip(pieces, states, states[1:]) for x in conversations.solve(p, a, b)) + conversations.TAIL[states[-1]][1] == got


def test_a_long_conversation_lies_in_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE_ROWS", 100)
    r = random.Random(3)
    rows = [(1, i, r.choice(["user", "assistant", "assistant", "system"]), r.choice(["Same text.", f"text {i}.", f"open {i}", ""])) for i in range(3000)] + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    got = repaired(spark, rows)
    mine = [(role, text) for c, _, role, text in rows if c == 1]
    kinds = bytes("sua".index(role[0]) + (conversations.MUST_GO if f in ("blank", "duplicate") else conversations.TRUNCATED if f else 0) for (role, _), f in zip(mine, faults(mine)))
    assert "".join(got[1][0]) == trace(kinds)[0] and "".join(got[2][0]) == "KK"


def test_odd_conversations(spark):
    rows = [(1, None, "user", "late?"), (1, 0, None, None), (1, 2, "assistant", "ok."), (1, 2, "assistant", "ok."), (None, 1, "user", "x."), (None, None, "", "y."), (3, 5, "system", "z" * 300_000 + ".")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("clash") for c in ("conv", "op", "was", "place", "fault", "key")})
    got = {r["conv"]: [(e["op"], e["fault"]) for e in conversations.repair(df).orderBy("conv", "piece", "place").collect() if e["conv"] == r["conv"]] for r in [{"conv": 1}, {"conv": None}, {"conv": 3}]}
    assert got[1] == [("K", ""), ("D", "blank"), ("K", ""), ("D", "duplicate")]
    assert got[None] == [("R", ""), ("R", "")] and got[3] == [("D", "")]
    assert conversations.repair(df.limit(0)).count() == 0 and conversations.digest(df.limit(0)).count() == 0
    full = conversations.digest(df).toPandas()
    assert len(full) == 3 and full[full.audit == ""].repaired_sha256.isin([hashlib.sha256(b"").hexdigest()]).all()


# Hard negatives


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = negatives.hilbert(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_intervals_hold_and_products_are_exact():
    r = np.random.default_rng(0)
    for size in (100, 1 << 24):
        a, x = r.integers(-size, size, (5, 9)), r.integers(-size, size, (40, 9))
        low, high = negatives.intervals(a, x.min(0)[None], x.max(0)[None])
        exact = np.array([[sum(int(p) * int(q) for p, q in zip(u, v)) for v in x] for u in a])
        assert (negatives.products(a, x) == exact).all() and (low <= exact.min(1, keepdims=True)).all() and (high >= exact.max(1, keepdims=True)).all()


def brute_negatives(vectors, anchors, positives=5, negatives_=3):
    out = []
    for a in anchors:
        va, la = vectors[a]
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, l) for i, (v, l) in vectors.items() if i != a)
        for s, p, l in [x for x in scored if x[2] == la][:positives]:
            fits = [(i, -t) for t, i, k in scored if k != la and 50 * -s <= 100 * -t <= 95 * -s][:negatives_]
            out += [(a, p, rank, i, -s, t) for rank, (i, t) in enumerate(fits, 1)]
    return sorted(out)


def test_bounds_rule_out_blocks_and_nothing_is_lost(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(40, 8)) * 4
    vectors = {i: (np.floor(256 * (centres[i % 40] + r.normal(size=8) * 0.2)).astype(int).tolist(), int(r.integers(0, 3))) for i in range(2000)}
    rows = [(i, [x / 256 for x in v], l) for i, (v, l) in vectors.items()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    read = spark.sparkContext.accumulator(0)
    got = negatives.mine(df, F.expr("vec_id % 50 = 0"), F.col("label"), block_rows=16, tile_anchors=4, counted=read).collect()
    assert sorted(map(tuple, got)) == brute_negatives(vectors, range(0, 2000, 50))
    assert read.value < 0.6 * 2 * (2000 / 16) * (40 / 4)  # of all (tile, block) pairs of both passes


def test_odd_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=5)], i % 3) for i in range(120)] + [(i, [1.0, 2.0, 3.0, 4.0, 5.0], i % 2) for i in range(120, 170)]
    bad = [(200, None, 1), (250, [1.0, None, 1.0, 1.0, 1.0], 1), (300, [float("nan")] * 5, 1), (350, [float("inf")] + [1.0] * 4, 1), (400, [1.0], 1), (None, [1.0] * 5, 1), (450, [], 1), (500, [1.0] * 5, None), (550, [1e300] * 5, 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit("clash") for c in ("id", "cells", "tile", "block", "rank", "nth", "key")})
    vectors = {i: ([int(np.floor(256 * x)) for x in v], l) for i, v, l in rows}
    got = negatives.mine(df, F.expr("vec_id % 10 = 0"), F.col("label"), block_rows=7, tile_anchors=3)
    assert sorted(map(tuple, got.collect())) == brute_negatives(vectors, [i for i in vectors if i % 10 == 0])
    twice = negatives.mine(df.union(df.filter("vec_id = 30")), F.expr("vec_id = 30"), F.col("label")).collect()
    assert sorted(map(tuple, twice)) == brute_negatives(vectors, [30])
    assert negatives.mine(df.limit(0), F.lit(True), F.col("label")).count() == 0
    assert negatives.mine(df, F.lit(False), F.col("label")).count() == 0
