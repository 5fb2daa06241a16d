"""The pipeline's result against plain loops over the documents, and its stages on odd rows."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from catalog_spark.llm import langid, mixing, pieces, pii, simhash, spans
from test_calibration_and_disclosure import plain_disclosure

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
NAMES = list(STAGES)


def plain_pipeline(spark, docs):
    """doc_id -> (copies, ids, decoded) by loops; the language model is the trained one."""
    rows = docs.toPandas().sort_values("doc_id")
    model = langid.fit(docs.filter(langid.fold(F.col("doc_id")) != 2))
    rows = rows[[not model.predict(t)[2] for t in rows.text]].reset_index(drop=True)
    prints = np.array([simhash.fingerprint(t) for t in rows.text], np.uint64)
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= 3):
            a, b = group[i], group[int(j)]
            group = [min(a, b) if g in (a, b) else g for g in group]
    rows = rows[[g == i for i, g in enumerate(group)]].reset_index(drop=True)
    told: dict[str, float] = {}
    for (_, term), d in plain_disclosure(list(rows.text)).items():
        told[term] = max(d, told.get(term, 0))
    clean = []
    for t in rows.text:
        found = pii.base(t)
        marks = [(a, b, pii.MARKS[k]) for k, a, b in found]
        for m in pii.TERM.finditer(t):
            if m[0].casefold() in told and not any(s < m.end() and m.start() < e for _, s, e in found):
                marks.append((m.start(), m.end(), pii.MARKS["removed" if told[m[0].casefold()] >= pii.REMOVE else "generalised"]))
        clean.append(spans.masked(t, marks))
    rows["text"] = clean
    con = duckdb.connect()
    con.register("documents", rows)
    mixed = con.sql(mixing.SQL).df().set_index("doc_id")
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    out = {}
    for r in rows.itertuples():
        m = mixed.loc[r.doc_id]
        if m["taken"]:
            ids = lib.encode(r.text, add_bos=True, add_eos=True)
            out[r.doc_id] = (int(m["taken"] / m["size"]), ids, lib.decode(ids))
    return out


def test_pipeline_against_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_pipeline(spark, docs)
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert got.groupby("doc_id").size().to_dict() == {i: n for i, (n, _, _) in want.items()}
    for r in got.itertuples():
        _, ids, decoded = want[r.doc_id]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == decoded and r.n_tokens == len(ids)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in all columns, empty and very long texts, ties, repeated rows and ids, and columns with clashing names."""
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    prose = lambda n: " ".join(word() for _ in range(n))
    long = prose(400_000)  # beyond two blocks of the classifier
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, prose(60), "en", "a", 1), (None, prose(60), "de", None, None), (None, prose(60), None, "b", 9), (5, long, "en", "a", None), (5, prose(60), "de", "b", 3), (6, "mail me: ann@mail.example " + prose(30), "en", "a", 2)]
    df = spark.createDataFrame(rows + rows[2:3], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in ("row", "key", "fp", "size", "copies", "id", "component", "k1", "_kept", "spans")})


def texts(df):
    return sorted((str(r["doc_id"]), r["text"] or "") for r in df.select("doc_id", "text").collect())


def test_stages_on_odd_rows(spark, odd):
    every = texts(odd)
    kept = STAGES[NAMES[0]](spark, odd, SF)
    assert kept.columns == odd.columns and set(texts(kept)) <= set(every) and not any(t == "" for _, t in texts(kept))
    single = STAGES[NAMES[1]](spark, odd, SF)
    got = texts(single)
    # Rows without words are one group; the repeated row is one; all other texts differ, whatever their ids.
    assert single.columns == odd.columns and len(got) == len(set(got)) == len({t for _, t in every}) and {t for _, t in got} == {t for _, t in every}
    clean = STAGES[NAMES[2]](spark, odd, SF)
    assert clean.columns == odd.columns and clean.count() == odd.count() and not any("@" in t for _, t in texts(clean))
    assert clean.filter("text IS NULL").count() == 1 and clean.filter("n_chars <> length(text)").count() == 0
    mixed = STAGES[NAMES[3]](spark, odd, SF)
    assert mixed.columns == odd.columns and set(texts(mixed)) <= set(every) and mixed.count() > 0
    coded = STAGES[NAMES[4]](spark, odd, SF)
    assert coded.columns == ["doc_id", "n_tokens", "ids", "decoded"] and sorted((str(r["doc_id"]), r["decoded"]) for r in coded.collect()) == every
    assert coded.filter("n_tokens = 2").count() == 2  # the null text and the empty one: begin and end


def test_empty_tables(spark, odd):
    for name in NAMES:
        assert STAGES[name](spark, odd.limit(0), SF).count() == 0
