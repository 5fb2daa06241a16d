"""Language rejection, block edges, disclosure scores and fingerprints against plain computations."""

import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from catalog_spark.llm import langid, pieces, pii, queries, simhash, weighted

SF = "/root/testdata/sf0.001"


def test_no_subword_is_lost_at_block_edges(monkeypatch):
    r = random.Random(2)
    for _ in range(50):
        text = "".join(r.choice("abcÄß İ1 ") for _ in range(r.randint(0, 40)))
        whole = Counter(langid.subwords(text).tolist())
        for size in (1, 2, 3, 4, 7):
            assert Counter(np.concatenate([np.zeros(0, np.uint32), *langid.blocks(text, size)]).tolist()) == whole, (text, size)
    model = langid.train(["the cat sat on the mat"] * 10 + ["le chat est sur la table"] * 10, ["en"] * 10 + ["fr"] * 10)
    long = "the cat le chat " * 5000
    want = model.logits(long)
    monkeypatch.setattr(langid, "BLOCK", 1000)
    assert np.allclose(model.logits(long), want)


def test_rejection_is_calibrated_within_its_bounds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    assert 0.01 < model.temperature < 100 and 1 / len(model.langs) < model.threshold < 1
    rows = [(r["text"], r["lang"]) for r in docs.filter("lang IS NOT NULL").select("text", "lang").limit(600).collect()]
    strange = []
    for out_of in model.langs:  # a language that training never saw; some look like another one, and own rows come first
        part = langid.train([t for t, y in rows if y != out_of], [y for _, y in rows if y != out_of])
        strange.append(np.mean([part.predict(t)[2] for t, y in rows if y == out_of]))
    assert np.mean(strange) > 0.4
    own = [model.predict(t) for t, _ in rows]
    assert np.mean([p[2] for p in own]) <= 0.02


def test_one_or_two_languages():
    for langs in (["en"], ["en", "de"]):
        model = langid.train(["some words of a text"] * 8, (langs * 8)[:8])
        got = model.predict("some words of a text")
        assert got[0] in langs and 0 < got[1] <= 1 and not got[2]
    assert langid.train([], []).predict("x") == ("und", 0.0, True)


def plain_disclosure(texts, chance=pii.CHANCE, reach=pii.REACH):
    """(entity, term) -> lower bound of the share of the term's texts that point to the entity, by loops over the texts."""
    different = {t or "" for t in texts}
    docs, windows, holds = Counter(), defaultdict(set), defaultdict(set)
    near, seen = defaultdict(set), defaultdict(set)
    terms = {}
    for t in different:
        terms[t] = {x.casefold() for x in re.findall(r"[^\W\d_]{3,}", t)}
        docs.update(terms[t])
        found = pii.base(t)
        for kind, a, b in found:
            e = pii.entity(kind, t[a:b])
            low, high = max(0, a - pii.REACH_CHARS), min(len(t), b + pii.REACH_CHARS)
            words = [m.span() for m in re.compile(r"[^\x20\x09-\x0D]+").finditer(t, low, a)][-reach:] + [m.span() for m in re.compile(r"[^\x20\x09-\x0D]+").finditer(t, b, high)][:reach]
            here = []
            for m in re.finditer(r"[^\W\d_]{3,}", t):
                for x, y in words:
                    if x <= m.start() and m.end() <= y and not any(s < m.end() and m.start() < z for _, s, z in found):
                        here.append(m[0].casefold())
            windows[e].add(tuple(here))
            holds[e].add(t)
            for x in here:
                near[e, x].add(t)
                seen[e, x].add(tuple(here))

    def bound(k, n, s, tried):
        p, n = k / n, n * s / k
        z2 = 2 * math.log(max(tried, 1) / (2 * chance))
        return (p + z2 / (2 * n) - math.sqrt(z2 * (p * (1 - p) / n + z2 / (4 * n * n)))) / (1 + z2 / n)

    out = {}
    for e in windows:
        tried = len({x for w in windows[e] for x in w})
        scores = {x: bound(len(near[e, x]), docs[x], min(len(seen[e, x]), len(near[e, x])), tried) for f, x in near if f == e}
        tried = np.mean([len(terms[t]) for t in holds[e]])
        for x, k in Counter(x for t in holds[e] for x in terms[t]).items():
            scores[x] = max(scores.get(x, 0), bound(k, docs[x], min(k, len(windows[e])), tried))
        out |= {(e, x): v for x, v in scores.items() if v >= pii.GENERALISE and v * len(different) >= 2 * len(holds[e])}
    return out


@pytest.fixture(scope="module")
def disclosing_texts():
    r = random.Random(4)
    common = "now the report of a number from all that is at the town his her our".split()
    texts = []
    for who, mail in (("Zephyrine Straße", "ann@mail.example"), ("İstanbullu", "bob@mail.example"), ("GRÜSSE Quillon", "+49 (30) 123-4567")):
        for k in range(8):
            side = [r.choice(common) for _ in range(20)]
            texts.append(" ".join([*side[: r.randint(0, 9)], *(who.split() if r.random() < 0.8 else []), mail, *side[10:]]))
    texts += [" ".join(r.choice(common) for _ in range(60)) + r.choice(["", " straße", " STRASSE", " istanbullu"]) for _ in range(300)]
    return texts + texts[:5] + [None, "", "ﬁx ann@mail.example"]


def test_disclosure_against_plain_loops(spark, disclosing_texts):
    df = spark.createDataFrame([(t,) for t in disclosing_texts], "text string")
    got = {(r["entity"], r["term"]): r["disclosed"] for r in pii.disclosing(pii.scan(df)).collect()}
    want = plain_disclosure(disclosing_texts)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and len(want) >= 3
    real = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {(r["entity"], r["term"]): r["disclosed"] for r in pii.disclosing(pii.scan(spark.createDataFrame([(t,) for t in real], "text string"))).collect()}
    want = plain_disclosure(real)
    assert got.keys() == want.keys()


def test_folded_terms_are_counted_as_they_are_found(spark):
    """Spellings that folding changes are no rarer for it: a common word stays, whatever its letters."""
    rows = [(k, f"write {w} to ann.lee@mail.example now") for k, w in enumerate(["Straße", "Grüße", "İzmir", "Strasse"])]
    rows += [(100 + k, f"an der Straße mit Grüße aus İzmir und Strasse {k} " * 5) for k in range(40)]  # different by their numbers
    spans = {r["id"]: r["spans"] for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k in range(4):
        word = rows[k][1].split()[1]
        assert not any(rows[k][1][s["start"] : s["end"]] == word for s in spans[k])


def mask(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["id"]: r["spans"] for r in pii.detect(rows).collect()}
    return [{texts[k][s["start"] : s["end"]] for s in found[k] if s["kind"] in ("generalised", "removed")} for k in range(len(texts))]


def name_and_common(contexts, size):
    r = random.Random(8)
    common = [f"{a}{b}" for a in ("ba", "ke", "li", "mo", "nu") for b in ("rat", "sel", "tim", "von", "wug", "zap")]
    named = [" ".join([*r.sample(common, 5), "please write to Zephyrine at ann.lee@mail.example", *r.sample(common, 5)]) for _ in range(contexts)]
    return named, [" ".join(r.choice(common) for _ in range(40)) + " please write to us" for _ in range(size)]


def test_copies_neither_hide_nor_prove(spark):
    named, others = name_and_common(6, 300)
    for copies in (1, 10, 200):
        got = mask(spark, named * copies + others)
        assert all(g == {"Zephyrine"} for g in got[: len(named) * copies]) and not any(got[len(named) * copies :])
    one, others = name_and_common(1, 300)  # a single context proves nothing, however often it is copied
    for copies in (1, 10, 200):
        assert not any(mask(spark, one * copies + others))


def test_a_larger_corpus_marks_the_same_terms(spark):
    named, others = name_and_common(6, 3000)
    hapax = [f"{o} singular{chr(97 + k)}word carl.{k}@mail.example" for k, o in enumerate(others[:20])]
    small, large = mask(spark, named + hapax + others[20:300]), mask(spark, named + hapax + others[20:])
    n = len(named) + len(hapax)
    assert small[:n] == large[:n] and all(g == {"Zephyrine"} for g in small[:6]) and not any(small[6:]) and not any(large[6:])


def test_a_word_with_other_company_stays(spark):
    named, others = name_and_common(6, 300)
    got = mask(spark, named + others + [f"Zephyrine {o}" for o in others[:60]])
    assert not any(got)


def test_many_addresses_in_one_text():
    for glue in (" and then ", ","):
        text = glue.join(f"name{chr(97 + k % 26)} x{k}@mail.example" for k in range(20_000))
        start = time.time()
        spans = pii.base(text)
        taken = pii.covered(spans)
        assert sum(len(pii.around(text, a, b, taken)) for _, a, b in spans) > 0
        assert len(pii.added(text, spans, {"then": 1, "and": 2})) == (2 * 19_999 if " " in glue else 0)
        assert time.time() - start < 10


def test_many_disclosing_terms_take_the_join(spark, disclosing_texts, monkeypatch):
    rows = [(k, t, "clash", 1) for k, t in enumerate(disclosing_texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, h int")
    want = [sorted(map(tuple, r["spans"])) for r in pii.detect(df).orderBy("id").collect()]
    clean = sorted(map(str, pii.sanitise(df).collect()))
    monkeypatch.setattr(pii, "MOST_TOLD", 0)
    assert [sorted(map(tuple, r["spans"])) for r in pii.detect(df).orderBy("id").collect()] == want
    assert sorted(map(str, pii.sanitise(df).collect())) == clean and pii.sanitise(df).columns == df.columns
    assert sum(map(len, want)) > 30


def test_fingerprints_against_plain_bits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    for t in [d["text"] for d in docs] + [None, "", " \t", "one", "One two", "a b c", "a b c d a b c"]:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(t) == want, t


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    keys = set(a) | set(b)
    return sum(min(a[x], b[x]) for x in keys) / sum(max(a[x], b[x]) for x in keys) if keys else 1.0


def test_likeness_to_the_next_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op3_weighted_fingerprints(spark, SF).collect()}
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    errors = [got[i]["near_next"] - jaccard(t, rows[(k + 1) % len(rows)][1]) for k, (i, t) in enumerate(rows)]
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.5
    assert all(got[i]["near_next"] == 1 for k, (i, t) in enumerate(rows) if t == rows[(k + 1) % len(rows)][1])


def test_repeated_and_null_ids_are_dealt_over_ranges(spark):
    texts = [f"text number {k} of some words" for k in range(200)]
    rows = [(None if k % 2 else 7, t) for k, t in enumerate(texts)] + [(7, texts[0])] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string")
    placed = weighted.in_ranges(df, "doc_id", "text")
    assert placed.groupBy("part").count().agg(F.max("count")).first()[0] <= len(rows) / 5
    assert placed.select("slot").distinct().count() == placed.select("part").distinct().count()
    got = weighted.digest(df).collect()
    assert len(got) == len(rows)
    same = [r for r in got if r["near_next"] == 1.0]
    assert len(same) >= 49 and Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)


def test_the_cache_is_bounded_within_one_text(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_BYTES", 20_000)
    monkeypatch.setattr(pieces, "PAIR_ENTRIES", 50)
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    c = pieces.MergeCoder(pieces.model_bytes(pieces.default_model()))
    r = random.Random(3)
    text = " ".join("".join(r.choice("abcdefgh,.") for _ in range(r.randint(1, 12))) for _ in range(20_000))
    assert np.frombuffer(c.framed(text), "<u4").tolist() == lib.encode(text, add_bos=True, add_eos=True)
    assert c.size <= 20_000 + 2000 and len(c.fits) <= 50 and sum(len(k) + len(v) for k, v in c.known.items()) <= 22_000
    c.forget()
    assert not c.known and not c.fits


def test_resampling_is_what_emitting_gives(spark):
    from catalog_spark.llm import mixing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.unionByName(docs.filter("doc_id < 9")).unionByName(docs.filter("doc_id < 9")).unionByName(docs.limit(3).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string")}))
    odd = odd.withColumns({"size": F.lit("clash"), "k1": F.lit(0), "row": F.lit("clash"), "copies": F.lit(7)})
    want = mixing.emit(mixing.mix(odd, size=mixing.word_count(F.col("text"))))
    got = mixing.resample(odd)
    assert got.columns == odd.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert mixing.resample(odd.limit(0)).count() == 0
