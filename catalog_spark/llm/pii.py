"""Personal data: patterns, and terms that reveal them.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. Each value found is a protected entity e.
The corpus then tells how strongly a term t reveals it: of all different texts that hold t, the share p(e | t) in which t
stands near a mention of e (within ``REACH`` words), or anywhere beside one. -log2 p(e | t) bits of doubt are what t leaves;
t discloses e if few are left, and fewer than before: at most 2 bits and a third (p of ``GENERALISE``) for being
generalised to a mark, at most one (``REMOVE``) for being removed, and one less than e's own -log2 p(e) at least.
Terms that disclose are masked wherever they occur in any text.

p(e | t) is not taken as observed: it is a lower confidence bound (Wilson's), so that few contexts prove little, at a
level of ``CHANCE`` divided by the number of terms that were tried for e, so that many trials do not make finds by
chance. All of this comes from the contexts of t and e themselves: other texts, however many, change nothing. Copies of
a text are one context on both sides, and equal surroundings of e are one observation.

Two passes over the texts: ``scan`` lists mentions and counts terms, and a second one marks spans. Up to ``MOST_TOLD``
disclosing terms go to the workers as 64-bit hashes, 9 bytes a term; if there are more, each text's terms are joined
with them instead, after a Bloom filter of ``FILTER_BITS`` bits has left out most that do not disclose.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .tables import forget, map_arrow, materialise, slices

KINDS = ("email", "ip", "card", "phone")
REACH = 6
REACH_CHARS = 200  # of a window, on each side
CHANCE = 0.05
GENERALISE = 0.2
REMOVE = 0.5
MOST_TOLD = 2_000_000
FILTER_BITS = 1 << 25
COUNTED = 100_000  # different terms that a task counts before it hands them on

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")
LETTER = re.compile(r"[^\W\d_]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "generalised": "<TERM>", "removed": ""}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str):
    """An address starts where the run of its local part's characters starts, or where the address before ends."""
    floor, at = 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at + 1)
        if m:
            start = at
            while start > floor and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                floor = m.end()
        at = text.find("@", max(at + 1, floor))


def base(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed in KINDS, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        parts = (p.lstrip("0") for p in m[0].split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def entity(kind: str, value: str) -> str:
    """One spelling of a value: letters lower-cased, and only digits of numbers."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(filter(str.isdigit, value))}"


def covered(found: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover, in order."""
    starts, ends = [], []
    for _, a, b in sorted(found, key=lambda s: s[1]):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def around(text: str, start: int, end: int, taken: tuple[list[int], list[int]], reach: int = REACH) -> list[tuple[str, int, int]]:
    """Terms (case-folded) within ``reach`` words and ``REACH_CHARS`` of a mention, outside the stretches of all base
    spans, with their places. A term that an edge of the window or of a mention cuts is left out."""
    low, high = max(0, start - REACH_CHARS), min(len(text), end + REACH_CHARS)
    left, right = [m.span() for m in WORD.finditer(text, low, start)][-reach:], []
    for m in WORD.finditer(text, end, high):
        right.append(m.span())
        if len(right) == reach:
            break
    out = []
    for a, b in left + right:
        for m in TERM.finditer(text, a, b):
            x, y = m.span()
            if (x and LETTER.match(text, x - 1)) or LETTER.match(text, y):
                continue
            k = bisect_right(taken[0], y - 1) - 1
            if k < 0 or taken[1][k] <= x:
                out.append((m[0].casefold(), x, y))
    return out


SCANNED = "key string, n_terms long, terms array<string>, mentions array<struct<entity:string,terms:array<string>>>, term string, n_docs double, n_texts double"
ARROW_PLAIN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
ARROW_SCANNED = pa.schema([
    ("key", pa.string()), ("n_terms", pa.int64()), ("terms", pa.list_(pa.string())), ("mentions", pa.list_(pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))]))),
    ("term", pa.string()), ("n_docs", pa.float64()), ("n_texts", pa.float64()),
])

def terms(text: str) -> list[str]:
    return [x.casefold() for x in TERM.findall(text)]


def text_key(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def term_hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"))


def scan(texts: DataFrame) -> DataFrame:
    """Over the column ``text``, three sorts of rows: (key, n_terms, terms, mentions) for each text with base spans, its
    different terms and those near each mention; (term, n_docs) partial numbers of different texts with the term;
    and (n_texts) partial numbers of different texts. Each of n copies counts 1/n. A null text is a text without terms."""
    t = F.coalesce("text", F.lit(""))
    hashes = [F.xxhash64(t).alias("h1"), F.xxhash64(t, F.lit(1)).alias("h2")]
    copies = materialise(texts.select(*hashes).groupBy("h1", "h2").agg(F.count("*").alias("copies")).filter("copies > 1"))
    keyed = texts.select("text", *hashes).join(copies, ["h1", "h2"], "left").select("text", F.coalesce("copies", F.lit(1)).alias("copies"))

    def counts(docs: dict[str, float]) -> Iterator[pa.RecordBatch]:
        listed = list(docs)
        for k in range(0, len(listed), 10_000):
            yield _rows(term=(some := listed[k : k + 10_000]), n_docs=[docs[x] for x in some])
        docs.clear()

    def run(batches):
        docs: Counter = Counter()
        n_texts = 0.0
        for b in batches:
            for part, some in slices(b, b.column(0)):
                keys, here, mentions = [], [], []
                for t, n in zip(some, part.column(1).to_pylist()):
                    n_texts += 1 / n
                    if not t:
                        continue
                    different = {x.casefold() for x in set(TERM.findall(t))}
                    if n == 1:
                        docs.update(different)
                    else:
                        for x in different:
                            docs[x] += 1 / n
                    if spans := base(t):
                        taken = covered(spans)
                        keys.append(text_key(t))
                        here.append(sorted(different))
                        mentions.append([{"entity": entity(k, t[a:e]), "terms": [x[0] for x in around(t, a, e, taken)]} for k, a, e in spans])
                if keys:
                    yield _rows(key=keys, n_terms=[len(x) for x in here], terms=here, mentions=mentions)
                if len(docs) > COUNTED:
                    yield from counts(docs)
        yield from counts(docs)
        if n_texts:
            yield _rows(n_texts=[n_texts])

    out = materialise(map_arrow(keyed, run, SCANNED))
    forget(copies)
    return out


def _rows(**columns: list) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * n), f.type) for f in ARROW_SCANNED], schema=ARROW_SCANNED)


def bound(n_both: Column, n_term: Column, seen: Column, tried: Column, chance: float = CHANCE) -> Column:
    """Wilson's lower bound of the share n_both / n_term, as if of ``seen`` observations for ``n_both``, at a level of
    ``chance`` / ``tried``; its quantile is bounded by Chernoff's inequality."""
    n_term = F.greatest(n_term, n_both.cast("double"))
    share, n = n_both / n_term, n_term * seen / n_both
    z2 = 2 * F.log(F.greatest(tried, F.lit(1.0)) / (2 * chance))
    return (share + z2 / (2 * n) - F.sqrt(z2 * (share * (1 - share) / n + z2 / (4 * n * n)))) / (1 + z2 / n)


def disclosing(scanned: DataFrame, generalise: float = GENERALISE, chance: float = CHANCE) -> DataFrame:
    """(entity, term, disclosed) for the terms that leave little doubt about an entity; ``disclosed`` is the lower bound
    of p(e | t), from ``generalise`` on and at least twice p(e).

    ``scanned`` is the output of ``scan`` over the whole corpus. All pairs are scored, near mentions and over whole
    texts, where each text's terms are tried. Entities in too few texts for any term's bound to reach ``generalise``
    are left out before their texts' terms are listed, which changes no result.
    """
    c = F.col
    counts = materialise(scanned.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n_docs").alias("n_term")))
    n_texts = scanned.agg(F.sum("n_texts")).first()[0] or 0.0
    texts = materialise(scanned.filter("key IS NOT NULL").select("key", "n_terms", "terms", "mentions").dropDuplicates(["key"]))
    mentions = texts.select("key", "n_terms", F.explode("mentions").alias("m")).select("key", "n_terms", "m.entity", F.xxhash64("m.terms").alias("window"), F.array_distinct("m.terms").alias("terms"))
    mentions = materialise(mentions)
    entities = mentions.groupBy("entity").agg(F.countDistinct("key").alias("n_entity"), F.countDistinct("window").alias("windows"))
    entities = materialise(entities.join(mentions.select("entity", F.explode("terms").alias("t")).groupBy("entity").agg(F.countDistinct("t").alias("tried")), "entity", "left"))
    pairs = mentions.select("entity", "key", "window", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.countDistinct("key").alias("n_both"), F.countDistinct("window").alias("seen"))
    pairs = pairs.withColumn("seen", F.least("seen", "n_both")).join(entities.select("entity", "n_entity", c("tried").cast("double").alias("tried")), "entity")

    holds = mentions.select("entity", "key", "n_terms").distinct()
    sizes = holds.groupBy("entity").agg(F.avg("n_terms").alias("tried")).join(entities.select("entity", "n_entity", "windows"), "entity").withColumn("most", F.least("n_entity", "windows").cast("double"))
    many = materialise(sizes.filter(bound(c("most"), c("most"), c("most"), c("tried"), chance) >= generalise).drop("most"))
    if not many.isEmpty():
        far = holds.join(many, "entity").join(texts.select("key", F.explode("terms").alias("term")), "key")
        far = far.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.first("windows").alias("windows"), F.first("n_entity").alias("n_entity"), F.first("tried").alias("tried"))
        pairs = pairs.unionByName(far.select("entity", "term", "n_both", F.least("n_both", "windows").alias("seen"), "n_entity", "tried"))
    scored = pairs.join(counts, "term").withColumn("disclosed", bound(c("n_both"), c("n_term"), c("seen"), c("tried"), chance))
    told = scored.filter((c("disclosed") >= generalise) & (c("disclosed") * n_texts >= 2 * c("n_entity")))
    told = materialise(told.groupBy("entity", "term").agg(F.max("disclosed").alias("disclosed")))
    forget(counts, texts, mentions, entities, many)
    return told


def told_terms(texts: DataFrame, remove: float = REMOVE, **limits) -> DataFrame:
    """(h, removed): the disclosing terms as 64-bit hashes, and whether they are removed or generalised."""
    scanned = scan(texts)
    found = disclosing(scanned, **limits)

    def run(batches):
        for b in batches:
            hashes = np.array([term_hash(t) for t in b.column(0).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), b.column(1)], ["h", "removed"])

    told = materialise(found.groupBy("term").agg((F.max("disclosed") >= remove).alias("removed")).mapInArrow(run, "h long, removed boolean"))
    forget(scanned, found)
    return told


class Told:
    """Verdicts on terms: 2 to remove, 1 to generalise, 0 neither. ``rows``: (h, removed) of disclosing terms."""

    def __init__(self, rows: pa.Table):
        hashes = rows.column("h").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.verdict = hashes[order], 1 + rows.column("removed").to_numpy()[order].astype(np.int8)

    def verdicts(self, spelled: set[str]) -> dict[str, int]:
        """Those of the spellings that disclose, with their verdict."""
        asked = list(spelled) if len(self.hashes) else []
        hashes = np.array([term_hash(x.casefold()) for x in asked], np.uint64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return {asked[i]: int(self.verdict[at[i]]) for i in np.flatnonzero(self.hashes[at] == hashes).tolist()}


def added(text: str, found: list[tuple[str, int, int]], verdicts: dict[str, int]) -> list[tuple[str, int, int]]:
    """Kinds ``generalised`` and ``removed``: every occurrence of the terms outside the base spans ``found``."""
    out, taken = [], covered(found)
    for m in TERM.finditer(text):
        if v := verdicts.get(m[0]):
            k = bisect_right(taken[0], m.end() - 1) - 1
            if k < 0 or taken[1][k] <= m.start():
                out.append(("removed" if v == 2 else "generalised", *m.span()))
    return out


def bloom(hashes: np.ndarray, bits: np.ndarray | None = None) -> np.ndarray:
    """Four places of each hash, as an array; with ``bits`` given, whether all four are set."""
    unused = np.uint64(65 - FILTER_BITS.bit_length())
    places = np.stack([(hashes >> np.uint64(s)) * np.uint64(0x9E3779B97F4A7C15) >> unused for s in (0, 7, 17, 29)])
    return places if bits is None else (bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1).all(axis=0)


def bloom_filter(told: DataFrame) -> np.ndarray:
    """``FILTER_BITS`` bits with the places of all hashes set; each task hands on the bytes that it has set."""

    def run(batches):
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for b in batches:
            places = bloom(b.column(0).to_numpy().view(np.uint64)).ravel()
            np.bitwise_or.at(bits, places >> np.uint64(3), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
        at = np.flatnonzero(bits)
        for k in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[k : k + 100_000]), pa.array(bits[at[k : k + 100_000]].astype(np.int16))], ["at", "byte"])

    got = told.select("h").mapInArrow(run, "at long, byte short").groupBy("at").agg(F.bit_or("byte").alias("byte")).toArrow()  # FILTER_BITS / 8 rows at most
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    bits[got.column("at").to_numpy()] = got.column("byte").to_numpy().astype(np.uint8)
    return bits


def with_told(docs: DataFrame, text_col: str, told: DataFrame) -> DataFrame:
    """``docs`` with the disclosing terms (h, removed) of each text as ``_told``, by a join on terms; no task or driver
    holds all disclosing terms."""
    sent = docs.sparkSession.sparkContext.broadcast(bloom_filter(told))

    def run(batches):
        for b in batches:
            for _, some in slices(b, b.column(0)):
                keys, hashes = [], [np.zeros(0, np.uint64)]
                for t in some:
                    here = np.array([term_hash(x) for x in set(terms(t))] if t else [], np.uint64)
                    here = here[bloom(here, sent.value)]
                    hashes.append(here)
                    keys += [text_key(t)] * len(here) if len(here) else []
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(np.concatenate(hashes).view(np.int64))], ["key", "h"])

    asked = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "key string, h long").distinct()
    hits = materialise(asked.join(told, "h").groupBy("key").agg(F.collect_list(F.struct("h", "removed")).alias("_told")))  # at most a text's terms
    key = F.sha2(F.col(f"`{text_col}`").cast("binary"), 256)
    hits = hits.withColumnRenamed("key", "_key")
    return docs.join(hits, key == F.col("_key"), "left").drop("_key")


def marked(docs: DataFrame, text_col: str, out: Callable, schema) -> DataFrame:
    """``out(batch, texts, base spans, added spans)`` over all rows of ``docs``; ``schema`` describes what it returns."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    told = told_terms(texts)
    at, few = docs.columns.index(text_col), told.count() <= MOST_TOLD
    if few:
        sent = docs.sparkSession.sparkContext.broadcast(told.toArrow())
        forget(told)
    rows = docs if few else with_told(docs, text_col, told)
    shape = pa.schema([("h", pa.int64()), ("removed", pa.bool_())])

    def run(batches):
        every = Told(sent.value) if few else None
        for b in batches:
            for part, some in slices(b, b.column(at)):
                spelled = [set(TERM.findall(t)) if t else set() for t in some]
                if few:
                    hits = every.verdicts(set().union(*spelled))
                    verdicts = [{x: v for x, v in hits.items() if x in mine} for mine in spelled]
                else:
                    told_of = part.column(part.num_columns - 1).to_pylist()
                    verdicts = [Told(pa.Table.from_pylist(x or [], shape)).verdicts(mine) for x, mine in zip(told_of, spelled)]
                    part = part.select(range(part.num_columns - 1))
                found = [base(t) if t else [] for t in some]
                yield out(part, some, found, [added(t, f, v) if v else [] for t, f, v in zip(some, found, verdicts)])

    return map_arrow(rows, run, schema)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) for each row: the base spans, and these with the spans that the method adds.

    A null text counts as empty and has no spans; repeated rows and repeated or null ids give a row each, equal texts
    equal spans; an empty table gives no rows; other columns are dropped. The windows around a mention hold a bounded
    number of words, so a very long text costs time in proportion.
    """
    one = lambda found: [dict(zip(("kind", "start", "end"), x)) for x in found]

    def out(part, texts, found, more):
        plain, every = [one(f) for f in found], [one(f + m) for f, m in zip(found, more)]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(plain, ARROW_PLAIN), pa.array(every, ARROW_PLAIN)], ["id", "base", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    done = marked(rows, "text", out, f"id {kind}, base array<{S.SPAN}>, spans array<{S.SPAN}>")
    kinds = (*KINDS, "generalised", "removed")
    return done.select("id", "base", S.ordered(F.col("spans"), kinds, by_start=False).alias("spans"))


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced by marks or removed; all columns and rows stay, null
    texts stay null. Each row passes through Python once."""
    at = docs.columns.index(text_col)

    def out(part, texts, found, more):
        clean = [S.masked(t, [(s, e, MARKS[k]) for k, s, e in f + m]) if f or m else t for t, f, m in zip(texts, found, more)]
        return part.set_column(at, part.schema.field(at), pa.array(clean, part.schema.field(at).type))

    return marked(docs, text_col, out, docs.schema)


def digest(docs: DataFrame) -> DataFrame:
    d = detect(docs)
    counts = [S.count(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return d.select(F.col("id").alias("doc_id"), *counts, F.sha2(S.listing(F.col("base")), 256).alias("base_sha256"), S.listing(F.col("spans")).alias("spans"))
