"""Secrets: base patterns, and weak candidates that complementary parts confirm.

A credential has parts: an access identifier, a secret and an endpoint. Base spans are strong parts. Weak candidates
(short access identifiers, user or client names, mixed tokens, short hexadecimal runs, service addresses) are
everywhere in clean texts, so they are reported only where complementary parts stand in their scope: at most ``SCOPE``
code points between the end of one and the start of the other. The interval join is a running maximum of ends, for
each role, over the starts and scopes' ends of a text in order: a part is in scope if any that starts before the
scope's end ends after the scope's start. No pairs are made.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import spans as S
from .tables import forget, map_arrow, materialise, slices

KINDS = ("assign", "access", "hex")
SCOPE = 200

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
NAME = re.compile(r"\b(?:user(?:name|_id)?|login|account|client_?id|access_?key(?:_?id)?)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.@-]{3,})", re.I | re.A)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}")
SHORT_HEX = re.compile(r"(?<![0-9A-Za-z])[0-9a-f]{16,23}(?![0-9A-Za-z])")
ADDRESS = re.compile(r"\b(?:https?|ftp|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]+", re.I | re.A)
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}


def base(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def weak(text: str, strong: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak candidates that overlap no base span."""
    out = [("weak_id", m.start(), m.end()) for m in NAME.finditer(text)]
    if "AKIA" in text:
        out += [("weak_id", m.start(), m.end()) for m in ACCESS.finditer(text) if 12 <= m.end() - m.start() < 20]
    for m in TOKEN.finditer(text):
        if re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0]):
            out.append(("weak_secret", m.start(), m.end()))
    out += [("weak_secret", m.start(), m.end()) for m in SHORT_HEX.finditer(text) if not m[0].isdigit() and not m[0].isalpha()]
    if "://" in text:
        out += [("endpoint", m.start(), m.end()) for m in ADDRESS.finditer(text)]
    taken, kept = sorted((a, b) for _, a, b in strong), []
    k = 0
    for c in sorted(out, key=lambda s: s[1]):
        while k < len(taken) and taken[k][1] <= c[1]:
            k += 1
        if k == len(taken) or taken[k][0] >= c[2]:
            kept.append(c)
    return kept


ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, base, weak) for each row; ``key`` names texts that have weak candidates."""

    def run(batches):
        for b in batches:
            for part, texts in slices(b, b.column(1)):
                keys, strong, faint = [], [], []
                for t in texts:
                    s = base(t) if t else []
                    w = weak(t, s) if t else []
                    keys.append(hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() if w else None)
                    strong.append([dict(zip(("kind", "start", "end"), x)) for x in s])
                    faint.append([dict(zip(("kind", "start", "end"), x)) for x in w])
                yield pa.RecordBatch.from_pydict({"id": part.column(0), "key": pa.array(keys, pa.string()), "base": pa.array(strong, ARROW_SPANS), "weak": pa.array(faint, ARROW_SPANS)})

    kind = docs.schema[id_col].dataType.simpleString()
    shape = f"id {kind}, key string, base array<{S.SPAN}>, weak array<{S.SPAN}>"
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, shape)


def confirmed(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(key, added): the weak candidates of each text that complementary parts confirm: an identifier needs a secret
    in its scope, a secret an identifier or an endpoint, an endpoint an identifier and a secret."""
    parts = found.filter("key IS NOT NULL").dropDuplicates(["key"])
    parts = parts.select("key", F.explode(F.concat("base", "weak")).alias("s")).select("key", "s.*")
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[F.col("kind")]
    places = F.array(F.struct(F.col("start").alias("at"), F.lit(False).alias("asks")), F.struct((F.col("end") + scope).alias("at"), F.lit(True).alias("asks")))
    events = parts.withColumn("role", role).select("*", F.explode(places).alias("p")).select("key", "kind", "start", "end", "role", "p.*")
    before = Window.partitionBy("key").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # of one place, starts come first
    reach = {r: F.max(F.when((F.col("role") == r) & ~F.col("asks"), F.col("end"))).over(before) for r in ("id", "secret", "endpoint")}
    has = {f"has_{r}": F.coalesce(c >= F.col("start") - scope, F.lit(False)) for r, c in reach.items()}
    told = events.withColumns(has).filter("asks")
    met = (
        F.when(F.col("kind") == "weak_id", F.col("has_secret"))
        .when(F.col("kind") == "weak_secret", F.col("has_id") | F.col("has_endpoint"))
        .when(F.col("kind") == "endpoint", F.col("has_id") & F.col("has_secret"))
        .otherwise(F.lit(False))
    )
    return told.filter(met).groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, base, spans) for each row: the base spans, and these with the confirmed weak candidates.

    A null text counts as empty and has no spans; repeated rows and repeated or null ids give a row each, equal texts
    equal spans; spans that start together stand by kind; an empty table gives no rows; other columns are dropped.
    Rows without weak candidates, mostly all, take no part in the join. The result is a table in the shared folder.
    """
    found = materialise(find(docs, id_col, text_col))
    added = materialise(confirmed(found, scope))
    none = F.array().cast(f"array<{S.SPAN}>")
    kinds = (*KINDS, "weak_id", "weak_secret", "endpoint")
    every = found.filter("key IS NOT NULL").join(added, "key", "left").select("id", "base", "added")
    every = every.union(found.filter("key IS NULL").select("id", "base", none.alias("added")))
    out = materialise(every.select("id", "base", S.ordered(F.concat("base", F.coalesce("added", none)), kinds, by_start=True).alias("spans")))
    forget(found, added)
    return out


def digest(docs: DataFrame) -> DataFrame:
    d = detect(docs)
    counts = [S.count(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return d.select(F.col("id").alias("doc_id"), *counts, F.sha2(S.listing(F.col("base")), 256).alias("base_sha256"), S.listing(F.col("spans")).alias("spans"))
