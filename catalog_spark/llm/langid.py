"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A text's subwords are the runs of 1 to 3 characters of its lower-cased letters, with a blank for every other
character; runs without a letter do not count. Each is hashed to a bucket with an embedding; their mean goes through a
linear layer and softmax. A temperature fitted on labelled rows that training did not see calibrates the
probabilities; its targets are smoothed by the number of rows, so that it stays finite where no row is wrong.

Rejection is calibrated on two sorts of rows: own ones (held-out rows of the languages learned) and foreign ones (rows
of each language in turn under a model trained without it). The threshold rejects ``FOREIGN`` of the foreign rows, but
no more than ``LOST`` of the own rows. Training takes a bounded sample (``SAMPLE_DOCS`` rows, as many of each language,
and no more than have ``SAMPLE_CHARS`` characters in all) of whole texts; prediction takes every whole text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import map_arrow, slices

SAMPLE_DOCS = 4000
SAMPLE_CHARS = 32_000_000
BUCKETS = 1 << 16
DIMS = 12
EPOCHS = 6
RATE = 2.0
BATCH = 16
LOST = 0.005
FOREIGN = 0.95
FOREIGN_DOCS = 1000  # rows that each model without one language is trained on
GRAMS = 3
BLOCK = 1 << 20


@lru_cache(maxsize=1)
def letter() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((not 0xD800 <= i < 0xE000 and chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def subwords(text: str) -> np.ndarray:
    """Buckets of all subwords of a text."""
    return np.concatenate([np.zeros(0, np.uint32), *blocks(text)])


def blocks(text: str, size: int | None = None):
    """The same in blocks of at most ``size`` characters. A block also sees the two characters before it, and each
    subword belongs to the block that its last character falls in, so that none is lost or counted twice."""
    low, size = text.lower(), size or BLOCK
    for k in range(0, len(low), size):
        lead = min(k, GRAMS - 1)
        points = np.frombuffer(low[k - lead : k + size].encode("utf-32-le", "surrogatepass"), "<u4")
        is_letter = letter()[points]
        c = np.where(is_letter, points, 32).astype(np.uint32)
        mixed, has = np.zeros(len(c), np.uint32), np.zeros(len(c), bool)
        for n in range(1, GRAMS + 1):
            left = len(c) - n + 1
            if left <= 0:
                break
            mixed = (mixed[:left] * np.uint32(0x01000193)) ^ (c[n - 1 :] * np.uint32(0x9E3779B1))
            has = has[:left] | is_letter[n - 1 :]
            h = mixed ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            own = max(0, lead - n + 1)
            yield (h >> np.uint32(16))[own:][has[own:]]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    """``table`` holds each bucket's contribution to the logits, that is embedding x linear layer."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, threshold: float):
        self.langs, self.table, self.bias, self.temperature, self.threshold = langs, table, bias, temperature, threshold

    def logits(self, text: str) -> np.ndarray | None:
        """Null for a text without letters. Long texts go block by block."""
        total, n = np.zeros(len(self.langs)), 0
        for piece in blocks(text):
            total += self.table[piece].sum(axis=0, dtype=np.float64)
            n += len(piece)
        return total / n + self.bias if n else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, rejected)."""
        z = self.logits(text) if text and self.langs else None
        if z is None:
            return "und", 0.0, True
        p = softmax(z / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k]), bool(p[k] < self.threshold)


def _rows(texts: list[str], labels: list[str]) -> list[tuple[np.ndarray, np.ndarray, int, str]]:
    """(buckets, counts, subwords, language) of the texts that have subwords."""
    rows = ((subwords(t), y) for t, y in zip(texts, labels))
    return [(*np.unique(s, return_counts=True), len(s), y) for s, y in rows if len(s)]


def _descend(fit: list[tuple], langs: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(table, bias) by stochastic gradient descent in mini-batches."""
    rng = np.random.default_rng(seed)
    emb, w, b = np.zeros((BUCKETS, DIMS), np.float32), rng.normal(0, 1, (DIMS, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    emb += rng.uniform(-0.05, 0.05, emb.shape).astype(np.float32)
    for epoch in range(EPOCHS):
        order, rate = rng.permutation(len(fit)), RATE * (1 - epoch / EPOCHS)
        for k in range(0, len(order), BATCH):
            batch = [fit[i] for i in order[k : k + BATCH]]
            ids = np.concatenate([r[0] for r in batch])
            share = np.concatenate([r[1] / r[2] for r in batch]).astype(np.float32)
            starts = np.cumsum([0, *(len(r[0]) for r in batch[:-1])])
            mean = np.add.reduceat(emb[ids] * share[:, None], starts, axis=0)
            p = softmax(mean @ w + b)
            p[np.arange(len(batch)), [langs.index(r[3]) for r in batch]] -= 1
            g = p / len(batch)
            back = np.repeat(g @ w.T, [len(r[0]) for r in batch], axis=0) * share[:, None]
            w -= rate * mean.T @ g
            b -= rate * g.sum(axis=0)
            np.subtract.at(emb, ids, rate * len(batch) * back)
    seen = np.zeros(BUCKETS, bool)
    for r in fit:
        seen[r[0]] = True
    return (emb @ w) * seen[:, None], b  # what training never met says nothing


def _logits(rows: list[tuple], table: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return np.array([(table[i] * (n / total)[:, None]).sum(axis=0) + bias for i, n, total, _ in rows]).reshape(len(rows), len(bias))


def _temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The scale of logits with the least cross-entropy against targets of (n + 1) / (n + 2) for the right language."""
    n, k = z.shape
    if k < 2:
        return 1.0
    goal = np.full((n, k), 1 / (n + 2) / (k - 1))
    goal[np.arange(n), y] = (n + 1) / (n + 2)
    low, high = np.log(1e-4), np.log(1e4)
    loss = lambda t: -(goal * np.log(np.maximum(softmax(z / np.exp(t)), 1e-300))).sum()
    for _ in range(3):  # a finer grid around the best place
        grid = np.linspace(low, high, 61)
        at = int(np.argmin([loss(t) for t in grid]))
        low, high = grid[max(0, at - 1)], grid[min(60, at + 1)]
    return float(np.exp((low + high) / 2))


def _fitted(rows: list[tuple], seed: int) -> tuple[list[str], np.ndarray, np.ndarray, float, np.ndarray]:
    """Languages, table, bias, temperature, and the scores of held-out rows (every fifth) for their own language."""
    langs = sorted({r[3] for r in rows})
    fit = [r for i, r in enumerate(rows) if i % 5] or rows
    held = [r for i, r in enumerate(rows) if i % 5 == 0]
    table, bias = _descend(fit, langs, seed)
    z, y = _logits(held, table, bias), np.array([langs.index(r[3]) for r in held])
    temperature = _temperature(z, y)
    return langs, table, bias, temperature, softmax(z / temperature).max(axis=1)


def _foreign(rows: list[tuple], seed: int, docs: int = FOREIGN_DOCS) -> np.ndarray:
    """Scores of rows of each language under a model that was trained without it."""
    langs, out = sorted({r[3] for r in rows}), [np.zeros(0)]
    for out_of in langs if len(langs) > 2 else []:
        _, table, bias, temperature, _ = _fitted([r for r in rows if r[3] != out_of][:docs], seed)
        strange = [r for r in rows if r[3] == out_of][: docs // len(langs)]
        out.append(softmax(_logits(strange, table, bias) / temperature).max(axis=1))
    return np.concatenate(out)


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Fit on (text, label) in the given order; every fifth row serves for calibration only. With one or two languages
    there are no foreign rows; then only the share ``LOST`` of own rows is rejected."""
    rows = _rows(texts, labels)
    if not rows:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    langs, table, bias, temperature, own = _fitted(rows, seed)
    strange = _foreign(rows, seed)
    least = float(np.quantile(own, LOST, method="lower"))
    threshold = min(least, float(np.quantile(strange, FOREIGN))) if len(strange) else least
    return Model(langs, table.astype(np.float32), bias.astype(np.float64), temperature, threshold)


def fold(id_: Column) -> Column:
    """crc32 of the id as text, modulo 4 (a null id: 0)."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4, F.lit(0))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> Model:
    """Train on the whole texts of a sample of rows with a language: as many of each as ``docs`` allows, chosen and
    ordered by hash, up to the row that brings them to ``chars`` characters."""
    rows = labelled.filter(F.col(lang_col).isNotNull())
    per = {r[0]: r[1] for r in rows.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(docs).collect()}
    if not per:
        return train([], [])
    quota = max(1, docs // len(per))
    turn = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("sample"))
    share = F.create_map(*[x for k, n in per.items() for x in (F.lit(k), F.lit(min(1.0, 1.1 * quota / n)))])[F.col(lang_col)]
    chosen = rows.filter(F.pmod(turn, F.lit(1_000_003)) < share * 1_000_003)
    few = chosen.select(turn.alias("turn"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).orderBy("turn", "lang", "text").limit(docs)
    before = Window.orderBy("turn", "lang", "text").rowsBetween(Window.unboundedPreceding, -1)  # at most ``docs`` rows
    few = few.withColumn("before", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0))).filter(F.col("before") < chars)
    got = few.orderBy("turn", "lang", "text").select("text", "lang").collect()
    return train([r["text"] or "" for r in got], [r["lang"] for r in got])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) for each row.

    A null text or one without letters is ``und`` with score 0 and rejected; of equally likely languages the first by
    code point is taken; repeated rows and repeated or null ids give a row each; other columns are dropped; an empty
    table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats, whatever the data

    def run(batches):
        m = sent.value
        for b in batches:
            for part, texts in slices(b, b.column(1)):
                got = [m.predict(t) for t in texts]
                columns = [pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["id", "lang_pred", "score", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``predict`` does not reject, with all columns. Each row passes through Python once."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        m = sent.value
        for b in batches:
            for part, texts in slices(b, b.column(at)):
                yield part.filter(pa.array([not m.predict(t)[2] for t in texts], pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def digest(docs: DataFrame) -> DataFrame:
    model = fit(docs.filter(fold(F.col("doc_id")) != 2))
    return predict(docs, model).select(F.col("id").alias("doc_id"), (fold(F.col("id")) == 2).alias("held_out"), "lang_pred", "score", "rejected")
