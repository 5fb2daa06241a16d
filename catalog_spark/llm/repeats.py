"""Removal of long repeats, by column-wise construction over collections of fragments.

A byte goes if a ``WIDTH``-byte string that covers it also starts anywhere else. Copies of a text are settled as they
are, and from then on each different text counts once. Minimisers find where to look: in each ``WIDTH``-byte string
the least hash of its ``GRAM``-byte substrings is an anchor, so equal strings have equal anchors at equal places. An
anchor's fragment is all that such strings can reach around it. Fragments that occur twice are repeats as they are.
Other fragments of one anchor can share a string only if they agree on one of a few cores; those that do are compared
column by column:

the fragments of one anchor, cut into ``BLOCK``-byte symbols, form a collection of documents aligned at the anchor.
Each round inserts one symbol in front of every document's suffix, from the last column to the first: the order of all
suffixes (the collection's Burrows-Wheeler order of that column) follows from the last round's order by a stable sort
on the new symbols, and their common prefixes from range minima of the last round's. Symbol columns are written to a
file once and read in sequence; the order and prefixes of a column are written to a second file, from which the next
round reads them, so that a round holds two columns. The fragments themselves (736 bytes each, ``COLLECTION`` of them
or one anchor's, ``HOT`` at most) stay in memory, too. Symbols instead of bytes keep the rounds few, and no string is
missed: neighbours with one symbol more than ``WIDTH`` share all strings that start in their first one, and a string
that starts inside a symbol agrees on all but 16 of its bytes with the prefixes of the next column, so classes of
these are compared on the 16 bytes.

An anchor with more fragments than ``HOT`` (a passage that very many different texts share) is not one task's work:
its strings are counted by hash, level by level. Fragments that agree with no other one on what ``STEP`` neighbouring
strings have in common hold none of these; those that agree on all that these strings cover hold all of them; only for
the others, at the edges of what is shared, strings are counted one by one.
"""

from __future__ import annotations

import os
import tempfile
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import bucketed, forget, map_arrow, materialise, slices

WIDTH = 400
GRAM = 64
BLOCK = 16
CORES = 4
SLACK = WIDTH - GRAM
REACH = SLACK + WIDTH
LONGEST = 1 << 10  # bound of a span's length, which is REACH at most
COLLECTION = 4000
HOT = 4 * COLLECTION
STEP = 21
CHUNK = 1 << 17
BASE = 0x9E3779B97F4A7C15
IDS = ["anchor", "f1", "f2"]  # of a fragment


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, and powers of BASE and of its inverse modulo 2^64."""
    size = CHUNK + WIDTH + 1
    bytes_ = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    powers = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))]) for b in (BASE, pow(BASE, -1, 1 << 64))]
    return bytes_, *powers


def sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minima or maxima of all runs of ``width`` values, by block-wise running extremes from both sides."""
    f = np.minimum if least else np.maximum
    rows = -(-len(x) // width)
    y = np.full(rows * width, np.iinfo(np.uint64).max if least else 0, np.uint64)
    y[: len(x)] = x
    y = y.reshape(rows, width)
    ahead, back = f.accumulate(y, axis=1).ravel(), f.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(back[: len(x) - width + 1], ahead[width - 1 : len(x)])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, hashes and core hashes (0 for a core that reaches beyond the text) of all anchors; ties count all."""
    values, powers, inverse = tables()
    raw, n = np.frombuffer(data, np.uint8), len(data)
    places, hashes, cores = [], [], []
    step = SLACK // CORES
    for first in range(0, n - WIDTH + 1, CHUNK):
        last = min(first + CHUNK, n - WIDTH + 1)  # windows that start in [first, last)
        c = values[raw[first : last + WIDTH - 1]]
        q = np.concatenate([np.zeros(1, np.uint64), np.cumsum(c * powers[: len(c)])])
        h = (q[GRAM:] - q[:-GRAM]) * inverse[: len(c) - GRAM + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        least = sliding(h, SLACK + 1, True)
        pad = np.zeros(SLACK, np.uint64)
        p = np.flatnonzero(sliding(np.concatenate([pad, least, pad]), SLACK + 1, False) == h)
        places.append(p + first)
        hashes.append(h[p])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, CORES), np.int32)
    p, k = np.unique(np.concatenate(places), return_index=True)
    for i in range(CORES):
        size = WIDTH - step
        start = p - step * i
        ok = (start >= 0) & (start + size <= n)
        got = np.zeros(len(p), np.int32)
        got[ok] = [xxhash.xxh32_intdigest(data[s : s + size]) - (1 << 31) or 1 for s in start[ok].tolist()]
        cores.append(got)
    return p, np.concatenate(hashes)[k].view(np.int64), np.stack(cores, axis=1)


def fragment(data: bytes, place: int) -> tuple[int, bytes]:
    """How many bytes of the fragment are left of the anchor, and its bytes."""
    left = min(SLACK, place)
    return left, data[place - left : place + WIDTH]


def find_anchors(texts: DataFrame) -> DataFrame:
    """One row for each anchor of each text (key, text): its key, place, anchor, 128-bit hash of the fragment, cores."""

    def run(batches):
        for b in batches:
            for part, some in slices(b, b.column(1)):
                for key, text in zip(part.column(0).to_pylist(), some):
                    data = text.encode("utf-8", "surrogatepass")
                    p, h, c = anchors(data)
                    if not len(p):
                        continue
                    f = np.empty((len(p), 2), "<i8")
                    for i, at in enumerate(p.tolist()):
                        left, piece = fragment(data, at)
                        f[i] = np.frombuffer(xxhash.xxh3_128_digest(piece, left), "<i8")
                    columns = [pa.array([key] * len(p), pa.binary()), p, h, f[:, 0], f[:, 1], *(c[:, i] for i in range(CORES))]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "place", "anchor", "f1", "f2", *(f"c{i}" for i in range(CORES))])

    cores = ", ".join(f"c{i} int" for i in range(CORES))
    return map_arrow(texts.select("key", "text"), run, f"key binary, place long, anchor long, f1 long, f2 long, {cores}")


def arranged(label: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A stable order by label and words; a label and a hash are one key while 20 bits hold all labels."""
    if not len(label) or int(label.max()) < 1 << 20:
        return np.argsort((label << np.uint64(44)) | mix(words), kind="stable")
    return np.lexsort((words[:, 1], words[:, 0], label))


def together(order: np.ndarray, *exact: np.ndarray) -> np.ndarray:
    """Which rows equal another one: neighbours in ``order`` compared on all of ``exact``."""
    same = np.ones(max(len(order) - 1, 0), bool)
    for x in exact:
        y = x[order]
        same &= y[1:] == y[:-1]
    out = np.zeros(len(order), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def mix(words: np.ndarray) -> np.ndarray:
    """A 44-bit hash of two 64-bit words each."""
    h = (words[:, 0] ^ (words[:, 1] * np.uint64(BASE))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0x2545F4914F6CDD1D) >> np.uint64(20)


def edges(found: np.ndarray, at: int, order: np.ndarray, common: np.ndarray, dense: np.ndarray, parts: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
    """Mark strings that start in the block before column ``at``: they agree on WIDTH - BLOCK bytes from ``at`` on, so
    only rows in one class of such prefixes are looked at, and 16 bytes around these decide. ``dense`` rows have all
    these starts marked already; classes of none but them are skipped."""
    inner = WIDTH // BLOCK - 1
    label = np.cumsum(common[:-1] < inner)
    size, wanting = np.bincount(label), np.bincount(label, weights=~dense[order])
    use = (size[label] > 1) & (wanting[label] > 0)
    rows, label = order[use], label[use].astype(np.uint64)
    if not len(rows):
        return
    around = np.concatenate([parts[rows, max(at - BLOCK + 1, 0) : at], parts[rows, at + WIDTH - BLOCK : at + WIDTH]], axis=1)
    for back in range(min(BLOCK, at + 1)):
        start = at - back
        words = np.ascontiguousarray(around[:, around.shape[1] - BLOCK - back : around.shape[1] - back]).view("<u8")
        whole = (first[rows] <= start) & (start + WIDTH <= last[rows])
        hit = together(arranged(label, words), label, words[:, 0], words[:, 1], whole) & whole
        found[rows[hit], start] = True


def put_column(path: str, order: np.ndarray, common: np.ndarray) -> None:
    """A column of the transform: its suffixes in order, as rows, and the symbols that neighbours have in common."""
    with open(path, "wb") as f:
        f.write(order.astype("<u4").tobytes())
        f.write(common.astype("<i2").tobytes())


def take_column(path: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    with open(path, "rb") as f:
        return np.fromfile(f, "<u4", n).astype(np.int64), np.fromfile(f, "<i2", n + 1)


def shared_starts(parts: np.ndarray, first: np.ndarray, last: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For rows of ``parts`` (fragments laid out so that anchors stand in one column; valid from ``first`` to
    ``last``) whether the string that starts at each column also stands there in another row of the same ``group``."""
    n, most = len(parts), WIDTH // BLOCK + 1
    found = np.zeros((n, REACH - WIDTH + 1), bool)
    top = np.unique(group, return_inverse=True)[1].astype(np.uint64)
    rounds = [BLOCK * t for t in reversed(range(REACH // BLOCK))]
    with tempfile.TemporaryDirectory() as folder:  # a task's own scratch files
        column, transform = os.path.join(folder, "symbols"), os.path.join(folder, "transform")
        with open(column, "wb") as out:  # symbol columns in the order of the rounds
            for at in rounds:
                out.write(parts[:, at : at + BLOCK].tobytes())
        put_column(transform, np.argsort(top, kind="stable"), np.zeros(n + 1, np.int16))
        with open(column, "rb") as symbols:
            for at in rounds:
                words = np.frombuffer(symbols.read(n * BLOCK), "<u8").reshape(n, 2)
                order, common = take_column(transform, n)
                there = (first <= at) & (at + BLOCK <= last)
                new = arranged(top[order], words[order])  # places in the last order
                then, a, b = order[new], new[:-1], new[1:]
                u, v = then[:-1], then[1:]
                same = (a < b) & (words[u] == words[v]).all(axis=1) & there[u] & there[v] & (group[u] == group[v])
                prefix = np.zeros(n + 1, np.int16)
                k = np.flatnonzero(same)
                if len(k):
                    by = k[np.argsort(a[k], kind="stable")]
                    spans = np.empty(2 * len(by), np.int64)
                    spans[::2], spans[1::2] = a[by] + 1, b[by] + 1
                    prefix[by + 1] = np.minimum(1 + np.minimum.reduceat(common, spans)[::2], most)
                put_column(transform, then, prefix)
                full = np.flatnonzero(prefix == most)
                dense = np.zeros(n, bool)
                dense[then[full]] = dense[then[full - 1]] = True
                if at <= REACH - WIDTH:
                    found[dense, at : at + BLOCK + 1] = True
                if at + BLOCK <= REACH - WIDTH:
                    edges(found, at + BLOCK, order, common, dense, parts, first, last)
        edges(found, 0, *take_column(transform, n), np.zeros(n, bool), parts, first, last)
    return found


def runs(marks: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def compare(table: pa.Table) -> pa.Table:
    """Shared strings of one collection (anchor, f1, f2, left, part) as runs of starts, relative to the anchor."""
    data, left = table.column("part").to_pylist(), table.column("left").to_numpy()
    parts = np.zeros((len(data), REACH), np.uint8)
    first = SLACK - left
    for i, d in enumerate(data):
        parts[i, first[i] : first[i] + len(d)] = np.frombuffer(d, np.uint8)
    last = first + np.array([len(d) for d in data])
    found = shared_starts(parts, first, last, table.column("anchor").to_numpy())
    rows, start, end = [], [], []
    for i in np.flatnonzero(found.any(axis=1)).tolist():
        for a, b in runs(found[i]):
            rows.append(i)
            start.append(a - SLACK)
            end.append(b - 1 + WIDTH - SLACK)
    rows = pa.array(rows, pa.int64())
    return pa.table({c: table.column(c).take(rows) for c in ("anchor", "f1", "f2")} | {"from": pa.array(start, pa.int64()), "to": pa.array(end, pa.int64())})


def strings(parts: DataFrame, step: int, whole: bool = False) -> DataFrame:
    """(anchor, f1, f2, back, h1, h2): for each run of ``step`` strings in each fragment, those that start ``back`` to
    ``back + step - 1`` bytes before the anchor, the 128-bit hash of the bytes that they have in common, or (``whole``)
    of all that they cover. ``parts`` may have ``backs``: then only the strings of these runs of ``STEP`` are taken."""

    def run(batches):
        for b in batches:
            for first in range(0, b.num_rows, 64):
                few = b.slice(first, 64)
                rows, back, found = [], [], []
                wanted = few.column("backs").to_pylist() if "backs" in few.schema.names else [None] * few.num_rows
                for i, (left, part, runs_) in enumerate(zip(few.column("left").to_pylist(), few.column("part").to_pylist(), wanted)):
                    starts = range(0, left + 1, step) if runs_ is None else [x for k in runs_ for x in range(k, min(k + STEP, left + 1), step)]
                    for k in starts:
                        # Where the text starts, a run has fewer strings; what it has in common is the same in all runs.
                        far = min(k + step - 1, left)
                        start, end = (left - far, left - k + WIDTH) if whole else (left - k, left - k - step + 1 + WIDTH)
                        if end <= len(part):
                            rows.append(i)
                            back.append(k)
                            found.append(xxhash.xxh3_128_digest(part[start:end], far - k if whole else 0))
                h = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                ids = [few.column(c).take(pa.array(rows, pa.int64())) for c in IDS]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(back, pa.int64()), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], [*IDS, "back", "h1", "h2"])

    return map_arrow(parts, run, "anchor long, f1 long, f2 long, back long, h1 long, h2 long")


def met_twice(parts: DataFrame, step: int, whole: bool = False) -> DataFrame:
    """(anchor, f1, f2, backs, first): the runs of each fragment whose hash another fragment of its anchor has, too, and
    those of them for which this fragment stands for all that have the hash. Counts are combined before the shuffle, and
    the join's large side is dealt out by Spark where one hash is in very many rows."""
    what = ["anchor", "back", "h1", "h2"]
    every = materialise(strings(parts, step, whole))
    often = materialise(every.groupBy(*what).agg(F.count("*").alias("n"), F.min("f1").alias("least")).filter("n > 1").drop("n"))
    runs_ = [F.array_sort(F.collect_list("back")).alias("backs"), F.collect_list(F.when(F.col("f1") == F.col("least"), F.col("back"))).alias("first")]  # at most SLACK + 1
    out = materialise(every.join(often, what).groupBy(*IDS).agg(*runs_))
    forget(every, often)
    return out


def shared_hot(parts: DataFrame) -> DataFrame:
    """What ``compare`` finds, for anchors with too many different fragments for one task. Strings are counted over the
    runs that are still open and over one fragment of each set that shares a run whole: an open fragment may share a
    string with such a set."""
    near = met_twice(parts, STEP).drop("first")
    sure = met_twice(parts.join(near, IDS), STEP, whole=True)
    none = F.array().cast("array<long>")
    settled = near.join(sure.withColumnRenamed("backs", "sure"), IDS, "left").withColumns({c: F.coalesce(c, none) for c in ("sure", "first")})
    asked = settled.select(*IDS, F.concat(F.array_except("backs", "sure"), "first").alias("backs")).filter(F.size("backs") > 0)
    hits = met_twice(parts.join(asked, IDS), 1)
    out = materialise(_spans(hits, 1).union(_spans(sure, STEP)))
    forget(near, sure, hits)
    return out


def _spans(hits: DataFrame, step: int) -> DataFrame:
    """(anchor, f1, f2, from, to): what the runs ``backs`` of ``step`` strings cover, neighbours taken together."""
    begins = F.filter("backs", lambda x: ~F.array_contains("backs", x + step))  # the farthest from the anchor
    ends = F.filter("backs", lambda x: ~F.array_contains("backs", x - step))
    spans = hits.select(*IDS, begins.alias("a"), ends.alias("b")).select(*IDS, F.explode(F.arrays_zip("a", "b")).alias("r"))
    far = F.least(F.col("r.a") + step - 1, F.lit(SLACK))  # a text's start cuts the rest
    return spans.select(*IDS, (-far).cast("long").alias("from"), (F.lit(WIDTH) - F.col("r.b")).cast("long").alias("to"))


def repeated_spans(unique: DataFrame) -> DataFrame:
    """(key, spans): for each text of ``unique`` (key, text) with repeats in other places, [start, end) byte spans that
    together cover them. Each key has one text."""
    every = materialise(find_anchors(unique))
    often = materialise(every.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"))
    met = materialise(every.join(often, "anchor"))
    forget(every, often)
    kinds = met.groupBy(*IDS).agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("at"), *[F.first(f"c{i}").alias(f"c{i}") for i in range(CORES)])
    kinds = materialise(kinds)
    cores = kinds.select(*IDS, F.posexplode(F.array(*[f"c{i}" for i in range(CORES)])).alias("i", "core")).filter("core <> 0")
    common = materialise(cores.groupBy("anchor", "i", "core").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", "i", "core"))
    hopeful = cores.join(common, ["anchor", "i", "core"], "left_semi").select(*IDS).distinct()
    wanted = materialise(kinds.join(hopeful, IDS, "left_semi").select(*IDS, "at.key", "at.place"))
    by_text = wanted.groupBy("key").agg(F.collect_list(F.struct(*IDS, "place")).alias("wanted"))  # at most a text's anchors

    def cut(batches):
        for b in batches:
            for part, some in slices(b, b.column(0)):
                for text, rows in zip(some, part.column(1).to_pylist()):
                    data = text.encode("utf-8", "surrogatepass")
                    left, piece = zip(*(fragment(data, r["place"]) for r in rows))
                    columns = [pa.array([r[c] for r in rows], pa.int64()) for c in IDS]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(left, pa.int64()), pa.array(piece, pa.binary())], [*IDS, "left", "part"])

    parts = map_arrow(unique.join(by_text, "key").select("text", "wanted"), cut, "anchor long, f1 long, f2 long, left long, part binary")
    hot = materialise(wanted.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("anchor"))
    told = kinds.filter("n > 1").select(*IDS, F.lit(-SLACK).cast("long").alias("from"), F.lit(WIDTH).cast("long").alias("to"))
    whole = None
    if not hot.isEmpty():
        whole = materialise(parts)
        parts = whole.join(hot, "anchor", "left_anti")
    collections = max(1, -(-wanted.count() // COLLECTION))
    collection = F.pmod(F.xxhash64("anchor"), F.lit(collections)).alias("collection")
    shared = materialise(parts.withColumn("collection", collection).groupBy("collection").applyInArrow(compare, "anchor long, f1 long, f2 long, from long, to long"))
    told = told.union(shared)
    counted = None
    if whole is not None:
        few = materialise(whole.join(hot, "anchor", "left_semi"))
        counted = shared_hot(few)
        told = told.union(counted)
        forget(few)
    told = materialise(told.groupBy(*IDS).agg(F.collect_list(F.struct("from", "to")).alias("told")))  # a row for each fragment
    # A span is one long (its start, then its length), since distinct structs are told apart two by two.
    start = lambda s: F.greatest(F.col("place") + s["from"], F.lit(0))
    packed = lambda s: start(s) * LONGEST + F.col("place") + s["to"] - start(s)
    covered = met.select("key", "place", *IDS).join(told, IDS).select("key", F.transform("told", packed).alias("spans"))
    spans = F.array_distinct(F.flatten(F.collect_list("spans")))
    shaped = lambda x: F.struct(F.shiftright(x, 10).alias("start"), (F.shiftright(x, 10) + x % LONGEST).alias("end"))
    out = materialise(covered.groupBy("key").agg(spans.alias("spans")).select("key", F.transform("spans", shaped).alias("spans")))
    forget(met, kinds, common, wanted, hot, shared, told, *(t for t in (whole, counted) if t is not None))
    return out


SHAPE = "array<struct<start:long,end:long>>"
ARROW_SHAPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def cleaned(docs: DataFrame, *columns: Column | str, text_col: str = "text") -> DataFrame:
    """``columns`` of (key, n_bytes, removed, kept) for each different text, as a table in the shared folder; the key
    is ``text_key``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # Copies are put together before the shuffle; whole texts are shuffled this once.
    unique = docs.select(text_key(text).alias("key"), text.alias("text")).groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("n"))
    unique = bucketed(unique, "key")
    spans = repeated_spans(unique)
    rows = unique.join(spans, "key", "left").select("key", "text", "n", "spans")

    def run(batches):
        for b in batches:
            for part, some in slices(b, b.column(1)):
                sizes, removed, kept = [], [], []
                for text, n, found in zip(some, part.column(2).to_pylist(), part.column(3).to_pylist()):
                    data = text.encode("utf-8", "surrogatepass")
                    found = [{"start": 0, "end": len(data)}] if n > 1 and len(data) >= WIDTH else found
                    merged: list[list[int]] = []
                    for s in sorted((x["start"], min(x["end"], len(data))) for x in found or []):
                        if merged and s[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s[1])
                        else:
                            merged.append(list(s))
                    cuts = [0, *(x for s in merged for x in s), len(data)]
                    sizes.append(len(data))
                    removed.append([{"start": s, "end": e} for s, e in merged])
                    kept.append(b"".join(data[x:y] for x, y in zip(cuts[::2], cuts[1::2])))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, ARROW_SHAPE), pa.array(kept, pa.binary())], ["key", "n_bytes", "removed", "kept"])

    out = materialise(map_arrow(rows, run, f"key binary, n_bytes long, removed {SHAPE}, kept binary").select(*columns))
    forget(unique, spans)
    return out


def text_key(text: Column) -> Column:
    """128 bits that nobody can make two texts agree in."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def _for_rows(docs: DataFrame, done: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), text_key(text).alias("key")).join(done, "key").drop("key")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, removed, kept) for each row: maximal removed spans and the remaining bytes.

    A null text counts as empty; texts under ``WIDTH`` bytes keep all. Repeated rows are occurrences of each other and
    give a row each. Matches never cross rows. Null or repeated ids stay; other columns are dropped; an empty table
    gives no rows.
    """
    return _for_rows(docs, cleaned(docs, "*", text_col=text_col), id_col, text_col)


def digest(docs: DataFrame) -> DataFrame:
    """The removed spans' sums and the kept bytes' digest for each document."""
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    done = cleaned(docs, "key", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return _for_rows(docs, done, "doc_id", "text").withColumnRenamed("id", "doc_id")
