"""SimHash near-duplicates by tiled exact comparison.

Texts become 64-bit fingerprints. Distinct fingerprints are laid in tiles by the population counts of a few parts of
their bits; one changed bit changes one part's count by one, so two tiles whose counts differ by more than the radius
(summed over the parts) hold no link and are skipped. Other tile pairs are compared in full with numpy exclusive-or
and bit counts. Each task hands on a spanning forest of the links it found, never all pairs, and connected components
of these forests are those of all links.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import forget, map_arrow, materialise, slices

RADIUS = 3
SHINGLE = 3
SEED = 42
PARTS = 3
BASE_ROWS = 4096
NEAR_ROWS = 65_536
COMPARED = 1 << 21
SPACE = bytes([32, *range(9, 14)])
FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b in SPACE else b for b in range(256))


def shingles(text: str | None, size: int = SHINGLE) -> list[bytes]:
    """Space-joined runs of ``size`` words, A-Z lower-cased; the whole sequence if it is shorter; none if no word."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - size].tolist()]
    return [joined[a : b - 1] for a, b in zip(starts, ends[size - 1 :].tolist())]


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half the shingles' XXH64 values; 0 for a text without words."""
    found = shingles(text, size)
    total, digest, ones = len(found), xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, total, 8192):
        h = np.array([digest(s, SEED) for s in found[k : k + 8192]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, fp) for each row, ``fp`` being the fingerprint's bits as a signed long."""

    def run(batches):
        for b in batches:
            for part, texts in slices(b, b.column(1)):
                fps = np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps)], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, fp long")


def forest(base: np.ndarray, near: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect just what the links within ``base`` and between ``base`` and ``near`` connect."""
    nodes = np.concatenate([base, near])
    root = np.arange(len(nodes))
    step = max(1, COMPARED // max(1, len(nodes)))
    for k in range(0, len(base), step):
        i, j = np.nonzero(np.bitwise_count(base[k : k + step, None] ^ nodes[None, k:]) <= radius)
        i, j = i + k, j + k
        i, j = i[i != j], j[i != j]
        while len(i):
            a, b = root[i], root[j]
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := root[root], root):
                root = up
    low = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[low], nodes[root[low]]


def links(distinct: DataFrame, radius: int = RADIUS, parts: int = PARTS) -> DataFrame:
    """(a, b) edges between distinct fingerprints ``fp``, with the connectivity of all pairs within ``radius`` bits."""
    bits = [range(64 * p // parts, 64 * (p + 1) // parts) for p in range(parts)]
    masks = [sum(1 << i for i in r) for r in bits]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    counts = [F.bit_count(F.col("fp").bitwiseAND(F.lit(m))) for m in signed]
    tile = sum((c.cast("long") * 65 ** k for k, c in enumerate(counts)), F.lit(0).cast("long"))
    cells = materialise(distinct.select("fp", tile.alias("tile")))
    loads = materialise(cells.groupBy("tile").agg(F.count("*").alias("load")))
    # Tiles at a later place within the radius; each pair of tiles is met once.
    steps = [d for d in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    shift = sorted(x for x in (sum(v * 65**k for k, v in enumerate(d)) for d in steps) if x > 0)
    sized = loads.select(F.col("tile").alias("base"), F.ceil(F.col("load") / BASE_ROWS).cast("int").alias("blocks"))
    near = cells.select("fp", F.explode(F.array(*[F.col("tile") + F.lit(x).cast("long") for x in shift])).alias("base"))
    around = loads.select(F.explode(F.array(*[F.col("tile") + F.lit(x).cast("long") for x in shift])).alias("base"), "load").groupBy("base").agg(F.sum("load").alias("near"))
    # A tile's own rows are near rows of its later blocks, too, so that blocks of one tile are compared.
    sized = sized.join(around, "base", "left").join(loads.withColumnRenamed("tile", "base"), "base")
    crowd = F.coalesce(F.col("near"), F.lit(0)) + F.when(F.col("blocks") > 1, F.col("load")).otherwise(0)
    sized = materialise(sized.select("base", "blocks", F.greatest(F.lit(1), F.ceil(crowd / NEAR_ROWS)).cast("int").alias("slices")))
    own = cells.withColumnRenamed("tile", "base").join(sized, "base")
    first = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    base_rows = own.select("base", first.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices").cast("long") - 1)).alias("slice"), "fp", F.lit(True).alias("own"))
    near_rows = near.join(sized, "base").select("base", "fp", "blocks", "slices").union(own.filter("blocks > 1").select("base", "fp", "blocks", "slices"))
    second = F.pmod(F.xxhash64(F.col("fp"), F.lit(1)), F.col("slices"))
    near_rows = near_rows.select("base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"), second.alias("slice"), "fp", F.lit(False).alias("own"))
    keyed = base_rows.union(near_rows)

    def compare(table: pa.Table) -> pa.Table:
        own = table.column("own").to_numpy()
        fps = table.column("fp").to_numpy().view(np.uint64)
        a, b = forest(fps[own], fps[~own], radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    out = materialise(keyed.groupBy("base", "block", "slice").applyInArrow(compare, "a long, b long"))
    forget(cells, loads, sized)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(id, fp, component, root) for each row; ``component`` is the least id linked to it, itself included, and ``root``
    tells components apart where ids are repeated or null.

    A null or wordless text has fingerprint 0 and links like any other. Repeated rows give a row each and fall in
    one component; a null id is never a component's id unless all its ids are null; an empty table gives no rows. The
    result is a table in the shared folder.
    """
    marked = materialise(fingerprints(docs, id_col, text_col, size))
    classes = materialise(marked.groupBy("fp").agg(F.min("id").alias("least")))
    forest_ = links(classes.select("fp"), radius)
    linked = connected_components(forest_, "a", "b")
    rooted = materialise(classes.join(linked, classes.fp == linked.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(ids, "root").select("fp", "component", "root")
    out = materialise(marked.join(named, "fp").select("id", "fp", "component", "root"))
    forget(marked, classes, forest_, linked, rooted)
    return out


def digest(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
