"""Hard-negative mining over Hilbert-curve-ordered blocks with zone maps.

Rows are sorted along a Hilbert curve through the dimensions of the greatest variance and written as Parquet in blocks
of ``BLOCK_ROWS`` neighbours, a record each, whose columns ``low`` and ``high`` (the zone map) hold each dimension's
least and greatest value. By interval arithmetic an anchor's inner product with any row of a block lies between the
sums of the least and of the greatest products of its components with the zone's ends. So an anchor reads a block only
if that interval meets a window of scores that it still looks for.

First each tile of neighbouring anchors reads the blocks that it lies in, which bounds the k-th best score from below;
then it reads those other blocks that the bounds leave. This is done once for positives (one window without ends) and
once for negatives (one window for each positive). All results are exact. How many blocks the bounds rule out depends
on the data: clustered vectors leave few, directions spread evenly over many dimensions leave nearly all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import forget, materialise, shuffle_partitions

BLOCK_ROWS = 512
TILE_ANCHORS = 256
SHELF_VALUES = 1 << 20  # components of the blocks that a task holds at a time
CURVE_DIMS = 10
CURVE_BITS = 6
LARGEST = 1 << 55  # of a squared norm: a hundredfold inner product then fits a long
NONE = -(1 << 62)
FEW_SHELVES = 1000

PACKED = "ids array<long>, labels array<long>, cells array<long>"
WINDOWS = "array<struct<nth:int,low:long,high:long,best:long>>"
FOUND = "anchor long, nth int, id long, score long"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of ``cells`` (whole numbers under 2 ** bits); at most 63 bits in all."""
    x = cells.T.astype(np.int64)
    for shift in range(bits - 1, 0, -1):
        low = (1 << shift) - 1
        for i in range(len(x)):
            on = (x[i] >> shift & 1).astype(bool)
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for shift in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> shift & 1, (1 << shift) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for shift in range(bits - 1, -1, -1):
        for row in x:
            key = key << 1 | row >> shift & 1
    return key


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of each anchor with any vector of each zone, as whole numbers or, where doubles
    may round, as a wider interval."""
    up, down = np.maximum(anchors, 0).astype(np.float64), np.minimum(anchors, 0).astype(np.float64)
    a, b = low.astype(np.float64).T, high.astype(np.float64).T
    slack = np.floor(2.0**-40 * (up.sum(1) - down.sum(1)).max(initial=0.0) * np.abs(np.stack([a, b])).max(initial=0.0))
    return up @ a + down @ b - slack, up @ b + down @ a + slack


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole rows; by doubles where these are exact."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _rows(table: pa.Table | pa.RecordBatch) -> list[dict]:
    """Rows with their lists of numbers as arrays."""
    out: list[dict] = [{} for _ in range(table.num_rows)]
    for name, column in zip(table.schema.names, table.columns):
        plain = pa.types.is_list(column.type) and pa.types.is_integer(column.type.value_type)
        for row, x in zip(out, column):
            row[name] = x.values.to_numpy() if plain and x.is_valid else x.as_py()
    return out


def _unpack(row: dict, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return row["ids"], row["labels"], row["cells"].reshape(-1, dims)


def _wanted(tile: dict, dims: int, low: np.ndarray, high: np.ndarray, labels: list[np.ndarray], same: bool) -> np.ndarray:
    """Which of the zones some anchor of the tile must read."""
    ids, own, cells = _unpack(tile, dims)
    least, most = intervals(cells, low, high)
    holds = np.array([[(x == l).any() if same else (x != l).any() for x in labels] for l in own]).reshape(len(own), len(labels))
    out = np.zeros(len(labels), bool)
    for i, w in zip(tile["who"], tile["windows"]):
        out |= holds[i] & (most[i] >= max(w["low"], w["best"])) & (least[i] <= w["high"])
    return out


def _best(tile: dict, dims: int, blocks: list[dict], same: bool, k: int) -> dict[str, list]:
    """The k best rows of the blocks in each window of the tile's anchors."""
    ids, labels, cells = _unpack(tile, dims)
    out: dict[str, list] = {"anchor": [], "nth": [], "id": [], "score": []}
    kept: list[list[np.ndarray]] = [[] for _ in tile["who"]]
    for b in blocks:
        their, other, rows = _unpack(b, dims)
        score = products(cells, rows)
        fits = ((labels[:, None] == other) == same) & (ids[:, None] != their)
        for j, (i, w) in enumerate(zip(tile["who"], tile["windows"])):
            at = np.flatnonzero(fits[i] & (score[i] >= max(w["low"], w["best"])) & (score[i] <= w["high"]))
            if len(at):
                at = at[np.lexsort((their[at], -score[i, at]))[:k]]
                kept[j].append(np.stack([their[at], score[i, at]]))
    for (i, w), parts in zip(zip(tile["who"], tile["windows"]), kept):
        if parts:
            got = np.concatenate(parts, axis=1)
            got = got[:, np.lexsort((got[0], -got[1]))[:k]]
            out["anchor"] += [int(ids[i])] * got.shape[1]
            out["nth"] += [w["nth"]] * got.shape[1]
            out["id"] += got[0].tolist()
            out["score"] += got[1].tolist()
    return out


def _spread(rows: DataFrame) -> list:
    """(d, n, total, squares, low, high) of each dimension."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1).astype(np.float64)
                yield pa.RecordBatch.from_pydict({"d": np.arange(x.shape[1]), "n": np.full(x.shape[1], len(x)), "total": x.sum(0), "squares": (x * x).sum(0), "low": x.min(0), "high": x.max(0)})

    parts = rows.select("cells").mapInArrow(run, "d long, n long, total double, squares double, low double, high double")
    return parts.groupBy("d").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect()


class Blocks:
    """Rows in blocks along the curve, and their anchors in tiles; see ``mine`` for what the rows are."""

    def __init__(self, rows: DataFrame, dims: int, block_rows: int, tile_anchors: int):
        """``rows``: id, label, asks, cells (``dims`` whole numbers)."""
        self.dims, self.spark = dims, rows.sparkSession
        shelf_blocks = max(1, SHELF_VALUES // (block_rows * dims))
        spread = _spread(rows)
        by_variance = sorted(spread, key=lambda r: ((r["total"] / r["n"]) ** 2 - r["squares"] / r["n"], r["d"]))[:CURVE_DIMS]
        axes = [r["d"] for r in by_variance]
        low, width = np.array([r["low"] for r in by_variance]), np.array([max(r["high"] - r["low"], 1.0) for r in by_variance])

        def curve(batches):
            for b in batches:
                x = b.column("cells").flatten().to_numpy().reshape(b.num_rows, -1)[:, axes] if b.num_rows else np.zeros((0, len(axes)))
                at = np.minimum(((x - low) / width * (1 << CURVE_BITS)).astype(np.int64), (1 << CURVE_BITS) - 1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hilbert(at, CURVE_BITS))], [*b.schema.names, "key"])

        def number(batches):
            part, n, asked = TaskContext.get().partitionId(), 0, 0
            for b in batches:
                asks = b.column("asks").to_numpy(zero_copy_only=False)
                at = [np.full(b.num_rows, part), n + np.arange(b.num_rows), asked + np.cumsum(asks) - asks]
                n, asked = n + b.num_rows, asked + int(asks.sum())
                yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x.astype(np.int64)) for x in at)], [*b.schema.names, "part", "place", "turn"])

        plain = "id long, label long, asks boolean, cells array<long>"
        keyed = rows.select("id", "label", "asks", "cells").mapInArrow(curve, f"{plain}, key long")
        lined = keyed.repartitionByRange(shuffle_partitions(self.spark), "key", "id", "label").sortWithinPartitions("key", "id", "label")
        lined = materialise(lined.drop("key").mapInArrow(number, f"{plain}, part long, place long, turn long"))
        before, starts = (0, 0), []
        for r in lined.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("asked")).orderBy("part").collect():  # a row a partition
            starts.append((r["part"], *before))
            before = (before[0] + r["n"], before[1] + r["asked"])
        starts = self.spark.createDataFrame(starts, "part long, rows_before long, anchors_before long")
        placed = lined.join(starts, "part").select(
            "id", "label", "asks", "cells", F.expr(f"(rows_before + place) div {block_rows}").alias("block"), F.expr(f"(anchors_before + turn) div {tile_anchors}").alias("tile"))
        placed = placed.withColumn("shelf", F.expr(f"block div {shelf_blocks}"))

        def pack(table: pa.Table) -> pa.Table:
            x = table.column("cells").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
            return pa.table({
                "shelf": table.column("shelf").slice(0, 1), "block": table.column("block").slice(0, 1), "low": [x.min(0)], "high": [x.max(0)], "kinds": [np.unique(table.column("label").to_numpy())],
                "ids": [table.column("id").to_numpy()], "labels": [table.column("label").to_numpy()], "cells": [x.ravel()]})

        zone = "shelf long, block long, low array<long>, high array<long>, kinds array<long>"
        self.blocks = materialise(placed.repartition("shelf").groupBy("shelf", "block").applyInArrow(pack, f"{zone}, {PACKED}"), "shelf")
        first = Window.partitionBy("id").orderBy("label", "cells")
        asked = placed.filter("asks").withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
        self.anchors = materialise(asked.select("tile", "block", "id", "label", "cells"))
        forget(lined)

    def tiles(self, windows: DataFrame) -> DataFrame:
        """The tiles of those anchors that have ``windows`` (id, nth, low, high, best)."""
        one = windows.groupBy("id").agg(F.collect_list(F.struct("nth", "low", "high", "best")).alias("windows"))  # as many as positives are asked for

        def pack(table: pa.Table) -> pa.Table:
            who, flat = [], []
            for i, some in enumerate(table.column("windows").to_pylist()):
                who += [i] * len(some)
                flat += some
            cells = table.column("cells").combine_chunks().flatten().to_numpy()
            shape = pa.list_(pa.struct([("nth", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("best", pa.int64())]))
            return pa.table({
                "tile": table.column("tile").slice(0, 1), "own": [np.unique(table.column("block").to_numpy())], "who": pa.array([who], pa.list_(pa.int32())), "windows": pa.array([flat], shape),
                "ids": [table.column("id").to_numpy()], "labels": [table.column("label").to_numpy()], "cells": [cells]})

        packed = self.anchors.join(one, "id").groupBy("tile").applyInArrow(pack, f"tile long, own array<long>, who array<int>, windows {WINDOWS}, {PACKED}")
        return materialise(packed)

    def route(self, tiles: DataFrame, same: bool) -> DataFrame:
        """(tile, block): blocks that a tile's windows must read, other than those that it lies in.

        A shelf's zone maps are one row; each meets each tile, and no vectors are read."""
        dims = self.dims
        zones = self.blocks.groupBy("shelf").agg(F.collect_list(F.struct("block", "low", "high", "kinds")).alias("zones"))  # SHELF_VALUES bound them
        last = tiles.agg(F.max("tile")).first()[0]
        tile = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(-1 if last is None else last).cast("long"))) if last is not None else F.lit(None).cast("long")
        pairs = zones.select(tile.alias("tile"), "shelf", "zones").join(tiles, "tile")

        def run(batches):
            for b in batches:
                for row in _rows(b):
                    zones = row["zones"]
                    low, high = np.array([z["low"] for z in zones]), np.array([z["high"] for z in zones])
                    hit = _wanted(row, dims, low, high, [np.array(z["kinds"]) for z in zones], same)
                    own = set(row["own"].tolist())
                    got = [z["block"] for z, h in zip(zones, hit) if h and z["block"] not in own]
                    yield pa.RecordBatch.from_pydict({"tile": pa.array([row["tile"]] * len(got), pa.int64()), "block": pa.array(got, pa.int64())})

        return pairs.mapInArrow(run, "tile long, block long")

    def score(self, tiles: DataFrame, wanted: DataFrame, same: bool, k: int) -> DataFrame:
        """The k best rows in each window, of each shelf's wanted blocks."""
        dims = self.dims
        blocks = self.blocks
        shelves = wanted.join(blocks.select("block", "shelf"), "block").select("shelf").distinct().limit(FEW_SHELVES + 1).collect()
        if len(shelves) <= FEW_SHELVES:  # then other shelves' files are not even opened
            blocks = blocks.filter(F.col("shelf").isin([r["shelf"] for r in shelves]))
        asked = wanted.join(blocks.select("shelf", "block", "ids", "labels", "cells"), "block")
        mine = tiles.join(asked.select("tile", "shelf").distinct(), "tile").select("tile", "shelf", "ids", "labels", "cells", "who", "windows")
        theirs = asked.select("tile", "shelf", "ids", "labels", "cells", F.lit(None).cast("array<int>").alias("who"), F.lit(None).cast(WINDOWS).alias("windows"))

        def run(table: pa.Table) -> pa.Table:
            rows = _rows(table)
            tile = next(r for r in rows if r["windows"] is not None)
            got = _best(tile, dims, [r for r in rows if r is not tile], same, k)
            return pa.table({name: pa.array(got[name], kind) for name, kind in (("anchor", pa.int64()), ("nth", pa.int32()), ("id", pa.int64()), ("score", pa.int64()))})

        return mine.union(theirs).groupBy("tile", "shelf").applyInArrow(run, FOUND)

    def search(self, windows: DataFrame, same: bool, k: int, counted=None) -> DataFrame:
        """(anchor, nth, rank, id, score): the k best rows of the same label, or of others, in each window."""
        order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id")
        tiles = self.tiles(windows)
        near = materialise(self.score(tiles, tiles.select("tile", F.explode("own").alias("block")), same, k))
        kth = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k).select(F.col("anchor").alias("id"), "nth", F.col("score").alias("kth"))
        bounded = windows.join(kth, ["id", "nth"], "left").select("id", "nth", "low", "high", F.coalesce("kth", "best").alias("best"))
        forget(tiles)
        tiles = self.tiles(bounded)
        wanted = materialise(self.route(tiles, same))
        if counted is not None:
            counted.add(wanted.count())
        far = self.score(tiles, wanted, same, k)
        out = materialise(near.union(far).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))
        forget(tiles, wanted, near)
        return out


def usable(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & fine, F.lit(False))


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, block_rows: int = BLOCK_ROWS, tile_anchors: int = TILE_ANCHORS, counted=None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exactly.

    Components become floor(scale * x); scores are inner products of these. ``is_anchor`` and ``label`` (a whole number)
    are columns of ``vectors``. An anchor's positives are its best ``positives`` rows of the same label; for each, the
    best ``negatives`` rows of other labels with scores from ``low`` to ``high`` per cent of the positive's are returned,
    ties to the smaller id. Negative positive scores have an empty window, a score of 0 one of 0 only.

    Rows with a null id, label or vector, with an empty vector, or with null or non-finite components take no part, nor
    do rows with a squared norm of 2**55 or more, whose scores may not fit, or whose length is not the commonest (of
    equally common ones the longest). Rows with the anchor's own id are never its candidates; other repeated rows are
    candidates each; of a repeated anchor id the row with the least label, then vector, asks. An empty table gives no
    rows; other columns are ignored. ``counted`` is an accumulator for the (tile, block) pairs that bounds leave to be
    read beyond the tiles' own blocks. The result is a table in the shared folder.
    """
    spark = vectors.sparkSession
    cells = F.transform(F.col(f"`{vec_col}`"), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = vectors.filter(usable(F.col(f"`{vec_col}`")) & F.col(f"`{id_col}`").isNotNull() & label.isNotNull())
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"), cells.alias("cells"))
    rows = rows.filter(F.aggregate("cells", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) < float(LARGEST))
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    common = rows.groupBy(F.size("cells").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if common is None:
        return empty
    table = Blocks(rows.filter(F.size("cells") == common["dims"]), common["dims"], block_rows, tile_anchors)
    endless = table.anchors.select("id", F.lit(1).alias("nth"), F.lit(NONE).alias("low"), F.lit(-NONE).alias("high"), F.lit(NONE).alias("best"))
    found = table.search(endless, True, positives, counted)
    first = found.select(F.col("anchor"), F.col("rank").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ends = first.select(F.col("anchor").alias("id"), "nth", F.expr(f"-((-{low} * positive_score - pmod(-{low} * positive_score, 100L)) div 100)").alias("low"), F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100L)) div 100").alias("high"), F.lit(NONE).alias("best"))
    got = table.search(ends.filter("low <= high"), False, negatives, counted)
    out = got.join(first, ["anchor", "nth"]).select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    out = materialise(out)
    forget(found, got, table.blocks, table.anchors)
    return out


def digest(vectors: DataFrame) -> DataFrame:
    """The query's rows: every seventh label is moved on by one, every fiftieth row asks."""
    return mine(vectors, F.expr("vec_id % 50 = 0"), F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, e.vec_id AS other, a.label = e.label AS same, list_dot_product(a.v, e.v)::BIGINT AS score
  FROM e AS a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives AS p JOIN scores AS s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
