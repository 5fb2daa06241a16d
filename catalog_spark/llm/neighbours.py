"""Approximate nearest neighbours by largest inner product: stable projections, a kd-tree and a chi-square stop.

An added component sqrt(M^2 - |x|^2), M being the largest norm, turns the largest inner product into the smallest
Euclidean distance. Gaussian (2-stable) projections to ``PROJECTED`` dimensions keep distances in this sense: the
squared projected distance over the squared distance is chi-square distributed. A query takes rows in the order of
projected distance and verifies them on the original vectors until a row as near as its k-th best so far would have
been met already with probability ``CERTAINTY``.

The projected space is cut into kd-tree cells of about ``CELL_ROWS`` rows (cuts from a bounded sample), ``MOST_CELLS``
at most, and cells with more rows into shards, so that no task holds an unbounded group. A query first searches its own
cell, which bounds its k-th distance, and then only those cells that the stopping test does not rule out. The workers
get the cells' boxes for that, 520 bytes each and so 9 MB at most.

More projected dimensions verify fewer rows for the same recall: with 8 and a certainty of 0.98 the stopping test leaves
0.81 of 51,000 and 0.91 of 2,000 vectors of 64 dimensions to be verified, with 32 and 0.95 it leaves 0.32 and 0.55.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import forget, materialise

PROJECTED = 32
CERTAINTY = 0.95
CELL_ROWS = 4096
MOST_CELLS = 16_384
SLICE_QUERIES = 4096
SAMPLE_ROWS = 20_000
LEAF = 512
SEED = 11


def chi_square(x: float, dims: int) -> float:
    """Distribution function, by the series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, h = dims / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-15:
        k += 1
        term *= h / k
        total += term
    return min(1.0, total * math.exp(a * math.log(h) - h - math.lgamma(a)))


def chi_square_at(p: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, dims) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < p else (low, mid)
    return high


def projection(dims: int, projected: int = PROJECTED, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dims, projected))


def cuts(points: np.ndarray, leaves: int) -> list[tuple]:
    """A kd-tree over a sample as (dimension, value, left, right) nodes; a leaf is (-1, cell, 0, 0)."""
    nodes: list[tuple] = []
    cells = 0

    def grow(rows: np.ndarray, share: int) -> int:
        nonlocal cells
        at = len(nodes)
        nodes.append(())
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(points.shape[1])
        if share <= 1 or len(rows) < 2 or not spread.max() > 0:
            nodes[at] = (-1, cells, 0, 0)
            cells += 1
            return at
        d = int(spread.argmax())
        value = float(np.median(rows[:, d]))
        side = rows[:, d] < value
        if not side.any() or side.all():
            value = float(rows[:, d].mean())
            side = rows[:, d] < value
        nodes[at] = (d, value, grow(rows[side], share // 2), grow(rows[~side], share - share // 2))
        return at

    grow(points, leaves)
    return nodes


def placed(nodes: list[tuple], points: np.ndarray) -> np.ndarray:
    """The cell of each point."""
    out, todo = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
    while todo:
        at, rows = todo.pop()
        d, value, left, right = nodes[at]
        if d < 0:
            out[rows] = value
        else:
            side = points[rows, d] < value
            todo += [(left, rows[side]), (right, rows[~side])]
    return out


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        d = int(np.ptp(points[rows], axis=0).argmax())
        half = len(rows) // 2
        order = rows[np.argpartition(points[rows, d], half)]
        todo += [order[:half], order[half:]]
    return out


def search_shard(vectors, ids, projected, top: float, queries, query_ids, query_projected, reach, k: int, stop: float):
    """For each query the best k of one shard that it verifies, as (query, id, score) arrays, and how many rows all
    queries verified.

    Leaves of the shard's kd-tree come in the order of projected distance; of a leaf, the rows whose own projected
    distance passes the test are verified together. ``top`` is M^2; ``reach`` is each query's bound on the squared k-th
    distance known before. Fast matrix products lead the search; the scores handed on are summed alike for every row,
    so that equal vectors tie exactly.
    """
    groups = leaves(projected)
    low = np.array([projected[g].min(axis=0) for g in groups])
    high = np.array([projected[g].max(axis=0) for g in groups])
    order = np.concatenate(groups)
    vectors, ids, projected = np.ascontiguousarray(vectors[order]), ids[order], np.ascontiguousarray(projected[order])
    ends = np.cumsum([len(g) for g in groups]).tolist()
    starts = [0, *ends[:-1]]
    found_q, found_i, found_s, verified = [], [], [], 0
    for q in range(len(queries)):
        y, here, me = query_projected[q], queries[q], query_ids[q]
        own, bound = float(here @ here), float(reach[q])
        gap = np.maximum(np.maximum(low - y, y - high), 0)
        far = (gap * gap).sum(axis=1)
        met, best = [], np.zeros(0)
        for g in np.argsort(far, kind="stable").tolist():
            if far[g] > stop * bound:  # the test holds for all that is left
                break
            rows = np.arange(starts[g], ends[g])
            if bound < np.inf:
                step = projected[rows] - y
                rows = rows[(step * step).sum(axis=1) <= stop * bound]
            if not len(rows):
                continue
            verified += len(rows)
            rough = vectors[rows] @ here
            rough[ids[rows] == me] = -np.inf
            met.append((rows, rough))
            best = np.concatenate([best, rough])
            if len(best) > k:
                best = np.partition(best, len(best) - k)[len(best) - k :]
            if len(best) == k:
                bound = min(bound, max(0.0, top + own - 2 * float(best.min())) * (1 + 1e-9) + 1e-12)
        if not met:
            continue
        least = max(best.min() - 1e-9 * (1 + abs(best.min())), -1e300) if len(best) else -1e300
        rows = np.concatenate([r[rough >= least] for r, rough in met])
        score = (vectors[rows] * here).sum(axis=1)
        keep = np.lexsort((ids[rows], -score))[:k]
        found_q.append(np.full(len(keep), me))
        found_i.append(ids[rows][keep])
        found_s.append(score[keep])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_q]), np.concatenate([none, *found_i]), np.concatenate([np.zeros(0), *found_s]), verified


def _matrix(column) -> np.ndarray:
    """Rows of a list column without nulls as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(vec: Column) -> Column:
    """No null, not empty or zero, all components finite."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, certainty: float = CERTAINTY, cell_rows: int = CELL_ROWS, verified=None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, ties to the smaller id.

    ``is_query`` marks query rows by the columns of ``vectors``. Null ids, vectors that are null, zero or hold null or
    non-finite components, and vectors whose length is not the commonest (of equally common ones the longest) take no
    part. Repeated rows are candidates each, but a query id is searched once, with the least of its vectors. With too few candidates all are
    returned; an empty table gives no rows. ``verified`` is an accumulator for the number of rows that queries verify.
    The result is a table in the shared folder.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col(vec_col)) & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    common = rows.groupBy(F.size("vec").alias("dims")).agg(F.count("*").alias("n"), F.max(norm).alias("top")).orderBy(F.desc("n"), F.desc("dims")).first()
    if common is None:
        return empty
    dims, n, top = common["dims"], common["n"], common["top"]
    rows = rows.filter(F.size("vec") == dims)
    a = projection(dims + 1)
    stop = chi_square_at(certainty, PROJECTED)

    def project(batches):
        for b in batches:
            x = _matrix(b.column("vec"))
            lift = np.sqrt(np.maximum(0.0, top - (x * x).sum(axis=1)))
            y, q = x @ a[:-1] + lift[:, None] * a[-1], x @ a[:-1]
            both = [pa.array(list(m), pa.list_(pa.float64())) for m in (y, q)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vec"), b.column("asks"), *both], ["id", "vec", "asks", "y", "yq"])

    projected = materialise(rows.mapInArrow(project, "id long, vec array<double>, asks boolean, y array<double>, yq array<double>"))
    sample = projected.select("y", F.xxhash64("id").alias("turn")).filter(F.pmod("turn", F.lit(1_000_003)) <= 1_000_003 * min(1.0, 1.2 * SAMPLE_ROWS / n)).orderBy("turn").limit(SAMPLE_ROWS)
    nodes = cuts(np.array([r["y"] for r in sample.collect()] or [[0.0] * PROJECTED]), max(1, min(MOST_CELLS, math.ceil(n / cell_rows))))

    def place(batches):
        for b in batches:
            cells = [pa.array(placed(nodes, _matrix(b.column(c)))) for c in ("y", "yq")]
            yield pa.RecordBatch.from_arrays([*b.columns, *cells], [*b.schema.names, "cell", "home"])

    rows = materialise(projected.mapInArrow(place, "id long, vec array<double>, asks boolean, y array<double>, yq array<double>, cell long, home long"))
    forget(projected)
    ends = rows.select("cell", F.posexplode("y").alias("j", "x")).groupBy("cell", "j").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    boxes = ends.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("j", "low", "high"))).alias("box"))  # PROJECTED of them
    cells = materialise(rows.groupBy("cell").agg(F.count("*").alias("n")).join(boxes, "cell").withColumn("shards", F.ceil(F.col("n") / cell_rows).cast("long")))
    least = Window.partitionBy("id").orderBy("vec")
    asking = rows.filter("asks").withColumn("at", F.row_number().over(least)).filter("at = 1").select("id", "vec", "yq", "home")

    made: list[DataFrame] = []

    def searched(queries: DataFrame) -> DataFrame:
        """(query_id, id, score) for queries (id, vec, y, reach, cell): each goes to all shards of its cell."""
        shards = cells.select("cell", "shards")
        slices = queries.groupBy("cell").agg(F.ceil(F.count("*") / SLICE_QUERIES).cast("long").alias("slices"))
        sized = materialise(shards.join(slices, "cell"))
        made.append(sized)
        part = lambda c, salt: F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.col(c))
        span = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        base = rows.select("id", "vec", "y", F.lit(0.0).alias("reach"), "cell").join(sized, "cell")
        base = base.withColumn("shard", part("shards", 0)).select("cell", "shard", span("slices").alias("slice"), "id", "vec", "y", "reach", F.lit(False).alias("asks"))
        near = queries.select("id", "vec", "y", "reach", "cell").join(sized, "cell").withColumn("slice", part("slices", 1))
        near = near.select("cell", span("shards").alias("shard"), "slice", "id", "vec", "y", "reach", F.lit(True).alias("asks"))

        def run(table: pa.Table) -> pa.Table:
            asks = table.column("asks").to_numpy()
            v, y, i, r = _matrix(table.column("vec")), _matrix(table.column("y")), table.column("id").to_numpy(), table.column("reach").to_numpy()
            if asks.all() or not asks.any():
                return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
            q, found, score, seen = search_shard(v[~asks], i[~asks], y[~asks], top, v[asks], i[asks], y[asks], r[asks], k, stop)
            if verified is not None:
                verified.add(seen)
            return pa.table({"query_id": q, "id": found, "score": score})

        keyed = base.select("cell", "shard", "slice", "id", "vec", "y", "reach", "asks").union(near)
        return keyed.groupBy("cell", "shard", "slice").applyInArrow(run, "query_id long, id long, score double")

    endless = F.lit(float("inf"))
    first = materialise(searched(asking.select("id", "vec", F.col("yq").alias("y"), endless.alias("reach"), F.col("home").alias("cell"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    kth = first.withColumn("at", F.row_number().over(order)).filter(F.col("at") == k).select(F.col("query_id").alias("id"), "score")
    bounded = asking.join(kth, "id", "left")
    own = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    reach = F.when(F.col("score").isNotNull(), F.greatest(F.lit(0.0), F.lit(top) + own - 2 * F.col("score")) * (1 + 1e-9) + 1e-12).otherwise(endless)
    bounded = materialise(bounded.select("id", "vec", F.col("yq").alias("y"), reach.alias("reach"), "home"))
    boxes = cells.orderBy("cell").collect()  # MOST_CELLS rows at most
    number = np.array([c["cell"] for c in boxes])
    low, high = (np.array([[side[end] for side in c["box"]] for c in boxes]) for end in ("low", "high"))
    sent = spark.sparkContext.broadcast((number, low, high))

    def route(batches):
        number, low, high = sent.value
        for b in batches:
            y, reach, home = _matrix(b.column("y")), b.column("reach").to_numpy(), b.column("home").to_numpy()
            to = []
            for p, r, h in zip(y, reach, home):
                gap = np.maximum(np.maximum(low - p, p - high), 0)
                to.append(number[((gap * gap).sum(axis=1) <= stop * r) & (number != h)])
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vec"), b.column("y"), b.column("reach"), pa.array(to, pa.list_(pa.int64()))], ["id", "vec", "y", "reach", "cells"])

    routed = bounded.mapInArrow(route, "id long, vec array<double>, y array<double>, reach double, cells array<long>")
    routed = materialise(routed.select("id", "vec", "y", "reach", F.explode("cells").alias("cell")))
    all_found = first.union(searched(routed)).withColumn("rank", F.row_number().over(order))
    out = materialise(all_found.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"))
    forget(rows, cells, first, bounded, routed, *made)
    return out
