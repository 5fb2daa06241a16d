"""New courses among scanned URLs: de-duplication, existence, scan slices and flush batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coerce as C
from . import sinks
from .latest import latest_by

DISPLAY = ("title", "description", "category_main_title", "category_sub_title")


def dedupe_first(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in an order; rank filtering happens before the shuffle, too."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_at", F.row_number().over(w)).filter("_at = 1").drop("_at")


def known_courses(dim: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """(course_id, locale) that exist: latest versions, those in ``ko`` only with Hangul in a display text; and, if
    given, the crawl state's courses."""
    last = latest_by(dim, ["course_id", "locale"], "fetched_at", list(DISPLAY))
    korean = C.any_of([F.coalesce(F.col(c).rlike("[가-힣]"), F.lit(False)) for c in DISPLAY])
    out = last.filter((F.col("locale") != "ko") | korean).select("course_id", "locale")
    return out if state is None else out.unionByName(state.select("course_id", "locale")).distinct()


def new_rows(candidates: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates whose key is not known, in one set-wise anti join."""
    return candidates.join(known.select(*keys), keys, "left_anti")


def scan_slice(urls: DataFrame, known: DataFrame, keys: list[str], start: tuple[int, int], max_scan: int, batch: int, position: tuple[str, str] = ("sitemap_index", "url_index"), unavailable_from: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(picked, checkpoint) of a resumable scan.

    From ``start`` on, at most ``max_scan`` URLs in order are looked at, and the scan ends with the ``batch``-th new
    key (the first URL of each). The checkpoint is the place after the last URL scanned, ``start`` if there is none;
    an unavailable sitemap ends the scan before itself. Windows run over the ``max_scan`` rows only.
    """
    i, j = position
    at = F.struct(i, j)
    rows = urls.filter(at >= F.struct(F.lit(start[0]).alias(i), F.lit(start[1]).alias(j)))
    if unavailable_from is not None:
        rows = rows.filter(F.col(i) < unavailable_from)
    scanned = rows.orderBy(i, j).limit(max_scan)
    marked = scanned.join(known.select(*keys).distinct().withColumn("_known", F.lit(True)), keys, "left")
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(i, j)) == 1
    marked = marked.withColumn("_new", (F.col("_known").isNull() & first).cast("int"))
    before = Window.orderBy(i, j).rowsBetween(Window.unboundedPreceding, -1)
    cut = marked.withColumn("_before", F.coalesce(F.sum("_new").over(before), F.lit(0))).filter(F.col("_before") < batch)
    picked = cut.filter("_new = 1").drop("_known", "_new", "_before")
    last = cut.agg(F.max(at).alias("p"))
    checkpoint = last.select(F.coalesce(F.col(f"p.{i}"), F.lit(start[0])).alias(i), F.coalesce(F.col(f"p.{j}") + 1, F.lit(start[1])).alias(j))
    return picked, checkpoint


def head_first(head: DataFrame, scan: DataFrame) -> DataFrame:
    """Candidates of the newest-first pass ahead of the scan's, as ``seq``."""
    return head.withColumn("seq", F.lit(0)).unionByName(scan.withColumn("seq", F.lit(1)), allowMissingColumns=True)


def flush_batches(rows: DataFrame, order: list[str], size: int, range_rows: int = 1_000_000) -> DataFrame:
    """The number of the flush that each scanned row falls in. The result is a table in the shared folder.

    Rows are sorted in ranges of about ``range_rows`` rows (as many ranges as the session shuffles to, at least) and
    written with their place in their range; ranges are then put one after the other by a prefix sum of their sizes, a
    row each. So no task takes all rows, and the number of ranges grows with them. Ties of ``order`` go by all columns.
    """
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // range_rows))
    by = [*order, *(c for c in rows.columns if c not in order)]
    lined = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
    folder = sinks.scratch(spark)
    lined.withColumns({"_range": F.shiftright("_place", 33), "_k": F.col("_place") % (1 << 33)}).drop("_place").write.parquet(folder)
    lined = spark.read.parquet(folder)
    sizes = lined.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    first = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return lined.join(first, "_range").withColumn("batch", F.floor((F.col("_first") + F.col("_k")) / size).cast("long")).drop("_range", "_k", "_first")
