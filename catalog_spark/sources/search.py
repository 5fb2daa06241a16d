"""Pages of search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coerce as C
from ..functions import links

# Where an item has its id, and its URL and slug.
ID_PATHS = ("$.id", "$.courseId", "$.course_id", "$.course.id", "$.course.courseId", "$.course.course_id")
TEXT_PATHS = {"raw": ("$.url", "$.course.url"), "slug": ("$.slug", "$.course.slug")}


def search_hits(pages: DataFrame, body: str = "body", host: str = links.HOST) -> DataFrame:
    """One row for each usable item of each page, other columns kept: pos, course_id and url.

    The id is the first positive one; an item without id or without URL and slug is dropped; wrong kinds are empty.
    """
    items = F.try_variant_get(F.try_parse_json(body), "$.data.items", "array<variant>")
    kept = [c for c in pages.columns if c != body]
    hits = pages.select(*kept, F.posexplode(items).alias("pos", "item"))
    item = F.col("item")
    ids = F.filter(F.transform(F.array(*[C.at(item, p) for p in ID_PATHS]), lambda v: C.as_int(v)), lambda n: n > 0)
    found = F.struct(F.coalesce(F.try_element_at(ids, F.lit(1)), F.lit(0)).alias("course_id"), *[C.first_non_empty(*[C.text_at(item, p) for p in ps]).alias(c) for c, ps in TEXT_PATHS.items()])
    # What an explode returns is computed once, though filter and URL both use the id.
    hits = hits.select(*kept, "pos", F.explode(F.array(found)).alias("hit")).filter("hit.course_id > 0").select(*kept, "pos", "hit.*")
    url = links.course_url(F.col("raw"), F.col("course_id"), F.col("slug"), host)
    return hits.select(*kept, "pos", "course_id", F.explode(F.array(url)).alias("url")).filter("url <> ''")


def pages_read(sizes: DataFrame, page_size: int, page: str = "page", rows: str = "n") -> DataFrame:
    """The pages that a reader would take: none after an empty page (itself left out) or a short one."""
    before = Window.orderBy(page).rowsBetween(Window.unboundedPreceding, -1)  # one row for each page
    stopped = F.coalesce(F.max((F.col(rows) < page_size).cast("int")).over(before), F.lit(0))
    return sizes.withColumn("_stopped", stopped).filter((F.col("_stopped") == 0) & (F.col(rows) > 0)).select(page)


def paged_union(hits: DataFrame, keys: list[str], page_size: int, page: str = "page", pos: Column | str = "pos") -> DataFrame:
    """Rows of the pages read, the first of each key in the order of pages."""
    sizes = hits.groupBy(page).agg(F.count("*").alias("n"))
    taken = hits.join(pages_read(sizes, page_size, page), page, "left_semi")
    first = Window.partitionBy(*keys).orderBy(page, pos)
    return taken.withColumn("_at", F.row_number().over(first)).filter("_at = 1").drop("_at")
