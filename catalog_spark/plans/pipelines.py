"""Whole jobs composed of the operators: first the frames of each job, then (``run_*``) the jobs that also write."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import links
from ..operators import backlog, capture, discovery, flatten, latest, outbox, sinks, state, translate
from ..sources import documents, search, sitemaps


def flattened(pages: DataFrame, queries: DataFrame, api: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """(bundle, errors) of captures."""
    captured, snapshots, errors = capture.capture(pages, queries, api)
    return flatten.bundle(captured, snapshots), errors


def _of(urls: DataFrame, *tables: DataFrame) -> list[DataFrame]:
    return [t.join(urls.select("url").distinct(), "url", "left_semi") for t in tables]


def collect_new(responses: DataFrame, search_pages: DataFrame, known: DataFrame, checkpoint: tuple[int, int], pages: DataFrame, queries: DataFrame, api: DataFrame, max_scan: int = 1500, batch: int = 100, page_size: int = 100):
    """(bundle, errors, checkpoint) of newly found courses: the newest first, then the scan of sitemaps.

    ``checkpoint`` is a frame with one row; it stays where it was if the newest fill the batch, and returns to (0, 0)
    at the end of the sitemaps. The first unavailable sitemap ends the scan. If the newest cannot be had, that is only
    a warning, and the scan goes on without them.
    """
    keys = ["course_id", "locale"]
    with_key = lambda df: df.withColumns({"course_id": links.course_id_from_url(F.col("url")), "locale": links.locale_from_url(F.col("url"))})
    newest, taken = recent_head(search_pages, known, min(batch, max_scan), page_size)
    told = sitemaps.resolve_sitemaps(responses)
    stop = told.filter(F.col("outcome").isin("unavailable", "error") & (F.col("sitemap_index") >= checkpoint[0])).agg(F.min("sitemap_index")).first()[0]
    end = told.filter(F.col("outcome") == "end").agg(F.min("sitemap_index")).first()[0]
    rows = with_key(sitemaps.sitemap_locs(told.filter("outcome = 'ok'").select("sitemap_index", "body")))
    already = known.select(*keys).unionByName(newest.select(*keys))
    if taken < batch:
        picked, position = discovery.scan_slice(rows, already, keys, checkpoint, max_scan - taken, batch - taken, unavailable_from=stop)
        if end is not None and stop is None and position.join(rows, (rows.sitemap_index > position.sitemap_index) | ((rows.sitemap_index == position.sitemap_index) & (rows.url_index >= position.url_index)), "left_semi").isEmpty():
            position = position.select(F.lit(0).alias("sitemap_index"), F.lit(0).alias("url_index"))
    else:
        picked, position = rows.limit(0), newest.sparkSession.createDataFrame([checkpoint], "sitemap_index int, url_index int")
    urls = _chosen(discovery.head_first(newest.select("url"), picked.select("url")))
    bundle, errors = flattened(*_of(urls, pages, queries, api))
    return bundle, errors, position


def _chosen(rows: DataFrame) -> DataFrame:
    """The same rows by value: a job's limit bounds them, and what it writes next must not change the choice."""
    return rows.sparkSession.createDataFrame(rows.collect(), rows.schema)


def recent_head(search_pages: DataFrame, known: DataFrame, most: int, page_size: int = 100) -> tuple[DataFrame, int]:
    """(page, pos, url, course_id, locale) of the newest courses that are not known, ``most`` at most, by value, and their
    number; after an error of the data or the cluster none, with a warning.

    The hits are kept while page sizes and rows are taken from them, so that each page is opened once.
    """
    keys = ["course_id", "locale"]
    shape = "page long, pos int, url string, course_id long, locale string"
    spark = known.sparkSession
    try:
        hits = search.search_hits(search_pages).select("page", "pos", "url")
        hits = hits.withColumns({"course_id": links.course_id_from_url(F.col("url")), "locale": links.locale_from_url(F.col("url"))}).persist()
        try:
            newest = discovery.new_rows(search.paged_union(hits, keys, page_size), known, keys).orderBy("page", "pos").limit(most).select(*(f.split()[0] for f in shape.split(", ")))
            rows = newest.collect()  # ``most`` at most
        finally:
            hits.unpersist()
        return spark.createDataFrame(rows, newest.schema), len(rows)
    except PySparkException as e:  # whatever is wrong with the head, the scan goes on
        warnings.warn(f"newest courses left out: {e}", stacklevel=2)
        return spark.createDataFrame([], shape), 0


def refresh_existing(snapshots: DataFrame, pages: DataFrame, queries: DataFrame, api: DataFrame, limit: int = 100):
    """(bundle, errors, picked) of the courses whose latest good snapshot is oldest; failures are rows, not errors."""
    picked = _chosen(latest.stalest(snapshots, ["course_id", "locale"], "fetched_at", limit, url="source_url", ok=F.col("status_code") == "OK"))
    bundle, errors = flattened(*_of(picked.select(F.col("source_url").alias("url")), pages, queries, api))
    return bundle, errors, picked


def collect_urls(texts: DataFrame, pages: DataFrame, queries: DataFrame, api: DataFrame) -> dict[str, DataFrame]:
    """The bundle of an explicit URL list with one timestamp for all; any URL without a course is fatal."""
    urls = documents.required_urls(texts)
    lost = urls.join(pages, "url", "left_anti").select("url").first()
    if lost is None:
        mine = _of(urls, pages, queries, api)
        now = F.lit(datetime.now(timezone.utc)).cast("timestamp")
        bundle, errors = flattened(mine[0].withColumn("fetched_at", now), *mine[1:])
        lost = errors.select("url").first()  # needs the pages' ids only
    if lost:
        raise ValueError(f"no course at {lost[0]}")
    return bundle


def translate_display(dim: DataFrame, units: DataFrame, course_done: DataFrame, unit_done: DataFrame, targets: list[str], fn, model: str = "model", batch: int = 12, most: int = 80):
    """(course rows, unit rows, failures): courses of all targets first, then units; only successes use the quota.

    The candidates of all targets come from one scan of each table and come to the driver (``batch`` rows a target at
    most). Each is sent to the translator once, as its answer comes to the driver, too. Targets are asked in rounds of
    as many as surely fit in what is left of the quota, so no more than the quota and the failures are asked, and a
    target's limit is the same as if they went one by one.
    """
    courses, lost, left = _in_rounds(
        backlog.backlog_of_targets(dim, course_done, targets, batch), list(backlog.COURSE_TEXTS), translate.course_translations, targets, fn, model, batch, most)
    lessons, lost_units, _ = _in_rounds(
        backlog.unit_backlog_of_targets(units, unit_done, targets, batch), ["section_title", "unit_title"], translate.unit_translations, targets, fn, model, batch, left)
    empty = [dim.sparkSession.createDataFrame([], schemas.schema(t)) for t in ("course_display_translation", "curriculum_display_translation")]
    failures = dim.sparkSession.createDataFrame([], "course_id long, target_language string")
    for frame in lost + lost_units:
        failures = failures.unionByName(frame.select(*failures.columns))
    return _together(courses, empty[0]), _together(lessons, empty[1]), failures


def _together(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty
    for frame in frames:
        out = out.unionByName(frame.select(*empty.columns))
    return out


def _in_rounds(candidates: DataFrame, fields: list[str], finish: Callable, targets: list[str], fn, model: str, batch: int, left: int) -> tuple[list[DataFrame], list[DataFrame], int]:
    """(frames of rows, frames of failures, what is left of the quota)."""
    rows, lost, todo = [], [], list(targets)
    found = candidates.collect() if left > 0 else []  # batch rows a target at most
    while todo and left > 0:
        many = max(1, left // batch)
        now, todo = todo[:many], todo[many:]
        some = [r for target in now for r in found if r["target"] == target and r["rn"] <= min(batch, left)]
        asked = candidates.sparkSession.createDataFrame(some, candidates.schema).drop("rn")
        answered = translate.apply_translator(translate.requests(asked, F.col("target"), fields, model), fn)
        answered = asked.sparkSession.createDataFrame(answered.collect(), answered.schema)  # batch rows a target at most
        good, bad = finish(answered, model)
        rows.append(good)
        lost.append(bad)
        left -= good.count()
    return rows, lost, left


def drain_outbox_job(spark, box: DataFrame, writers: dict, schemas: dict, limit: int = 50):
    """Run before an ingest; its errors do not stop it: (outbox, chunks written, error or None)."""
    try:
        marked, n = outbox.drain(spark, box, writers, schemas, limit)
        return marked, n, None
    except Exception as e:  # noqa: BLE001 - reported, as the job goes on
        return box, 0, str(e)


def remember(prior: DataFrame, bundle: dict[str, DataFrame]) -> DataFrame:
    return state.upsert(prior, state.seen_courses(bundle["course_snapshot_raw"], bundle["course_dim"]))


# Jobs that write: target tables below ``root``, the crawl state and checkpoints among them.

COLLECT, UPDATE = "collect_new", "update_existing"


def _write(spark: SparkSession, root: str, bundle: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write a bundle and what it says about the crawl state; the bundle as written."""
    written = sinks.write_bundle(bundle, root)
    state.append_state(spark, root, state.seen_courses(written["course_snapshot_raw"], written["course_dim"]))
    return written


def run_collect_new(spark: SparkSession, root: str, responses: DataFrame, search_pages: DataFrame, pages: DataFrame, queries: DataFrame, api: DataFrame, source: str = COLLECT, **limits):
    """``collect_new`` from the checkpoint and the known courses below ``root``; writes the bundle, the state and, if it
    moved, the checkpoint. Returns (bundle as written, errors, checkpoint)."""
    start = state.latest_checkpoint(state.read_checkpoints(spark, root), source)
    courses = state.read_state_table(spark, root).select("course_id", "locale")
    bundle, errors, point = collect_new(responses, search_pages, courses, start, pages, queries, api, **limits)
    end = tuple(point.first())
    written = _write(spark, root, bundle)
    if end != start or end == (0, 0):
        state.append_checkpoint(spark, root, source, *end)
    return written, errors, end


def run_refresh_existing(spark: SparkSession, root: str, pages: DataFrame, queries: DataFrame, api: DataFrame, limit: int = 100, source: str = UPDATE):
    """``refresh_existing`` of the courses below ``root``; progress is stored as (picked so far, picked now), failed
    picks included. Returns (bundle as written, errors, progress)."""
    done, _ = state.latest_checkpoint(state.read_checkpoints(spark, root), source)
    snapshots = documents.read_table(spark, f"{root}/course_snapshot_raw")
    bundle, errors, picked = refresh_existing(snapshots, pages, queries, api, limit)
    n = picked.count()
    written = _write(spark, root, bundle)
    state.append_checkpoint(spark, root, source, done + n, n)
    return written, errors, (done + n, n)


def run_collect_urls(spark: SparkSession, root: str, texts: DataFrame, pages: DataFrame, queries: DataFrame, api: DataFrame) -> dict[str, DataFrame]:
    return _write(spark, root, collect_urls(texts, pages, queries, api))


def run_translate_display(spark: SparkSession, root: str, targets: list[str], fn, **limits) -> tuple[int, int, DataFrame]:
    """``translate_display`` of the tables below ``root``: (course rows written, unit rows written, failures)."""
    tables = ("course_dim", "course_curriculum_unit", "course_display_translation", "curriculum_display_translation")
    frames = [sinks.read_or_empty(spark, root, t) for t in tables]
    courses, lessons, failures = translate_display(*frames, targets, fn, **limits)
    for rows, table in ((courses, tables[2]), (lessons, tables[3])):
        sinks.append_table(rows, root, table)
    return courses.count(), lessons.count(), failures
