"""What still lacks a display translation, per target language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, times
from .latest import best_by, latest_by

COURSE_TEXTS = ("title", "description", "category_main_title", "category_sub_title", "level_code", "keywords")
LOCALES = ("ko", "en")


def source_rank(target: str, locale: Column) -> Column:
    first, second = ("en", "ko") if target == "en" else ("ko", "en")
    return F.when(locale == first, 0).when(locale == second, 1).otherwise(9)


def latest_activity(published: Column, updated: Column, fetched: Column) -> Column:
    """The greatest of the three; dates up to 1971-01-01 count as the epoch."""
    real = lambda t: F.when(t <= times.year_one(), times.epoch()).otherwise(t)
    return F.greatest(real(published), real(updated), fetched)


def existing(translations: DataFrame, target: str, keys: list[str]) -> DataFrame:
    return translations.filter((F.col("target_language") == target) & (F.col("generation_status") == "success")).select(*keys).distinct()


def missing(rows: DataFrame, native: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is neither native nor done, whatever their source text was at the time."""
    return rows.join(native.select(*keys), keys, "left_anti").join(done.select(*keys), keys, "left_anti")


def _wanted(rows: DataFrame, ids: list[int]) -> DataFrame:
    rows = rows.filter(F.col("locale").isin(*LOCALES))
    return rows.filter(F.col("course_id").isin(*ids)) if ids else rows


def translation_backlog(dim: DataFrame, translations: DataFrame, target: str, limit: int, ids: list[int] = ()) -> DataFrame:
    """Published courses without text in ``target``, each with its preferred source locale, most active first."""
    columns = ["status", *COURSE_TEXTS, "published_at", "last_updated_at"]
    last = latest_by(_wanted(dim, ids), ["course_id", "locale"], "fetched_at", columns)
    last = last.filter((F.col("status") == "PUBLISH") & (F.col("title") != ""))
    whole = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("title", "description", "category_main_title", "category_sub_title", "keywords")])
    native = last.filter(text.is_native(target, F.col("title"), whole))
    todo = missing(last, native, existing(translations, target, ["course_id"]), ["course_id"])
    activity = latest_activity(F.col("published_at"), F.col("last_updated_at"), F.col("max_fetched_at"))
    todo = todo.withColumn("activity", activity).withColumn("rank", source_rank(target, F.col("locale")))
    order = [F.col("rank"), -F.unix_millis("activity"), -F.unix_millis("max_fetched_at"), F.col("locale")]
    best = best_by(todo, ["course_id"], ["locale", *COURSE_TEXTS], order, [F.max("activity").alias("activity"), F.max("max_fetched_at").alias("fetched")])
    return best.orderBy(F.desc("activity"), F.desc("fetched"), F.desc("course_id")).limit(limit).select("course_id", "locale", *COURSE_TEXTS)


def _of_targets(last: DataFrame, keys: list[str], columns: list[str], title: Column, whole: Column, rank: list[Column], extra: list[Column], line: list[Column], translations: DataFrame, targets: list[str], limit: int) -> DataFrame:
    """(target, rn, keys, columns) of latest versions: what is missing in each target, best source first.

    The versions are read once. A target is a bit: what a key's texts are native in and what is translated are masks,
    joined by ``bit_or``, and what neither holds is asked for. As a source's rank depends only on whether the target is
    English, two best rows a key are enough. Ranks are cut in the tasks before the shuffle, too.
    """
    targets = list(dict.fromkeys(targets))  # a repeated target is one; there are fewer than 63
    bit, none = (lambda k: F.lit(1 << k).cast("long")), F.lit(0).cast("long")
    native, wanted = none, none
    for k, target in enumerate(targets):
        native = native.bitwiseOR(F.when(text.is_native(target, title, whole), bit(k)).otherwise(none))
        wanted = wanted.bitwiseOR(F.when(F.col("target_language") == target, bit(k)).otherwise(none))
    order = lambda target: F.struct(source_rank(target, F.col("locale")), *rank)
    row = F.struct(*columns)
    best = last.withColumn("_native", native).groupBy(*keys).agg(F.bit_or("_native").alias("_native"), *extra, F.min_by(row, order("en")).alias("_en"), F.min_by(row, order("")).alias("_other"))
    done = translations.filter((F.col("generation_status") == "success") & F.col("target_language").isin(*targets)).groupBy(*keys).agg(F.bit_or(wanted).alias("_done"))
    joined = best.join(done, keys, "left").withColumn("_has", F.col("_native").bitwiseOR(F.coalesce("_done", none)))
    every = F.array(*[F.struct(bit(k).alias("bit"), F.lit(t).alias("target")) for k, t in enumerate(targets)])
    todo = joined.withColumn("_t", F.explode(F.filter(every, lambda t: F.col("_has").bitwiseAND(t["bit"]) == 0)))
    todo = todo.withColumns({"target": F.col("_t.target"), "_best": F.when(F.col("_t.target") == "en", F.col("_en")).otherwise(F.col("_other"))})
    numbered = todo.withColumn("rn", F.row_number().over(Window.partitionBy("target").orderBy(*line)))
    return numbered.filter(F.col("rn") <= limit).select("target", "rn", *keys, "_best.*")


def backlog_of_targets(dim: DataFrame, translations: DataFrame, targets: list[str], limit: int, ids: list[int] = ()) -> DataFrame:
    """``translation_backlog`` of all targets in one scan of the dimension: (target, rn, course_id, locale, texts), the
    rows of each target numbered in its order, ``limit`` at most."""
    columns = ["status", *COURSE_TEXTS, "published_at", "last_updated_at"]
    last = latest_by(_wanted(dim, ids), ["course_id", "locale"], "fetched_at", columns)
    last = last.filter((F.col("status") == "PUBLISH") & (F.col("title") != ""))
    whole = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("title", "description", "category_main_title", "category_sub_title", "keywords")])
    last = last.withColumn("activity", latest_activity(F.col("published_at"), F.col("last_updated_at"), F.col("max_fetched_at")))
    rank = [-F.unix_millis("activity"), -F.unix_millis("max_fetched_at"), F.col("locale")]
    extra = [F.max("activity").alias("_activity"), F.max("max_fetched_at").alias("_fetched")]
    line = [F.desc("_activity"), F.desc("_fetched"), F.desc("course_id")]
    return _of_targets(last, ["course_id"], ["locale", *COURSE_TEXTS], F.col("title"), whole, rank, extra, line, translations, targets, limit)


def unit_backlog_of_targets(units: DataFrame, translations: DataFrame, targets: list[str], limit: int, ids: list[int] = ()) -> DataFrame:
    """The same for ``unit_translation_backlog``: (target, rn, course_id, section_id, unit_id, locale, titles)."""
    keys = ["course_id", "section_id", "unit_id"]
    last = latest_by(_wanted(units, ids), [*keys, "locale"], "fetched_at", ["section_title", "unit_title"]).filter("unit_title <> ''")
    whole = F.concat_ws(" ", F.coalesce("section_title", F.lit("")), "unit_title")
    rank, extra = [-F.unix_millis("max_fetched_at"), F.col("locale")], [F.max("max_fetched_at").alias("_fetched")]
    line = [F.desc("_fetched"), F.desc("course_id"), F.col("section_id"), F.col("unit_id")]
    return _of_targets(last, keys, ["locale", "section_title", "unit_title"], F.col("unit_title"), whole, rank, extra, line, translations, targets, limit)


def unit_translation_backlog(units: DataFrame, translations: DataFrame, target: str, limit: int, ids: list[int] = ()) -> DataFrame:
    """The same for curriculum units, latest fetched first."""
    keys = ["course_id", "section_id", "unit_id"]
    last = latest_by(_wanted(units, ids), [*keys, "locale"], "fetched_at", ["section_title", "unit_title"]).filter("unit_title <> ''")
    native = last.filter(text.is_native(target, F.col("unit_title"), F.concat_ws(" ", F.coalesce("section_title", F.lit("")), "unit_title")))
    todo = missing(last, native, existing(translations, target, keys), keys).withColumn("rank", source_rank(target, F.col("locale")))
    order = [F.col("rank"), -F.unix_millis("max_fetched_at"), F.col("locale")]
    best = best_by(todo, keys, ["locale", "section_title", "unit_title"], order, [F.max("max_fetched_at").alias("fetched")])
    return best.orderBy(F.desc("fetched"), F.desc("course_id"), "section_id", "unit_id").limit(limit).select("course_id", "locale", "section_id", "section_title", "unit_id", "unit_title")


def quota_plan(rows: DataFrame, target: str, order: list[str | Column], targets: list[str], batch: int, most: int, phase: str | None = None) -> DataFrame:
    """At most ``batch`` rows of each target (and phase), ``most`` in all, phases first, then targets in list order."""
    place = F.array_position(F.array(*map(F.lit, targets)), F.col(target))
    group = [phase, target] if phase else [target]
    own = Window.partitionBy(*group).orderBy(*order)
    kept = rows.filter(place > 0).withColumn("rn", F.row_number().over(own)).filter(F.col("rn") <= batch)
    lead = [F.col(phase)] if phase else []
    line = Window.orderBy(*lead, place, "rn")  # over batch x targets x phases rows
    return kept.withColumn("turn", F.row_number().over(line)).filter(F.col("turn") <= most)
