"""Captured documents to the tables of a bundle. Input: one row for each capture with fetched_at, course_id, locale
and the JSON texts online, meta, curriculum, discounts and contents (null where missing)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import coerce as C
from ..functions import hashing as H
from ..functions import times


# The paths of the source documents' fields, below ``$.data``.
DIM_TEXT = {
    "slug": "slug", "en_slug": "enSlug", "status": "status", "title": "title", "description": "description", "thumbnail_url": "thumbnailUrl",
    "category_main_title": "category.main.title", "category_main_slug": "category.main.slug", "category_sub_title": "category.sub.title", "category_sub_slug": "category.sub.slug",
}
DIM_WHOLE = {"student_count": "studentCount", "like_count": "likeCount", "review_count": "review.count", "lecture_unit_count": "unitSummary.lectureUnitCount", "preview_unit_count": "unitSummary.previewUnitCount", "runtime_sec": "unitSummary.runtime"}
DIM_FLAG = {"is_new": "isNew", "is_best": "isBest", "provides_certificate": "providesCertificate", "provides_instructor_answer": "providesInstructorAnswer", "provides_inquiry": "providesInquiry"}
DIM_TIME = {"published_at": "publishedAt", "last_updated_at": "lastUpdatedAt"}
META_ARRAY = {"category_slugs": "categorySlugs", "skill_slugs": "skillSlugs", "common_tag_slugs": "commonTagsSlugs"}


def active_level(v: Column, path: str = "$.data.levels") -> Column:
    """Code, else title, of the first active level; a first active level without either ends the search."""
    levels = F.try_variant_get(v, path, "array<variant>")
    first = F.slice(F.filter(levels, lambda x: C.to_u8(x, "$.isActive") == 1), 1, 1)
    named = F.transform(first, lambda x: C.first_non_empty(C.as_string(x, "$.code"), C.as_string(x, "$.title")))  # so that levels are gone through once
    return F.coalesce(F.try_element_at(named, F.lit(1)), F.lit(""))


def _complete(captured: DataFrame) -> DataFrame:
    """Dimension and facts need both the online and the meta document, as objects. Told by the first character, so that
    a document that is none is not read for it; one that is no JSON is dropped in ``typed``."""
    return captured.filter(F.col("online").rlike(r"^\s*\{") & F.col("meta").rlike(r"^\s*\{"))


def _fit(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.schema(table)])


def _text(v: Column) -> Column:
    return C.text_at(v, "$")


def _when(v: Column) -> Column:
    return times.parse_ts(C.as_string(v))


PAY = "paymentInfo"
# Columns by coercion, each with its path below ``data``.
ONLINE = [
    (C.as_string, DIM_TEXT),
    (C.as_int, DIM_WHOLE | {"krw_regular_price": f"{PAY}.krwRegularPrice", "krw_pay_price": f"{PAY}.krwPaymentPrice"}),
    (C.to_u8, DIM_FLAG),
    (lambda v: F.coalesce(_when(v), times.epoch()), DIM_TIME),
    (C.as_float, {"average_star": "review.averageStar", "regular_price": f"{PAY}.regularPrice", "pay_price": f"{PAY}.payPrice"}),
    (lambda v: active_level(v, "$"), {"level_code": "levels"}),
    (_text, {"_rate": f"{PAY}.discountRate", "_title": f"{PAY}.discount.title"}),
    (_when, {"discount_ended_at": f"{PAY}.discount.endedAt"}),
]
META = [(C.as_string, {"keywords": "keywords"}), (C.string_array, META_ARRAY)]
DISCOUNTS = [(_text, {"_other_rate": "discountRate", "_other_title": "discountTitle"})]


def typed(captured: DataFrame) -> DataFrame:
    """A row for each capture with an online and a meta document: all columns of the dimension and of both facts, but
    for their hashes. Each document is read once, and only as far as the columns that are used need it."""
    documents = {"online": ONLINE, "meta": META, "discounts": DISCOUNTS}
    read = {d: C.leaves(F.col(d), [f"data.{p}" for _, paths in groups for p in paths.values()]) for d, groups in documents.items()}
    once = F.explode(F.array(F.struct(*[r.alias(d) for d, r in read.items()]))).alias("_read")  # a filter beside it would read again
    docs = _complete(captured).select("fetched_at", "course_id", "locale", "online", "meta", once)
    docs = docs.filter(C.is_json(F.col("online"), F.col("_read.online")) & C.is_json(F.col("meta"), F.col("_read.meta")))
    found = {name: coercion(F.col(f"_read.{d}.data.{p}")).alias(name) for d, groups in documents.items() for coercion, paths in groups for name, p in paths.items()}
    rows = docs.select("fetched_at", "course_id", "locale", *found.values())
    rate = C.int_of(F.coalesce(C.first_non_zero(F.col("_rate"), F.col("_other_rate")), F.lit("0")))
    rows = rows.withColumns({"discount_rate": C.clamp_percent(rate), "discount_title": C.first_non_empty(F.col("_title"), F.col("_other_title"))})
    return rows.drop("_rate", "_title", "_other_rate", "_other_title")


def course_dim(captured: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``rows``: ``typed(captured)``, if it is there already; the same for both facts."""
    return _fit(typed(captured) if rows is None else rows, "course_dim")


def _sig(*names: str) -> Column:
    kinds = {"average_star": H.json_number, "regular_price": H.json_number, "pay_price": H.json_number, "discount_title": H.json_text}
    parts = [H.json_text(times.format_ts(F.col(n))) if n == "discount_ended_at" else kinds.get(n, H.json_whole)(F.col(n)) for n in names]
    return H.h64(H.json_sig(*parts))


def course_metric(captured: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    sig = _sig("student_count", "like_count", "review_count", "average_star", "krw_regular_price", "krw_pay_price", "discount_rate", "discount_title", "discount_ended_at")
    return _fit((typed(captured) if rows is None else rows).withColumn("metric_hash", sig), "course_metric_fact")


def course_price(captured: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    sig = _sig("regular_price", "pay_price", "discount_rate", "discount_title", "discount_ended_at", "krw_regular_price", "krw_pay_price")
    return _fit((typed(captured) if rows is None else rows).withColumn("price_hash", sig), "course_price_fact")


def curriculum_units(captured: DataFrame) -> DataFrame:
    """Sections times units; elements of a wrong kind give defaults."""
    rows = captured.select("fetched_at", "course_id", "locale", F.try_parse_json("curriculum").alias("c"))
    rows = rows.select("fetched_at", "course_id", "locale", F.explode(F.try_variant_get("c", "$.data.curriculum", "array<variant>")).alias("s"))
    s, u = F.col("s"), F.col("u")
    rows = rows.select("fetched_at", "course_id", "locale", C.as_int(s, "$.id").alias("section_id"), C.as_string(s, "$.title").alias("section_title"), F.explode(F.try_variant_get("s", "$.units", "array<variant>")).alias("u"))
    flags = {"is_preview": "isPreview", "has_video": "hasVideo", "has_attachment": "hasAttachment", "is_challenge_only": "isChallengeOnly"}
    rows = rows.withColumns({
        "unit_id": C.as_int(u, "$.id"), "unit_title": C.as_string(u, "$.title"), "unit_type": C.as_string(u, "$.type"), "runtime_sec": C.as_int(u, "$.runtime"),
        "quiz_id": C.nullable_int(u, "$.quizId"), "reading_time": C.nullable_int(u, "$.readingTime"), **{k: C.to_u8(u, f"$.{p}") for k, p in flags.items()},
    })
    raw = lambda p: F.when(C.nullable_str(C.text_at(u, p)).isNull(), F.lit("null")).otherwise(F.to_json(C.at(u, p)))
    c = F.col
    sig = H.json_sig(H.json_whole(c("section_id")), H.json_text(c("section_title")), H.json_whole(c("unit_id")), H.json_text(c("unit_title")), H.json_text(c("unit_type")), H.json_whole(c("runtime_sec")),
                     H.json_whole(c("is_preview")), H.json_whole(c("has_video")), H.json_whole(c("has_attachment")), raw("$.quizId"), raw("$.readingTime"), H.json_whole(c("is_challenge_only")))
    return _fit(rows.withColumn("unit_hash", H.h64(sig)), "course_curriculum_unit")


def _main_instructors(captured: DataFrame) -> DataFrame:
    rows = captured.select("fetched_at", "course_id", F.explode(F.try_variant_get(F.try_parse_json("contents"), "$.data.mainInstructors", "array<variant>")).alias("i"))
    return rows.withColumn("instructor_id", C.as_int(F.col("i"), "$.id")).filter("instructor_id > 0")


def instructors(captured: DataFrame) -> DataFrame:
    i = F.col("i")
    text = {"name": "name", "slug": "slug", "thumbnail_url": "thumbnail", "introduce_html": "introduce"}
    whole = {"course_count": "courseCount", "student_count": "studentCount", "review_count": "reviewCount", "total_star": "totalStar", "answer_count": "answerCount"}
    return _fit(_main_instructors(captured).withColumns({k: C.as_string(i, f"$.{p}") for k, p in text.items()} | {k: C.as_int(i, f"$.{p}") for k, p in whole.items()}), "instructor_dim")


def course_instructors(captured: DataFrame) -> DataFrame:
    return _fit(_main_instructors(captured).withColumn("role", F.lit("main")), "course_instructor_map")


class Bundle(dict):
    """Frames by table name, and the frames that several of them are made from."""

    shared: tuple[DataFrame, ...] = ()


def bundle(captured: DataFrame, snapshots: DataFrame) -> Bundle:
    """All tables of one captured batch, in the order of schemas.BUNDLE."""
    rows = typed(captured)
    made = (snapshots, course_dim(captured, rows), course_metric(captured, rows), course_price(captured, rows), curriculum_units(captured), instructors(captured), course_instructors(captured))
    out = Bundle(zip(schemas.BUNDLE, made))
    out.shared = (captured, rows)
    return out
