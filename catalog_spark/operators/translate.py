"""Requests to a translator, its answers, and the rows they become."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coerce as C
from ..functions import hashing, text

PROMPT = "Translate the JSON object's text fields into the language it names. Answer with one JSON object that has the same text fields."
COURSE_LIMITS = {"title": 180, "description": 500, "category_main_title": 120, "category_sub_title": 120, "keywords": 500}
UNIT_LIMITS = {"section_title": 180, "unit_title": 220}
COURSE_HASHED = ("locale", "title", "description", "category_main_title", "category_sub_title", "level_code", "keywords")
UNIT_HASHED = ("locale", "section_id", "section_title", "unit_id", "unit_title")


def requests(candidates: DataFrame, target: Column, fields: list[str], model: str, temperature: float = 0.2) -> DataFrame:
    """Candidates with ``target_language``, ``source_hash`` inputs kept, and the ``request`` as JSON."""
    code = text.language_code(target)
    body = F.to_json(F.struct(code.alias("target_language"), text.language_name(code).alias("target_language_name"), *fields))
    messages = F.array(F.struct(F.lit("system").alias("role"), F.lit(PROMPT).alias("content")), F.struct(F.lit("user").alias("role"), body.alias("content")))
    request = F.to_json(F.struct(F.lit(model).alias("model"), F.lit(temperature).alias("temperature"), messages.alias("messages")))
    return candidates.withColumn("target_language", code).withColumn("request", request)


AT_ONCE = 1 << 20  # bytes of requests that are Python objects at a time


def apply_translator(rows: DataFrame, fn: Callable[[list[str]], list[str | None]]) -> DataFrame:
    """Add ``response`` from a user's function of a batch of requests; null where it fails for one. A call gets about
    ``AT_ONCE`` bytes of requests, or one longer request; other columns pass as Arrow."""
    at_once = AT_ONCE

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            asked = batch.column("request")
            step = max(1, at_once * len(asked) // max(1, asked.nbytes))
            for k in range(0, batch.num_rows, step):
                said = fn(asked.slice(k, step).to_pylist())
                part = batch.slice(k, step)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(said, pa.string())], [*part.schema.names, "response"])
        pa.default_memory_pool().release_unused()  # the worker lives on

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{shape}, response string")


def answers(rows: DataFrame) -> Column:
    """The JSON object in the first choice's content, as VARIANT; null if there is none."""
    content = C.text_at(F.try_parse_json("response"), "$.choices[0].message.content")
    v = F.try_parse_json(text.extract_json_object(content))
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def course_translations(rows: DataFrame, model: str) -> tuple[DataFrame, DataFrame]:
    """(rows of course_display_translation, failures): an answer without a title is a failure."""
    got = rows.withColumn("a", answers(rows))
    title = text.compact_text(C.as_string(F.col("a"), "$.title"), COURSE_LIMITS["title"])
    got = got.withColumn("_title", title)
    texts = {k: text.compact_text(C.as_string(F.col("a"), f"$.{k}"), n) for k, n in COURSE_LIMITS.items()}
    now = F.current_timestamp()
    out = got.filter("_title <> ''").select(
        "course_id", F.col("locale").alias("source_locale"), "target_language", hashing.source_hash(*[F.col(c) for c in COURSE_HASHED]).alias("source_hash"), now.alias("translated_at"),
        *[texts[k].alias(k) for k in ("title", "description", "category_main_title", "category_sub_title")],
        text.localize_level(F.col("target_language"), F.col("level_code")).alias("level_code"), texts["keywords"].alias("keywords"),
        F.lit(model).alias("model"), hashing.h64(F.lit(PROMPT)).alias("prompt_hash"), F.lit("success").alias("generation_status"), F.lit("").alias("generation_error"), now.alias("ingested_at"),
    )
    return out, got.filter("_title = '' OR _title IS NULL").drop("a", "_title")


def unit_translations(rows: DataFrame, model: str) -> tuple[DataFrame, DataFrame]:
    """(rows of curriculum_display_translation, failures): a blank section title falls back to the source's."""
    got = rows.withColumn("a", answers(rows))
    got = got.withColumn("_title", text.compact_text(C.as_string(F.col("a"), "$.unit_title"), UNIT_LIMITS["unit_title"]))
    section = C.first_non_empty(text.compact_text(C.as_string(F.col("a"), "$.section_title"), UNIT_LIMITS["section_title"]), F.col("section_title"))
    now = F.current_timestamp()
    out = got.filter("_title <> ''").select(
        "course_id", F.col("locale").alias("source_locale"), "target_language", "section_id", "unit_id", hashing.source_hash(*[F.col(c) for c in UNIT_HASHED]).alias("source_hash"),
        now.alias("translated_at"), section.alias("section_title"), F.col("_title").alias("unit_title"), F.lit(model).alias("model"), hashing.h64(F.lit(PROMPT)).alias("prompt_hash"),
        F.lit("success").alias("generation_status"), F.lit("").alias("generation_error"), now.alias("ingested_at"),
    )
    return out, got.filter("_title = '' OR _title IS NULL").drop("a", "_title")
