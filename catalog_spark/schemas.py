"""Target tables: ordered columns and types. All are append-only versions; the latest by time wins at read time."""

from __future__ import annotations

from pyspark.sql import types as T

_ARRAY = "array<string>"

DDL = {
    "course_snapshot_raw": "uuid string, fetched_at timestamp, course_id long, locale string, source_url string, query_key string, query_key_hash decimal(20,0), status_code string, error_code string, payload_json string, payload_hash decimal(20,0)",
    "crawl_checkpoint": "source string, updated_at timestamp, sitemap_index int, url_index int",
    "course_state": "course_id long, locale string, source_url string, first_seen_at timestamp, last_fetched_at timestamp, written_at timestamp",
    "course_dim": "course_id long, locale string, fetched_at timestamp, slug string, en_slug string, status string, title string, description string, thumbnail_url string, category_main_title string, category_main_slug string, category_sub_title string, category_sub_slug string, level_code string, is_new int, is_best int, student_count long, like_count long, review_count long, average_star double, lecture_unit_count long, preview_unit_count long, runtime_sec long, provides_certificate int, provides_instructor_answer int, provides_inquiry int, published_at timestamp, last_updated_at timestamp, keywords string, "
    f"category_slugs {_ARRAY}, skill_slugs {_ARRAY}, common_tag_slugs {_ARRAY}",
    "course_metric_fact": "fetched_at timestamp, course_id long, locale string, student_count long, like_count long, review_count long, average_star double, krw_regular_price long, krw_pay_price long, discount_rate int, discount_title string, discount_ended_at timestamp, metric_hash decimal(20,0)",
    "course_price_fact": "fetched_at timestamp, course_id long, locale string, regular_price double, pay_price double, discount_rate int, discount_title string, discount_ended_at timestamp, krw_regular_price long, krw_pay_price long, price_hash decimal(20,0)",
    "course_curriculum_unit": "fetched_at timestamp, course_id long, locale string, section_id long, section_title string, unit_id long, unit_title string, unit_type string, runtime_sec long, is_preview int, has_video int, has_attachment int, quiz_id long, reading_time long, is_challenge_only int, unit_hash decimal(20,0)",
    "instructor_dim": "instructor_id long, fetched_at timestamp, name string, slug string, thumbnail_url string, course_count long, student_count long, review_count long, total_star long, answer_count long, introduce_html string",
    "course_instructor_map": "fetched_at timestamp, course_id long, instructor_id long, role string",
    "course_display_translation": "course_id long, source_locale string, target_language string, source_hash decimal(20,0), translated_at timestamp, title string, description string, category_main_title string, category_sub_title string, level_code string, keywords string, model string, prompt_hash decimal(20,0), generation_status string, generation_error string, ingested_at timestamp",
    "curriculum_display_translation": "course_id long, source_locale string, target_language string, section_id long, unit_id long, source_hash decimal(20,0), translated_at timestamp, section_title string, unit_title string, model string, prompt_hash decimal(20,0), generation_status string, generation_error string, ingested_at timestamp",
    "insert_outbox": f"outbox_uuid string, created_at timestamp, target_database string, target_table string, target_columns {_ARRAY}, rows_json string, row_count int, payload_hash decimal(20,0), source_error string, replay_attempt int, last_replay_at timestamp, replayed_at timestamp, replay_error string",
}

#: The tables that one captured batch fills, in the order they are written.
BUNDLE = ("course_snapshot_raw", "course_dim", "course_metric_fact", "course_price_fact", "course_curriculum_unit", "instructor_dim", "course_instructor_map")


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[table])
