"""Dead letters: failed chunks kept as NDJSON, replayed in order, and errors sorted by kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce as C
from ..functions import hashing, text
from ..sources.documents import ndjson_rows

# Lower-case parts of messages of temporary write errors.
TEMPORARY = (
    "code: 242", "code: 667", "code: 999", "table_is_read_only", "not_initialized", "not initialized", "not initialized yet", "readonly mode",
    "read-only", "keeper_exception", "coordination error", "connection loss", "session expired", "replica is not active", "replica is not ready",
    "replica is not initialized", "zookeeper", "clickhouse keeper", "network_error", "socket_timeout", "timeout_exceeded", "all connection tries failed",
    "context deadline exceeded", "i/o timeout", "no route to host", "connection refused", "timeout", "temporary", "connection reset", "broken pipe", "eof",
)
# Reasons of event write errors, first match first.
REASONS = (
    ("leader-metadata-stale", ("not leader for partition", "not the leader for", "partition has no leader", "has no leader", "metadata are likely out of date")),
    ("leader-not-available", ("leader not available",)),
    ("timeout", ("timeout",)),
    ("network", ("eof", "connection reset", "connection refused", "broken pipe", "failed to dial", "failed to open connection", "no route to host", "network is unreachable", "temporary failure in name resolution")),
)
RETRYABLE_OTHER = ("i/o timeout",)


def is_temporary(message: Column) -> Column:
    low = F.lower(F.coalesce(message, F.lit("")))
    return C.any_of([low.contains(n) for n in TEMPORARY])


def temporary_text(message: str) -> bool:
    """``is_temporary`` of one message, for code that runs in tasks."""
    return any(n in message.lower() for n in TEMPORARY)


def retry_reason(message: Column) -> Column:
    low = F.lower(F.coalesce(message, F.lit("")))
    out = F.when(low == "", F.lit(""))
    for reason, needles in REASONS:
        out = out.when(C.any_of([low.contains(n) for n in needles]), F.lit(reason))
    return out.otherwise(F.lit("temporary-kafka-error"))


def is_retryable(message: Column) -> Column:
    """Whether an event write error's message names a condition that passes by itself."""
    low = F.lower(F.coalesce(message, F.lit("")))
    needles = [n for reason, ns in REASONS if reason != "timeout" for n in ns] + list(RETRYABLE_OTHER)
    return C.any_of([low.contains(n) for n in needles])


def retryable_text(message: str) -> bool:
    """``is_retryable`` of one message, for code that runs in tasks."""
    needles = [n for reason, ns in REASONS if reason != "timeout" for n in ns] + list(RETRYABLE_OTHER)
    return any(n in message.lower() for n in needles)


def error_report(rows: DataFrame, message: str) -> DataFrame:
    """(temporary, reason, n) over messages."""
    return rows.groupBy(is_temporary(F.col(message)).alias("temporary"), retry_reason(F.col(message)).alias("reason")).agg(F.count("*").alias("n"))


def chunked(rows: DataFrame, columns: list[str], order: list[str], size: int = 100) -> DataFrame:
    """(chunk, rows_json, row_count, payload_hash): rows as NDJSON chunks of about ``size``, the same in every run.

    Rows fall into chunks by a hash of their line and of its number among equal lines, so that equal rows spread, too;
    ``order`` columns break no ties but fix the lines' order within. Equal lines are counted before the shuffle and then
    numbered, so no task gathers them.
    """
    line = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    lines = rows.select(line.alias("value"), F.struct(*[F.col(c).cast("string") for c in order]).alias("at"))
    n = max(1, -(-rows.count() // size))
    counted = lines.groupBy("value", "at").agg(F.count("*").alias("_n"))
    lines = counted.select("value", "at", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_k"))
    made = lines.groupBy(F.pmod(F.xxhash64("value", "_k"), F.lit(n)).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("all"))
    made = made.select("chunk", F.array_join(F.transform("all", lambda x: x["value"]), "\n").alias("rows_json"), F.size("all").alias("row_count"))
    return made.withColumn("payload_hash", hashing.h64(F.col("rows_json")))


def enqueue(chunks: DataFrame, outbox: DataFrame, database: str, table: str, columns: list[str], error: str | Column) -> DataFrame:
    """New outbox rows for failed chunks, without those of which an equal one is pending (or comes twice)."""
    pending = outbox.filter(F.col("replayed_at").isNull() & (F.col("target_table") == table) & (F.col("target_database") == database)).select("payload_hash")
    fresh = chunks.dropDuplicates(["payload_hash"]).join(pending, "payload_hash", "left_anti")
    now, nothing = F.current_timestamp(), F.lit(None).cast("timestamp")
    return fresh.select(
        hashing.uuid7(now).alias("outbox_uuid"), now.alias("created_at"), F.lit(database).alias("target_database"), F.lit(table).alias("target_table"),
        F.array(*map(F.lit, columns)).alias("target_columns"), "rows_json", F.col("row_count").cast("int").alias("row_count"), "payload_hash",
        text.error_text(error if isinstance(error, Column) else F.lit(error), 400).alias("source_error"), F.lit(0).alias("replay_attempt"), nothing.alias("last_replay_at"), nothing.alias("replayed_at"), F.lit("").alias("replay_error"),
    )


def pending(outbox: DataFrame, limit: int | None = 50) -> DataFrame:
    """Well-formed pending chunks among the ``limit`` oldest, or all of them in no order without a limit; malformed
    ones (a blank field) stay pending."""
    whole = C.any_of([F.trim(F.coalesce(c, F.lit(""))) == "" for c in ("outbox_uuid", "target_database", "target_table", "rows_json")])
    first = outbox.filter(F.col("replayed_at").isNull())
    if limit is not None:
        first = first.orderBy("created_at", "outbox_uuid").limit(limit)
    return first.filter(~whole & (F.size("target_columns") > 0))


def replay_rows(chunks: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """The rows of a target's pending chunks."""
    return ndjson_rows(chunks.filter(F.col("target_table") == table), schema)


def mark_replayed(outbox: DataFrame, results: DataFrame) -> DataFrame:
    """The outbox after a replay with ``results`` (outbox_uuid, error: null for success)."""
    r = results.select("outbox_uuid", F.col("error").alias("_error"), F.lit(True).alias("_tried"))
    joined = outbox.join(r, "outbox_uuid", "left")
    tried, won, now = F.col("_tried").isNotNull(), F.col("_error").isNull(), F.current_timestamp()
    out = joined.withColumns({
        "replay_attempt": F.when(tried, F.col("replay_attempt") + 1).otherwise(F.col("replay_attempt")),
        "last_replay_at": F.when(tried, now).otherwise(F.col("last_replay_at")),
        "replayed_at": F.when(tried & won, now).otherwise(F.col("replayed_at")),
        "replay_error": F.when(tried & won, F.lit("")).when(tried, text.error_text(F.col("_error"), 400)).otherwise(F.col("replay_error")),
    })
    return out.select(*outbox.columns)


def drain(spark: SparkSession, outbox: DataFrame, writers: dict, schemas: dict[str, T.StructType], limit: int = 50) -> tuple[DataFrame, int]:
    """Replay pending chunks in order through ``writers`` (table -> function of a DataFrame), which write all rows they
    get or none, as Spark's own do.

    Returns the outbox with its marks and the number of chunks written. A chunk that fails is marked and the rest
    goes on, but once a target is found unwritable (a temporary error), its later chunks wait for another run. A target's
    chunks are one write; only if that fails, its halves are tried, oldest first, down to the chunk that fails. At most
    ``limit`` chunk names are looped over; the rows stay on the executors.
    """
    todo: dict[str, list[str]] = {}
    for r in pending(outbox, limit).orderBy("created_at", "outbox_uuid").select("outbox_uuid", "target_table").collect():
        todo.setdefault(r[1], []).append(r[0])
    results = []

    def tried(table: str, uuids: list[str]) -> bool:
        """Whether the target can be written still."""
        try:
            if table not in writers:
                raise ValueError(f"no writer for {table}")
            chunks = outbox.filter(F.col("outbox_uuid").isin(uuids)).orderBy("created_at", "outbox_uuid")
            writers[table](replay_rows(chunks, table, schemas[table]))
            results.extend((u, None) for u in uuids)
        except Exception as e:  # noqa: BLE001 - the error is data here: it is stored with the chunk
            if len(uuids) > 1:
                half = len(uuids) // 2
                return tried(table, uuids[:half]) and tried(table, uuids[half:])
            results.append((uuids[0], str(e)))
            return not temporary_text(str(e))
        return True

    for table, uuids in todo.items():
        tried(table, uuids)
    marks = spark.createDataFrame(results, "outbox_uuid string, error string")
    return mark_replayed(outbox, marks), sum(e is None for _, e in results)
