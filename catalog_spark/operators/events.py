"""Rows of the bundle's tables as events of one envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing, times

ENVELOPE = ("event_uuid", "source", "host", "uuid_user", "ip", "url", "event_type", "payload", "created_at")


def payload_to_json(rows: DataFrame) -> DataFrame:
    """A ``payload`` struct, map or VARIANT becomes the string ``payload_json`` ({} for null); other rows stay."""
    if "payload" not in rows.columns:
        return rows
    kind = rows.schema["payload"].dataType.typeName()
    made = F.col("payload") if kind == "string" else F.to_json("payload")
    return rows.withColumn("payload_json", F.coalesce(made, F.lit("{}"))).drop("payload")


def to_ndjson(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(value): one JSON object for each row, null columns included; columns that the rows lack are null."""
    return rows.select(F.to_json(F.struct(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"}).alias("value"))


FEW = 8  # copies of a row that are made where it was counted


def numbered(rows: DataFrame, number: str = "_equal", block: int = 1_000, made: dict[str, Column] | None = None) -> DataFrame:
    """Rows with their number among equal rows, from 1. Equal rows are counted before the shuffle; rows that come more than
    ``FEW`` times are cut into blocks of numbers, which are dealt to all tasks: counted rows may be so few that Spark puts
    them into one task, whose copies are all rows there are. ``made`` are further columns, computed once for equal rows.
    Columns must be of types that can be grouped by."""
    counted = rows.groupBy(*[F.col(f"`{c}`") for c in rows.columns]).agg(F.count("*").alias("_n"))
    one, few_n = F.lit(1).cast("long"), min(block, FEW)
    few = counted.filter(F.col("_n") <= few_n).withColumns(made or {}).withColumn(number, F.explode(F.sequence(one, F.col("_n"))))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = counted.filter(F.col("_n") > few_n).withColumn("_from", F.explode(F.sequence(one, F.col("_n"), F.lit(block).cast("long")))).repartition(tasks)
    many = many.withColumns(made or {}).withColumn(number, F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + block - 1, F.col("_n"))))).drop("_from")
    return few.unionByName(many).drop("_n")


def to_events(rows: DataFrame, table: str, namespace: str = "catalog", source: str = "", host: str = "", ip: str = "", id_key: str | None = None) -> DataFrame:
    """Each row as an event ``<namespace>.<table>.v1`` created at fetched_at, else updated_at, else now.

    Identifiers are random, so a partition that is computed again has others. With ``id_key``, a secret, they come from
    a keyed hash of the row, its table and its number among equal rows (a shuffle of the rows): the same in every run and
    every attempt, different for equal rows, and not to be guessed from the row. A row without a time has that of the run.
    """
    rows = payload_to_json(rows)
    if id_key is not None:
        line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
        rows = numbered(rows, made={"_line": line})
    stamps = [F.col(c) for c in ("fetched_at", "updated_at") if c in rows.columns]
    created = F.coalesce(*stamps, F.current_timestamp())
    if id_key is None:
        made = hashing.uuid7(created)
    else:
        made = hashing.uuid7_of(created, hashing.keyed_hash(id_key, F.lit(table), F.col("_line"), F.col("_equal")))
    own = F.coalesce(F.when(F.trim("uuid") != "", F.col("uuid")), made) if table.endswith("course_snapshot_raw") and "uuid" in rows.columns else made
    url = F.coalesce("source_url", F.lit("")) if "source_url" in rows.columns else F.lit("")
    payload = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}) if id_key is None else F.col("_line")
    return enveloped(rows, own, url, f"{namespace}.{table}.v1", payload, times.format_ts(created), source, host, ip)


def enveloped(rows: DataFrame, uuid: Column, url: Column, event_type: str, payload: Column, created: Column, source: str = "", host: str = "", ip: str = "") -> DataFrame:
    """The columns of ENVELOPE."""
    return rows.select(
        uuid.alias("event_uuid"), F.lit(source).alias("source"), F.lit(host).alias("host"), F.lit("").alias("uuid_user"), F.lit(ip).alias("ip"),
        url.alias("url"), F.lit(event_type).alias("event_type"), payload.alias("payload"), created.alias("created_at"),
    )


def bundle_events(bundle: dict[str, DataFrame], **settings) -> DataFrame:
    out = None
    for name, rows in bundle.items():
        events = to_events(rows, name, **settings)
        out = events if out is None else out.unionByName(events)
    return out


def event_key(event_type: Column, url: Column, uuid: Column) -> Column:
    return F.concat_ws(":", event_type, F.when(F.trim(url) != "", url).otherwise(uuid))


def kafka_frame(events: DataFrame) -> DataFrame:
    """(key, value) for a Kafka sink."""
    return events.select(event_key(F.col("event_type"), F.col("url"), F.col("event_uuid")).alias("key"), F.to_json(F.struct(*ENVELOPE)).alias("value"))


def write_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Needs Spark's Kafka connector on the class path."""
    kafka_frame(events).write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option("topic", topic).save()
