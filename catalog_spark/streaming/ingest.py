"""Captured payloads as a stream: stateless flattening, and one batch function that writes all tables of the bundle,
the crawl state and the outbox."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import capture, flatten, sinks, state
from ..sources import manifests

CAPTURED = "fetched_at timestamp, course_id long, locale string, source_url string, online string, meta string, curriculum string, discounts string, contents string"


def captured_stream(spark: SparkSession, path: str, max_files: int = 200) -> DataFrame:
    """Captures (columns of CAPTURED) that arrive as JSON files."""
    return spark.readStream.schema(CAPTURED).option("maxFilesPerTrigger", max_files).json(path)


def snapshots(batch: DataFrame) -> DataFrame:
    """Rows of course_snapshot_raw: one for each document of a capture, under the address it is fetched from."""
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(k).alias("payload_json")) for k in capture.KINDS]
    rows = batch.select("fetched_at", "course_id", "locale", "source_url", F.explode(F.array(*kinds)).alias("d")).filter("d.payload_json IS NOT NULL")
    address = F.create_map(*[F.lit(x) for k, n in capture.NEEDLES.items() for x in (k, n.replace("\\", ""))])[F.col("d.kind")]
    key = F.replace(address, F.lit("{id}"), F.col("course_id").cast("string"))
    return capture.snapshot_rows(rows.select("fetched_at", "course_id", "locale", "source_url", key.alias("query_key"), F.col("d.payload_json").alias("payload_json")))


def send_batch(root: str, send: Callable[[str, str], None], database: str = "", chunk: int = 100):
    """A ``foreachBatch`` function that sends the bundle's tables in chunks: ``send(table, lines)`` runs in the tasks.

    Each table of a batch is a delivery of its own in the ledger below ``root``, so a batch that runs again goes on
    where it was; chunks that fail for a temporary error go to the outbox one by one, and the others are not held up.
    Snapshots are written to ``root`` first, so that a batch that runs again has the same identifiers, and so the same
    chunks. The crawl state is committed under the batch's number.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = f"{root}/{manifests.STAGED}/captures/{batch_id}"
        if not manifests.exists(spark, f"{kept}/_SUCCESS"):
            snapshots(batch).write.mode("overwrite").parquet(kept)
        shots = spark.read.schema(schemas.schema("course_snapshot_raw")).parquet(kept)
        batch = batch.persist()
        try:
            for table, rows in flatten.bundle(batch, shots).items():
                sinks.send_with_outbox(rows, table, partial(send, table), root, database, chunk, f"batch-{batch_id}-{table}")
            state.append_state(spark, root, state.seen_courses(shots, flatten.course_dim(batch)), f"batch-{batch_id}")
        finally:
            batch.unpersist()

    return run


def write_batch(root: str, write=None, database: str = ""):
    """A ``foreachBatch`` function: all tables of the bundle, the crawl state of the courses seen, and an outbox.

    A batch that runs again after a failure replaces its own folders, so that no row is written twice. ``write`` is a
    function of (rows, folder) that writes all rows or none; rows that it cannot write for a temporary error go to the
    outbox, other errors end the batch.
    """
    write = write or (lambda rows, folder: rows.write.mode("overwrite").parquet(folder))

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        here = lambda table: f"{root}/{table}/batch_id={batch_id}"
        batch = batch.persist()
        shots = snapshots(batch).persist()  # their identifiers are drawn once
        try:
            nothing = spark.createDataFrame([], schemas.schema("insert_outbox"))
            kept = nothing
            for table, rows in flatten.bundle(batch, shots).items():
                late = sinks.write_with_outbox(rows, table, lambda ready, table=table: write(ready, here(table)), nothing, database)
                kept = kept if late is None else kept.unionByName(late)
            kept.write.mode("overwrite").parquet(here("insert_outbox"))
            state.append_state(spark, root, state.seen_courses(shots, flatten.course_dim(batch)), f"batch-{batch_id}")
        finally:
            shots.unpersist()
            batch.unpersist()

    return run


def start(captures: DataFrame, root: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Start the ingest; ``once`` takes what is there and ends."""
    writer = captures.writeStream.foreachBatch(write_batch(root)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def read_stream_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}").drop("batch_id")
