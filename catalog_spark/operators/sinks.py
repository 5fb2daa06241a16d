"""Appending to target tables, alone, as a bundle and with an outbox."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sources import manifests
from . import ledger
from . import outbox as box


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share, below spark.checkpoint.dir; a local one only where that is unset and
    Spark runs in one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='spark-scratch-')}"
    return f"{shared.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def fitted(rows: DataFrame, table: str) -> DataFrame:
    """The table's columns in order: missing ones null, others dropped."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.schema(table)])


def append_table(rows: DataFrame, root: str, table: str) -> None:
    fitted(rows, table).write.mode("append").parquet(f"{root}/{table}")


def read_or_empty(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A target table: what was appended to it and what committed bundles hold; without rows if there is nothing."""
    return manifests.read_table(spark, root, table, schemas.schema(table))


def write_bundle(bundle: dict[str, DataFrame], root: str, commit_id: str | None = None) -> dict[str, DataFrame]:
    """All tables in their fixed order; the first error stops the rest. Returns the tables as written by this call.

    Readers that go by the manifests (``read_or_empty``, ``sources.documents.read_table``) see either the whole bundle
    or nothing of it: its files lie in folders of its own until one manifest lists them all. After an error these
    folders are deleted. A ``commit_id`` makes a retry harmless: a bundle that is committed already is only read.

    What the tables have in common (``flatten.Bundle.shared``) is persisted while they are written, so it is made once.
    """
    shared = getattr(bundle, "shared", ())
    some = next(iter(bundle.values()))
    spark = some.sparkSession
    commit_id = commit_id or manifests.new_id()
    tables = [t for t in schemas.BUNDLE if t in bundle]
    if not manifests.is_committed(spark, root, commit_id):
        for rows in shared:
            rows.persist()
        try:
            for table in tables:
                fitted(bundle[table], table).write.mode("overwrite").parquet(manifests.staged(root, commit_id, table))
            manifests.publish(spark, root, {t: f"{root}/{t}" for t in tables}, commit_id)
        finally:
            for rows in shared:
                rows.unpersist()
            manifests.delete(spark, f"{root}/{manifests.STAGED}/{commit_id}")
    return {t: manifests.read_files(spark, manifests.files_of(spark, f"{root}/{t}", commit_id), schemas.schema(t)) for t in tables}


def write_with_outbox(rows: DataFrame, table: str, writer, outbox: DataFrame, database: str = "", chunk: int = 100) -> DataFrame | None:
    """Write with a writer that writes all rows or none, as Spark's own do; after a temporary error return the outbox
    rows that keep them, and raise any other error."""
    ready = fitted(rows, table)
    try:
        writer(ready)
        return None
    except Exception as e:
        if not any(n in str(e).lower() for n in box.TEMPORARY):
            raise
        columns = ready.columns
        return box.enqueue(box.chunked(ready, columns, columns[:1], chunk), outbox, database, table, columns, str(e))


def send_with_outbox(rows: DataFrame, table: str, send: Callable[[str], None], root: str, database: str = "", chunk: int = 100, delivery: str | None = None) -> int:
    """Send rows in NDJSON chunks, each on its own; chunks that fail by a temporary error go to the outbox table below
    ``root``, unless an equal one is pending, and their number is returned. Any other error is raised afterwards.

    ``send`` runs in the tasks. A ledger below ``root`` (``ledger.deliver``) keeps each chunk's outcome, so no retry of
    a task and no action sends a chunk again; with the same ``delivery`` a job that was cut off goes on where it was.
    """
    spark = rows.sparkSession
    ready = fitted(rows, table)
    columns = ready.columns
    chunks = box.chunked(ready, columns, columns[:1], chunk)
    done = ledger.deliver(chunks, send, root, delivery or manifests.new_id()).filter("step = 'failed'")
    if done.isEmpty():
        return 0
    late = chunks.join(done.select(F.col("payload_hash").cast(chunks.schema["payload_hash"].dataType).alias("payload_hash"), "error"), "payload_hash")
    waiting = late.filter(box.is_temporary(F.col("error")))
    fresh = fitted(box.enqueue(waiting, read_or_empty(spark, root, "insert_outbox"), database, table, columns, F.col("error")), "insert_outbox")
    commit_id = manifests.new_id()
    fresh.write.parquet(manifests.staged(root, commit_id, "insert_outbox"))
    manifests.publish(spark, root, {"insert_outbox": f"{root}/insert_outbox"}, commit_id)
    other = done.filter(~box.is_temporary(F.col("error"))).first()
    if other:
        raise RuntimeError(other["error"])
    return manifests.read_files(spark, manifests.files_of(spark, f"{root}/insert_outbox", commit_id), schemas.schema("insert_outbox")).count()
