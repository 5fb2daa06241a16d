"""Deliveries of chunks with a ledger that tasks write ahead.

A task appends a line for each chunk before it sends it and one with the outcome afterwards, to a log of its own below
``<root>/_ledger/<delivery>``. When a task, an executor or a whole job runs again, chunks with an outcome are not sent
again: a task reads the logs of earlier attempts at its partition, a job those of all. A chunk whose log ends with the
line before it is in doubt and is sent once more, marked as such; its hash lets a receiver tell. Nothing is cached, and
no action on the result sends anything.

The logs are flushed line by line, which local, network and HDFS folders can do.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..sources import manifests
from . import outbox

LINE = "payload_hash string, step string, attempt int, error string, at long"
FOLDER = "_ledger"


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


@dataclass
class Delivered(WriterCommitMessage):
    """A task's word that its chunks have outcomes: how many were sent now, and how many it found done."""

    log: str | None = None
    sent: int = 0
    found: int = 0
    failed: int = 0


class _Writer(DataSourceArrowWriter):
    def __init__(self, send: Callable[..., None], folder: str, in_order: bool = False):
        self.send, self.folder, self.in_order = send, folder, in_order

    def _known(self, store, path: str, part: int) -> dict[str, tuple[str, str | None]]:
        """(step, error) of chunks with an outcome, or in doubt, in logs of earlier attempts at this partition."""
        from pyarrow import fs

        steps: dict[str, tuple[str, str | None]] = {}
        for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if info.base_name.startswith(f"p{part}-"):
                with store.open_input_stream(info.path) as f:
                    for line in f.read().decode().splitlines():
                        try:
                            one = json.loads(line)
                        except ValueError:  # cut off when the task died
                            continue
                        if one["payload_hash"] not in steps or one["step"] in ("sent", "failed"):  # logs come in any order
                            steps[one["payload_hash"]] = one["step"], one["error"]
        return steps

    def _chunks(self, batch) -> Iterator[tuple[str, str | None, tuple]]:
        """(name, target if in order, arguments of ``send``) of each chunk."""
        names, lines = batch.column("payload_hash").to_pylist(), batch.column("rows_json").to_pylist()
        if not self.in_order:
            return ((h, None, (text,)) for h, text in zip(names, lines))
        tables, targets = batch.column("target_table").to_pylist(), batch.column("target").to_pylist()
        return ((h, target, (table, text)) for h, target, table, text in zip(names, targets, tables, lines))

    def write(self, iterator: Iterator) -> Delivered:
        task = TaskContext.get()
        store, path = _files(self.folder)
        store.create_dir(path, recursive=True)
        known = self._known(store, path, task.partitionId())
        out = Delivered()
        log = None
        stopped: set[str] = set()  # targets that cannot be written now

        def note(h: str, step: str, error: str | None = None) -> None:
            log.write((json.dumps({"payload_hash": h, "step": step, "attempt": task.attemptNumber(), "error": error, "at": time.time_ns()}) + "\n").encode())
            log.flush()

        try:
            for batch in iterator:
                for h, target, said in self._chunks(batch):
                    if target in stopped:
                        continue
                    step, error = known.get(h, ("", None))
                    if step in ("sent", "failed"):
                        out.found += 1
                        if target is not None and step == "failed" and outbox.temporary_text(error or ""):
                            stopped.add(target)
                        continue
                    if log is None:
                        out.log = f"{path}/p{task.partitionId()}-{task.taskAttemptId()}-{time.time_ns()}.jsonl"
                        log = store.open_output_stream(out.log, buffer_size=None)
                    note(h, "again" if step in ("begin", "again") else "begin")
                    try:
                        self.send(*said)
                    except Exception as e:  # noqa: BLE001 - the error is data here: it is stored with the chunk
                        note(h, "failed", str(e) or type(e).__name__)
                        out.failed += 1
                        if target is not None and outbox.temporary_text(str(e)):
                            stopped.add(target)
                    else:
                        note(h, "sent")
                        out.sent += 1
        finally:
            if log is not None:
                log.close()
        return out


def _source(send: Callable[..., None], folder: str, in_order: bool = False) -> type[DataSource]:
    class Writer(_Writer):
        def commit(self, messages) -> None:
            """All tasks have outcomes for all their chunks."""
            done = [m for m in messages if m is not None]
            store, path = _files(folder)
            with store.open_output_stream(f"{path}/_done.json") as f:
                f.write(json.dumps({"sent": sum(m.sent for m in done), "found": sum(m.found for m in done), "failed": sum(m.failed for m in done), "logs": [m.log for m in done if m.log]}).encode())

        def abort(self, messages) -> None:
            """The logs stay: they say what was sent, to whoever runs the delivery again."""

    class ChunkDelivery(DataSource):
        @classmethod
        def name(cls) -> str:
            return "chunk_delivery"

        def writer(self, schema, overwrite):
            return Writer(send, folder, in_order)

    return ChunkDelivery


def entries(spark: SparkSession, root: str, delivery: str) -> DataFrame:
    """(payload_hash, step, attempt, error, at): the delivery's ledger so far. Steps are begin, again (in doubt), sent
    and failed. A line that was cut off has no hash and is left out."""
    folder = f"{root}/{FOLDER}/{delivery}"
    logs = [path for name, path, is_folder in manifests.listed(spark, folder) if name.endswith(".jsonl")]
    if not logs:
        return spark.createDataFrame([], LINE)
    return spark.read.schema(LINE).json(logs).filter("payload_hash IS NOT NULL")


def outcomes(spark: SparkSession, root: str, delivery: str) -> DataFrame:
    """(payload_hash, step, error): each chunk's last outcome, sent or failed."""
    ended = entries(spark, root, delivery).filter(F.col("step").isin("sent", "failed"))
    return ended.groupBy("payload_hash").agg(F.max_by(F.struct("step", "error"), "at").alias("o")).select("payload_hash", "o.*")


def deliver(chunks: DataFrame, send: Callable[[str], None], root: str, delivery: str) -> DataFrame:
    """Send the ``rows_json`` of each chunk (``payload_hash``, ``rows_json``) that has no outcome in the ledger yet; the
    outcomes of all. Equal chunks are one. ``send`` runs in the tasks; what it raises is the chunk's outcome."""
    spark = chunks.sparkSession
    named = chunks.select(F.col("payload_hash").cast("string").alias("payload_hash"), "rows_json").dropDuplicates(["payload_hash"])
    todo = named.join(outcomes(spark, root, delivery).select("payload_hash"), "payload_hash", "left_anti")
    source = _source(send, f"{root}/{FOLDER}/{delivery}")
    spark.dataSource.register(source)
    todo.write.format("chunk_delivery").mode("append").save()
    return outcomes(spark, root, delivery)


def replay(box: DataFrame, send: Callable[[str, str], None], root: str, limit: int | None = 50, delivery: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Replay pending chunks in one job: (the outbox with its marks, outcomes).

    Each target's chunks go through one ordered iterator in a task, oldest first, and that stops at the target's first
    temporary error; its later chunks stay as they are, other targets go on, and a lasting error marks its own chunk
    only. A target's order leaves it one task; its chunks stream through it, a batch of them in memory. ``send(target,
    lines)`` runs in the tasks. With the same ``delivery`` a replay that was cut off goes on where it was, and a target
    that had stopped stays so. Outcomes: (outbox_uuid, step, error). Without a limit all pending chunks are taken.
    """
    spark = box.sparkSession
    delivery = delivery or manifests.new_id()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    taken = outbox.pending(box, limit).select(F.col("outbox_uuid").alias("payload_hash"), "rows_json", "target_database", "target_table", "created_at")
    dealt = taken.repartition(n, "target_database", "target_table").sortWithinPartitions("target_database", "target_table", "created_at", "payload_hash")
    target = F.to_json(F.struct("target_database", "target_table")).alias("target")
    spark.dataSource.register(_source(send, f"{root}/{FOLDER}/{delivery}", in_order=True))
    dealt.select("payload_hash", "rows_json", "target_table", target).write.format("chunk_delivery").mode("append").save()
    done = outcomes(spark, root, delivery).withColumnRenamed("payload_hash", "outbox_uuid")
    return outbox.mark_replayed(box, done), done
