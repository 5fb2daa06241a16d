"""An event log as a sink of its own: a data source whose writers are tasks, for batches and for streams.

Events are keyed, and a key's events go to one partition of the log in the order in which they come. A task hands its
events over in batches of ``batch`` and tries only those again that failed, if their errors pass by themselves; any
other error, or the last attempt's, ends the task. What was taken is kept in segments, a file for each task and
partition, and the task's commit message names them. The driver's commit lists the segments of all tasks in one manifest
(``sources.manifests``), so a failed or repeated write, or a repeated batch of a stream, never shows twice.
"""

from __future__ import annotations

import json
import time
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from ..sources import manifests
from .ledger import _files
from .outbox import retryable_text

TABLE = "events"
EVENT = "partition int, key string, value string"
Publish = Callable[[int, list[tuple[str, str]]], list[str | None]]


def accept(partition: int, events: list[tuple[str, str]]) -> list[str | None]:
    """Hand events over to nobody but the log itself."""
    return [None] * len(events)


def partition_of(key: Column, partitions: int) -> Column:
    return (F.crc32(key) % partitions).cast("int")


def delays(attempts: int, least: float, most: float) -> list[float]:
    """Seconds before each further attempt: doubled from ``least`` to ``most`` at most."""
    return [min(most, least * 2**k) for k in range(attempts - 1)]


@dataclass
class Segments(WriterCommitMessage):
    """What a task has written: its segments, and how many events it handed over how often."""

    files: list[str] = field(default_factory=list)
    events: int = 0
    repeated: int = 0


class _Task:
    """The work of one task, the same for batches and streams."""

    def __init__(self, settings: dict):
        self.settings = settings

    def hand_over(self, partition: int, events: list[tuple[str, str]], out: Segments) -> list[tuple[str, str]]:
        """Events in the order in which they were taken."""
        publish, waits, taken = self.settings["publish"], [*self.settings["waits"], None], []
        for wait in waits:
            errors = publish(partition, events)
            taken += [e for e, error in zip(events, errors) if error is None]
            failed = [(e, error) for e, error in zip(events, errors) if error is not None]
            if not failed:
                return taken
            lasting = [error for _, error in failed if not retryable_text(error)]
            if lasting or wait is None:
                raise RuntimeError((lasting or [failed[0][1]])[0])
            events = [e for e, _ in failed]
            out.repeated += len(events)
            time.sleep(wait)
        return taken

    def write(self, iterator: Iterator) -> Segments:
        store, root = _files(self.settings["root"])
        store.create_dir(f"{root}/{TABLE}", recursive=True)
        out, held, open_ = Segments(), {}, {}

        def flush(p: int) -> None:
            if p not in open_:
                path = f"{root}/{TABLE}/p{p}-{TaskContext.get().taskAttemptId()}-{time.time_ns()}.jsonl"
                open_[p] = store.open_output_stream(path)
                out.files.append(path)
            taken = self.hand_over(p, held.pop(p), out)
            out.events += len(taken)
            open_[p].write("".join(json.dumps({"partition": p, "key": k, "value": v}) + "\n" for k, v in taken).encode())

        try:
            for batch in iterator:
                for k, v in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist()):
                    p = zlib.crc32((k or "").encode()) % self.settings["partitions"]
                    held.setdefault(p, []).append((k, v))
                    if len(held[p]) >= self.settings["batch"]:
                        flush(p)
            for p in sorted(held):
                flush(p)
        finally:
            for f in open_.values():
                f.close()
        return out

    def commit_as(self, commit_id: str, messages: list) -> None:
        """One manifest for all segments, unless it is there."""
        from pyarrow import fs

        store, root = _files(self.settings["root"])
        folder = f"{root}/{manifests.FOLDER}"
        store.create_dir(folder, recursive=True)
        names = [i.base_name for i in store.get_file_info(fs.FileSelector(folder))]
        if any(n.endswith(f"-{commit_id}.json") for n in names):
            return
        done = [m for m in messages if m is not None]
        at = time.time_ns()
        body = {"id": commit_id, "at": at, "tables": {TABLE: [f for m in done for f in m.files]}, "replaces": [], "events": sum(m.events for m in done), "repeated": sum(m.repeated for m in done)}
        with store.open_output_stream(f"{folder}/_{commit_id}.tmp") as f:
            f.write(json.dumps(body).encode())
        store.move(f"{folder}/_{commit_id}.tmp", f"{folder}/{at:020d}-{commit_id}.json")

    def drop(self, messages: list) -> None:
        store, _ = _files(self.settings["root"])
        for m in messages:
            for path in m.files if m is not None else ():
                store.delete_file(path)


class _BatchWriter(DataSourceArrowWriter, _Task):
    def write(self, iterator):
        return _Task.write(self, iterator)

    def commit(self, messages) -> None:
        self.commit_as(self.settings["commit_id"], messages)

    def abort(self, messages) -> None:
        self.drop(messages)


class _StreamWriter(DataSourceStreamArrowWriter, _Task):
    def write(self, iterator):
        return _Task.write(self, iterator)

    def commit(self, messages, batchId) -> None:
        self.commit_as(f"{self.settings['commit_id']}-{batchId}", messages)

    def abort(self, messages, batchId) -> None:
        self.drop(messages)


def _register(spark: SparkSession, root: str, commit_id: str, partitions: int, publish: Publish, attempts: int, least: float, most: float, batch: int) -> None:
    settings = {"root": root, "commit_id": commit_id, "partitions": partitions, "publish": publish, "waits": delays(attempts, least, most), "batch": batch}

    class EventLog(DataSource):
        @classmethod
        def name(cls) -> str:
            return "event_log"

        def writer(self, schema, overwrite):
            return _BatchWriter(settings)

        def streamWriter(self, schema, overwrite):
            return _StreamWriter(settings)

    spark.dataSource.register(EventLog)


def write_events(framed: DataFrame, root: str, order: list[str] = (), partitions: int = 8, publish: Publish = accept, commit_id: str | None = None, attempts: int = 3, least: float = 1.0, most: float = 12.0, batch: int = 100) -> None:
    """Append events (``events.kafka_frame``: key, value) to the log below ``root``. A ``commit_id`` that is known already
    appends nothing. ``order`` columns, if the frame has them, order a partition's events, which leaves each partition one
    task and its sort; without them a partition's events go to as many tasks as the session shuffles to, a key's to one
    of them, and are not sorted."""
    spark = framed.sparkSession
    commit_id = commit_id or manifests.new_id()
    if manifests.is_committed(spark, root, commit_id):
        return
    _register(spark, root, commit_id, partitions, publish, attempts, least, most, batch)
    part = partition_of(F.coalesce("key", F.lit("")), partitions)
    if order:
        dealt = framed.withColumn("_partition", part).repartition(partitions, "_partition").sortWithinPartitions("_partition", *order)
    else:
        tasks = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // partitions))  # for each partition of the log
        dealt = framed.repartitionById(partitions * tasks, part + partitions * F.pmod(F.xxhash64("key"), F.lit(tasks)).cast("int"))
    dealt.select("key", "value").write.format("event_log").mode("append").save()


def start_events(framed: DataFrame, root: str, checkpoint: str, name: str, once: bool = False, partitions: int = 8, publish: Publish = accept, attempts: int = 3, least: float = 1.0, most: float = 12.0, batch: int = 100) -> StreamingQuery:
    """The same for a stream of events; ``name`` tells the stream's batches from others' in the log."""
    _register(framed.sparkSession, root, name, partitions, publish, attempts, least, most, batch)
    writer = framed.select("key", "value").writeStream.format("event_log").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """(partition, key, value) of all committed segments."""
    files = manifests.table_files(spark, root, TABLE)
    return spark.read.schema(EVENT).json(files) if files else spark.createDataFrame([], EVENT)
