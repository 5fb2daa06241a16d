"""The scan of sitemaps as a stream, whose offset is the place (sitemap_index, url_index).

Resolved sitemaps lie in a folder, each in one of its own that is renamed into place when it is whole, cut into slices
of ``SLICE`` URLs. A trigger admits at most ``max_scan`` URLs from its place on and ends before a sitemap that is not
there, as one that is unavailable for now. The place after the last URL admitted is the batch's end; it is kept beside
the folder when a batch is planned, which is after Spark has logged that batch, so a stream that starts again goes on
behind the last batch logged, and a batch that runs again is the same. The driver sees sizes only: a listing for each
sitemap and one Parquet footer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..operators import discovery, state
from ..operators.ledger import _files
from ..sources import manifests

SLICE = 10_000
PLACED = "sitemap_index int, url_index int, url string"
FOUND, POINTS = "new_url", "crawl_checkpoint"
Place = tuple[int, int]


def add_sitemaps(locations: DataFrame, folder: str, slice_rows: int = SLICE) -> int:
    """Put sitemaps (``sitemaps.sitemap_locs``: sitemap_index, url_index, url) into the folder; how many were new. A
    sitemap that is there already stays as it is, so a retry changes nothing. A task writes slices, not sitemaps."""
    spark = locations.sparkSession
    new = f"{folder}/_new-{uuid.uuid4().hex}"
    cut = locations.select(F.col("sitemap_index").cast("int"), F.col("url_index").cast("int"), "url").withColumn("slice", F.floor(F.col("url_index") / slice_rows).cast("int"))
    dealt = cut.repartition("sitemap_index", "slice").sortWithinPartitions("sitemap_index", "slice", "url_index")
    dealt.write.partitionBy("sitemap_index", "slice").parquet(new)
    store, path = _files(folder)
    placed = 0
    for name, _, is_folder in manifests.listed(spark, new):
        if is_folder and name.startswith("sitemap_index=") and not _there(store, f"{path}/{name}"):
            store.move(f"{path}/{new.rsplit('/', 1)[1]}/{name}", f"{path}/{name}")
            placed += 1
    manifests.delete(spark, new)
    return placed


def _there(store, path: str) -> bool:
    from pyarrow import fs

    return store.get_file_info(path).type != fs.FileType.NotFound


class Slice(InputPartition):
    """URLs [low, high) of a sitemap, all in one slice."""

    def __init__(self, path: str, sitemap_index: int, low: int, high: int):
        self.path, self.sitemap_index, self.low, self.high = path, sitemap_index, low, high


class _Scan(DataSourceStreamReader):
    def __init__(self, folder: str, place: str, start: Place, max_scan: int):
        self.folder, self.place, self.start, self.max_scan = folder, place, start, max_scan
        self.at: Place | None = None

    def _parts(self, store, path: str, i: int) -> list[tuple[int, list[str]]]:
        """(slice, its files) of a sitemap in order; none if it is not there."""
        from pyarrow import fs

        found: dict[int, list[str]] = {}
        for info in store.get_file_info(fs.FileSelector(f"{path}/sitemap_index={i}", allow_not_found=True, recursive=True)):
            if info.base_name.endswith(".parquet"):
                found.setdefault(int(info.path.rsplit("/", 2)[1].split("=")[1]), []).append(info.path)
        return sorted(found.items())

    def _rows(self, store, files: list[str]) -> tuple[int, int]:
        """(first, last + 1) url_index of a slice, from its footers."""
        import pyarrow.parquet as pq

        low, high = [], []
        for path in files:
            with store.open_input_file(path) as f:
                meta = pq.read_metadata(f)
            for g in range(meta.num_row_groups):
                told = meta.row_group(g).column(0).statistics
                low.append(told.min)
                high.append(told.max)
        return min(low), max(high) + 1

    def _slices(self, start: Place, most: int | None = None, end: Place | None = None) -> Iterator[Slice]:
        """What follows a place: ``most`` URLs, or those up to an end."""
        store, path = _files(self.folder)
        i, j = start
        left = most
        while (left is None or left > 0) and (end is None or (i, j) < end):
            parts = self._parts(store, path, i)
            if not parts:
                return
            for _, files in parts:
                low, high = self._rows(store, files)
                low = max(low, j)
                if end is not None and i == end[0]:
                    high = min(high, end[1])
                if left is not None:
                    high = min(high, low + left)
                if low < high:
                    for file in files:
                        yield Slice(file, i, low, high)
                    if left is not None:
                        left -= high - low
                        if left <= 0:
                            return
            i, j = i + 1, 0

    def _stored(self) -> Place:
        store, path = _files(self.place)
        if not _there(store, path):
            return self.start
        with store.open_input_stream(path) as f:
            return tuple(json.loads(f.read()))

    def initialOffset(self) -> dict:
        return _offset(self.start)

    def latestOffset(self) -> dict:
        self.at = self.at or self._stored()
        last = self.at
        for s in self._slices(self.at, most=self.max_scan):
            last = (s.sitemap_index, s.high)
        return _offset(last)

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        low, high = _place(start), _place(end)
        if self.at is None or high > self.at:
            store, path = _files(self.place)
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(f"{path}.tmp") as f:
                f.write(json.dumps(high).encode())
            store.move(f"{path}.tmp", path)
            self.at = high
        return list(self._slices(low, end=high))

    def read(self, partition: Slice) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        store, _ = _files(self.folder)
        with store.open_input_file(partition.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(columns=["url_index", "url"]):
                inside = pc.and_(pc.greater_equal(batch["url_index"], partition.low), pc.less(batch["url_index"], partition.high))
                batch = batch.filter(inside)
                if batch.num_rows:
                    index = pa.array([partition.sitemap_index] * batch.num_rows, pa.int32())
                    yield pa.RecordBatch.from_arrays([index, batch["url_index"], batch["url"]], names=["sitemap_index", "url_index", "url"])


def _offset(place: Place) -> dict:
    return {"sitemap_index": int(place[0]), "url_index": int(place[1])}


def _place(offset: dict) -> Place:
    return offset["sitemap_index"], offset["url_index"]


def scan_stream(spark: SparkSession, folder: str, place: str, start: Place = (0, 0), max_scan: int = 1500) -> DataFrame:
    """(sitemap_index, url_index, url) of the sitemaps in a folder as a stream. ``place`` is the file that keeps the
    stream's place; it belongs to one checkpoint folder. Sitemaps follow each other by number."""

    class SitemapScan(DataSource):
        @classmethod
        def name(cls) -> str:
            return "sitemap_scan"

        def schema(self):
            return PLACED

        def streamReader(self, schema):
            return _Scan(folder, place, start, max_scan)

    spark.dataSource.register(SitemapScan)
    return spark.readStream.format("sitemap_scan").load()


def find_new(root: str, known: Callable[[SparkSession], DataFrame], keys: list[str], name: str, with_keys: Callable[[DataFrame], DataFrame] = lambda urls: urls):
    """A ``foreachBatch`` function: the first URL of each key that neither ``known`` nor an earlier batch has, and the
    checkpoint after the batch, in one commit under the batch's number, so a repeated batch changes nothing."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commit_id = f"{name}-{batch_id}"
        if manifests.is_committed(spark, root, commit_id):
            return
        rows = with_keys(batch)
        schema = rows.schema
        before = manifests.read_table(spark, root, FOUND, schema)
        already = known(spark).select(*keys).unionByName(before.select(*keys))
        first = discovery.dedupe_first(discovery.new_rows(rows, already, keys), keys, ["sitemap_index", "url_index"])
        last = batch.agg(F.max(F.struct("sitemap_index", "url_index")).alias("p")).first()["p"]
        try:
            first.select(*schema.names).write.mode("overwrite").parquet(manifests.staged(root, commit_id, FOUND))
            folders = {FOUND: f"{root}/{FOUND}"}
            if last:
                state.checkpoint_row(spark, name, last["sitemap_index"], last["url_index"] + 1).write.mode("overwrite").parquet(manifests.staged(root, commit_id, POINTS))
                folders[POINTS] = f"{root}/{POINTS}"
            manifests.publish(spark, root, folders, commit_id)
        finally:
            manifests.delete(spark, f"{root}/{manifests.STAGED}/{commit_id}")

    return run


def start_scan(spark: SparkSession, folder: str, root: str, checkpoint: str, known: Callable[[SparkSession], DataFrame], keys: list[str], name: str, start: Place = (0, 0), max_scan: int = 1500, once: bool = False, with_keys: Callable[[DataFrame], DataFrame] = lambda urls: urls) -> StreamingQuery:
    """Start the scan; with ``once`` it admits one batch, as a run of ``collect_new`` does, and ends."""
    urls = scan_stream(spark, folder, f"{checkpoint}/place.json", start, max_scan)
    writer = urls.writeStream.foreachBatch(find_new(root, known, keys, name, with_keys)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="0 seconds")).start()


def read_found(spark: SparkSession, root: str, schema: str | T.StructType = PLACED) -> DataFrame:
    """(sitemap_index, url_index, url, and what else the scan's keys are) found so far."""
    return manifests.read_table(spark, root, FOUND, schema)
