"""Reading input tables, Arrow batches, and cutting lineage with tables in the cluster's shared folder."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents are large, so few are held at a time. Only settings that still have Spark's default are changed.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "1m")}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROW_GROUP = 16 << 20
AT_ONCE = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """For applications (the registered queries and the pipeline): Arrow batches that suit documents, in their own
    session, unless it has set others. Operators never call this."""
    for key, (default, value) in BATCHES.items():
        if spark.conf.get(key, None) in (default, None):
            spark.conf.set(key, value)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the length of a block; afterwards those from before."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def slices(batch: pa.RecordBatch, column: pa.Array, at_once: int = AT_ONCE) -> Iterator[tuple[pa.RecordBatch, list]]:
    """The batch in slices of about ``at_once`` bytes of ``column`` (texts or bytes), each with the column's values, so
    that few of them are Python objects at a time, whatever the session's batch size. A longer value stands alone."""
    size = column.nbytes // max(1, len(column)) + 1
    step = max(1, at_once // size)
    for k in range(0, batch.num_rows, step):
        yield batch.slice(k, step), column.slice(k, step).to_pylist()


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow``; at the end of each partition the worker, which lives on, gives its free memory back."""

    def tidy(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
            trim(0)

    return df.mapInArrow(tidy, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset, a temporary one in local mode only, as executors
    on other machines would not see each other's files there."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def materialise(df: DataFrame, folders: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder (in folders by a column, if one is named) and read it back, so that
    later stages do not recompute it and a lost executor costs only the tasks that were running."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    with session_settings(spark, {CLEANUP: "true"}):  # the written table takes the place of the shuffles behind it
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path, partitionBy=folders)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def spread_join(left: DataFrame, keyed: DataFrame, key: str, n_col: str, total: Callable[[], int]) -> DataFrame:
    """Left join of ``left`` with ``keyed``, which has one row a key and in ``n_col`` the number of the key's rows in ``left``.

    Keys with more than a quarter of an average partition's rows, of which there are fewer than four a partition, are
    broadcast, so that no task gets all rows of a hot key; their rows then pass the shuffle join under keys of their own.
    """
    spark = left.sparkSession
    heavy_from = max(1000, total() // (4 * shuffle_partitions(spark)))
    value = F.struct(*(c for c in keyed.columns if c not in (key, n_col)))
    small, heavy = keyed.filter(F.col(n_col) <= heavy_from), keyed.filter(F.col(n_col) > heavy_from)
    one = left.join(F.broadcast(heavy.select(F.col(key).alias("_heavy"), value.alias("_hot"))), F.col(key) == F.col("_heavy"), "left")
    own = F.when(F.col("_heavy").isNull(), F.col(key)).otherwise(F.concat(F.lit("~"), F.monotonically_increasing_id().cast("string")))
    both = one.withColumn("_own", own).join(small.select(F.col(key).alias("_light"), value.alias("_cold")), F.col("_own") == F.col("_light"), "left")
    got = F.coalesce("_hot", "_cold")
    return both.select(*left.columns, *(got[c].alias(c) for c in keyed.columns if c not in (key, n_col)))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """``materialise``, in buckets of ``key`` (as many as the session has shuffle partitions): what needs the rows of a
    key together does not shuffle the table again."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    with session_settings(spark, {CLEANUP: "true"}):
        writer = df.write.bucketBy(buckets or shuffle_partitions(spark), key)
        writer.option("path", path).option("parquet.block.size", ROW_GROUP).saveAsTable(name)
    out = spark.table(name)
    out._written_path, out._table = path, name
    return out


def bucket_labels(spark: SparkSession, buckets: int) -> list[int]:
    """For each bucket a whole number that falls in it, so that rows labelled with these get a bucket each."""
    label = spark.range(64 * buckets).select("id", F.pmod(F.hash("id"), F.lit(buckets)).alias("bucket"))
    return [r["label"] for r in label.groupBy("bucket").agg(F.min("id").alias("label")).orderBy("bucket").collect()]


def forget(*tables: DataFrame) -> None:
    """Delete the files behind tables from ``materialise`` or ``bucketed`` that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_written_path", None):
            spark = df.sparkSession
            if name := getattr(df, "_table", None):
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
