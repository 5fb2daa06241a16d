"""Tables of latest versions by key, kept incrementally: a base in buckets of the key, and deltas beside it.

A write adds one delta, of its own rows only. A read joins the base with the deltas' latest versions; the base lies in
buckets already, so only the deltas are shuffled. ``compact`` writes a new base from both. Every step becomes visible by
a manifest (``sources.manifests``), so readers see a whole state, and a repeated commit changes nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import manifests
from .latest import latest_by


class KeyedTable:
    """The latest version of each key below ``root``.

    ``schema`` names all columns; of a key's versions the one with the largest ``order`` column counts, then the largest
    other columns. Rows with a null in a key are left out. ``buckets`` is the number for new bases; a base keeps its own.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], order: str, buckets: int | None = None):
        self.spark, self.root, self.schema, self.keys, self.order = spark, root, schema, keys, order
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.values = [f.name for f in schema if f.name not in (*keys, order)]

    def _versions(self, rows: DataFrame) -> DataFrame:
        best = latest_by(rows, self.keys, self.order, self.values)
        return best.withColumnRenamed(f"max_{self.order}", self.order).select(*self.schema.names)

    def _fitted(self, rows: DataFrame) -> DataFrame:
        named = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema]
        return rows.select(*named).dropna(subset=self.keys)

    def append(self, rows: DataFrame, commit_id: str | None = None) -> bool:
        """Add a delta; false if ``commit_id`` was committed before (a retry), and then nothing is written."""
        commit_id = commit_id or manifests.new_id()
        if manifests.is_committed(self.spark, self.root, commit_id):
            return False
        self._versions(self._fitted(rows)).write.mode("overwrite").parquet(manifests.staged(self.root, commit_id, "delta"))
        return manifests.publish(self.spark, self.root, {"delta": self.root}, commit_id)

    def deltas(self) -> int:
        """The number of deltas that a read merges."""
        return sum("delta" in m["tables"] for m in manifests.commits(self.spark, self.root))

    def _parts(self) -> tuple[DataFrame | None, int, DataFrame]:
        """(base, its buckets, deltas): as the manifests list them now."""
        found = manifests.commits(self.spark, self.root)
        base, buckets = None, self.buckets
        for m in found:
            if "base" in m["tables"]:
                base, buckets = self._bucketed(m["folder"], m["buckets"]), m["buckets"]
        return base, buckets, manifests.read_files(self.spark, [f for m in found for f in m["tables"].get("delta", [])], self.schema)

    def _bucketed(self, folder: str, buckets: int) -> DataFrame:
        """The base as a table of this session's catalogue, which is how Spark knows buckets."""
        name = f"keyed_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{folder}'")
        return self.spark.table(name)

    def _merged(self, base: DataFrame | None, buckets: int, deltas: DataFrame) -> DataFrame:
        fresh = self._versions(deltas.repartition(buckets, *self.keys))  # one shuffle, which the join uses, too
        if base is None:
            return fresh
        ours = fresh.select(*self.keys, F.struct(self.order, *self.values).alias("_new"))
        both = base.select(*self.keys, F.struct(self.order, *self.values).alias("_old")).join(ours, self.keys, "full_outer")
        best = F.when(F.col("_old").isNull() | (F.col("_new") > F.col("_old")), F.col("_new")).otherwise(F.col("_old"))
        return both.select(*self.keys, best.alias("_best")).select(*self.keys, "_best.*").select(*self.schema.names)

    def read(self) -> DataFrame:
        return self._merged(*self._parts())

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The latest versions of the given keys only; again without a shuffle of the base."""
        asked = keys.select(*self.keys).distinct()
        base, buckets, deltas = self._parts()
        some = None if base is None else base.join(asked, self.keys, "left_semi")
        return self._merged(some, buckets, deltas.join(asked, self.keys, "left_semi"))

    def compact(self) -> bool:
        """A new base from the base and the deltas there are; deltas that come meanwhile stay. False if there are none."""
        found = manifests.commits(self.spark, self.root)
        covered = [m["id"] for m in found if {"base", "delta"} & m["tables"].keys()]
        if not any("delta" in m["tables"] for m in found):
            return False
        commit_id = manifests.new_id()
        folder = f"{self.root}/base-{commit_id}"
        name = f"keyed_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"
        rows = self.read().repartition(self.buckets, *self.keys)  # one file a bucket
        rows.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", folder).saveAsTable(name)
        forgotten = [x for m in found for x in m["replaces"]]  # so that a retry of an old commit stays known
        return manifests.commit(self.spark, self.root, {"base": manifests.data_files(self.spark, folder)}, commit_id, covered + forgotten, folder=folder, buckets=self.buckets)

    def compact_if(self, deltas: int) -> bool:
        return self.deltas() >= deltas and self.compact()
