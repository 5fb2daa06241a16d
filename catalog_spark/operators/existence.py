"""Existence by a filter first: candidates that are surely new do not shuffle.

Tasks set the bits of their known keys in a bitmap each and hand on its words that are not zero; equal words are merged
by ``bit_or``. The filter has ``BITS`` bits for each known key, by their count, but ``WORDS`` words of 64 bits at most,
which bounds what is broadcast (32 MB) whatever the number of keys. A fuller filter only says "maybe" more often. It
never says "new" of a known key, and an exact anti join decides about the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 10
WORDS = 1 << 22


def _places(hashes, words: int, probes: int):
    """Bit numbers of 64-bit hashes, a row for each probe, by double hashing."""
    import numpy as np

    with np.errstate(over="ignore"):
        a = hashes.astype(np.uint64)
        b = a ^ (a >> np.uint64(30))
        b = b * np.uint64(0xBF58476D1CE4E5B9)  # one round of a mixing function makes the second hash
        b = (b ^ (b >> np.uint64(27))) | np.uint64(1)
        return (a + np.arange(probes, dtype=np.uint64)[:, None] * b) % np.uint64(64 * words)


@dataclass
class KeyFilter:
    """A filter over known keys: its words on the executors, how many bits a key sets, and the keys' types."""

    bits: object
    words: int
    probes: int
    known: int
    types: list[T.DataType]

    def expected_rate(self) -> float:
        """The share of new keys that it takes for known, as its size lets expect; less if known keys repeat."""
        return (1 - math.exp(-self.probes * self.known / (64 * self.words))) ** self.probes

    def maybe(self, *keys: Column) -> Column:
        """Whether a key may be known; false is certain."""
        held, words, probes = self.bits, self.words, self.probes

        @F.pandas_udf("boolean")
        def probe(h):
            import numpy as np
            import pandas as pd

            at = _places(h.to_numpy(), words, probes)
            found = held.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
            return pd.Series(found.all(axis=0))

        return probe(F.xxhash64(*keys))


def _checked(rows: DataFrame, keys: list[str]) -> list[T.DataType]:
    types = [rows.schema[k].dataType for k in keys]
    for k, t in zip(keys, types):
        if isinstance(t, (T.FloatType, T.DoubleType)):
            raise TypeError(f"{k}: equal numbers of floating point can have different hashes")
    return types


def key_filter(known: DataFrame, keys: list[str], bits: int = BITS, most: int = WORDS) -> KeyFilter:
    """The filter of known keys, which are read twice: to count and to set bits. An empty table gives an empty filter."""
    spark: SparkSession = known.sparkSession
    types = _checked(known, keys)
    hashed = known.select(F.xxhash64(*keys).alias("h"))
    n = hashed.count()
    words = max(1, min(most, -(-n * bits // 64)))
    probes = max(1, min(16, round(64 * words / max(n, 1) * math.log(2))))

    def bitmap(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = None
        for batch in batches:
            own = np.zeros(words, np.uint64) if own is None else own
            at = _places(batch.column("h").to_numpy(), words, probes).ravel()
            np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        if own is not None:
            used = np.flatnonzero(own)
            for i in range(0, len(used), 65_536):
                some = used[i : i + 65_536]
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(own[some].view(np.int64))], names=["word", "bits"])

    merged = hashed.mapInArrow(bitmap, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()  # ``most`` rows at most
    import numpy as np

    all_bits = np.zeros(words, np.uint64)
    all_bits[merged["word"].to_numpy(np.int64)] = merged["bits"].to_numpy(np.int64).view(np.uint64)
    return KeyFilter(spark.sparkContext.broadcast(all_bits), words, probes, n, types)


def new_rows(candidates: DataFrame, known: DataFrame, keys: list[str], held: KeyFilter | None = None) -> DataFrame:
    """Candidates whose key is not known, as ``discovery.new_rows``; a key with a null is new.

    Rows that the filter calls new go straight on; only the others are joined. A filter that was made before of the same
    keys can be ``held``. Keys must have the same types on both sides, as the filter knows hashes only.
    """
    held = held or key_filter(known, keys)
    if _checked(candidates, keys) != held.types:
        raise TypeError(f"keys are {_checked(candidates, keys)} here and {held.types} in the filter")
    maybe = held.maybe(*keys)
    rest = candidates.filter(maybe).join(known.select(*keys), keys, "left_anti").select(*candidates.columns)
    return candidates.filter(~maybe).unionByName(rest)
