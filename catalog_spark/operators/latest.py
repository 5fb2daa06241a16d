"""Versions and best rows: one aggregation buffer for all columns, never a window over a key's whole history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(rows: DataFrame, keys: list[str], ts: str, columns: list[str], tie: list[str] = ()) -> DataFrame:
    """The latest version of each key: its columns and ``max_<ts>``. Ties go to the largest of ``tie``, then columns."""
    order = F.struct(ts, *tie, *columns)
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("_best"), F.max(ts).alias(f"max_{ts}"))
    return best.select(*keys, "_best.*", f"max_{ts}")


def best_by(rows: DataFrame, keys: list[str], columns: list[str], order: list[Column], extra: list[Column] = ()) -> DataFrame:
    """The columns of each key's least row by a composite order, and further aggregates."""
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_best"), *extra)
    return best.select(*keys, "_best.*", *[c for c in best.columns if c not in (*keys, "_best")])


def stalest(rows: DataFrame, keys: list[str], ts: str, limit: int, url: str | None = None, ok: Column | None = None) -> DataFrame:
    """Keys whose latest version is oldest, ``limit`` of them; rows that are not ``ok`` and blank URLs do not count."""
    rows = rows if ok is None else rows.filter(ok)
    columns = [url] if url else []
    aggregates = [F.max(ts).alias(f"last_{ts}")] + ([F.max_by(url, F.struct(ts, url)).alias(url)] if url else [])
    found = rows.groupBy(*keys).agg(*aggregates)
    if url:
        found = found.filter(F.trim(url) != "")
    return found.orderBy(f"last_{ts}", *keys).limit(limit).select(*keys, *columns, f"last_{ts}")


def distinct_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*keys).distinct()


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) for each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def union_bundles(bundles: list[dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """All rows of several bundles, table by table."""
    out: dict[str, DataFrame] = {}
    for bundle in bundles:
        for name, df in bundle.items():
            out[name] = out[name].unionByName(df, allowMissingColumns=True) if name in out else df
    return out
