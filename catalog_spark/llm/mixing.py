"""Mixing sources to target weights by systematic sampling.

Each document of a source has the same expected number of copies, target / source size. Within a source the
documents stand in one fixed order; the running sum of expected copies plus one random offset for the source crosses
some whole numbers, and a document is emitted once for each whole number its own step crosses. The order is by hash
buckets of about ``BUCKET`` documents and by size within them, so that running sums need only a small table of bucket
counts and a window over one bucket, and the words taken stay near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import forget, materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_COPIES = 2
BUCKET = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, most=MOST_COPIES) -> DataFrame:
    """Add ``target`` to (source, n, source_size), one row per source.

    Weights repeat over the sources by code point, null last. Sources whose weighted share is above ``most`` times
    their size stop there, and the rest is shared anew: taken in ascending order of cap / weight, a source is capped
    while its share of what is left reaches its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    scale = 1
    for w in weights:
        scale *= w
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ordered = Window.orderBy("_reach", F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("_reach").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = sources.withColumn("_w", w.cast("long")).withColumn("_cap", F.lit(most) * F.col("source_size"))
    t = t.withColumn("_reach", F.col("_cap") * scale / F.col("_w"))
    t = t.withColumn("_total", F.sum("source_size").over(everything) * share_percent / 100)
    t = t.withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
    t = t.withColumn("_capped", F.col("_w") * F.col("_left") >= F.col("_cap") * F.sum("_w").over(onward))
    free = F.sum(F.when(~F.col("_capped"), F.col("_w"))).over(everything)
    rest = F.col("_total") - F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_cap"))).over(everything), F.lit(0))
    return t.withColumn("target", F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(F.col("_w") * rest / free)).select(
        "source", "n", "source_size", "target"
    )


def unit(text: Column) -> Column:
    """A number in [0, 1) from a text, the same in every run."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / float(16**13)


def mix(rows: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | str = "size", seed: str = "mix", bucket_rows: int = BUCKET) -> DataFrame:
    """All rows as the struct ``row`` with size, source_size, target, copies and taken (= copies x size).

    Null sources are one source; null ids are ordered first; repeated rows count each for itself (which of equal rows
    gets a copy is immaterial); rows of size 0 take 0 words, and a source of size 0 has no copies; an empty table
    gives no rows. Other columns stay inside ``row``, so their names cannot clash.
    """
    size = F.col(size) if isinstance(size, str) else size
    rows = rows.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.cast("long").alias("size"))
    narrow = materialise(rows.select("id", "source", "size"))
    sources = materialise(targets(narrow.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))))
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")
    bucket = hashed % F.ceil(F.col("n") / bucket_rows)
    s = sources.withColumnRenamed("source", "_s")
    same = F.col("source").eqNullSafe(F.col("_s"))
    counts = narrow.join(s, same).groupBy("source", bucket.alias("bucket")).agg(F.count("*").alias("rows"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialise(counts.select(F.col("source").alias("_bs"), F.col("bucket").alias("_bb"), F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("ahead")))
    forget(narrow)
    within = Window.partitionBy("source", "bucket").orderBy(F.col("size"), F.col("id").asc_nulls_first())
    out = rows.join(s, same).drop("_s").withColumn("bucket", bucket).withColumn("at", F.row_number().over(within) - 1)
    out = out.join(counts, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("bucket") == F.col("_bb")))
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = unit(F.concat(F.lit(seed + "|"), F.coalesce(F.col("source"), F.lit("\x00"))).cast("binary"))
    rank = F.col("ahead") + F.col("at")
    out = out.withColumn("_step", step).withColumn("_u", offset)
    crossed = F.floor((rank + 1) * F.col("_step") + F.col("_u")) - F.floor(rank * F.col("_step") + F.col("_u"))
    out = out.withColumn("copies", F.least(crossed, F.ceil("_step")).cast("long"))
    return out.select("row", "id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(mixed: DataFrame) -> DataFrame:
    """The rows themselves, each as often as its copies say."""
    return mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def resample(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **settings) -> DataFrame:
    """What ``emit`` gives for whole documents, sized by their words: all columns, each row as often as the mix takes it.

    Only ids, sources and sizes are ranked. Their copies meet the documents by 128 bits of hashes of id, source and
    text, in a hash join, so that whole texts are shuffled once and never sorted. Equal rows share their copies.
    """
    parts = [F.col(f"`{c}`") for c in (id_col, source_col, text_col)]
    key = [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(1), *parts).alias("k2")]
    narrow = materialise(docs.select(*key, parts[0].alias("id"), parts[1].alias("source"), word_count(parts[2]).alias("size")))
    taken = mix(narrow, "id", "source", **settings).groupBy("row.k1", "row.k2").agg(F.sum("copies").alias("copies"), F.count("*").alias("n"))
    taken = materialise(taken.filter("copies > 0"))
    forget(narrow)
    rows = docs.select(*key, F.struct("*").alias("row"))
    met = rows.join(taken.filter("n = 1").drop("n").hint("shuffle_hash"), ["k1", "k2"]).select("row", "copies")
    equal = taken.filter("n > 1").drop("n")
    if not equal.isEmpty():
        one = rows.join(equal, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("row").alias("row"))
        met = met.union(one.join(equal, ["k1", "k2"]).select("row", "copies"))
    return emit(met)


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INTEGER]::BIGINT AS w
  FROM d GROUP BY source
), a AS (
  SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 150 / 100 AS total,
         ((sum(source_size) OVER () * 150 / 100)
           - coalesce(sum(2 * source_size) OVER (ORDER BY source_size * 12 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS remaining,
         sum(w) OVER (ORDER BY source_size * 12 / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward
  FROM s
), b AS (SELECT *, w * remaining >= cap * onward AS capped FROM a
), t AS (
  SELECT source, n, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE w::DOUBLE * (total - coalesce(sum(cap) FILTER (capped) OVER (), 0))::DOUBLE / (sum(w) FILTER (NOT capped) OVER ())::DOUBLE END AS target
  FROM b
), r AS (
  SELECT d.doc_id, d.size, t.source, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0.0 END AS step,
         ('0x' || substr(sha256('mix|' || coalesce(t.source, chr(0))), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0 AS u,
         row_number() OVER (PARTITION BY d.source ORDER BY
           ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 8))::UBIGINT % ceil(t.n / 4096.0)::UBIGINT, d.size, d.doc_id NULLS FIRST) - 1 AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (least(floor((k + 1) * step + u) - floor(k * step + u), ceil(step)) * size)::BIGINT AS taken
FROM r
"""
