"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

Terms are the words of a text, weighted by their counts. For each of ``SAMPLES`` draws and each term, two gamma
variates and a uniform one come from hashes of (term, draw), so they are the same in every document. A term of weight
w has the level t = floor(ln w / r + b) and the key ln c - r (t - b + 1); the term with the least key is the draw's
sample. Two documents draw the same sample with probability equal to their generalised Jaccard similarity. A key
depends on term and level alone, so the least key itself names the sample, and plain minima of doubles suffice.

``SAMPLES`` = 32 draws give a likeness with a standard error of at most 0.09 (the square root of s (1 - s) / 32 for a
similarity s). Time is in proportion to the draws; 64 would bring the error to 0.06 at twice the time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import bucket_labels, bucketed, forget, materialise, shuffle_partitions

SAMPLES = 32
DRAWS = 8  # computed side by side; more would make generated code too long for the JVM's compiler
GAPS = r"[\x20\x09-\x0D]+"
RANGES = 4  # ranges of ids for each shuffle partition of the session


def _unit(bits: Column, width: int) -> Column:
    return (bits.cast("double") + 0.5) * (2.0**-width)


def keys(term: Column, first: Column, log_weight: Column, draws: int):
    """For ``draws`` draws from number ``first`` on: their hashed bits as columns, and the keys from these."""
    bits, out = {}, []
    for k in range(draws):
        bits[f"g{k}"] = F.xxhash64(term, 2 * (first + k))
        bits[f"h{k}"] = F.xxhash64(term, 2 * (first + k) + 1)
        g, h = F.col(f"g{k}"), F.col(f"h{k}")
        low = (1 << 21) - 1
        bits[f"r{k}"] = -F.ln(_unit(g.bitwiseAND(F.lit(low)), 21) * _unit(F.shiftrightunsigned(g, 43), 21))
        bits[f"b{k}"] = _unit(F.shiftright(g, 21).bitwiseAND(F.lit(low)), 21)
        c = -F.ln(_unit(h.bitwiseAND(F.lit(0xFFFFFFFF)), 32) * _unit(F.shiftrightunsigned(h, 32), 32))
        r, b = F.col(f"r{k}"), F.col(f"b{k}")
        out.append(F.ln(c) - r * (F.floor(log_weight / r + b) - b + 1.0))
    return bits, out


def signatures(texts: DataFrame, by: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """(by..., fingerprint): one fingerprint for each group of ``by``; 8 hexadecimal digits for each draw.

    Rows whose text is null or has no word give no row here. The counts of a text's terms stay in its partition if
    ``texts`` is already partitioned by some of ``by``.
    """
    words = texts.select(*by, F.explode(F.split(text, GAPS)).alias("word")).filter("word <> ''")
    terms = words.groupBy(*by, F.xxhash64("word").alias("term")).agg(F.count("*").alias("n"))
    terms = terms.select(*by, "term", F.ln("n").alias("log"))
    draws = min(DRAWS, samples)
    starts = F.array(*[F.lit(k).cast("long") for k in range(0, samples, draws)])
    terms = terms.select(*by, "log", "term", F.explode(starts).alias("first"))
    bits, out = keys(F.col("term"), F.col("first"), F.col("log"), draws)
    plain = {k: v for k, v in bits.items() if k[0] in "gh"}
    terms = terms.select(*by, "first", "log", *[v.alias(k) for k, v in plain.items()])
    terms = terms.select(*by, "first", "log", *[F.col(k) for k in plain], *[v.alias(k) for k, v in bits.items() if k not in plain])
    least = terms.groupBy(*by, "first").agg(*[F.min(e).alias(f"m{k}") for k, e in enumerate(out)])
    code = [F.lpad(F.hex(F.xxhash64(f"m{k}").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0") for k in range(draws)]
    least = least.select(*by, "first", F.lower(F.concat(*code)).alias("code"))
    codes = least.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("first", "code"))).alias("codes"))
    return codes.select(*by, F.array_join(F.transform("codes", lambda c: c["code"]), "").alias("fingerprint"))


def empty_fingerprint(samples: int = SAMPLES) -> str:
    return "0" * (8 * samples)


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of draws with equal samples; two texts without words are alike."""
    same = [(F.substring(a, 8 * k + 1, 8) == F.substring(b, 8 * k + 1, 8)).cast("int") for k in range(samples)]
    return sum(same[1:], same[0]) / float(samples)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(id, fingerprint) for each id; texts of a repeated id are taken together; no words: all zeros."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    found = signatures(rows, ["id"], "text", samples).withColumnRenamed("id", "_id")
    ids = rows.select("id").distinct()
    return ids.join(found, F.col("id").eqNullSafe(F.col("_id")), "left").select("id", F.coalesce("fingerprint", F.lit(empty_fingerprint(samples))).alias("fingerprint"))


def in_ranges(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(slot, part, id, text, tie, row) as a table: rows in descending order of id, dealt into ranges ``part`` of about
    equal numbers of rows. Of equal ids the text's hash decides and then the place in the input, so that repeated and
    null ids and repeated rows are split like any others. Each range has a bucket of its own, that of ``slot``."""
    spark = docs.sparkSession
    n = RANGES * shuffle_partitions(spark)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"))
    dealt = rows.repartitionByRange(n, *down()).withColumn("part", F.spark_partition_id())
    slot = F.element_at(F.array(*[F.lit(x).cast("long") for x in bucket_labels(spark, n)]), F.col("part") + 1)
    return bucketed(dealt.select(slot.alias("slot"), "part", "id", "text", "tie", "row"), "slot", n)


def down() -> list[Column]:
    return [F.col("id").desc_nulls_last(), F.col("tie").desc(), F.col("row")]


def heads(rows: DataFrame, value: str) -> DataFrame:
    """(_slot, head): for each range the ``value`` of the row after its last one, which is the next range's first one
    (after the last range: the first range's). ``rows`` has slot, part and at; one row for each range stays."""
    first = rows.filter("at = 1").select("slot", "part", F.col(value).alias("head"))
    follow = Window.orderBy("part")  # over the ranges only
    around = follow.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("head").over(follow), F.first("head").over(around))
    return first.select(F.col("slot").alias("_slot"), after.alias("head"))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """For each row its fingerprint, that of its edited text, and the likeness to it and to the next row.

    Rows stand in descending order of id (null ids last, equal ids by the text's hash); after the last comes the
    first. The edited text has the last third of its code points replaced by as many of the next row's first ones. A
    null text counts as empty. Repeated rows are rows of their own. An empty table gives no rows. Neighbours come from
    windows over ranges of rows, and the row after a range from a small table, so nothing passes through one task;
    texts are shuffled once. The result reads a table in the shared folder.
    """
    rows = in_ranges(docs, id_col, text_col)
    order = Window.partitionBy("slot").orderBy(*down())
    placed = rows.select("slot", "part", "id", "text", F.row_number().over(order).alias("at"), F.lead("text").over(order).alias("lead"))
    next_text = materialise(heads(placed, "text"))
    joined = placed.join(next_text, (F.col("slot") == F.col("_slot")) & F.col("lead").isNull(), "left")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.left("text", n - third), F.left(F.coalesce("lead", "head"), third))
    texts = joined.select("slot", "part", "at", "id", "text", edited.alias("edited"))
    about = texts.select("slot", "part", "at", "id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    both = texts.select("slot", "at", F.explode(F.array(F.struct(F.lit(0).alias("of"), "text"), F.struct(F.lit(1).alias("of"), F.col("edited").alias("text")))).alias("t"))
    prints = signatures(both.select("slot", "at", "t.of", "t.text"), ["slot", "at", "of"], "text", samples)
    blank = F.lit(empty_fingerprint(samples))
    told = prints.groupBy("slot", "at").agg(F.max(F.when(F.col("of") == 0, F.col("fingerprint"))).alias("fingerprint"), F.max(F.when(F.col("of") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    done = about.join(told, ["slot", "at"], "left").withColumns({c: F.coalesce(c, blank) for c in ("fingerprint", "edited_fingerprint")})
    done = materialise(done)
    forget(rows, next_text)
    near = done.withColumn("lead", F.lead("fingerprint").over(Window.partitionBy("slot").orderBy("at")))
    near = near.join(heads(done, "fingerprint"), (F.col("slot") == F.col("_slot")) & F.col("lead").isNull(), "left")
    return near.select(
        "id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("lead", "head"), samples).alias("near_next"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return compare_edits(docs).withColumnRenamed("id", "doc_id")
