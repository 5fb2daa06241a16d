"""Hash columns and their inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def h64(text: Column) -> Column:
    """The first eight bytes of SHA-256, little-endian, as an unsigned number. The digest is named once, so that Spark,
    which puts a text's expression in each place that names it, plans and compiles it once."""
    digest = F.left(F.sha2(text.cast("binary"), 256), F.lit(16))
    turned = F.regexp_replace(digest, "(..)" * 8, "".join(f"${i}" for i in range(8, 0, -1)))
    return F.conv(turned, 16, 10).cast("decimal(20,0)")


def json_number(x: Column) -> Column:
    """A double as JSON prints it: whole values without a point."""
    whole = (x == F.floor(x)) & (F.abs(x) < 1e15)
    plain = F.rtrim(F.format_string("%.17f", x), F.lit("0"))
    return F.when(x.isNull(), F.lit("null")).when(whole, x.cast("decimal(38,0)").cast("string")).otherwise(F.when(F.abs(x) < 1e-3, plain).otherwise(x.cast("string")))


def json_text(x: Column) -> Column:
    """A JSON string with <, > and & escaped; null for null."""
    inner = F.substring(F.rtrim(F.to_json(F.struct(x.alias("x"))), F.lit("}")), 6, 2_000_000_000)  # before the brace stands a quote
    for char, code in (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026")):
        inner = F.replace(inner, F.lit(char), F.lit(code))
    return F.when(x.isNull(), F.lit("null")).otherwise(inner)


def json_whole(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("null"))


def json_sig(*parts: Column) -> Column:
    """A JSON array of parts already in JSON form."""
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def source_hash(*texts: Column) -> Column:
    return h64(F.concat_ws("\u001f", *[F.coalesce(t.cast("string"), F.lit("")) for t in texts]))


def uuid7(ts: Column) -> Column:
    """A version 7 identifier: 48 bits of milliseconds, the rest random. Not deterministic."""
    ms = F.lower(F.lpad(F.hex(F.unix_millis(ts)), 12, "0"))
    rest = F.expr("uuid()")  # version 4: its variant digit is right already
    return F.concat(F.left(ms, F.lit(8)), F.lit("-"), F.substring(ms, 9, 4), F.lit("-7"), F.substring(rest, 16, 3), F.lit("-"), F.substring(rest, 20, 17))


def keyed_hash(key: str, *texts: Column) -> Column:
    """SHA-256 of texts (null: empty) under a secret key, nested so that nothing can be appended, in hexadecimal digits."""
    inner = F.sha2(F.concat_ws("\u001f", F.lit(key), *[F.coalesce(t.cast("string"), F.lit("")) for t in texts]), 256)
    return F.sha2(F.concat(F.lit(key), inner), 256)


def uuid7_of(ts: Column, digest: Column) -> Column:
    """A version 7 identifier: 48 bits of milliseconds, the rest from the digits of a digest. The same in every run."""
    ms = F.lower(F.lpad(F.hex(F.unix_millis(ts)), 12, "0"))
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(digest, 4, 1), 16, 10).cast("int") + 1, F.lit(1))
    return F.concat(F.left(ms, F.lit(8)), F.lit("-"), F.substring(ms, 9, 4), F.lit("-7"), F.substring(digest, 1, 3), F.lit("-"), variant, F.substring(digest, 5, 3), F.lit("-"), F.substring(digest, 8, 12))
