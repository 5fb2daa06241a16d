"""Permissive coercion of VARIANT paths: wrong or missing kinds give defaults, never errors.

``leaves`` reads a document once and hands on the small values at its paths; the coercions then look at these.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUE_WORDS = ("1", "true", "yes", "y", "on")


def at(v: Column, path: str) -> Column:
    """The VARIANT at a path; null where there is none."""
    return F.try_variant_get(v, path, "variant")


def _kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(at(v, path))


def text_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def as_string(v: Column, path: str = "$") -> Column:
    return F.coalesce(text_at(v, path), F.lit(""))


def int_of(text: Column) -> Column:
    """Whole number in a text, truncated; 0 where there is none."""
    x = F.trim(text)
    return F.coalesce(x.try_cast("bigint"), x.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def as_int(v: Column, path: str = "$") -> Column:
    """Numbers and numeric strings truncate, booleans are 0 or 1, all else is 0."""
    fraction = text_at(v, path).try_cast("double").try_cast("bigint")  # of a string, which is no whole number
    return F.coalesce(F.try_variant_get(v, path, "bigint"), fraction, F.lit(0).cast("bigint"))


def as_float(v: Column, path: str = "$") -> Column:
    return F.coalesce(F.try_variant_get(v, path, "double"), F.lit(0.0))


def flag_of(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin(*TRUE_WORDS), F.lit(False))


def to_u8(v: Column, path: str = "$") -> Column:
    """1 for true and for strings that say so, else 0; a JSON number is no flag and gives 0."""
    said = flag_of(text_at(v, path))  # a number's text may say so, too
    return (said & _kind(v, path).isin("BOOLEAN", "STRING")).cast("int")


def clamp_percent(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0)), F.lit(100)).cast("int")


def nullable_str(text: Column) -> Column:
    said = F.trim(text)
    return F.when(said != "", said)  # not nullif, whose operand becomes a column below for each place that names it


def nullable_int(v: Column, path: str = "$") -> Column:
    return F.when(nullable_str(text_at(v, path)).isNotNull(), as_int(v, path))


def first_non_empty(*texts: Column) -> Column:
    """The first text that is not blank, as it stands; else empty."""
    return F.coalesce(*[F.when(F.trim(t) != "", t) for t in texts], F.lit(""))


def first_non_zero(*texts: Column) -> Column:
    """The first text that is not null, blank or 0."""
    return F.coalesce(*[F.when((F.trim(t) != "") & ~F.coalesce(F.trim(t).try_cast("double") == 0, F.lit(False)), t) for t in texts])


def first_positive(*numbers: Column) -> Column:
    return F.coalesce(*[F.when(n > 0, n) for n in numbers], F.lit(0).cast("bigint"))


def string_array(v: Column, path: str = "$") -> Column:
    """Elements as strings, blanks dropped; a comma-separated string is split; all else is empty."""
    items = F.try_variant_get(v, path, "array<string>")  # what is null there is blank, and goes
    split = F.when(_kind(v, path) == "STRING", F.transform(F.split(text_at(v, path), ","), lambda x: F.trim(x)))
    return F.filter(F.coalesce(items, split, F.array().cast("array<string>")), lambda x: F.trim(x) != "")


BROKEN = "_broken"


def leaves(document: Column, paths: list[str]) -> Column:
    """A JSON document read once: a struct with a VARIANT for each dotted path, and null where there is none.

    Its field ``BROKEN`` holds the text of a document that is no JSON, or whose path leads through a value that is no
    object; ``is_json`` tells the two apart.
    """
    tree: dict = {}
    for path in paths:
        node = tree
        *above, last = path.split(".")
        for name in above:
            node = node.setdefault(name, {})
        node[last] = None

    def ddl(node: dict | None) -> str:
        return "variant" if node is None else "struct<" + ",".join(f"`{k}`:{ddl(v)}" for k, v in node.items()) + ">"

    return F.from_json(document, f"{ddl(tree)[7:-1]},`{BROKEN}`:string".replace("`:", "` "), {"columnNameOfCorruptRecord": BROKEN})


def is_json(document: Column, read: Column) -> Column:
    """Whether ``document``, of which ``read`` has the leaves, is JSON; it is parsed again only where that is in doubt."""
    return read.isNotNull() & F.coalesce(read[BROKEN].isNull() | F.try_parse_json(document).isNotNull(), F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
