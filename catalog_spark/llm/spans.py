"""Helpers for spans of code points: their Spark type, digests and masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:long,end:long>"


def listing(spans: Column) -> Column:
    """kind:start:end, comma-joined in the array's order."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def ordered(spans: Column, kinds: tuple[str, ...], by_start: bool) -> Column:
    """Sorted by place of the kind in ``kinds`` and start, or by start and place."""
    place = lambda s: F.array_position(F.array(*map(F.lit, kinds)), s["kind"])

    def keyed(s):
        keys = (s["start"], place(s)) if by_start else (place(s), s["start"])
        return F.struct(keys[0].alias("a"), keys[1].alias("b"), s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    bare = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    return F.transform(F.array_sort(F.transform(spans, keyed)), bare)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Replace spans by their marks; of overlapping spans, the one that starts first (then the longest) is replaced
    and the others' remainders are covered with it."""
    out, at = [], 0
    for start, end, mark in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
