"""Course URLs: locale and id in them, and making them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOST = "https://www.example.com"
ID_KEYS = ("cid", "courseId", "course_id")
# URL locale spellings.
LOCALES = {
    "ko": ("ko", "ko-kr", "kr"), "en": ("en", "en-us", "en-gb"), "ja": ("ja", "ja-jp"), "zh-Hans": ("zh-hans", "zh-cn", "zh-sg"),
    "zh-Hant": ("zh-hant", "zh-tw", "zh-hk"), "pt-BR": ("pt", "pt-br"),
    **{x: (x,) for x in ("es", "fr", "de", "ru", "id", "vi", "th", "ms", "fil", "hi", "ar", "it", "nl", "pl", "sv", "tr", "uk")},
}


def query_value(url: Column, key: str) -> Column:
    """The first value of a query parameter, decoded; empty where there is none."""
    first = F.regexp_extract(url, rf"^[^?#]*\?(?:[^#&]*&)*?{key}=([^&#]*)", 1)
    return F.coalesce(F.try_url_decode(first), F.lit(""))


def locale_name(text: Column) -> Column:
    """The locale of a spelling; null for an unknown one."""
    spelled = F.create_map(*[F.lit(x) for name, forms in LOCALES.items() for f in forms for x in (f, name)])
    return F.element_at(spelled, F.lower(F.trim(text)))


def locale_from_url(url: Column) -> Column:
    segment = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?/*([^/?#]*)", 1)
    return F.coalesce(locale_name(query_value(url, "locale")), locale_name(segment), F.lit("ko"))


def course_id_from_url(url: Column) -> Column:
    """The first of the id parameters that is a whole number, else 0."""
    found = [F.trim(query_value(url, k)) for k in ID_KEYS]
    return F.coalesce(*[F.when(v.rlike(r"^[+-]?\d+$"), v.try_cast("bigint")) for v in found], F.lit(0).cast("bigint"))


def path_escape(text: Column) -> Column:
    """Escape one path segment: blanks as %20, and $ & + = : @ ~ left as they are."""
    out = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    for code, char in (("%24", "$"), ("%26", "&"), ("%3A", ":"), ("%3D", "="), ("%40", "@"), ("%2B", "+"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return F.replace(out, F.lit("*"), F.lit("%2A"))


def ensure_query_id(url: Column, course_id: Column) -> Column:
    """Add ``cid`` if no id parameter has a value; then the query is written anew with its keys in order."""
    has = F.concat(*[query_value(url, k) for k in ID_KEYS]) != ""
    query, fragment = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), F.regexp_extract(url, r"(#.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("cid="))
    whole = F.transform(kept, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("="))))
    pairs = F.array_sort(F.array_append(whole, F.concat(F.lit("cid="), course_id.cast("string"))))
    added = F.concat(F.regexp_extract(url, r"^([^?#]*)", 1), F.lit("?"), F.array_join(pairs, "&"), fragment)
    return F.when((course_id <= 0) | has, url).otherwise(added)


def course_url(raw: Column, course_id: Column, slug: Column, host: str = HOST) -> Column:
    """An absolute URL as it is, a path on the host, else one made of slug and id; empty if neither is there."""
    u = F.trim(F.coalesce(raw, F.lit("")))
    s = F.regexp_replace(F.trim(F.coalesce(slug, F.lit(""))), "^/+|/+$", "")
    made = F.when((course_id <= 0) | (s == ""), F.lit("")).otherwise(F.concat(F.lit(f"{host}/course/"), path_escape(s), F.lit("?cid="), course_id.cast("string")))
    return F.when(u.startswith("http://") | u.startswith("https://"), ensure_query_id(u, course_id)).when(u.startswith("/"), ensure_query_id(F.concat(F.lit(host), u), course_id)).otherwise(made)


def search_url(page: Column, size: int = 100, sort: str = "RECENT", types: str = "ONLINE", host: str = HOST) -> Column:
    """The request of one page of the newest courses."""
    return F.concat(F.lit(f"{host}/client/api/v2/courses/search?isBot=false&pageNumber="), page.cast("string"), F.lit(f"&pageSize={size}&sort={sort}&types={types}"))
