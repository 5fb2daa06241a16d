"""State embedded in captured HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where pages hold their state.
STATE_PATTERNS = (
    r"""(?s)<script[^>]+id=["']__NEXT_DATA__["'][^>]*>(.*?)</script>""",
    r"""(?s)window\.__NEXT_DATA__\s*=\s*(\{.*?\})\s*;</script>""",
)
QUERIES = "$.props.pageProps.dehydratedState.queries"


def embedded_state(html: Column, patterns: tuple[str, ...] = STATE_PATTERNS) -> Column:
    """The first pattern's match that is a JSON object, as VARIANT; null if there is none."""
    parsed = [F.try_parse_json(F.trim(F.regexp_extract(html, p, 1))) for p in patterns]
    return F.coalesce(*[F.when(F.schema_of_variant(v).startswith("OBJECT"), v) for v in parsed])


def page_queries(pages: DataFrame, state: str = "state") -> DataFrame:
    """Each cached query of a page: pos, query_key (JSON) and payload; payloads that are no objects are dropped."""
    kept = [c for c in pages.columns if c != state]
    found = pages.select(*kept, F.posexplode(F.try_variant_get(state, QUERIES, "array<variant>")).alias("pos", "q"))
    payload = F.try_variant_get("q", "$.state.data", "variant")
    key = F.coalesce(F.to_json(F.try_variant_get("q", "$.queryKey", "variant")), F.lit("null"))
    out = found.select(*kept, "pos", key.alias("query_key"), payload.alias("payload"))
    return out.filter(F.schema_of_variant("payload").startswith("OBJECT"))
