"""URL verdicts by rules, carried to aliases over redirect and canonical-link edges.

Every URL has a canonical form, in which only spellings of one address agree: no fragment, scheme and host in lower case,
no default port, and a path of ``/`` at least. That link, a page's ``<link rel=canonical>`` and its ``<meta http-equiv=refresh>``
are alias edges. With ``guesses`` the form also drops the scheme, tracking parameters, ``www.`` before a name of two parts,
a trailing slash and ``.html``: conventions of many sites, which prove nothing about one, so they are no default. The
connected components of all edges are sets of aliases. A page that a rule fits has the rule's verdict. Any other
page takes its component's: allowed if a member is explicitly allowed, else blocked if one is blocked, else allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import forget, materialise

#: (verdict, rule): host, then path from its first slash.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
QUERY = r"(?s)^.*?://[^?#]*\?([^#]*)"
SCHEME = r"(?s)^(.*?)://"
ASKED = r"(?s)^.*?://[^?#]*(\?[^#]*)"
PORTS = {"http": ":80$", "https": ":443$"}
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$"
WWW = r"^www\.([^.]+\..+)$"
TAIL = r"(/+|/index\.html?|\.html?)$"
CANONICAL = r"(?is)<link\b[^<>]*\brel\s*=\s*[\"']?canonical\b[^<>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s<>]+)"
REFRESH = r"(?is)<meta\b[^<>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^<>]*>"
GOAL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s<>;]+)"


def _part(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(_part(url, HOST), UPPER, LOWER)


def path(url: Column) -> Column:
    return _part(url, PATH)


def scheme(url: Column) -> Column:
    return F.translate(_part(url, SCHEME), UPPER, LOWER)


def canonical(url: Column, guesses: bool = False) -> Column:
    """One spelling of an absolute URL's address; with ``guesses`` host, trimmed path and remaining parameters in order."""
    if not guesses:
        name = host(url)
        for known, port in PORTS.items():
            name = F.when(scheme(url) == known, F.regexp_replace(host(url), port, "")).otherwise(name)
        return F.concat(scheme(url), F.lit("://"), name, F.when(path(url) == "", F.lit("/")).otherwise(path(url)), _part(url, ASKED))
    kept = F.filter(F.split(_part(url, QUERY), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise(F.lit(""))
    return F.concat(F.regexp_replace(host(url), WWW, "$1"), F.regexp_replace(path(url), TAIL, ""), tail)


def resolved(link: Column, url: Column) -> Column:
    """A link's absolute form as seen from ``url``; null if there is none."""
    root = F.concat(scheme(url), F.lit("://"), host(url))
    folder = F.regexp_replace(path(url), "[^/]*$", "")
    return (
        F.when(link.isNull() | (link == "") | (host(url) == ""), F.lit(None).cast("string"))
        .when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(scheme(url), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


def rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits. ``rules`` is a short list of settings."""
    which = verdict = None
    for v, r in sorted(rules, key=lambda x: (-len(x[1]), x[1])):
        rh, _, rp = r.partition("/")
        fits = ((host_ == rh) | host_.endswith("." + rh)) & path_.startswith("/" + rp)
        which = F.when(fits, F.lit(r)) if which is None else which.when(fits, F.lit(r))
        verdict = F.when(fits, F.lit(v)) if verdict is None else verdict.when(fits, F.lit(v))
    return which, verdict


def node(url: Column) -> Column:
    """A URL as a node; canonical forms start with another sign."""
    return F.concat(F.lit("u"), url)


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str | None = "html", guesses: bool = False) -> DataFrame:
    """(a, b): each URL with its canonical form, and canonical forms of pages with those of their link targets."""
    url = F.col(url_col)
    out = [pages.filter(host(url) != "").select(node(url).alias("a"), F.concat(F.lit("="), canonical(url, guesses)).alias("b"))]
    if html_col:
        html = F.col(html_col)
        for tag, goal in ((CANONICAL, HREF), (REFRESH, GOAL)):
            link = resolved(F.regexp_extract(F.regexp_extract(html, tag, 0), goal, 1), url)
            near = pages.select(url.alias("u"), link.alias("t")).filter("t IS NOT NULL")
            out.append(near.select(F.concat(F.lit("="), canonical(F.col("u"), guesses)).alias("a"), F.concat(F.lit("="), canonical(F.col("t"), guesses)).alias("b")))
    edges = out[0]
    for e in out[1:]:
        edges = edges.union(e)
    return edges


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html", rules=RULES, guesses: bool = False) -> DataFrame:
    """(id, host, path, rule, verdict, component) for each row.

    A null URL or one without ``://`` has empty host and path, no aliases and no component, and is allowed. Repeated
    rows give a row each with one verdict; rules of one length that both fit are taken by code point; null ids stay;
    an empty table gives no rows; other columns are dropped. The result is a table in the shared folder.
    """
    url = F.col(url_col)
    which, verdict = rule(F.col("host"), F.col("path"), rules)
    seen = pages.select(F.col(id_col).alias("id"), url.alias("url"), host(url).alias("host"), path(url).alias("path"))
    seen = materialise(seen.withColumn("rule", which).withColumn("told", verdict))
    roots = connected_components(alias_edges(pages, url_col, html_col, guesses), "a", "b")
    alias = seen.join(roots, node(seen.url) == roots.node, "left").drop("node").withColumnRenamed("root", "component")
    told = alias.filter("component IS NOT NULL").groupBy("component").agg(
        F.max((F.col("told") == "allow").cast("int")).alias("allowed"), F.max((F.col("told") == "block").cast("int")).alias("blocked")
    )
    out = alias.join(told, "component", "left")
    passed_on = F.when((F.col("allowed").isNull() | (F.col("allowed") == 0)) & (F.col("blocked") == 1), F.lit("block")).otherwise(F.lit("allow"))
    out = materialise(out.select("id", "host", "path", "rule", F.coalesce("told", passed_on).alias("verdict"), "component"))
    forget(seen, roots)
    return out


def digest(pages: DataFrame, guesses: bool = False) -> DataFrame:
    return judge(pages, guesses=guesses).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql() -> str:
    h = lambda u: f"translate(coalesce(regexp_extract({u}, {_q(HOST)}, 1), ''), {_q(UPPER)}, {_q(LOWER)})"
    p = lambda u: f"coalesce(regexp_extract({u}, {_q(PATH)}, 1), '')"

    sch = lambda u: f"translate(coalesce(regexp_extract({u}, {_q(SCHEME)}, 1), ''), {_q(UPPER)}, {_q(LOWER)})"

    def canon(u: str) -> str:
        ports = " ".join(f"WHEN {_q(k)} THEN regexp_replace({h(u)}, {_q(port)}, '')" for k, port in PORTS.items())
        return f"{sch(u)} || '://' || CASE {sch(u)} {ports} ELSE {h(u)} END || CASE WHEN {p(u)} = '' THEN '/' ELSE {p(u)} END || coalesce(regexp_extract({u}, {_q(ASKED)}, 1), '')"

    def link(tag: str, goal: str) -> str:
        return f"regexp_extract(regexp_extract(html, {_q(tag)}, 0), {_q(goal)}, 1)"

    def target(t: str) -> str:
        folder = f"regexp_replace({p('url')}, '[^/]*$', '')"
        return (
            f"CASE WHEN {t} IS NULL OR {t} = '' OR {h('url')} = '' THEN NULL WHEN contains({t}, '://') THEN {t} WHEN starts_with({t}, '//') THEN {sch('url')} || ':' || {t} "
            f"WHEN starts_with({t}, '/') THEN {sch('url')} || '://' || {h('url')} || {t} ELSE {sch('url')} || '://' || {h('url')} || CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || {t} END"
        )

    cases = {"rule": "", "told": ""}
    for v, r in sorted(RULES, key=lambda x: (-len(x[1]), x[1])):
        rh, _, rp = r.partition("/")
        fits = f"(host = {_q(rh)} OR ends_with(host, {_q('.' + rh)})) AND starts_with(path, {_q('/' + rp)})"
        cases["rule"] += f" WHEN {fits} THEN {_q(r)}"
        cases["told"] += f" WHEN {fits} THEN {_q(v)}"
    return f"""
WITH RECURSIVE g AS (
  SELECT page_id, url, {h('url')} AS host, {p('url')} AS path FROM pages
), s AS (SELECT *, CASE{cases['rule']} END AS rule, CASE{cases['told']} END AS told FROM g
), t AS (
  SELECT url, {target(link(CANONICAL, HREF))} AS t FROM pages UNION ALL SELECT url, {target(link(REFRESH, GOAL))} FROM pages
), e AS (
  SELECT 'u' || url AS a, '=' || {canon('url')} AS b FROM s WHERE host <> ''
  UNION SELECT '=' || {canon('url')}, '=' || {canon('t')} FROM t WHERE t IS NOT NULL
), both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e
), reach AS (
  SELECT a AS x, a AS y FROM both_ways UNION SELECT reach.x, both_ways.b FROM reach JOIN both_ways ON reach.y = both_ways.a
), c AS (SELECT x, min(y) AS component FROM reach GROUP BY x
), m AS (
  SELECT component, max((told = 'allow')::INT) AS allowed, max((told = 'block')::INT) AS blocked FROM s JOIN c ON 'u' || s.url = c.x GROUP BY component
)
SELECT s.page_id, s.host, s.path, s.rule,
       coalesce(s.told, CASE WHEN coalesce(m.allowed, 0) = 0 AND m.blocked = 1 THEN 'block' ELSE 'allow' END) AS verdict
FROM s LEFT JOIN c ON 'u' || s.url = c.x LEFT JOIN m ON c.component = m.component
"""


SQL = _sql()
