"""WARC archives: pages written as captures, and captures put together again from any archives' records.

A capture is written as a response, or, where another page has the same payload, as a revisit that refers to that page's
response; with it go a request and a metadata record, both concurrent to it. ``write`` lets Spark's text writer do this:
a value holds a capture's records, and the line separator is the blank line that ends a record. So archives have the
writer's commit protocol, and any file system that Spark knows. Archives are compressed as a whole and have at most
``CAPTURES`` captures each, since a task reads one from its start.

``records`` reads them back by their Content-Length, whatever their payloads hold: text is split at each ``WARC/1.``,
and pieces are put together until a record has its length. ``captures`` joins request, response (or revisit) and
metadata records through their concurrent-to identifiers and gives a nested row for each capture.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .tables import forget, map_arrow, materialise, shared_dir, slices, spread_join

CAPTURES = 10_000
LEAST = 0  # bytes; shorter payloads are not told apart from others, each is a response
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
UNDATED = "1970-01-01T00:00:00Z"
MARK = "WARC/1."
PRIMARY = ("response", "revisit", "resource", "conversion")
END = "\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of a binary column's SHA-1. ``conv`` knows digits up to V and 64 bits, so three parts of
    whole letters are converted, and the digits are then spelled as letters."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, at, n), 16, 32), n * 4 // 5, "0") for at, n in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", ALPHABET)


def urn(*of: Column) -> Column:
    """A record identifier that follows from the values."""
    h = F.sha2(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in of)), 256)
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 14, 3)), F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(text: Column) -> Column:
    """Without control characters, which would end a header."""
    return F.regexp_replace(text, r"[\x00-\x1F\x7F]", "")


def _record(kind: Column, identifier: Column, block: Column, headers: list[tuple[str, Column]], size: Column | None = None) -> Column:
    """A record without the blank line after it; headers whose value is null are left out."""
    size = F.octet_length(block) if size is None else size
    listed = [("WARC-Type", kind), ("WARC-Record-ID", identifier), ("WARC-Date", F.lit(UNDATED)), *headers, ("Content-Length", size.cast("string"))]
    return F.concat(F.lit("WARC/1.1\r\n"), *(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in listed), F.lit("\r\n"), block)


def planned(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(id, url, payload, digest, size, role, response): what each page becomes; ``role`` is response or revisit and
    ``response`` the identifier of the response that it is or refers to.

    ``pages``: id, url, payload (binary). Of pages with equal payloads of ``least`` bytes or more, that with the largest
    id (null ids last), then url, is the response; of rows that are equal throughout, one. A payload that a large
    share of all rows has is joined by broadcast, a bounded number of them (``tables.spread_join``).
    """
    c = F.col
    rows = pages.withColumn("digest", base32_sha1(c("payload"))).withColumn("size", F.octet_length("payload").cast("long"))
    per_row = rows.filter(c("size") >= least).groupBy("digest", "id", "url").agg(F.count("*").alias("n"))
    best = per_row.groupBy("digest").agg(F.sum("n").alias("rows"), F.max(F.struct("id", "url", "n")).alias("best"))
    shared = materialise(best.filter("rows > 1"))
    joined = spread_join(rows, shared, "digest", "rows", pages.count)
    is_best = c("best").isNull() | (c("best.id").eqNullSafe(c("id")) & c("best.url").eqNullSafe(c("url")))
    one = F.when(c("size") >= least, urn(F.lit("response"), c("digest"))).otherwise(urn(F.lit("short"), c("digest"), c("id"), c("url"), F.monotonically_increasing_id()))
    plain = joined.select("id", "url", F.when(is_best, c("payload")).alias("payload"), "digest", "size", F.when(is_best, "response").otherwise("revisit").alias("role"), one.alias("response"), F.coalesce(c("best.n"), F.lit(1)).alias("n"))
    columns = ["id", "url", "payload", "digest", "size", "role", "response"]
    repeated = shared.filter("best.n > 1")
    if repeated.isEmpty():
        out = plain.select(columns)
    else:  # rows that are equal throughout: one response, and the others made from their number
        tied = (c("role") == "response") & (c("n") > 1)
        first = plain.filter(tied).dropDuplicates(["digest"])
        size = first.select(c("digest").alias("_digest"), "size")
        others = repeated.select("best.id", "best.url", "digest", F.explode(F.sequence(F.lit(2).cast("long"), c("best.n"))).alias("k")).join(size, c("digest") == c("_digest"))
        others = others.select("id", "url", F.lit(None).cast("binary").alias("payload"), "digest", "size", F.lit("revisit").alias("role"), urn(F.lit("response"), c("digest")).alias("response"))
        out = plain.filter(~tied).select(columns).union(first.select(columns)).union(others)
    out._shared = shared
    return out


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST) -> None:
    """Write each row of ``pages`` as a capture into archives (``*.gz``) under ``path``.

    A null payload is an empty one; strings are written in UTF-8, binary values as they are. A null url or id has no
    header; control characters in them are left out. Repeated rows are captures each; an empty table gives archives
    without records; other columns are ignored.
    """
    c = F.col
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    rows = planned(pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload")), least)
    uri = _line(c("url"))
    revisit = c("role") == "revisit"
    me = F.when(revisit, urn(F.lit("revisit"), c("digest"), c("id"), c("url"), F.monotonically_increasing_id())).otherwise(c("response"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), c("size").cast("string"), F.lit(END))
    block = F.concat(head, F.when(revisit, "").otherwise(c("payload").cast("string")))
    digest = F.concat(F.lit("sha1:"), c("digest"))
    kept = _record(c("role"), c("me"), block, [
        ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest), ("WARC-Profile", F.when(revisit, F.lit(PROFILE))), ("WARC-Refers-To", F.when(revisit, c("response"))),
        ("Content-Type", F.lit("application/http; msgtype=response"))], F.octet_length(head) + F.when(revisit, 0).otherwise(c("size")))
    target = F.coalesce(F.nullif(F.regexp_extract(uri, r"^[^:]*://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    asked = F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(F.regexp_extract(uri, r"^[^:]*://([^/?#]*)", 1), F.lit("")), F.lit(END))
    request = _record(F.lit("request"), urn(F.lit("request"), c("me")), asked, [("WARC-Target-URI", uri), ("WARC-Concurrent-To", c("me")), ("Content-Type", F.lit("application/http; msgtype=request"))])
    fields = F.coalesce(F.concat(F.lit("page-id: "), _line(c("id").cast("string")), F.lit("\r\n")), F.lit(""))
    metadata = _record(F.lit("metadata"), urn(F.lit("metadata"), c("me")), fields, [("WARC-Target-URI", uri), ("WARC-Concurrent-To", c("me")), ("Content-Type", F.lit("application/warc-fields"))])
    texts = rows.withColumn("me", me).select(F.concat_ws(END, request, kept, metadata).alias("value"))
    texts.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", CAPTURES).text(path)
    forget(rows._shared)


RECORD = pa.schema([
    ("file", pa.string()), ("place", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("headers", pa.map_(pa.string(), pa.string())),
    ("http", pa.string()), ("payload", pa.binary()), ("complete", pa.bool_())])
RECORD_DDL = "file string, place long, type string, record_id string, concurrent_to array<string>, headers map<string,string>, http string, payload binary, complete boolean"


class _Open:
    """A record that is being put together."""

    def __init__(self, start: bytes):
        self.data, self.body, self.size = bytearray(start), -1, 0
        self.headers: dict[str, str] = {}
        self.to: list[str] = []
        self._head(0)

    def _head(self, searched: int) -> None:
        end = self.data.find(b"\r\n\r\n", max(0, searched - 3))
        if end < 0:
            return
        for line in self.data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            name, value = name.strip().lower(), value.strip()
            if name == "warc-concurrent-to":
                self.to.append(value)
            self.headers.setdefault(name, value)
        length = self.headers.get("content-length", "")
        self.body, self.size = end + 4, int(length) if length.isascii() and length.isdigit() else 0

    def add(self, more: bytes) -> None:
        known = len(self.data)
        self.data += more
        if self.body < 0:
            self._head(known)

    @property
    def complete(self) -> bool:
        return 0 <= self.body and len(self.data) >= self.body + self.size

    def row(self, file: str, place: int) -> tuple:
        body = max(self.body, 0)
        block = bytes(self.data[body : body + self.size]) if self.body >= 0 else b""
        http = None
        if self.headers.get("content-type", "").startswith("application/http"):
            head, _, block = block.partition(b"\r\n\r\n")
            http = head.decode("latin-1")
        return file, place, self.headers.get("warc-type"), self.headers.get("warc-record-id"), self.to, list(self.headers.items()), http, block, self.complete


def _stitch(batches) -> Iterator[pa.RecordBatch]:
    """Pieces (value, file, start, length, size) of archives in order: their records."""
    file, opened, place, out, held = None, None, 0, [], 0

    def flush() -> pa.RecordBatch:
        rows = list(zip(*out)) or [()] * len(RECORD)
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, RECORD)], schema=RECORD)

    def close() -> None:
        nonlocal place, opened, held
        if opened is not None:
            row = opened.row(file, place)
            out.append(row)
            held += len(row[7])
            place, opened = place + 1, None

    for b in batches:
        for some, values in slices(b, b.column(0)):
            for value, name, start, length, size in zip(values, *(some.column(k).to_pylist() for k in range(1, 5))):
                if name != file:
                    close()
                    if start or length < size:
                        raise ValueError(f"{name} is read in several parts; compress archives with gzip")
                    file, place = name, 0
                    continue  # what stands before the first record
                if opened is not None and not opened.complete:
                    opened.add(MARK.encode() + value)
                else:
                    close()
                    opened = _Open(MARK.encode() + value)
                if held > 1 << 20:
                    yield flush()
                    out, held = [], 0
    close()
    if out:
        yield flush()


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the gzip-compressed archives under ``path``: its place in its file, type, identifiers, headers
    (by lower-case name; of repeated ones the first), the HTTP head (null for other blocks) and payload.

    Records are taken by Content-Length (missing: 0), so payloads may hold anything, archives included. A record that
    its file cuts short has ``complete`` false. Transfer encodings are left as they are.
    """
    lines = spark.read.option("lineSep", MARK).text(path)
    m = "_metadata"
    pieces = lines.select(F.col("value").cast("binary").alias("value"), f"{m}.file_path", f"{m}.file_block_start", f"{m}.file_block_length", f"{m}.file_size")
    return map_arrow(pieces, _stitch, RECORD_DDL)


def owners(found: DataFrame) -> DataFrame:
    """(member, owner): the response-like record that each other record belongs to, through concurrent-to identifiers.

    A record that names such a record belongs to it. Others are linked through records between them, in whichever
    direction, as connected components; if one has several response-like records, they go to the least identifier.
    """
    c = F.col
    links = found.select(c("record_id").alias("a"), (c("type").isin(*PRIMARY)).alias("main"), F.explode("concurrent_to").alias("b")).filter("a IS NOT NULL AND a <> b").distinct()
    mains = found.filter(c("type").isin(*PRIMARY)).select(c("record_id").alias("main_id")).distinct()
    marked = materialise(links.join(mains, c("b") == c("main_id"), "left"))
    direct = marked.filter("NOT main AND main_id IS NOT NULL").groupBy("a").agg(F.min("b").alias("owner")).select(c("a").alias("member"), "owner")
    rest = marked.filter("main OR main_id IS NULL")
    if rest.isEmpty():
        return direct
    parts = connected_components(marked, "a", "b")
    heads = parts.join(mains, c("node") == c("main_id")).groupBy("root").agg(F.min("node").alias("owner"))
    chained = parts.join(heads, "root").select(c("node").alias("member"), "owner")
    chained = chained.join(mains, c("member") == c("main_id"), "left_anti").join(direct.select(c("member").alias("_known")), c("member") == c("_known"), "left_anti")
    return direct.union(chained)


def captures(found: DataFrame, fields: tuple[str, ...] = ("headers", "http", "payload", "complete")) -> DataFrame:
    """A nested row for each capture: (record_id, response, request, metadata), with ``fields`` of each record.

    ``response`` is the response-like record, ``request`` the request (of several, that with the least identifier), and
    ``metadata`` an array of all other records of the capture. Records that belong to none are captures without a
    response, under their own identifier. Records with equal identifiers are captures each and share what belongs to
    them. An empty table gives no rows.
    """
    c = F.col
    whole = F.struct("type", "record_id", *fields)
    owner = owners(found)
    main = found.filter(c("type").isin(*PRIMARY)).select("record_id", whole.alias("response"))
    side = found.filter(~F.coalesce(c("type").isin(*PRIMARY), F.lit(False))).join(owner, c("record_id") == c("member"), "left")
    side = side.select(F.coalesce("owner", "record_id").alias("_of"), c("record_id").alias("_own"), c("type").alias("_type"), whole.alias("one"))
    request = F.min_by(F.when(c("_type") == "request", c("one")), F.when(c("_type") == "request", F.coalesce("_own", F.lit(""))))
    grouped = side.groupBy("_of").agg(request.alias("request"), F.filter(F.collect_list(F.when(c("_type").eqNullSafe("request"), None).otherwise(c("one"))), lambda x: x.isNotNull()).alias("metadata"))
    joined = main.join(grouped, c("record_id") == c("_of"), "full")
    return joined.select(F.coalesce("record_id", "_of").alias("record_id"), "response", "request", F.coalesce("metadata", F.array()).alias("metadata"))


def digest(pages: DataFrame) -> DataFrame:
    """The query's rows: pages written as archives, read back and put together. The result is a table in the shared folder."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    c = F.col
    measured = records(spark, path).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(c("payload"))})
    small = F.when(c("type") == "metadata", c("payload"))  # the others' payloads have been measured
    found = materialise(measured.select("type", "record_id", "concurrent_to", "headers", "http", small.alias("payload"), "payload_bytes", "payload_digest"))
    nested = captures(found, ("headers", "http", "payload", "payload_bytes", "payload_digest"))
    kind = pages.schema["page_id"].dataType.simpleString()
    page = F.regexp_extract(F.decode(c("metadata")[0]["payload"], "UTF-8"), r"page-id: ([^\r\n]*)", 1)
    full = c("response.type") == "response"
    told = F.regexp_extract("response.http", r"(?i)\ncontent-length: *([0-9]+)", 1).cast("long")
    rows = nested.select(
        F.nullif(page, F.lit("")).cast(kind).alias("page_id"), "record_id", F.when(full, c("response.payload_bytes")).otherwise(told).alias("payload_bytes"),
        F.when(full, c("response.payload_digest")).otherwise(F.regexp_replace(c("response.headers")["warc-payload-digest"], "^sha1:", "")).alias("payload_digest"),
        c("response.type").alias("record_type"), F.when(~full, c("response.headers")["warc-refers-to"]).alias("refers"))
    rows = materialise(rows)
    answers = rows.filter("record_type = 'response'").select(c("record_id").alias("refers"), c("page_id").alias("refers_to"))
    asked = rows.filter("refers IS NOT NULL").groupBy("refers").agg(F.count("*").alias("n"))
    answers = materialise(answers.join(asked, "refers"))
    out = spread_join(rows.drop("record_id"), answers, "refers", "n", rows.count)
    out = materialise(out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    archives = spark.range(0)
    archives._written_path = path
    forget(rows, answers, found, archives)
    return out


SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h FROM p),
e AS (
  SELECT page_id, payload_bytes, h, array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((((instr('0123456789abcdef', substr(h, 5 * j // 4 + 1, 1)) - 1) * 16 + greatest(0, instr('0123456789abcdef', substr(h, 5 * j // 4 + 2, 1)) - 1)) // [8, 4, 2, 1][5 * j % 4 + 1]) % 32), 1)), '') AS payload_digest,
    row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place, first_value(page_id) OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS newest
  FROM d
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN newest END AS refers_to FROM e
"""
