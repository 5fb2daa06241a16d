"""Sitemaps read as files against the parser of whole bodies."""

import gzip

import pytest

from catalog_spark.sources import sitemap_files, sitemaps

BODIES = {
    "plain": "<urlset>\n" + "".join(f"  <url><loc>https://e.com/{k}?a=1&amp;b={k}</loc><lastmod>2024</lastmod></url>\n" for k in range(200)) + "</urlset>\n",
    "names": '﻿ <?xml version="1.0"?><x:urlset xmlns:x="urn:x"><x:URL><x:LOC> https://e.com/ä </x:LOC></x:URL><x:url><x:Loc >\n https://e.com/2\n</x:Loc ></x:url></x:urlset>',
    "comments": "<u><!-- <loc>no</loc> --><loc>yes</loc><!-- a > b <loc>no</loc> --><loc>also</loc><!----></u>",
    "data": "<u><loc><![CDATA[https://e.com/?a=1&b=2]]></loc><x><![CDATA[other]]></x><loc>next</loc></u>",
    "entities": "<u><loc>&#104;ttp&#x3A;//e.com/&lt;&quot;</loc></u>",
    "blank": "<u><loc> </loc><loc/><loc></loc><loc>one</loc></u>",
    "cut": "<urlset><url><loc>https://e.com/1</loc></url><url><loc>https://e.com/2</l",
    "bare": "<u><loc>a&b</loc><loc>c</loc></u>",
    "empty": "",
    "none": "<u></u>",
    "twins": "<u><location>no</location><loc>same</loc><loc>same</loc></u>",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("maps")
    for name, body in BODIES.items():
        (out / name).write_bytes(body.encode())
        (out / f"{name}.gz").write_bytes(gzip.compress(body.encode()))
    return str(out)


@pytest.mark.parametrize("split", ["128m", "97b"])
def test_files_give_what_bodies_give(spark, folder, split):
    bodies = spark.createDataFrame(list(BODIES.items()), "sitemap_index string, body string")
    want = {}
    for r in sitemaps.sitemap_locs(bodies).orderBy("url_index").collect():
        want.setdefault(r["sitemap_index"], []).append(r["url"])
    assert len(want["plain"]) == 200 and want["comments"] == ["yes", "also"] and "cut" not in want and "bare" not in want
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, split)
    try:
        files, found = sitemap_files.read_files(spark, folder)
        got = {}
        for r in found.orderBy("url_index").collect():
            got.setdefault(r["sitemap"], []).append((r["url_index"], r["url"]))
        broken = {r["sitemap"] for r in files.filter("broken").collect()}
        if split != "128m":
            assert sitemap_files.records(spark, folder).rdd.getNumPartitions() > 100
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name in BODIES:
        for file in (name, f"{name}.gz"):
            assert [u for _, u in got.get(file, [])] == want.get(name, []), file
            assert [k for k, _ in got.get(file, [])] == list(range(len(want.get(name, []))))
    assert broken == {"cut", "cut.gz", "bare", "bare.gz"}


def test_indexes_are_followed(spark, tmp_path):
    index = lambda *urls: "<sitemapindex>" + "".join(f"<sitemap><loc>{u}</loc></sitemap>" for u in urls) + "</sitemapindex>"
    said = {"top": index("m/a", "m/more", "m/gone", "m/cut"), "more": index("m/b", "m/a", "m/top"), "a": BODIES["twins"], "b": BODIES["data"], "c": BODIES["plain"], "cut": BODIES["cut"]}
    for name, body in said.items():
        (tmp_path / f"{name}.xml.gz").write_bytes(gzip.compress(body.encode()))
    captured = spark.createDataFrame([(f"m/{n}", f"{n}.xml.gz") for n in said], "url string, sitemap string")
    found, missing = sitemap_files.walk(spark, str(tmp_path), captured, ["m/top"])
    assert sorted(tuple(r) for r in found.collect()) == [("a.xml.gz", 0, "same"), ("a.xml.gz", 1, "same"), ("b.xml.gz", 0, "https://e.com/?a=1&b=2"), ("b.xml.gz", 1, "next")]
    assert sorted(tuple(r) for r in missing.collect()) == [("m/cut", "broken"), ("m/gone", "not captured")]
    assert sitemap_files.walk(spark, str(tmp_path), captured, [])[0].count() == 0
    assert sitemap_files.walk(spark, str(tmp_path), captured, ["m/c", "m/c"])[0].count() == 200
