"""The scan of sitemaps as a stream against ``scan_slice``."""

import json

import pytest
from pyspark.sql import functions as F

from catalog_spark.operators import discovery, state
from catalog_spark.sources import manifests
from catalog_spark.streaming import scan

SIZES = {0: 7, 1: 1, 2: 30, 3: 12, 5: 4}  # 4 is not there


@pytest.fixture()
def located(spark):
    rows = [(i, j, f"u{(i * 31 + j * 7) % 40}") for i, n in SIZES.items() for j in range(n)]
    return spark.createDataFrame(rows, "sitemap_index int, url_index int, url string")


def found(spark, root):
    return sorted(tuple(r) for r in scan.read_found(spark, root).collect())


def test_triggers_equal_scan_slices(spark, located, tmp_path):
    folder, root, point = str(tmp_path / "maps"), str(tmp_path / "out"), str(tmp_path / "point")
    assert scan.add_sitemaps(located, folder, slice_rows=8) == 5 and scan.add_sitemaps(located, folder, slice_rows=8) == 0
    known = spark.createDataFrame([("u3",), ("u17",), (None,)], "url string")
    place, want = (0, 3), []
    for most in (4, 1, 9, 100, 100):
        scan.start_scan(spark, folder, root, point, lambda s: known, ["url"], "maps", (0, 3), most, once=True).awaitTermination()
        already = known.unionByName(spark.createDataFrame([(u,) for _, _, u in want], "url string"))
        picked, after = discovery.scan_slice(located, already, ["url"], place, most, 10**6, unavailable_from=4)
        want += [tuple(r) for r in picked.select("sitemap_index", "url_index", "url").collect()]
        place = tuple(after.first())
        assert found(spark, root) == sorted(want)
        assert state.latest_checkpoint(state.read_checkpoints(spark, root), "maps") == place
    assert place == (3, 12)
    scan.add_sitemaps(located.filter("sitemap_index = 5").withColumn("sitemap_index", F.lit(4)), folder)  # it can be had again
    scan.start_scan(spark, folder, root, point, lambda s: known, ["url"], "maps", (0, 3), 100, once=True).awaitTermination()
    assert state.latest_checkpoint(state.read_checkpoints(spark, root), "maps") == (5, 4)


def test_a_batch_that_failed_runs_again_as_it_was(spark, located, tmp_path):
    folder, root, point = str(tmp_path / "maps"), str(tmp_path / "out"), str(tmp_path / "point")
    scan.add_sitemaps(located, folder)

    def broken(s):
        raise RuntimeError("cannot read what is known")

    with pytest.raises(Exception, match="cannot read what is known"):
        scan.start_scan(spark, folder, root, point, broken, ["url"], "maps", max_scan=10, once=True).awaitTermination()
    assert found(spark, root) == [] and json.loads((tmp_path / "point/place.json").read_text()) == [2, 2]
    nothing = spark.createDataFrame([], "url string")
    for most in (25, 10):  # the batch that was planned with ten URLs comes first, whatever is admitted now
        scan.start_scan(spark, folder, root, point, lambda s: nothing, ["url"], "maps", max_scan=most, once=True).awaitTermination()
    points = [tuple(r) for r in state.read_checkpoints(spark, root).select("sitemap_index", "url_index").collect()]
    assert sorted(points) == [(2, 2), (2, 12)]
    rows = found(spark, root)
    assert len({u for _, _, u in rows}) == len(rows) and [m["id"] for m in manifests.commits(spark, root)] == [f"maps-{k}" for k in range(len(points))]


def test_an_empty_folder_gives_no_batch(spark, tmp_path):
    root = str(tmp_path / "out")
    nothing = spark.createDataFrame([], "url string")
    scan.start_scan(spark, str(tmp_path / "maps"), root, str(tmp_path / "point"), lambda s: nothing, ["url"], "maps", once=True).awaitTermination()
    assert found(spark, root) == [] and state.latest_checkpoint(state.read_checkpoints(spark, root), "maps") == (0, 0)
