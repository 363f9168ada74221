"""Tables in the order of their keys: pages, merges, snapshots."""

import random

import pytest

from marketloom.operators import catalog, changes
from marketloom.sources import ordered

FILE = "venue string, path string, date string, size long, etag string, modified string, existence string, downloaded_at string"


def file(path, size=1, venue="v"):
    return (venue, path, "20240101", size, "e", "m", "confirmed", "d")


def test_a_page_opens_as_many_files_however_large_the_table(spark, tmp_path):
    opened = []
    for n in (1000, 8000):
        root = str(tmp_path / str(n))
        keys = spark.createDataFrame([(f"a/{i:06}", i) for i in range(n)] + [(f"b/{i:06}", i) for i in range(n)], "key string, size long")
        ordered.build(keys, root, ["key"], range_rows=100)
        rows = ordered.read_from(spark, root, "key", "a/", "a/000500", 151)
        page = catalog.list_page(rows, "a/", "a/000500", 150).collect()
        assert [r.key for r in page] == [f"a/{i:06}" for i in range(501, 651)] and all(r.more for r in page)
        opened.append(len(rows.inputFiles()))
        plan = catalog.list_page(rows, "a/", "a/000500", 150)._jdf.queryExecution().toString()
        assert "StringStartsWith(key,a/)" in plan and "GreaterThan(key,a/000500)" in plan
    assert max(opened) <= 5, opened


@pytest.mark.parametrize("prefix, after, most", [("", "", 5000), ("a/", "", 7), ("a/", "a/9", 7), ("b/", "a/", 30), ("b/x", "", 3), ("c", "", 3), ("a/0001", "a/00015", 400)])
def test_pages_at_the_edges(spark, tmp_path, prefix, after, most):
    rng = random.Random(3)
    keys = sorted({f"{rng.choice('ab')}/{rng.randrange(3000):06}" for _ in range(900)})
    root = str(tmp_path / "k")
    ordered.build(spark.createDataFrame([(k, 1) for k in keys], "key string, size long"), root, ["key"], range_rows=20)
    want = [k for k in keys if k.startswith(prefix) and k > after]
    page = catalog.list_page(ordered.read_from(spark, root, "key", prefix, after, most + 1), prefix, after, most).collect()
    assert [r.key for r in page] == want[:most] and {r.more for r in page} <= {len(want) > most}


def test_empty_table(spark, tmp_path):
    root = str(tmp_path / "none")
    ordered.build(spark.createDataFrame([], FILE), root, changes.KEY)
    assert ordered.read_all(spark, root).count() == 0
    ordered.merge(spark, root, changes.KEY, spark.createDataFrame([file("a")], FILE), changes.merge_listing)
    assert [r.path for r in ordered.read_all(spark, root).collect()] == ["a"]


def test_merges_touch_their_ranges_only(spark, tmp_path):
    """Pages one after the other: the table is what whole merges make of it, ranges that a page does not reach stay the files they were."""
    root, rng = str(tmp_path / "c"), random.Random(1)
    whole = spark.createDataFrame([file(f"p{i:05}", i) for i in range(0, 6000, 2)] + [file(f"p{i:05}", i, "w") for i in range(300)], FILE)
    ordered.build(whole, root, changes.KEY, range_rows=100)
    first = set(ordered.current(spark, root)[1].select("path").toPandas()["path"])
    pages = [[file(f"p{i:05}", rng.randrange(3)) for i in range(1000, 1400)], [file(f"p{i:05}", i) for i in range(5990, 6100)], [file("a"), file("zz", venue="w")], [file("p00001", venue="u")], [file(f"p{i:05}", 5) for i in range(1100, 1200)]]
    for k, rows in enumerate(pages):
        page = spark.createDataFrame(rows, FILE)
        done = ordered.merge(spark, root, changes.KEY, page, changes.merge_listing, range_rows=100)
        whole = spark.createDataFrame(changes.merge_listing(whole, page).drop("action").collect(), whole.schema)
        assert sorted(map(tuple, ordered.read_all(spark, root).select(*whole.columns).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
        assert done["snapshot"] == k + 1 and (done["touched"] <= 4 or k == 2)
    index = ordered.current(spark, root)[1]
    assert len(first & set(index.select("path").toPandas()["path"])) >= 24
    bounds = sorted((tuple(r.low), tuple(r.high)) for r in index.collect())
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    assert spark.read.parquet(f"{root}/index/snapshot=0").count() == len(first)  # a reader of an earlier snapshot still has it


def test_small_ranges_share_tasks(spark, tmp_path):
    """A hundred ranges of ten rows are written by one task, in the order of the key, and none has more rows than asked for."""
    import glob

    rows = spark.range(1000).selectExpr("printf('%04d', (id * 7) % 1000) AS key", "id AS size").repartition(3)
    ordered.build(rows, str(tmp_path / "t"), ["key"], range_rows=10)
    files = glob.glob(f"{tmp_path}/t/data/0/range=*/*.parquet")
    assert len(files) == 100 and {f.rsplit("/", 1)[1][:10] for f in files} == {"part-00000"}
    _, index = ordered.current(spark, str(tmp_path / "t"))
    held = sorted((r.low.key, r.high.key, r.rows) for r in index.collect())
    assert held == [(f"{i:04d}", f"{i + 9:04d}", 10) for i in range(0, 1000, 10)]
    assert [r.size for r in ordered.read_all(spark, str(tmp_path / "t")).orderBy("key").collect()] == [r.size for r in rows.orderBy("key").collect()]
