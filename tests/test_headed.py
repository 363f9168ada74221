"""Headed tables in files, splits and archives."""

import gzip
import io
import random
import zipfile

import pytest

from marketloom.sources import scans


def cells(frame, *columns):
    return sorted(tuple("" if r[c] is None else r[c] for c in columns) for r in frame.collect())


def test_ragged_rows_quotes_and_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿Key,"Na me",x\r\n1,"a,b",2\r\n3,"line\nbreak",\r\n4\r\n5,f,6,7\r\n\r\n8,"say ""hi""",9\r\n')
    (tmp_path / "b.csv").write_bytes(b"x,key,x\n\xff,10,no\n")
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(b"NA ME,key\nz,11\n"))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "head.csv").write_text("key,x")
    (tmp_path / "long.csv").write_text("key\n12,13\n14,15\n")
    got = scans.scan_csv_named(spark, str(tmp_path), ["key", "Na Me", "x", "none"])
    assert cells(got, "key", "Na Me", "x", "none", "_overflow_") == sorted([
        ("1", "a,b", "2", "", ""), ("3", "line\nbreak", "", "", ""), ("4", "", "", "", ""), ("5", "f", "6", "", "7"), ("8", 'say "hi"', "9", "", ""), ("10", "", "�", "", ""), ("11", "z", "", "", ""), ("12", "", "", "", "13"), ("14", "", "", "", "15")])
    assert got.filter("key = '1'").first().filename.endswith("/a.csv")
    with pytest.raises(Exception, match="wider than declared"):
        scans.assert_width(got).collect()
    assert scans.scan_csv_named(spark, str(tmp_path / "empty.csv"), ["key"]).count() == 0


def test_a_thousand_files_of_five_headers(spark, tmp_path):
    names = ["key", "price", "size", "side", "note"]
    want = []
    for i in range(1000):
        order = names[i % 5 :] + names[: i % 5]
        rows = [{"key": f"{i}.{k}", "price": str(k), "size": str(i), "side": "b", "note": f"n{i}"} for k in range(i % 4)]
        (tmp_path / f"{i}.csv").write_text("\n".join([",".join(order).upper(), *(",".join(r[n] for n in order) for r in rows)]) + "\n")
        want += [tuple(r[n] for n in ("key", "note", "size")) for r in rows]
    assert cells(scans.scan_csv_named(spark, str(tmp_path), ["key", "note", "size"]), "key", "note", "size") == sorted(want)


def test_files_in_splits(spark, tmp_path, monkeypatch):
    """Files of several splits, of one, and small ones together: each split has its own file's header, and heads are read without the rest."""
    want, rng = [], random.Random(1)
    for i, (n, order) in enumerate([(3000, "key,a,b"), (2500, "b,key,a"), (900, "a,b,key"), (3, "key,b,a"), (1200, "a,key")]):
        rows = [{"key": f"{i}.{k}", "a": "x" * rng.randrange(40), "b": str(k)} for k in range(n)]
        (tmp_path / f"{i}.csv").write_text("\n".join([order, *(",".join(r[c] for c in order.split(",")) for r in rows)]))
        want += [(r["key"], r["a"], r["b"] if "b" in order.split(",") else "") for r in rows]
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], 20_000)
        spark.conf.set(keys[1], 1_000)
        found = scans.scan_csv_named(spark, str(tmp_path), ["key", "a", "b"])
        assert cells(found, "key", "a", "b") == sorted(want)
        assert found.rdd.getNumPartitions() > 6
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_archive_of_many_columns(spark, tmp_path):
    head = [f"c{i}" for i in range(70)]
    with zipfile.ZipFile(tmp_path / "wide.zip", "w") as z:
        z.writestr("a.csv", ",".join(head) + "\n" + ",".join(f"v{i}" for i in range(70)) + "\n" + ",".join(f"w{i}" for i in range(71)) + '\n"two\nlines"\n')
        z.writestr("b.csv", "C66,c3\n1,2\n")
    got = scans.scan_archive_named(scans.binary_files(spark, str(tmp_path)), ["c0", "c3", "c66"])
    assert cells(got, "c0", "c3", "c66", "_overflow_") == sorted([("v0", "v3", "v66", ""), ("w0", "w3", "w66", "w70"), ("two\nlines", "", "", ""), ("", "2", "1", "")])


def archive(path, members, method):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_large_archive_by_member(spark, tmp_path, monkeypatch):
    """Members of a large archive are read by several tasks; the lines are those of a small one's reader."""
    rng = random.Random(2)
    members = {f"m{i}.csv": "".join(f"{i},{k},{rng.random()}\n" for k in range(rng.randrange(60))) for i in range(200)}
    for name, method in (("a.zip", zipfile.ZIP_DEFLATED), ("b.zip", zipfile.ZIP_STORED)):
        archive(tmp_path / name, members, method)
    files = scans.binary_files(spark, str(tmp_path))
    lines = lambda: scans.scan_archive(files)
    key = lambda frame: cells(frame.selectExpr("split_part(archive, '/', -1) AS archive", "member", "cast(number AS string) AS number", "line"), "archive", "member", "number", "line")
    near = key(lines())
    monkeypatch.setattr(scans, "SPREAD_FROM", 1000)
    spread = lines()
    assert key(spread) == near and len(near) == 2 * sum(t.count("\n") for t in members.values())
    assert spread.filter("archive LIKE '%a.zip'").selectExpr("spark_partition_id() AS p").distinct().count() > 1
    assert scans.zip_members(files).count() == 400


def test_damaged_member(spark, tmp_path, monkeypatch):
    archive(tmp_path / "a.zip", {"m.csv": "1234567890\n" * 50}, zipfile.ZIP_STORED)
    data = bytearray((tmp_path / "a.zip").read_bytes())
    at = data.index(b"1234567890\n")
    data[at] = ord("x")
    (tmp_path / "a.zip").write_bytes(bytes(data))
    monkeypatch.setattr(scans, "SPREAD_FROM", 10)
    with pytest.raises(Exception, match="damaged"):
        scans.scan_archive(scans.binary_files(spark, str(tmp_path))).collect()


def test_commas_inside_quotes_are_no_cells(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b,c\n"1,2",3\n"4,""5,6"\n')
    (tmp_path / "ok.csv").write_text('a,b\n"1,2",3\n')
    assert [(r.header_cells, r.most_cells) for r in scans.malformed_files(spark, str(tmp_path)).collect()] == [(3, 2)]


def test_inflating_reader():
    text = b"abc" * 100_000
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x", text)
        z.writestr("none", b"")
    import zlib

    squeeze = zlib.compressobj(9, zlib.DEFLATED, -15)
    packed = squeeze.compress(text) + squeeze.flush()
    assert io.BufferedReader(scans._Inflated(packed, 8, zlib.crc32(text))).read() == text
    assert io.BufferedReader(scans._Inflated(b"", 0, 0)).read() == b""
