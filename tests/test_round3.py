"""Queries against their SQL on small tables made for the case."""

import io
import os
import zipfile

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

GIVEN = "/root/testdata/sf0.001"


def given(name: str) -> pa.Table:
    return pq.read_table(f"{GIVEN}/{name}.parquet")


def tables(folder, **made: pa.Table) -> str:
    """A folder of the given tables, some of them replaced."""
    for name in os.listdir(GIVEN):
        os.symlink(f"{GIVEN}/{name}", folder / name)
    for name, table in made.items():
        os.remove(folder / f"{name}.parquet")
        pq.write_table(table, folder / f"{name}.parquet")
    return str(folder)


def of_sql(folder: str, sql: str, threads: int = 4) -> list[tuple]:
    con = duckdb.connect()
    con.execute(f"SET TimeZone = 'UTC'; SET threads = {threads}")
    for name in os.listdir(folder):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{folder}/{name}')")
    return sorted(con.execute(sql).fetchall(), key=repr)


def same(spark, folder: str, name: str) -> list[tuple]:
    rows = sorted((tuple(r) for r in entry.queries()[name](spark, folder).collect()), key=repr)
    assert rows == of_sql(folder, entry.oracle_sql()[name])
    return rows


@pytest.fixture
def free_ticks(tmp_path):
    """Events of which some have a price of zero."""
    e = given("events").slice(0, 60)
    price = pa.array([0.0 if i % 10 == 3 else v for i, v in enumerate(e["value"].to_pylist())])
    return tables(tmp_path, events=e.set_column(e.column_names.index("value"), "value", price))


def test_padding_levels_of_series(spark, free_ticks):
    rows = same(spark, free_ticks, "books_of_series")
    assert len(rows) == 8 * 60 - 6 * 6  # gate's rows of price zero stay


def test_padding_levels(spark, free_ticks):
    assert len(same(spark, free_ticks, "normalised_books")) == 3 * 60 - 2 * 6


@pytest.fixture
def equal_spans(tmp_path):
    """Two customers of 40 orders each, of few months, so that spans of one customer are equal by the dozen and islands adjoin; a file of each order."""
    from datetime import date, datetime

    o, l = given("orders").slice(0, 80), given("lineitem").slice(0, 80)
    when = pa.array([datetime(1995, 1 + i // 2 % 12, 3) for i in range(80)], o["o_orderdate"].type)
    put = lambda t, **columns: pa.table({n: columns.get(n, t[n]) for n in t.column_names})
    orders = put(o, o_orderkey=pa.array(range(80), pa.int64()), o_custkey=pa.array([1 + i % 2 for i in range(80)], pa.int64()), o_orderdate=when)
    ship = pa.array([datetime(1995, 1 + i // 2 % 12, 1 + i % 28) for i in range(80)], l["l_shipdate"].type)
    lineitem = put(l, l_orderkey=pa.array(range(80), pa.int64()), l_shipdate=ship)
    c = given("customer")
    customer = put(c, c_nationkey=pa.array([0] * len(c), pa.int64()))
    return tables(tmp_path, orders=orders, lineitem=lineitem, customer=customer)


def test_equal_spans_are_one(spark, equal_spans):
    """The SQL tells it whatever order it takes equal spans in: each month of each customer is a span."""
    rows = same(spark, equal_spans, "spans_united")
    assert len(rows) == 24 and all(r[1] == r[2] for r in rows)


def test_files_in_equal_spans(spark, equal_spans):
    rows = same(spark, equal_spans, "contents_exact")
    assert all(r[2][:6] == r[3][:6] for r in rows)


def test_bounds_in_equal_spans(spark, equal_spans):
    rows = same(spark, equal_spans, "contents_through_lens")
    assert all(r[3].endswith("99") or r[2][:6] == r[3][:6] for r in rows)


@pytest.fixture
def open_spans(tmp_path):
    """Customer 1 with an order of no date, customer 2 of no nation, customer 3 of neither kind; a file of each order, those of customer 1 in p1 without a date."""
    from datetime import datetime

    put = lambda t, **columns: pa.table({n: pa.array(columns[n], t[n].type) if n in columns else t[n] for n in t.column_names})
    ids, whose = range(60), [1 + i % 3 for i in range(60)]
    orders = put(given("orders").slice(0, 60), o_orderkey=ids, o_custkey=whose, o_orderpriority=[f"p{i % 2}" for i in ids], o_orderdate=[datetime(1995, 4 + i // 3 % 6, 3) if i else None for i in ids])
    lineitem = put(given("lineitem").slice(0, 60), l_orderkey=ids, l_shipdate=[None if i % 6 == 3 else datetime(1995, 1 + i // 3 % 12, 1 + i % 28) for i in ids])
    customer = put(given("customer").slice(0, 3), c_custkey=[1, 2, 3], c_nationkey=[1, None, 1])
    return tables(tmp_path, orders=orders, lineitem=lineitem, customer=customer)


def test_files_in_open_spans(spark, open_spans):
    """A month that is not known leaves its end open, for the SQL too; a series without a dated file is left out, as one without a file is."""
    rows = same(spark, open_spans, "contents_exact")
    assert [r for r in rows if r[0] == "C1"] == [("C1", "p0", "19950101", "19951103")]
    assert [r for r in rows if r[0] == "C2"] == [("C2", "p0", "19950411", "19951207"), ("C2", "p1", "19950514", "19951104")]


def test_bounds_in_open_spans(spark, open_spans):
    rows = same(spark, open_spans, "contents_through_lens")
    assert [r for r in rows if r[:2] == ("C1", "p0")] == [("C1", "p0", "19950101", "19951103")]
    assert [r for r in rows if r[0] == "C2"] == [("C2", "p0", "199504", "19951207"), ("C2", "p1", "199504", "19951104")]


def test_large_text_tables_among_sheets_are_split(spark, tmp_path):
    """Of the large files, plain tables are read by several tasks, one with line breaks in its cells and a workbook whole."""
    from marketloom.plans.queries_files import workbook
    from marketloom.sources import scans

    body = lambda word: "".join(f"{i},{word},{i % 7 or ''}\n" for i in range(3000))
    files = {"a b+c.csv": "Key,word,Rest\n" + body("w"), "broken.csv": "rest,key,word\n" + "".join(f'{i % 7 or ""},{i},"u\nv"\n' for i in range(3000)), "small.csv": "key,word\n1,s\n"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "book.xlsx").write_bytes(workbook([["KEY", "word", "rest"], *[[str(i), f"x{i * 7919 % 3001}", "5"] for i in range(3000)]]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert min(os.path.getsize(tmp_path / n) for n in ("a b+c.csv", "broken.csv", "book.xlsx")) > 8192
        rows = scans.scan_sheet_files(spark, str(tmp_path), ["key", "word", "rest", "none"]).selectExpr("*", "spark_partition_id() AS task").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    of = lambda name: [r for r in rows if r.filename.endswith(name)]
    for name, word in (("a b+c.csv", "w"), ("broken.csv", "u\nv")):
        assert sorted((int(r.key), r.word, r.rest, r.none) for r in of(name)) == [(i, word, str(i % 7) if i % 7 else None, None) for i in range(3000)]
    assert sorted(int(r.key) for r in of("book.xlsx")) == list(range(3000)) and [(r.key, r.word, r.rest) for r in of("small.csv")] == [("1", "s", None)]
    assert len({r.task for r in of("a b+c.csv")}) > 1 and len({r.task for r in of("broken.csv")}) == 1


def _files(spark, rows):
    return spark.createDataFrame(rows, "owner long, month string, path string, size long, etag string")


def test_coverage_meets_each_file_once(spark):
    """Orphans and other sizes come of one join by path; each side is dealt once."""
    from marketloom.operators import reconcile

    catalog = _files(spark, [(1, "202401", "a", 3, "t"), (1, "202403", "b", 4, "u"), (1, "202404", "d", 1, "w")])
    store = _files(spark, [(1, "202401", "a", 3, "t"), (1, "202403", "b", 5, "u"), (1, "202403", "c", 6, "v"), (1, "202403", None, 6, "v")])
    found = reconcile.coverage_findings(catalog, store, ["owner"])
    assert {tuple(r) for r in found.collect()} == {("gap", 1, "202402", 0), ("orphans", 1, "202403", 2), ("sizes", 1, "202403", 1)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reconcile.coverage_findings(catalog, store, ["owner"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(path") == 2




def test_files_at_hand_are_packed_once(spark):
    """Packed files are read where they were stored: what chooses among them and what reads them does not pack them again."""
    from marketloom.plans.queries_files import packed

    rows = spark.createDataFrame([("a.csv", "m", 2, "y,2"), ("a.csv", "m", 1, "x,1"), ("b.zip", "n", 1, "z,3"), ("b.zip", "k", 5, "w,4")], "path string, member string, n long, line string")
    files = packed(rows)
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
    content = {r.path: bytes(r.content) for r in files.collect()}
    with zipfile.ZipFile(io.BytesIO(content["b.zip"])) as z:
        assert content["a.csv"] == b"x,1\ny,2\n" and {n: z.read(n) for n in z.namelist()} == {"k": b"w,4\n", "n": b"z,3\n"}


def test_rows_are_not_dealt_by_their_file(spark):
    """Files' owners meet rows without a shuffle of the rows, even where Spark would broadcast nothing by itself; ticks are parsed once."""
    from marketloom.plans import queries_series

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = queries_series._normalised(spark, [("gate|spot|trades|BTC_USDT|202401.csv", queries_series._ticks(spark, "/root/testdata/sf0.001"), {"a": "seconds", "b": "sequence", "c": "price", "d": "size", "e": "word"}, False)], "trades", ["symbol", "ts"])
        plan = rows._jdf.queryExecution().executedPlan().toString()
        ticks = queries_series._ticks(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plan and {r.symbol for r in rows.collect()} == {"BTC_USDT"}
    assert "get_json_object" not in ticks


def _market_rows(spark, rows):
    """Trades (symbol, ts, month) of one market."""
    from marketloom.schema import TABLES

    kinds = ", ".join(f"{n} {t}" for n, t in [("symbol", "string"), *TABLES["trades"], ("venue", "string"), ("market", "string"), ("aggregated", "string"), ("month", "string")])
    return spark.createDataFrame([(s, ts, str(ts), *[None] * (len(TABLES["trades"]) - 2), "v", "spot", "false", month) for s, ts, month in rows], kinds)


def _files_by_month(root):
    """month: the (symbol, ts) of each of its files, in the order they stand in."""
    found = {}
    for path in sorted(root.rglob("*.parquet")):
        month = next(p.split("=")[1] for p in path.parts if p.startswith("month="))
        t = pq.ParquetFile(path).read(columns=["symbol", "ts"])
        found.setdefault(month, []).append(list(zip(t["symbol"].to_pylist(), t["ts"].to_pylist())))
    return found


_MONTHS = [(f"S{i * 7919 % 13}", i * 104729 % 1009, month) for month, n in (("2024-01", 1000), ("2024-02", 30), ("2024-03", 40)) for i in range(n)]


def test_partitions_are_compacted_by_ranges(spark, tmp_path, monkeypatch):
    """A partition of any size becomes one ordered file without the repeats, put together of pieces that are sorted each."""
    from marketloom.sources import scans, sinks

    monkeypatch.setattr(sinks, "SORT_ROWS", 100)
    root, rows = tmp_path / "v", _market_rows(spark, _MONTHS).withColumn("part", F.lit("own"))
    for n in (2, 3):
        rows.repartition(n).write.mode("append").partitionBy("venue", "market", "aggregated", "month", "part").parquet(f"{root}/trades")
    sinks.compact_partitions(scans.read_table(spark, str(root), "trades"), str(root), "trades", str(tmp_path / "staged"), distinct=True)
    want = {m: [sorted({(s, ts) for s, ts, month in _MONTHS if month == m})] for m in ("2024-01", "2024-02", "2024-03")}
    assert _files_by_month(root) == want
    staged = _files_by_month(tmp_path / "staged")["2024-01"]
    assert len(staged) > 8 and max(map(len, staged)) < 300
    assert spark.read.parquet(f"{root}/trades").count() == sum(len(x[0]) for x in want.values())


def test_light_months_are_sorted_by_ranges(spark, tmp_path, monkeypatch):
    """A month that is light by its weights is one ordered file, of whatever size, and no task sorts it whole."""
    from marketloom.sources import sinks

    monkeypatch.setattr(sinks, "SORT_ROWS", 100)
    monkeypatch.setattr(sinks, "scratch", lambda spark, name: str(tmp_path / name))
    rows = _market_rows(spark, _MONTHS)
    weights = rows.groupBy("venue", "market", "aggregated", "month").agg(F.max(F.when(F.col("month") == "2024-02", sinks.SPLIT_BYTES).otherwise(1)).alias("bytes"))
    sinks.write_table(rows, str(tmp_path / "v"), "trades", weights=weights)
    got = _files_by_month(tmp_path / "v")
    assert {m: sorted(x for f in got[m] for x in f) for m in got} == {m: sorted((s, ts) for s, ts, month in _MONTHS if month == m) for m in got}
    assert all(len(got[m]) == 1 and got[m][0] == sorted(got[m][0]) for m in ("2024-01", "2024-03"))
    staged = _files_by_month(tmp_path / "staged")
    assert "2024-02" not in staged and max(map(len, staged["2024-01"])) < 300


def test_tapes_are_kept_by_bucket(spark, tmp_path):
    """The tapes of any number of symbols are as many entries of the state as there are buckets; a batch gives the tapes of its own symbols only."""
    from marketloom.streaming import streams

    rows, got = [(f"S{i % 60}" if i % 60 else None, i * 7919 % 211, i, float(i)) for i in range(1200)], []
    kinds, feed, state = "symbol string, ts long, sequence long, price double", str(tmp_path / "feed"), str(tmp_path / "state")
    for part in (rows[600:], rows[:600], [("S7", 500, 1200, 0.5)]):
        spark.createDataFrame(part, kinds).repartition(2).write.mode("append").parquet(feed)
        tapes = streams.tape_by_symbol(streams.stream_frames(spark, feed, kinds, "parquet"), 4, buckets=3)
        tapes.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(lambda f, n: got.append([tuple(r) for r in f.collect()])).start().awaitTermination()
    tape = lambda seen, symbol: [(symbol, k + 1, *r) for k, r in enumerate(sorted(((ts, q, p) for s, ts, q, p in seen if s == symbol), reverse=True)[:4])]
    names = {r[0] for r in rows}
    assert sorted(got[1], key=repr) == sorted((r for s in names for r in tape(rows, s)), key=repr)
    assert sorted(got[2]) == tape([*rows, ("S7", 500, 1200, 0.5)], "S7")
    held = spark.read.format("statestore").option("path", state).option("stateVarName", "kept").option("flattenCollectionTypes", True).load()
    assert held.select("key").distinct().count() <= 3 and held.count() == 4 * 60


def _reachable(n, pairs):
    """The sets of 0 to n - 1 that pairs connect."""
    of = {i: {i} for i in range(n)}
    for a, b in pairs:
        if of[a] is not of[b]:
            of[a] |= of[b]
            for i in of[b]:
                of[i] = of[a]
    return of.values()


def test_near_copies_go_through_the_grid(spark):
    """Texts whose fingerprint words are within two bits are found by the grid, as brute force finds them; what only the bands can reach is grouped too."""
    import random

    from marketloom.llm import simhash

    rnd, texts = random.Random(11), []
    for k in range(12):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(900)]
        for edits in (0, 0, 1, 2, 4):  # at 4 edits far apart, a similarity of about 0.96
            copy = list(words)
            for at in range(edits):
                copy[100 + 190 * at] = f"e{k}-{edits}-{at}"
            texts.append((k, " ".join(copy)))
    sets = {simhash.shingle_set(t.encode()).tobytes() for _, t in texts}
    prints = [simhash.fingerprint_words(simhash.np.frombuffer(b, simhash.np.uint64), simhash.COPY_WORDS) for b in sets]
    nodes = spark.createDataFrame([(i, fp.view("int64").tolist()) for i, fp in enumerate(prints)], "node long, fp array<long>")
    found = {tuple(r) for r in simhash.grid_pairs(nodes).collect()}
    bits = lambda i, j, k: bin(int(prints[i][k]) ^ int(prints[j][k])).count("1")
    want = {(i, j) for i in range(len(prints)) for j in range(i) if any(bits(i, j, k) <= simhash.GRID_RADIUS for k in range(simhash.GRID_WORDS))}
    reach = lambda pairs: {frozenset(x) for x in _reachable(len(prints), pairs)}
    assert want and found <= want and reach(found) == reach(want)
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    groups = {}
    for r in simhash.near_copies(docs).collect():
        groups.setdefault(r["group"], set()).add(texts[r["doc"]][0])
    assert len(groups) == 12 and all(len(g) == 1 for g in groups.values())
