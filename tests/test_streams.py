"""Streams with file sources, run to their end."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from marketloom.operators import market, messages
from marketloom.sources import scans, sinks
from marketloom.streaming import streams


NOW = 1_704_067_200_000_000  # 2024-01-01


def feed(tmp_path, name, batches):
    folder = tmp_path / name
    folder.mkdir()
    for k, batch in enumerate(batches):
        (folder / f"{k}.json").write_text("\n".join(json.dumps(r) for r in batch))
        os.utime(folder / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))  # the source takes files by age, and ties in any order
    return str(folder)


def drain(df, tmp_path, name, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"c-{name}")).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name).collect()


def test_relay_splits_control_frames(spark, tmp_path):
    frames = [{"venue": "binance", "value": '{"e":"trade"}'}, {"venue": "binance", "value": '{"result":null}'}, {"venue": "okx", "value": '{"arg":{},"data":[1]}'}, {"venue": "okx", "value": "pong"}]
    data, control = streams.split_control(streams.relay(streams.stream_frames(spark, feed(tmp_path, "f", [frames])), "me"))
    assert sorted(r.value for r in drain(data, tmp_path, "data")) == sorted(f["value"] for f in frames if f["value"] in ('{"e":"trade"}', '{"arg":{},"data":[1]}'))
    assert len(drain(control, tmp_path, "control")) == 2


def test_routes(spark):
    rules = spark.createDataFrame([("s", "one", "fixed", None, None, {"h": "1"}), ("s", "two", None, "a", "X", None), ("s", "three", None, None, None, None)], "source string, destination string, fixed string, find string, put string, headers map<string, string>")
    frames = spark.createDataFrame([("s", "banana", "v"), ("other", "k", "w")], "source string, key string, value string")
    assert sorted((r.destination, r.key) for r in streams.route(frames, rules).collect()) == [("one", "fixed"), ("three", "banana"), ("two", "bXnana")]


def test_running_bars(spark, tmp_path):
    base = [{"symbol": "A", "time": f"2024-01-01T00:0{m}:00.000Z", "price": float(m), "size": 1.0, "sequence": m} for m in range(6)]
    late = [{"symbol": "A", "time": "2024-01-01T01:00:00.000Z", "price": 9.0, "size": 1.0, "sequence": 99}]
    ticks = streams.stream_frames(spark, feed(tmp_path, "t", [base, late, late]), "symbol string, time timestamp, price double, size double, sequence long", files=1)
    out = {str(r.time): r for r in drain(streams.running_bars(ticks, "5 minutes"), tmp_path, "bars")}
    assert out["2024-01-01 00:05:00"].open == 1.0 and out["2024-01-01 00:05:00"].trades == 5 and out["2024-01-01 00:00:00"].trades == 1


def rounds(spark, tmp_path, name, schema, parts, build, mode="append"):
    """A stream over files of shuffled rows that come in several rounds, each read by a run of its own."""
    folder, out = tmp_path / f"{name}-in", []
    folder.mkdir()
    for k, part in enumerate(parts):
        rnd = random.Random(k)
        rnd.shuffle(part)
        for f in range(3):
            (folder / f"{rnd.random()}-{k}-{f}.json").write_text("\n".join(json.dumps(r) for r in part[f::3]))
        stream = build(streams.stream_frames(spark, str(folder), schema, files=1000))
        stream.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / f"{name}-c")).trigger(availableNow=True).foreachBatch(lambda f, n: out.extend(f.collect())).start().awaitTermination()
    return out


@pytest.fixture(params=[7, 10_000])
def chunks(spark, request):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", request.param)
    yield request.param
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_clocked_repeats(spark, tmp_path, chunks):
    rnd = random.Random(5)
    rows = [{"source": f"s{i % 2}", "arrival": i, "ts": NOW + (i * 100 - rnd.choice([0, 0, 900])) * 1000, "content": rnd.choice("abcdefghij") * (i // 150 + 1)} for i in range(600)]
    rows += [{"source": "t", "arrival": i, "ts": NOW + t * 1000, "content": c} for i, (t, c) in enumerate([(0, "a"), (200, "b"), (0, "a"), (900, "c"), (0, "a"), (200, "b")])]
    parts = [[r for r in rows if lo <= r["arrival"] < hi] for lo, hi in ((0, 3), (3, 250), (250, 10_000))]
    frame = spark.createDataFrame([(r["source"], "t", 0, r["arrival"], r["ts"], r["content"]) for r in rows], "source string, table string, day long, arrival long, ts long, content string")
    want = sorted((r.source, r.arrival) for r in messages.flag_repeats(frame, 500).filter("NOT dropped").collect())
    got = rounds(spark, tmp_path, "log", "source string, arrival long, ts long, content string", parts, lambda s: streams.dedup_clocked(s, 500, by=("source",)))
    assert sorted((r.source, r.arrival) for r in got) == want and len(want) < len(rows)
    assert [a for s, a in want if s == "t"] == [0, 1, 2, 3]
    assert sorted(r.arrival for r in messages.flag_repeats(frame.filter("source = 't'"), 0).filter("NOT dropped").collect()) == [0, 1, 3]


def test_clocked_repeats_keep_what_comes_too_late(spark, tmp_path):
    row = lambda a, c: {"source": "s", "arrival": a, "ts": NOW + a, "content": c}
    got = rounds(spark, tmp_path, "late", "source string, arrival long, ts long, content string", [[row(5, "x")], [row(4, "x"), row(6, "x")]], lambda s: streams.dedup_clocked(s, 0, by=("source",)))
    assert sorted(r.arrival for r in got) == [4, 5]


def test_state_is_touched_by_content(spark, tmp_path):
    """A batch writes entries for its own new contents only, however many its key has; a batch of contents known writes its clock and timer."""
    folder, written = tmp_path / "grow", []
    folder.mkdir()
    batches = [[f"c{i}" for i in range(10)], [f"c{i}" for i in range(10, 310)], ["c1", "c200", "new"], ["c2"]]
    arrival = 0
    for k, contents in enumerate(batches):
        rows = [{"source": "s", "arrival": (arrival := arrival + 1), "ts": NOW, "content": c} for c in contents]
        (folder / f"{k}.json").write_text("\n".join(json.dumps(r) for r in rows))
        stream = streams.dedup_clocked(streams.stream_frames(spark, str(folder), "source string, arrival long, ts long, content string"), 0, by=("source",))
        query = stream.writeStream.format("noop").outputMode("append").option("checkpointLocation", str(tmp_path / "grow-c")).trigger(availableNow=True).start()
        query.awaitTermination()
        ops = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
        written.append((ops[-1]["numRowsUpdated"], ops[-1]["numRowsTotal"]))
    assert written[1][1] >= 310 and written[2][0] < 20 and written[3][0] < 20, written


def test_contents_are_forgotten(spark, tmp_path):
    """Entries older than forget_ms, by the clock of the machines, are gone."""
    import time

    folder, out, began = tmp_path / "ttl", [], time.time()
    folder.mkdir()

    def put(name, *rows):
        (folder / f".{name}").write_text("\n".join(json.dumps({"source": s, "arrival": a, "ts": NOW, "content": c}) for s, a, c in rows))
        os.rename(folder / f".{name}", folder / f"{name}.json")

    def wait(n):
        while len(out) < n and time.time() - began < 240:
            time.sleep(0.1)
        assert sorted(r.arrival for r in out if r.source == "s") == wanted

    stream = streams.dedup_clocked(streams.stream_frames(spark, str(folder), "source string, arrival long, ts long, content string"), 0, by=("source",), forget_ms=20_000)
    query = stream.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "ttl-c")).trigger(processingTime="200 milliseconds").foreachBatch(lambda f, n: out.extend(f.collect())).start()
    try:
        wanted = []
        put("0", ("warm", 1, "x"))
        wait(1)
        wanted = [1, 2]
        put("1", ("s", 1, "a"), ("s", 2, "b"))
        wait(3)
        wanted = [1, 2, 4]
        put("2", ("s", 3, "a"), ("s", 4, "c"))
        wait(4)
        time.sleep(25)
        wanted = [1, 2, 4, 5]
        put("3", ("s", 5, "a"))
        wait(5)
    finally:
        query.stop()


def test_exact_repeats(spark, tmp_path):
    rows = [{"source": "s", "content": c, "time": "2024-01-01T00:00:00Z"} for c in "aab"]
    log = streams.stream_frames(spark, feed(tmp_path, "e", [rows]), "source string, content string, time timestamp")
    assert sorted(r.content for r in drain(streams.dedup_exact(log), tmp_path, "exact")) == ["a", "b"]


DELTAS = [("T", "partial", "k1", 1.0, 1), ("T", "partial", "k2", 2.0, 1), ("T", "update", "k3", 9.0, 2), ("T", "update", "k1", 5.0, 3), ("T", "insert", "k4", 4.0, 4), ("T", "delete", "k2", 0.0, 5), ("T", "partial", "k9", 7.0, 6), ("T", "insert", "k8", 8.0, 7)]


def replay(rows):
    held, image = {}, None
    for n, a, k, v, s in sorted(rows, key=lambda r: r[4]):
        if a == "partial" and s != image:
            held, image = {x: y for x, y in held.items() if x[0] != n}, s
        if a in ("partial", "insert") or (a == "update" and (n, k) in held):
            held[n, k] = v
        elif a == "delete":
            held.pop((n, k), None)
    return held


def test_table_state_stream_and_batch(spark, tmp_path, chunks):
    rnd = random.Random(2)
    rows = DELTAS + [("U", rnd.choice(["insert", "update", "update", "delete"] + ["partial"] * (s % 40 == 0)), f"k{rnd.randrange(30)}", float(s), s) for s in range(400)]
    parts = [[{"name": n, "action": a, "key": k, "value": v, "seq": s} for n, a, k, v, s in rows if lo <= s < hi] for lo, hi in ((0, 5), (5, 120), (120, 999))]
    seen = rounds(spark, tmp_path, "deltas", "name string, action string, key string, value double, seq long", parts, lambda s: streams.table_state(s, "name", "key", "value"), "update")
    state = streams.current_state(spark.createDataFrame(seen, "name string, key string, value double, seq long"), "name", "key", "value")
    frame = spark.createDataFrame(rows, "name string, action string, key string, value double, seq long")
    for got in (state, market.table_state(frame, "name", ["key"], ["value"])):
        assert {(r.name, r.key): r.value for r in got.collect()} == replay(rows)
    early = market.table_state(frame.filter("name = 'T' AND seq <= 5"), "name", ["key"], ["value"])
    assert sorted((r.key, r.value) for r in early.collect()) == [("k1", 5.0), ("k4", 4.0)]


def test_tape_and_buckets(spark, tmp_path):
    rows = [{"symbol": "A", "ts": i, "sequence": i, "table": "trade", "day": "2024-01-01"} for i in range(9)]
    kinds, folder, held = "symbol string, ts long, sequence long, table string, day string", tmp_path / "b", []
    folder.mkdir()
    for k, part in enumerate((rows[3:8], rows[:3], rows[8:])):
        (folder / f"{9 - k}.json").write_text("\n".join(json.dumps(r) for r in part))
        ticks = streams.stream_frames(spark, str(folder), kinds)
        streams.tape(ticks, 4, lambda f, _: held.append(sorted((r.ts for r in f.collect()), reverse=True)), str(tmp_path / "ct")).awaitTermination()
    assert held == [[7, 6, 5, 4], [7, 6, 5, 4], [8, 7, 6, 5]]
    streams.stream_to_buckets(ticks, str(tmp_path / "out"), str(tmp_path / "cb"), None, flush_rows=2).awaitTermination()
    day = spark.read.parquet(str(tmp_path / "out")).filter("table = 'trade' AND day = '2024-01-01'")
    assert day.count() == 9 and max(r["count"] for r in day.groupBy(F.input_file_name()).count().collect()) == 2
    streams.seal_bucket(day, str(tmp_path / "sealed"), ["sequence"])
    assert [r.ts for r in spark.read.parquet(str(tmp_path / "sealed")).collect()] == list(range(9))


def test_tapes_by_symbol(spark, tmp_path, chunks):
    rnd = random.Random(6)
    rows = [{"symbol": f"S{rnd.randrange(4)}", "ts": NOW + rnd.randrange(50), "sequence": i, "price": float(i)} for i in range(300)]
    parts = [rows[200:], rows[:40], rows[40:200]]
    out = {}
    kinds = "symbol string, ts long, sequence long, price double"
    folder = tmp_path / "tapes"
    folder.mkdir()
    for k, part in enumerate(parts):
        for f in range(2):
            (folder / f"{k}-{f}.json").write_text("\n".join(json.dumps(r) for r in part[f::2]))
        tapes = streams.tape_by_symbol(streams.stream_frames(spark, str(folder), kinds), 6)

        def sink(frame, number):
            for symbol, group in frame.toPandas().groupby("symbol"):
                out[symbol] = list(group.sort_values("place")[["ts", "sequence", "price"]].itertuples(index=False, name=None))

        tapes.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "tapes-c")).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
    for symbol in {r["symbol"] for r in rows}:
        own = sorted(((r["ts"], r["sequence"], r["price"]) for r in rows if r["symbol"] == symbol), reverse=True)[:6]
        assert out[symbol] == own


def test_buffers_flush_by_size_or_age(spark, tmp_path):
    """A fast table is written when it has enough rows, a slow one when its first row is old enough, and what waits survives a stop."""
    import time

    folder, got, began = tmp_path / "buf", [], time.time()
    folder.mkdir()

    def put(name, *rows):
        (folder / f".{name}").write_text("\n".join(json.dumps({"table": t, "day": "2024-01-01", "n": n, "data": [{"x": n}]}) for t, n in rows))
        os.rename(folder / f".{name}", folder / f"{name}.json")

    def start(seconds):
        rows = streams.stream_frames(spark, str(folder), "table string, day string, n long, data array<struct<x: long>>")
        return streams.buffered(rows, seconds, 10).writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "buf-c")).trigger(processingTime="200 milliseconds").foreachBatch(
            lambda f, i: got.extend((r.table, r.n, r.data[0].x, r.reason, i) for r in f.collect())).start()

    def wait(ready):
        while not ready() and time.time() - began < 240:
            time.sleep(0.1)
        assert ready(), got

    query = start(6)
    put("0", *(("fast", n) for n in range(25)), *(("slow", n) for n in range(3)))
    wait(lambda: len(got) >= 25)
    assert {g[:2] for g in got if g[3] == "full"} == {("fast", n) for n in range(25)}
    wait(lambda: len(got) >= 28)
    assert {g[:2] for g in got if g[3] == "stale"} == {("slow", n) for n in range(3)}
    query.stop()
    query = start(100_000)
    put("1", *(("slow", n) for n in range(3, 7)))
    wait(lambda: query.lastProgress is not None and any(p["numInputRows"] for p in query.recentProgress))
    time.sleep(2)
    query.stop()
    assert sorted((r.table, json.loads(r.row)["n"]) for r in streams.waiting(spark, str(tmp_path / "buf-c")).collect()) == [("slow", n) for n in range(3, 7)]
    query = start(100_000)
    put("2", *(("slow", n) for n in range(7, 14)))
    wait(lambda: len(got) >= 39)
    query.stop()
    assert sorted(g[1] for g in got if g[0] == "slow") == list(range(14)) and all(g[1] == g[2] for g in got) and len(got) == 39


def test_bars_open_at_the_close_before(spark, tmp_path):
    folder, got = tmp_path / "t2", []
    folder.mkdir()
    tick = lambda m, p: {"symbol": "A", "time": f"2024-01-01T{m // 60:02}:{m % 60:02}:30.000Z", "price": p, "size": 1.0, "sequence": m}
    for k, part in enumerate(([tick(0, 1.0), tick(1, 2.0), tick(9, 5.0)], [tick(20, 7.0)], [tick(60, 9.0)])):
        (folder / f"{k}.json").write_text("\n".join(json.dumps(r) for r in part))
        ticks = streams.stream_frames(spark, str(folder), "symbol string, time timestamp, price double, size double, sequence long")
        streams.carried_bars(streams.running_bars(ticks, "5 minutes"), lambda f, _: got.extend(f.collect()), str(tmp_path / "cc")).awaitTermination()
    assert [(str(r.time)[11:16], r.open, r.close) for r in sorted(got, key=lambda r: r.time)] == [("00:05", 1.0, 2.0), ("00:10", 2.0, 5.0), ("00:25", 5.0, 7.0)]


def test_vault_round_trip(spark, tmp_path):
    from marketloom.schema import TABLES

    names = [n for n, _ in TABLES["trades"]]
    kinds = ", ".join(f"{n} {t}" for n, t in [("symbol", "string"), *TABLES["trades"], ("venue", "string"), ("market", "string"), ("aggregated", "string"), ("month", "string")])
    row = lambda s, ts, month: (s, ts, *[None] * (len(names) - 1), "v", "spot", "false", month)
    root = str(tmp_path / "vault")
    sinks.write_table(spark.createDataFrame([row("B", 2, "2024-01"), row("A", 3, "2024-01"), row("A", 1, "2024-02")], kinds), root, "trades")
    sinks.write_table(spark.createDataFrame([row("C", 9, "2024-02")], kinds), root, "trades")
    got = scans.read_table(spark, root, "trades", venue="v", market="spot")
    assert sorted((r.symbol, r.month) for r in got.collect()) == [("A", "2024-01"), ("B", "2024-01"), ("C", "2024-02")]
    sinks.write_sides(spark.createDataFrame([row("A", 4, "2024-01")], kinds), root, "trades", "post")
    assert scans.read_table(spark, root, "trades", month="2024-01").count() == 3
    sinks.write_empty(spark, root, "trades", venue="v", market="spot", aggregated="true", month="2024-03")
    assert scans.read_table(spark, root, "trades", month="2024-03").count() == 0


def test_files_by_size(spark, tmp_path):
    """A symbol with nine tenths of a month is cut, small symbols are put together, and files come near the size asked for; sorted all the same."""
    from marketloom.schema import TABLES

    names = [n for n, _ in TABLES["trades"]]
    rows = spark.range(60_000).select(F.when(F.col("id") % 10 > 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 500)).alias("symbol"), (F.col("id") * 7919 % 60_000).alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("tradeId"))
    kinds = dict(TABLES["trades"])
    rows = rows.select("symbol", *[F.col(n) if n in rows.columns else F.lit(None).cast(kinds[n]).alias(n) for n in names], F.lit("v").alias("venue"), F.lit("spot").alias("market"), F.lit("false").alias("aggregated"), F.lit("2024-01").alias("month"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "512k")
        sinks.write_table(rows.repartition(8), str(tmp_path / "v"), "trades")
    finally:
        spark.conf.set(key, before)
    files = [f for f in (tmp_path / "v").rglob("*.parquet")]
    sizes = sorted(f.stat().st_size for f in files)
    middle = sizes[len(sizes) // 2]
    assert 4 <= len(files) <= 24 and sizes[-1] <= 2 * middle, sizes
    for f in files:
        got = [(r.symbol, r.ts) for r in spark.read.parquet(str(f)).select("symbol", "ts").collect()]
        assert got == sorted(got)
    assert scans.read_table(spark, str(tmp_path / "v"), "trades").count() == 60_000


def test_only_partitions_in_pieces_are_compacted(spark, tmp_path):
    from marketloom.schema import TABLES

    kinds = ", ".join(f"{n} {t}" for n, t in [("symbol", "string"), *TABLES["trades"], ("venue", "string"), ("market", "string"), ("aggregated", "string"), ("month", "string")])
    row = lambda s, ts, month: (s, ts, *[None] * (len(TABLES["trades"]) - 1), "v", "spot", "false", month)
    root = str(tmp_path / "v")
    sinks.write_table(spark.createDataFrame([row("A", 1, "2024-01"), row("A", 1, "2024-02"), row("B", 2, "2024-02")], kinds), root, "trades")
    spark.createDataFrame([row("C", 5, "2024-02"), row("A", 1, "2024-02")], kinds).withColumn("part", F.lit("own")).repartition(2).write.mode("append").partitionBy("venue", "market", "aggregated", "month", "part").parquet(f"{root}/trades")
    still = [f for f in (tmp_path / "v").rglob("*.parquet") if "2024-01" in str(f)]
    sinks.compact_partitions(scans.read_table(spark, root, "trades"), root, "trades", str(tmp_path / "staged"), distinct=True)
    after = [f for f in (tmp_path / "v").rglob("*.parquet")]
    assert [f for f in after if "2024-01" in str(f)] == still and len(after) == 2
    got = [(r.symbol, r.ts) for r in spark.read.parquet(str(next(f for f in after if "2024-02" in str(f)))).collect()]
    assert got == [("A", 1), ("B", 2), ("C", 5)]
    assert not [f for f in (tmp_path / "staged").rglob("*.parquet") if "2024-01" in str(f)]


def test_archives_and_logs(spark, tmp_path):
    import tarfile
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", "1,2\n3,4\n")
        z.writestr("y.csv", "5\n")
    (tmp_path / "t.txt").write_text("p\nq\n")
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        t.add(tmp_path / "t.txt", "t.txt")
    got = sorted((r.member, r.number, r.line) for r in scans.scan_archive(scans.binary_files(spark, [str(tmp_path / "a.zip"), str(tmp_path / "b.tar.gz")])).collect())
    assert got == [("t.txt", 0, "p"), ("t.txt", 1, "q"), ("x.csv", 0, "1,2"), ("x.csv", 1, "3,4"), ("y.csv", 0, "5")]
    assert {r.kind for r in scans.split_by_signature(scans.binary_files(spark, [str(tmp_path / "a.zip"), str(tmp_path / "t.txt")])).collect()} == {"sheet", "text"}
    (tmp_path / "bad.csv").write_text("a,b,c\n1\n2,3\n")
    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    assert [r.rows for r in scans.malformed_files(spark, [str(tmp_path / "bad.csv"), str(tmp_path / "good.csv")]).collect()] == [2]
    events = spark.createDataFrame([("v", "p", "withdrawn")], "venue string, path string, event string")
    sinks.write_withdrawals(events, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).first().event == "withdrawn"


def test_late_sides(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "symbol string, ts long")
    out = streams.accept_late(rows(("A", 10), ("A", 20)), rows(("A", 5), ("A", 12), ("B", 1)), rows(("A", 20), ("A", 21)))
    assert sorted(r.ts for r in out.collect()) == [5, 10, 20, 21]


def test_late_sides_in_a_stream(spark, tmp_path):
    """The same sides a round after their months, before them, and after the patience: what is accepted is what the batch form accepts."""
    at = lambda d: f"2024-01-{d:02}T00:00:00Z" if d < 32 else f"2024-03-{d - 31:02}T00:00:00Z"
    months = [[("A", "m", 10, 20, 1)], [("B", "m", 5, 5, 9)], [("C", "m", 1, 2, 20)], [], [("x", "end", 0, 0, 60)]]
    sides = [[], [("A", "pre", 5, 2), ("A", "pre", 12, 2), ("A", "post", 21, 14)], [("B", "post", 6, 20), ("B", "post", 5, 20), ("C", "pre", 0, 10)], [("A", "post", 30, 22), ("D", "pre", 1, 22)], [("y", "pre", 1, 60)]]
    for name, parts, keys in (("m", months, ("symbol", "month", "first", "last", "at")), ("s", sides, ("symbol", "side", "ts", "at"))):
        (tmp_path / name).mkdir()
        for k, part in enumerate(parts):
            text = "\n".join(json.dumps({"month": "m", **dict(zip(keys, r)), "at": at(r[-1])}) for r in part)
            (tmp_path / f"{name}{k}").write_text(text)
    for k in range(len(months)):
        for name in "ms":
            os.rename(tmp_path / f"{name}{k}", tmp_path / name / f"{k}.json")
        s = streams.stream_frames(spark, str(tmp_path / "s"), "symbol string, month string, side string, ts long, at timestamp")
        m = streams.stream_frames(spark, str(tmp_path / "m"), "symbol string, month string, first long, last long, at timestamp")
        streams.write_judged(streams.judge_sides(s, m), str(tmp_path / "ok"), str(tmp_path / "late"), str(tmp_path / "cs")).awaitTermination()
    read = lambda name: sorted((r.symbol, r.side, r.ts) for r in spark.read.parquet(str(tmp_path / name)).collect())
    assert read("ok") == [("A", "post", 21), ("A", "pre", 5), ("B", "post", 6), ("C", "pre", 0)]
    assert read("late") == [("A", "post", 30), ("D", "pre", 1)]
    rows = lambda *x: spark.createDataFrame([("own", *r) for r in x], "part string, symbol string, ts long")
    own = rows(("A", 10), ("A", 20), ("B", 5), ("C", 1), ("C", 2))
    batch = streams.accept_late(own, rows(("A", 5), ("A", 12), ("C", 0)), rows(("A", 21), ("B", 6), ("B", 5)))
    assert sorted((r.symbol, r.ts) for r in batch.exceptAll(own).collect()) == [(s, t) for s, _, t in sorted(read("ok"), key=lambda r: (r[0], r[2]))]


def test_event_day_routes(spark):
    rows = spark.createDataFrame([("t", 86_400_000_000 * 3, [(86_400_000_000,), (5,)]), ("t", 86_400_000_000 * 3, [])], "table string, received long, data array<struct<timestamp: long>>")
    assert [r.day for r in streams.route_by_event_day(rows).orderBy(F.size("data").desc()).collect()] == ["1970-01-02", "1970-01-04"]
