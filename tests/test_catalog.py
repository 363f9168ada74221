"""Catalog, lenses, change capture and reconciliation on hand-written rows."""

from marketloom.operators import catalog, changes, lenses, reconcile

FILE = "venue string, path string, date string, size long, etag string, modified string, existence string, downloaded_at string"


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_partition_version_wraps(spark):
    import hashlib

    tags = [f"tag{i}" for i in range(50)]
    files = spark.createDataFrame([("v", t, "confirmed" if i % 7 else "absent") for i, t in enumerate(tags)], "venue string, etag string, existence string")
    want = sum(int(hashlib.sha256(t.encode()).hexdigest()[:16], 16) for i, t in enumerate(tags) if i % 7) % 2**64
    assert catalog.partition_version(files, ["venue"]).first().version == f"{want:016x}"


def test_span_union_and_difference(spark):
    s = lambda *x: spark.createDataFrame([("a", *p) for p in x], "slice string, `from` string, `to` string")
    got = {(r["from"], r["to"]) for r in lenses.span_union(s(("202001", "202003"), ("202003", "202005"), ("202006", "202006"), (None, "201905")), ["slice"]).collect()}
    assert got == {(None, "201905"), ("202001", "202005"), ("202006", "202006")}
    cut = lambda whole, *cuts: {(r["from"], r["to"]) for r in lenses.span_minus(s(whole), s(*cuts), ["slice"]).collect()}
    assert cut(("202001", "202012"), ("202003", "202004")) == {("202001", "202002"), ("202005", "202012")}
    assert cut((None, None), ("202003", None)) == {(None, "202002")}
    assert cut(("202001", "202002"), (None, "202105")) == set()
    assert cut(("202001", "202012"), ("201901", "202001"), ("202012", "202101"), ("202012", "202012")) == {("202002", "202011")}


def test_lens_exclude_wins_and_prefer_falls_back(spark):
    cols = "partition string, venue string, market string, dataset string, variant string, grain string, bundle string, month string"
    p = spark.createDataFrame([("1", "v", "spot", "trades", "", "daily", "instrument", "202001"), ("2", "v", "spot", "trades", "", "monthly", "market", "202001"), ("3", "v", "spot", "trades", "", "monthly", "market", "202002"), ("4", "v", "perp", "books", "", "daily", "market", "202002")], cols)
    names = "rule int, effect string, venue string, markets array<string>, datasets array<struct<dataset: string, variant: string>>, only_grain string, only_bundle string, prefer_bundle string, prefer_grain string, `from` string, `to` string"
    rules = spark.createDataFrame([(1, "exclude", "*", ["perp"], None, None, None, None, None, None, None), (2, "include", "*", None, None, None, None, "instrument", None, None, None)], names)
    assert rows(lenses.resolve_lens(p, rules), "partition") == [("1",), ("3",)]
    assert rows(lenses.resolve_new(p, p.filter("partition = '3'"), rules), "partition") == [("3",)]
    assert {(r.slice, r["from"]) for r in lenses.lens_slices(p.drop("month").withColumnRenamed("partition", "slice"), rules).collect()} == {("1", None), ("2", None), ("3", None)}


def test_listing_changes(spark):
    old = spark.createDataFrame([("v", "a", "20200101", 5, "x", "m", "confirmed", "d"), ("v", "b", "20200101", 5, "x", "m", "confirmed", "d"), ("v", "c", "20200101", 5, "x", "m", "absent", None), ("v", "d", "20200101", None, None, "m", "assumed", None), ("w", "b", "20200101", 5, "x", "m", "confirmed", "d")], FILE)
    page = spark.createDataFrame([("v", "a", "20200101", 6, None, "m", "confirmed", None), ("v", "c", "20200101", 5, "x", "m", "confirmed", None), ("v", "d", "20200101", 7, "y", "m", "confirmed", None), ("v", "e", "20200102", 1, "z", "m", "confirmed", None)], FILE)
    got = {(r.venue, r.path): r for r in changes.merge_listing(old, page).collect()}
    assert {k: r.action for k, r in got.items()} == {("v", "a"): "revised", ("v", "b"): "unlisted", ("v", "c"): "restated", ("v", "d"): "restated", ("v", "e"): "created", ("w", "b"): "unlisted"}
    assert got["v", "a"].downloaded_at is None and got["v", "a"].etag == "x" and got["v", "c"].existence == "confirmed" and got["v", "d"]["size"] == 7
    assert rows(changes.revisions(old, page), "path", "size") == [("a", 5)]
    assert rows(changes.withdraw(old, page, "a", "c").filter("withdrawn"), "venue", "path") == [("v", "b")]


def test_reports_and_probes(spark):
    files = spark.createDataFrame([("v", p, "d", 5, "x", "m", e, d) for p, e, d in (("a", "confirmed", None), ("b", "confirmed", None), ("c", "confirmed", "old"), ("e", "absent", "old"))], FILE)
    report = spark.createDataFrame([("v", "a", "downloaded", None, None, "now", False), ("v", "b", "failed", None, None, "now", True), ("v", "c", "mismatched", 9, "y", "now", False)], "venue string, path string, outcome string, size long, etag string, at string, confirmed_absent boolean")
    got = {r.path: (r.existence, r["size"], r.downloaded_at) for r in changes.apply_report(files, report).collect()}
    assert got == {"a": ("confirmed", 5, "now"), "b": ("absent", 5, None), "c": ("confirmed", 9, None), "e": ("absent", 5, "old")}


def test_settled_candidates(spark):
    """Only what is parked, answered for and known by size and tag arrives; of the rows held before, only withdrawn ones change."""
    files = spark.createDataFrame([("v", p, "d", 5, "x", "m", e, d) for p, e, d in (("a", "confirmed", "old"), ("b", "absent", "old"), ("c", "absent", "old"), ("d", "absent", "old"), ("e", "absent", "old"))], FILE)
    parked = spark.createDataFrame([("v", p, "d2", None, t, "p") for p, t in (("a", "x"), ("b", "x"), ("c", "x"), ("d", "x"), ("f", None), ("g", "x"), ("h", "x"), ("i", "x"))], "venue string, path string, date string, size long, etag string, modified string")
    ask = lambda p, size=5, etag=None, existence=None: ("v", p, size, etag, None, existence)
    probes = spark.createDataFrame([ask("a", 9), ask("b"), ask("c", 6), ask("d", existence="absent"), ask("e"), ask("f"), ask("g", None), ask("h", existence="absent"), ask("i", etag="y")], "venue string, path string, size long, etag string, modified string, existence string")
    got = {r.path: (r.date, r["size"], r.etag, r.existence, r.downloaded_at) for r in changes.settle(files, parked, probes).collect()}
    assert got == {"a": ("d", 5, "x", "confirmed", "old"), "b": ("d2", 5, "x", "confirmed", "old"), "c": ("d2", 6, "x", "confirmed", None), "d": ("d", 5, "x", "absent", "old"), "e": ("d", 5, "x", "absent", "old"),
                   "h": ("d2", 5, "x", "absent", None), "i": ("d2", 5, "y", "confirmed", None)}
    assert {r.path for r in changes.learned(parked, probes).filter("NOT settled").collect()} == {"f", "g"}


def test_series_after_their_files(spark):
    from pyspark.sql import functions as F

    series = spark.createDataFrame([("none", "daily", "19950101", "19960101", "19970101"), ("open", "daily", None, "20991231", None), ("narrow", "daily", "19950101", "19991231", "19980601"), ("month", "monthly", None, "199801", "199001"), ("gone", "daily", "19960101", "19960101", None)],
                                   "series string, grain string, first string, last string, tip string")
    files = spark.createDataFrame([("open", "19960505", "confirmed"), ("open", "20991231", "confirmed"), ("narrow", "19960505", "assumed"), ("narrow", "19960707", "absent"), ("month", "199801", "confirmed"), ("gone", "19960101", "absent")], "series string, date string, existence string")
    got = changes.reconcile_series(series, files, ["series"], F.lit("2024-06-10 12:00:00").cast("timestamp"))
    assert rows(got, "series", "first", "last", "tip", "lifted", "corrected") == [
        ("month", "199801", "199801", "202404", True, True), ("narrow", "19960505", "19960505", "20240525", True, True), ("open", "19960505", "20991231", "20240609", True, True)]
    early = changes.reconcile_series(series, files, ["series"], F.lit("1998-06-10 12:00:00").cast("timestamp"))
    assert rows(early, "series", "tip", "lifted") == [("month", "199804", True), ("narrow", "19980609", True), ("open", "19980609", True)]


def test_revision_bytes(spark):
    """A digest written out by hand: a line break behind every part but the fields."""
    import hashlib

    from pyspark.sql import functions as F

    from marketloom.functions.names import revision
    from marketloom.schema import fields_json

    assert fields_json("funding") == '[{"name":"ts","type":"BIGINT"},{"name":"rate","type":"DOUBLE"},{"name":"intervalHours","type":"BIGINT"}]'
    none = F.array().cast("array<struct<id:string,side:string,version:string>>")
    edge = F.array(F.struct(F.lit("n").alias("id"), F.lit("pre").alias("side"), F.lit("e").alias("version")))
    made = lambda edges, *missing: spark.range(1).select(revision(F.array(F.lit("a"), F.lit("b")), F.lit("[]"), F.lit("p"), F.lit("v"), edges, F.array(*[F.lit(m) for m in missing]).cast("array<string>"))).first()[0]
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()[:12]
    assert made(none) == sha("a\nb\n[]p\nv\n")
    assert made(edge) == sha("a\nb\n[]p\nv\napart\nn\npre\ne\n")
    assert made(none, "pre", "post") == sha("a\nb\n[]p\nv\napart\npost\nmissing\npre\nmissing\n")


def test_tags(spark):
    from marketloom.functions.names import norm_etag

    raw = {'"Ab"': "ab", 'W/"Ab"': 'w/"ab', '""x""': '"x"', "&quot;Q-gzip&quot;": "q", '"&quot;': '', "x-gzip": "x", "x-GZIP": "x-gzip", 'a"b': 'a"b', '"a-gzip"': "a"}
    frame = spark.createDataFrame(list(raw.items()), "raw string, want string")
    assert [(r[0], r[1]) for r in frame.select(norm_etag(frame.raw), "want").collect() if r[0] != r[1]] == []


def test_misfiled(spark):
    paths = ["s/k/202401/BTC-202402.csv.gz", "s/k/202401/BTC-20240201.csv.gz", "s/k/202401/BTC-2024020100.csv.gz", "s/k/202401/BTC-20240131.csv.gz", "s/k/202401/KEPT-20240201.csv.gz", "s/k/2024-01/BTC-20240201.csv.gz", "s/k/202401/A-B-20240201.csv"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    kept = spark.createDataFrame([("KEPT", "20240201")], "symbol string, day string")
    assert {r.path for r in catalog.misfiled(files, kept).collect()} == {paths[0], paths[1], paths[6]}
    trees = spark.createDataFrame([(p,) for p in ("futures_btc/t/202401/BTC_USD-202401.csv.gz", "futures_btc/t/202401/BTC_USDT-202401.csv.gz", "futures_usdt/t/202401/BTC_USDT-202401.csv.gz", "futures_btc/t/2024/BTC_USDT-2.csv")], "path string")
    assert [r.path for r in catalog.wrong_tree(trees).collect()] == ["futures_btc/t/202401/BTC_USDT-202401.csv.gz"]


def test_counter_deltas_cancel(spark):
    state = "struct<partition: string, existence: string, size: long, downloaded_at: string>"
    effects = spark.createDataFrame([(("p", "confirmed", 5, None), ("p", "confirmed", 5, None)), (None, ("q", "confirmed", 7, None)), (("p", "confirmed", 2, "d"), ("q", "absent", 2, "d"))], f"was {state}, now {state}")
    assert rows(catalog.counter_deltas(effects), "partition", "files", "bytes", "pending", "withdrawn") == [("p", -1, -2, 0, 0), ("q", 1, 7, 1, 1)]


def test_ledger(spark):
    schema = "partition string, line long, state string, revision string, grain string, bundle string, version string, pre_version string, post_version string"
    line = lambda p, n, state, revision="r", grain="daily", version="v", pre="missing", post="e": (p, n, state, revision, grain, "market", version, pre, post)
    log = spark.createDataFrame([
        line("a", 1, "stocked"), line("a", 2, "outdated"), line("a", 3, "updating", pre="p"),  # a side comes to a stocked month, marked or not
        line("b", 3, "stocked"), line("b", 4, "outdated"), line("c", 5, "updating"), line("d", 6, "stocked"), line("d", 7, "stocked", "r2"),
        line("e", 8, "stocked"), line("e", 9, "updating"), line("e", 10, "outdated"),  # a mark does not bring back what updating took
        line("f", 11, "stocked"), line("f", 12, "updating"), line("f", 13, "stocked"), line("f", 14, "outdated"), line("f", 15, "stocked"),
        line("g", 16, "stocked"), line("g", 17, "updating", version="w", pre="p"), line("h", 18, "stocked", pre="o"), line("h", 19, "updating", pre="p"),
        line("i", 20, "stocked", post="missing"), line("i", 21, "updating", pre="p", post="q"), line("j", 22, "stocked"), line("j", 23, "updating", grain="monthly", pre="p"),
        line("k", 24, "stocked"), line("k", 25, "updating"), line("l", 26, "outdated")], schema)
    assert rows(reconcile.ledger_current(log), "partition", "line", "outdated") == [("b", 3, True), ("d", 7, False), ("f", 15, False)]
    assert rows(reconcile.ledger_current(log, distrusted=spark.createDataFrame([("b", "r"), ("d", "r"), ("d", "x")], "partition string, revision string")), "partition", "line") == [("d", 7), ("f", 15)]
    held = spark.createDataFrame([(x,) for x in "abceghijk"], "partition string")
    got = {r.partition: (r.action, r.sides) for r in reconcile.repair_plan(log, held.filter("partition <> 'k'")).collect()}
    assert got == {"a": ("undo sides", ["pre"]), "c": ("drop", []), "g": ("drop", []), "h": ("drop", []), "i": ("undo sides", ["pre", "post"]), "j": ("drop", [])}


def test_archives_on_the_disk(spark):
    name = lambda month, day, more="": f"/a/okx|spot|trades|BTC-USDT|2024{month}{day}.csv{more}"
    listing = spark.createDataFrame([(name("01", "01"), 5), (name("01", "02"), 6), (name("01", "03", ".bak"), 7), ("/a/notes", 1), (name("02", "01"), 5), (name("03", "01"), 4), ("/a/okx|spot|trades|BTC-USDT|202404.csv", 9)], "path string, length long")
    part = lambda month, files, size, grain="daily": ("okx", "spot", "trades", "", "instrument", grain, f"2024-{month}", files, size)
    partitions = spark.createDataFrame([part("01", 2, 11), part("02", 2, 11), part("03", 1, 5), part("04", 1, 9), part("04", 1, 9, "monthly"), part("05", 0, 0)], "venue string, market string, dataset string, variant string, bundle string, grain string, month string, files long, bytes long")
    got = rows(reconcile.matches_catalog(reconcile.archive_files(listing), partitions), "month", "grain", "verdict")
    assert got == [("2024-01", "daily", "complete"), ("2024-02", "daily", "incomplete"), ("2024-03", "daily", "incomplete"), ("2024-04", "daily", "absent"), ("2024-04", "monthly", "complete"), ("2024-05", "daily", "complete")]


def test_recorded_writes(spark, tmp_path):
    """A write that raises leaves its mark the last line; one that ends records what it has seen."""
    import pytest

    from marketloom.sources import scans, sinks

    path = str(tmp_path / "log")
    part = spark.createDataFrame([("p", "r")], "partition string, revision string")

    def broken():
        raise RuntimeError("no room")

    with pytest.raises(RuntimeError):
        sinks.recorded(part, path, broken)
    assert reconcile.ledger_current(scans.read_ledger(spark, path)).count() == 0
    sinks.recorded(part, path, lambda: {"rows": 3, "first": 1, "last": 9})
    line = reconcile.ledger_current(scans.read_ledger(spark, path)).first()
    assert (line.rows, line.first, line.last, line.outdated) == ("3", "1", "9", False)
    with pytest.raises(ValueError, match="has no"):
        sinks.append_ledger(part.withColumn("colour", part.revision), path)


def test_batches_fit(spark):
    p = spark.createDataFrame([("v", "m", str(i), s) for i, s in enumerate([60, 50, 40, 30, 20, 130])], "venue string, month string, partition string, bytes long")
    got = {}
    for r in reconcile.pack_batches(p, 100).collect():
        got.setdefault(r.batch, []).append(r["bytes"])
    assert sorted(map(sorted, got.values())) == [[20, 30, 50], [40, 60], [130]]


def test_listing_page_and_transform(spark):
    keys = spark.createDataFrame([(k, 1) for k in ("a/1", "a/2", "a/2", "a/3", "b/1")], "key string, size long")
    page = catalog.list_page(keys, "a/", "a/1", 1).collect()
    assert [(r.key, r.more) for r in page] == [("a/2", True)]
    asks = spark.createDataFrame([(1, "v", "d", "k", "20240105"), (2, "v", "e", "k", "202401"), (3, "v", "d", "x", "202401")], "ask int, venue string, dataset string, kind string, date string")
    known = spark.createDataFrame([("v", "", "k", "202401", None, "all"), ("v", "d", "k", "20240101", "20240105", "own")], "venue string, dataset string, kind string, `from` string, `to` string, value string")
    assert rows(catalog.resolve_transform(asks, known).fillna("-"), "ask", "value") == [(1, "own"), (2, "all"), (3, "-")]


def test_established_prefix(spark):
    runs = spark.createDataFrame([("", 1, 2), ("x", 3, 4), ("x/y", 5, None), ("z", 6, 7)], "scope string, started_at long, completed_at long")
    prefixes = spark.createDataFrame([("x/q",), ("z/a",), ("x/y/w",)], "prefix string")
    assert rows(catalog.established_at(runs, prefixes), "prefix", "established") == [("z/a", 7)]


def test_batches_are_first_fit_decreasing(spark):
    import random

    rnd = random.Random(3)
    rows = [(v, "m", f"{v}{i}", rnd.randint(1, 120)) for v in "vw" for i in range(60)]
    got = {r.partition: r.batch for r in reconcile.pack_batches(spark.createDataFrame(rows, "venue string, month string, partition string, bytes long"), 100).collect()}
    for v in "vw":
        bins, want = [], {}
        for _, _, name, size in sorted((r for r in rows if r[0] == v), key=lambda r: (-r[3], r[2])):
            at = next((i for i, room in enumerate(bins) if room >= size), len(bins))
            bins += [100] * (at == len(bins))
            bins[at] -= size
            want[name] = at
        assert {k: b for k, b in got.items() if k[0] == v} == want


def test_arrived_neighbour_only_completes(spark):
    from pyspark.sql import functions as F

    from marketloom.functions.names import revision

    kinds = "key string, partition string, rank int, files long, version string, versions array<string>, fields string, on_disk boolean, edges array<struct<id: string, side: string, version: string, here: boolean>>, missing array<string>"
    r = spark.createDataFrame([("k", "p", 0, 3, "v", ["s"], "f", False, [("n", "pre", "e", True)], [])], kinds)
    then = r.select(revision(F.col("versions"), F.col("fields"), F.col("partition"), F.col("version"), F.array().cast("array<struct<id: string, side: string, version: string>>"), F.array(F.lit("pre")))).first()[0]
    ledger = spark.createDataFrame([("k", "p", "v", then, ["pre"])], "key string, partition string, version string, revision string, lacking array<string>")
    assert rows(reconcile.decide(r, ledger), "key", "status", "partition") == [("k", "complete", "p")]
    edited = r.withColumn("versions", F.array(F.lit("s2")))
    assert rows(reconcile.decide(edited, ledger), "key", "status") == [("k", "outdated")]
    assert rows(reconcile.decide(r.withColumn("files", F.lit(0).cast("long")), ledger), "key", "status") == [("k", "waiting")]
