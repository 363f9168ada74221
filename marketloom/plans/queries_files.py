"""Queries that put the given tables into venues' files, archives and workbooks, and normalise them; and that write and keep the vault."""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import lenses, market, reconcile
from marketloom.plans import normalise, views
from marketloom.schema import TABLES
from marketloom.session import scratch, stored, table
from marketloom.sources import scans, sinks

HOUR = market.HOUR


def workbook(rows: list[list]) -> bytes:
    """A workbook of one sheet, all cells texts."""
    cell = lambda r, i, v: f'<c r="{chr(65 + i)}{r}" t="inlineStr"><is><t>{v}</t></is></c>'
    body = "".join(f'<row r="{r}">{"".join(cell(r, i, v) for i, v in enumerate(row))}</row>' for r, row in enumerate(rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def pack(path: str, members: dict[str, str]) -> bytes:
    """An archive of the kind that its path says."""
    out = io.BytesIO()
    if path.endswith(".zip"):
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in members.items():
                z.writestr(name, text)
    elif path.endswith(".tar.gz"):
        with tarfile.open(fileobj=out, mode="w:gz") as t:
            for name, text in members.items():
                info = tarfile.TarInfo(name)
                info.size = len(text.encode())
                t.addfile(info, io.BytesIO(text.encode()))
    else:
        data = "".join(members.values()).encode()
        out.write(gzip.compress(data) if path.endswith(".gz") else data)
    return out.getvalue()


def packed(rows: DataFrame) -> DataFrame:
    """rows (path, member, n, line) as path, content: an archive of each path's members, lines in the order of n; a path ending
    in .xlsx is a workbook of comma-separated cells. An archive is one task's, as it is to its reader."""

    texts = rows.repartition("path").groupBy("path", "member").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("lines"))
    texts = texts.select("path", "member", F.concat(F.array_join("lines.line", "\n"), F.lit("\n")).alias("text"))
    files = texts.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("member", "text"))).alias("held"))
    scans.one_by_one(rows.sparkSession)

    def build(frames):
        for f in frames:
            made = [workbook([x.split(",") for t in texts for x in t.split("\n")[:-1]]) if path.endswith(".xlsx") else pack(path, dict(zip(members, texts))) for path, members, texts in zip(f["path"], f["members"], f["texts"])]
            yield pd.DataFrame({"path": f["path"], "content": made})

    files = files.select("path", F.col("held.member").alias("members"), F.col("held.text").alias("texts"))
    return stored(files.mapInPandas(build, "path string, content binary"), "packed")  # whoever takes them lists, chooses and reads them


def _pick(k: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))


def archives_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in zip, tar.gz, gzip and plain files, a file for each supplier, read back line by line."""
    l = table(spark, sf_dir, "lineitem")
    path = F.concat(F.lit("s"), "l_suppkey", _pick(F.col("l_suppkey"), ".zip", ".tar.gz", ".csv.gz", ".csv"))
    rows = l.select(path.alias("path"), F.concat(F.lit("m"), "l_linenumber").alias("member"), F.col("l_orderkey").alias("n"), F.concat_ws(",", "l_orderkey", "l_partkey").alias("line"))
    lines = scans.scan_archive(packed(rows))
    key = F.split_part("line", F.lit(","), F.lit(1)).cast("bigint")
    return lines.groupBy("archive").agg(F.count("*").alias("lines"), F.sum(key).alias("keys"), F.countDistinct(F.when(F.col("archive").rlike("zip$|tar.gz$"), F.col("member"))).alias("members"))


def sheets_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of each nation in a workbook, a text table or a zipped text table, told apart by their first bytes."""
    scanned = scans.scan_sheets(_sheets(spark, sf_dir), ["C_CUSTKEY", "name", "none"])
    return scanned.select(F.col(scans.FILE).alias("file"), F.col("C_CUSTKEY").cast("bigint").alias("c_custkey"), "name", "none")


def _sheets(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = F.concat(F.lit("n"), "c_nationkey", _pick(F.col("c_nationkey"), ".xlsx", ".csv", ".zip")).alias("path")
    rows = c.select(path, F.lit("a").alias("member"), "c_custkey", F.concat_ws(",", F.col("c_name"), F.col("c_custkey")).alias("line")).withColumnRenamed("c_custkey", "n")
    heads = c.select(path).distinct().select("path", F.lit("a").alias("member"), F.lit(-1).cast("bigint").alias("n"), F.lit("Name,c_custkey").alias("line"))
    return packed(rows.unionByName(heads))


def signatures_sniffed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.split_by_signature(_sheets(spark, sf_dir)).select("path", "kind")


def empties_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without a byte, gzip files of nothing, gzip files and plain ones."""
    c = table(spark, sf_dir, "customer")

    def build(frames):
        for f in frames:
            bodies = [b"" if k % 4 == 0 else gzip.compress(b"" if k % 4 == 1 else n.encode()) if k % 4 < 3 else n.encode() for k, n in zip(f["c_custkey"], f["c_name"])]
            yield pd.DataFrame({"path": "f" + f["c_custkey"].astype(str), "content": bodies})

    return scans.drop_empty(c.select("c_custkey", "c_name").mapInPandas(build, "path string, content binary")).select("path")


def _bars(spark, sf_dir):
    return stored(market.bars(views.ticks(spark, sf_dir), HOUR), "bars")


def _written(spark, rows: DataFrame, columns: list[Column], header: bool = False) -> str:
    path = scratch(spark, "raw")
    rows.select(*columns).write.option("header", header).csv(path)
    return path


def _canonical(spark, sf_dir, key: str, path: str, pattern: str = "part-*") -> dict[str, DataFrame]:
    """The canonical tables of files that all have the name key."""
    venue, _, dataset = key.split("|")[:3]
    files = scans.drop_empty(scans.list_files(spark, path, pattern)).select("path", F.lit(key).alias("key"))
    return normalise.normalise(spark, files, venue, dataset.split(",")[0])


def normalised_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars as six venues publish theirs: other orders of columns, units of time, a zone, rows twice."""
    b = _bars(spark, sf_dir)
    ms, s, zero = F.expr("ts div 1000"), F.expr("ts div 1000000"), F.lit("0")
    turnover = (F.col("volume") * 2).alias("turnover")
    ohlc = [F.col(c) for c in ("open", "high", "low", "close")]
    twice = b.unionByName(b)
    paths = {
        "binance|spot|klines,1h|BTCUSDT|202401.csv": _written(spark, b, [ms.alias("t"), *ohlc, F.col("volume"), zero.alias("x"), turnover, F.col("trades"), zero.alias("y"), zero.alias("z"), zero.alias("w")]),
        "bybit|perp|klines,60m|BTCUSDT|202401.csv": _written(spark, b, [F.date_format(F.timestamp_micros(F.col("ts") + 3 * HOUR), "yyyy.MM.dd HH:mm").alias("t"), *ohlc, F.col("volume")]),
        "gate|spot|klines,1h|BTC_USDT|202401.csv": _written(spark, b, [s.alias("t"), *[F.col(c) for c in ("volume", "close", "high", "low", "open")]]),
        "kucoin|spot|klines,1hour|BTC-USDT|202401.csv": _written(spark, b, [F.col("volume"), *ohlc, turnover, ms.alias("time")], True),
        "htx|spot|klines,60min|BTC-USDT|202401.csv": _written(spark, b, [s.alias("t"), *[F.col(c) for c in ("open", "close", "high", "low")], turnover, F.col("volume")]),
        "okx|spot|klines,1H|@|202401.csv": _written(spark, twice, [F.col("symbol").alias("instrument_name"), *ohlc, F.col("volume").alias("vol"), turnover.alias("vol_ccy"), F.lit("None").alias("vol_quote"), ms.alias("open_time"), F.lit(1).alias("confirm")], True),
    }
    parts = [_canonical(spark, sf_dir, k, p)["klines"].select("venue", "symbol", "ts", "open", "high", "low", "close", "volume", "quoteVolume", "trades", "interval") for k, p in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def normalised_funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as funding rates of five series."""
    t = views.ticks(spark, sf_dir)
    ms, s, rate = F.expr("ts div 1000"), F.expr("ts div 1000000"), F.col("price").alias("rate")
    paths = {
        "binance|perp|funding,realised|BTCUSDT|202401.csv": _written(spark, t, [ms.alias("calc_time"), F.lit(8).alias("funding_interval_hours"), rate.alias("last_funding_rate")], True),
        "kucoin|perp|funding,realised|XBTUSDTM|202401.csv": _written(spark, t, [rate.alias("fundingRate"), ms.alias("time")], True),
        "gate|perp|funding,realised|BTC_USDT|202401.csv": _written(spark, t, [s.alias("t"), rate]),
        "gate|perp|funding,predicted|BTC_USDT|202401.csv": _written(spark, t, [s.alias("t"), rate, *[F.lit("0").alias(f"x{i}") for i in range(6)]]),
        "okx|perp|funding,realised|@|202401.csv": _written(spark, t, [F.col("symbol").alias("instrument_name"), rate.alias("funding_rate"), ms.alias("funding_time")], True),
    }
    parts = [_canonical(spark, sf_dir, k, p)["funding"].select("venue", "symbol", "ts", "rate", "intervalHours", "kind") for k, p in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def normalised_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as levels of order books of three venues: JSON whose levels of price zero are padding, and a table of coded sides."""
    t = views.ticks(spark, sf_dir)
    ms, price, size = F.expr("ts div 1000"), F.col("price").cast("string"), F.col("size").cast("string")
    level = F.array(F.array(price, size), F.array(F.lit("0"), F.lit("0")))
    none = F.array().cast("array<array<string>>")
    even = F.col("sequence") % 2 == 0
    asks, bids = F.when(even, level).otherwise(none), F.when(even, none).otherwise(level)
    kind = F.when(F.col("side") == "signup", "snapshot").otherwise("update")
    bybit, okx = scratch(spark, "raw"), scratch(spark, "raw")
    t.select(F.to_json(F.struct(kind.alias("type"), ms.alias("ts"), F.struct(asks.alias("a"), bids.alias("b"), F.col("sequence").alias("seq")).alias("data"))).alias("value")).write.text(bybit)
    third = lambda side: F.transform(side, lambda x: F.concat(x, F.array(F.lit("3"))))
    t.select(F.to_json(F.struct(F.col("symbol").alias("instId"), kind.alias("action"), ms.cast("string").alias("ts"), third(asks).alias("asks"), third(bids).alias("bids"))).alias("value")).write.text(okx)
    gate = _written(spark, t, [F.concat(F.expr("ts div 1000000"), F.lit("."), F.lpad(F.expr("ts % 1000000").cast("string"), 6, "0")).alias("t"), F.when(even, "1").otherwise("2").alias("s"), F.lit("set").alias("a"), F.col("price"), F.col("size"), F.col("sequence"), F.lit("x").alias("x")])
    paths = {"bybit|perp|books,incremental,500|BTCUSDT|202401.json": bybit, "okx|spot|books,incremental,400|@|202401.json": okx, "gate|spot|books,incremental,full|BTC_USDT|202401.csv": gate}
    parts = [_canonical(spark, sf_dir, k, p)["orderBook"].select("venue", "symbol", "ts", "action", "side", "price", "size", "orderCount", "sequence", "kind", "depth") for k, p in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def normalised_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as whole books: JSON lines among others, lists of pairs and lists of objects."""
    t = views.ticks(spark, sf_dir)
    ms, pair = F.expr("ts div 1000"), F.array(F.array(F.col("price").cast("string"), F.col("size").cast("string")))
    one = F.array(F.struct(F.col("price").cast("string").alias("p"), F.col("size").cast("string").alias("s")))
    none = F.array().cast("array<array<string>>")
    kucoin, spot, perp = (scratch(spark, "raw") for _ in range(3))
    image = F.to_json(F.struct(pair.alias("asks"), none.alias("bids"), ms.alias("timestamp"), F.col("sequence")))
    t.select(F.explode(F.array(image, F.lit("orderbook"))).alias("value")).write.text(kucoin)
    t.select(F.to_json(F.struct(F.col("sequence").alias("id"), ms.cast("string").alias("current"), none.alias("asks"), pair.alias("bids"))).alias("value")).write.text(spot)
    t.select(F.to_json(F.struct(F.col("sequence").alias("id"), ms.cast("string").alias("current"), one.alias("asks"), one.alias("bids"))).alias("value")).write.text(perp)
    paths = {"kucoin|spot|books,snapshot,50|BTC-USDT|202401.csv": kucoin, "gate|spot|books,snapshot,20|BTC_USDT|202401.json": spot, "gate|perp|books,snapshot,20|BTC_USDT|202401.json": perp}
    top = lambda side: [F.try_element_at(F.try_element_at(side, F.lit(1)), F.lit(i)).alias(f"{side}_{n}") for i, n in ((1, "price"), (2, "size"))]
    parts = [_canonical(spark, sf_dir, k, p)["orderBookSnapshot"].select("venue", "market", "ts", *top("asks"), *top("bids"), "sequence", "depth") for k, p in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def normalised_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as option tickers: the time in two columns in one, in the file's name in the other, whose files are plain words."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    binance = _written(spark, p, [F.lit("2024-01-05").alias("date"), (k % 24).alias("hour"), F.concat(F.lit("BTC-"), k).alias("symbol"), F.col("p_retailprice").alias("mark_price"), F.col("p_size").alias("delta")], True)
    one = _canonical(spark, sf_dir, "binance|option|optionSummary,1h|BTCUSDT|202401.csv", binance)["optionTicker"]
    stamp = F.lit(1_704_067_200) + (k % 50) * 60
    path = F.concat(F.lit("gate|option|optionTicker,ticks|@|202401010000.part"), stamp, F.lit(".txt"))
    rows = p.select(path.alias("path"), F.lit("a").alias("member"), k.alias("n"), F.concat_ws("  ", F.concat(F.lit("BTC_USDT-"), k, F.lit("-C")), F.col("p_retailprice"), F.lit("0.5")).alias("line"))
    two = normalise.normalise(spark, packed(rows).withColumn("key", F.col("path")), "gate", "optionTicker")["optionTicker"]
    return reduce(DataFrame.unionByName, [x.select("venue", "symbol", "ts", "option", "markPrice", "delta", "interval") for x in (one, two)])


def normalised_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as quotes: one venue's table, another's workbooks, text tables and zipped tables, with its sign for no number."""
    t = views.ticks(spark, sf_dir)
    ms = F.expr("ts div 1000")
    binance = _written(spark, t, [ms.alias("transaction_time"), F.col("price").alias("best_bid_price"), F.col("size").alias("best_bid_qty"), (F.col("price") + 1).alias("best_ask_price")], True)
    one = _canonical(spark, sf_dir, "binance|perp|quotes|BTCUSDT|202401.csv", binance)["quotes"]
    key = F.concat(F.lit("bitget|perp|quotes|"), F.col("symbol"), F.lit("USDT|202401"), _pick(F.substring("symbol", 2, 10).cast("int"), ".xlsx", ".csv", ".zip"))
    line = F.concat_ws(",", ms.cast("string"), F.when(F.col("side") == "error", "-999999").otherwise(F.col("price").cast("string")), F.col("size").cast("string"))
    rows = t.select(key.alias("path"), F.lit("a").alias("member"), F.col("sequence").alias("n"), line.alias("line"))
    heads = rows.select("path", "member").distinct().select("*", F.lit(-1).cast("bigint").alias("n"), F.lit("Timestamp,bid_price,ask_volume").alias("line"))
    two = normalise.normalise(spark, packed(rows.unionByName(heads)).withColumn("key", F.col("path")), "bitget", "quotes")["quotes"]
    return reduce(DataFrame.unionByName, [x.select("venue", "symbol", "ts", "bidPrice", "bidSize", "askPrice", "askSize", "margin") for x in (one, two)])


def normalised_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as trades in zip and tar archives of a day each: without a header, with one, and empty files among them."""
    t = views.ticks(spark, sf_dir)
    day = F.expr("ts div 86400000000 - 19723")
    stamp = F.concat(F.lit("202401"), F.lpad((day + 1).cast("string"), 2, "0"))
    ms = F.expr("ts div 1000").cast("string")
    plain = t.select(F.concat(F.lit("binance|perp|trades|BTCUSDT|"), stamp, F.lit(".zip")).alias("path"), F.lit("x.csv").alias("member"), F.col("sequence").alias("n"),
                     F.concat_ws(",", "sequence", F.col("price").cast("string"), F.col("size").cast("string"), F.lit(""), ms, (F.col("side") == "click").cast("string")).alias("line"))
    key = F.concat(F.lit("okx|spot|trades|@|"), stamp, _pick(day, ".zip", ".tar.gz", ".csv.gz"))
    named = t.select(key.alias("path"), F.lit("m").alias("member"), F.col("sequence").alias("n"), F.concat_ws(",", F.col("price").cast("string"), "symbol", "sequence", F.when(F.col("side") == "click", "SELL").otherwise("buy"), F.col("size").cast("string"), ms).alias("line"))
    heads = named.select("path", "member").distinct().select("*", F.lit(-1).cast("bigint").alias("n"), F.lit("Price,instrument_name,trade_id,side,size,created_time").alias("line"))
    out = []
    for venue, rows in (("binance", plain), ("okx", named.unionByName(heads))):
        files = packed(rows).withColumn("key", F.col("path"))
        files = files.unionByName(files.select(F.concat("path", F.lit("~")).alias("path"), F.lit(b"").alias("content"), "key"))
        out.append(normalise.normalise(spark, files, venue, "trades")["trades"].select("venue", "symbol", "ts", "tradeId", "price", "size", "side"))
    return reduce(DataFrame.unionByName, out)


def files_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headed files, eight of each kind: sound ones, some with commas inside quotes, ones of a single column and ones whose header is wider than their rows. How
    many rows the bad ones have, and how many cells."""
    c = table(spark, sf_dir, "customer").repartition(8)
    path = scratch(spark, "malformed")
    headed = lambda df, kind, **more: df.write.options(header=True, **more).csv(f"{path}/{kind}")
    headed(c.select("c_custkey", "c_name", "c_acctbal"), "good")
    headed(c.select(F.concat(F.lit('say "x", '), "c_name").alias("said"), "c_custkey"), "quoted", escape='"')
    headed(c.select("c_custkey"), "single")
    headed(c.select(F.concat_ws(",", "c_custkey", "c_name").alias("key,name,more")), "narrow", sep="|")
    found = scans.malformed_files(spark, [f"{path}/{kind}" for kind in ("good", "quoted", "single", "narrow")])
    return found.groupBy(F.regexp_extract(scans.FILE, "/(good|quoted|single|narrow)/", 1).alias("kind")).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.max("header_cells").alias("header_cells"), F.max("most_cells").alias("most_cells"))


def rows_too_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as rows of two cells, every seventh with a third: how many are too wide, and whether a first one is found."""
    s = table(spark, sf_dir, "supplier")
    path = scratch(spark, "wide")
    s.select(F.concat_ws(",", F.col("s_suppkey"), F.lit("a"), F.when(F.col("s_suppkey") % 7 == 0, "more")).alias("value")).write.text(path)
    rows = scans.scan_csv_positional(spark, path, ["k", "a"])
    wide = scans.wide_rows(rows).agg(F.sum("wide").alias("wide"))
    first = scans.first_offender(rows).select(F.lit(1).alias("one"), F.col(scans.OVERFLOW).alias("overflow"))
    return wide.withColumn("one", F.lit(1)).join(first, "one").drop("one")


def times_implausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of customers, half a century early for every eleventh: whose times leave the bounds."""
    o = table(spark, sf_dir, "orders")
    ts = F.unix_micros((F.col("o_orderdate") + F.expr("INTERVAL 25 YEARS")).cast("timestamp"))
    rows = o.select(F.concat(F.lit("C"), "o_custkey").alias("symbol"), F.when(F.col("o_orderkey") % 11 == 0, ts - 50 * 365 * market.DAY).otherwise(ts).alias("ts"))
    return normalise.implausible(rows)


def tables_united(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the customers whose columns differ in case and number."""
    c = table(spark, sf_dir, "customer")
    return lenses.unite([c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("C_CustKey"), "c_name"), c.filter("c_custkey % 2 = 1").select("c_custkey", F.col("c_acctbal").alias("C_ACCTBAL"))])


def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.partition_stats(views.ticks(spark, sf_dir), ["symbol", "side"])


def _trades(spark, sf_dir):
    t = views.ticks(spark, sf_dir)
    made = {"tradeId": F.col("sequence").cast("string"), "price": F.col("price"), "size": F.col("size"), "side": F.col("side")}
    columns = [F.col("ts") if n == "ts" else made.get(n, F.lit(None)).cast(k).alias(n) for n, k in TABLES["trades"]]
    market_of = F.when(F.substring("symbol", 2, 10).cast("int") % 2 == 0, "spot").otherwise("perp")
    return t.select("symbol", *columns, F.lit("events").alias("venue"), market_of.alias("market"), F.lit("false").alias("aggregated"), F.date_format(F.timestamp_micros("ts"), "yyyy-MM").alias("month"))


def vault_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks written as trades by symbol and month, and all of them read back."""
    root = scratch(spark, "vault")
    sinks.write_table(_trades(spark, sf_dir), root, "trades")
    return scans.read_table(spark, root, "trades").select("market", "month", "symbol", "ts", "tradeId", "price", "size", "side")


def layouts_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks written with one market light and the other heavy: the light one's month is one file."""
    rows, root = _trades(spark, sf_dir), scratch(spark, "vault")
    weights = rows.groupBy("venue", "market", "aggregated", "month").agg(F.max(F.when(F.col("market") == "spot", sinks.SPLIT_BYTES).otherwise(1)).alias("bytes"))
    sinks.write_table(rows, root, "trades", weights=weights)
    back = scans.read_table(spark, root, "trades").withColumn("file", F.col("_metadata.file_path"))
    by_file = back.groupBy("market", "month").agg(F.countDistinct("file").alias("files"), F.count("*").alias("rows"))
    return by_file.select("market", "month", F.when(F.col("market") == "perp", F.col("files") == 1).alias("whole"), "rows")


def sides_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of a month with the errors among them stored beside it as its neighbours' hours, and an empty partition; by part."""
    rows, root = _trades(spark, sf_dir), scratch(spark, "vault")
    early = F.col("ts") < 1_705_500_000_000_000
    sinks.write_table(rows.filter("side <> 'error'"), root, "trades")
    sinks.write_sides(rows.filter((F.col("side") == "error") & early), root, "trades", "pre")
    sinks.write_sides(rows.filter((F.col("side") == "error") & ~early), root, "trades", "post")
    sinks.write_empty(spark, root, "trades", venue="events", market="none", aggregated="false", month="2024-01")
    back = scans.read_table(spark, root, "trades")
    held = back.groupBy("market", "part").agg(F.count("*").alias("rows"), F.min("ts").alias("first"))
    empty = scans.list_files(spark, f"{root}/trades", "*.parquet").filter(F.col("path").contains("market=none")).select(F.lit("none").alias("market"), F.lit("own").alias("part"), F.lit(0).cast("long").alias("rows"), F.lit(None).cast("long").alias("first"))
    return held.unionByName(empty)


def partitions_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes of the same ticks into pieces, made one ordered file a partition without the repeats."""
    rows, root = _trades(spark, sf_dir).drop("margin").withColumn("margin", F.lit(None).cast("string")), scratch(spark, "vault")
    for _ in range(2):
        rows.withColumn("part", F.lit("own")).hint("rebalance").write.mode("append").partitionBy("venue", "market", "aggregated", "month", "part").parquet(f"{root}/trades")
    sinks.compact_partitions(scans.read_table(spark, root, "trades"), root, "trades", scratch(spark, "staged"), distinct=True)
    back = scans.read_table(spark, root, "trades").withColumn("file", F.col("_metadata.file_path"))
    # the greatest text, of numbers of one sign and length the one farthest from zero: of texts themselves Spark would sort all rows
    below, far = F.col("tradeId").startswith("-"), F.abs(F.col("tradeId").cast("decimal(20,0)"))
    held = back.groupBy("market", "month", "file", F.length("tradeId").alias("digits"), below.alias("below")).agg(F.count("*").alias("rows"), F.max(far).alias("far"))
    ids = F.concat(F.when(F.col("below"), "-").otherwise(""), F.col("far").cast("string"))
    return held.groupBy("market", "month").agg(F.countDistinct("file").alias("files"), F.sum("rows").alias("rows"), F.max(ids).alias("highest"))


def ledger_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions marked, written and recorded in a log of several files, some of their writes never ended, and what the log then says: those that ended
    with a 1 were adding a side, and of those with a 2 nothing is in the store."""
    p = views.partitions(spark, sf_dir).select(F.concat_ws("/", "venue", "dataset", "month").alias("partition"), F.lit("r1").alias("revision"), F.lit("daily").alias("grain"), F.lit("market").alias("bundle"), F.lit("v").alias("version"),
                                               F.lit("missing").alias("pre_version"), F.lit("e").alias("post_version"))
    path = scratch(spark, "ledger")
    sinks.recorded(p, path, lambda: None)
    sinks.append_ledger(p.filter(F.col("partition").startswith("A")).withColumn("state", F.lit("outdated")), path)
    sinks.append_ledger(p.filter(F.col("partition").startswith("N")).withColumns({"state": F.lit("updating"), "pre_version": F.when(F.col("partition").endswith("1"), "e").otherwise("missing")}), path)
    current = reconcile.ledger_current(scans.read_ledger(spark, path))
    repairs = reconcile.repair_plan(scans.read_ledger(spark, path), p.filter("NOT endswith(partition, '2')")).select("partition", F.lit(None).cast("string").alias("revision"), "action")
    return current.select("partition", "revision", F.when(F.col("outdated"), "outdated").otherwise("current").alias("action")).unionByName(repairs)


def withdrawals_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are gone, as lines of a log that grows by two writes."""
    f = views.catalog_files(spark, sf_dir).filter("existence = 'absent'").select("venue", "path", F.when(F.col("number") % 2 == 1, "withdrawn").otherwise("returned").alias("event"), "size")
    path = scratch(spark, "withdrawn")
    for half in (0, 1):
        sinks.write_withdrawals(f.filter(F.col("size") % 2 == half), path)
    return scans.scan_ndjson(spark, path, "venue string, path string, event string, size bigint").drop(scans.FILE)


def cells_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations with quotes, commas and line breaks put among them, written as CSV and read back."""
    c = table(spark, sf_dir, "conversations")
    text = F.concat(F.lit('"a", '), "text", F.lit(' ""\n;'), F.col("role"))
    path = scratch(spark, "quoted")
    sinks.to_csv(c.select("conv_id", "turn", text.alias("text")), path)
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(path)
    return back.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.md5(F.col("text").cast("binary")).alias("digest"))


def buckets_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as day buckets of two tables, one of free text with line breaks, read back; with what the store lists of each."""
    c = table(spark, sf_dir, "conversations")
    root = scratch(spark, "store")
    days = F.concat(F.lit("2024-01-0"), F.col("conv_id") % 3 + 1)
    for name, text in (("chat", F.concat(F.lit('say "x"\n'), "text")), ("trade", F.regexp_replace("text", '[\\n\\r,"]', " "))):
        for d in (1, 2, 3):
            c.filter(days == f"2024-01-0{d}").select("conv_id", "turn", text.alias("text")).write.options(header=True, escape='"').csv(f"{root}/{name}/2024-01-0{d}")
    sums = scans.list_buckets(spark, root, ".csv").select("table", "days", F.col("first").alias("first_day"), F.col("last").alias("last_day"))
    rows = [scans.read_bucket(spark, f"{root}/{name}/*", name).select(F.lit(name).alias("table"), F.col("conv_id").cast("bigint").alias("conv_id"), "text") for name in ("chat", "trade")]
    held = rows[0].unionByName(rows[1]).groupBy("table").agg(F.count("*").alias("rows"), F.sum("conv_id").alias("ids"), F.sum(F.length("text")).alias("chars"))
    return held.join(sums, "table")


def writes_watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as trades of two series, some without a time, some with one far out, some too wide, written to the vault in one pass that counts them: the facts
    of each series, and of the ledger's line."""
    t = views.ticks(spark, sf_dir)
    root, ledger = scratch(spark, "vault"), scratch(spark, "ledger")
    k = F.col("sequence")
    ms = F.when(k % 10 == 1, "none").when(k % 100 == 2, "1").otherwise(F.expr("cast(ts div 1000 AS string)"))
    spot = _written(spark, t, [k, F.col("price"), F.col("size"), F.lit("0").alias("q"), ms.alias("t"), (F.col("side") == "click").alias("m"), F.lit("x").alias("b"), F.when(k % 7 == 0, "more").alias("w")])
    perp = _written(spark, t.filter(k % 2 == 0), [k, F.col("price"), F.col("size"), F.lit("0").alias("q"), ms.alias("t"), (F.col("side") == "click").alias("m")])
    files = [scans.list_files(spark, p, "part-*").select("path", F.lit(key).alias("key")) for p, key in ((spot, "binance|spot|trades|BTCUSDT|202401.csv"), (perp, "binance|perp|trades|BTCUSDT|202401.csv"))]
    watch = normalise.Watch()

    def write() -> dict:
        sinks.write_table(normalise.normalise(spark, files[0].unionByName(files[1]), "binance", "trades", watch=watch)["trades"], root, "trades")
        facts = watch.facts()
        return {"rows": sum(f["rows"] for f in facts), "first": min(f["first"] for f in facts), "last": max(f["last"] for f in facts)}

    sinks.recorded(spark.createDataFrame([("binance/trades", "r")], "partition string, revision string"), ledger, write)
    names = ["market", "rows", "untimed", "first", "last", "implausible", "wide"]
    seen = spark.createDataFrame([tuple(f[n] for n in names) for f in watch.facts()], "market string, rows long, untimed long, first long, last long, implausible long, wide long")
    line = scans.read_ledger(spark, ledger).filter("state = 'stocked'").select(F.lit("ledger").alias("market"), *[F.col(n).cast("long").alias(n) for n in ("rows",)], F.lit(None).cast("long").alias("untimed"), F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"))
    back = scans.read_table(spark, root, "trades").agg(F.lit("vault").alias("market"), F.count("*").alias("rows"), F.min("ts").alias("first"), F.max("ts").alias("last"))
    return seen.unionByName(line, allowMissingColumns=True).unionByName(back, allowMissingColumns=True)


QUERIES = {f.__name__: f for f in (
    archives_read, sheets_read, signatures_sniffed, empties_dropped, normalised_klines, normalised_funding, normalised_books, normalised_snapshots, normalised_options, normalised_quotes, normalised_archives,
    files_malformed, rows_too_wide, times_implausible, tables_united, partition_stats, vault_month, layouts_written, sides_written, partitions_compacted, ledger_written, withdrawals_logged, cells_quoted, buckets_read, writes_watched)}

_T = views.TICKS
_HB = f"""hb AS (SELECT symbol, ts - ts % {HOUR} AS ts, arg_min(price, (ts, sequence)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, sequence)) AS close, sum(size) AS volume, count(*) AS trades FROM ticks GROUP BY symbol, ts - ts % {HOUR})"""
_DAY = "ts // 86400000000 - 19723"
_MARKET = "CASE WHEN CAST(substr(symbol, 2) AS INT) % 2 = 0 THEN 'spot' ELSE 'perp' END"
_PARTS = f"{views.PARTITIONS}, p AS (SELECT concat_ws('/', venue, dataset, month) AS partition FROM partitions)"
ORACLES = {
    "archives_read": """WITH l AS (SELECT *, 's' || l_suppkey || CASE l_suppkey % 4 WHEN 0 THEN '.zip' WHEN 1 THEN '.tar.gz' WHEN 2 THEN '.csv.gz' ELSE '.csv' END AS archive FROM lineitem)
SELECT archive, count(*) AS lines, sum(l_orderkey)::BIGINT AS keys, CASE WHEN l_suppkey % 4 < 2 THEN count(DISTINCT l_linenumber) ELSE 0 END AS members FROM l GROUP BY archive, l_suppkey""",
    "sheets_read": "SELECT 'n' || c_nationkey || CASE c_nationkey % 3 WHEN 0 THEN '.xlsx' WHEN 1 THEN '.csv' ELSE '.zip' END AS file, c_custkey, c_name AS name, CAST(NULL AS VARCHAR) AS \"none\" FROM customer",
    "signatures_sniffed": "SELECT DISTINCT 'n' || c_nationkey || CASE c_nationkey % 3 WHEN 0 THEN '.xlsx' WHEN 1 THEN '.csv' ELSE '.zip' END AS path, CASE WHEN c_nationkey % 3 = 1 THEN 'text' ELSE 'sheet' END AS kind FROM customer",
    "empties_dropped": "SELECT 'f' || c_custkey AS path FROM customer WHERE c_custkey % 4 >= 2",
    "normalised_klines": f"""WITH {_T}, {_HB}, v AS (SELECT * FROM (VALUES ('binance', 'BTCUSDT', '1h', true, true), ('bybit', 'BTCUSDT', '60m', false, false), ('gate', 'BTC_USDT', '1h', false, false), ('kucoin', 'BTC-USDT', '1hour', true, false), ('htx', 'BTC-USDT', '60min', true, false), ('okx', NULL, '1H', true, false)) AS x(venue, own, interval, q, n))
SELECT venue, coalesce(own, symbol) AS symbol, ts, open, high, low, close, volume, CASE WHEN q THEN volume * 2 END AS "quoteVolume", CASE WHEN n THEN trades END AS trades, interval FROM hb, v""",
    "normalised_funding": f"""WITH {_T}, v AS (SELECT * FROM (VALUES ('binance', 'BTCUSDT', 1000, 8, 'realised'), ('kucoin', 'XBTUSDTM', 1000, NULL, 'realised'), ('gate', 'BTC_USDT', 1000000, NULL, 'realised'), ('gate', 'BTC_USDT', 1000000, NULL, 'predicted'), ('okx', NULL, 1000, NULL, 'realised')) AS x(venue, own, unit, hours, kind))
SELECT venue, coalesce(own, symbol) AS symbol, ts // unit * unit AS ts, price AS rate, hours::BIGINT AS "intervalHours", kind FROM ticks, v""",
    "normalised_books": f"""WITH {_T}, v AS (SELECT * FROM (VALUES ('bybit', 'BTCUSDT', 1000, NULL, 'incremental', '500'), ('okx', NULL, 1000, 3, 'incremental', '400'), ('gate', 'BTC_USDT', 1, NULL, 'incremental', 'full')) AS x(venue, own, unit, orders, kind, depth))
SELECT venue, coalesce(own, symbol) AS symbol, ts // unit * unit AS ts, CASE WHEN venue <> 'gate' AND side = 'signup' THEN 'snapshot' ELSE 'set' END AS action, CASE WHEN sequence % 2 = 0 THEN 'ask' ELSE 'bid' END AS side, price, size, orders::BIGINT AS "orderCount",
 CASE WHEN venue <> 'okx' THEN sequence END AS sequence, kind, depth FROM ticks, v WHERE venue = 'gate' OR price IS DISTINCT FROM 0""",
    "normalised_snapshots": f"""WITH {_T}, v AS (SELECT * FROM (VALUES ('kucoin', 'spot', true, false, '50'), ('gate', 'spot', false, true, '20'), ('gate', 'perp', true, true, '20')) AS x(venue, market, a, b, depth))
SELECT venue, market, ts // 1000 * 1000 AS ts, CASE WHEN a THEN price END AS asks_price, CASE WHEN a THEN size END AS asks_size, CASE WHEN b THEN price END AS bids_price, CASE WHEN b THEN size END AS bids_size, sequence, depth FROM ticks, v""",
    "normalised_options": """SELECT 'binance' AS venue, 'BTCUSDT' AS symbol, 1704412800000000 + p_partkey % 24 * 3600000000 AS ts, 'BTC-' || p_partkey AS option, p_retailprice AS "markPrice", p_size::DOUBLE AS delta, '1h' AS interval FROM part
UNION ALL SELECT 'gate', 'BTC_USDT', (1704067200 + p_partkey % 50 * 60) * 1000000, 'BTC_USDT-' || p_partkey || '-C', p_retailprice, NULL, NULL FROM part""",
    "normalised_quotes": f"""WITH {_T} SELECT 'binance' AS venue, 'BTCUSDT' AS symbol, ts // 1000 * 1000 AS ts, price AS "bidPrice", size AS "bidSize", price + 1 AS "askPrice", CAST(NULL AS DOUBLE) AS "askSize", 'linear' AS margin FROM ticks
UNION ALL SELECT 'bitget', symbol || 'USDT', ts // 1000 * 1000, CASE WHEN side <> 'error' THEN price END, NULL, NULL, size, 'linear' FROM ticks""",
    "normalised_archives": f"""WITH {_T} SELECT 'binance' AS venue, 'BTCUSDT' AS symbol, ts // 1000 * 1000 AS ts, CAST(sequence AS VARCHAR) AS "tradeId", price, size, CASE WHEN side = 'click' THEN 'sell' ELSE 'buy' END AS side FROM ticks
UNION ALL SELECT 'okx', symbol, ts // 1000 * 1000, CAST(sequence AS VARCHAR), price, size, CASE WHEN side = 'click' THEN 'sell' ELSE 'buy' END FROM ticks""",
    "files_malformed": "SELECT kind, 8::BIGINT AS files, count(*) AS rows, h AS header_cells, m AS most_cells FROM customer, (VALUES ('single', 1, 1), ('narrow', 3, 2)) AS x(kind, h, m) GROUP BY kind, h, m",
    "rows_too_wide": "SELECT count(*) AS wide, 'more' AS overflow FROM supplier WHERE s_suppkey % 7 = 0",
    "times_implausible": f"""WITH r AS (SELECT 'C' || o_custkey AS symbol, epoch_us(o_orderdate + INTERVAL 25 YEARS) - CASE WHEN o_orderkey % 11 = 0 THEN {50 * 365 * market.DAY} ELSE 0 END AS ts FROM orders)
SELECT symbol, min(ts) AS first, max(ts) AS last FROM r GROUP BY symbol HAVING min(ts) < epoch_us(TIMESTAMP '2015-01-01') OR max(ts) >= epoch_us(TIMESTAMP '2035-01-01')""",
    "tables_united": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS c_name, CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS c_acctbal FROM customer",
    "partition_stats": f"WITH {_T} SELECT symbol, side, count(*) AS rows, min(ts) AS first, max(ts) AS last FROM ticks GROUP BY ALL",
    "vault_month": f"WITH {_T} SELECT {_MARKET} AS market, strftime(make_timestamp(ts), '%Y-%m') AS month, symbol, ts, CAST(sequence AS VARCHAR) AS \"tradeId\", price, size, side FROM ticks",
    "layouts_written": f"WITH {_T}, m AS (SELECT {_MARKET} AS market, strftime(make_timestamp(ts), '%Y-%m') AS month FROM ticks) SELECT market, month, CASE WHEN market = 'perp' THEN true END AS whole, count(*) AS rows FROM m GROUP BY ALL",
    "sides_written": f"""WITH {_T}, m AS (SELECT *, {_MARKET} AS market, CASE WHEN side <> 'error' THEN 'own' WHEN ts < 1705500000000000 THEN 'pre' ELSE 'post' END AS part FROM ticks)
SELECT market, part, count(*) AS rows, min(ts) AS first FROM m GROUP BY ALL UNION ALL SELECT 'none', 'own', 0, NULL""",
    "partitions_compacted": f"WITH {_T}, m AS (SELECT *, {_MARKET} AS market, strftime(make_timestamp(ts), '%Y-%m') AS month FROM ticks) SELECT market, month, 1::BIGINT AS files, count(*) AS rows, max(CAST(sequence AS VARCHAR)) AS highest FROM m GROUP BY ALL",
    "ledger_written": f"WITH {_PARTS} SELECT partition, CASE WHEN partition NOT LIKE 'N%' THEN 'r1' END AS revision, CASE partition[1] WHEN 'A' THEN 'outdated' WHEN 'N' THEN CASE WHEN partition LIKE '%1' THEN 'undo sides' ELSE 'drop' END ELSE 'current' END AS action FROM p WHERE partition NOT LIKE 'N%2'",
    "writes_watched": f"""WITH {_T}, r AS (SELECT sequence AS k, CASE WHEN sequence % 10 <> 1 THEN CASE WHEN sequence % 100 = 2 THEN 1000000 ELSE ts // 1000 * 1000 END END AS ts FROM ticks), s AS (SELECT 'spot' AS market, * FROM r UNION ALL SELECT 'perp', * FROM r WHERE k % 2 = 0),
f AS (SELECT market, count(ts) AS rows, count(*) FILTER (ts IS NULL) AS untimed, min(ts) AS first, max(ts) AS last, count(*) FILTER (ts < 1420070400000000) AS implausible, count(*) FILTER (market = 'spot' AND k % 7 = 0) AS wide FROM s GROUP BY market)
SELECT * FROM f UNION ALL SELECT m, sum(rows)::BIGINT, NULL, min(first), max(last), NULL, NULL FROM f, (VALUES ('ledger'), ('vault')) AS x(m) GROUP BY m""",
    "withdrawals_logged": f"WITH {views.CATALOG_FILES} SELECT venue, path, CASE WHEN number % 2 = 1 THEN 'withdrawn' ELSE 'returned' END AS event, size FROM catalog_files WHERE existence = 'absent'",
    "cells_quoted": "SELECT conv_id, turn, md5('\"a\", ' || text || ' \"\"' || chr(10) || ';' || role) AS digest FROM conversations",
    "buckets_read": """WITH r AS (SELECT 'chat' AS "table", conv_id, length(text) + 8 AS n FROM conversations UNION ALL SELECT 'trade', conv_id, length(text) FROM conversations)
SELECT "table", count(*) AS rows, sum(conv_id)::BIGINT AS ids, sum(n)::BIGINT AS chars, count(DISTINCT conv_id % 3) AS days, '2024-01-01' AS first_day, '2024-01-03' AS last_day FROM r GROUP BY "table\"""",
}
