"""Queries that write the given tables in venues' forms and read them back through the scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.plans import normalise, views
from marketloom.session import scratch, table
from marketloom.sources import scans


def csv_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items without a header, a column left out and one row in a hundred short."""
    l = table(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    short = F.col("l_orderkey") % 100 == 0
    line = F.concat_ws(",", key, F.col("l_quantity").cast("string"), F.lit("skipped"), F.when(~short, F.col("l_returnflag")))
    path = scratch(spark, "csv")
    l.select(line.alias("value")).write.text(path)
    rows = scans.assert_width(scans.scan_csv_positional(spark, path, ["key", "quantity", "-", "flag"]))
    return rows.select("key", F.col("quantity").try_cast("double").alias("quantity"), "flag")


def csv_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in a thousand files of five headers, which differ in order, case and columns."""
    c = table(spark, sf_dir, "customer").withColumns({"segment": F.col("c_mktsegment"), "extra": F.col("c_acctbal"), "more": F.lit('a,"b"')})
    path = scratch(spark, "named")
    headers = (["c_custkey", "c_name", "segment"], ["SEGMENT", "extra", "C_CustKey"], ["more", "c_name", "extra", "c_custkey", "segment"], ["c_name", "c_custkey"], ["c_custkey", "Segment", "more"])
    for k, names in enumerate(headers):
        c.filter(F.col("c_custkey") % 5 == k).select(*[F.col(n).alias(n) for n in names]).repartition(200).write.option("header", True).option("escape", '"').csv(f"{path}/{k}")
    rows = scans.scan_csv_named(spark, [f"{path}/{k}" for k in range(len(headers))], ["c_custkey", "c_name", "segment"])
    return rows.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "segment")


def ndjson_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines with a field too many, one missing and some broken lines."""
    e = table(spark, sf_dir, "events")
    path = scratch(spark, "json")
    value = F.when(F.col("event_id") % 50 == 7, "broken {").otherwise(F.to_json(F.struct("event_id", F.col("value").cast("string").alias("value"), F.lit(1).alias("other"))))
    e.select(value.alias("value")).write.text(path)
    rows = scans.scan_ndjson(spark, path, "event_id bigint, value string, absent string")
    return rows.filter("event_id IS NOT NULL").select("event_id", F.col("value").try_cast("double").alias("value"), "absent")


def word_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' names and sizes between runs of blanks."""
    p = table(spark, sf_dir, "part")
    path = scratch(spark, "words")
    p.select(F.concat(F.lit("  "), "p_partkey", F.lit(" \t "), "p_brand", F.lit("   "), "p_size", F.lit(" \r")).alias("value")).write.text(path)
    return scans.scan_words(spark, path, ["p_partkey", "p_brand", "p_size", "none"]).select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_brand", F.col("p_size").cast("int").alias("p_size"), F.col("_width").alias("width"))


def normalised_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the raw trade files of three venues, normalised in one form."""
    t = views.ticks(spark, sf_dir)
    path = scratch(spark, "raw")
    of = lambda k: t.filter(F.col("sequence") % 3 == k)
    seconds = F.concat(F.expr("ts div 1000000"), F.lit("."), F.lpad(F.expr("ts % 1000000").cast("string"), 6, "0"))
    of(0).select(F.col("symbol").alias("instrument_name"), F.col("sequence").alias("trade_id"), F.when(F.col("side") == "click", "SELL").otherwise("BUY").alias("side"), "price", "size", F.col("ts").alias("created_time")).write.option("header", True).csv(f"{path}/okx")
    of(1).select(seconds.alias("a"), F.col("sequence").alias("b"), "price", F.when(F.col("side") == "click", -F.col("size")).otherwise(F.col("size")).alias("c")).write.csv(f"{path}/gate")
    of(2).select("sequence", "price", "size", F.lit("").alias("q"), F.expr("ts div 1000").alias("ms"), (F.col("side") == "click").alias("m")).write.csv(f"{path}/binance")
    keys = {"okx": "okx|spot|trades|@|202401.csv", "gate": "gate|perp|trades|BTC_USDT|202401.csv", "binance": "binance|perp|trades|BTCUSDT|202401.csv"}
    out = None
    for venue, key in keys.items():
        files = scans.drop_empty(scans.list_files(spark, f"{path}/{venue}", "*.csv")).select("path", F.lit(key).alias("key"))
        part = normalise.normalise(spark, files, venue, "trades")["trades"].select("venue", "symbol", "ts", "tradeId", "price", "size", "side", "margin")
        out = part if out is None else out.unionByName(part)
    return out


QUERIES = {f.__name__: f for f in (csv_positional, csv_named, ndjson_events, word_scan, normalised_trades)}

ORACLES = {
    "csv_positional": "SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS key, l_quantity AS quantity, CASE WHEN l_orderkey % 100 <> 0 THEN l_returnflag END AS flag FROM lineitem",
    "csv_named": "SELECT c_custkey, CASE WHEN c_custkey % 5 IN (0, 2, 3) THEN c_name END AS c_name, CASE WHEN c_custkey % 5 <> 3 THEN c_mktsegment END AS segment FROM customer",
    "ndjson_events": "SELECT event_id, value, CAST(NULL AS VARCHAR) AS absent FROM events WHERE event_id % 50 <> 7",
    "word_scan": "SELECT p_partkey, p_brand, p_size, 3 AS width FROM part",
    "normalised_trades": f"""WITH {views.TICKS}, t AS (SELECT *, CAST(sequence AS VARCHAR) AS tid, CASE WHEN side = 'click' THEN 'sell' ELSE 'buy' END AS s FROM ticks)
SELECT 'okx' AS venue, symbol, ts, tid AS "tradeId", price, size, s AS side, CAST(NULL AS VARCHAR) AS margin FROM t WHERE sequence % 3 = 0 AND ts >= 1704067200000000 AND ts < 1706745600000000
UNION ALL SELECT 'gate', 'BTC_USDT', ts, tid, price, size, CASE WHEN s = 'sell' AND size > 0 THEN 'sell' ELSE 'buy' END, 'linear' FROM t WHERE sequence % 3 = 1
UNION ALL SELECT 'binance', 'BTCUSDT', ts // 1000 * 1000, tid, price, size, s, 'linear' FROM t WHERE sequence % 3 = 2""",
}
