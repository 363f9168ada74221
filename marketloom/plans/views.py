"""Views of the given tables in the shapes that the operators take, for Spark and for SQL.

Each function makes a DataFrame; the constant of its name in capitals is the same as a SQL CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import table

TICKS = """ticks AS (SELECT epoch_us(ts) AS ts, 'U' || user_id AS symbol, value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size,
  event_type AS side, event_id AS sequence FROM events)"""
CATALOG_FILES = """catalog_files AS (SELECT l_returnflag AS venue, o_orderpriority AS dataset, strftime(l_shipdate, '%Y%m%d') AS date, strftime(l_shipdate, '%Y%m') AS month,
  CAST(l_quantity AS BIGINT) AS size, md5(l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey) AS etag, l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey AS path,
  CASE WHEN l_linestatus = 'O' THEN 'confirmed' WHEN l_linenumber = 1 THEN 'absent' ELSE 'confirmed' END AS existence,
  CASE WHEN l_linenumber % 3 <> 0 THEN l_shipdate END AS downloaded_at, l_suppkey AS series, o_custkey AS owner, l_linenumber AS number
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
PARTITIONS = f"""{CATALOG_FILES}, partitions AS (SELECT venue, dataset, month, count(*) FILTER (existence = 'confirmed') AS files,
  CAST(coalesce(sum(size) FILTER (existence = 'confirmed'), 0) AS BIGINT) AS bytes, count(*) FILTER (existence = 'confirmed' AND downloaded_at IS NULL) AS pending,
  CAST(coalesce(sum(size) FILTER (existence = 'confirmed' AND downloaded_at IS NULL), 0) AS BIGINT) AS pending_bytes, count(*) FILTER (existence = 'absent') AS withdrawn
  FROM catalog_files GROUP BY venue, dataset, month)"""
SERIES = """series AS (SELECT s_suppkey AS series, CASE WHEN s_suppkey % 11 = 0 THEN '@' ELSE 'S' || s_suppkey END AS symbol, CASE s_nationkey % 3 WHEN 0 THEN 'spot' WHEN 1 THEN 'perp' ELSE 'option' END AS market,
  CASE s_suppkey % 4 WHEN 0 THEN 'trades' WHEN 1 THEN 'klines' WHEN 2 THEN 'books' ELSE 'quotes' END AS dataset, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE '1m' END AS variant,
  CASE WHEN s_acctbal > 0 THEN 'daily' ELSE 'monthly' END AS grain, n_name AS host FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
MESSAGES = "messages AS (SELECT conv_id, turn, role, text FROM conversations)"
BOOK_EVENTS = """book_events AS (SELECT epoch_us(ts) AS ts, 'B' || (user_id % 50) AS symbol, CASE event_type WHEN 'signup' THEN 'snapshot' WHEN 'purchase' THEN 'set' WHEN 'view' THEN 'make' WHEN 'click' THEN 'take' ELSE 'set' END AS action,
  CASE WHEN event_id % 2 = 0 THEN 'ask' ELSE 'bid' END AS side, CAST(CASE WHEN event_id % 2 = 0 THEN 100 + user_id % 17 ELSE 99 - user_id % 17 END AS DOUBLE) AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size, event_id AS sequence FROM events)"""


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), F.concat(F.lit("U"), F.col("user_id")).alias("symbol"), F.col("value").alias("price"),
                    F.get_json_object("props", "$.k").cast("double").alias("size"), F.col("event_type").alias("side"), F.col("event_id").alias("sequence"))


def catalog_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    j = l.join(o, l["l_orderkey"] == o["o_orderkey"])
    key = lambda sep: F.concat(F.col("l_orderkey"), F.lit(sep), F.col("l_linenumber"))
    return j.select(
        F.col("l_returnflag").alias("venue"), F.col("o_orderpriority").alias("dataset"), F.date_format("l_shipdate", "yyyyMMdd").alias("date"), F.date_format("l_shipdate", "yyyyMM").alias("month"),
        F.col("l_quantity").cast("long").alias("size"), F.md5(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").cast("binary")).alias("etag"), F.concat(key("/"), F.lit("/"), F.col("l_partkey"), F.lit("/"), F.col("l_suppkey")).alias("path"),
        F.when(F.col("l_linestatus") == "O", "confirmed").when(F.col("l_linenumber") == 1, "absent").otherwise("confirmed").alias("existence"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_shipdate")).alias("downloaded_at"), F.col("l_suppkey").alias("series"), F.col("o_custkey").alias("owner"), F.col("l_linenumber").alias("number"))


def partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.operators.catalog import partition_counters

    return partition_counters(catalog_files(spark, sf_dir), ["venue", "dataset", "month"])


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        F.col("s_suppkey").alias("series"), F.when(F.col("s_suppkey") % 11 == 0, "@").otherwise(F.concat(F.lit("S"), "s_suppkey")).alias("symbol"),
        F.when(F.col("s_nationkey") % 3 == 0, "spot").when(F.col("s_nationkey") % 3 == 1, "perp").otherwise("option").alias("market"),
        F.element_at(F.array(F.lit("trades"), F.lit("klines"), F.lit("books"), F.lit("quotes")), (F.col("s_suppkey") % 4 + 1).cast("int")).alias("dataset"),
        F.when(F.col("s_suppkey") % 2 == 0, "").otherwise("1m").alias("variant"), F.when(F.col("s_acctbal") > 0, "daily").otherwise("monthly").alias("grain"), F.col("n_name").alias("host"))


def book_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    action = F.when(F.col("event_type") == "signup", "snapshot").when(F.col("event_type") == "view", "make").when(F.col("event_type") == "click", "take").otherwise("set")
    even = F.col("event_id") % 2 == 0
    return e.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), F.concat(F.lit("B"), F.col("user_id") % 50).alias("symbol"), action.alias("action"), F.when(even, "ask").otherwise("bid").alias("side"),
                    F.when(even, 100 + F.col("user_id") % 17).otherwise(99 - F.col("user_id") % 17).cast("double").alias("price"), F.get_json_object("props", "$.k").cast("double").alias("size"), F.col("event_id").alias("sequence"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")
