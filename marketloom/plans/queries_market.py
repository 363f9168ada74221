"""Queries over ticks, bars, books and messages, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import names
from marketloom.functions.times import with_us
from marketloom.operators import market, messages
from marketloom.operators.carry import asof_join
from marketloom.plans import views

DAY, HOUR = market.DAY, market.HOUR
_BAR = "arg_min(price, (ts, sequence)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, sequence)) AS close, sum(size) AS volume, count(*) AS trades"
_DAYS = f"days AS (SELECT symbol, ts - ts % {DAY} AS bar, {_BAR} FROM ticks GROUP BY ALL), days2 AS (SELECT symbol, bar AS ts, open, high, low, close, volume, trades FROM days)"
_GAPS = f"CASE WHEN step IS NULL THEN 'first' WHEN step = 0 THEN 'duplicate' WHEN step = {DAY} THEN 'next' ELSE 'gap' END AS continuity"


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.bar_gaps(market.bars(views.ticks(spark, sf_dir), DAY), DAY)


def bars_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.bars(views.ticks(spark, sf_dir), HOUR, "end", carry_open=True)


def bars_coarser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.rebar(market.bars(views.ticks(spark, sf_dir), HOUR), DAY)


def bar_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars against hourly ones summed up, of ticks at or above 1 on one side, so that some differ."""
    ticks = views.ticks(spark, sf_dir)
    return market.audit_bars(market.bars(ticks.filter("price >= 1"), DAY), market.rebar(market.bars(ticks, HOUR), DAY))


def bars_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = market.bars(views.ticks(spark, sf_dir), DAY)
    return market.merge_bars(days, days.filter("trades > 2").withColumn("volume", F.col("volume") * 2))


def side_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.side_impact(views.ticks(spark, sf_dir))


def aggregated_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of one hour and symbol as fills of one time."""
    hour = views.ticks(spark, sf_dir).withColumn("ts", F.expr("ts - pmod(ts, 3600000000)"))
    return market.aggregate_trades(hour)


def quote_at_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = views.ticks(spark, sf_dir)
    trades = ticks.filter("side = 'purchase'").select("symbol", "ts", "sequence", "price")
    quotes = ticks.filter("side IN ('view', 'click')").select("symbol", "ts", "sequence", F.col("price").alias("quote"))
    return asof_join(trades, quotes, "symbol", "ts", ["quote"], ["sequence"])


_AT = 1_705_500_000_000_000


def book_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.cumulative_depth(market.book_at(views.book_events(spark, sf_dir), _AT))


def book_tops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.top_of_book(market.book_at(views.book_events(spark, sf_dir), _AT), 5)


def tape_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.latest(views.ticks(spark, sf_dir), 50)


def page_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.newest_page(views.ticks(spark, sf_dir), _AT, 100, 50)


def delta_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a delta stream: signups replace a table, purchases insert, views and clicks update, errors delete."""
    e = views.ticks(spark, sf_dir)
    action = F.when(F.col("side") == "signup", "partial").when(F.col("side") == "purchase", "insert").when(F.col("side") == "error", "delete").otherwise("update")
    rows = e.select(F.concat(F.lit("T"), F.expr("cast(substring(symbol, 2) as int) % 20")).alias("name"), "symbol", action.alias("action"), F.col("sequence").alias("seq"),
                    F.when(F.col("side") != "click", F.col("price")).alias("price"), F.when(F.col("side") != "view", F.col("size")).alias("size"))
    return market.table_state(rows, "name", ["symbol"], ["price", "size"])


def clock_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written in seven ways, and what is read back from each."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    secs, rest = F.expr("us div 1000000"), F.lpad(F.expr("us % 1000000").cast("string"), 6, "0")
    texts = F.array(secs.cast("string"), F.expr("us div 1000").cast("string"), F.col("us").cast("string"), F.concat("us", F.lit("600")), F.concat(secs, F.lit("."), rest),
                    F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd HH:mm:ss"), F.date_format(F.timestamp_micros("us"), "yyyy.MM.dd HH:mm"), F.lit("12:30"), F.lit("1.2.3"))
    rows = e.select("event_id", us.alias("us")).select("event_id", F.posexplode(texts).alias("form", "text"))
    return with_us(rows, F.col("text"), "ts").select("event_id", "form", "text", "ts")


def repeats_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.flag_repeats(_log(spark, sf_dir), 500)


def repeats_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.dedup_report(_log(spark, sf_dir))


def _log(spark, sf_dir):
    """Ticks as a message log: content is what is traded, rounded so that some repeat; every seventh arrives late."""
    t = views.ticks(spark, sf_dir)
    return t.select(F.concat(F.lit("S"), F.col("sequence") % 4).alias("source"), F.col("side").alias("table"), F.expr("ts div 86400000000").alias("day"), F.col("sequence").alias("arrival"),
                    F.when(F.col("sequence") % 7 == 0, F.col("ts") - 600_000_000).otherwise(F.col("ts")).alias("ts"), F.concat_ws("|", F.expr("cast(floor(price / 10) as bigint)"), F.expr("cast(floor(size / 20) as bigint)")).alias("content"))


_LOG = f"""log AS (SELECT 'S' || sequence % 4 AS source, side AS "table", ts // {DAY} AS day, sequence AS arrival, CASE WHEN sequence % 7 = 0 THEN ts - 600000000 ELSE ts END AS ts,
  CAST(floor(price / 10) AS BIGINT) || '|' || CAST(floor(size / 20) AS BIGINT) AS content FROM ticks),
clocked AS (SELECT *, max(ts) OVER (PARTITION BY source, "table", day ORDER BY arrival ROWS UNBOUNDED PRECEDING) AS clock, row_number() OVER (PARTITION BY source, "table", day, content ORDER BY arrival) > 1 AS repeat FROM log)"""


def messages_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as messages: encoded to rows with a marked first one, regrouped, and counted."""
    from marketloom.sources.sinks import encode_messages

    turns = views.conversations(spark, sf_dir)
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.length("text").alias("length")))).alias("data"))
    sent = grouped.select(F.col("conv_id").alias("seq"), F.concat(F.lit("d"), "conv_id").alias("date"), F.lit("insert").alias("action"), "data")
    rows = encode_messages(sent, ["turn", "role", "length"]).select(F.expr("cast(seq % 8 as string)").alias("file"), (F.col("seq") * 1_000_000 + F.col("row")).alias("line"), "_date_", "_action_", "turn", "role", "length")
    back = messages.decode_messages(rows, ["turn", "role", "length"])
    return back.select(F.expr("cast(substring(date, 2) as bigint)").alias("conv_id"), "file", "message", "action", F.size("data").alias("turns"), F.aggregate("data", F.lit(0).cast("bigint"), lambda a, x: a + x["length"].cast("bigint")).alias("chars"))


def message_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = views.ticks(spark, sf_dir)
    grouped = t.groupBy(F.expr("sequence div 25").alias("message")).agg(F.collect_list(F.struct(F.col("ts").alias("timestamp"), "sequence")).alias("data"), F.min("ts").alias("received"))
    return messages.event_day(grouped).select("message", "event_ts", "day")


def side_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forms in which venues write a side, and the sentinel that stands for no number."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    signed = F.when(F.col("p_partkey") % 3 == 0, -F.col("p_retailprice")).otherwise(F.col("p_retailprice")).cast("string")
    return p.select("p_partkey", names.side_of_flag(F.col("p_partkey") % 2).alias("by_flag"), names.side_of_code((F.col("p_partkey") % 3).cast("string")).alias("by_code"), names.side_of_sign(signed).alias("by_sign"),
                    names.unsentinel(F.when(F.col("p_size") == 7, "-999999").otherwise(signed)).alias("price"), names.first_number(F.col("p_brand"), F.col("p_size").cast("string")).alias("first_number"))


QUERIES = {f.__name__: f for f in (bars_daily, bars_running, bars_coarser, bar_audit, bars_merged, side_impact, aggregated_trades, quote_at_trade, book_now, book_tops, tape_latest, page_newest,
                                   delta_state, clock_texts, repeats_flagged, repeats_report, messages_round_trip, message_days, side_words)}

_BOOK = f"""{views.BOOK_EVENTS}, past AS (SELECT * FROM book_events WHERE ts <= {_AT}), images AS (SELECT symbol, max(ts) AS image FROM past WHERE action = 'snapshot' GROUP BY symbol),
live AS (SELECT p.* FROM past p LEFT JOIN images i USING (symbol) WHERE image IS NULL OR ts >= image),
lev AS (SELECT symbol, side, price, max((ts, sequence)) FILTER (action IN ('snapshot', 'set')) AS seen_at, arg_max(size, (ts, sequence)) FILTER (action IN ('snapshot', 'set')) AS last FROM live GROUP BY ALL),
mov AS (SELECT symbol, side, price, sum(CASE action WHEN 'make' THEN l.size ELSE -l.size END) AS moved FROM live l JOIN lev USING (symbol, side, price) WHERE action IN ('make', 'take') AND (seen_at IS NULL OR (ts, sequence) > seen_at) GROUP BY ALL),
book AS (SELECT symbol, side, price, coalesce(last, 0) + coalesce(moved, 0) AS size FROM lev LEFT JOIN mov USING (symbol, side, price) WHERE coalesce(last, 0) + coalesce(moved, 0) > 0)"""
_BEST = "CASE WHEN side = 'ask' THEN price ELSE -price END"
ORACLES = {
    "bars_daily": f"WITH {views.TICKS}, {_DAYS}, s AS (SELECT *, ts - lag(ts) OVER (PARTITION BY symbol ORDER BY ts) AS step FROM days2) SELECT *, {_GAPS} FROM s",
    "bars_running": f"WITH {views.TICKS}, b AS (SELECT symbol, ((ts + {HOUR - 1}) // {HOUR}) * {HOUR} AS bar, {_BAR} FROM ticks GROUP BY ALL) "
    "SELECT symbol, bar AS ts, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY bar), open) AS open, high, low, close, volume, trades FROM b",
    "bars_coarser": f"WITH {views.TICKS}, {_DAYS} SELECT * FROM days2",
    "bar_audit": f"""WITH {views.TICKS}, {_DAYS}, pub AS (SELECT symbol, ts - ts % {DAY} AS ts2, {_BAR} FROM ticks WHERE price >= 1 GROUP BY ALL)
SELECT coalesce(p.symbol, s.symbol) AS symbol, coalesce(ts2, s.ts) AS ts, CASE WHEN p.symbol IS NULL THEN 'unpublished' WHEN s.symbol IS NULL THEN 'unexplained'
 WHEN p.open IS DISTINCT FROM s.open OR p.high IS DISTINCT FROM s.high OR p.low IS DISTINCT FROM s.low OR p.close IS DISTINCT FROM s.close OR p.volume IS DISTINCT FROM s.volume THEN 'differs' ELSE 'equal' END AS verdict,
 concat_ws(',', CASE WHEN p.open IS DISTINCT FROM s.open THEN 'open' END, CASE WHEN p.high IS DISTINCT FROM s.high THEN 'high' END, CASE WHEN p.low IS DISTINCT FROM s.low THEN 'low' END,
 CASE WHEN p.close IS DISTINCT FROM s.close THEN 'close' END, CASE WHEN p.volume IS DISTINCT FROM s.volume THEN 'volume' END) AS fields
FROM pub p FULL JOIN days2 s ON p.symbol = s.symbol AND ts2 = s.ts""",
    "bars_merged": f"WITH {views.TICKS}, {_DAYS} SELECT symbol, ts, open, high, low, close, CASE WHEN trades > 2 THEN volume * 2 ELSE volume END AS volume, trades FROM days2",
    "side_impact": f"WITH {views.TICKS}, n AS (SELECT side, lead(price) OVER (PARTITION BY symbol ORDER BY ts, sequence) - price AS step FROM ticks) "
    "SELECT side, count(*) AS trades, count(*) FILTER (step > 0) AS up, count(*) FILTER (step < 0) AS down, count(*) FILTER (step = 0) AS flat FROM n GROUP BY side",
    "aggregated_trades": f"""WITH {views.TICKS}, h AS (SELECT symbol, ts - ts % {HOUR} AS ts, price, size, side, sequence FROM ticks),
n AS (SELECT *, CASE WHEN lag((side, price)) OVER w IS NOT DISTINCT FROM (side, price) THEN 0 ELSE 1 END AS fresh FROM h WINDOW w AS (PARTITION BY symbol, ts ORDER BY sequence)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol, ts ORDER BY sequence ROWS UNBOUNDED PRECEDING) AS island FROM n)
SELECT symbol, ts, any_value(side) AS side, any_value(price) AS price, sum(size) AS size, count(*) AS fills, min(sequence) AS first_sequence FROM i GROUP BY symbol, ts, island""",
    "quote_at_trade": f"""WITH {views.TICKS}, t AS (SELECT symbol, ts, sequence, price FROM ticks WHERE side = 'purchase'), q AS (SELECT symbol, ts, sequence, price AS quote FROM ticks WHERE side IN ('view', 'click'))
SELECT symbol, ts, sequence, price, (SELECT arg_max(quote, (q.ts, q.sequence)) FROM q WHERE q.symbol = t.symbol AND q.ts <= t.ts) AS quote FROM t""",
    "book_now": f"WITH {_BOOK} SELECT *, sum(size) OVER (PARTITION BY symbol, side ORDER BY {_BEST} DESC ROWS UNBOUNDED PRECEDING) AS depth FROM book",
    "book_tops": f"""WITH {_BOOK}, top AS (SELECT *, row_number() OVER (PARTITION BY symbol, side ORDER BY {_BEST}) AS n FROM book)
SELECT symbol, max(price) FILTER (side = 'bid') AS best_bid, min(price) FILTER (side = 'ask') AS best_ask, count(*) FILTER (side = 'bid') AS bid_levels, count(*) FILTER (side = 'ask') AS ask_levels,
 min(price) FILTER (side = 'ask') - max(price) FILTER (side = 'bid') AS spread FROM top WHERE n <= 5 GROUP BY symbol""",
    "tape_latest": f"WITH {views.TICKS} SELECT * FROM ticks ORDER BY ts DESC, sequence DESC LIMIT 50",
    "page_newest": f"WITH {views.TICKS} SELECT *, count(*) OVER () AS total FROM ticks WHERE ts <= {_AT} ORDER BY ts DESC, sequence DESC LIMIT 100 OFFSET 50",
    "delta_state": f"""WITH {views.TICKS}, r AS (SELECT 'T' || CAST(substr(symbol, 2) AS INT) % 20 AS name, symbol, CASE side WHEN 'signup' THEN 'partial' WHEN 'purchase' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS action,
 sequence AS seq, CASE WHEN side <> 'click' THEN price END AS price, CASE WHEN side <> 'view' THEN size END AS size FROM ticks),
f AS (SELECT name, max(seq) AS since FROM r WHERE action = 'partial' GROUP BY name), live AS (SELECT r.* FROM r LEFT JOIN f USING (name) WHERE since IS NULL OR seq >= since),
b AS (SELECT name, symbol, max(seq) FILTER (action IN ('partial', 'insert')) AS born, max(seq) FILTER (action = 'delete') AS died FROM live GROUP BY ALL)
SELECT name, symbol, arg_max(price, seq) AS price, arg_max(size, seq) AS size FROM live JOIN b USING (name, symbol) WHERE born IS NOT NULL AND (died IS NULL OR died < born) AND seq >= born AND action <> 'delete' GROUP BY ALL""",
    "clock_texts": """WITH e AS (SELECT event_id, epoch_us(ts) AS us, date_trunc('second', ts) AS s, date_trunc('minute', ts) AS m FROM events)
SELECT event_id, 0 AS form, CAST(us // 1000000 AS VARCHAR) AS text, us // 1000000 * 1000000 AS ts FROM e UNION ALL SELECT event_id, 1, CAST(us // 1000 AS VARCHAR), us // 1000 * 1000 FROM e
UNION ALL SELECT event_id, 2, CAST(us AS VARCHAR), us FROM e UNION ALL SELECT event_id, 3, us || '600', us + 1 FROM e
UNION ALL SELECT event_id, 4, (us // 1000000) || '.' || lpad(CAST(us % 1000000 AS VARCHAR), 6, '0'), us FROM e
UNION ALL SELECT event_id, 5, strftime(s, '%Y-%m-%d %H:%M:%S'), epoch_us(s) FROM e UNION ALL SELECT event_id, 6, strftime(m, '%Y.%m.%d %H:%M'), epoch_us(m) FROM e
UNION ALL SELECT event_id, 7, '12:30', NULL FROM e UNION ALL SELECT event_id, 8, '1.2.3', NULL FROM e""",
    "repeats_flagged": f"WITH {views.TICKS}, {_LOG} SELECT *, repeat AND clock - ts >= 500000 AS dropped FROM clocked",
    "repeats_report": f"""WITH {views.TICKS}, {_LOG}, g AS (SELECT source, day, count(*) AS original, count(*) FILTER (repeat AND clock - ts >= 0) AS dropped_t0, count(*) FILTER (repeat AND clock - ts >= 500000) AS dropped_wide FROM clocked GROUP BY ROLLUP (source, day)),
h AS (SELECT *, original - dropped_wide AS kept, dropped_t0 - dropped_wide AS effect, round(100.0 * dropped_t0 / original, 6)::DOUBLE AS percent FROM g)
SELECT *, percent > 2 * min(percent) FILTER (source IS NOT NULL) OVER (PARTITION BY day) AS outlier FROM h""",
    "messages_round_trip": f"""WITH g AS (SELECT conv_id, count(*) AS turns, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY conv_id)
SELECT conv_id, CAST(conv_id % 8 AS VARCHAR) AS file, row_number() OVER (PARTITION BY conv_id % 8 ORDER BY conv_id) AS message, 'insert' AS action, turns, chars FROM g""",
    "message_days": f"WITH {views.TICKS} SELECT sequence // 25 AS message, max(ts) AS event_ts, max(ts) // {DAY} AS day FROM ticks GROUP BY 1",
    "side_words": """SELECT p_partkey, CASE WHEN p_partkey % 2 = 1 THEN 'sell' ELSE 'buy' END AS by_flag, CASE p_partkey % 3 WHEN 1 THEN 'buy' WHEN 2 THEN 'sell' END AS by_code, CASE WHEN p_partkey % 3 = 0 AND p_retailprice > 0 THEN 'sell' ELSE 'buy' END AS by_sign,
 CASE WHEN p_size = 7 THEN NULL WHEN p_partkey % 3 = 0 THEN -p_retailprice ELSE p_retailprice END AS price, p_size::DOUBLE AS first_number FROM part""",
}
