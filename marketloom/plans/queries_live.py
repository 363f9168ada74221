"""Queries that play the given tables as streams, in rounds of several files each, and over message logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.functions import names
from marketloom.operators import messages
from marketloom.plans import views
from marketloom.session import scratch
from marketloom.streaming import streams

ROUNDS, FILES = 3, 4


def _played(rows: DataFrame, order: str, start: Callable[[DataFrame, str], object]) -> str:
    """Plays rows as a stream in ROUNDS rounds, by ranges of `order`: each is dealt over FILES files in no order, and read by a run
    of its own from where the one before it ended. start takes the stream and its checkpoint, which is returned."""
    spark = rows.sparkSession
    path, state = scratch(spark, "feed"), scratch(spark, "state")
    cuts = rows.agg(F.percentile_approx(order, [i / ROUNDS for i in range(1, ROUNDS)], 10_000)).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]
    for low, high in zip(edges, edges[1:]):
        part = rows if low is None else rows.filter(F.col(order) > low)
        part = part if high is None else part.filter(F.col(order) <= high)
        part.repartition(FILES).write.mode("append").parquet(path)
        stream = streams.stream_frames(spark, path, rows.schema, "parquet", 1_000_000)
        start(stream, state).awaitTermination()
    return state


def _drained(rows: DataFrame, order: str, build: Callable[[DataFrame], DataFrame], mode: str = "append") -> DataFrame:
    """All that a stream made of rows gives, from a table in the shared folder, a folder for each batch."""
    spark, out, kinds = rows.sparkSession, scratch(rows.sparkSession, "out"), []

    def start(stream, state):
        made = build(stream)
        kinds.append(made.schema)
        return made.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(lambda f, n: f.write.mode("overwrite").parquet(f"{out}/batch={n}")).start()

    _played(rows, order, start)
    return spark.read.schema(kinds[0]).parquet(out).select(*kinds[0].names)


def stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running daily bars of a stream, those that its watermark has closed, each opening at the close before it."""
    t = views.ticks(spark, sf_dir).withColumn("time", F.timestamp_micros("ts")).select("symbol", "time", "price", "size", "sequence")
    out, kinds = scratch(spark, "bars"), []

    def start(stream, state):
        bars = streams.running_bars(stream, "1 day")
        kinds.append(bars.schema)
        return streams.carried_bars(bars, lambda f, n: f.write.mode("overwrite").parquet(f"{out}/batch={n}"), state)

    _played(t, "sequence", start)
    rows = spark.read.schema(kinds[0]).parquet(out)
    return rows.select("symbol", F.unix_micros("time").alias("ts"), "open", "high", "low", "close", "volume", "trades")


def stream_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message stream less the repeats that the clock of their source, table and day is half a second past."""
    from marketloom.plans.queries_market import _log

    return _drained(_log(spark, sf_dir), "arrival", lambda s: streams.dedup_clocked(s, 500))


def stream_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of contents by source, of which one of each comes through: how many there are."""
    from marketloom.plans.queries_market import _log

    rows = _log(spark, sf_dir).select("source", "content", "arrival", F.timestamp_micros("ts").alias("time"))
    kept = _drained(rows, "arrival", lambda s: streams.dedup_exact(s.drop("arrival"), "90 days"))
    return kept.select("source", "content")


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a delta stream over many tables leaves."""
    e = views.ticks(spark, sf_dir)
    action = F.when(F.col("side") == "signup", "partial").when(F.col("side") == "purchase", "insert").when(F.col("side") == "error", "delete").otherwise("update")
    rows = e.select(F.concat(F.lit("T"), F.expr("cast(substring(symbol, 2) as int) % 20")).alias("name"), action.alias("action"), F.col("symbol").alias("key"), F.col("price").alias("value"), F.col("sequence").alias("seq"))
    return streams.current_state(_drained(rows, "seq", lambda s: streams.table_state(s, "name", "key", "value"), "update"), "name", "key", "value")


def stream_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty newest trades of a stream that comes newest half first."""
    out = scratch(spark, "tape")
    rows = views.ticks(spark, sf_dir).withColumn("place", -F.col("sequence"))
    _played(rows, "place", lambda s, state: streams.tape(s, 50, lambda f, n: f.write.mode("overwrite").parquet(out), state))
    return spark.read.parquet(out).drop("place")


def stream_tapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five newest trades of every symbol of a stream that comes newest third first."""
    rows, out = views.ticks(spark, sf_dir).withColumn("order", -F.col("sequence")), scratch(spark, "tapes")
    kinds = []

    def start(stream, state):
        tapes = streams.tape_by_symbol(stream, 5)
        kinds.append(tapes.schema)
        return tapes.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(lambda f, n: f.write.mode("overwrite").parquet(f"{out}/batch={n}")).start()

    _played(rows, "order", start)
    given = spark.read.schema(kinds[0]).parquet(out).withColumn("_batch", F.regexp_extract("_metadata.file_path", r"batch=(\d+)/", 1).cast("int"))
    newest = given.groupBy("symbol").agg(F.max("_batch").alias("_batch"))
    return given.join(newest, ["symbol", "_batch"]).select("symbol", "place", "ts", "sequence", "price", "size", "side")


def _frames(spark, sf_dir):
    t = views.ticks(spark, sf_dir)
    venue = F.element_at(F.array(*[F.lit(v) for v in ("binance", "bybit", "okx", "kraken", "gate")]), (F.col("sequence") % 5 + 1).cast("int"))
    data = (F.when(venue == "binance", '{"e":"trade"}').when(venue == "bybit", '{"topic":"t","data":[1]}').when(venue == "okx", '{"arg":{"a":1},"data":[1]}').when(venue == "kraken", '{"channel":"trade","data":[1]}').otherwise('{"data":1}'))
    beat = F.when(venue == "kraken", '{"channel":"heartbeat","data":[1]}').when(venue == "okx", "pong").otherwise('{"result":null}')
    return t.select(venue.alias("venue"), F.lit("live").alias("source"), F.concat(F.lit("trade."), F.col("side"), F.lit(".trade")).alias("key"), F.when(F.col("side") == "error", beat).otherwise(data).alias("value"), "sequence")


def stream_relayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of five venues relayed, told from control frames: how many of each."""
    out = _drained(_frames(spark, sf_dir), "sequence", lambda s: streams.relay(s, "me").withColumn("data", F.coalesce(streams.is_data(F.col("venue"), F.col("value")), F.lit(False))))
    return out.groupBy("venue", "collector", "data").agg(F.count("*").alias("frames"), F.count("collected_at").alias("stamped"), F.min("value").alias("value"))


def stream_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames that carry data, fanned out by rules into folders, counted by destination and key."""
    rules = spark.createDataFrame([("live", "all", None, None, None, {"x": "1"}), ("live", "one", "fixed", None, None, None), ("live", "named", None, "trade.", "t/", None)], "source string, destination string, fixed string, find string, put string, headers map<string, string>")
    root = scratch(spark, "routes")
    _played(_frames(spark, sf_dir), "sequence", lambda s, state: streams.write_routes(streams.split_control(s)[0], rules, root, state))
    return spark.read.parquet(root).groupBy("destination", "key").agg(F.count("*").alias("frames"), F.count("headers").alias("headed"))


def stream_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages put into buckets by the day of their newest row, sealed, and read back."""
    t = views.ticks(spark, sf_dir)
    grouped = t.groupBy(F.expr("sequence div 25").alias("message")).agg(F.collect_list(F.struct(F.col("ts").alias("timestamp"), "sequence")).alias("data"), F.min("ts").alias("received"))
    rows = grouped.select(F.concat(F.lit("t"), F.col("message") % 3).alias("table"), "received", F.when(F.col("message") % 4 != 0, F.col("data")).otherwise(F.array().cast("array<struct<timestamp:bigint,sequence:bigint>>")).alias("data"), "message")
    root, sealed = scratch(spark, "buckets"), scratch(spark, "sealed")
    _played(rows, "message", lambda s, state: streams.stream_to_buckets(streams.route_by_event_day(s), root, state, None))
    streams.seal_bucket(spark.read.parquet(root), sealed, ["message"])
    return spark.read.parquet(sealed).groupBy("table", F.col("day").cast("string").alias("day")).agg(F.count("*").alias("messages"), F.sum("message").alias("numbers"))


#: A time that closes the streams of stream_sides: what waits in them is decided then.
_CLOSED = "2030-01-01 00:00:00"


def stream_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of the two days on either side of each week's edges as sides of the week, taken for a month, played a round after the weeks they belong
    to: which were accepted, and which came too late, as every fiftieth does by weeks, and as those of a week without rows do."""
    t = views.ticks(spark, sf_dir)
    day = F.expr("ts div 86400000000 - 19723")
    week = F.floor(day / 7)
    months = t.groupBy("symbol", week.alias("month")).agg(F.min("ts").alias("first"), F.max("ts").alias("last")).withColumn("at", F.timestamp_micros(((F.col("month") + 1) * 7 + 19723) * 86_400_000_000))
    reach = F.expr("explode(array(named_struct('by', -1, 'side', 'post', 'a', 0, 'b', 1), named_struct('by', 1, 'side', 'pre', 'a', 5, 'b', 6), named_struct('by', 0, 'side', 'pre', 'a', 0, 'b', 0)))")
    sides = t.withColumn("r", reach).filter((day % 7).isin(F.col("r.a"), F.col("r.b"))).select(
        "symbol", (week + F.col("r.by")).alias("month"), F.col("r.side").alias("side"), "ts", "sequence", F.timestamp_micros(F.col("ts") + F.when(F.col("sequence") % 50 == 7, 60 * 86_400_000_000).otherwise(0)).alias("at"))
    feeds = {name: scratch(spark, name) for name in ("weeks", "sides")}
    state, accepted, late = scratch(spark, "state"), scratch(spark, "accepted"), scratch(spark, "late")
    edges = ["2000-01-01", "2024-01-12", "2024-01-24", "2024-03-05", "2029-01-01"]
    for k in range(len(edges) + 1):  # weeks of round k, sides of the round before, and at last a row that says how late it is
        for name, rows, back in (("weeks", months, 0), ("sides", sides, 1)):
            if 0 <= k - back < len(edges) - 1:
                rows.filter((F.col("at") >= edges[k - back]) & (F.col("at") < edges[k - back + 1])).repartition(FILES).write.mode("append").parquet(feeds[name])
            elif k == len(edges):
                rows.limit(1).withColumns({"symbol": F.lit(f"end of {name}"), "at": F.lit(_CLOSED).cast("timestamp")}).write.mode("append").parquet(feeds[name])
            else:
                rows.limit(0).write.mode("append").parquet(feeds[name])
        read = lambda name, rows: spark.readStream.schema(rows.schema).parquet(feeds[name])
        streams.write_judged(streams.judge_sides(read("sides", sides), read("weeks", months)), accepted, late, state).awaitTermination()
    out = [spark.read.schema(sides.schema).parquet(root).select("symbol", "month", "side", "ts", "sequence", F.lit(verdict).alias("verdict")) for root, verdict in ((accepted, "accepted"), (late, "late"))]
    return out[0].unionByName(out[1])


def _message_rows(spark, sf_dir):
    turns = views.conversations(spark, sf_dir)
    first = F.col("turn") == F.min("turn").over(Window.partitionBy("conv_id"))
    return turns.select(F.expr("cast(conv_id % 8 as string)").alias("file"), (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("line"), F.when(first, F.concat(F.lit("d"), "conv_id")).otherwise("").alias("_date_"), "role", "conv_id", "turn")


def messages_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as message rows, less the first five messages of each file."""
    return messages.skip_messages(_message_rows(spark, sf_dir), 5).select("file", "conv_id", "turn", "message", "row")


def rows_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of texts, cast by kind."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    even = F.col("event_id") % 2 == 0
    rows = e.select("event_id", F.when(F.col("event_id") % 5 == 0, "").otherwise(F.col("value").cast("string")).alias("price"), F.when(even, "true").otherwise("false").alias("live"), F.when(even, "").otherwise(F.col("event_type")).alias("note"), F.when(even, "").otherwise("x").alias("kept"),
                    F.date_format("ts", "yyyy-MM-dd'D'HH:mm:ss").alias("at"), F.when(even, F.col("props")).otherwise("{no json").alias("props"), F.when(even, F.col("user_id").cast("string")).otherwise("1.5").alias("count"))
    return messages.cast_row(rows, {"price": "float", "live": "boolean", "note": "text", "kept": "keep", "at": "timestamp", "props": "json", "count": "integer"})


def pools_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events against dotted names of tables: their base table and whether the event's pool is theirs."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    name = F.element_at(F.array(F.lit("quote"), F.lit("quote.View"), F.lit("book.click")), (F.col("event_id") % 3 + 1).cast("int"))
    return e.select("event_id", names.base_table(name).alias("base"), names.in_pool(name, F.col("event_type")).alias("in_pool"))


QUERIES = {f.__name__: f for f in (stream_bars, stream_repeats, stream_exact, stream_state, stream_tape, stream_tapes, stream_relayed, stream_routes, stream_buckets, stream_sides, messages_skipped, rows_cast, pools_filtered)}

_T = views.TICKS
_VENUE = "CASE sequence % 5 WHEN 0 THEN 'binance' WHEN 1 THEN 'bybit' WHEN 2 THEN 'okx' WHEN 3 THEN 'kraken' ELSE 'gate' END"
_LOGGED = f"""{_T}, log AS (SELECT 'S' || sequence % 4 AS source, side AS "table", ts // 86400000000 AS day, sequence AS arrival, CASE WHEN sequence % 7 = 0 THEN ts - 600000000 ELSE ts END AS ts, CAST(floor(price / 10) AS BIGINT) || '|' || CAST(floor(size / 20) AS BIGINT) AS content FROM ticks)"""
ORACLES = {
    "stream_bars": f"""WITH {_T}, m AS (SELECT max(ts) - 60000001 AS edge FROM ticks), b AS (SELECT symbol, (ts + 86399999999) // 86400000000 * 86400000000 AS bar, arg_min(price, (ts, sequence)) AS open, max(price) AS high, min(price) AS low,
 arg_max(price, (ts, sequence)) AS close, sum(size) AS volume, count(*) AS trades FROM ticks GROUP BY ALL), k AS (SELECT b.* FROM b, m WHERE bar <= edge)
SELECT symbol, bar AS ts, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY bar), open) AS open, high, low, close, volume, trades FROM k""",
    "stream_repeats": f"""WITH {_LOGGED}, c AS (SELECT *, max(ts) OVER (PARTITION BY source, "table", day ORDER BY arrival ROWS UNBOUNDED PRECEDING) AS clock, row_number() OVER (PARTITION BY source, "table", day, content ORDER BY arrival) > 1 AS repeat FROM log)
SELECT source, "table", day, arrival, ts, content FROM c WHERE NOT (repeat AND clock - ts >= 500000)""",
    "stream_exact": f"WITH {_LOGGED} SELECT DISTINCT source, content FROM log",
    "stream_state": f"""WITH {_T}, r AS (SELECT 'T' || CAST(substr(symbol, 2) AS INT) % 20 AS name, symbol AS key, CASE side WHEN 'signup' THEN 'partial' WHEN 'purchase' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS action, sequence AS seq, price AS value FROM ticks),
f AS (SELECT name, max(seq) AS since FROM r WHERE action = 'partial' GROUP BY name), live AS (SELECT r.* FROM r LEFT JOIN f USING (name) WHERE since IS NULL OR seq >= since),
b AS (SELECT name, key, max(seq) FILTER (action IN ('partial', 'insert')) AS born, max(seq) FILTER (action = 'delete') AS died FROM live GROUP BY ALL)
SELECT name, key, arg_max(value, seq) AS value FROM live JOIN b USING (name, key) WHERE born IS NOT NULL AND (died IS NULL OR died < born) AND seq >= born AND action <> 'delete' GROUP BY ALL""",
    "stream_tape": f"WITH {_T} SELECT * FROM ticks ORDER BY ts DESC, sequence DESC LIMIT 50",
    "stream_tapes": f"WITH {_T} SELECT symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, sequence DESC) AS INTEGER) AS place, ts, sequence, price, size, side FROM ticks QUALIFY place <= 5",
    "stream_relayed": f"""WITH {_T}, f AS (SELECT {_VENUE} AS venue, side <> 'error' AS data FROM ticks)
SELECT venue, 'me' AS collector, data, count(*) AS frames, count(*) AS stamped, CASE WHEN data THEN CASE venue WHEN 'binance' THEN '{{"e":"trade"}}' WHEN 'bybit' THEN '{{"topic":"t","data":[1]}}' WHEN 'okx' THEN '{{"arg":{{"a":1}},"data":[1]}}' WHEN 'kraken' THEN '{{"channel":"trade","data":[1]}}' ELSE '{{"data":1}}' END
 ELSE CASE venue WHEN 'kraken' THEN '{{"channel":"heartbeat","data":[1]}}' WHEN 'okx' THEN 'pong' ELSE '{{"result":null}}' END END AS value FROM f GROUP BY venue, data""",
    "stream_routes": f"""WITH {_T}, d AS (SELECT 'trade.' || side || '.trade' AS key, 't/' || side || '.trade' AS put FROM ticks WHERE side <> 'error')
SELECT 'all' AS destination, key, count(*) AS frames, count(*) AS headed FROM d GROUP BY key UNION ALL SELECT 'one', 'fixed', count(*), 0 FROM d UNION ALL SELECT 'named', put, count(*), 0 FROM d GROUP BY put""",
    "stream_buckets": f"""WITH {_T}, m AS (SELECT sequence // 25 AS message, CASE WHEN sequence // 25 % 4 <> 0 THEN max(ts) ELSE min(ts) END AS us FROM ticks GROUP BY 1)
SELECT 't' || message % 3 AS "table", strftime(make_timestamp(us), '%Y-%m-%d') AS day, count(*) AS messages, sum(message)::BIGINT AS numbers FROM m GROUP BY ALL""",
    "stream_sides": f"""WITH {_T}, d AS (SELECT *, ts // 86400000000 - 19723 AS day FROM ticks), m AS (SELECT symbol, day // 7 AS month, min(ts) AS first, max(ts) AS last, (day // 7 + 1) * 7 AS at FROM d GROUP BY ALL),
r AS (SELECT * FROM (VALUES (-1, 'post', 0, 1), (1, 'pre', 5, 6), (0, 'pre', 0, 0)) t(shift, side, a, b)), s AS (SELECT symbol, day // 7 + shift AS month, r.side, ts, sequence, (ts - 19723 * 86400000000) / 86400000000 + CASE WHEN sequence % 50 = 7 THEN 60 ELSE 0 END AS at FROM d JOIN r ON day % 7 IN (a, b)),
j AS (SELECT s.*, first, last FROM s LEFT JOIN m ON m.symbol = s.symbol AND m.month = s.month AND abs(s.at - m.at) <= 15)
SELECT symbol, month, side, ts, sequence, CASE WHEN first IS NULL THEN 'late' ELSE 'accepted' END AS verdict FROM j WHERE first IS NULL OR CASE side WHEN 'post' THEN ts > last ELSE ts < first END""",
    "messages_skipped": """WITH n AS (SELECT CAST(conv_id % 8 AS VARCHAR) AS file, conv_id, turn, dense_rank() OVER (PARTITION BY conv_id % 8 ORDER BY conv_id) AS message, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS "row" FROM conversations) SELECT * FROM n WHERE message > 5""",
    "rows_cast": """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS price, event_id % 2 = 0 AS live, CASE WHEN event_id % 2 = 1 THEN event_type END AS note, CASE WHEN event_id % 2 = 0 THEN '' ELSE 'x' END AS kept,
 strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at, CASE WHEN event_id % 2 = 0 THEN json(props)::VARCHAR ELSE '{no json' END AS props, CASE WHEN event_id % 2 = 0 THEN user_id END AS count FROM events""",
    "pools_filtered": "SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 'book' ELSE 'quote' END AS base, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN event_type = 'view' ELSE event_type = 'click' END AS in_pool FROM events",
}
