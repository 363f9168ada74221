"""Live frames: relay, control frames, routing, running bars, state of delta tables, repeats, tapes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: Days after which a month's late rows are no longer waited for.
PATIENCE = "15 days"
#: Rows of a bucket that are written even if their time has not come, and of one file.
FLUSH_ROWS = 10_000
#: Buckets that symbols are dealt into by their hash, whose tapes are one entry of the state each.
TAPE_BUCKETS = 2048


def stream_frames(spark: SparkSession, path: str, schema: str = "venue string, value string", form: str = "json", files: int = 100) -> DataFrame:
    """Frames as they arrive in a folder; a deployment reads a broker's topic in its place."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(form).load(path)


def relay(frames: DataFrame, collector: str) -> DataFrame:
    """Frames verbatim, with who collected them and when."""
    return frames.withColumns({"collector": F.lit(collector), "collected_at": F.current_timestamp()})


def is_data(venue: Column, value: Column) -> Column:
    """Whether a frame carries data, or is an answer, a heartbeat or a status."""
    has = lambda path: F.get_json_object(value, path).isNotNull()
    return (F.when(venue == "binance", has("$.e")).when(venue == "bybit", has("$.topic") & has("$.data")).when(venue == "okx", has("$.arg") & has("$.data"))
            .when(venue == "kraken", has("$.channel") & has("$.data") & ~F.get_json_object(value, "$.channel").isin("heartbeat", "status")).otherwise(has("$.data")))


def split_control(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    data = F.coalesce(is_data(F.col("venue"), F.col("value")), F.lit(False))
    return frames.filter(data), frames.filter(~data)


def route(frames: DataFrame, rules: DataFrame) -> DataFrame:
    """A frame for each rule whose source it is from: destination, key and headers. A rule's key is fixed, or replaces the first
    occurrence of a text in the frame's own key, or passes it through. rules is written by hand and static."""
    f, r = frames.alias("f"), rules.alias("r")
    at = F.expr("locate(r.find, f.key)")
    replaced = F.when(at > 0, F.expr("overlay(f.key PLACING r.put FROM locate(r.find, f.key) FOR length(r.find))")).otherwise(F.col("f.key"))
    key = F.when(F.col("r.fixed").isNotNull(), F.col("r.fixed")).when(F.col("r.find").isNotNull(), replaced).otherwise(F.col("f.key"))
    return f.join(r, F.col("f.source") == F.col("r.source")).select(F.col("r.destination").alias("destination"), key.alias("key"), F.col("r.headers").alias("headers"), F.col("f.value").alias("value"))


def write_routes(frames: DataFrame, rules: DataFrame, root: str, checkpoint: str):
    """Each destination's frames to a folder of its own."""
    return route(frames, rules).writeStream.format("parquet").partitionBy("destination").option("path", root).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_bars(ticks: DataFrame, width: str, late: str = "1 minute") -> DataFrame:
    """Bars of symbol and (start, end], stamped at their end, from a stream of ticks (symbol, time, price, size, sequence)."""
    order = F.struct("time", "sequence")
    shifted = ticks.withColumn("_at", F.col("time") - F.expr("INTERVAL 1 MICROSECOND")).withWatermark("_at", late)
    out = shifted.groupBy("symbol", F.window("_at", width).alias("w")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("size").alias("volume"), F.count("*").alias("trades"))
    return out.select("symbol", F.col("w.end").alias("time"), "open", "high", "low", "close", "volume", "trades")


def _carried(spark: SparkSession, folder: str, number: int, schema) -> DataFrame:
    """What batch `number` - 1 left in folder; nothing before the first."""
    return spark.read.schema(schema).parquet(f"{folder}/{number - 1}") if number else spark.createDataFrame([], schema)


def carried_bars(bars: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Closed bars handed to a sink, each opening at the symbol's close before it, across batches too.

    The last close of each symbol is a row of a table beside the checkpoint, one table a batch, so
    that a batch that is run again reads what the one before it left.
    """

    def batch(frame: DataFrame, number: int) -> None:
        folder, kept = f"{checkpoint}/closes", "symbol string, time timestamp, close double"
        last = _carried(frame.sparkSession, folder, number, kept)
        frame.write.mode("overwrite").parquet(f"{checkpoint}/bars/{number}")
        frame = frame.sparkSession.read.schema(frame.schema).parquet(f"{checkpoint}/bars/{number}")
        both = frame.select("symbol", "time", "close").unionByName(last)
        both.groupBy("symbol").agg(F.max("time").alias("time"), F.max_by("close", "time").alias("close")).write.mode("overwrite").parquet(f"{folder}/{number}")
        guests = last.withColumn("_guest", F.lit(True))
        order = Window.partitionBy("symbol").orderBy("time")
        opened = frame.unionByName(guests, allowMissingColumns=True).withColumn("open", F.coalesce(F.lag("close").over(order), F.col("open")))
        sink(opened.filter("_guest IS NULL").select(*frame.columns), number)

    return bars.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedup_exact(messages: DataFrame, late: str = PATIENCE) -> DataFrame:
    """Messages (source, content, time) without later ones of equal content, as far back as the watermark."""
    return messages.withWatermark("time", late).withColumn("content_hash", F.sha2("content", 256)).dropDuplicatesWithinWatermark(["source", "content_hash"])


def _in_order(rows: Iterator[pd.DataFrame], order: str) -> pd.DataFrame:
    """A key's rows of one batch, of all the chunks that they come in, in order. A batch is bounded by what its source hands out."""
    return pd.concat(list(rows), ignore_index=True).sort_values(order, kind="stable", ignore_index=True)


def _fields(df: DataFrame, names: tuple[str, ...]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{n}` {kinds[n]}" for n in names)


def keyed_state(spark: SparkSession) -> None:
    """State of any number of keys lies in a local database on disk and its changes in the checkpoint, not in a task's memory. A query that is begun
    under another store keeps that one."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class ClockedRepeats(StatefulProcessor):
    """A key's clock and newest arrival, and a map entry for each content it has seen: a batch reads and writes the entries of its own contents only."""

    def __init__(self, threshold_ms: int, columns: list[str], forget_ms: int | None):
        self.threshold, self.columns, self.forget_ms = threshold_ms * 1000, columns, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "clock long, arrival long", self.forget_ms)
        self.seen = handle.getMapState("seen", "content_hash binary", "arrival long", self.forget_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        clock, newest = self.clock.get() if self.clock.exists() else (-(2**62), -(2**62))
        frame, known, keep = _in_order(rows, "arrival"), {}, []
        for arrival, ts, content in frame[["arrival", "ts", "content_hash"]].itertuples(index=False):
            if arrival <= newest:  # after what it came before: it cannot be judged
                keep.append(True)
                continue
            clock = max(clock, ts)
            if content not in known:
                known[content] = self.seen.containsKey((content,))
                if not known[content]:
                    self.seen.updateValue((content,), (int(arrival),))
            keep.append(not (known[content] and clock - ts >= self.threshold))
            known[content] = True
        self.clock.update((int(clock), int(max(newest, frame["arrival"].max()))))
        if self.forget_ms is None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(max(int(clock) // 1000, timerValues.getCurrentWatermarkInMs()) + 1)
        yield frame.loc[keep, self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.clock.clear()
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


def dedup_clocked(messages: DataFrame, threshold_ms: int, by: tuple[str, ...] = ("source", "table", "day"), late: str = PATIENCE, forget_ms: int | None = None) -> DataFrame:
    """Messages (by, arrival, ts µs, content) less repeats that the clock of their key is threshold_ms past.

    All rows of a key in a batch are put in order of arrival, however they are cut into chunks and
    files; a batch is bounded by what its source hands out. Across batches arrivals must rise: a row at or below the newest arrival of an earlier
    batch is kept and changes nothing, as a drop could not be undone. What a key has seen is a map of content hashes, an entry each, with its clock
    beside it; with the day in the key it is a day's. It is forgotten once the stream's times are `late` past the key's clock, and so are rows older than that.
    With forget_ms each entry is forgotten so long after it was written instead, by the clock of the machines; such a query never ends by itself.
    """
    keyed_state(messages.sparkSession)
    columns = [*by, "arrival", "ts", "content"]
    hashed = messages.select(*columns).withColumns({"content_hash": F.unhex(F.sha2("content", 256)), "_time": F.timestamp_micros("ts")})
    timed = hashed if forget_ms is not None else hashed.withWatermark("_time", late)
    return timed.groupBy(*by).transformWithStateInPandas(ClockedRepeats(threshold_ms, columns, forget_ms), _fields(messages, tuple(columns)), "append", "processingTime" if forget_ms is not None else "eventTime")


class TableState(StatefulProcessor):
    """The keys of a table, a map entry each, and the newest image and seq: a batch touches the entries of its own keys, an image all of them."""

    def __init__(self, by: str, key: str, value: str):
        self.by, self.key, self.value = by, key, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getValueState("at", "image long, seq long")
        self.held = handle.getMapState("held", "k string", "v double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        image, before = self.at.get() if self.at.exists() else (-1, -1)
        frame, touched, was, cleared = _in_order(rows, "seq"), {}, {}, False  # touched: the value of a key after the batch, None: gone; was: whether a key was held before it

        def held(k) -> bool:
            if k in touched:
                return touched[k] is not None
            if k not in was:
                was[k] = not cleared and self.held.containsKey((k,))
            return was[k]

        for seq, action, k, v in frame[["seq", "action", self.key, self.value]].itertuples(index=False):
            if seq < before:
                continue
            if action == "partial" and seq != image:  # rows of one partial share its seq
                if not cleared:
                    for (old,) in list(self.held.keys()):
                        touched.setdefault(old, None)
                    self.held.clear()
                touched, image, cleared = dict.fromkeys(touched), seq, True
            if action in ("partial", "insert") or (action == "update" and held(k)):
                touched[k] = float(v)
            elif action == "delete" and held(k):
                touched[k] = None
        for k, v in touched.items():
            if v is not None:
                self.held.updateValue((k,), (v,))
            elif not cleared:
                self.held.removeKey((k,))
        newest = int(max(before, frame["seq"].max()))
        self.at.update((int(image), newest))
        yield pd.DataFrame({self.by: [key[0]] * len(touched), self.key: list(touched), self.value: pd.array(list(touched.values()), dtype="Float64"), "seq": [newest] * len(touched)})

    def close(self) -> None:
        pass


def table_state(rows: DataFrame, by: str, key: str, value: str) -> DataFrame:
    """What each batch of a delta stream (by, action, key, value, seq) changes: by, key, value (null: gone) and the newest seq.

    partial replaces all, insert sets, update patches what is there, delete removes. All rows of a
    table in a batch are put in order of seq; a row older than the newest of an earlier batch is
    left out. The last row of each key is the state (see current_state).
    """
    keyed_state(rows.sparkSession)
    return rows.select(by, "action", key, value, "seq").groupBy(by).transformWithStateInPandas(TableState(by, key, value), f"`{by}` string, `{key}` string, `{value}` double, seq long", "update", "none")


def current_state(changes: DataFrame, by: str, key: str, value: str) -> DataFrame:
    """The state that the changes of table_state leave."""
    last = changes.groupBy(by, key).agg(F.max_by(F.struct(value), "seq").alias("_last"))
    return last.select(by, key, F.col("_last")[value].alias(value)).filter(F.col(value).isNotNull())


def tape(ticks: DataFrame, n: int, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """The n newest trades of the stream so far, after each batch, handed to a sink. The tape is a table
    of n rows beside the checkpoint, one a batch."""

    def batch(frame: DataFrame, number: int) -> None:
        folder = f"{checkpoint}/tape"
        newest = lambda df: df.orderBy(F.desc("ts"), F.desc("sequence")).limit(n)
        newest(newest(frame).unionByName(_carried(frame.sparkSession, folder, number, frame.schema))).write.mode("overwrite").parquet(f"{folder}/{number}")
        sink(frame.sparkSession.read.schema(frame.schema).parquet(f"{folder}/{number}"), number)

    return ticks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class NewestRows(StatefulProcessor):
    """The n newest rows of each symbol of a bucket, as one list, which holds no more than n a symbol."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", "symbol string, ts long, sequence long, row string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        columns, touched = ["symbol", "ts", "sequence", "row"], set()
        newest = pd.DataFrame(list(self.kept.get()), columns=columns) if self.kept.exists() else None
        for frame in rows:  # chunk by chunk: no more than n a symbol and a chunk are held
            touched.update(frame["symbol"].unique())
            both = frame[columns] if newest is None else pd.concat([newest, frame[columns]], ignore_index=True)
            newest = both.sort_values(["ts", "sequence"], ascending=False, kind="stable").groupby("symbol", sort=False, dropna=False).head(self.n)
        self.kept.put([(symbol, int(ts), int(sequence), row) for symbol, ts, sequence, row in newest.itertuples(index=False)])
        given = newest[newest["symbol"].isin(touched)]
        yield pd.DataFrame({"symbol": given["symbol"], "place": given.groupby("symbol", sort=False, dropna=False).cumcount() + 1, "row": given["row"]})

    def close(self) -> None:
        pass


def tape_by_symbol(ticks: DataFrame, n: int, buckets: int = TAPE_BUCKETS) -> DataFrame:
    """The n newest trades of each symbol that a batch has trades of: symbol, place (1 is the newest) and the trade's columns. What a batch gives of a
    symbol stands in place of what earlier ones gave. Symbols are kept by the bucket of their hash, so that a batch calls Python and the store once a bucket, however many
    symbols there are; it rewrites the tapes of the buckets that it has trades of."""
    keyed_state(ticks.sparkSession)
    rest = [f for f in ticks.schema.fields if f.name != "symbol"]
    rows = ticks.select(F.pmod(F.xxhash64("symbol"), F.lit(buckets)).alias("bucket"), "symbol", "ts", "sequence", F.to_json(F.struct(*[f.name for f in rest])).alias("row"))
    kept = rows.groupBy("bucket").transformWithStateInPandas(NewestRows(n), "symbol string, place int, row string", "update", "none")
    return kept.select("symbol", "place", F.from_json("row", StructType(rest)).alias("_r")).select("symbol", "place", "_r.*")


class Buffers(StatefulProcessor):
    """The rows of a bucket that are not written yet: handed on when there are flush_rows of them, or flush_ms after the first came."""

    def __init__(self, flush_rows: int, flush_ms: int):
        self.flush_rows, self.flush_ms = flush_rows, flush_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "row string")
        self.count = handle.getValueState("count", "n long")

    def _flushed(self, key, rows: list[str], reason: str) -> pd.DataFrame:
        return pd.DataFrame({"table": [key[0]] * len(rows), "day": [key[1]] * len(rows), "row": rows, "reason": reason})

    def _taken(self) -> list[str]:
        rows = [r[0] for r in self.held.get()] if self.held.exists() else []
        self.held.clear()
        self.count.clear()
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        return rows

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            n = self.count.get()[0] if self.count.exists() else 0
            if n + len(frame) >= self.flush_rows:
                yield self._flushed(key, self._taken() + frame["row"].tolist(), "full")
                continue
            if not n:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.flush_ms)
            self.held.appendList([(r,) for r in frame["row"]])
            self.count.update((n + len(frame),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = self._taken()
        if rows:
            yield self._flushed(key, rows, "stale")

    def close(self) -> None:
        pass


def buffered(rows: DataFrame, seconds: float = 10, flush_rows: int = FLUSH_ROWS) -> DataFrame:
    """rows (table, day, ...) as their buckets' buffers hand them on, with reason: full, at flush_rows or more of a table and day, or stale, `seconds` after
    the first of them came. Rows that wait are in the checkpoint: a query that is stopped hands them on when it is begun again."""
    keyed_state(rows.sparkSession)
    kept = [f for f in rows.schema.fields if f.name not in ("table", "day")]
    packed = rows.select("table", F.col("day").cast("string").alias("day"), F.to_json(F.struct(*[f.name for f in kept])).alias("row"))
    out = packed.groupBy("table", "day").transformWithStateInPandas(Buffers(flush_rows, int(seconds * 1000)), "table string, day string, row string, reason string", "append", "processingTime")
    return out.select("table", "day", F.from_json("row", StructType(kept)).alias("_r"), "reason").select("table", "day", "_r.*", "reason")


def waiting(spark: SparkSession, checkpoint: str) -> DataFrame:
    """table, day, row (JSON) of what waits in the buffers of a stopped query, for a day that is sealed without it."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "held").option("flattenCollectionTypes", True).load()
    return state.select("key.table", "key.day", "list_element.row")


def stream_to_buckets(rows: DataFrame, root: str, checkpoint: str, seconds: float | None = 10, flush_rows: int = FLUSH_ROWS):
    """Message rows appended by table and day, each bucket's when it has flush_rows of them or `seconds` after the first, whichever is first, and at most flush_rows
    to a file; None takes what is there and ends. seal_bucket makes a day's pieces one."""
    ready = buffered(rows, seconds, flush_rows).drop("reason") if seconds else rows
    writer = ready.writeStream.format("parquet").partitionBy("table", "day").option("path", root).option("checkpointLocation", checkpoint).option("maxRecordsPerFile", flush_rows)
    return (writer.trigger(processingTime=f"{min(1.0, seconds / 4)} seconds") if seconds else writer.trigger(availableNow=True)).start()


def seal_bucket(pieces: DataFrame, sealed: str, order: list[str], records_per_file: int = 50_000_000) -> None:
    """Closed days of buckets (table, day), each rewritten as ordered pieces without the small files of its appends. Days are
    dealt over tasks; a sealed day is written again whole if it is sealed again."""
    (pieces.repartition("table", "day").sortWithinPartitions("table", "day", *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", records_per_file).partitionBy("table", "day").parquet(sealed))


def route_by_event_day(messages: DataFrame) -> DataFrame:
    """messages (table, received, data) with the day of their newest row, that of receipt where they have none."""
    at = F.coalesce(F.array_max(F.transform("data", lambda x: x["timestamp"])), F.col("received"))
    return messages.withColumn("day", F.date_format(F.timestamp_micros(at), "yyyy-MM-dd"))


def judge_sides(sides: DataFrame, months: DataFrame, patience: str = PATIENCE, late: str = "1 day") -> DataFrame:
    """The streaming form of accept_late: sides (symbol, month, side, ts µs, at, ...) with verdict, against months as they are stocked (symbol, month,
    first, last: the reach of their own rows in µs, at: when they were stocked), one row a symbol and month.

    A side waits for its month, and a month for its sides, for `patience`: the times of the two may be so far apart, in either order, and what is
    held of either stream is dropped once both streams' times are past that. accepted: the row lies beyond the month's own rows; held: within their reach; late: no month of
    its symbol was stocked within the patience, known once the times have passed. Rows over `late` behind their stream's newest are not read.
    """
    s = sides.withWatermark("at", late)
    m = months.select(F.col("symbol").alias("_symbol"), F.col("month").alias("_month"), F.col("first").alias("_first"), F.col("last").alias("_last"), F.col("at").alias("_stocked")).withWatermark("_stocked", late)
    joined = s.join(m, F.expr(f"symbol = _symbol AND month = _month AND at >= _stocked - INTERVAL {patience} AND at <= _stocked + INTERVAL {patience}"), "leftOuter")
    beyond = F.when(F.col("side") == "post", F.col("ts") > F.col("_last")).otherwise(F.col("ts") < F.col("_first"))
    verdict = F.when(F.col("_symbol").isNull(), "late").when(beyond, "accepted").otherwise("held")
    return joined.select(*sides.columns, verdict.alias("verdict"))


def write_judged(judged: DataFrame, accepted: str, late: str, checkpoint: str):
    """Accepted sides to one table, late ones to a table of their own, a folder for each batch, which a batch that is run again writes again."""

    def batch(frame: DataFrame, number: int) -> None:
        kept = frame.persist()
        for verdict, root in (("accepted", accepted), ("late", late)):
            kept.filter(F.col("verdict") == verdict).drop("verdict").write.mode("overwrite").parquet(f"{root}/batch={number}")
        kept.unpersist()

    return judged.writeStream.foreachBatch(batch).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def accept_late(main: DataFrame, pre: DataFrame, post: DataFrame) -> DataFrame:
    """A month's rows with the side rows that lie beyond them, by symbol, and only for symbols that it has."""
    from marketloom.operators.reconcile import drop_overlap, sides_of_own

    parts = [drop_overlap(sides_of_own(side, main), main, name) for side, name in ((pre, "pre"), (post, "post"))]
    return main.unionByName(parts[0]).unionByName(parts[1])
