"""Message logs: regrouping, event days, repeats against a clock, and their accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Message tables, their natural keys and casts.
NATURAL_KEYS = {"orderBookL2": ["symbol", "id", "side"], "liquidation": ["orderID"], "instrument": ["symbol"], "position": ["account", "symbol"], "order": ["orderID"]}
_CASTS = {"long": "bigint", "float": "double", "integer": "bigint"}


def message_ids(rows: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """rows with message (1, 2, ... in a file) and row (0, 1, ... in a message): a row with a _date_ opens one."""
    w = Window.partitionBy(file).orderBy(line).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = rows.withColumn("message", F.sum((F.coalesce("_date_", F.lit("")) != "").cast("int")).over(w))
    return opened.withColumn("row", F.row_number().over(Window.partitionBy(file, "message").orderBy(line)) - 1)


def decode_messages(rows: DataFrame, columns: list[str], file: str = "file", line: str = "line") -> DataFrame:
    """file, message, date, action, data (array of structs in row order); a message of one empty row has no data."""
    held = message_ids(rows, file, line)
    empty = F.lit(True)
    for c in columns:
        empty = empty & (F.coalesce(F.col(c), F.lit("")) == "")
    item = F.when(~empty, F.struct("row", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in columns]))
    out = held.groupBy(file, "message").agg(F.max(F.when(F.col("row") == 0, F.col("_date_"))).alias("date"), F.max(F.when(F.col("row") == 0, F.col("_action_"))).alias("action"), F.array_sort(F.collect_list(item)).alias("data"))
    return out.withColumn("data", F.transform("data", lambda x: x.dropFields("row")))


def skip_messages(rows: DataFrame, n: int, file: str = "file", line: str = "line") -> DataFrame:
    return message_ids(rows, file, line).filter(F.col("message") > n)


def cast_row(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cells by kind: numbers, booleans, `json`, `timestamp` (a D between date and time read as T), `text`, `keep` (empty stays empty)."""
    out = {}
    for name, kind in kinds.items():
        cell = F.nullif(F.col(name), F.lit(""))
        if kind == "boolean":
            out[name] = F.when(cell.isNotNull(), cell == "true")
        elif kind == "json":  # canonical where it parses, as it is where it does not
            out[name] = F.coalesce(F.to_json(F.try_parse_json(cell)), cell)
        elif kind in _CASTS:
            out[name] = cell.try_cast(_CASTS[kind])
        elif kind == "timestamp":
            out[name] = F.regexp_replace(cell, r"^(\d{4}-\d{2}-\d{2})D", "$1T")
        else:
            out[name] = F.col(name) if kind == "keep" else cell
    return rows.withColumns(out)


def event_day(messages: DataFrame) -> DataFrame:
    """messages with event_ts, the newest timestamp of their rows, receipt if there is none, and day."""
    at = F.coalesce(F.array_max(F.transform("data", lambda x: x["timestamp"])), F.col("received"))
    return messages.withColumn("event_ts", at).withColumn("day", F.floor(at / 86_400_000_000).cast("long"))


def flag_repeats(messages: DataFrame, threshold_ms: int, inclusive: bool = True) -> DataFrame:
    """messages (source, table, day, arrival, ts µs, content) with repeat and dropped.

    A repeat's whole content was seen before in its source, table and day. It is dropped when the clock, the
    newest ts in order of arrival, is at least (or over) threshold_ms past its own ts. The clock is one ordered
    pass over a source's table and day; messages are told apart by content hash in a pass of their own, which
    splits further.
    """
    key = ["source", "table", "day"]
    order = Window.partitionBy(*key).orderBy("arrival").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    clocked = messages.withColumn("clock", F.max("ts").over(order)).withColumn("_hash", F.sha2("content", 256))
    seen = F.row_number().over(Window.partitionBy(*key, "_hash").orderBy("arrival")) > 1
    past = F.col("clock") - F.col("ts")
    late = past >= threshold_ms * 1000 if inclusive else past > threshold_ms * 1000
    return clocked.withColumn("repeat", seen).withColumn("dropped", F.col("repeat") & late).drop("_hash")


def dedup_report(messages: DataFrame, wide_ms: int = 500, factor: float = 2.0) -> DataFrame:
    """source, day (null: all days), original, kept, dropped_t0, dropped_wide, effect, percent, outlier: what each threshold drops.

    Contents are hashed before they are sorted, and both thresholds are read off one pass. An outlier's percent is
    over `factor` times the floor, the lowest percent of the sources on that day.
    """
    narrow = messages.withColumn("content", F.sha2("content", 256))
    flagged = flag_repeats(narrow, 0).withColumn("wide", F.col("repeat") & (F.col("clock") - F.col("ts") >= wide_ms * 1000))
    out = flagged.rollup("source", "day").agg(F.count("*").alias("original"), F.count_if("dropped").alias("dropped_t0"), F.count_if("wide").alias("dropped_wide"))
    out = out.withColumns({"kept": F.col("original") - F.col("dropped_wide"), "effect": F.col("dropped_t0") - F.col("dropped_wide"), "percent": F.round(100.0 * F.col("dropped_t0") / F.col("original"), 6)})
    floor = F.min(F.when(F.col("source").isNotNull(), F.col("percent"))).over(Window.partitionBy("day"))  # a row for each source and day
    return out.withColumn("outlier", F.col("percent") > factor * floor)
