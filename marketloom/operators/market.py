"""Bars, books, tapes and audits over canonical rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.operators.carry import lead_by_day

DAY = 86_400_000_000
HOUR = 3_600_000_000


def bars(ticks: DataFrame, width: int, stamp: str = "start", carry_open: bool = False) -> DataFrame:
    """symbol, ts, open, high, low, close, volume, trades for each bar of `width` µs.

    stamp "start": bins are [start, end), stamped at the start, as venues publish closed bars. "end": bins
    are (start, end], stamped at the end, as a running bar is. Ties of time are broken by sequence.
    With carry_open a bar opens at the close before it.
    """
    at = F.expr(f"(ts - pmod(ts, {width}))") if stamp == "start" else F.expr(f"(ts + pmod(-ts, {width}))")
    order = F.struct("ts", "sequence")
    out = ticks.withColumn("_bin", at).groupBy("symbol", F.col("_bin").alias("bar")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("size").alias("volume"), F.count("*").alias("trades")).withColumnRenamed("bar", "ts")
    if carry_open:
        out = out.withColumn("open", F.coalesce(F.lag("close").over(Window.partitionBy("symbol").orderBy("ts")), F.col("open")))
    return out


def rebar(fine: DataFrame, width: int) -> DataFrame:
    """Bars of `width` µs from finer ones that are stamped at their start."""
    return fine.groupBy("symbol", F.expr(f"ts - pmod(ts, {width})").alias("bar")).agg(
        F.min_by("open", "ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "ts").alias("close"),
        F.sum("volume").alias("volume"), F.sum("trades").alias("trades")).withColumnRenamed("bar", "ts")


def bar_gaps(rows: DataFrame, width: int) -> DataFrame:
    """rows with step (µs since the bar before) and continuity: first, duplicate, next or gap."""
    step = F.col("ts") - F.lag("ts").over(Window.partitionBy("symbol").orderBy("ts"))
    return rows.withColumn("step", step).withColumn(
        "continuity", F.when(F.col("step").isNull(), "first").when(F.col("step") == 0, "duplicate").when(F.col("step") == width, "next").otherwise("gap"))


def audit_bars(published: DataFrame, summed: DataFrame, fields=("open", "high", "low", "close", "volume")) -> DataFrame:
    """symbol, ts, verdict (equal, differs, unpublished, unexplained) and the fields that differ."""
    p, s = published.alias("p"), summed.alias("s")
    joined = p.join(s, (F.col("p.symbol") == F.col("s.symbol")) & (F.col("p.ts") == F.col("s.ts")), "full_outer")
    # sums of doubles depend on their order in the last bits
    near = lambda a, b: F.coalesce(F.abs(a - b) <= 1e-9 * F.greatest(F.abs(a), F.abs(b)), F.lit(False)) | a.eqNullSafe(b)
    wrong = F.array_compact(F.array(*[F.when(~near(F.col(f"p.{f}"), F.col(f"s.{f}")), f) for f in fields]))
    verdict = F.when(F.col("p.symbol").isNull(), "unpublished").when(F.col("s.symbol").isNull(), "unexplained").when(F.size(wrong) > 0, "differs").otherwise("equal")
    return joined.select(F.coalesce("p.symbol", "s.symbol").alias("symbol"), F.coalesce("p.ts", "s.ts").alias("ts"), verdict.alias("verdict"), F.array_join(wrong, ",").alias("fields"))


def side_impact(ticks: DataFrame) -> DataFrame:
    """side, trades, up, down, flat: how the price moves to the symbol's next trade, by the taker's side."""
    moved = lead_by_day(ticks, "symbol", "ts", ["ts", "sequence"], {"next_price": "price"})
    step = F.col("next_price") - F.col("price")
    return moved.groupBy("side").agg(F.count("*").alias("trades"), F.count_if(step > 0).alias("up"), F.count_if(step < 0).alias("down"), F.count_if(step == 0).alias("flat"))


def aggregate_trades(ticks: DataFrame) -> DataFrame:
    """Adjacent fills of one time, side and price as one trade: symbol, ts, side, price, size, fills, first_sequence.

    Fills of one time are together in (symbol, ts), so islands are found there and no symbol is one task's.
    """
    w = Window.partitionBy("symbol", "ts").orderBy("sequence")
    new = F.coalesce((~F.lag(F.struct("side", "price")).over(w).eqNullSafe(F.struct("side", "price"))).cast("int"), F.lit(1))
    islands = ticks.withColumn("_new", new).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return islands.groupBy("symbol", "ts", "_island").agg(F.first("side").alias("side"), F.first("price").alias("price"), F.sum("size").alias("size"), F.count("*").alias("fills"), F.min("sequence").alias("first_sequence")).drop("_island")


def merge_bars(old: DataFrame, new: DataFrame) -> DataFrame:
    """Bars of both, by symbol and time; where both have one, the new one."""
    both = old.withColumn("_rank", F.lit(0)).unionByName(new.withColumn("_rank", F.lit(1)))
    values = [c for c in old.columns if c not in ("symbol", "ts")]
    return both.groupBy("symbol", "ts").agg(F.max_by(F.struct(*values), "_rank").alias("v")).select("symbol", "ts", *[f"v.{c}" for c in values])


def book_at(events: DataFrame, at: int) -> DataFrame:
    """symbol, side, price, size: the levels of each book at an instant, from snapshot, set, make and take events.

    A snapshot at or before the instant clears what was there; then the last set of a level (a snapshot's rows
    set theirs) and the makes less the takes after it give the size. Levels without size are gone.
    """
    past = events.filter(F.col("ts") <= at)
    place = F.struct("ts", "sequence")
    images = past.filter("action = 'snapshot'").groupBy("symbol").agg(F.max("ts").alias("_image"))
    live = past.join(images, "symbol", "left").filter("_image IS NULL OR ts >= _image")
    sets = F.when(F.col("action").isin("snapshot", "set"), place)
    by = ["symbol", "side", "price"]
    level = live.groupBy(*by).agg(F.max(sets).alias("_at"), F.max_by(F.when(F.col("action").isin("snapshot", "set"), F.col("size")), sets).alias("_set"))
    moves = live.filter("action IN ('make', 'take')").join(level.select(*by, "_at"), by).filter(F.col("_at").isNull() | (place > F.col("_at")))
    moved = moves.groupBy(*by).agg(F.sum(F.when(F.col("action") == "make", F.col("size")).otherwise(-F.col("size"))).alias("_moved"))
    return level.join(moved, by, "left").select(*by, (F.coalesce("_set", F.lit(0.0)) + F.coalesce("_moved", F.lit(0.0))).alias("size")).filter("size > 0")


def _best_first(side: str = "side"):
    return F.when(F.col(side) == "ask", F.col("price")).otherwise(-F.col("price"))


def cumulative_depth(levels: DataFrame) -> DataFrame:
    """levels with depth, the size from the worst level to this one, by symbol and side."""
    w = Window.partitionBy("symbol", "side").orderBy(_best_first().desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return levels.withColumn("depth", F.sum("size").over(w))


def top_of_book(levels: DataFrame, depth: int = 25) -> DataFrame:
    """symbol, best_bid, best_ask, spread, bid_levels, ask_levels over the first `depth` levels a side."""
    w = Window.partitionBy("symbol", "side").orderBy(_best_first())
    top = levels.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= depth)
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    out = top.groupBy("symbol").agg(F.max(F.when(bid, F.col("price"))).alias("best_bid"), F.min(F.when(ask, F.col("price"))).alias("best_ask"), F.count_if(bid).alias("bid_levels"), F.count_if(ask).alias("ask_levels"))
    return out.withColumn("spread", F.col("best_ask") - F.col("best_bid"))


def latest(ticks: DataFrame, n: int) -> DataFrame:
    return ticks.orderBy(F.desc("ts"), F.desc("sequence")).limit(n)


def newest_page(ticks: DataFrame, end: int, n: int, start: int = 0, symbol: str | None = None) -> DataFrame:
    """The n newest rows at or before `end` after the `start` newest, of one symbol or all, newest first, with total: how many there are
    in all. A page is as many rows a task as it ends at; the total is a count beside it."""
    asked = ticks.filter(F.col("ts") <= end)
    asked = asked if symbol is None else asked.filter(F.col("symbol") == symbol)
    page = asked.orderBy(F.desc("ts"), F.desc("sequence"))
    page = page.offset(start).limit(n) if start else page.limit(n)
    return page.withColumn("total", asked.agg(F.count("*")).scalar())


def table_state(rows: DataFrame, by: str, keys: list[str], values: list[str], order: str = "seq") -> DataFrame:
    """The rows a delta stream leaves: partial replaces all of `by`, insert sets, update patches what is there, delete removes.

    Columns of an update that are null keep what they were. An update or a delete of an unknown key changes nothing.
    """
    partial = rows.filter("action = 'partial'").groupBy(by).agg(F.max(order).alias("_from"))
    live = rows.join(partial, by, "left").filter(F.col("_from").isNull() | (F.col(order) >= F.col("_from")))
    whole = F.col("action").isin("partial", "insert")
    key = [by, *keys]
    born = live.groupBy(*key).agg(F.max(F.when(whole, F.col(order))).alias("_born"), F.max(F.when(F.col("action") == "delete", F.col(order))).alias("_died"))
    held = live.join(born.filter("_born IS NOT NULL AND (_died IS NULL OR _died < _born)"), key).filter((F.col(order) >= F.col("_born")) & (F.col("action") != "delete"))
    return held.groupBy(*key).agg(*[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values])
