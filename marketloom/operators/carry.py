"""Neighbouring rows across chunks: a window over a hot symbol is cut by day, and each day gets the row
that its neighbour would have given it, so no symbol has to be one task's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def day_of(ts: Column) -> Column:
    return F.floor(ts / DAY_US).cast("long")


def _edges(df: DataFrame, by: str, order: list[str], last: bool, columns: list[str]) -> DataFrame:
    """One row for each (by, day): its last or first by order."""
    pick = F.max_by if last else F.min_by
    return df.groupBy(by, "_day").agg(pick(F.struct(*columns), F.struct(*order)).alias("_edge"))


def lead_by_day(df: DataFrame, by: str, ts: str, order: list[str], columns: dict[str, str]) -> DataFrame:
    """df with, for each name: column of `columns`, the column of the next row of `by` in `order`."""
    chunks = df.withColumn("_day", day_of(F.col(ts)))
    needed = list(dict.fromkeys([*order, *columns.values()]))
    firsts = _edges(chunks, by, order, False, needed)
    days = Window.partitionBy(by).orderBy("_day")
    # the first row of the day after, as a guest at the end of this one; one row a day
    guests = firsts.select(by, F.lag("_day").over(days).alias("_day"), "_edge").filter("_day IS NOT NULL").select(by, "_day", "_edge.*")
    both = chunks.withColumn("_guest", F.lit(False)).unionByName(guests.withColumn("_guest", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy(by, "_day").orderBy(*order)
    return both.select(*df.columns, "_guest", *[F.lead(c).over(w).alias(n) for n, c in columns.items()]).filter("NOT _guest").drop("_guest")


def asof_join(left: DataFrame, right: DataFrame, by: str, on: str, values: list[str], tie: list[str]) -> DataFrame:
    """left with, from right, the `values` of the latest row of `by` at or before left's `on`; null if none.

    Both sides are merged and the last value carried forward inside each (by, day); a day begins with what
    the days before it left. Of right rows at one time the last by `tie` counts.
    """
    value = F.struct(*[F.col(v).alias(v) for v in values])
    r = right.select(F.col(by), F.col(on), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tie)], value.alias("_value")).withColumn("_day", day_of(F.col(on)))
    order = [on, *[f"_t{i}" for i in range(len(tie))]]
    lasts = r.groupBy(by, "_day").agg(F.max_by("_value", F.struct(*order)).alias("_value"))
    days = left.select(by, day_of(F.col(on)).alias("_day")).distinct().withColumn("_ask", F.lit(True)).unionByName(lasts, allowMissingColumns=True)
    before = Window.partitionBy(by).orderBy("_day").rangeBetween(Window.unboundedPreceding, -1)
    carried = days.withColumn("_carried", F.last("_value", ignorenulls=True).over(before)).filter("_ask").select(by, "_day", "_carried")
    l = left.withColumn("_day", day_of(F.col(on))).withColumn("_left", F.lit(True))
    both = l.unionByName(r, allowMissingColumns=True)
    run = Window.partitionBy(by, "_day").orderBy(on, F.col("_left").asc_nulls_first(), *order[1:]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_value", F.last("_value", ignorenulls=True).over(run)).filter("_left")
    joined = found.join(carried, [by, "_day"], "left").withColumn("_value", F.coalesce("_value", "_carried"))
    return joined.select(*left.columns, *[F.col("_value")[v].alias(v) for v in values])
