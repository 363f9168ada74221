"""Questions to the catalog of files: partitions, series, contents and listing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.names import fill_pattern, transform_kind
from marketloom.functions.times import at_grain, last_closed, next_period, stamp_of, stamp_to_time

PARTITION = ["venue", "market", "dataset", "variant", "grain", "bundle", "month"]


def partition_version(files: DataFrame, by: list[str]) -> DataFrame:
    """by, version: the sum modulo 2^64 of the first 64 bits of each confirmed file's SHA-256 of its tag, 16 hex digits.

    The sum is taken in decimals, as 64-bit sums would overflow; it does not depend on order.
    """
    bits = F.conv(F.substring(F.sha2("etag", 256), 1, 16), 16, 10).cast("decimal(20,0)")
    total = F.pmod(F.coalesce(F.sum(F.when(F.col("existence") == "confirmed", bits)), F.lit(0).cast("decimal(38,0)")), F.lit("18446744073709551616").cast("decimal(38,0)"))
    return files.groupBy(*by).agg(F.lpad(F.lower(F.conv(total.cast("decimal(20,0)").cast("string"), 10, 16)), 16, "0").alias("version"))


def partition_counters(files: DataFrame, by: list[str]) -> DataFrame:
    """by, files, bytes, pending, pending_bytes, withdrawn: confirmed files, those not downloaded yet, those gone."""
    ok, gone = F.col("existence") == "confirmed", F.col("existence") == "absent"
    owed = ok & F.col("downloaded_at").isNull()
    return files.groupBy(*by).agg(
        F.count_if(ok).alias("files"), F.coalesce(F.sum(F.when(ok, F.col("size"))), F.lit(0)).alias("bytes"), F.count_if(owed).alias("pending"),
        F.coalesce(F.sum(F.when(owed, F.col("size"))), F.lit(0)).alias("pending_bytes"), F.count_if(gone).alias("withdrawn"))


def counter_deltas(effects: DataFrame) -> DataFrame:
    """partition, files, bytes, pending, withdrawn: what a batch of changes (was, now; either null) adds; zeros are left out."""
    def sides(name: str, sign: int) -> Column:
        s = F.col(name)
        ok, gone = F.coalesce(s["existence"] == "confirmed", F.lit(False)), F.coalesce(s["existence"] == "absent", F.lit(False))
        owed = ok & s["downloaded_at"].isNull()
        one = lambda flag, value=F.lit(1): (F.when(flag, value).otherwise(F.lit(0)) * sign).cast("long")
        return F.struct(s["partition"].alias("partition"), one(ok).alias("files"), one(ok, F.coalesce(s["size"], F.lit(0))).alias("bytes"), one(owed).alias("pending"), one(gone).alias("withdrawn"))

    rows = effects.select(F.inline(F.array(sides("was", -1), sides("now", 1)))).filter("partition IS NOT NULL")
    names = ["files", "bytes", "pending", "withdrawn"]
    return rows.groupBy("partition").agg(*[F.sum(n).alias(n) for n in names]).filter(" OR ".join(f"{n} <> 0" for n in names))


def venue_totals(venues: DataFrame, partitions: DataFrame) -> DataFrame:
    """Every venue with first and last month that has files, files, bytes, pending and withdrawn ones."""
    joined = venues.join(partitions, "venue", "left")
    has = F.when(F.col("files") > 0, F.col("month"))
    return joined.groupBy("venue").agg(F.min(has).alias("first"), F.max(has).alias("last"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("files", "bytes", "pending", "withdrawn")])


def series_view(series: DataFrame, pattern: DataFrame, slices: DataFrame, instrument: DataFrame) -> DataFrame:
    """Series with their pattern, slice and symbol; a market bundle's is @."""
    return series.join(pattern, "pattern").join(slices, "slice").join(instrument, "instrument", "left").withColumn("symbol", F.coalesce("symbol", F.lit("@")))


def filter_series(series: DataFrame, symbols: list[str] | None = None, live: bool = False, **levels: str) -> DataFrame:
    out = series.filter("last IS NOT NULL") if live else series
    out = out.filter(F.upper("symbol").isin([s.upper() for s in symbols])) if symbols else out
    for name, value in levels.items():
        out = out.filter(F.lower(name) == value.lower())
    return out


def shapes(series: DataFrame) -> DataFrame:
    """market, dataset, variant, grain with symbols, buckets, first, last."""
    return series.groupBy("market", "dataset", "variant", "grain").agg(F.count_if(F.col("symbol") != "@").alias("symbols"), F.count_if(F.col("symbol") == "@").alias("buckets"), F.min("first").alias("first"), F.max("last").alias("last"))


def markets(series: DataFrame) -> DataFrame:
    """market, datasets: dataset, shapes, variants, grains and distinct symbols of each, nested. Sets are of names of levels, which are few."""
    by = series.groupBy("market", "dataset").agg(
        F.count_distinct("variant", "grain").alias("shapes"), F.sort_array(F.collect_set("variant")).alias("variants"), F.sort_array(F.collect_set("grain")).alias("grains"),
        F.count_distinct(F.when(F.col("symbol") != "@", F.col("symbol"))).alias("symbols"))
    return by.groupBy("market").agg(F.sort_array(F.collect_list(F.struct("dataset", "shapes", "variants", "grains", "symbols"))).alias("datasets"))


def symbols(series: DataFrame) -> DataFrame:
    return series.filter("symbol <> '@'").select("symbol").distinct().orderBy("symbol")


def series_counts(series: DataFrame, by: str = "host") -> DataFrame:
    return series.groupBy(by).agg(F.count("*").alias("series"), F.count_if(F.col("first").isNotNull()).alias("with_files"))


def series_bounds(files: DataFrame, by: list[str]) -> DataFrame:
    return files.filter("existence <> 'absent'").groupBy(*by).agg(F.min("date").alias("first"), F.max("date").alias("last"))


def partition_contents(partitions: DataFrame) -> DataFrame:
    """Each slice with its months nested, oldest first."""
    return partitions.groupBy("venue", "dataset").agg(F.sort_array(F.collect_list(F.struct("month", "files", "bytes"))).alias("months"))


def filter_partitions(df: DataFrame, downloaded: bool = False, datasets: list[str] | None = None, **levels: str) -> DataFrame:
    out = df.filter("pending = 0") if downloaded else df
    out = out.filter(F.lower("dataset").isin([d.lower() for d in datasets])) if datasets else out
    for name, value in levels.items():
        out = out.filter(F.lower(name) == value.lower())
    return out


def settled(partitions: DataFrame, runs: DataFrame, now: str, before: str, days: int = 15) -> DataFrame:
    """Partitions whose month closed over `days` days ago and that nothing touched since the oldest open run began."""
    edge = runs.filter("completed_at IS NULL").agg(F.least(F.lit(before).cast("timestamp"), F.coalesce(F.min("started_at"), F.lit(before).cast("timestamp"))).alias("_edge"))
    month = F.date_format(F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS"), "yyyyMM")
    return partitions.filter((F.col("month") < month) & (F.col("updated_at") < edge.scalar()))


def closed_months(df: DataFrame, now: str) -> DataFrame:
    return df.filter(F.col("month") < F.date_format(F.lit(now).cast("timestamp"), "yyyyMM"))


def pick_rendering(partitions: DataFrame) -> DataFrame:
    """Of a slice's renderings of one month the preferred: by instrument before by market, then the coarsest grain."""
    rank = F.struct(F.col("bundle") != "instrument", F.element_at(F.create_map(*[F.lit(x) for kv in zip(("monthly", "daily", "hourly", "minutely"), range(4)) for x in kv]), F.col("grain")))
    w = Window.partitionBy("venue", "market", "dataset", "variant", "month").orderBy(rank)
    return partitions.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def drop_excluded(files: DataFrame, exclusions: DataFrame) -> DataFrame:
    return files.join(exclusions.select("venue", "path"), ["venue", "path"], "left_anti")


# A month's folder before a name that ends in a hyphen and six or eight digits, and the instrument and day of a daily name.
_FILED = r"/(\d{6})/[^/]*?-(\d{6})(?:\d{2})?\.[a-z.]+\z"
_DAILY = r"/([^/]+)-(\d{8})\.[a-z.]+\z"


def misfiled(files: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """Files in a folder of another month than their name's, by six or eight digits of the name: those with an hour's ten are not asked, as there
    the misfiled one is the only copy. Nor are those of kept (symbol, day), of which there is no other, reported."""
    folder, name = F.regexp_extract("path", _FILED, 1), F.regexp_extract("path", _FILED, 2)
    out = files.filter((folder != "") & (folder != name))
    if kept is None:
        return out
    marked = out.withColumns({"_symbol": F.regexp_extract("path", _DAILY, 1), "_day": F.regexp_extract("path", _DAILY, 2)})
    known = F.broadcast(kept.select(F.col("symbol").alias("_symbol"), F.col("day").alias("_day")))  # a list written by hand
    return marked.join(known, ["_symbol", "_day"], "left_anti").select(*files.columns)


def wrong_tree(files: DataFrame, tree: str = "futures_btc", instrument: str = "_USD-") -> DataFrame:
    """Files of a tree, a month's folder below any, whose names hold no instrument of it."""
    parts = F.split("path", "/")
    return files.filter((F.size(parts) == 4) & (parts[0] == tree) & (parts[1] != "") & parts[2].rlike(r"\A\d{6}\z") & (parts[3] != "") & ~F.contains(parts[3], F.lit(instrument)))


def list_page(keys: DataFrame, prefix: str, after: str, max_keys: int) -> DataFrame:
    """The keys after a marker under a prefix, in byte order, at most max_keys of them, with whether more follow.

    Equal keys are one; the sort keeps max_keys + 1 rows a task.
    """
    page = keys.filter(F.col("key").startswith(prefix) & (F.col("key") > after)).groupBy("key").agg(F.max("size").alias("size")).orderBy("key").limit(max_keys + 1)
    n = F.row_number().over(Window.orderBy("key"))  # max_keys + 1 rows
    return page.withColumn("_n", n).withColumn("more", F.max("_n").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) > max_keys).filter(F.col("_n") <= max_keys).drop("_n")


def listing_rows(series: DataFrame, files: DataFrame, members: DataFrame | None = None, partition: tuple[str, str] | None = None, pending: bool = False, low: str = "", high: str | None = None,
                 after: tuple[str, str, str] | None = None, limit: int | None = None) -> DataFrame:
    """prefix, pattern and all of the confirmed files of series (series, slice, prefix, pattern), in the order of prefix, date, path.

    members: only the (slice, month) of a lens; partition: only one (slice, month); pending: only files that are owed; low and
    high: prefixes from low to below high; after: what follows (prefix, date, path); limit: so many at most, which
    keeps so many a task. The date range of a partition is its month, so the range join is an equi-join.
    """
    f = files.filter("existence = 'confirmed'" + (" AND downloaded_at IS NULL" if pending else "")).withColumn("month", F.substring("date", 1, 6))
    s = series.select("series", "slice", "prefix", "pattern").filter((F.col("prefix") >= low) & (F.lit(True) if high is None else F.col("prefix") < high))
    if partition is not None:
        s, f = s.filter(F.col("slice") == partition[0]), f.filter(F.col("month") == partition[1])
    if members is not None:
        s = touched_slices(s, members)
    rows = f.join(s, "series")
    if members is not None:
        rows = rows.join(members.select("slice", "month").distinct(), ["slice", "month"], "left_semi")
    if after is not None:
        rows = rows.filter(F.struct("prefix", "date", "path") > F.struct(*[F.lit(x) for x in after]))
    out = rows.orderBy("prefix", "date", "path")
    return out if limit is None else out.limit(limit)


def touched_slices(slices: DataFrame, members: DataFrame) -> DataFrame:
    return slices.join(members.select("slice"), "slice", "left_semi")


def within_lens(partitions: DataFrame, members: DataFrame) -> DataFrame:
    return partitions.join(members.select("partition"), "partition", "left_semi")


def partition_named(names: DataFrame, partitions: DataFrame) -> DataFrame:
    """names (venue|market|dataset|variant|month) with the partition each is of."""
    keys = ["venue", "market", "dataset", "variant", "month"]
    return names.select("name", *[F.split("name", r"\|")[i].alias(k) for i, k in enumerate(keys)]).join(partitions, keys)


def established_at(runs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """prefix, established: of each prefix the newest completed run over one of its ancestors that no run still open is below."""
    parts = F.split("prefix", "/")
    ancestors = prefixes.select("prefix", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("scope"))
    done = runs.filter("completed_at IS NOT NULL").groupBy("scope").agg(F.max("completed_at").alias("established"))
    open_parts = F.split("scope", "/")
    under = runs.filter("completed_at IS NULL").select(F.explode(F.transform(F.sequence(F.lit(0), F.size(open_parts)), lambda i: F.array_join(F.slice(open_parts, 1, i), "/"))).alias("scope")).distinct()
    return ancestors.join(done, "scope").join(under, "scope", "left_anti").groupBy("prefix").agg(F.max("established").alias("established"))


def neighbours(partitions: DataFrame, by: int) -> DataFrame:
    """partitions with neighbour, the partition of the slice `by` months on, null where there is none."""
    keys = ["venue", "market", "dataset", "variant"]
    shifted = F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("01")), "yyyyMMdd"), -by), "yyyyMM")
    other = partitions.select(*keys, shifted.alias("month"), F.col("partition").alias("neighbour"))
    return partitions.join(other, [*keys, "month"], "left")


def resolve_transform(asks: DataFrame, transforms: DataFrame) -> DataFrame:
    """asks (ask, venue, dataset, kind, date) with value: the transform whose dates hold, one that names the dataset before one for all."""
    a, t = asks.alias("a"), transforms.alias("t")
    # dates of different grains are compared as far as both go
    cut = lambda x, y: F.substring(x, F.lit(1), F.least(F.length(x), F.length(y)))
    date, first, last = F.col("a.date"), F.col("t.from"), F.col("t.to")
    fits = ((F.col("a.venue") == F.col("t.venue")) & (F.col("a.kind") == F.col("t.kind")) & ((F.col("t.dataset") == "") | (F.col("t.dataset") == F.col("a.dataset")))
            & (first.isNull() | (cut(date, first) >= cut(first, date))) & (last.isNull() | (cut(date, last) <= cut(last, date))))
    joined = a.join(t, fits, "left").select("a.*", F.col("t.value").alias("_v"), F.col("t.dataset").alias("_d"))
    return joined.groupBy(*[c for c in asks.columns]).agg(F.max_by("_v", F.struct(F.col("_d") != "", "_v")).alias("value"))


def expected_periods(series: DataFrame, now: str) -> DataFrame:
    """series' rows with date, for every period of their grain from the later of tip + 1 and first to the earlier of the last closed
    period less the lag (in periods) and retirement. Stamps may be of any grain and are taken at the series'.

    Periods of the measured-empty span (empty_from, empty_to) are left out.
    """
    grain = F.col("grain")
    at = lambda c: F.when(F.col(c).isNotNull(), at_grain(F.col(c), grain))
    closed = next_period(last_closed(grain, F.lit(now).cast("timestamp")), grain)
    step = F.expr("make_interval(0, CAST(grain = 'monthly' AS INT), 0, CAST(grain = 'daily' AS INT), CAST(grain = 'hourly' AS INT), CAST(grain = 'minutely' AS INT), 0)")
    start = stamp_to_time(F.greatest(next_period(at("tip"), grain), at("first")))
    last = stamp_to_time(closed) - step * (F.lit(1) + F.coalesce("lag", F.lit(0)))
    stop = F.least(last, stamp_to_time(at("retired")))
    bounded = series.withColumns({"_start": start, "_stop": stop, "_step": step})
    rows = bounded.withColumn("_t", F.explode(F.when(F.col("_start") <= F.col("_stop"), F.sequence("_start", "_stop", "_step")))).withColumn("date", stamp_of(F.col("_t"), grain))
    return rows.filter(F.col("empty_from").isNull() | (F.col("date") < at("empty_from")) | (F.col("date") > at("empty_to"))).drop("_start", "_stop", "_step", "_t")


def expected_keys(series: DataFrame, now: str, transforms: DataFrame | None = None) -> DataFrame:
    """series, date, key of every expected period (see expected_periods); series has pattern, symbol, venue and dataset besides. Of a
    pattern's transform the rows of `transforms` that hold at the date (see resolve_transform) say what it stands for."""
    periods = expected_periods(series, now)
    if transforms is None:
        value = F.lit(None).cast("string")
    else:
        asks = periods.select("series", "venue", "dataset", transform_kind(F.col("pattern")).alias("kind"), "date").filter("kind IS NOT NULL")
        held = resolve_transform(asks, transforms).select("series", "date", F.col("value").alias("_value"))
        periods, value = periods.join(held, ["series", "date"], "left"), F.col("_value")
    return periods.select("series", "date", fill_pattern(F.col("pattern"), F.col("date"), F.col("symbol"), F.lit(""), value).alias("key"))


def months_between(df: DataFrame, by: list[str]) -> DataFrame:
    """by, month for each month from `first` to `last` (yyyyMM)."""
    day = lambda c: F.to_date(F.concat(c, F.lit("01")), "yyyyMMdd")
    return df.select(*by, F.explode(F.sequence(day("first"), day("last"), F.expr("INTERVAL 1 MONTH"))).alias("_m")).select(*by, F.date_format("_m", "yyyyMM").alias("month"))


def missing_periods(expected: DataFrame, held: DataFrame, by: list[str]) -> DataFrame:
    return expected.join(held.select(*by).distinct(), by, "left_anti")
