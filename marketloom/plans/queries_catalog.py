"""Queries over the catalog of files, lenses, change capture and reconciliation, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import listing, names
from marketloom.functions.times import WIDTH, at_grain, last_closed, last_settled, next_period
from marketloom.operators import catalog, changes, lenses, reconcile
from marketloom.plans import views
from marketloom.session import scratch, stored, table
from marketloom.sources import ordered

BY = ["venue", "dataset", "month"]
_SLICE = "CASE number % 4 WHEN 0 THEN 'monthly' WHEN 1 THEN 'daily' WHEN 2 THEN 'hourly' ELSE 'minutely' END"


def partition_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.partitions(spark, sf_dir)


def partition_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.partition_version(views.catalog_files(spark, sf_dir), BY)


def venue_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    venues = views.catalog_files(spark, sf_dir).select("venue").distinct().unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("venue")))
    return catalog.venue_totals(venues, views.partitions(spark, sf_dir))


def counter_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose state changes: odd suppliers' files are new, every fifth one's are withdrawn, the rest stay."""
    f = views.catalog_files(spark, sf_dir).withColumn("partition", F.concat_ws("/", *BY))
    state = lambda existence: F.struct("partition", existence.alias("existence"), "size", "downloaded_at")
    was = F.when(F.col("series") % 2 == 0, state(F.col("existence")))
    now = state(F.when(F.col("series") % 5 == 0, "absent").otherwise(F.col("existence")))
    return catalog.counter_deltas(f.select(was.alias("was"), now.alias("now")))


def contents_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.shapes(_bounded(spark, sf_dir))


def _bounded(spark, sf_dir):
    return views.series(spark, sf_dir).join(catalog.series_bounds(views.catalog_files(spark, sf_dir), ["series"]), "series", "left")


def contents_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = catalog.markets(views.series(spark, sf_dir))
    return nested.select("market", F.inline("datasets")).select("market", "dataset", "shapes", "symbols", F.array_join("variants", "|").alias("variants"), F.array_join("grains", "|").alias("grains"))


def contents_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.symbols(views.series(spark, sf_dir))


def series_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.series_counts(_bounded(spark, sf_dir))


def series_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.series_bounds(views.catalog_files(spark, sf_dir), ["venue", "series"])


def partition_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = catalog.partition_contents(views.partitions(spark, sf_dir))
    return nested.select("venue", "dataset", F.size("months").alias("months"), F.col("months")[0]["month"].alias("oldest"), F.array_join(F.transform("months", lambda m: F.concat_ws(":", m["month"], m["files"])), ",").alias("listing"))


def settled_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions touched at the newest ship date of their files, against orders as runs, the open ones of the last months without completion."""
    touched = views.catalog_files(spark, sf_dir).groupBy(*BY).agg(F.max("downloaded_at").cast("timestamp").alias("updated_at"))
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("timestamp").alias("started_at"), F.when((F.col("o_orderstatus") != "O") | (F.col("o_orderdate") < "1998-06-01"), F.col("o_orderdate").cast("timestamp")).alias("completed_at"))
    return catalog.settled(touched, runs, "1998-08-20 00:00:00", "1998-07-01 00:00:00").select(*BY)


def renderings_preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.pick_rendering(_renderings(spark, sf_dir)).select("venue", "market", "dataset", "variant", "month", "grain", "bundle", "files")


def _renderings(spark, sf_dir):
    f = views.catalog_files(spark, sf_dir)
    grain = F.element_at(F.array(F.lit("monthly"), F.lit("daily"), F.lit("hourly"), F.lit("minutely")), (F.col("number") % 4 + 1).cast("int"))
    g = f.withColumn("grain", grain).withColumn("bundle", F.when(F.col("number") % 2 == 0, "market").otherwise("instrument")).withColumn("market", F.when(F.col("series") % 2 == 0, "spot").otherwise("perp")).withColumn("variant", F.lit(""))
    out = g.groupBy("venue", "market", "dataset", "variant", "grain", "bundle", "month").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    return out.withColumn("partition", F.concat_ws("|", "venue", "market", "dataset", "variant", "month", "grain", "bundle")).withColumn("slice", F.concat_ws("|", "venue", "market", "dataset", "variant", "grain", "bundle"))


_RENDER = f"""{views.CATALOG_FILES}, g AS (SELECT *, {_SLICE} AS grain, CASE WHEN number % 2 = 0 THEN 'market' ELSE 'instrument' END AS bundle, CASE WHEN series % 2 = 0 THEN 'spot' ELSE 'perp' END AS market, '' AS variant FROM catalog_files),
rend AS (SELECT venue, market, dataset, variant, grain, bundle, month, count(*) AS files, sum(size)::BIGINT AS bytes, concat_ws('|', venue, market, dataset, variant, month, grain, bundle) AS partition,
 concat_ws('|', venue, market, dataset, variant, grain, bundle) AS slice FROM g GROUP BY ALL)"""
_RULES = [
    (1, "include", "*", None, None, None, None, "instrument", "daily", None, None),
    (2, "include", "R", ["spot"], [("1-URGENT", None), ("2-HIGH", "")], None, None, None, None, "199401", "199612"),
    (3, "exclude", "*", ["perp"], [("5-LOW", None)], None, None, None, None, "199506", None),
    (4, "exclude", "N", None, None, "hourly", None, None, None, None, None),
]


def _rules(spark):
    return spark.createDataFrame(_RULES, "rule int, effect string, venue string, markets array<string>, datasets array<struct<dataset: string, variant: string>>, only_grain string, only_bundle string, prefer_bundle string, prefer_grain string, `from` string, `to` string")


def lens_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lenses.resolve_lens(_renderings(spark, sf_dir), _rules(spark)).select("partition", "files", "bytes")


def lens_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _renderings(spark, sf_dir)
    return lenses.lens_figures(lenses.resolve_lens(r, _rules(spark)), r)


def lens_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _renderings(spark, sf_dir)
    return lenses.lens_changes(lenses.resolve_lens(r, _rules(spark)), r.filter("files > 2"))


_LENS = f"""{_RENDER}, inc1 AS (SELECT *, bool_or(bundle = 'instrument') OVER s AS has FROM rend WINDOW s AS (PARTITION BY venue, market, dataset, variant, month)),
inc1b AS (SELECT *, bool_or(grain = 'daily') OVER s AS hasg FROM inc1 WHERE NOT has OR bundle = 'instrument' WINDOW s AS (PARTITION BY venue, market, dataset, variant, month)),
inc AS (SELECT partition FROM inc1b WHERE NOT hasg OR grain = 'daily' UNION SELECT partition FROM rend WHERE venue = 'R' AND market = 'spot' AND dataset IN ('1-URGENT', '2-HIGH') AND month BETWEEN '199401' AND '199612'),
exc AS (SELECT partition FROM rend WHERE (market = 'perp' AND dataset = '5-LOW' AND month >= '199506') OR (venue = 'N' AND grain = 'hourly')),
lens AS (SELECT rend.* FROM rend WHERE partition IN (SELECT partition FROM inc) AND partition NOT IN (SELECT partition FROM exc))"""


def _spans(spark, sf_dir):
    """Spans of months by customer: of orders, from their month for as many months as the customer's nation says. A month that is not known leaves its end open."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    end = F.add_months("o_orderdate", F.col("c_nationkey") % 4)
    return j.select(F.concat(F.lit("C"), "c_custkey").alias("slice"), F.col("o_orderkey"), F.date_format("o_orderdate", "yyyyMM").alias("from"), F.date_format(end, "yyyyMM").alias("to"))


_SPANS = """sp AS (SELECT 'C' || c_custkey AS slice, o_orderkey, strftime(o_orderdate, '%Y%m') AS f, strftime(o_orderdate + to_months(CAST(c_nationkey % 4 AS INT)), '%Y%m') AS t,
 year(o_orderdate) * 12 + month(o_orderdate) - 1 AS a, year(o_orderdate) * 12 + month(o_orderdate) - 1 + c_nationkey % 4 AS b FROM orders JOIN customer ON o_custkey = c_custkey)"""
_ISLANDS = """(SELECT slice, min(a) AS a, max(b) AS b FROM (SELECT *, sum(fresh) OVER (PARTITION BY slice ORDER BY a, b RANGE UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN max(b) OVER (PARTITION BY slice ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= a
 THEN 0 ELSE 1 END AS fresh FROM {spans} )) GROUP BY slice, island)"""
#: The spans with their open ends, which lie beyond every month.
_OPEN_SPANS = "open_spans AS (SELECT slice, coalesce(a, 0) AS a, coalesce(b, 9999 * 12 + 11) AS b FROM sp)"
_MONTH = "lpad(CAST({x} // 12 AS VARCHAR), 4, '0') || lpad(CAST({x} % 12 + 1 AS VARCHAR), 2, '0')"


def spans_united(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lenses.span_union(_spans(spark, sf_dir).drop("o_orderkey"), ["slice"])


def spans_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of the even orders' spans less those of the odd ones, as months."""
    s = _spans(spark, sf_dir)
    even, odd = s.filter("o_orderkey % 2 = 0").drop("o_orderkey"), s.filter("o_orderkey % 2 = 1").drop("o_orderkey")
    left = lenses.span_minus(lenses.span_union(even, ["slice"]), odd, ["slice"])
    return catalog.months_between(left.select("slice", F.col("from").alias("first"), F.col("to").alias("last")), ["slice"])


def contents_through_lens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last file dates of each customer's datasets, cut to the united spans of the customer."""
    f = views.catalog_files(spark, sf_dir)
    s = f.groupBy(F.concat(F.lit("C"), "owner").alias("slice"), F.col("dataset").alias("series")).agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return lenses.through_lens(s, spans_united(spark, sf_dir))


def listing_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = views.catalog_files(spark, sf_dir).select(F.concat_ws("|", "venue", "dataset", "date", "path").alias("key"), "size")
    return catalog.list_page(keys, "N|3-MEDIUM", "N|3-MEDIUM|19960101", 200)


def expected_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.expected_periods(_publishing(spark, sf_dir), "1998-12-01").select("series", "date")


def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = views.catalog_files(spark, sf_dir).select(F.col("series"), "date")
    return catalog.missing_periods(catalog.expected_periods(_publishing(spark, sf_dir), "1998-12-01").select("series", "date"), held, ["series", "date"])


def _publishing(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    day = lambda c: F.date_format(F.date_add(F.to_date(F.lit("1998-01-01")), c.cast("int")), "yyyyMMdd")
    k = F.col("s_suppkey")
    return s.select(k.alias("series"), F.lit("daily").alias("grain"), day(k % 90).alias("tip"), day(F.lit(40)).alias("first"), F.when(k % 7 == 0, day(F.lit(200))).alias("retired"), (k % 5).cast("int").alias("lag"),
                    F.when(k % 4 == 0, day(F.lit(60))).alias("empty_from"), F.when(k % 4 == 0, day(F.lit(99))).alias("empty_to"))


_EXPECTED = """x AS (SELECT s_suppkey AS series, unnest(range(CAST(greatest(s_suppkey % 90 + 1, 40) AS BIGINT), least(334 - 1 - s_suppkey % 5, CASE WHEN s_suppkey % 7 = 0 THEN 200 ELSE 9999 END)::BIGINT + 1)) AS d FROM supplier),
want AS (SELECT series, strftime(DATE '1998-01-01' + CAST(d AS INT), '%Y%m%d') AS date FROM x WHERE NOT (series % 4 = 0 AND d BETWEEN 60 AND 99))"""


def _before(spark, sf_dir):
    return views.catalog_files(spark, sf_dir).filter("series % 10 <> 3").select("venue", "path", "date", "size", "etag", F.lit("m").alias("modified"), "existence", "downloaded_at")


def _page(spark, sf_dir):
    """A listing: suppliers of every tenth withheld, sizes of others' changed, tags of some unknown."""
    f = views.catalog_files(spark, sf_dir).filter("series % 10 <> 4")
    return f.select("venue", "path", "date", F.when(F.col("series") % 10 == 5, F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(F.col("series") % 10 != 6, F.col("etag")).alias("etag"),
                    F.when(F.col("series") % 10 == 7, "n").otherwise("m").alias("modified"), F.lit("confirmed").alias("existence"))


def listing_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.merge_listing(_before(spark, sf_dir), _page(spark, sf_dir)).groupBy("venue", "action", "existence").agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"), F.count_if(F.col("downloaded_at").isNull()).alias("owed"), F.min("path").alias("lowest"))


def listing_merged_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue in ordered ranges of files, and a listing's page of one venue's paths from 2 to 3 merged into it: the catalogue after it, and whether
    most ranges were neither read nor written."""
    root = scratch(spark, "catalogue")
    before = stored(_before(spark, sf_dir), "before")
    rows = max(100, before.count() // 60)
    ordered.build(before, root, changes.KEY, range_rows=rows)
    page = _page(spark, sf_dir).filter("venue = 'N' AND path >= '2' AND path < '3'")
    done = ordered.merge(spark, root, changes.KEY, page, changes.merge_listing, range_rows=rows)
    after = ordered.read_all(spark, root)
    return after.groupBy("venue", "existence").agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"), F.count_if(F.col("downloaded_at").isNull()).alias("owed"), F.min("path").alias("lowest"), F.max("path").alias("highest")).withColumn("mostly_kept", F.lit(done["kept"] > 3 * done["touched"]))


def listing_page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of listing_page from keys in ordered ranges, of which the index names those to open: ranges of 1,000 keys, or of a 600th of
    more than 600,000, up to the rows of a range."""
    root = scratch(spark, "keys")
    keys = views.catalog_files(spark, sf_dir).select(F.concat_ws("|", "venue", "dataset", "date", "path").alias("key"), "size").groupBy("key").agg(F.max("size").alias("size"))
    keys = stored(keys, "listed")
    ordered.build(keys, root, ["key"], range_rows=min(ordered.RANGE_ROWS, max(1000, keys.count() // 600)))
    prefix, after = "N|3-MEDIUM", "N|3-MEDIUM|19960101"
    return catalog.list_page(ordered.read_from(spark, root, "key", prefix, after, 201), prefix, after, 200)


def listing_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.revisions(_before(spark, sf_dir), _page(spark, sf_dir)).select("venue", "path", "size", "etag")


def files_withdrawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.withdraw(_before(spark, sf_dir), _page(spark, sf_dir), "1", "5").filter("withdrawn").select("venue", "path", "existence", "size")


def files_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of every supplier, some of them catalogued, probed: found as they were, changed, without a tag, gone, not asked, or asked without being parked."""
    f = views.catalog_files(spark, sf_dir)
    k = F.col("series") % 10
    files = f.filter((k != 5) & (k != 6)).select("venue", "path", "date", "size", "etag", F.lit("m").alias("modified"), "existence", "downloaded_at")
    parked = f.filter(k != 4).select("venue", "path", "date", F.lit(None).cast("long").alias("size"), F.when(k != 3, F.col("etag")).alias("etag"), F.lit("p").alias("modified"))
    probes = f.filter(k != 6).select("venue", "path", (F.col("size") + F.when(k == 2, 1).otherwise(0)).alias("size"), F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("modified"), F.when(k == 7, "absent").alias("existence"))
    out = changes.settle(files, parked, probes)
    return out.groupBy("venue", "existence").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.count_if(F.col("downloaded_at").isNull()).alias("owed"))


def reports_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.catalog_files(spark, sf_dir)
    outcome = F.element_at(F.array(F.lit("downloaded"), F.lit("failed"), F.lit("mismatched")), (F.col("series") % 3 + 1).cast("int"))
    report = f.filter("series % 10 < 5").select("venue", "path", outcome.alias("outcome"), (F.col("size") + 2).alias("size"), F.lit(None).cast("string").alias("etag"), F.to_timestamp_ntz(F.lit("1999-01-01 00:00:00")).alias("at"), (F.col("number") % 2 == 0).alias("confirmed_absent"))
    out = changes.apply_report(f.select("venue", "path", "date", "size", "etag", F.lit("m").alias("modified"), "existence", "downloaded_at"), report)
    return out.groupBy("venue", "existence").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.count_if(F.col("downloaded_at").isNull()).alias("owed"))


def series_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of four grains, their bounds too wide, too narrow, right or unknown, at a time within the span of the files; a fifth have no file."""
    k = F.col("series")
    grain = F.element_at(F.array(*[F.lit(g) for g in WIDTH]), (k % 4 + 1).cast("int"))
    date = F.substring(F.concat("date", F.lit("0730")), 1, F.element_at(F.create_map(*[F.lit(x) for kv in WIDTH.items() for x in kv]), grain))
    files = views.catalog_files(spark, sf_dir).filter("series % 5 <> 1").select("series", date.alias("date"), "existence")
    at = lambda stamp: F.when(F.lit(stamp).isNotNull(), at_grain(F.lit(stamp), F.col("grain")))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("series")).withColumn("grain", grain)
    s = s.select("series", "grain", F.when(k % 7 > 0, F.when(k % 3 == 0, at("199501")).otherwise(at("19960601"))).alias("first"),
                 F.when(k % 7 > 0, F.when(k % 3 == 0, at("20991231")).when(k % 3 == 1, at("19980515")).otherwise(at("19970101"))).alias("last"), F.when(k % 7 > 1, F.when(k % 2 == 0, at("19980701")).otherwise(at("19900101"))).alias("tip"))
    return changes.reconcile_series(s, files, ["series"], F.lit("1998-06-10 12:30:00").cast("timestamp"))


def _parts(spark, sf_dir):
    return views.catalog_files(spark, sf_dir).select("venue", "month", "path", "size", (F.col("number") % 7 != 3).alias("uploaded"))


_PARTS = f"{views.CATALOG_FILES}, parts AS (SELECT venue, month, path, size, number % 7 <> 3 AS uploaded FROM catalog_files)"


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.coverage(_parts(spark, sf_dir))


def months_backed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.backed_months(_parts(spark, sf_dir))


def month_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.month_bytes(_parts(spark, sf_dir))


def files_duplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.duplicated(views.catalog_files(spark, sf_dir).withColumn("key", F.concat_ws("/", "venue", "dataset", "date")), "key")


def cold_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.cold_stats(_parts(spark, sf_dir))


def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.coverage_gaps(views.catalog_files(spark, sf_dir).select("owner", "month"), ["owner"])


def stage_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.catalog_files(spark, sf_dir).select("series", "month", "number")
    return reconcile.stage_lag(f, f.filter("number < 3"), ["series"])


def ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says now, a tenth of its lines distrusted."""
    log = _ledger(spark, sf_dir)
    return reconcile.ledger_current(log, distrusted=log.filter("line % 10 = 3").select("partition", "revision")).select("partition", "line", "state", "outdated")


def ledger_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store has nothing of every eleventh user's partitions."""
    log = _ledger(spark, sf_dir)
    plan = reconcile.repair_plan(log, log.filter("line % 11 > 0").select("partition"))
    return plan.select("partition", "action", F.array_join("sides", ",").alias("sides"))


def _ledger(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    state = F.when(F.col("event_type") == "error", "updating").when(F.col("event_type") == "click", "outdated").otherwise("stocked")
    k = F.col("event_id")
    side = lambda n, m: F.when(k % n == 0, "missing").when(k % n < m, "e1").otherwise("e2")
    return e.select(F.concat(F.lit("P"), F.col("user_id") % 997 * 31 + k % 31).alias("partition"), k.alias("line"), state.alias("state"), F.concat(F.lit("r"), k).alias("revision"), F.when(k % 13 == 0, "monthly").otherwise("daily").alias("grain"),
                    F.lit("market").alias("bundle"), F.when(k % 17 == 0, "v2").otherwise("v1").alias("version"), side(2, 2).alias("pre_version"), side(3, 3).alias("post_version"))


_LEDGER = """led AS (SELECT 'P' || (user_id % 997 * 31 + event_id % 31) AS partition, event_id AS line, CASE event_type WHEN 'error' THEN 'updating' WHEN 'click' THEN 'outdated' ELSE 'stocked' END AS state, 'r' || event_id AS revision,
 CASE WHEN event_id % 13 = 0 THEN 'monthly' ELSE 'daily' END AS grain, CASE WHEN event_id % 17 = 0 THEN 'v2' ELSE 'v1' END AS version, CASE WHEN event_id % 2 = 0 THEN 'missing' ELSE 'e1' END AS pre, CASE WHEN event_id % 3 = 0 THEN 'missing' ELSE 'e1' END AS post FROM events)"""


def store_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.catalog_files(spark, sf_dir).select("path", "size", "etag", "series")
    store = f.filter("series % 10 <> 1").select(F.when(F.col("series") % 10 == 2, F.concat("path", F.lit("~"))).otherwise(F.col("path")).alias("path"), F.when(F.col("series") % 10 == 3, F.col("size") + 1).otherwise(F.col("size")).alias("size"), "etag")
    return reconcile.reconcile_store(f, store).groupBy("verdict").agg(F.count("*").alias("files"), F.min("path").alias("lowest"), F.max("path").alias("highest"))


def plans_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = catalog.partition_version(views.catalog_files(spark, sf_dir), BY)
    held = catalog.partition_version(views.catalog_files(spark, sf_dir).filter("series % 50 <> 9 AND venue <> 'R'"), BY)
    return reconcile.plan_diff(ready, held, BY).groupBy("venue", "plan").agg(F.count("*").alias("partitions"), F.min("version").alias("lowest"))


_VERSION = "lower(lpad(hex(CAST(sum(CAST(('0x' || substr(sha256(etag), 1, 16)) AS UBIGINT)::HUGEINT) FILTER (existence = 'confirmed') % 18446744073709551616 AS UBIGINT)), 16, '0'))"


def stocking_decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of two renderings each against a ledger: the number of a month's files says what has become of it since."""
    p = views.partitions(spark, sf_dir)
    k, texts = F.col("files") % 8, lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    edge = F.array(F.struct(F.lit("next").alias("id"), F.lit("post").alias("side"), F.lit("e1").alias("version"), (k != 4).alias("here")))
    none = F.array().cast("array<struct<id:string,side:string,version:string,here:boolean>>")
    lone = k.isin(2, 5)
    both = p.select(F.concat_ws("/", *BY).alias("key"), "files", k.alias("k"), F.explode(F.array(F.lit(0), F.lit(1))).alias("rank")).withColumns({
        "partition": F.concat_ws("#", "key", "rank"), "version": F.when(F.col("rank") == 0, "v0").otherwise("v1"), "versions": texts("s1", "s2"), "fields": F.lit("ts,price"),
        "edges": F.when(lone, none).otherwise(edge), "missing": F.when(lone, texts("post")).otherwise(texts()), "on_disk": F.when(F.col("rank") == 0, F.col("k").isin(1, 2)).otherwise(F.col("k").isin(1, 5, 6))})
    made = lambda version, edges, missing: names.revision(F.col("versions"), F.col("fields"), F.col("partition"), version, edges, missing)
    first = both.filter("rank = 0 AND k NOT IN (2, 6)")
    now, alone = made(F.col("version"), F.col("edges"), F.col("missing")), made(F.col("version"), none, texts("post"))
    ledger = first.select("key", "partition", F.when(F.col("k").isin(5, 7), "old").otherwise(F.col("version")).alias("version"), F.when(F.col("k") == 0, now).when(F.col("k").isin(3, 4), alone).otherwise("other").alias("revision"),
                          F.when(F.col("k").isin(3, 4), texts("post")).otherwise(texts()).alias("lacking"))
    return reconcile.decide(both, ledger).select("key", "status", F.substring_index("partition", "#", -1).alias("rendering"), F.array_join("sides", ",").alias("sides"))


def _archives(spark, sf_dir):
    """The catalogue's files as archives: every venue's datasets by instrument, the names that a store would list."""
    f = views.catalog_files(spark, sf_dir).filter("existence = 'confirmed'")
    dataset = F.concat(F.lit("d"), F.substring("dataset", 1, 1))
    key = F.concat_ws("|", F.lower("venue"), F.lit("spot"), dataset, F.concat(F.lit("S"), "series", F.lit("x"), F.regexp_replace("path", "/", "x")), F.concat("date", F.lit(".csv")))
    return f.select(F.lower("venue").alias("venue"), F.lit("spot").alias("market"), dataset.alias("dataset"), F.lit("").alias("variant"), F.lit("instrument").alias("bundle"), F.lit("daily").alias("grain"),
                    F.concat_ws("-", F.substring("month", 1, 4), F.substring("month", 5, 2)).alias("month"), F.col("size"), key.alias("name"), "series", "number", F.substring("month", 6, 1).alias("k"))


def stocking_from_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is to be done about each month as its archives are on the disk: of months that end in 1 a file is missing, in 2 one is cut short, in 3 nothing is there,
    and everywhere lie files that are no archives."""
    a = _archives(spark, sf_dir)
    partitions = stored(a.groupBy(*reconcile.PARTITION).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.min("name").alias("_first")), "partitions")
    first, partitions = partitions.select(*reconcile.PARTITION, "_first"), partitions.drop("_first")  # a row a month of each dataset
    disk = a.join(F.broadcast(first), reconcile.PARTITION).filter("k <> '3' AND NOT (k = '1' AND name = _first)").select(F.concat(F.lit("/archives/x/"), "name").alias("path"), (F.col("size") - F.when((F.col("k") == "2") & (F.col("name") == F.col("_first")), 1).otherwise(0)).alias("length"))
    junk = a.select(F.explode(F.array(F.concat(F.lit("/archives/x/"), "name", F.lit(".part")), F.concat(F.lit("/archives/x/"), "name", F.lit(".bak")), F.lit("/archives/x/notes.txt"))).alias("path"), F.lit(9).cast("long").alias("length"))
    judged = reconcile.matches_catalog(reconcile.archive_files(disk.unionByName(junk)), partitions)
    edge = F.array(F.struct(F.lit("next").alias("id"), F.lit("post").alias("side"), F.lit("e1").alias("version"), F.lit(True).alias("here")))
    none = F.filter(edge, lambda e: F.col("files") < 0)  # no month has a neighbour here
    texts = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    renderings = judged.select(F.concat_ws("/", "venue", "dataset", "month").alias("key"), F.concat_ws("/", *reconcile.PARTITION).alias("partition"), F.lit(0).alias("rank"), "files", F.lit("v").alias("version"), texts("every=1.0.0").alias("versions"),
                               F.lit("[]").alias("fields"), (F.col("verdict") == "complete").alias("on_disk"), none.alias("edges"), texts().alias("missing"), "verdict")
    ledger = renderings.filter("key LIKE 'n/%'").select("key", "partition", "version", F.lit("old").alias("revision"), texts().alias("lacking"))
    decided = reconcile.decide(renderings.drop("verdict"), ledger)
    return decided.join(renderings.select("key", "verdict"), "key").select("key", "verdict", "status")


def ledger_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.catalog_files(spark, sf_dir).withColumn("partition", F.concat_ws("/", *BY)).select("partition", "size", "series", "venue")
    ledger = f.groupBy("partition").agg(F.count("*").alias("count"), F.sum("size").alias("size"), F.min("venue").alias("revision"))
    return reconcile.validate_ledger(ledger, f.filter("series % 40 <> 7").select("partition", F.when(F.col("series") % 40 == 8, F.col("size") + 1).otherwise(F.col("size")).alias("size")), ledger.filter("revision = 'R'").select("partition", "revision"))


def batches_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices packed into bins; SQL has no form for first-fit."""
    return reconcile.pack_batches(_renderings(spark, sf_dir), 4000)


def spill_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.partitions(spark, sf_dir).select("venue", F.lit("spot").alias("market"), "dataset", F.lit("").alias("variant"), "month", F.concat_ws("/", *BY).alias("partition"))
    return reconcile.spill_reach(p, "both")


def sides_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each week's ticks with those of the two days on either side of its edges as side rows, some of which it has itself; a symbol's
    week is taken for its month."""
    from marketloom.streaming.streams import accept_late

    t = views.ticks(spark, sf_dir)
    day = F.expr("ts div 86400000000 - 19723")
    of = lambda rows, shift: rows.withColumn("symbol", F.concat_ws("/", "symbol", F.floor(day / 7) + shift))
    edge = lambda *days: t.filter((day % 7).isin(*days))
    pre, post = of(edge(5, 6), 1).unionByName(of(edge(0), 0)), of(edge(0, 1), -1).unionByName(of(edge(6), 0))
    return accept_late(of(t, 0), pre, post).select("symbol", "ts", "sequence")


def names_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive keys made of parts' names, and their parts read back."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    stamp = F.element_at(F.array(F.lit("202402"), F.lit("20240229"), F.lit("2024022907"), F.lit("202402290715")), (k % 4 + 1).cast("int"))
    ext = F.element_at(F.array(F.lit(".zip"), F.lit(".csv.gz"), F.lit(".tar.gz"), F.lit(".part3.csv"), F.lit(".csv.xz"), F.lit(".bak")), (k % 6 + 1).cast("int"))
    key = F.concat(F.lit("x/"), F.concat_ws("|", F.lit("okx"), F.when(k % 2 == 0, "spot").otherwise("perp"), F.when(k % 3 == 0, "klines,1m").otherwise("trades"), F.when(k % 5 == 0, "@").otherwise(F.concat(F.lit("BTC-USD-"), k)), F.concat(stamp, ext)))
    out = names.parse_keys(p.select("p_partkey", key.alias("key")))
    first, last = names.edge_of(F.col("date"), F.col("grain"))
    return out.withColumns({"first": first, "last": last, "margin": names.margin_of(F.col("venue"), F.col("market"), F.col("symbol"))}).drop("key")


def intervals_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    unit = F.element_at(F.array(*[F.lit(x) for x in ("s", "min", "m", "h", "d", "w", "mo", "", "parsec")]), (F.col("p_partkey") % 9 + 1).cast("int"))
    token = F.concat(F.col("p_partkey") % 97, unit)
    return p.select("p_partkey", token.alias("token"), names.canonical_interval(token).alias("interval"))


def tags_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.catalog_files(spark, sf_dir)
    n = F.col("number")
    raw = (F.when(n == 1, F.concat(F.lit('"'), F.upper("etag"), F.lit('"'))).when(n == 2, F.concat(F.lit("&quot;"), "etag", F.lit("-gzip&quot;"))).when(n == 3, F.concat("etag", F.lit("-7")))
           .when(n == 4, F.concat(F.lit('W/"'), "etag", F.lit('"'))).when(n == 5, F.concat(F.lit('a"'), "etag", F.lit("-GZIP"))).otherwise(F.col("etag")))
    return f.select("path", names.norm_etag(raw).alias("tag"), names.is_digest(raw).alias("digest"))


def periods_stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    grain = F.element_at(F.array(F.lit("monthly"), F.lit("daily"), F.lit("hourly"), F.lit("minutely")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    stamp = F.substring(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("2359")), F.lit(1), F.element_at(F.array(*[F.lit(x) for x in (6, 8, 10, 12)]), (F.col("o_orderkey") % 4 + 1).cast("int")))
    now = F.col("o_orderdate").cast("timestamp")
    return o.select("o_orderkey", grain.alias("grain"), stamp.alias("stamp"), next_period(stamp, grain).alias("after"), next_period(stamp, grain, -1).alias("before"), last_closed(grain, now).alias("closed"), last_settled(grain, now).alias("settled"))


def keys_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as files of four URL patterns, with the key, extension, part and bar length of each."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    pick = lambda *x: F.element_at(F.array(*[F.lit(v) for v in x]), (k % len(x) + 1).cast("int"))
    pattern = pick("a/1m/{SYMBOL}-{YYYY}-{MM}-{DD}.zip", "b/{SYMBOL}_15_{YYYY}.csv.gz", "c/{SYMBOL}.{YYYY}{MM}.part{PART}.gz", "d/slice_{SYMBOL}_{YYYY}")
    path = F.concat(pick("a/1m/S", "b/S", "c/S", "d/slice_s"), pick("-2024-02-03.zip", "_15_2024.CSV.gz", ".202402.part", "_2024"), F.when(k % 4 == 2, F.concat(k % 7, F.lit(".gz"))).otherwise(""))
    prefix = F.concat(F.lit("v/spot/trades/"), F.when(k % 5 == 0, "@/").otherwise("S/SYM/"))
    return p.select("p_partkey", listing.catalog_key(prefix, pattern, F.lit("20240203"), path).alias("key"), listing.part_of(path, pattern).alias("part"), listing.extension_of(path).alias("extension"), listing.interval_of(pattern).alias("interval"))


def levels_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    pick = lambda *x: F.element_at(F.array(*[F.lit(v) for v in x]), (k % len(x) + 1).cast("int"))
    levels = listing.levels_map(pick("klines", "books", "trades", "funding", "quotes"), pick("", "1m", "snapshot,20,raw"))
    return p.select("p_partkey", *[levels[n].alias(n) for n in ("interval", "kind", "depth", "aggregation")])


def selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renderings(spark, sf_dir).filter(listing.means(market="spot", dataset="2-HIGH", variant="", start="199501", end="199606")).select("partition", "files")


QUERIES = {f.__name__: f for f in (
    keys_listed, levels_named, selection,
    partition_counters, partition_versions, venue_totals, counter_deltas, contents_shapes, contents_markets, contents_symbols, series_counts, series_bounds, partition_months, settled_partitions, renderings_preferred,
    lens_members, lens_figures, lens_changes, spans_united, spans_cut, contents_through_lens, listing_page, expected_days, missing_days, listing_merged, listing_merged_ranges, listing_page_ranges, listing_revisions, files_withdrawn, files_settled, reports_applied, series_reconciled,
    coverage, months_backed, month_bytes, files_duplicated, cold_stats, coverage_gaps, stage_lag, ledger_current, ledger_repairs, store_reconciled, plans_compared, stocking_decided, stocking_from_storage, ledger_validated, batches_packed, spill_neighbours,
    sides_accepted, names_parsed, intervals_canonical, tags_normalised, periods_stepped)}

_B = "venue, dataset, month"
_BOUNDED = f"{views.CATALOG_FILES}, {views.SERIES}, bounded AS (SELECT s.*, b.first, b.last FROM series s LEFT JOIN (SELECT series, min(date) AS first, max(date) AS last FROM catalog_files WHERE existence <> 'absent' GROUP BY series) b USING (series))"
_BEFORE = f"""{views.CATALOG_FILES}, bef AS (SELECT * FROM catalog_files WHERE series % 10 <> 3), page AS (SELECT venue, path, date, CASE WHEN series % 10 = 5 THEN size + 1 ELSE size END AS size, CASE WHEN series % 10 <> 6 THEN etag END AS etag,
 CASE WHEN series % 10 = 7 THEN 'n' ELSE 'm' END AS modified, 'confirmed' AS existence FROM catalog_files WHERE series % 10 <> 4)"""
_GROUPED = "SELECT venue, existence, count(*) AS files, sum(size)::BIGINT AS bytes, count(*) FILTER (downloaded_at IS NULL) AS owed FROM r GROUP BY ALL"
ORACLES = {
    "keys_listed": """WITH k AS (SELECT p_partkey AS k, 'v/spot/trades/' || CASE WHEN p_partkey % 5 = 0 THEN '@/' ELSE 'S/SYM/' END AS prefix, CASE WHEN p_partkey % 5 = 0 THEN '@' ELSE 'SYM' END AS sym, CASE WHEN p_partkey % 4 = 2 THEN CAST(p_partkey % 7 AS VARCHAR) END AS part,
 CASE p_partkey % 4 WHEN 0 THEN '.zip' WHEN 1 THEN '.csv.gz' WHEN 2 THEN '.part' || p_partkey % 7 || '.gz' ELSE '.txt' END AS extension FROM part)
SELECT k AS p_partkey, prefix || '202402/v|spot|trades|' || sym || '|20240203' || coalesce('.part' || part, '') || extension AS key, part, extension, CASE k % 4 WHEN 0 THEN '1m' WHEN 1 THEN '15' END AS interval FROM k""",
    "levels_named": """SELECT p_partkey, CASE WHEN d = 0 THEN CASE v WHEN 1 THEN '1m' WHEN 2 THEN 'snapshot,20,raw' END END AS interval, CASE WHEN d = 1 THEN CASE v WHEN 1 THEN '1m' WHEN 2 THEN 'snapshot' END WHEN d = 3 THEN CASE v WHEN 1 THEN '1m' WHEN 2 THEN 'snapshot,20,raw' END END AS kind,
 CASE WHEN d = 1 AND v = 2 THEN '20,raw' END AS depth, CASE WHEN d = 2 THEN CASE v WHEN 0 THEN 'default' WHEN 1 THEN '1m' ELSE 'snapshot,20,raw' END END AS aggregation FROM (SELECT p_partkey, p_partkey % 5 AS d, p_partkey % 3 AS v FROM part)""",
    "selection": f"WITH {_RENDER} SELECT partition, files FROM rend WHERE market = 'spot' AND dataset = '2-HIGH' AND month BETWEEN '199501' AND '199606'",
    "partition_counters": f"WITH {views.PARTITIONS} SELECT * FROM partitions",
    "partition_versions": f"WITH {views.CATALOG_FILES} SELECT {_B}, coalesce({_VERSION}, '0000000000000000') AS version FROM catalog_files GROUP BY {_B}",
    "venue_totals": f"""WITH {views.PARTITIONS}, v AS (SELECT DISTINCT venue FROM catalog_files UNION ALL SELECT r_name FROM region), p AS (SELECT * FROM partitions)
SELECT venue, min(month) FILTER (files > 0) AS first, max(month) FILTER (files > 0) AS last, coalesce(sum(files), 0)::BIGINT AS files, coalesce(sum(bytes), 0)::BIGINT AS bytes, coalesce(sum(pending), 0)::BIGINT AS pending, coalesce(sum(withdrawn), 0)::BIGINT AS withdrawn FROM v LEFT JOIN p USING (venue) GROUP BY venue""",
    "counter_deltas": f"""WITH {views.CATALOG_FILES}, e AS (SELECT concat_ws('/', {_B}) AS partition, -1 AS sign, existence, size, downloaded_at FROM catalog_files WHERE series % 2 = 0
 UNION ALL SELECT concat_ws('/', {_B}), 1, CASE WHEN series % 5 = 0 THEN 'absent' ELSE existence END, size, downloaded_at FROM catalog_files),
d AS (SELECT partition, sum(CASE WHEN existence = 'confirmed' THEN sign ELSE 0 END)::BIGINT AS files, sum(CASE WHEN existence = 'confirmed' THEN sign * size ELSE 0 END)::BIGINT AS bytes,
 sum(CASE WHEN existence = 'confirmed' AND downloaded_at IS NULL THEN sign ELSE 0 END)::BIGINT AS pending, sum(CASE WHEN existence = 'absent' THEN sign ELSE 0 END)::BIGINT AS withdrawn FROM e GROUP BY partition)
SELECT * FROM d WHERE files <> 0 OR bytes <> 0 OR pending <> 0 OR withdrawn <> 0""",
    "contents_shapes": f"WITH {_BOUNDED} SELECT market, dataset, variant, grain, count(*) FILTER (symbol <> '@') AS symbols, count(*) FILTER (symbol = '@') AS buckets, min(first) AS first, max(last) AS last FROM bounded GROUP BY ALL",
    "contents_markets": f"WITH {views.SERIES} SELECT market, dataset, count(DISTINCT (variant, grain)) AS shapes, count(DISTINCT symbol) FILTER (symbol <> '@') AS symbols, array_to_string(list_sort(list(DISTINCT variant)), '|') AS variants, array_to_string(list_sort(list(DISTINCT grain)), '|') AS grains FROM series GROUP BY ALL",
    "contents_symbols": f"WITH {views.SERIES} SELECT DISTINCT symbol FROM series WHERE symbol <> '@'",
    "series_counts": f"WITH {_BOUNDED} SELECT host, count(*) AS series, count(first) AS with_files FROM bounded GROUP BY host",
    "series_bounds": f"WITH {views.CATALOG_FILES} SELECT venue, series, min(date) AS first, max(date) AS last FROM catalog_files WHERE existence <> 'absent' GROUP BY ALL",
    "partition_months": f"WITH {views.PARTITIONS} SELECT venue, dataset, count(*)::INT AS months, min(month) AS oldest, string_agg(month || ':' || files, ',' ORDER BY month) AS listing FROM partitions GROUP BY ALL",
    "settled_partitions": f"""WITH {views.CATALOG_FILES}, t AS (SELECT {_B}, max(downloaded_at) AS u FROM catalog_files GROUP BY {_B}), e AS (SELECT least(TIMESTAMP '1998-07-01', coalesce(min(o_orderdate), TIMESTAMP '1998-07-01')) AS edge FROM orders WHERE o_orderstatus = 'O' AND o_orderdate >= DATE '1998-06-01')
SELECT {_B} FROM t, e WHERE month < '199808' AND u < edge""",
    "renderings_preferred": f"""WITH {_RENDER}, n AS (SELECT *, row_number() OVER (PARTITION BY venue, market, dataset, variant, month ORDER BY bundle <> 'instrument', CASE grain WHEN 'monthly' THEN 0 WHEN 'daily' THEN 1 WHEN 'hourly' THEN 2 ELSE 3 END) AS n FROM rend)
SELECT venue, market, dataset, variant, month, grain, bundle, files FROM n WHERE n = 1""",
    "lens_members": f"WITH {_LENS} SELECT partition, files, bytes FROM lens",
    "lens_figures": f"WITH {_LENS} SELECT venue, count(*) AS partitions, sum(files)::BIGINT AS files, sum(bytes)::BIGINT AS bytes FROM lens GROUP BY ROLLUP (venue)",
    "lens_changes": f"WITH {_LENS}, held AS (SELECT partition FROM rend WHERE files > 2) SELECT partition, 'add' AS change FROM lens WHERE partition NOT IN (SELECT partition FROM held) UNION ALL SELECT partition, 'remove' FROM held WHERE partition NOT IN (SELECT partition FROM lens)",
    "spans_united": f"WITH {_SPANS} SELECT slice, {_MONTH.format(x='a')} AS \"from\", {_MONTH.format(x='b')} AS \"to\" FROM {_ISLANDS.format(spans='sp')}",
    "spans_cut": f"""WITH {_SPANS}, plus AS (SELECT DISTINCT slice, unnest(range(a, b + 1)) AS m FROM sp WHERE o_orderkey % 2 = 0), minus AS (SELECT DISTINCT slice, unnest(range(a, b + 1)) AS m FROM sp WHERE o_orderkey % 2 = 1)
SELECT slice, {_MONTH.format(x='m')} AS month FROM (SELECT * FROM plus EXCEPT SELECT * FROM minus)""",
    "contents_through_lens": f"""WITH {_SPANS}, {_OPEN_SPANS}, {views.CATALOG_FILES}, s AS (SELECT 'C' || owner AS slice, dataset AS series, min(date) AS first, max(date) AS last FROM catalog_files GROUP BY ALL),
u AS (SELECT slice, {_MONTH.format(x='a')} AS f, {_MONTH.format(x='b')} AS t FROM {_ISLANDS.format(spans='open_spans')}), j AS (SELECT slice, series, greatest(first, f) AS first, least(last, t || '99') AS last FROM s JOIN u USING (slice))
SELECT * FROM j WHERE substr(first, 1, 6) <= substr(last, 1, 6)""",
    "listing_page": f"""WITH {views.CATALOG_FILES}, k AS (SELECT concat_ws('|', venue, dataset, date, path) AS key, max(size) AS size FROM catalog_files GROUP BY 1), n AS (SELECT *, row_number() OVER (ORDER BY key) AS n, count(*) OVER () AS c FROM k WHERE starts_with(key, 'N|3-MEDIUM') AND key > 'N|3-MEDIUM|19960101')
SELECT key, size, c > 200 AS more FROM n WHERE n <= 200""",
    "listing_page_ranges": f"""WITH {views.CATALOG_FILES}, k AS (SELECT concat_ws('|', venue, dataset, date, path) AS key, max(size) AS size FROM catalog_files GROUP BY 1), n AS (SELECT *, row_number() OVER (ORDER BY key) AS n, count(*) OVER () AS c FROM k WHERE starts_with(key, 'N|3-MEDIUM') AND key > 'N|3-MEDIUM|19960101')
SELECT key, size, c > 200 AS more FROM n WHERE n <= 200""",
    "expected_days": f"WITH {_EXPECTED} SELECT * FROM want",
    "missing_days": f"WITH {_EXPECTED}, {views.CATALOG_FILES} SELECT * FROM want ANTI JOIN catalog_files USING (series, date)",
    "listing_merged": f"""WITH {_BEFORE}, j AS (SELECT coalesce(b.venue, p.venue) AS venue, coalesce(b.path, p.path) AS path, CASE WHEN p.path IS NULL THEN 'unlisted' WHEN b.path IS NULL THEN 'created'
 WHEN b.existence = 'confirmed' AND (p.size <> b.size OR p.etag <> b.etag) THEN 'revised' WHEN p.size <> b.size OR p.etag <> b.etag OR p.modified <> 'm' OR p.existence <> b.existence THEN 'restated' ELSE 'unchanged' END AS action,
 coalesce(p.existence, b.existence) AS existence, coalesce(p.size, b.size) AS size, b.downloaded_at AS d FROM bef b FULL JOIN page p ON b.venue = p.venue AND b.path = p.path)
SELECT venue, action, existence, count(*) AS files, sum(size)::BIGINT AS bytes, count(*) FILTER (d IS NULL OR action = 'revised') AS owed, min(path) AS lowest FROM j GROUP BY ALL""",
    "listing_merged_ranges": f"""WITH {_BEFORE}, q AS (SELECT * FROM page WHERE venue = 'N' AND path >= '2' AND path < '3'), j AS (SELECT coalesce(b.venue, p.venue) AS venue, coalesce(b.path, p.path) AS path, coalesce(p.existence, b.existence) AS existence, coalesce(p.size, b.size) AS size,
 CASE WHEN b.existence = 'confirmed' AND (p.size <> b.size OR p.etag <> b.etag) THEN NULL ELSE b.downloaded_at END AS d FROM bef b FULL JOIN q p ON b.venue = p.venue AND b.path = p.path)
SELECT venue, existence, count(*) AS files, sum(size)::BIGINT AS bytes, count(*) FILTER (d IS NULL) AS owed, min(path) AS lowest, max(path) AS highest, true AS mostly_kept FROM j GROUP BY ALL""",
    "listing_revisions": f"WITH {_BEFORE} SELECT b.venue, b.path, b.size, b.etag FROM bef b JOIN page p ON b.venue = p.venue AND b.path = p.path WHERE b.existence = 'confirmed' AND (p.size <> b.size OR p.etag <> b.etag)",
    "files_withdrawn": f"WITH {_BEFORE} SELECT venue, path, 'absent' AS existence, size FROM bef b WHERE existence <> 'absent' AND path BETWEEN '1' AND '5' AND NOT EXISTS (SELECT 1 FROM page p WHERE p.venue = b.venue AND p.path = b.path)",
    "files_settled": f"""WITH {views.CATALOG_FILES}, f AS (SELECT venue, path, size, etag, existence, downloaded_at FROM catalog_files WHERE series % 10 NOT IN (5, 6)),
c AS (SELECT venue, path, CASE WHEN series % 10 = 2 THEN size + 1 ELSE size END AS size, CASE WHEN series % 10 = 7 THEN 'absent' ELSE 'confirmed' END AS existence, etag FROM catalog_files WHERE series % 10 NOT IN (3, 4, 6)),
r AS (SELECT venue, existence, size, NULL::TIMESTAMP AS downloaded_at FROM c WHERE (venue, path) NOT IN (SELECT venue, path FROM f)
 UNION ALL SELECT f.venue, 'confirmed', c.size, CASE WHEN c.size = f.size THEN f.downloaded_at END FROM f JOIN c ON f.venue = c.venue AND f.path = c.path WHERE f.existence = 'absent' AND c.existence = 'confirmed'
 UNION ALL SELECT venue, existence, size, downloaded_at FROM f WHERE (venue, path) NOT IN (SELECT f.venue, f.path FROM f JOIN c ON f.venue = c.venue AND f.path = c.path WHERE f.existence = 'absent' AND c.existence = 'confirmed')) {_GROUPED}""",
    "reports_applied": f"""WITH {views.CATALOG_FILES}, r AS (SELECT venue, CASE WHEN series % 10 < 5 AND series % 3 = 1 AND number % 2 = 0 THEN 'absent' ELSE existence END AS existence, CASE WHEN series % 10 < 5 AND series % 3 = 2 THEN size + 2 ELSE size END AS size,
 CASE WHEN series % 10 < 5 AND series % 3 = 2 THEN NULL WHEN series % 10 < 5 AND series % 3 = 0 AND downloaded_at IS NULL AND existence = 'confirmed' THEN TIMESTAMP '1999-01-01' ELSE downloaded_at END AS downloaded_at FROM catalog_files) {_GROUPED}""",
    "series_reconciled": f"""WITH {views.CATALOG_FILES}, g AS (SELECT * FROM (VALUES (0, 'monthly', 6, '199804', '199805'), (1, 'daily', 8, '19980525', '19980609'), (2, 'hourly', 10, '1998052611', '1998061011'), (3, 'minutely', 12, '199805261229', '199806101229')) t(k, grain, w, settled, closed)),
s AS (SELECT s_suppkey AS series, g.*, CASE WHEN s_suppkey % 7 > 0 THEN CASE WHEN s_suppkey % 3 = 0 THEN '199501010000' ELSE '199606010000' END END AS first, CASE WHEN s_suppkey % 7 > 0 THEN CASE s_suppkey % 3 WHEN 0 THEN '209912310000' WHEN 1 THEN '199805150000' ELSE '199701010000' END END AS last,
 CASE WHEN s_suppkey % 7 > 1 THEN CASE WHEN s_suppkey % 2 = 0 THEN '199807010000' ELSE '199001010000' END END AS tip FROM supplier JOIN g ON s_suppkey % 4 = k),
b AS (SELECT series, min(date) || '0730' AS f, max(date) || '0730' AS l FROM catalog_files WHERE existence <> 'absent' AND series % 5 <> 1 GROUP BY series),
r AS (SELECT s.series, grain, left(f, w) AS f, left(l, w) AS l, left(first, w) AS first, left(last, w) AS last, left(tip, w) AS tip, settled, closed FROM s JOIN b USING (series)),
u AS (SELECT *, CASE WHEN last IS NOT NULL AND CASE WHEN last < closed THEN last ELSE closed END > settled THEN CASE WHEN last < closed THEN last ELSE closed END ELSE settled END AS upto FROM r)
SELECT series, grain, f AS first, l AS last, CASE WHEN tip IS NULL OR tip < upto THEN upto ELSE tip END AS tip, tip IS NULL OR tip < upto AS lifted, first IS DISTINCT FROM f OR last IS DISTINCT FROM l AS corrected FROM u""",
    "coverage": f"""WITH {_PARTS}, m AS (SELECT venue, month, count(*) AS parts, sum(size) AS bytes, count(*) FILTER (uploaded) AS sent FROM parts GROUP BY ALL)
SELECT venue, count(*) AS months, count(*) FILTER (sent = parts) AS whole, sum(parts)::BIGINT AS parts, sum(bytes)::BIGINT AS bytes, sum(sent)::BIGINT AS sent, round(sum(sent / parts), 6) AS share FROM m GROUP BY ROLLUP (venue)""",
    "months_backed": f"WITH {_PARTS} SELECT venue, month, bool_and(uploaded) AS backed FROM parts GROUP BY ALL",
    "month_bytes": f"WITH {_PARTS} SELECT venue, month, sum(size)::BIGINT AS bytes FROM parts GROUP BY ALL",
    "files_duplicated": f"WITH {views.CATALOG_FILES} SELECT concat_ws('/', venue, dataset, date) AS key, count(*) AS places FROM catalog_files GROUP BY 1 HAVING count(*) > 1",
    "cold_stats": f"WITH {_PARTS} SELECT venue, count(*) AS files, sum(size)::BIGINT AS bytes, min(month) AS first, max(month) AS last FROM parts GROUP BY venue",
    "coverage_gaps": f"""WITH {views.CATALOG_FILES}, h AS (SELECT DISTINCT owner, CAST(substr(month, 1, 4) AS BIGINT) * 12 + CAST(substr(month, 5, 2) AS BIGINT) - 1 AS m FROM catalog_files),
w AS (SELECT owner, unnest(range(min(m), max(m) + 1)) AS m FROM h GROUP BY owner) SELECT owner, {_MONTH.format(x='m')} AS month FROM (SELECT * FROM w EXCEPT SELECT * FROM h)""",
    "stage_lag": f"""WITH {views.CATALOG_FILES}, a AS (SELECT DISTINCT series, month FROM catalog_files), b AS (SELECT DISTINCT series, month FROM catalog_files WHERE number < 3), n AS (SELECT series, max(month) AS newest FROM a GROUP BY series)
SELECT series, month FROM (SELECT * FROM a EXCEPT SELECT * FROM b) JOIN n USING (series) WHERE month <> newest""",
    "ledger_current": f"""WITH {_LEDGER}, held AS (SELECT partition, line, state FROM led a WHERE state = 'stocked' AND NOT EXISTS (SELECT 1 FROM led b WHERE b.partition = a.partition AND b.line > a.line AND b.state IN ('stocked', 'updating')))
SELECT partition, line, state, EXISTS (SELECT 1 FROM led b WHERE b.partition = held.partition AND b.line > held.line AND b.state = 'outdated') AS outdated FROM held WHERE line % 10 <> 3""",
    "ledger_repairs": f"""WITH {_LEDGER}, now AS (SELECT * FROM led QUALIFY row_number() OVER (PARTITION BY partition ORDER BY line DESC) = 1), was AS (SELECT * FROM led WHERE state = 'stocked' QUALIFY row_number() OVER (PARTITION BY partition ORDER BY line DESC) = 1),
j AS (SELECT now.partition, was.partition IS NOT NULL AND was.grain = now.grain AND was.version = now.version AND (was.pre = now.pre OR was.pre = 'missing') AND (was.post = now.post OR was.post = 'missing') AS same, was.pre = 'missing' AND now.pre <> 'missing' AS pre, was.post = 'missing' AND now.post <> 'missing' AS post
 FROM now LEFT JOIN was USING (partition) WHERE now.state = 'updating'), r AS (SELECT partition, CASE WHEN same THEN concat_ws(',', CASE WHEN pre THEN 'pre' END, CASE WHEN post THEN 'post' END) ELSE '' END AS sides FROM j)
SELECT partition, CASE WHEN sides <> '' THEN 'undo sides' ELSE 'drop' END AS action, sides FROM r WHERE sides <> '' OR partition IN (SELECT partition FROM led WHERE line % 11 > 0)""",
    "store_reconciled": f"""WITH {views.CATALOG_FILES}, v AS (SELECT CASE series % 10 WHEN 1 THEN 'missing' WHEN 2 THEN 'renamed' WHEN 3 THEN 'resized' ELSE 'equal' END AS verdict, path FROM catalog_files UNION ALL SELECT 'orphaned', path || '~' FROM catalog_files WHERE series % 10 = 2)
SELECT verdict, count(*) AS files, min(path) AS lowest, max(path) AS highest FROM v GROUP BY verdict""",
    "plans_compared": f"""WITH {views.CATALOG_FILES}, r AS (SELECT {_B}, coalesce({_VERSION}, '0000000000000000') AS version FROM catalog_files GROUP BY {_B}), h AS (SELECT {_B}, coalesce({_VERSION}, '0000000000000000') AS old FROM catalog_files WHERE series % 50 <> 9 AND venue <> 'R' GROUP BY {_B})
SELECT venue, CASE WHEN old IS NULL THEN 'new' WHEN old <> version THEN 'changed' ELSE 'unchanged' END AS plan, count(*) AS partitions, min(version) AS lowest FROM r LEFT JOIN h USING ({_B}) GROUP BY ALL""",
    "stocking_decided": f"""WITH {views.PARTITIONS}, d AS (SELECT concat_ws('/', {_B}) AS key, files, CASE WHEN files = 0 THEN 'waiting' ELSE CASE files % 8 WHEN 0 THEN 'current' WHEN 1 THEN 'restock' WHEN 2 THEN 'stock' WHEN 3 THEN 'complete' WHEN 4 THEN 'pending' WHEN 5 THEN 'restock' WHEN 6 THEN 'stock' ELSE 'outdated' END END AS status FROM partitions)
SELECT key, status, CASE WHEN status IN ('restock', 'stock', 'complete') THEN CASE WHEN files % 8 IN (5, 6) THEN '1' ELSE '0' END END AS rendering, CASE WHEN status = 'complete' THEN 'post' END AS sides FROM d""",
    "stocking_from_storage": f"""WITH {views.CATALOG_FILES}, k AS (SELECT lower(venue) AS venue, 'd' || left(dataset, 1) AS dataset, left(month, 4) || '-' || right(month, 2) AS month, count(*) AS files FROM catalog_files WHERE existence = 'confirmed' GROUP BY ALL),
v AS (SELECT *, CASE right(month, 1) WHEN '1' THEN CASE WHEN files = 1 THEN 'absent' ELSE 'incomplete' END WHEN '2' THEN 'incomplete' WHEN '3' THEN 'absent' ELSE 'complete' END AS verdict FROM k)
SELECT venue || '/' || dataset || '/' || month AS key, verdict, CASE WHEN venue = 'n' THEN CASE verdict WHEN 'complete' THEN 'restock' ELSE 'outdated' END ELSE CASE verdict WHEN 'complete' THEN 'stock' ELSE 'missing' END END AS status FROM v""",
    "ledger_validated": f"""WITH {views.CATALOG_FILES}, l AS (SELECT concat_ws('/', {_B}) AS partition, any_value(venue) AS venue, count(*) AS n, count(*) FILTER (series % 40 <> 7) AS held, count(*) FILTER (series % 40 = 8) AS grown FROM catalog_files GROUP BY 1)
SELECT partition, CASE WHEN held = 0 THEN 'gone' WHEN held <> n THEN 'wrong count' ELSE 'wrong bytes' END AS finding FROM l WHERE venue <> 'R' AND (held <> n OR grown > 0)""",
    "spill_neighbours": f"""WITH {views.PARTITIONS}, p AS (SELECT *, concat_ws('/', {_B}) AS partition, CAST(substr(month, 1, 4) AS BIGINT) * 12 + CAST(substr(month, 5, 2) AS BIGINT) AS m FROM partitions)
SELECT a.partition, b.partition AS neighbour, side FROM (SELECT *, 'first' AS side, m + 1 AS o FROM p UNION ALL SELECT *, 'last', m - 1 FROM p) a LEFT JOIN p b ON a.venue = b.venue AND a.dataset = b.dataset AND b.m = a.o""",
    "sides_accepted": f"""WITH {views.TICKS}, d AS (SELECT *, ts // 86400000000 - 19723 AS day FROM ticks), own AS (SELECT symbol || '/' || day // 7 AS symbol, ts, sequence FROM d), r AS (SELECT symbol, min(ts) AS f, max(ts) AS l FROM own GROUP BY symbol)
SELECT symbol, ts, sequence FROM own UNION ALL SELECT r.symbol, ts, sequence FROM d JOIN r ON r.symbol = d.symbol || '/' || (day // 7 + 1) WHERE day % 7 IN (5, 6) AND ts < f
UNION ALL SELECT r.symbol, ts, sequence FROM d JOIN r ON r.symbol = d.symbol || '/' || (day // 7 - 1) WHERE day % 7 IN (0, 1) AND ts > l""",
    "names_parsed": """WITH k AS (SELECT p_partkey AS k, p_partkey % 6 NOT IN (4, 5) AS ok, CASE p_partkey % 4 WHEN 0 THEN '202402' WHEN 1 THEN '20240229' WHEN 2 THEN '2024022907' ELSE '202402290715' END AS d FROM part)
SELECT k AS p_partkey, CASE WHEN ok THEN 'okx' END AS venue, CASE WHEN ok THEN CASE WHEN k % 2 = 0 THEN 'spot' ELSE 'perp' END END AS market, CASE WHEN ok THEN CASE WHEN k % 3 = 0 THEN 'klines' ELSE 'trades' END END AS dataset,
 CASE WHEN ok THEN CASE WHEN k % 3 = 0 THEN '1m' ELSE '' END END AS variant, CASE WHEN ok THEN CASE WHEN k % 5 = 0 THEN 'market' ELSE 'instrument' END END AS bundle, CASE WHEN ok THEN CASE WHEN k % 5 = 0 THEN '@' ELSE 'BTC-USD-' || k END END AS symbol,
 CASE WHEN ok THEN '2024-02' END AS month, CASE WHEN ok THEN d END AS date, CASE WHEN ok THEN CASE k % 4 WHEN 0 THEN 'monthly' WHEN 1 THEN 'daily' WHEN 2 THEN 'hourly' ELSE 'minutely' END END AS grain,
 CASE WHEN k % 6 = 3 THEN '3' END AS part, CASE WHEN ok THEN CASE k % 6 WHEN 0 THEN 'zip' WHEN 1 THEN 'gzip' WHEN 2 THEN 'tar.gz' ELSE 'plain' END END AS container,
 CASE WHEN ok THEN k % 4 = 0 END AS first, CASE WHEN ok THEN true END AS last, CASE WHEN ok AND k % 2 = 1 THEN CASE WHEN k % 5 = 0 THEN 'linear' ELSE 'inverse' END END AS margin FROM k""",
    "intervals_canonical": """WITH k AS (SELECT p_partkey, p_partkey % 97 AS n, p_partkey % 9 AS u FROM part), s AS (SELECT *, n * CASE u WHEN 0 THEN 1 WHEN 1 THEN 60 WHEN 2 THEN 60 WHEN 3 THEN 3600 WHEN 4 THEN 86400 WHEN 5 THEN 604800 WHEN 7 THEN 60 END AS s FROM k)
SELECT p_partkey, n || CASE u WHEN 0 THEN 's' WHEN 1 THEN 'min' WHEN 2 THEN 'm' WHEN 3 THEN 'h' WHEN 4 THEN 'd' WHEN 5 THEN 'w' WHEN 6 THEN 'mo' WHEN 7 THEN '' ELSE 'parsec' END AS token,
 CASE WHEN u = 6 THEN CASE WHEN n > 0 THEN n || 'mo' END WHEN s IS NULL OR s <= 0 THEN NULL WHEN s < 60 THEN s || 's' WHEN s < 3600 AND s % 60 = 0 THEN s // 60 || 'm' WHEN s < 86400 AND s % 3600 = 0 THEN s // 3600 || 'h' WHEN s < 604800 AND s % 86400 = 0 THEN s // 86400 || 'd'
 WHEN s % 604800 = 0 THEN s // 604800 || 'w' WHEN s % 86400 = 0 THEN s // 86400 || 'd' WHEN s % 3600 = 0 THEN s // 3600 || 'h' WHEN s % 60 = 0 THEN s // 60 || 'm' ELSE s || 's' END AS interval FROM s""",
    "tags_normalised": f"WITH {views.CATALOG_FILES} SELECT path, CASE number WHEN 3 THEN etag || '-7' WHEN 4 THEN 'w/' || chr(34) || etag WHEN 5 THEN 'a' || chr(34) || etag || '-gzip' ELSE etag END AS tag, number NOT IN (3, 4, 5) AS digest FROM catalog_files",
    "periods_stepped": """WITH o AS (SELECT o_orderkey, o_orderdate AS d, o_orderdate + INTERVAL '23 hours 59 minutes' AS e, o_orderkey % 4 AS g FROM orders),
f AS (SELECT *, CASE g WHEN 0 THEN 6 WHEN 1 THEN 8 WHEN 2 THEN 10 ELSE 12 END AS w, CASE g WHEN 0 THEN INTERVAL 1 MONTH WHEN 1 THEN INTERVAL 1 DAY WHEN 2 THEN INTERVAL 1 HOUR ELSE INTERVAL 1 MINUTE END AS i,
 CASE g WHEN 0 THEN date_trunc('month', d) WHEN 1 THEN d WHEN 2 THEN date_trunc('hour', e) ELSE e END AS base FROM o),
t AS (SELECT o_orderkey, g, w, e, base + i AS after, base - i AS before, CASE WHEN g = 0 THEN date_trunc('month', d) ELSE d END - i AS closed, CASE WHEN g = 0 THEN date_trunc('month', d - INTERVAL 15 DAY) ELSE d - INTERVAL 15 DAY END - i AS settled FROM f)
SELECT o_orderkey, CASE g WHEN 0 THEN 'monthly' WHEN 1 THEN 'daily' WHEN 2 THEN 'hourly' ELSE 'minutely' END AS grain, substr(strftime(e, '%Y%m%d%H%M'), 1, w) AS stamp, substr(strftime(after, '%Y%m%d%H%M'), 1, w) AS after,
 substr(strftime(before, '%Y%m%d%H%M'), 1, w) AS before, substr(strftime(closed, '%Y%m%d%H%M'), 1, w) AS closed, substr(strftime(settled, '%Y%m%d%H%M'), 1, w) AS settled FROM t""",
}
