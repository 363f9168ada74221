"""Queries over listings, series views, lenses in draft, keys to be expected and records of what is stored, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import listing, names, times
from marketloom.operators import catalog, lenses, reconcile
from marketloom.plans import queries_catalog as base
from marketloom.plans import views
from marketloom.schema import fields_json
from marketloom.session import table

BY = base.BY


def _pick(k, *values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))


def partitions_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renderings without owed files of two datasets and one market, asked for in any case."""
    r = base._renderings(spark, sf_dir).withColumn("pending", F.col("files") % 3)
    return catalog.filter_partitions(r, downloaded=True, datasets=["2-high", "5-Low"], market="SPOT", grain="Daily").select("partition", "files")


def months_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.closed_months(views.partitions(spark, sf_dir), "1998-03-15 10:00:00").select(*BY, "files")


def _parts_of_series(spark, sf_dir):
    """Suppliers as series, with their slice and pattern as tables of their own."""
    s = views.series(spark, sf_dir)
    shape = ["market", "dataset", "variant", "grain"]
    slices = s.select(F.concat_ws("|", *shape).alias("slice"), *shape).distinct()
    pattern = slices.select(F.concat(F.lit("P|"), "slice").alias("pattern"), "slice", F.concat(F.col("dataset"), F.lit("/{SYMBOL}-{YYYY}")).alias("url"))
    instrument = s.filter("symbol <> '@'").select(F.col("series").alias("instrument"), "symbol")
    return s.select("series", F.concat(F.lit("P|"), F.concat_ws("|", *shape)).alias("pattern"), F.col("series").alias("instrument"), "host"), pattern, slices, instrument


def series_viewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.series_view(*_parts_of_series(spark, sf_dir)).select("series", "symbol", "market", "dataset", "variant", "grain", "url")


def series_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = base._bounded(spark, sf_dir)
    some = catalog.filter_series(s, live=True, market="PERP", variant="")
    named = catalog.filter_series(s, symbols=["s1", "S2", "s40", "@"])
    return some.select(F.lit("live").alias("ask"), "series", "symbol").unionByName(named.select(F.lit("named").alias("ask"), "series", "symbol"))


def _listed(spark, sf_dir):
    f = views.catalog_files(spark, sf_dir)
    slot = F.concat_ws("|", "venue", "dataset")
    files = f.select("venue", F.concat_ws("|", slot, F.col("series")).alias("series"), "date", "path", "size", "existence", "downloaded_at")
    s = f.select(F.concat_ws("|", slot, F.col("series")).alias("series"), slot.alias("slice"), F.concat_ws("/", "venue", "dataset", F.col("series")).alias("prefix")).distinct().withColumn("pattern", F.lit("p"))
    return s, files


def listing_lens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owed files of the prefixes of one venue, through a lens of the months with over six files."""
    s, files = _listed(spark, sf_dir)
    members = views.partitions(spark, sf_dir).filter("files > 6").select(F.concat_ws("|", "venue", "dataset").alias("slice"), "month")
    return catalog.listing_rows(s, files, members, pending=True, low="N/", high="N0").select("prefix", "date", "path", "size")


def listing_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of one partition's files, forty to a page."""
    s, files = _listed(spark, sf_dir)
    part = ("R|1-URGENT", "199501")
    page = catalog.listing_rows(s, files, partition=part, after=("R/1-URGENT/3", "19950101", ""), limit=40)
    return page.select("prefix", "date", "path")


def slices_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = base._renderings(spark, sf_dir)
    return catalog.touched_slices(r.groupBy("slice").agg(F.sum("files").alias("files")), r.filter("files > 5"))


def lens_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = base._renderings(spark, sf_dir)
    return catalog.within_lens(r, lenses.resolve_lens(r, base._rules(spark))).groupBy("venue", "market").agg(F.count("*").alias("partitions"), F.sum("files").alias("files"))


def lens_members_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lens among the siblings of the newest year's partitions."""
    r = base._renderings(spark, sf_dir)
    return lenses.resolve_new(r, r.filter("month >= '199801'"), base._rules(spark)).select("partition", "files")


def lens_drafted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months that a draft lens without preferences leaves each slice."""
    r = base._renderings(spark, sf_dir).select("slice", "venue", "market", "dataset", "variant", "grain", "bundle").distinct()
    return lenses.lens_slices(r, base._rules(spark))


def contents_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last file of each customer's datasets within the united spans of the customer."""
    f = views.catalog_files(spark, sf_dir).select(F.concat(F.lit("C"), "owner").alias("slice"), F.col("dataset").alias("series"), "date")
    return lenses.through_lens(f.select("slice", "series").distinct(), base.spans_united(spark, sf_dir), f)


def partitions_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the market bundles' partitions, of which some are unknown."""
    r = base._renderings(spark, sf_dir)
    names_asked = r.filter("bundle = 'market'").select(F.concat_ws("|", "venue", "market", "dataset", "variant", "month").alias("name")).distinct()
    names_asked = names_asked.unionByName(names_asked.select(F.concat(F.lit("?"), "name").alias("name")))
    return catalog.partition_named(names_asked, r).select("name", "partition", "files")


def files_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.catalog_files(spark, sf_dir)
    out = catalog.drop_excluded(f, f.filter("number = 1").select("venue", "path"))
    return out.groupBy("venue", "dataset").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def files_misfiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of days, months and hours, of which every third supplier's are in the folder of the month after, less those of a kept list; and those of another tree."""
    f = views.catalog_files(spark, sf_dir)
    shift = F.when(F.col("series") % 3 == 0, 1).otherwise(0)
    month = F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("01")), "yyyyMMdd"), shift), "yyyyMM")
    stamp = F.when(F.col("number") == 1, F.col("month")).when(F.col("number") == 4, F.concat("date", F.lit("07"))).otherwise(F.col("date"))
    tree = F.when(F.col("number") == 5, "futures_btc").otherwise("spot")
    name = F.concat(F.when(F.col("series") % 2 == 0, "X_USD").otherwise("X_USDT"), F.lit("-"), stamp, F.lit(".csv.gz"))
    placed = f.select(F.concat_ws("/", tree, F.replace("path", F.lit("/"), F.lit("_")), month, name).alias("path"))
    kept = f.select(F.when(F.col("series") % 2 == 0, "X_USD").otherwise("X_USDT").alias("symbol"), F.col("date").alias("day")).filter("day LIKE '%1' AND symbol = 'X_USD'").distinct()
    return catalog.misfiled(placed, kept).withColumn("fault", F.lit("month")).unionByName(catalog.wrong_tree(placed).withColumn("fault", F.lit("tree")))


def prefixes_established(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs over scopes of one to three levels, open ones without an end: when each three-level prefix was last established."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    parts = [F.concat(F.lit("a"), k % 3), F.concat(F.lit("b"), k % 5), F.concat(F.lit("c"), k % 7)]
    scope = F.when(k % 4 == 0, parts[0]).when(k % 4 == 1, F.concat_ws("/", *parts[:2])).otherwise(F.concat_ws("/", *parts))
    open_run = (F.col("o_orderstatus") == "P") & (k % 4 >= 1) & (k % 3 == 1) & (k % 5 == 2) & (k % 7 == 3)
    runs = o.select(scope.alias("scope"), F.col("o_orderdate").alias("started_at"), F.when(~open_run, F.col("o_orderdate")).alias("completed_at"))
    prefixes = o.select(F.concat_ws("/", *parts).alias("prefix")).distinct()
    return catalog.established_at(runs, prefixes)


def transforms_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as asks by date of month or day, against dated transforms made of the nations."""
    o, n = table(spark, sf_dir, "orders"), table(spark, sf_dir, "nation")
    date = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyyMM"))
    asks = o.select(F.col("o_orderkey").alias("ask"), F.lit("v").alias("venue"), F.substring("o_orderpriority", 1, 1).alias("dataset"), F.concat(F.lit("k"), F.col("o_custkey") % 5).alias("kind"), date.alias("date"))
    k = F.col("n_nationkey")
    known = n.select(F.lit("v").alias("venue"), F.when(k < 5, "").otherwise((k % 5 + 1).cast("string")).alias("dataset"), F.concat(F.lit("k"), F.when(k < 5, k).otherwise(F.expr("n_nationkey div 5"))).alias("kind"),
                     F.when(k >= 5, F.lit("19940110")).alias("from"), F.when(k >= 15, F.lit("19961220")).alias("to"), F.col("n_name").alias("value"))
    return catalog.resolve_transform(asks, known).select("ask", "value")


def expected_of_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods of four grains that suppliers owe, with the keys they should have."""
    return catalog.expected_keys(_publishing(spark, sf_dir), "1998-03-02 00:30:00", _transforms(spark))


def _publishing(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    grain = _pick(k, "monthly", "daily", "hourly", "minutely")
    tip = _pick(k, "199706", "199801", "1998022812", "199803020005")
    return s.select(k.alias("series"), grain.alias("grain"), tip.alias("tip"), _pick(k, "199708", "19980101", "1998022814", "199803020010").alias("first"), F.when(k % 3 == 0, _pick(k, "199712", "19980220", "1998030110", "199803020020")).alias("retired"), (k % 2).cast("int").alias("lag"),
                    F.when(k % 5 == 0, _pick(k, "199709", "19980205", "1998022815", "199803020012")).alias("empty_from"), F.when(k % 5 == 0, _pick(k, "199710", "19980210", "1998022820", "199803020015")).alias("empty_to"),
                    F.lit("v").alias("venue"), F.lit("d").alias("dataset"), F.concat(F.lit("S"), k).alias("symbol"), F.concat(F.lit("x/"), F.when(k % 2 == 0, "{TRANSFORM:dir:{SYMBOL}}").otherwise("{SYMBOL}"), F.lit("/{YYYY}-{MM}-{DD}-{HH}-{MI}")).alias("pattern"))


def _transforms(spark):
    return spark.createDataFrame([("v", "", "dir", "199709", "199802", "all$1"), ("v", "d", "dir", "199801", "199801", "own")], "venue string, dataset string, kind string, `from` string, `to` string, value string")


def patterns_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in URL patterns with transforms, of which some are known, and with a part's token."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    pattern = _pick(k, "a/{SYMBOL}/{YYYY}{MM}{DD}{HH}{MI}", "b/{TRANSFORM:dir:{SYMBOL}}.{PART}", "c/{TRANSFORM:name:plain}/{MM}")
    known = F.when(k % 2 == 0, F.concat(F.lit("K"), k))
    return p.select("p_partkey", names.transform_kind(pattern).alias("kind"), names.fill_pattern(pattern, F.lit("202402030405"), F.concat(F.lit("S"), k), F.when(k % 5 != 0, F.concat(F.lit("p"), k)), known).alias("key"), times.grain_of(pattern).alias("grain"))


def revisions_made(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions of partitions with and without neighbours."""
    p = views.partitions(spark, sf_dir).withColumn("partition", F.concat_ws("/", *BY))
    edges = F.when(F.col("files") % 3 == 0, F.array(F.struct(F.lit("n").alias("id"), F.lit("pre").alias("side"), F.col("month").alias("version")))).otherwise(F.array().cast("array<struct<id:string,side:string,version:string>>"))
    missing = F.when(F.col("files") % 3 == 1, F.array(F.lit("pre"), F.lit("post"))).otherwise(F.array().cast("array<string>"))
    return p.select("partition", names.revision(F.array(F.lit("every=1.0.0"), F.lit("series=1.2.0")), F.lit(fields_json("quotes")), F.col("partition"), F.col("files").cast("string"), edges, missing).alias("revision"))


def prefixes_made(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    symbol = F.when(k % 5 == 0, F.concat(F.lit("btc"), k)).when(k % 5 == 1, F.concat(F.lit("1"), k)).when(k % 5 == 2, "").when(k % 5 == 3, F.concat(F.lit("a/"), k))
    return p.select("p_partkey", names.series_prefix(F.lit("v"), F.lit("spot"), F.lit("klines"), F.when(k % 2 == 0, "1m").otherwise(""), symbol).alias("prefix"))


def series_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as series in several states: whether more of each is to be expected."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    state, retired = F.when(k % 3 == 0, "active").otherwise("quiet"), F.when(k % 6 == 0, "19990101")
    last = F.when(k % 7 != 0, F.date_format(F.date_sub("o_orderdate", (k % 40).cast("int")), "yyyyMMdd"))
    return o.select("o_orderkey", listing.is_open(state, retired, last, F.date_format("o_orderdate", "yyyyMMdd"), F.lit("daily")).alias("is_open"))


def option_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Underlyings, book actions, times in names and digests of parts."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select("p_partkey", names.underlying(F.concat(F.lit("U"), k, F.lit("-240105-C"))).alias("underlying"), names.book_action(_pick(k, "snapshot", "delta", "insert")).alias("action"),
                    times.time_in_name(F.concat(F.lit("a/b.part"), k, _pick(k, ".csv", ".CSV", ".gz"))).alias("stamp"), listing.digest_agrees(F.concat(F.lit('"'), F.md5(F.when(k % 2 == 0, F.col("p_name")).otherwise("x").cast("binary")), F.lit('"')), F.col("p_name").cast("binary")).alias("agrees"))


def archives_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months waited for, with the rendering each was recorded with, against what is here and what is stored elsewhere at the catalog's version."""
    r = base._renderings(spark, sf_dir).withColumn("rendering", F.concat_ws("-", "grain", "bundle")).withColumn("version", F.col("files").cast("string"))
    key = ["venue", "market", "dataset", "variant", "month"]
    wanted = r.groupBy(*key).agg(F.max("rendering").alias("rendering"))
    here = wanted.filter("month % 5 = 0")
    elsewhere = r.filter("bytes % 3 <> 0").withColumn("version", F.when(F.col("bytes") % 7 == 0, "old").otherwise(F.col("version")))
    return reconcile.needed(wanted, here, r, elsewhere, key)


def records_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions as stored in cold storage, recorded and told, all but some of each."""
    p = views.partitions(spark, sf_dir).select(F.concat_ws("/", *BY).alias("partition"), F.lit("r").alias("revision"), F.col("files").alias("count"), (F.col("bytes") % 6).alias("k"))
    held = p.filter("count > 0")
    stored = held.filter("k <> 0").select("partition", "revision", F.explode(F.sequence(F.lit(1), F.col("count") + F.when(F.col("k") == 1, 1).otherwise(0))).alias("n"))
    records, told = held.filter("k <> 2").select("partition", "revision", "count"), held.filter("k <> 3").select("partition", "revision")
    return reconcile.record_findings(stored, records, held.select("partition", "revision", "count"), told)


def coverage_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of customers catalogued and stored, each lacking some of the other's, some of another size."""
    f = views.catalog_files(spark, sf_dir).select("owner", "month", "path", "size", "etag", "number", "series")
    store = f.filter("number < 5").withColumn("size", F.when(F.col("series") % 50 == 7, F.col("size") + 1).otherwise(F.col("size")))
    return reconcile.coverage_findings(f.filter("series % 40 <> 3"), store, ["owner"])


QUERIES = {f.__name__: f for f in (
    partitions_filtered, months_closed, series_viewed, series_filtered, listing_lens, listing_partition, slices_touched, lens_partitions, lens_members_new, lens_drafted, contents_exact, partitions_named, files_excluded, files_misfiled,
    prefixes_established, transforms_resolved, expected_of_grains, patterns_filled, revisions_made, prefixes_made, series_open, option_words, archives_needed, records_checked, coverage_checked)}

_B, _R, _CF = "venue, dataset, month", base._RENDER, views.CATALOG_FILES
_KEY = "venue, market, dataset, variant, month"
_SIBLINGS = f"(SELECT DISTINCT {_KEY} FROM rend WHERE month >= '199801')"
_IX = "(CAST(substr({m}, 1, 4) AS BIGINT) * 12 + CAST(substr({m}, 5, 2) AS BIGINT) - 1)"
_OPEN = base._MONTH
ORACLES = {
    "partitions_filtered": f"WITH {_R} SELECT partition, files FROM rend WHERE files % 3 = 0 AND dataset IN ('2-HIGH', '5-LOW') AND market = 'spot' AND grain = 'daily'",
    "months_closed": f"WITH {views.PARTITIONS} SELECT {_B}, files FROM partitions WHERE month < '199803'",
    "series_viewed": f"WITH {views.SERIES} SELECT series, symbol, market, dataset, variant, grain, dataset || '/{{SYMBOL}}-{{YYYY}}' AS url FROM series",
    "series_filtered": f"WITH {base._BOUNDED} SELECT 'live' AS ask, series, symbol FROM bounded WHERE last IS NOT NULL AND market = 'perp' AND variant = '' UNION ALL SELECT 'named', series, symbol FROM bounded WHERE symbol IN ('S1', 'S2', 'S40', '@')",
    "listing_lens": f"""WITH {views.PARTITIONS} SELECT concat_ws('/', f.venue, f.dataset, series) AS prefix, date, path, size FROM catalog_files f JOIN partitions p ON p.venue = f.venue AND p.dataset = f.dataset AND p.month = f.month
WHERE p.files > 6 AND f.venue = 'N' AND existence = 'confirmed' AND downloaded_at IS NULL""",
    "listing_partition": f"""WITH {_CF}, r AS (SELECT concat_ws('/', venue, dataset, series) AS prefix, date, path FROM catalog_files WHERE venue = 'R' AND dataset = '1-URGENT' AND month = '199501' AND existence = 'confirmed')
SELECT * FROM r WHERE (prefix, date, path) > ('R/1-URGENT/3', '19950101', '') ORDER BY prefix, date, path LIMIT 40""",
    "slices_touched": f"WITH {_R} SELECT slice, sum(files)::BIGINT AS files FROM rend GROUP BY slice HAVING max(files) > 5",
    "lens_partitions": f"WITH {base._LENS} SELECT venue, market, count(*) AS partitions, sum(files)::BIGINT AS files FROM lens GROUP BY ALL",
    "lens_members_new": f"WITH {base._LENS} SELECT partition, files FROM lens JOIN {_SIBLINGS} USING ({_KEY})",
    "lens_drafted": f"""WITH {_R}, s AS (SELECT DISTINCT slice, venue, market, dataset, grain FROM rend),
plus AS (SELECT slice, 1 - 1 + 12 * 0 AS a, 9999 * 12 + 11 AS b FROM s), cut AS (SELECT slice, CASE WHEN venue = 'N' AND grain = 'hourly' THEN 0 ELSE 23945 END AS c FROM s WHERE (venue = 'N' AND grain = 'hourly') OR (market = 'perp' AND dataset = '5-LOW'))
SELECT s.slice, CAST(NULL AS VARCHAR) AS "from", CASE WHEN c IS NOT NULL THEN '199505' END AS "to" FROM s LEFT JOIN cut USING (slice) WHERE c IS NULL OR c > 0""",
    "contents_exact": f"""WITH {base._SPANS}, {base._OPEN_SPANS}, {_CF}, u AS (SELECT slice, {_OPEN.format(x='a')} AS f, {_OPEN.format(x='b')} AS t FROM {base._ISLANDS.format(spans='open_spans')}), d AS (SELECT 'C' || owner AS slice, dataset AS series, date FROM catalog_files)
SELECT slice, series, min(date) AS first, max(date) AS last FROM d JOIN u USING (slice) WHERE substr(date, 1, 6) BETWEEN f AND t GROUP BY slice, series, f, t""",
    "partitions_named": f"WITH {_R}, n AS (SELECT DISTINCT {_KEY} FROM rend WHERE bundle = 'market') SELECT concat_ws('|', {_KEY}) AS name, partition, files FROM rend JOIN n USING ({_KEY})",
    "files_excluded": f"WITH {_CF} SELECT venue, dataset, count(*) AS files, sum(size)::BIGINT AS bytes FROM catalog_files WHERE number <> 1 GROUP BY ALL",
    "files_misfiled": f"""WITH {_CF}, p AS (SELECT series, number, date, CASE WHEN number = 5 THEN 'futures_btc' ELSE 'spot' END || '/' || replace(path, '/', '_') || '/' || strftime(strptime(month || '01', '%Y%m%d') + CASE WHEN series % 3 = 0 THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END, '%Y%m')
 || '/' || CASE WHEN series % 2 = 0 THEN 'X_USD' ELSE 'X_USDT' END || '-' || CASE number WHEN 1 THEN month WHEN 4 THEN date || '07' ELSE date END || '.csv.gz' AS path FROM catalog_files)
SELECT path, 'month' AS fault FROM p WHERE series % 3 = 0 AND number <> 4 AND NOT (number <> 1 AND series % 2 = 0 AND date LIKE '%1') UNION ALL SELECT path, 'tree' FROM p WHERE number = 5 AND series % 2 = 1""",
    "prefixes_established": """WITH o AS (SELECT *, o_orderkey % 4 AS g, 'a' || o_orderkey % 3 AS a, 'b' || o_orderkey % 5 AS b, 'c' || o_orderkey % 7 AS c, o_orderstatus = 'P' AND o_orderkey % 4 >= 1 AND o_orderkey % 3 = 1 AND o_orderkey % 5 = 2 AND o_orderkey % 7 = 3 AS live FROM orders),
r AS (SELECT CASE g WHEN 0 THEN a WHEN 1 THEN a || '/' || b ELSE a || '/' || b || '/' || c END AS scope, live, o_orderdate FROM o),
p AS (SELECT DISTINCT a || '/' || b || '/' || c AS prefix FROM o), q AS (SELECT prefix, r.scope, o_orderdate FROM p JOIN r ON NOT live AND (prefix = r.scope OR starts_with(prefix, r.scope || '/')))
SELECT prefix, max(o_orderdate) AS established FROM q WHERE NOT EXISTS (SELECT 1 FROM r WHERE live AND (r.scope = q.scope OR starts_with(r.scope, q.scope || '/'))) GROUP BY prefix""",
    "transforms_resolved": """WITH a AS (SELECT o_orderkey AS ask, substr(o_orderpriority, 1, 1) AS dataset, 'k' || o_custkey % 5 AS kind, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y%m%d') ELSE strftime(o_orderdate, '%Y%m') END AS date FROM orders),
t AS (SELECT CASE WHEN n_nationkey < 5 THEN '' ELSE CAST(n_nationkey % 5 + 1 AS VARCHAR) END AS dataset, 'k' || CASE WHEN n_nationkey < 5 THEN n_nationkey ELSE n_nationkey // 5 END AS kind, CASE WHEN n_nationkey >= 5 THEN '19940110' END AS f, CASE WHEN n_nationkey >= 15 THEN '19961220' END AS t, n_name AS value FROM nation)
SELECT ask, (SELECT arg_max(value, (t.dataset <> '', value)) FROM t WHERE t.kind = a.kind AND (t.dataset = '' OR t.dataset = a.dataset) AND (f IS NULL OR date >= substr(f, 1, length(date))) AND (t.t IS NULL OR date <= substr(t.t, 1, length(date)))) AS value FROM a""",
    "expected_of_grains": """WITH s AS (SELECT s_suppkey AS k, s_suppkey % 4 AS g, s_suppkey % 2 AS lag FROM supplier),
b AS (SELECT *, CASE g WHEN 0 THEN INTERVAL 1 MONTH WHEN 1 THEN INTERVAL 1 DAY WHEN 2 THEN INTERVAL 1 HOUR ELSE INTERVAL 1 MINUTE END AS i, CASE g WHEN 0 THEN TIMESTAMP '1997-08-01' WHEN 1 THEN TIMESTAMP '1998-01-02' WHEN 2 THEN TIMESTAMP '1998-02-28 14:00' ELSE TIMESTAMP '1998-03-02 00:10' END AS lo,
 CASE g WHEN 0 THEN TIMESTAMP '1998-02-01' WHEN 1 THEN TIMESTAMP '1998-03-01' WHEN 2 THEN TIMESTAMP '1998-03-01 23:00' ELSE TIMESTAMP '1998-03-02 00:29' END AS hi, CASE WHEN k % 3 = 0 THEN CASE g WHEN 0 THEN TIMESTAMP '1997-12-01' WHEN 1 THEN TIMESTAMP '1998-02-20' WHEN 2 THEN TIMESTAMP '1998-03-01 10:00' ELSE TIMESTAMP '1998-03-02 00:20' END END AS ret FROM s),
d AS (SELECT k, g, unnest(generate_series(lo, least(hi - i * lag, coalesce(ret, TIMESTAMP '9999-01-01')), i)) AS t FROM b),
e AS (SELECT k, g, substr(strftime(t, '%Y%m%d%H%M'), 1, CASE g WHEN 0 THEN 6 WHEN 1 THEN 8 WHEN 2 THEN 10 ELSE 12 END) AS date, t FROM d),
f AS (SELECT * FROM e WHERE NOT (k % 5 = 0 AND date BETWEEN CASE g WHEN 0 THEN '199709' WHEN 1 THEN '19980205' WHEN 2 THEN '1998022815' ELSE '199803020012' END AND CASE g WHEN 0 THEN '199710' WHEN 1 THEN '19980210' WHEN 2 THEN '1998022820' ELSE '199803020015' END))
SELECT k AS series, date, 'x/' || CASE WHEN k % 2 = 1 THEN 'S' || k WHEN substr(date, 1, 6) = '199801' THEN 'own' WHEN substr(date, 1, 6) BETWEEN '199709' AND '199802' THEN 'all$1' ELSE 'S' || k END || '/' || substr(date, 1, 4) || '-' || substr(date, 5, 2) || '-' || substr(date, 7, 2) || '-' || substr(date, 9, 2) || '-' || substr(date, 11, 2) AS key FROM f""",
    "patterns_filled": """SELECT p_partkey, CASE p_partkey % 3 WHEN 1 THEN 'dir' WHEN 2 THEN 'name' END AS kind, CASE p_partkey % 3 WHEN 0 THEN 'a/S' || p_partkey || '/202402030405' WHEN 1 THEN 'b/' || CASE WHEN p_partkey % 2 = 0 THEN 'K' ELSE 'S' END || p_partkey || '.' || CASE WHEN p_partkey % 5 <> 0 THEN 'p' || p_partkey ELSE '' END
 ELSE 'c/' || CASE WHEN p_partkey % 2 = 0 THEN 'K' || p_partkey ELSE 'plain' END || '/02' END AS key, CASE p_partkey % 3 WHEN 0 THEN 'minutely' ELSE 'monthly' END AS grain FROM part""",
    "revisions_made": f"""WITH {views.PARTITIONS}, p AS (SELECT concat_ws('/', {_B}) AS partition, files, month FROM partitions)
SELECT partition, substr(sha256(replace('every=1.0.0~series=1.2.0~[{{"name":"ts","type":"BIGINT"}},{{"name":"bidPrice","type":"DOUBLE"}},{{"name":"bidSize","type":"DOUBLE"}},{{"name":"askPrice","type":"DOUBLE"}},{{"name":"askSize","type":"DOUBLE"}},{{"name":"margin","type":"VARCHAR"}}]'
 || partition || '~' || files || '~' || CASE files % 3 WHEN 0 THEN 'apart~n~pre~' || month || '~' WHEN 1 THEN 'apart~post~missing~pre~missing~' ELSE '' END, '~', chr(10))), 1, 12) AS revision FROM p""",
    "prefixes_made": """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'v/spot/klines' || CASE WHEN p_partkey % 2 = 0 THEN ',1m' ELSE '' END || '/B/btc' || p_partkey || '/' WHEN 1 THEN 'v/spot/klines' || CASE WHEN p_partkey % 2 = 0 THEN ',1m' ELSE '' END || '/_/1' || p_partkey || '/'
 WHEN 4 THEN 'v/spot/klines' || CASE WHEN p_partkey % 2 = 0 THEN ',1m' ELSE '' END || '/@/' END AS prefix FROM part""",
    "series_open": "SELECT o_orderkey, (o_orderkey % 3 = 0 AND o_orderkey % 6 <> 0) OR o_orderkey % 7 = 0 OR o_orderkey % 40 <= 15 AS is_open FROM orders",
    "option_words": "SELECT p_partkey, 'U' || p_partkey AS underlying, CASE WHEN p_partkey % 3 = 0 THEN 'snapshot' ELSE 'set' END AS action, CASE WHEN p_partkey % 3 = 1 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS stamp, p_partkey % 2 = 0 OR p_name = 'x' AS agrees FROM part",
    "archives_needed": f"""WITH {_R}, h AS (SELECT *, grain || '-' || bundle AS rendering FROM rend), w AS (SELECT {_KEY}, max(rendering) AS own FROM h GROUP BY {_KEY} HAVING CAST(month AS BIGINT) % 5 <> 0)
SELECT {_KEY}, arg_min(h.rendering, (h.rendering <> own, h.rendering)) FILTER (bytes % 3 <> 0 AND bytes % 7 <> 0) AS rendering FROM w JOIN h USING ({_KEY}) GROUP BY {_KEY}""",
    "records_checked": f"""WITH {views.PARTITIONS}, p AS (SELECT concat_ws('/', {_B}) AS partition, bytes % 6 AS k FROM partitions WHERE files > 0)
SELECT partition, 'r' AS revision, CASE k WHEN 0 THEN 'not stored' WHEN 1 THEN 'another number of files' WHEN 2 THEN 'unrecorded' ELSE 'untold' END AS finding FROM p WHERE k < 4""",
    "coverage_checked": f"""WITH {_CF}, f AS (SELECT owner, month, {_IX.format(m='month')} AS m, path, number, series FROM catalog_files), st AS (SELECT * FROM f WHERE number < 5), ct AS (SELECT * FROM f WHERE series % 40 <> 3),
w AS (SELECT owner, unnest(range(min(m), max(m) + 1)) AS m FROM st GROUP BY owner), gap AS (SELECT * FROM w EXCEPT SELECT owner, m FROM st),
n AS (SELECT owner, max(m) AS m FROM ct GROUP BY owner), lag AS (SELECT * FROM (SELECT owner, m FROM ct EXCEPT SELECT owner, m FROM st) EXCEPT SELECT owner, m FROM n)
SELECT 'gap' AS finding, owner, {_OPEN.format(x='m')} AS month, 0 AS files FROM gap UNION ALL SELECT 'lag', owner, {_OPEN.format(x='m')}, 0 FROM lag
UNION ALL SELECT 'orphans', owner, month, count(*) FROM st WHERE series % 40 = 3 GROUP BY owner, month UNION ALL SELECT 'sizes', owner, month, count(*) FROM st WHERE series % 50 = 7 AND series % 40 <> 3 GROUP BY owner, month""",
}
