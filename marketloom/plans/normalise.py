"""Raw files of a venue to canonical rows: choose a series for each file, read, project, clip, check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.names import margin_of, parse_keys, path_levels
from marketloom.functions.times import month_of, month_start_us, shifted_month, with_us
from marketloom.plans.series import SERIES, Series
from marketloom.schema import TABLES
from marketloom.sources import scans

#: Times outside these are taken for a wrong unit or column.
EARLIEST, LATEST = "2015-01", "2035-01"


def rules_frame(spark: SparkSession, rules: list[Series] = SERIES) -> DataFrame:
    """The conditions of each series, by its number; a constant of a few dozen rows."""
    rows = [(i, s.venue, s.market, s.dataset, s.variant, s.margin, s.since, s.until, s.table) for i, s in enumerate(rules)]
    return spark.createDataFrame(rows, "series int, venue string, market string, dataset string, rule_variant string, rule_margin string, since string, until string, table string")


def assign_series(files: DataFrame, rules: list[Series] = SERIES) -> DataFrame:
    """files (venue, market, dataset, variant, symbol, month) with series and table; null where no series
    reads a file. A variant `*` is any but none. Two series for one file are an error."""
    keyed = files.withColumn("_margin", margin_of(F.col("venue"), F.col("market"), F.col("symbol"))).withColumn("_file", F.monotonically_increasing_id())
    r = F.broadcast(rules_frame(files.sparkSession, rules)).alias("r")
    f = keyed.alias("f")
    fits = (
        (F.col("f.venue") == F.col("r.venue")) & (F.col("f.market") == F.col("r.market")) & (F.col("f.dataset") == F.col("r.dataset"))
        & F.when(F.col("r.rule_variant") == "*", F.col("f.variant") != "").otherwise(F.col("f.variant") == F.col("r.rule_variant"))
        & (F.col("r.rule_margin").isNull() | F.col("r.rule_margin").eqNullSafe(F.col("f._margin")))
        & (F.col("r.since").isNull() | (F.col("f.month") >= F.col("r.since"))) & (F.col("r.until").isNull() | (F.col("f.month") < F.col("r.until"))))
    joined = f.join(r, fits, "left").select(*[f"f.{c}" for c in files.columns], "f._file", "r.series", "r.table")
    found = joined.groupBy("_file", *files.columns).agg(F.min("series").alias("series"), F.max("series").alias("_high"), F.min("table").alias("table"))
    clear = F.when(F.col("series").eqNullSafe(F.col("_high")), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("two series claim a file of "), F.col("venue"), F.lit(" "), F.col("dataset"))))
    return found.filter(clear).drop("_file", "_high")


def scan(spark: SparkSession, series: Series, paths: list[str], archived: bool = False, contents: DataFrame | None = None, width=scans.assert_width) -> DataFrame:
    """Raw rows of a series' files, as strings (or declared fields), with their file's name. archived: the files are zip or
    tar archives, whose members are read line by line; tables that may be workbooks are told by their first bytes.
    contents (path, content): the files themselves, where they are at hand. width takes the rows of a text table with what lies past their columns."""
    if series.format == "sheet" and contents is None and not archived:
        return scans.scan_sheet_files(spark, paths, _wanted(series))
    if contents is not None or archived or series.format == "sheet":
        whole = scans.drop_empty(contents if contents is not None else scans.binary_files(spark, paths))
        if series.format == "sheet":
            return scans.scan_sheets(whole, _wanted(series))
        if series.header and series.format == "csv":
            return width(scans.scan_archive_named(whole, _wanted(series)))
        return scan_lines_of(series, scans.scan_archive(whole), width)
    if series.format == "ndjson":
        return scans.scan_ndjson(spark, paths, series.fields)
    if series.format == "lines":
        return scans.scan_lines(spark, paths)
    if series.format == "words":
        return scans.scan_words(spark, paths, list(series.columns))
    if series.header:
        return width(scans.scan_csv_named(spark, paths, _wanted(series)))
    return width(scans.scan_csv_positional(spark, paths, list(series.columns)))


def scan_lines_of(series: Series, lines: DataFrame, width=scans.assert_width) -> DataFrame:
    """Raw rows of a series without a header from the lines of archives' members (archive, member, number, line)."""
    if series.format == "ndjson":
        return lines.select(F.from_json("line", series.fields).alias("_r"), F.col("archive").alias(scans.FILE)).select("_r.*", scans.FILE)
    if series.format == "lines":
        return lines.select("line", F.col("archive").alias(scans.FILE))
    if series.format == "words":
        return scans.words_of(lines.withColumnRenamed("archive", scans.FILE), list(series.columns))
    return width(scans.cells_of_lines(lines, list(series.columns)))


def _wanted(series: Series) -> list[str]:
    """The raw columns that a headed series names in its expressions."""
    import re

    text = " ".join([series.ts, series.instrument or "", *series.project.values()])
    quoted = re.findall(r"`([^`]+)`", text)
    bare = [] if quoted and text.startswith("`") else [w for w in (series.ts, series.instrument) if w and re.fullmatch(r"\w+", w)]
    inner = re.findall(r"(?:lower|try_cast)\((\w+)", text)
    plain = [v for v in series.project.values() if re.fullmatch(r"\w+", v)]
    return list(dict.fromkeys([*quoted, *bare, *inner, *plain]))


def project(series: Series, rows: DataFrame, keep: list[Column] = (), watch: Observation | None = None) -> DataFrame:
    """The table's columns in order, each tried as its type: null where a cell is none or the venue has no
    such number; rows without a time are no rows. watch gets how many have one and none, and the bounds of the times."""
    if series.rows:
        rows = series.rows(rows)
    timed = with_us(rows, F.expr(series.ts), "_us", series.utc_offset_hours)
    columns = []
    for name, kind in TABLES[series.table]:
        if name == "ts":
            columns.append(F.col("_us").alias("ts"))
        elif name != "margin":
            made = F.expr(series.project[name]).try_cast(kind) if name in series.project else F.lit(None).cast(kind)
            columns.append(made.alias(name))
    made = timed.select(*columns, *keep)
    if watch is not None:
        ts, early, late = F.col("ts"), month_start_us(F.lit(EARLIEST)), month_start_us(F.lit(LATEST))
        made = made.observe(watch, F.count("ts").alias("rows"), F.count_if(ts.isNull()).alias("untimed"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.count_if((ts < early) | (ts >= late)).alias("implausible"))
    return made.filter("ts IS NOT NULL")


def clip_month(rows: DataFrame, month: str | Column) -> DataFrame:
    """Rows of the half-open month, in µs."""
    start = F.lit(month) if isinstance(month, str) else month
    return rows.filter((F.col("ts") >= month_start_us(start)) & (F.col("ts") < month_start_us(shifted_month(start, 1))))


def assert_plausible(rows: DataFrame) -> DataFrame:
    """rows, failing on a time before 2015 or after 2034, with the instrument's name."""
    bad = (F.col("ts") < month_start_us(F.lit(EARLIEST))) | (F.col("ts") >= month_start_us(F.lit(LATEST)))
    return rows.filter(F.when(bad, F.raise_error(F.concat(F.lit("implausible time of "), F.col("symbol"), F.lit(": "), F.col("ts").cast("string")))).otherwise(F.lit(True)))


def implausible(rows: DataFrame) -> DataFrame:
    """symbol, first, last of the instruments whose times leave the bounds."""
    return (rows.groupBy("symbol").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
            .filter((F.col("first") < month_start_us(F.lit(EARLIEST))) | (F.col("last") >= month_start_us(F.lit(LATEST)))))


def tag_owner(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """rows with symbol: its own, or that of the instrument its file belongs to. owners: filename, owner, one row a file."""
    joined = rows.join(owners, scans.FILE, "left")
    return joined.withColumn("symbol", F.coalesce(F.col("_own"), F.col("owner"))).drop("_own", "owner")


def with_margin(rows: DataFrame, venue: str, market: str) -> DataFrame:
    return rows.withColumn("margin", margin_of(F.lit(venue), F.lit(market), F.col("symbol")))


class Watch:
    """What a write sees of each series as its rows go by, in the one pass that writes them: rows, untimed (rows without a time, which are left out), first and
    last time, implausible (times out of bounds) and wide (rows with more cells than declared). Read it when the write is over."""

    def __init__(self):
        self.series: list[tuple[Series, str, Observation, Observation]] = []

    def added(self, series: Series, variant: str) -> tuple[Observation, Observation]:
        self.series.append((series, variant, Observation(), Observation()))
        return self.series[-1][2:]

    def facts(self) -> list[dict]:
        """A row a series. Waits for a write that has not ended."""
        return [{"venue": s.venue, "market": s.market, "dataset": s.dataset, "variant": variant, "table": s.table, **rows.get, "wide": width.get["wide"]} for s, variant, rows, width in self.series]

    def sound(self) -> bool:
        """Whether what was written may be recorded as stocked."""
        return all(not f["implausible"] and not f["wide"] for f in self.facts())


def normalise(spark: SparkSession, files: DataFrame, venue: str, dataset: str, rules: list[Series] = SERIES, watch: Watch | None = None) -> dict[str, DataFrame]:
    """Canonical rows of a venue's files by table, with symbol and path levels.

    files: path (readable) and key (the canonical name) of each file, with their content if it is at hand; one job a
    series, over all its files at once. Spilling series are clipped to the month that the file's name says.
    A row that is wider than declared, and a time out of bounds, is an error; with a watch they are counted instead, and
    it is for the caller not to record what is not sound.
    """
    contents = files.select("path", "content") if "content" in files.columns else None
    listed = parse_keys(files.select("path", "key")).filter((F.col("venue") == venue) & (F.col("dataset") == dataset))
    assigned = assign_series(listed, rules).filter("series IS NOT NULL")
    groups: dict[tuple, list[tuple]] = {}
    archived = F.col("container").isin("zip", "tar.gz")
    for row in assigned.select("series", "path", "variant", archived.alias("archived"), "symbol", "month").toLocalIterator():  # a path for each file of the months asked for, as readers take them
        groups.setdefault((row["series"], row["variant"], row["archived"]), []).append((row["path"], row["symbol"], row["month"]))
    plain = lambda path: F.regexp_replace(path, r"^(file:)?/*", "/")
    tables: dict[str, list[DataFrame]] = {}
    for (number, variant, packed), listed_files in sorted(groups.items()):
        series, paths = rules[number], [path for path, _, _ in listed_files]
        held = F.broadcast(spark.createDataFrame(listed_files, "path string, owner string, own_month string"))  # the paths just listed, so that no rows are dealt by their file
        owners = held.select(plain(F.col("path")).alias(scans.FILE), "owner", "own_month")
        own_contents = None if contents is None else contents.join(held.select("path"), "path", "left_semi")
        seen, width = watch.added(series, variant) if watch is not None else (None, None)

        def counted(rows: DataFrame, width=width) -> DataFrame:
            return rows.observe(width, F.count(scans.OVERFLOW).alias("wide")).drop(scans.OVERFLOW)

        raw = scan(spark, series, paths, packed, own_contents, scans.assert_width if watch is None else counted)
        if watch is not None and series.format in ("ndjson", "lines", "words", "sheet"):
            raw = raw.observe(width, F.count_if(F.lit(False)).alias("wide"))  # no width is declared
        own = (F.expr(series.instrument) if series.instrument else F.lit(None).cast("string")).alias("_own")
        made = project(series, raw, [own, F.col(scans.FILE)], seen)
        made = tag_owner(made.withColumn(scans.FILE, plain(F.col(scans.FILE))), owners)
        if series.spill:
            made = clip_month(made, F.col("own_month"))
        made = made if watch is not None else assert_plausible(made)
        columns = [n for n, _ in TABLES[series.table] if n != "margin"]
        out = made.select("symbol", *columns)
        if series.repeats:
            out = out.distinct()
        if any(n == "margin" for n, _ in TABLES[series.table]):
            out = with_margin(out, series.venue, series.market)
        levels = path_levels(F.lit(series.table), F.lit(variant))
        named = {("band" if n == "depth" and n in columns else n): levels[n] for n in ("interval", "kind", "depth", "aggregated")}
        out = out.withColumns({"venue": F.lit(series.venue), "market": F.lit(series.market), "month": month_of(F.col("ts")), **named})
        tables.setdefault(series.table, []).append(out)
    return {name: reduce(DataFrame.unionByName, parts) for name, parts in tables.items()}
