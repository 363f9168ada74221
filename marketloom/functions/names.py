"""Names and their parts: archive keys, variants, intervals, margins, sides, tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The inverse contracts of each venue, by symbol.
_EXPIRY = r"[FGHJKMNQUVXZ]\d{2}"
INVERSE = {
    "binance": r"USD_",
    "bybit": rf"USD({_EXPIRY})?$",
    "gate": r"_USD(_\d{8})?$",
    "kucoin": r"USDM$",
    "okx": r"^[^-]+-USD(-|$)",
    "htx": r"^[^-]+-USD(-|$)",
    "bitget": rf"(USD(_CM)?|CM{_EXPIRY}|USD{_EXPIRY})$",
}

# Fixed value: the grammar of the end of an archive key: date, part, inner and outer ending.
_TAIL = r"^(\d{6}|\d{8}|\d{10}|\d{12})(?:\.part(\d+))?\.(?:([0-9a-z]*[a-z][0-9a-z]*)\.(?=(?:gz|bz2|xz|zst)$))?(?!(?:bak|part\d*)$)([0-9a-z]*[a-z][0-9a-z]*)$"


def margin_of(venue: Column, market: Column, symbol: Column) -> Column:
    """linear or inverse for perpetuals and futures, null for the rest."""
    inverse = F.lit(False)
    for name, pattern in INVERSE.items():
        inverse = F.when(venue == name, symbol.rlike(pattern)).otherwise(inverse)
    return F.when(market.isin("perp", "future"), F.when(inverse, "inverse").otherwise("linear"))


def parse_keys(df: DataFrame, key: str = "key") -> DataFrame:
    """df with the parts of an archive key venue|market|dataset[,variant]|symbol|date[.part].ext.

    Adds venue, market, dataset, variant, bundle, symbol, month, date, grain, part, container; all null
    where the key is none.
    """
    name = F.element_at(F.split(F.col(key), "/"), -1)
    df = df.withColumn("_p", F.split(name, r"\|"))
    tail = F.when(F.size("_p") == 5, F.col("_p")[4])
    df = df.withColumn("_date", F.regexp_extract(tail, _TAIL, 1)).withColumn("_inner", F.regexp_extract(tail, _TAIL, 3)).withColumn("_ext", F.regexp_extract(tail, _TAIL, 4))
    container = (F.when(F.col("_ext") == "zip", "zip").when(F.col("_ext") == "gz", F.when(F.col("_inner") == "tar", "tar.gz").otherwise("gzip"))
                 .when(~F.col("_ext").isin("bz2", "xz", "zst"), "plain"))
    ok = (F.col("_date") != "") & container.isNotNull()
    parts = {
        "venue": F.col("_p")[0], "market": F.col("_p")[1], "dataset": F.split_part(F.col("_p")[2], F.lit(","), F.lit(1)),
        "variant": F.regexp_extract(F.col("_p")[2], r"^[^,]*,(.*)$", 1), "bundle": F.when(F.col("_p")[3] == "@", "market").otherwise("instrument"),
        "symbol": F.col("_p")[3], "month": F.concat(F.substring("_date", 1, 4), F.lit("-"), F.substring("_date", 5, 2)), "date": F.col("_date"),
        "grain": F.element_at(F.create_map(F.lit(6), F.lit("monthly"), F.lit(8), F.lit("daily"), F.lit(10), F.lit("hourly"), F.lit(12), F.lit("minutely")), F.length("_date")),
        "part": F.nullif(F.regexp_extract(tail, _TAIL, 2), F.lit("")), "container": container,
    }
    return df.select(*[c for c in df.columns if c not in parts and c[0] != "_"], *[F.when(ok, v).alias(k) for k, v in parts.items()])


def edge_of(date: Column, grain: Column) -> tuple[Column, Column]:
    """Whether a file is in the first and the last period of its month."""
    day = F.try_to_date(F.substring(date, 1, 8), "yyyyMMdd")
    return (grain == "monthly") | (F.substring(date, 7, 2) == "01"), (grain == "monthly") | F.coalesce(day == F.last_day(day), F.lit(False))


# How months and the suffixes of other intervals are written, with their seconds.
_MONTHLY = r"^(\d*)\s*(?:mo|mon|month|months)$"
_SECONDS = {
    "s": 1, "sec": 1, "secs": 1, "second": 1, "seconds": 1,
    "": 60, "m": 60, "min": 60, "mins": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hr": 3600, "hrs": 3600, "hour": 3600, "hours": 3600,
    "d": 86_400, "day": 86_400, "days": 86_400,
    "w": 604_800, "wk": 604_800, "week": 604_800, "weeks": 604_800,
}


def canonical_interval(token: Column) -> Column:
    """60min as 1h, 7d as 1w, 90m as it is, months apart, a bare number as minutes; null if it is none."""
    raw = F.lower(F.trim(token))
    months = F.when(F.regexp_extract(raw, _MONTHLY, 1) == "", 1).otherwise(F.regexp_extract(raw, _MONTHLY, 1).try_cast("bigint"))
    count, suffix = F.regexp_extract(raw, r"^(\d+)\s*([a-z]*)$", 1).try_cast("bigint"), F.regexp_extract(raw, r"^(\d+)\s*([a-z]*)$", 2)
    unit = F.create_map(*[F.lit(x) for pair in _SECONDS.items() for x in pair])
    s = count * unit[suffix]
    text = lambda size, name: F.concat((s / size).cast("bigint"), F.lit(name))
    out = F.when(s < 60, text(1, "s"))
    for name, size, most in (("m", 60, 3600), ("h", 3600, 86_400), ("d", 86_400, 604_800)):
        out = out.when((s < most) & (s % size == 0), text(size, name))
    out = out.when(s % 604_800 == 0, text(604_800, "w"))
    for name, size in (("d", 86_400), ("h", 3600), ("m", 60)):
        out = out.when(s % size == 0, text(size, name))
    out = out.otherwise(text(1, "s"))
    return F.when(raw.rlike(_MONTHLY), F.when(months > 0, F.concat(months, F.lit("mo")))).when(s > 0, out)


def norm_etag(etag: Column) -> Column:
    """An entity tag without one quote at either end (written out first, then plain) and a compression suffix, in lower
    case. What else is in it stays: a weak mark, a quote inside."""
    bare = F.regexp_replace(F.regexp_replace(etag, r"\A&quot;|&quot;\z", ""), r'\A"|"\z', "")
    return F.lower(F.regexp_replace(bare, r"-gzip\z", ""))


def is_digest(etag: Column) -> Column:
    """Whether a tag is the MD5 of the whole object."""
    return norm_etag(etag).rlike("^[0-9a-f]{32}$")


def unsentinel(value: Column, sentinel: float = -999999.0) -> Column:
    return F.nullif(value.try_cast("double"), F.lit(sentinel))


def first_number(*values: Column) -> Column:
    return F.coalesce(*[v.try_cast("double") for v in values])


def book_action(action: Column, image: str = "snapshot") -> Column:
    return F.when(action == image, "snapshot").otherwise("set")


def underlying(option: Column) -> Column:
    return F.regexp_extract(option, "^([^-]+)-", 1)


def side_of_flag(buyer_maker: Column) -> Column:
    """The taker's side when the buyer was the maker or not."""
    return F.when(F.lower(buyer_maker.cast("string")).isin("true", "1"), "sell").otherwise("buy")


def side_of_code(code: Column, one: str = "buy", two: str = "sell") -> Column:
    return F.when(F.trim(code) == "1", one).when(F.trim(code) == "2", two)


def side_of_sign(size: Column) -> Column:
    return F.when(size.try_cast("double") < 0, "sell").otherwise("buy")


def path_levels(table: Column, variant: Column) -> Column:
    """interval, kind, depth and aggregated of a variant, by table, as a map of strings."""
    parts = F.split(variant, ",")
    kind, depth = F.nullif(parts[0], F.lit("")), F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 2, F.size(parts)), ","))
    interval = F.when((variant != "") & (variant != "ticks"), variant)
    aggregated = F.when(variant == "", "false").when(variant == "aggregated", "true").otherwise(variant)
    none = F.lit(None).cast("string")
    books, bars = table.isin("orderBook", "orderBookSnapshot", "orderBookBands"), table.isin("klines", "markPrice", "indexPrice", "premiumIndex", "optionMarkPrice", "optionTicker")
    return F.map_filter(F.create_map(
        F.lit("interval"), F.when(bars, interval).otherwise(none), F.lit("kind"), F.when(table == "funding", F.nullif(variant, F.lit(""))).when(books, kind).otherwise(none),
        F.lit("depth"), F.when(books, depth).otherwise(none), F.lit("aggregated"), F.when(table == "trades", aggregated).otherwise(none)), lambda k, v: v.isNotNull())


def series_prefix(venue: Column, market: Column, dataset: Column, variant: Column, symbol: Column) -> Column:
    """venue/market/dataset[,variant]/letter/symbol/: the letter is the symbol's first, _ if that is none; @ alone stands for
    a null symbol, and an empty one or one with a slash has no prefix."""
    first = F.upper(F.substring(symbol, 1, 1))
    letter = F.when(first.rlike("[A-Z]"), first).otherwise("_")
    folder = F.when(symbol.isNull(), "@/").when((symbol != "") & ~symbol.contains("/"), F.concat(letter, F.lit("/"), symbol, F.lit("/")))
    return F.concat(venue, F.lit("/"), market, F.lit("/"), F.concat_ws(",", dataset, F.nullif(variant, F.lit(""))), F.lit("/"), folder)


#: {TRANSFORM:kind:default}, whose default may hold one slot.
_TRANSFORM = r"\{TRANSFORM:([^:}]+):((?:[^{}]|\{[^{}]*\})*)\}"


def transform_kind(pattern: Column) -> Column:
    """The kind of a pattern's transform, null if it has none."""
    return F.nullif(F.regexp_extract(pattern, _TRANSFORM, 1), F.lit(""))


def fill_pattern(pattern: Column, stamp: Column, symbol: Column, part: Column, transformed: Column | None = None) -> Column:
    """A URL pattern with its slots filled for one period. `transformed` is what its transforms stand for, their default where
    it is null; they are resolved before the slots."""
    out = F.regexp_replace(pattern, _TRANSFORM, "$2")
    if transformed is not None:
        out = F.coalesce(F.replace(pattern, F.regexp_extract(pattern, _TRANSFORM, 0), transformed), out)
    for slot, value in (("{SYMBOL}", symbol), ("{PART}", F.coalesce(part, F.lit(""))), ("{YYYY}", F.substring(stamp, 1, 4)), ("{MM}", F.substring(stamp, 5, 2)),
                        ("{DD}", F.substring(stamp, 7, 2)), ("{HH}", F.substring(stamp, 9, 2)), ("{MI}", F.substring(stamp, 11, 2))):
        out = F.replace(out, F.lit(slot), value)
    return out


def base_table(name: Column) -> Column:
    return F.split_part(name, F.lit("."), F.lit(1))


def in_pool(name: Column, pool: Column) -> Column:
    """Whether a row of a pool belongs to a table: one with a dotted name has the rows of the pool after its dot only."""
    wanted = F.nullif(F.regexp_extract(name, r"\.(.*)$", 1), F.lit(""))
    return wanted.isNull() | F.coalesce(F.lower(pool) == F.lower(wanted), F.lit(False))


def revision(versions: Column, fields: Column, partition: Column, version: Column, edges: Column, missing: Column) -> Column:
    """Twelve hex digits over all that a stored partition depends on: the versions of its series, the table's fields (as JSON, see
    schema.fields_json), its own version, its neighbours (edges: structs of id, side, version) and the sides it is without.

    Each part ends in a line break, but for the fields, behind which the partition follows at once: a recorded revision is compared byte for byte.
    """
    line = lambda *parts: F.concat(*[x for p in parts for x in (p, F.lit("\n"))])
    apart = F.when(F.size(edges) + F.size(missing) > 0, "apart\n").otherwise("")
    neighbours = F.array_join(F.transform(edges, lambda e: line(e["id"], e["side"], e["version"])), "")
    without = F.array_join(F.transform(F.array_sort(missing), lambda side: line(side, F.lit("missing"))), "")
    text = F.concat(line(F.array_join(versions, "\n")), fields, line(partition, version), apart, neighbours, without)
    return F.substring(F.sha2(text, 256), 1, 12)
