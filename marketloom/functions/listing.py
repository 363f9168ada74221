"""Keys of listed files: extensions, parts, bar lengths and named levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.names import norm_etag
from marketloom.functions.times import last_settled, next_period, stamp_to_time

# Endings, slots, durations, levels by dataset, and the names of two kinds of misnamed files.
COMPRESSED = ["gz", "bz2", "xz", "zst"]
SLOTS = {"{YYYY}": r"\d{4}", "{MM}": r"\d{2}", "{DD}": r"\d{2}", "{MONTH_LAST_DAY}": r"\d{2}", "{PART}": "(.+?)"}
DURATION = r"(?i)^\d+(?:s|m|min|h|hour|d|day|w|week|mo|mon|month)$"
MINUTES = r"\{SYMBOL\}_(\d+)_\{"
LEVELS = [
    (["interval"], ["klines", "markPrice", "indexPrice", "premiumIndex", "volatilityIndex", "optionSummary", "optionTicker"]),
    (["kind", "depth"], ["books"]),
    (["aggregation"], ["trades"]),
    (["kind"], ["funding"]),
]
BOOK_SLICE = r"(^|/)orderbooks_slice/[^/]+/[^/]+\.gz$"
TEXT_SLICE = r"(^|/)slice_[a-z_]+_\d+$"


def _extension_like(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9a-z]*[a-z][0-9a-z]*$"), F.lit(False))


def extension_of(path: Column) -> Column:
    """The ending of a file's canonical name: that of its own name, text where it has none, and what two kinds of
    misnamed files hold."""
    parts = F.split(F.lower(F.element_at(F.split(path, "/"), -1)), r"\.")
    last, inner = F.when(F.size(parts) > 1, F.element_at(parts, -1)), F.when(F.size(parts) > 2, F.element_at(parts, -2))
    return (F.when(path.rlike(BOOK_SLICE), ".json.gz").when(path.rlike(TEXT_SLICE), ".txt")
            .when(~_extension_like(last), ".txt").when(~last.isin(COMPRESSED), F.concat(F.lit("."), last))
            .when(_extension_like(inner), F.concat(F.lit("."), inner, F.lit("."), last)).otherwise(F.concat(F.lit(".txt."), last)))


def pattern_regex(pattern: Column) -> Column:
    """The file-name part of a URL pattern as a regular expression whose first group is the part slot."""
    name = F.element_at(F.split(pattern, "/"), -1)
    marked = F.regexp_replace(name, r"([.*+?^$()|\[\]\\])", r"\\$1")
    for slot, rx in SLOTS.items():
        marked = F.replace(marked, F.lit(slot), F.lit(rx.replace("{", "\x01").replace("}", "\x02")))
    marked = F.regexp_replace(marked, r"\{TRANSFORM:[^{}]*(\{[A-Z_]+\})?[^{}]*\}|\{[A-Z_]+\}", ".+?")
    return F.concat(F.lit("^"), F.translate(marked, "\x01\x02", "{}"), F.lit("$"))


def part_of(path: Column, pattern: Column) -> Column:
    """What stands in a path where its pattern has the part slot; null if the pattern has none."""
    return F.when(pattern.contains("{PART}"), F.nullif(F.call_function("regexp_extract", F.element_at(F.split(path, "/"), -1), pattern_regex(pattern), F.lit(1)), F.lit("")))


def catalog_key(prefix: Column, pattern: Column, date: Column, path: Column) -> Column:
    """The key of a file under its series' prefix venue/market/dataset/letter/symbol/."""
    levels = F.split(prefix, "/")
    symbol = F.when(levels[3] == "@", "@").otherwise(levels[4])
    part = F.coalesce(F.concat(F.lit(".part"), part_of(path, pattern)), F.lit(""))
    return F.concat(prefix, F.substring(date, 1, 6), F.lit("/"), F.concat_ws("|", levels[0], levels[1], levels[2], symbol, date), part, extension_of(path))


def interval_of(pattern: Column) -> Column:
    """The bar length in a URL pattern: a segment that is a duration, or minutes after the symbol."""
    segment = F.get(F.filter(F.split(pattern, "/"), lambda x: x.rlike(DURATION)), F.lit(0))
    return F.coalesce(segment, F.nullif(F.regexp_extract(pattern, MINUTES, 1), F.lit("")))


def levels_map(dataset: Column, variant: Column) -> Column:
    """A variant's named levels; the last takes what is left. Trades without a variant have the default aggregation."""
    parts = F.split(variant, ",")
    out = F.create_map().cast("map<string,string>")
    for names, datasets in LEVELS:
        values = [F.get(parts, F.lit(i)) if i < len(names) - 1 else F.array_join(F.slice(parts, i + 1, F.greatest(F.size(parts) - i, F.lit(0))), ",") for i in range(len(names))]
        given = F.map_filter(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*values)), lambda k, v: F.coalesce(v, F.lit("")) != "")
        out = F.when(dataset.isin(datasets) & (variant != ""), given).otherwise(out)
    return F.when((dataset == "trades") & (variant == ""), F.create_map(F.lit("aggregation"), F.lit("default"))).otherwise(out)


def digest_agrees(etag: Column, content: Column) -> Column:
    """Whether a tag that is a whole-object digest is that of the content."""
    return norm_etag(etag) == F.md5(content)


def is_open(state: Column, retired: Column, last: Column, tip: Column, grain: Column) -> Column:
    """Whether more files of a series are to be expected: it is active, has none yet, or its newest was settled when its tip fell due."""
    due = stamp_to_time(next_period(tip, grain))
    return ((state == "active") & retired.isNull()) | last.isNull() | F.coalesce(last >= last_settled(grain, due), F.lit(False))


def means(market: str | None = None, dataset: str | None = None, variant: str | None = None, start: str | None = None, end: str | None = None) -> Column:
    """The condition of a selection over market, dataset, variant and month; what is not given leaves all."""
    out = F.lit(True)
    for name, value in (("market", market), ("dataset", dataset)):
        out = out & (F.col(name) == value) if value else out
    out = out & (F.col("variant") == variant) if variant is not None else out
    out = out & (F.col("month") >= start) if start else out
    return out & (F.col("month") <= end) if end else out
