"""Texts and numbers of any unit to microseconds UTC, in integers only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND, MILLI, MICRO = 10**11, 10**14, 10**17
ISO = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"


def epoch_to_us(value: Column) -> Column:
    """An integer epoch to µs; its magnitude tells seconds, milli-, micro- and nanoseconds apart."""
    size = F.abs(value)
    return F.when(size < SECOND, value * 1_000_000).when(size < MILLI, value * 1000).when(size < MICRO, value).otherwise(F.floor((value + 500) / F.lit(1000).cast("decimal(20,0)")).cast("long"))


def _digits(fraction: Column, keep: int) -> Column:
    """The first `keep` digits of a fraction as a number, rounded half up by the next."""
    up = F.when(F.substring(fraction, keep + 1, 1) >= "5", 1).otherwise(0)
    return (F.substring(fraction, 1, keep).cast("long") + up) if keep else up.cast("long")


def fraction_to_us(whole: Column, fraction: Column) -> Column:
    """A fractional epoch, split at its dot, to µs; fraction has nine digits."""
    size = F.abs(whole)
    return (F.when(size < SECOND, whole * 1_000_000 + _digits(fraction, 6)).when(size < MILLI, whole * 1000 + _digits(fraction, 3))
            .when(size < MICRO, whole + _digits(fraction, 0)).otherwise(F.floor((whole + 500) / F.lit(1000).cast("decimal(20,0)")).cast("long")))


def datetime_to_us(text: Column) -> Column:
    """ISO texts and yyyy.MM.dd HH:mm[:ss] to µs. ISO is held to a pattern, as a cast alone would
    read a bare time as today's and a bare year as a date."""
    iso = F.when(text.rlike(ISO), text.try_cast("timestamp"))
    dotted = F.coalesce(F.try_to_timestamp(text, F.lit("yyyy.MM.dd HH:mm")), F.try_to_timestamp(text, F.lit("yyyy.MM.dd HH:mm:ss")))
    return F.unix_micros(F.coalesce(iso, F.when(text.rlike(r"^\d{4}\.\d{2}\.\d{2} \d{2}:\d{2}(:\d{2})?$"), dotted)))


def integral(text: Column) -> Column:
    """A whole number, or null: a text with a dot is none."""
    return F.when(~text.contains("."), text.try_cast("bigint"))


def with_us(df: DataFrame, source: Column, out: str = "ts", utc_offset_hours: int = 0) -> DataFrame:
    """df with `out`, source in µs UTC, null where it is no time.

    Staged columns, so that each text is parsed once: the integer path first, then the text with
    one dot, then dates. `utc_offset_hours` is the zone that the source's times are in.
    """
    text = F.col("_text")
    one_dot = F.col("_int").isNull() & (F.length(text) - F.length(F.replace(text, F.lit("."), F.lit(""))) == 1)
    df = df.withColumn("_text", F.trim(source.cast("string"))).withColumn("_int", integral(text))
    df = df.withColumn("_fraction", F.when(one_dot, F.rpad(F.split_part(text, F.lit("."), F.lit(2)), 9, "0")))
    df = df.withColumn("_whole", F.when(F.col("_fraction").try_cast("bigint").isNotNull(), F.split_part(text, F.lit("."), F.lit(1)).try_cast("bigint")))
    us = F.when(F.col("_int").isNotNull(), epoch_to_us(F.col("_int"))).when(F.col("_whole").isNotNull(), fraction_to_us(F.col("_whole"), F.col("_fraction"))).otherwise(datetime_to_us(text))
    if utc_offset_hours:
        us = us - F.lit(utc_offset_hours * 3_600_000_000)
    return df.withColumn(out, us).drop("_text", "_int", "_fraction", "_whole")


def time_in_name(path: Column) -> Column:
    """The number after .part in a file name."""
    return F.regexp_extract(path, r"\.part(\d+)\.[a-z0-9]+$", 1)


def month_of(us: Column) -> Column:
    return F.date_format(F.timestamp_micros(us), "yyyy-MM")


def shifted_month(month: Column, by: int) -> Column:
    """A month yyyy-MM, `by` months on."""
    return F.date_format(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), by), "yyyy-MM")


def month_start_us(month: Column) -> Column:
    return F.unix_micros(F.to_timestamp(F.concat(month, F.lit("-01"))))


# Stamp widths by grain.
WIDTH = {"monthly": 6, "daily": 8, "hourly": 10, "minutely": 12}
_STEP = {"daily": "INTERVAL 1 DAY", "hourly": "INTERVAL 1 HOUR", "minutely": "INTERVAL 1 MINUTE", "monthly": "INTERVAL 1 MONTH"}
_FORMAT = {"monthly": "yyyyMM", "daily": "yyyyMMdd", "hourly": "yyyyMMddHH", "minutely": "yyyyMMddHHmm"}


def _by_grain(grain: Column, make) -> Column:
    return F.when(grain == "monthly", make("monthly")).when(grain == "daily", make("daily")).when(grain == "hourly", make("hourly")).when(grain == "minutely", make("minutely"))


def at_grain(stamp: Column, grain: Column) -> Column:
    """A stamp cut, or widened by its first period, to a grain."""
    wide = F.concat(stamp, F.substring(F.lit("010000"), F.length(stamp) - 5, F.lit(6)))
    return _by_grain(grain, lambda g: F.substring(F.when(F.length(stamp) >= WIDTH[g], stamp).otherwise(wide), 1, WIDTH[g]))


def stamp_to_time(stamp: Column) -> Column:
    return F.to_timestamp(F.rpad(F.concat(stamp, F.substring(F.lit("010000"), F.length(stamp) - 5, F.lit(6))), 12, "0"), "yyyyMMddHHmm")


def stamp_of(time: Column, grain: Column) -> Column:
    return _by_grain(grain, lambda g: F.date_format(time, _FORMAT[g]))


def next_period(stamp: Column, grain: Column, by: int = 1) -> Column:
    return _by_grain(grain, lambda g: F.date_format(stamp_to_time(F.substring(stamp, 1, WIDTH[g])) + F.expr(f"{_STEP[g]} * {by}"), _FORMAT[g]))


def last_closed(grain: Column, now: Column) -> Column:
    """The newest period over at `now`."""
    return _by_grain(grain, lambda g: F.date_format(now - F.expr(_STEP[g]), _FORMAT[g]) if g != "monthly" else F.date_format(F.add_months(F.trunc(now, "MM"), -1), "yyyyMM"))


def last_settled(grain: Column, now: Column, days: int = 15) -> Column:
    """The newest period over for `days` days at `now`."""
    return last_closed(grain, now - F.expr(f"INTERVAL {days} DAYS"))


def grain_of(pattern: Column) -> Column:
    """The grain of a URL pattern: that of its finest slot."""
    return F.when(pattern.contains("MI}"), "minutely").when(pattern.contains("HH}"), "hourly").when(pattern.contains("DD}"), "daily").otherwise("monthly")
