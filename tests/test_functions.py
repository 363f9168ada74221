"""Times, names and listing functions on single values."""

import pytest
from pyspark.sql import functions as F

from marketloom.functions import listing, names, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text, us", [
    ("1704067200", 1_704_067_200_000_000), ("1704067200123", 1_704_067_200_123_000), ("1704067200123456", 1_704_067_200_123_456), ("1704067200123456500", 1_704_067_200_123_457),
    ("1704067200.5", 1_704_067_200_500_000), ("1704067200.1234567", 1_704_067_200_123_457), ("1704067200.123456499", 1_704_067_200_123_456), ("1704067200123.4567", 1_704_067_200_123_457),
    (" 2024-01-01 00:00:00 ", 1_704_067_200_000_000), ("2024-01-01T00:00:00Z", 1_704_067_200_000_000), ("2024.01.01 00:00", 1_704_067_200_000_000), ("2024.01.01 00:00:01", 1_704_067_201_000_000),
    ("12:30", None), ("2024", 2_024_000_000), ("1.2.3", None), ("", None), ("time", None), ("-5", -5_000_000), ("99999999999999999999", None), ("1e9", None)])
def test_times(spark, text, us):
    assert times.with_us(spark.createDataFrame([(text,)], "t string"), F.col("t")).first().ts == us


def test_zone_and_month(spark):
    row = times.with_us(spark.createDataFrame([("2024.01.01 02:00",)], "t string"), F.col("t"), utc_offset_hours=3).withColumn("m", times.month_of(F.col("ts"))).first()
    assert row.m == "2023-12"


@pytest.mark.parametrize("token, want", [("60min", "1h"), ("7d", "1w"), ("90m", "90m"), ("1mo", "1mo"), ("month", "1mo"), ("15", "15m"), ("0m", None), ("x", None), ("8d", "8d"), ("24h", "1d"), ("61s", "61s"), ("0mo", None), ("3600 sec", "1h")])
def test_intervals(spark, token, want):
    assert one(spark, names.canonical_interval(F.lit(token))) == want


@pytest.mark.parametrize("venue, market, symbol, want", [("binance", "perp", "BTCUSD_PERP", "inverse"), ("bybit", "future", "BTCUSDZ24", "inverse"), ("bybit", "perp", "BTCUSDT", "linear"), ("okx", "spot", "BTC-USD", None), ("gate", "perp", "BTC_USD", "inverse"), ("kucoin", "perp", "XBTUSDM", "inverse"), ("htx", "perp", "BTC-USDT", "linear"), ("bitget", "perp", "BTCUSD_CM", "inverse")])
def test_margin(spark, venue, market, symbol, want):
    assert one(spark, names.margin_of(F.lit(venue), F.lit(market), F.lit(symbol))) == want


def test_keys(spark):
    def parsed(key):
        return names.parse_keys(spark.createDataFrame([(key,)], "key string")).first()

    row = parsed("d/okx|perp|books,incremental,400|BTC-USD-SWAP|20240131.part2.json.gz")
    assert (row.venue, row.dataset, row.variant, row.bundle, row.month, row.grain, row.part, row.container) == ("okx", "books", "incremental,400", "instrument", "2024-01", "daily", "2", "gzip")
    assert parsed("okx|perp|trades|@|202401.tar.gz").container == "tar.gz" and parsed("okx|perp|trades|@|202401.tar.gz").bundle == "market"
    for bad in ("x|y", "okx|perp|trades|A|2024.zip", "okx|perp|trades|A|202401.bak", "okx|perp|trades|A|202401.csv.xz", "okx|perp|trades|A|202401.part2"):
        assert parsed(bad).venue is None
    first, last = names.edge_of(F.lit("20240229"), F.lit("daily"))
    assert (one(spark, first), one(spark, last)) == (False, True)


def test_tags_and_numbers(spark):
    assert one(spark, names.norm_etag(F.lit('"ABC-gzip"'))) == "abc" and one(spark, names.norm_etag(F.lit('W/"ABC-gzip"'))) == 'w/"abc' and one(spark, names.norm_etag(F.lit('a"b-GZIP'))) == 'a"b-gzip'
    assert one(spark, listing.digest_agrees(F.lit('"5D41402ABC4B2A76B9719D911017C592"'), F.lit(b"hello"))) is True
    assert one(spark, names.unsentinel(F.lit("-999999.0"))) is None and one(spark, names.first_number(F.lit("x"), F.lit("2"))) == 2.0
    prefix = lambda s, v="": one(spark, names.series_prefix(F.lit("v"), F.lit("m"), F.lit("d"), F.lit(v), F.lit(s).cast("string")))
    assert prefix("btc") == "v/m/d/B/btc/" and prefix("1INCH", "1m") == "v/m/d,1m/_/1INCH/" and prefix(None) == "v/m/d/@/" and prefix("") is prefix("a/b") is None


def test_listing_names(spark):
    assert one(spark, listing.part_of(F.lit("a/X-202402-7.zip"), F.lit("a/{SYMBOL}-{YYYY}{MM}-{PART}.zip"))) == "7"
    assert one(spark, listing.part_of(F.lit("a/X.zip"), F.lit("a/{SYMBOL}.zip"))) is None
    assert one(spark, listing.extension_of(F.lit("orderbooks_slice/x/y.gz"))) == ".json.gz"
    assert one(spark, listing.is_open(F.lit("closed"), F.lit("202301"), F.lit("20240110"), F.lit("20240120"), F.lit("daily"))) is True
    assert one(spark, listing.is_open(F.lit("closed"), F.lit("202301"), F.lit("20240101"), F.lit("20240120"), F.lit("daily"))) is False


def test_periods(spark):
    assert one(spark, times.next_period(F.lit("202412"), F.lit("monthly"))) == "202501"
    assert one(spark, times.at_grain(F.lit("202412"), F.lit("hourly"))) == "2024120100"
    assert one(spark, times.grain_of(F.lit("a/{YYYY}{MM}{DD}.zip"))) == "daily"


def test_revision_depends_on_all(spark):
    texts = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    none, edge = F.array().cast("array<struct<id:string,side:string,version:string>>"), F.array(F.struct(F.lit("n").alias("id"), F.lit("pre").alias("side"), F.lit("e").alias("version")))
    base = [texts("s"), F.lit("f"), F.lit("p"), F.lit("v"), none, texts()]
    other = [texts("t"), F.lit("g"), F.lit("q"), F.lit("w"), edge, texts("post")]
    seen = {one(spark, names.revision(*(other[j] if j == i else base[j] for j in range(6)))) for i in range(7)}
    assert len(seen) == 7 and all(len(x) == 12 for x in seen)
    assert one(spark, names.revision(*base[:5], texts("pre", "post"))) == one(spark, names.revision(*base[:5], texts("post", "pre")))
