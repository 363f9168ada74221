"""The given tables as raw files of the venues' other series, normalised table by table, and their SQL.

Each query writes files in the venues' own columns, units and words, and each SQL says what the canonical rows are from the tables alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import market
from marketloom.plans import normalise, queries_files, views
from marketloom.plans.queries_files import packed
from marketloom.session import scratch, stored, table
from marketloom.sources import scans

HOUR, DAY = market.HOUR, market.DAY
#: From 2024-01 to 2026-03, in days: series that begin later have the ticks of a later month.
LATER = 790


def _normalised(spark: SparkSession, made: list[tuple[str, DataFrame, dict[str, Column | str] | Column, bool]], target: str, columns: list[str]) -> DataFrame:
    """Writes each (key, rows, raw columns, header) as files, or (key, rows, a line, _) as lines, and normalises all of a venue and dataset together."""
    groups: dict[tuple[str, str], list[DataFrame]] = {}
    for key, rows, raw, header in made:
        path = scratch(spark, "raw")
        if isinstance(raw, Column):
            rows.select(raw.alias("value")).write.text(path)
        else:
            rows.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in raw.items()]).write.options(header=header, escape='"').csv(path)
        venue, _, dataset = key.split("|")[:3]
        files = scans.drop_empty(scans.list_files(spark, path, "part-*")).select("path", F.lit(key).alias("key"))
        groups.setdefault((venue, dataset.split(",")[0]), []).append(files)
    parts = [normalise.normalise(spark, reduce(DataFrame.unionByName, files), venue, dataset)[target] for (venue, dataset), files in groups.items()]
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def _ticks(spark, sf_dir):
    t = stored(views.ticks(spark, sf_dir), "ticks")  # every series' files are made of them
    return t.withColumns({"word": F.when(F.col("side") == "click", "SELL").otherwise("Buy"), "base": F.col("size") * 3, "quote": F.col("size") * 5, "ms": F.expr("ts div 1000"),
                          "seconds": F.concat(F.expr("ts div 1000000"), F.lit("."), F.lpad(F.expr("ts % 1000000").cast("string"), 6, "0"))})


def _later(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"ts": F.col("ts") + LATER * DAY, "ms": F.col("ms") + LATER * DAY // 1000})


TRADES = ["venue", "market", "symbol", "ts", "tradeId", "price", "size", "baseSize", "quoteSize", "side", "buyerMaker", "margin", "aggregated"]


def trades_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of series without a header: other places for the two legs, makers for sides, codes for sides."""
    t = _ticks(spark, sf_dir)
    maker, none, code = F.col("side") == "click", F.lit("0"), F.when(F.col("side") == "click", "2").otherwise("1")
    spot = {"a": "sequence", "b": "price", "c": "size", "d": "quote", "e": "ms", "f": maker}
    aggregate = {"a": "sequence", "b": "price", "c": "size", "d": none, "e": none, "f": "ms", "g": maker}
    contracts = {"a": "sequence", "b": "ms", "c": "price", "d": "size", "e": "base"}
    return _normalised(spark, [
        ("binance|spot|trades|BTCUSDT|202401.csv", t, {**spot, "g": none}, False),
        ("binance|perp|trades|BTCUSD_PERP|202401.csv", t, {**spot, "d": "base"}, False),
        ("binance|spot|trades,aggregated|BTCUSDT|202401.csv", t, {**aggregate, "h": none}, False),
        ("binance|perp|trades,aggregated|BTCUSDT|202401.csv", t, aggregate, False),
        ("binance|perp|trades,aggregated|BTCUSD_PERP|202401.csv", t, aggregate, False),
        ("gate|spot|trades|BTC_USDT|202401.csv", t, {"a": "seconds", "b": "sequence", "c": "price", "d": "size", "e": code}, False),
        ("htx|spot|trades|BTC-USDT|202401.csv", t, {"a": "sequence", "b": "ms", "c": "price", "d": "size", "e": "word"}, False),
        ("htx|option|trades|BTC-USDT-C|202401.csv", t, {**contracts, "f": "quote", "g": "word"}, False),
        *[(f"htx|{m}|trades|BTC-USD|202401.csv", t, {**contracts, "f": "word"}, False) for m in ("perp", "future")],
        *[(f"htx|{m}|trades|BTC-USDT|202401.csv", t, {**contracts, "f": "quote", "g": "word"}, False) for m in ("perp", "future")],
    ], "trades", TRADES)


def trades_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of series with a header: other names, instruments in a column, a venue's new files from a month on."""
    t = _ticks(spark, sf_dir)
    kucoin = {"trade_id": "sequence", "trade_time": "ms", "price": "price", "size": "size", "side": "word"}
    perp = {"timestamp": "seconds", "symbol": "symbol", "side": "word", "size": "size", "price": "price", "trdMatchID": "sequence", "RPI": F.lit(0)}
    htx = {"instId": "symbol", "tradeId": "sequence", "px": "price", "side": "word", "size": "size", "ts": "ms"}
    okx = {"instrument_name": "symbol", "trade_id": "sequence", "side": "word", "price": "price", "size": "size", "created_time": "ms"}
    bitget = {"trade_id": "sequence", "timestamp": "ms", "price": "price", "side": "word", "volume(quote)": "quote", "size(base)": "base"}
    return _normalised(spark, [
        ("bybit|perp|trades|BTCUSDT|202401.csv", t, perp, True),
        ("bybit|perp|trades|BTCUSD|202401.csv", t, perp, True),
        ("bybit|spot|trades|BTCUSDT|202401.csv", t, {"id": "sequence", "timestamp": "ms", "price": "price", "volume": "size", "side": "word"}, True),
        ("bybit|option|trades|@|202401.csv", t, {"trade_id": "sequence", "timestamp": "ms", "instrument_name": "symbol", "direction": "word", "price": "price", "amount": "size"}, True),
        ("kucoin|spot|trades|BTC-USDT|202401.csv", t, kucoin, True),
        ("kucoin|perp|trades|XBTUSDTM|202401.csv", t, kucoin, True),
        *[(f"htx|{m}|trades|BTC-USDT|202603.csv", _later(t), htx, True) for m in ("spot", "perp", "future")],
        *[(f"okx|{m}|trades|@|202401.csv", t, okx, True) for m in ("perp", "future", "option")],
        *[(f"bitget|{m}|trades|BTCUSDT|202401.csv", t, bitget, True) for m in ("spot", "perp", "future")],
    ], "trades", TRADES)


def _bars(spark, sf_dir):
    b = stored(market.bars(views.ticks(spark, sf_dir), HOUR), "bars")  # every series' files are made of them
    return b.withColumns({"ms": F.expr("ts div 1000"), "s": F.expr("ts div 1000000"), "turnover": F.col("volume") * 2, "zero": F.lit("0")})


KLINES = ["venue", "market", "symbol", "ts", "open", "high", "low", "close", "volume", "quoteVolume", "trades", "takerBuyVolume", "margin", "interval"]
_OHLC = {c: c for c in ("open", "high", "low", "close")}


def klines_of_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of the series that normalised_klines has not."""
    b = _bars(spark, sf_dir)
    htx_old = {"a": "s", "b": "open", "c": "close", "d": "high", "e": "low", "f": "volume", "g": "turnover"}
    htx_new = {"instId": "symbol", **_OHLC, "vol": "volume", "volCcy": "zero", "volCcyQuote": "turnover", "ts": "ms"}
    okx = {"instrument_name": "symbol", **_OHLC, "vol": "volume", "vol_ccy": "zero", "vol_quote": "turnover", "open_time": "ms", "confirm": "zero"}
    return _normalised(spark, [
        ("binance|perp|klines,1h|BTCUSD_PERP|202401.csv", b, {"a": "ms", **_OHLC, "v": "volume", "x": "zero", "q": "turnover", "n": "trades", "tv": "volume", "tq": "zero", "y": "zero"}, False),
        ("kucoin|perp|klines,1hour|XBTUSDTM|202401.csv", b, {"time": "ms", **_OHLC, "volume": "volume"}, True),
        ("gate|perp|klines,1h|BTC_USDT|202401.csv", b, {"a": "s", "b": "volume", "c": "close", "d": "high", "e": "low", "f": "open"}, False),
        ("gate|tradfi|klines,1h|XAU|202401.csv", b, {"a": "s", "b": "close", "c": "high", "d": "low", "e": "open"}, False),
        *[(f"htx|{m}|klines,60min|BTC-USDT|202401.csv", b, htx_old, False) for m in ("perp", "future", "option")],
        *[(f"htx|{m}|klines,60min|BTC-USDT|202603.csv", _later(b), htx_new, True) for m in ("spot", "perp", "future")],
        *[(f"okx|{m}|klines,1H|@|202401.csv", b.unionByName(b), okx, True) for m in ("perp", "future", "option")],
        *[(f"bitget|{m}|klines,1h|BTCUSDT|202401.csv", b, {"Timestamp": "ms", **_OHLC, "baseVolume": "volume", "usdtVolume": "turnover"}, True) for m in ("spot", "perp", "future")],
    ], "klines", KLINES)


REFERENCE = ["venue", "market", "symbol", "ts", "price", "open", "high", "low", "close", "interval"]


def _reference_files(b: DataFrame, dataset: str) -> list[tuple]:
    """The files of the price that a dataset is of: mark and index prices alike at the venues that have both."""
    old, new = {"a": "s", "b": "open", "c": "close", "d": "high", "e": "low"}, {"instId": "symbol", **_OHLC, "ts": "ms"}
    out = [
        (f"binance|perp|{dataset},1h|BTCUSDT|202401.csv", b, {"a": "ms", **_OHLC, **{f"x{i}": "zero" for i in range(7)}}, False),
        (f"kucoin|perp|{dataset},1hour|XBTUSDTM|202401.csv", b, {"time": "ms", **_OHLC}, True),
        (f"htx|perp|{dataset},60min|BTC-USDT|202401.csv", b, old, False),
        (f"htx|perp|{dataset},60min|BTC-USDT|202603.csv", _later(b), new, True),
    ]
    if dataset == "markPrice":
        out += [(f"htx|future|{dataset},60min|BTC-USDT|202401.csv", b, old, False), (f"htx|future|{dataset},60min|BTC-USDT|202603.csv", _later(b), new, True)]
    return out


def mark_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of mark prices of three venues, and a fourth's prices as they tick."""
    t = _ticks(spark, sf_dir)
    ticking = ("gate|perp|markPrice,ticks|BTC_USDT|202401.csv", t, {"a": "seconds", "b": "price", "c": F.lit("0"), "d": F.lit("0")}, False)
    return _normalised(spark, [*_reference_files(_bars(spark, sf_dir), "markPrice"), ticking], "markPrice", REFERENCE)


def index_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of index prices of four venues, and a fifth's words, whose time is in the file's name."""
    b = _bars(spark, sf_dir)
    bybit = ("bybit|spot|indexPrice,60|BTCUSDT|202401.csv", b, {"start_at": "s", **_OHLC}, True)
    bars = _normalised(spark, [*_reference_files(b, "indexPrice"), bybit], "indexPrice", REFERENCE)
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    path = F.concat(F.lit("gate|spot|indexPrice,ticks|@|202401010000.part"), F.lit(1_704_067_200) + (k % 50) * 60, F.lit(".txt"))
    words = p.select(path.alias("path"), F.lit("a").alias("member"), k.alias("n"), F.concat_ws(" ", F.concat(F.lit("P"), k), F.col("p_retailprice")).alias("line"))
    return bars.unionByName(normalise.normalise(spark, packed(words).withColumn("key", F.col("path")), "gate", "indexPrice")["indexPrice"].select(*REFERENCE))


def premium_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bars(spark, sf_dir)
    return _normalised(spark, [
        ("binance|perp|premiumIndex,1h|BTCUSDT|202401.csv", b, {"a": "ms", **_OHLC, **{f"x{i}": "zero" for i in range(7)}}, False),
        ("bybit|perp|premiumIndex,60|BTCUSDT|202401.csv", b, {"start_at": "s", **_OHLC}, True),
    ], "premiumIndex", [c for c in REFERENCE if c != "price"])


def volatility_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {"calc_time": "ms", "symbol": "symbol", "base_asset": F.lit("BTC"), "quote_asset": F.lit("USDT"), "index_value": "price"}
    return _normalised(spark, [("binance|option|volatilityIndex,ticks|BTCBVOLUSDT|202401.csv", _ticks(spark, sf_dir), raw, True)], "volatilityIndex", ["venue", "market", "symbol", "ts", "value"])


def option_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of options' marks with their greeks, one of which the venue misspells."""
    raw = {"instrument_name": F.concat(F.lit("BTC-"), "symbol"), "open_time": "ms", **_OHLC, "delta": "volume", "gama": "turnover", "vega": "trades", "theta": F.lit("")}
    return _normalised(spark, [("bybit|option|markPrice,60|BTC|202401.csv", _bars(spark, sf_dir), raw, True)], "optionMarkPrice",
                       ["venue", "market", "symbol", "ts", "option", "open", "high", "low", "close", "delta", "gamma", "vega", "theta", "interval"])


def borrowing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates by currency, which is the symbol too."""
    return _normalised(spark, [("okx|spot|borrowing|@|202401.csv", _ticks(spark, sf_dir), {"currency_name": "symbol", "borrow_rate": "price", "time": "ms"}, True)], "borrowing", ["venue", "market", "symbol", "ts", "currency", "rate"])


def _clock() -> Column:
    return F.date_format(F.timestamp_micros("ts"), "yyyy-MM-dd HH:mm:ss")


def open_interests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures under times in words, one of them without a number now and then."""
    raw = {"create_time": _clock(), "symbol": "symbol", "sum_open_interest": "price", "sum_open_interest_value": "base", "count_toptrader_long_short_ratio": F.lit("9"), "sum_toptrader_long_short_ratio": F.lit("9"),
           "count_long_short_ratio": F.when(F.col("side") == "error", "").otherwise(F.col("size").cast("string")), "sum_taker_long_short_vol_ratio": "quote"}
    return _normalised(spark, [("binance|perp|openInterest|BTCUSDT|202401.csv", _ticks(spark, sf_dir), raw, True)], "openInterest",
                       ["venue", "market", "symbol", "ts", "openInterest", "openInterestValue", "longShortRatio", "takerLongShortVol", "margin"])


def depth_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {"timestamp": _clock(), "percentage": F.expr("cast(sequence % 11 - 5 AS int)"), "depth": "size", "notional": "quote"}
    return _normalised(spark, [("binance|perp|books,bands,5pct|BTCUSDT|202401.csv", _ticks(spark, sf_dir), raw, True)], "orderBookBands",
                       ["venue", "market", "symbol", "ts", "percentage", "depth", "notional", "margin", "kind", "band"])


def liquidations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Liquidations of two markets, every row of which is there twice."""
    t = _ticks(spark, sf_dir)
    raw = {"time": "ms", "side": "word", "order_type": F.lit("LIMIT"), "time_in_force": F.lit("IOC"), "original_quantity": "size", "price": "price", "average_price": "base", "order_status": F.lit("FILLED"), "last_fill_quantity": "size",
           "accumulated_fill_quantity": "size"}
    return _normalised(spark, [(f"binance|{m}|liquidations|{s}|202401.csv", t.unionByName(t), raw, True) for m, s in (("perp", "BTCUSDT"), ("future", "BTCUSD_240628"))], "liquidations",
                       ["venue", "market", "symbol", "ts", "side", "price", "size", "averagePrice", "status", "margin"])


def _levels(price: Column, size: Column, more: int = 0) -> tuple[Column, Column, Column]:
    """A tick as the levels of one side, of the other, and none."""
    level = F.array(F.array(price.cast("string"), size.cast("string"), *[F.lit(str(more))] * (more > 0)))
    none = F.array().cast("array<array<string>>")
    even = F.col("sequence") % 2 == 0
    return F.when(even, level).otherwise(none), F.when(even, none).otherwise(level), none


def books_of_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as book changes of the series that normalised_books has not: JSON of two venues, in whose lists of levels a price of zero is padding, and signed sizes of a third."""
    t = _ticks(spark, sf_dir)
    asks, bids, _ = _levels(F.col("price"), F.col("size"), 3)
    action = F.when(F.col("side") == "signup", "snapshot").otherwise("update")
    line = F.to_json(F.struct(F.col("symbol").alias("instId"), action.alias("action"), F.col("ms").cast("string").alias("ts"), asks.alias("asks"), bids.alias("bids")))
    signed = {"a": "seconds", "b": F.lit("set"), "c": "price", "d": F.when(F.col("sequence") % 2 == 0, -F.col("size")).otherwise(F.col("size")), "e": "sequence", "f": F.lit("x")}
    return _normalised(spark, [
        *[(f"htx|{m}|books,incremental,150|BTC-USDT|202401.json", t, line, False) for m in ("spot", "perp", "future")],
        *[(f"okx|{m}|books,incremental,400|@|202401.json", t, line, False) for m in ("perp", "future", "option")],
        *[(f"gate|{m}|books,incremental,full|BTC_USDT|202401.csv", t, signed, False) for m in ("perp", "future")],
    ], "orderBook", ["venue", "market", "symbol", "ts", "action", "side", "price", "size", "orderCount", "sequence", "margin", "kind", "depth"])


def snapshots_of_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as whole books: lines of JSON, and JSON in the cells of tables."""
    t = _ticks(spark, sf_dir)
    asks, bids, _ = _levels(F.col("price"), F.col("size"))
    line = F.to_json(F.struct(asks.alias("asks"), bids.alias("bids"), F.col("ms").alias("timestamp"), "sequence"))
    cells = {"timestamp": "ms", "asks": F.to_json(asks), "bids": F.to_json(bids)}
    first = lambda side, i: F.try_element_at(F.try_element_at(F.col(side), F.lit(1)), F.lit(i))
    out = _normalised(spark, [
        ("kucoin|perp|books,snapshot,50|XBTUSDTM|202401.csv", t, line, False),
        *[(f"bitget|{m}|books,snapshot,5|BTCUSDT|202401.csv", t, cells, True) for m in ("spot", "perp", "future")],
    ], "orderBookSnapshot", ["venue", "market", "symbol", "ts", "asks", "bids", "sequence", "margin", "kind", "depth"])
    return out.select("venue", "market", "symbol", "ts", first("asks", 1).alias("ask"), first("asks", 2).alias("ask_size"), first("bids", 1).alias("bid"), first("bids", 2).alias("bid_size"), "sequence", "margin", "kind", "depth")


def quotes_of_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {"timestamp": "ms", "ask_price": F.when(F.col("side") == "error", -999999).otherwise(F.col("price")), "bid_price": "price", "ask_volume": "base", "bid_volume": "size"}
    return _normalised(spark, [(f"bitget|{m}|quotes|BTCUSDT|202401.csv", _ticks(spark, sf_dir), raw, True) for m in ("spot", "future")], "quotes",
                       ["venue", "market", "symbol", "ts", "bidPrice", "bidSize", "askPrice", "askSize", "margin"])


def funding_of_a_later_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series that begins in 2026."""
    return _normalised(spark, [("htx|perp|funding,realised|BTC-USDT|202603.csv", _later(_ticks(spark, sf_dir)), {"instId": "symbol", "fundingRate": "price", "fundingTime": "ms"}, True)], "funding",
                       ["venue", "market", "symbol", "ts", "rate", "intervalHours", "kind"])


QUERIES = {f.__name__: f for f in (trades_by_position, trades_by_name, klines_of_series, mark_prices, index_prices, premium_indexes, volatility_indexes, option_marks, borrowing_rates, open_interests, depth_bands, liquidations,
                                    books_of_series, snapshots_of_series, quotes_of_series, funding_of_a_later_month)}

_T, _HB = views.TICKS, queries_files._HB
_AT = "ts // unit * unit + later * 790 * 86400000000"
_TRADES = f"""SELECT venue, market, coalesce(own, symbol) AS symbol, {_AT} AS ts, CAST(sequence AS VARCHAR) AS "tradeId", price, size * leg AS size, size * base AS "baseSize", size * quote AS "quoteSize", CASE WHEN side = 'click' THEN 'sell' ELSE 'buy' END AS side,
 CASE WHEN venue = 'binance' THEN side = 'click' END AS "buyerMaker", margin, aggregated FROM ticks, v"""
_COLUMNS = "x(venue, market, own, unit, later, leg, base, quote, margin, aggregated)"
ORACLES = {
    "trades_by_position": f"""WITH {_T}, v AS (SELECT * FROM (VALUES
 ('binance', 'spot', 'BTCUSDT', 1000, 0, 1, 1, 5, NULL, 'false'), ('binance', 'perp', 'BTCUSD_PERP', 1000, 0, 1, 3, NULL, 'inverse', 'false'), ('binance', 'spot', 'BTCUSDT', 1000, 0, 1, 1, NULL, NULL, 'true'), ('binance', 'perp', 'BTCUSDT', 1000, 0, 1, 1, NULL, 'linear', 'true'),
 ('binance', 'perp', 'BTCUSD_PERP', 1000, 0, 1, NULL, NULL, 'inverse', 'true'), ('gate', 'spot', 'BTC_USDT', 1, 0, 1, 1, NULL, NULL, 'false'), ('htx', 'spot', 'BTC-USDT', 1000, 0, 1, 1, NULL, NULL, 'false'), ('htx', 'option', 'BTC-USDT-C', 1000, 0, 1, 3, 5, NULL, 'false'),
 ('htx', 'perp', 'BTC-USD', 1000, 0, 1, 3, NULL, 'inverse', 'false'), ('htx', 'future', 'BTC-USD', 1000, 0, 1, 3, NULL, 'inverse', 'false'), ('htx', 'perp', 'BTC-USDT', 1000, 0, 1, 3, 5, 'linear', 'false'), ('htx', 'future', 'BTC-USDT', 1000, 0, 1, 3, 5, 'linear', 'false')) AS {_COLUMNS}) {_TRADES}""",
    "trades_by_name": f"""WITH {_T}, v AS (SELECT * FROM (VALUES
 ('bybit', 'perp', 'BTCUSDT', 1, 0, 1, 1, NULL, 'linear', 'false'), ('bybit', 'perp', 'BTCUSD', 1, 0, 1, NULL, 1, 'inverse', 'false'), ('bybit', 'spot', 'BTCUSDT', 1000, 0, 1, 1, NULL, NULL, 'false'), ('bybit', 'option', NULL, 1000, 0, 1, NULL, NULL, NULL, 'false'),
 ('kucoin', 'spot', 'BTC-USDT', 1000, 0, 1, 1, NULL, NULL, 'false'), ('kucoin', 'perp', 'XBTUSDTM', 1000, 0, 1, NULL, NULL, 'linear', 'false'), ('htx', 'spot', 'BTC-USDT', 1000, 1, 1, 1, NULL, NULL, 'false'), ('htx', 'perp', 'BTC-USDT', 1000, 1, 1, NULL, NULL, 'linear', 'false'),
 ('htx', 'future', 'BTC-USDT', 1000, 1, 1, NULL, NULL, 'linear', 'false'), ('okx', 'perp', NULL, 1000, 0, 1, NULL, NULL, 'linear', 'false'), ('okx', 'future', NULL, 1000, 0, 1, NULL, NULL, 'linear', 'false'), ('okx', 'option', NULL, 1000, 0, 1, NULL, NULL, NULL, 'false'),
 ('bitget', 'spot', 'BTCUSDT', 1000, 0, 3, 3, 5, NULL, 'false'), ('bitget', 'perp', 'BTCUSDT', 1000, 0, 3, 3, 5, 'linear', 'false'), ('bitget', 'future', 'BTCUSDT', 1000, 0, 3, 3, 5, 'linear', 'false')) AS {_COLUMNS}) {_TRADES}""",
    "klines_of_series": f"""WITH {_T}, {_HB}, v AS (SELECT * FROM (VALUES
 ('binance', 'perp', 'BTCUSD_PERP', 0, true, true, true, 'inverse', '1h'), ('kucoin', 'perp', 'XBTUSDTM', 0, true, false, false, 'linear', '1hour'), ('gate', 'perp', 'BTC_USDT', 0, true, false, false, 'linear', '1h'), ('gate', 'tradfi', 'XAU', 0, false, false, false, NULL, '1h'),
 ('htx', 'perp', 'BTC-USDT', 0, true, false, false, 'linear', '60min'), ('htx', 'future', 'BTC-USDT', 0, true, false, false, 'linear', '60min'), ('htx', 'option', 'BTC-USDT', 0, true, false, false, NULL, '60min'), ('htx', 'spot', 'BTC-USDT', 1, true, true, false, NULL, '60min'),
 ('htx', 'perp', 'BTC-USDT', 1, true, true, false, 'linear', '60min'), ('htx', 'future', 'BTC-USDT', 1, true, true, false, 'linear', '60min'), ('okx', 'perp', NULL, 0, true, true, false, 'linear', '1H'), ('okx', 'future', NULL, 0, true, true, false, 'linear', '1H'),
 ('okx', 'option', NULL, 0, true, true, false, NULL, '1H'), ('bitget', 'spot', 'BTCUSDT', 0, true, true, false, NULL, '1h'), ('bitget', 'perp', 'BTCUSDT', 0, true, true, false, 'linear', '1h'), ('bitget', 'future', 'BTCUSDT', 0, true, true, false, 'linear', '1h'))
 AS x(venue, market, own, later, v, q, n, margin, interval))
SELECT venue, market, coalesce(own, symbol) AS symbol, ts + later * {LATER} * {DAY} AS ts, open, high, low, close, CASE WHEN v THEN volume END AS volume, CASE WHEN q THEN volume * 2 END AS "quoteVolume", CASE WHEN n THEN trades END AS trades, CASE WHEN n THEN volume END AS "takerBuyVolume", margin, interval FROM hb, v""",
    "mark_prices": f"""WITH {_T}, {_HB}, v AS (SELECT * FROM (VALUES ('binance', 'perp', 'BTCUSDT', 0, '1h'), ('kucoin', 'perp', 'XBTUSDTM', 0, '1hour'), ('htx', 'perp', 'BTC-USDT', 0, '60min'), ('htx', 'perp', 'BTC-USDT', 1, '60min'), ('htx', 'future', 'BTC-USDT', 0, '60min'), ('htx', 'future', 'BTC-USDT', 1, '60min')) AS x(venue, market, own, later, interval))
SELECT venue, market, own AS symbol, ts + later * {LATER} * {DAY} AS ts, NULL::DOUBLE AS price, open, high, low, close, interval FROM hb, v UNION ALL SELECT 'gate', 'perp', 'BTC_USDT', ts, price, NULL, NULL, NULL, NULL, NULL FROM ticks""",
    "index_prices": f"""WITH {_T}, {_HB}, v AS (SELECT * FROM (VALUES ('binance', 'perp', 'BTCUSDT', 0, '1h'), ('kucoin', 'perp', 'XBTUSDTM', 0, '1hour'), ('htx', 'perp', 'BTC-USDT', 0, '60min'), ('htx', 'perp', 'BTC-USDT', 1, '60min'), ('bybit', 'spot', 'BTCUSDT', 0, '60')) AS x(venue, market, own, later, interval))
SELECT venue, market, own AS symbol, ts + later * {LATER} * {DAY} AS ts, NULL::DOUBLE AS price, open, high, low, close, interval FROM hb, v UNION ALL SELECT 'gate', 'spot', 'P' || p_partkey, (1704067200 + p_partkey % 50 * 60) * 1000000, p_retailprice, NULL, NULL, NULL, NULL, NULL FROM part""",
    "premium_indexes": f"WITH {_T}, {_HB}, v AS (SELECT * FROM (VALUES ('binance', '1h'), ('bybit', '60')) AS x(venue, interval)) SELECT venue, 'perp' AS market, 'BTCUSDT' AS symbol, ts, open, high, low, close, interval FROM hb, v",
    "volatility_indexes": f"WITH {_T} SELECT 'binance' AS venue, 'option' AS market, 'BTCBVOLUSDT' AS symbol, ts // 1000 * 1000 AS ts, price AS value FROM ticks",
    "option_marks": f"WITH {_T}, {_HB} SELECT 'bybit' AS venue, 'option' AS market, 'BTC' AS symbol, ts, 'BTC-' || symbol AS option, open, high, low, close, volume AS delta, volume * 2 AS gamma, CAST(trades AS DOUBLE) AS vega, NULL::DOUBLE AS theta, '60' AS interval FROM hb",
    "borrowing_rates": f"WITH {_T} SELECT 'okx' AS venue, 'spot' AS market, symbol, ts // 1000 * 1000 AS ts, symbol AS currency, price AS rate FROM ticks",
    "open_interests": f"""WITH {_T} SELECT 'binance' AS venue, 'perp' AS market, 'BTCUSDT' AS symbol, ts // 1000000 * 1000000 AS ts, price AS "openInterest", size * 3 AS "openInterestValue", CASE WHEN side <> 'error' THEN size END AS "longShortRatio", size * 5 AS "takerLongShortVol", 'linear' AS margin FROM ticks""",
    "depth_bands": f"WITH {_T} SELECT 'binance' AS venue, 'perp' AS market, 'BTCUSDT' AS symbol, ts // 1000000 * 1000000 AS ts, CAST(sequence % 11 - 5 AS DOUBLE) AS percentage, size AS depth, size * 5 AS notional, 'linear' AS margin, 'bands' AS kind, '5pct' AS band FROM ticks",
    "books_of_series": f"""WITH {_T}, v AS (SELECT * FROM (VALUES ('htx', 'spot', 'BTC-USDT', NULL, '150'), ('htx', 'perp', 'BTC-USDT', 'linear', '150'), ('htx', 'future', 'BTC-USDT', 'linear', '150'), ('okx', 'perp', NULL, 'linear', '400'), ('okx', 'future', NULL, 'linear', '400'), ('okx', 'option', NULL, NULL, '400'),
 ('gate', 'perp', 'BTC_USDT', 'linear', 'full'), ('gate', 'future', 'BTC_USDT', 'linear', 'full')) AS x(venue, market, own, margin, depth))
SELECT venue, market, coalesce(own, symbol) AS symbol, CASE WHEN venue = 'gate' THEN ts ELSE ts // 1000 * 1000 END AS ts, CASE WHEN venue <> 'gate' AND side = 'signup' THEN 'snapshot' ELSE 'set' END AS action,
 CASE WHEN venue = 'gate' AND size = 0 THEN NULL WHEN sequence % 2 = 0 THEN 'ask' ELSE 'bid' END AS side, price, size, CASE WHEN venue = 'okx' THEN 3::BIGINT END AS "orderCount", CASE WHEN venue = 'gate' THEN sequence END AS sequence, margin, 'incremental' AS kind, depth FROM ticks, v WHERE venue = 'gate' OR price IS DISTINCT FROM 0""",
    "snapshots_of_series": f"""WITH {_T}, v AS (SELECT * FROM (VALUES ('kucoin', 'perp', 'XBTUSDTM', 'linear', '50'), ('bitget', 'spot', 'BTCUSDT', NULL, '5'), ('bitget', 'perp', 'BTCUSDT', 'linear', '5'), ('bitget', 'future', 'BTCUSDT', 'linear', '5')) AS x(venue, market, symbol, margin, depth))
SELECT venue, market, v.symbol, ts // 1000 * 1000 AS ts, CASE WHEN sequence % 2 = 0 THEN price END AS ask, CASE WHEN sequence % 2 = 0 THEN size END AS ask_size, CASE WHEN sequence % 2 = 1 THEN price END AS bid, CASE WHEN sequence % 2 = 1 THEN size END AS bid_size,
 CASE WHEN venue = 'kucoin' THEN sequence END AS sequence, margin, 'snapshot' AS kind, depth FROM ticks, v""",
    "quotes_of_series": f"""WITH {_T}, v AS (SELECT * FROM (VALUES ('spot', NULL), ('future', 'linear')) AS x(market, margin))
SELECT 'bitget' AS venue, market, 'BTCUSDT' AS symbol, ts // 1000 * 1000 AS ts, price AS "bidPrice", size AS "bidSize", CASE WHEN side <> 'error' THEN price END AS "askPrice", size * 3 AS "askSize", margin FROM ticks, v""",
    "funding_of_a_later_month": f"""WITH {_T} SELECT 'htx' AS venue, 'perp' AS market, 'BTC-USDT' AS symbol, ts // 1000 * 1000 + {LATER} * {DAY} AS ts, price AS rate, NULL::BIGINT AS "intervalHours", 'realised' AS kind FROM ticks""",
    "liquidations": f"""WITH {_T}, v AS (SELECT * FROM (VALUES ('perp', 'BTCUSDT', 'linear'), ('future', 'BTCUSD_240628', 'inverse')) AS x(market, own, margin)), d AS (SELECT DISTINCT ts // 1000 * 1000 AS ts, CASE WHEN side = 'click' THEN 'sell' ELSE 'buy' END AS side, price, size FROM ticks)
SELECT 'binance' AS venue, market, own AS symbol, ts, side, price, size, size * 3 AS "averagePrice", 'FILLED' AS status, margin FROM d, v""",
}
