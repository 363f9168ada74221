"""The series map: which raw files are read how, and onto which canonical columns.

An entry says who publishes it (venue, market, dataset, variant), how the files are read (format,
columns) and what each canonical column is: a Spark SQL expression over the raw columns. Column
orders, names and the choice of units are the venues'.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Series:
    venue: str
    market: str
    dataset: str
    table: str
    ts: str
    project: dict[str, str]
    format: str = "csv"
    header: bool = True
    columns: tuple[str, ...] = ()
    fields: str = ""
    variant: str = ""
    margin: str | None = None
    since: str | None = None
    until: str | None = None
    spill: str | None = None
    repeats: bool = False
    utc_offset_hours: int = 0
    instrument: str | None = None
    rows: Callable[[DataFrame], DataFrame] | None = field(default=None, compare=False)


def unfold_levels(asks: str, bids: str) -> Callable[[DataFrame], DataFrame]:
    """Rows of an order book: one for each level of either side, as _side, _price, _size, _third. A level
    whose price is zero is padding; one whose price is no number stays."""

    def run(df: DataFrame) -> DataFrame:
        sides = F.array(F.struct(F.lit("ask").alias("side"), F.expr(asks).alias("levels")), F.struct(F.lit("bid").alias("side"), F.expr(bids).alias("levels")))
        one = df.select("*", F.inline(sides).alias("_side", "_levels")).select("*", F.explode("_levels").alias("_l")).drop("_levels")
        cells = {name: F.try_element_at("_l", F.lit(i)) for i, name in enumerate(("_price", "_size", "_third"), 1)}
        return one.withColumns(cells).drop("_l").filter(~F.col("_price").try_cast("double").eqNullSafe(F.lit(0.0)))

    return run


def json_line(schema: str) -> Callable[[DataFrame], DataFrame]:
    """Lines that are JSON objects, parsed into _m; null for any other line."""
    return lambda df: df.withColumn("_m", F.when(F.col("line").startswith("{"), F.from_json("line", schema))).drop("line")


def _cells(*same: str, **named: str) -> dict[str, str]:
    """A projection: canonical columns from raw cells of the same names, and of other names."""
    return {name: f"`{cell}`" for name, cell in {**{n: n for n in same}, **named}.items()}


# The venues' column orders ("-" is not read), names and codes.
C = {
    "binance spot trade": ("id", "price", "qty", "quoteQty", "rawTs", "buyerMaker", "-"),
    "binance linear trade": ("id", "price", "qty", "quoteQty", "rawTs", "buyerMaker"),
    "binance inverse trade": ("id", "price", "qty", "baseQty", "rawTs", "buyerMaker"),
    "binance aggregate": ("id", "price", "qty", "-", "-", "rawTs", "buyerMaker"),
    "binance spot aggregate": ("id", "price", "qty", "-", "-", "rawTs", "buyerMaker", "-"),
    "binance kline": ("rawTs", "open", "high", "low", "close", "volume", "-", "quoteVolume", "trades", "takerBuyVolume", "takerBuyQuote", "-"),
    "bybit kline": ("rawTs", "open", "high", "low", "close", "volume"),
    "gate spot trade": ("rawTs", "id", "price", "size", "side"),
    "gate futures trade": ("rawTs", "id", "price", "size"),
    "gate kline": ("rawTs", "volume", "close", "high", "low", "open"),
    "gate tradfi kline": ("rawTs", "close", "high", "low", "open"),
    "gate mark": ("rawTs", "price", "-", "-"),
    "gate funding": ("rawTs", "rate"),
    "gate predicted funding": ("rawTs", "rate", "-", "-", "-", "-", "-", "-"),
    "gate spot book": ("rawTs", "side", "action", "price", "size", "id", "-"),
    "gate futures book": ("rawTs", "action", "price", "size", "id", "-"),
    "gate index": ("name", "price"),
    "gate option": ("name", "markPrice", "markIv", "bidSize", "bidPrice", "bidIv", "askSize", "askPrice", "askIv", "delta", "gamma", "theta", "vega"),
    "htx spot trade": ("id", "rawTs", "price", "base", "side"),
    "htx inverse trade": ("id", "rawTs", "price", "contracts", "base", "side"),
    "htx linear trade": ("id", "rawTs", "price", "contracts", "base", "quote", "side"),
    "htx kline": ("rawTs", "open", "close", "high", "low", "vol", "amount"),
    "htx reference": ("rawTs", "open", "close", "high", "low"),
}
OHLC = _cells("open", "high", "low", "close")
SIDE = {"side": "lower(`side`)"}
MAKER = {"side": "CASE WHEN lower(buyerMaker) IN ('true', '1') THEN 'sell' ELSE 'buy' END", "buyerMaker": "lower(buyerMaker) IN ('true', '1')"}
LEVEL = {"side": "_side", "price": "_price", "size": "_size"}
BOOK = "instId string, action string, ts string, asks array<array<string>>, bids array<array<string>>"
IMAGE = "CASE WHEN {} = 'snapshot' THEN 'snapshot' ELSE 'set' END"
TIME_IN_NAME = r"regexp_extract(filename, '\\.part(\\d+)\\.[a-z0-9]+$', 1)"
GREEKS = ("delta", "gamma", "vega", "theta")
SIGNED = {"size": "abs(try_cast(`size` AS double))"}
HTX_NEW = "2026-02"


def _quote(column: str) -> str:
    return f"nullif(try_cast(`{column}` AS double), -999999D)"


def _json(column: str) -> str:
    return f"from_json(`{column}`, 'array<array<string>>')"


def _binance() -> list[Series]:
    def trade(market, columns, extra, variant="", margin=None):
        return Series("binance", market, "trades", "trades", "rawTs", {**_cells("price", tradeId="id", size="qty"), **extra, **MAKER}, header=False, columns=C[columns], variant=variant, margin=margin)

    out = [
        trade("spot", "binance spot trade", _cells(baseSize="qty", quoteSize="quoteQty")),
        trade("perp", "binance linear trade", _cells(baseSize="qty", quoteSize="quoteQty"), margin="linear"),
        trade("perp", "binance inverse trade", _cells(baseSize="baseQty"), margin="inverse"),
        trade("spot", "binance spot aggregate", _cells(baseSize="qty"), "aggregated"),
        trade("perp", "binance aggregate", _cells(baseSize="qty"), "aggregated", "linear"),
        trade("perp", "binance aggregate", {}, "aggregated", "inverse"),
    ]
    for market in ("spot", "perp"):
        out.append(Series("binance", market, "klines", "klines", "rawTs", _cells("open", "high", "low", "close", "volume", "quoteVolume", "trades", "takerBuyVolume", "takerBuyQuote"), header=False, columns=C["binance kline"], variant="*"))
    for dataset in ("markPrice", "indexPrice", "premiumIndex"):
        out.append(Series("binance", "perp", dataset, dataset, "rawTs", OHLC, header=False, columns=C["binance kline"], variant="*"))
    out += [
        Series("binance", "perp", "funding", "funding", "calc_time", _cells(rate="last_funding_rate", intervalHours="funding_interval_hours"), variant="realised"),
        Series("binance", "perp", "quotes", "quotes", "transaction_time", _cells(bidPrice="best_bid_price", bidSize="best_bid_qty", askPrice="best_ask_price", askSize="best_ask_qty")),
        Series("binance", "perp", "books", "orderBookBands", "timestamp", _cells("percentage", "depth", "notional"), variant="bands,5pct"),
        Series("binance", "perp", "openInterest", "openInterest", "create_time", _cells(openInterest="sum_open_interest", openInterestValue="sum_open_interest_value", longShortRatio="count_long_short_ratio", takerLongShortVol="sum_taker_long_short_vol_ratio")),
        Series("binance", "option", "optionSummary", "optionTicker", "`date` || ' ' || lpad(`hour`, 2, '0') || ':00:00'", _cells(
            "open", "high", "low", "close", *GREEKS, option="symbol", volume="volume_contracts", quoteVolume="volume_usdt", bidPrice="best_bid_price",
            bidSize="best_bid_qty", bidIv="best_buy_iv", askPrice="best_ask_price", askSize="best_ask_qty", askIv="best_sell_iv", markPrice="mark_price", markIv="mark_iv", openInterest="openinterest_contracts", openInterestValue="openinterest_usdt"), variant="*"),
        Series("binance", "option", "volatilityIndex", "volatilityIndex", "calc_time", _cells(value="index_value"), variant="ticks"),
    ]
    for market in ("perp", "future"):
        out.append(Series("binance", market, "liquidations", "liquidations", "time", {**SIDE, **_cells("price", size="original_quantity", averagePrice="average_price", status="order_status")}, repeats=True))
    return out


def _bybit() -> list[Series]:
    def trade(market, cells, margin=None, side=SIDE, instrument=None):
        return Series("bybit", market, "trades", "trades", "timestamp", {**cells, **side}, margin=margin, instrument=instrument)

    return [
        trade("perp", _cells("price", "size", tradeId="trdMatchID", baseSize="size"), "linear"),
        trade("perp", _cells("price", "size", tradeId="trdMatchID", quoteSize="size"), "inverse"),
        trade("spot", _cells("price", tradeId="id", size="volume", baseSize="volume")),
        trade("option", _cells("price", tradeId="trade_id", size="amount"), side={"side": "lower(direction)"}, instrument="instrument_name"),
        Series("bybit", "perp", "klines", "klines", "rawTs", _cells("open", "high", "low", "close", "volume"), header=False, columns=C["bybit kline"], variant="*", utc_offset_hours=3, spill="back"),
        Series("bybit", "perp", "premiumIndex", "premiumIndex", "start_at", OHLC, variant="*"),
        Series("bybit", "spot", "indexPrice", "indexPrice", "start_at", OHLC, variant="*"),
        Series("bybit", "perp", "books", "orderBook", "ts", {**LEVEL, "action": IMAGE.format("type"), "sequence": "data.seq"}, format="ndjson",
               fields="type string, ts bigint, data struct<a: array<array<string>>, b: array<array<string>>, seq: bigint>", variant="*", rows=unfold_levels("data.a", "data.b")),
        Series("bybit", "option", "markPrice", "optionMarkPrice", "open_time", {**OHLC, **_cells("delta", "vega", "theta", option="instrument_name", gamma="gama")}, variant="*"),
    ]


def _kucoin() -> list[Series]:
    out = [
        Series("kucoin", "spot", "trades", "trades", "trade_time", {**_cells("price", "size", tradeId="trade_id", baseSize="size"), **SIDE}),
        Series("kucoin", "perp", "trades", "trades", "trade_time", {**_cells("price", "size", tradeId="trade_id"), **SIDE}),
        Series("kucoin", "spot", "klines", "klines", "time", _cells("open", "high", "low", "close", "volume", quoteVolume="turnover"), variant="*"),
        Series("kucoin", "perp", "klines", "klines", "time", _cells("open", "high", "low", "close", "volume"), variant="*"),
        Series("kucoin", "perp", "funding", "funding", "time", _cells(rate="fundingRate"), variant="realised"),
    ]
    for dataset in ("indexPrice", "markPrice"):
        out.append(Series("kucoin", "perp", dataset, dataset, "time", OHLC, variant="*"))
    for market in ("spot", "perp"):
        out.append(Series("kucoin", market, "books", "orderBookSnapshot", "_m.timestamp", {"asks": "_m.asks", "bids": "_m.bids", "sequence": "_m.sequence"}, format="lines", header=False,
                          columns=("line",), variant="*", repeats=True, rows=json_line("asks array<array<string>>, bids array<array<string>>, timestamp bigint, sequence bigint")))
    return out


def _htx() -> list[Series]:
    def old(market, dataset, table, columns, project, **more):
        return Series("htx", market, dataset, table, "rawTs", project, header=False, columns=C[columns], until=HTX_NEW, spill="back", **more)

    def new(market, dataset, table, ts, project, **more):
        return Series("htx", market, dataset, table, ts, project, since=HTX_NEW, spill="back", **more)

    contracts = {**_cells("price", tradeId="id", size="contracts", baseSize="base"), **SIDE}
    both = {**_cells("price", tradeId="id", size="contracts", baseSize="base", quoteSize="quote"), **SIDE}
    out = [old("spot", "trades", "trades", "htx spot trade", {**_cells("price", tradeId="id", size="base", baseSize="base"), **SIDE}), old("option", "trades", "trades", "htx linear trade", both),
           old("spot", "klines", "klines", "htx kline", _cells("open", "high", "low", "close", volume="amount", quoteVolume="vol"), variant="*"),
           new("spot", "trades", "trades", "ts", {**_cells("tradeId", "size", price="px", baseSize="size"), **SIDE}), new("perp", "funding", "funding", "fundingTime", _cells(rate="fundingRate"), variant="realised")]
    for market in ("perp", "future"):
        out += [old(market, "trades", "trades", "htx inverse trade", contracts, margin="inverse"), old(market, "trades", "trades", "htx linear trade", both, margin="linear"),
                new(market, "trades", "trades", "ts", {**_cells("tradeId", "size", price="px"), **SIDE})]
    for market in ("perp", "future", "option"):
        out.append(old(market, "klines", "klines", "htx kline", _cells("open", "high", "low", "close", volume="vol"), variant="*"))
    for market in ("spot", "perp", "future"):
        out.append(new(market, "klines", "klines", "ts", _cells("open", "high", "low", "close", volume="vol", quoteVolume="volCcyQuote"), variant="*"))
        out.append(Series("htx", market, "books", "orderBook", "ts", {**LEVEL, "action": IMAGE.format("action")}, format="ndjson", fields=BOOK, variant="*", spill="back", rows=unfold_levels("asks", "bids")))
    for market, dataset in (("perp", "indexPrice"), ("perp", "markPrice"), ("future", "markPrice")):
        out += [old(market, dataset, dataset, "htx reference", OHLC, variant="*"), new(market, dataset, dataset, "ts", OHLC, variant="*")]
    return out


def _gate() -> list[Series]:
    def positional(market, dataset, table, columns, project, **more):
        return Series("gate", market, dataset, table, "rawTs", project, header=False, columns=C[columns], **more)

    out = [
        positional("spot", "trades", "trades", "gate spot trade", {**_cells("price", "size", tradeId="id", baseSize="size"), "side": "CASE trim(side) WHEN '1' THEN 'buy' WHEN '2' THEN 'sell' END"}),
        positional("perp", "trades", "trades", "gate futures trade", {**_cells("price", tradeId="id"), **SIGNED, "side": "CASE WHEN try_cast(`size` AS double) < 0 THEN 'sell' ELSE 'buy' END"}),
        positional("tradfi", "klines", "klines", "gate tradfi kline", OHLC, variant="*"),
        positional("perp", "markPrice", "markPrice", "gate mark", _cells("price"), variant="ticks"),
        positional("perp", "funding", "funding", "gate funding", _cells("rate"), variant="realised"),
        positional("perp", "funding", "funding", "gate predicted funding", _cells("rate"), variant="predicted"),
        positional("spot", "books", "orderBook", "gate spot book", {**_cells("action", "price", "size", sequence="id"), "side": "CASE trim(side) WHEN '1' THEN 'ask' WHEN '2' THEN 'bid' END"}, variant="incremental,full"),
        Series("gate", "spot", "books", "orderBookSnapshot", "`current`", _cells("asks", "bids", sequence="id"), format="ndjson", fields="id bigint, current string, asks array<array<string>>, bids array<array<string>>", variant="snapshot,20"),
        Series("gate", "perp", "books", "orderBookSnapshot", "`current`", {"asks": "transform(asks, x -> array(x.p, x.s))", "bids": "transform(bids, x -> array(x.p, x.s))", "sequence": "id"}, format="ndjson",
               fields="id bigint, current string, asks array<struct<p: string, s: string>>, bids array<struct<p: string, s: string>>", variant="snapshot,20"),
        Series("gate", "spot", "indexPrice", "indexPrice", TIME_IN_NAME, _cells("price"), format="words", header=False, columns=C["gate index"], variant="ticks", instrument="name"),
        Series("gate", "option", "optionTicker", "optionTicker", TIME_IN_NAME, _cells("markPrice", "markIv", "bidPrice", "bidSize", "bidIv", "askPrice", "askSize", "askIv", *GREEKS, option="name"), format="words", header=False,
               columns=C["gate option"], variant="ticks", instrument="regexp_extract(name, '^([^-]+)-', 1)"),
    ]
    for market in ("spot", "perp"):
        out.append(positional(market, "klines", "klines", "gate kline", _cells("open", "high", "low", "close", "volume"), variant="*"))
    for market in ("perp", "future"):
        sign = "CASE WHEN try_cast(`size` AS double) < 0 THEN 'ask' WHEN try_cast(`size` AS double) > 0 THEN 'bid' END"
        out.append(positional(market, "books", "orderBook", "gate futures book", {**_cells("action", "price", sequence="id"), **SIGNED, "side": sign}, variant="incremental,full"))
    return out


def _okx() -> list[Series]:
    out = [
        Series("okx", "perp", "funding", "funding", "funding_time", _cells(rate="funding_rate"), variant="realised", spill="back", instrument="instrument_name"),
        Series("okx", "spot", "borrowing", "borrowing", "time", _cells(currency="currency_name", rate="borrow_rate"), spill="back", instrument="currency_name"),
    ]
    for market in ("spot", "perp", "future", "option"):
        spot = market == "spot"
        quote = "coalesce(try_cast(vol_quote AS double), try_cast(vol_ccy AS double))" if spot else "`vol_quote`"
        out += [
            Series("okx", market, "trades", "trades", "created_time", {**_cells("price", "size", tradeId="trade_id"), **(_cells(baseSize="size") if spot else {}), **SIDE}, spill="back", instrument="instrument_name"),
            Series("okx", market, "klines", "klines", "open_time", {**OHLC, "volume": "vol", "quoteVolume": quote}, variant="*", spill="back", repeats=True, instrument="instrument_name"),
            Series("okx", market, "books", "orderBook", "ts", {**LEVEL, "action": IMAGE.format("action"), "orderCount": "_third"}, format="ndjson", fields=BOOK, variant="*", instrument="instId", rows=unfold_levels("asks", "bids")),
        ]
    return out


def _bitget() -> list[Series]:
    out = []
    for market in ("spot", "perp", "future"):
        out += [
            Series("bitget", market, "trades", "trades", "timestamp", {**_cells("price", tradeId="trade_id", size="size(base)", baseSize="size(base)", quoteSize="volume(quote)"), **SIDE}, spill="back"),
            Series("bitget", market, "klines", "klines", "timestamp", _cells("open", "high", "low", "close", volume="basevolume", quoteVolume="usdtvolume"), format="sheet", variant="*", spill="back"),
            Series("bitget", market, "books", "orderBookSnapshot", "timestamp", {"asks": _json("asks"), "bids": _json("bids")}, format="sheet", variant="*", spill="back"),
            Series("bitget", market, "quotes", "quotes", "timestamp", {k: _quote(v) for k, v in (("bidPrice", "bid_price"), ("bidSize", "bid_volume"), ("askPrice", "ask_price"), ("askSize", "ask_volume"))}, format="sheet", spill="back"),
        ]
    return out


SERIES: list[Series] = [*_binance(), *_bybit(), *_kucoin(), *_htx(), *_gate(), *_okx(), *_bitget()]
