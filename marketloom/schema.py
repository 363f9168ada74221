"""The canonical tables: one schema each, and the path levels they are partitioned by."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Column names and types of the canonical tables, in order, after ts.
_OHLC = "open double, high double, low double, close double"
_COLUMNS = {
    "trades": "tradeId string, price double, size double, baseSize double, quoteSize double, side string, buyerMaker boolean, margin string",
    "klines": f"{_OHLC}, volume double, quoteVolume double, trades bigint, takerBuyVolume double, takerBuyQuote double, margin string",
    "quotes": "bidPrice double, bidSize double, askPrice double, askSize double, margin string",
    "orderBook": "action string, side string, price double, size double, orderCount bigint, sequence bigint, margin string",
    "orderBookSnapshot": "asks array<array<double>>, bids array<array<double>>, sequence bigint, margin string",
    "orderBookBands": "percentage double, depth double, notional double, margin string",
    "markPrice": f"price double, {_OHLC}",
    "indexPrice": f"price double, {_OHLC}",
    "premiumIndex": _OHLC,
    "volatilityIndex": "value double",
    "optionMarkPrice": f"option string, {_OHLC}, delta double, gamma double, vega double, theta double",
    "optionTicker": f"option string, {_OHLC}, volume double, quoteVolume double, bidPrice double, bidSize double, bidIv double, "
    "askPrice double, askSize double, askIv double, markPrice double, markIv double, delta double, gamma double, vega double, "
    "theta double, openInterest double, openInterestValue double",
    "funding": "rate double, intervalHours bigint",
    "borrowing": "currency string, rate double",
    "openInterest": "openInterest double, openInterestValue double, longShortRatio double, takerLongShortVol double, margin string",
    "liquidations": "side string, price double, size double, averagePrice double, status string, margin string",
    "settlement": "price double",
}

TABLES: dict[str, list[tuple[str, str]]] = {
    name: [("ts", "bigint"), *[tuple(c.strip().split(" ", 1)) for c in text.split(", ")]] for name, text in _COLUMNS.items()}

#: Path levels beyond venue, market and dataset; a table has the same ones at every venue. The depth level of orderBookBands is called band, as the table has
#: a depth of its own, and a reader cannot tell a level from a column of its name.
LEVELS = {"klines": ["interval"], "markPrice": ["interval"], "indexPrice": ["interval"], "premiumIndex": ["interval"], "optionMarkPrice": ["interval"],
          "optionTicker": ["interval"], "funding": ["kind"], "orderBook": ["kind", "depth"], "orderBookSnapshot": ["kind", "depth"],
          "orderBookBands": ["kind", "band"], "trades": ["aggregated"]}
ORDER_BOOKS = ("orderBook", "orderBookSnapshot", "orderBookBands")


# How types are named where a table's fields are written down.
_WRITTEN = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "array<array<double>>": "DOUBLE[][]"}


def fields_json(table: str) -> str:
    """A table's fields as revisions hash them: compact JSON, name and type in their order."""
    return json.dumps([{"name": name, "type": _WRITTEN[kind]} for name, kind in TABLES[table]], separators=(",", ":"))


def levels_of(table: str) -> list[str]:
    return ["venue", "market", *LEVELS.get(table, []), "month"]


def dataset_of(table: str) -> str:
    """The dataset level of a table's path: the three order-book tables share one."""
    return "orderBook" if table in ORDER_BOOKS else table


def struct_of(table: str) -> T.StructType:
    """symbol, then the table's columns."""
    text = ", ".join(f"`{n}` {t}" for n, t in [("symbol", "string"), *TABLES[table]])
    return T.StructType.fromDDL(text)


def order_of(table: str) -> list[str]:
    """Rows of a file are by symbol and time, and by sequence where the table has one."""
    return ["symbol", "ts", *(["sequence"] if any(n == "sequence" for n, _ in TABLES[table]) else [])]
