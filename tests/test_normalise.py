"""Raw files of each venue, written by hand, to canonical rows."""

import gzip
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from marketloom.functions.times import month_start_us
from marketloom.plans import normalise
from marketloom.plans.series import SERIES
from marketloom.schema import TABLES

JAN = 1_704_067_200  # 2024-01-01T00:00:00Z


def put(folder, name, text):
    path = os.path.join(folder, name)
    data = text.encode() if isinstance(text, str) else text
    with (gzip.open(path, "wb") if name.endswith(".gz") else open(path, "wb")) as f:
        f.write(data)
    return path


def rows_of(spark, tmp_path, files, venue, dataset):
    listed = []
    for key, text in files.items():
        listed.append((put(str(tmp_path), key, text), key))
    frame = spark.createDataFrame(listed, "path string, key string")
    return {t: df for t, df in normalise.normalise(spark, frame, venue, dataset).items()}


def test_every_series_projects_known_columns():
    for s in SERIES:
        names = {n for n, _ in TABLES[s.table]}
        assert set(s.project) <= names, s


def test_binance_spot_trades(spark, tmp_path):
    files = {"binance|spot|trades|BTCUSDT|202401.csv": f"1,42000.5,0.1,4200.05,{JAN}123,True,True\nid,price,qty,quote,time,m,b\n2,bad,0.2,1,{JAN}123456,false,True\n"}
    out = rows_of(spark, tmp_path, files, "binance", "trades")["trades"].orderBy("ts").collect()
    assert [r.ts for r in out] == [JAN * 10**6 + 123_000, JAN * 10**6 + 123_456]
    assert out[0].side == "sell" and out[0].buyerMaker is True and out[0].baseSize == 0.1 and out[0].quoteSize == 4200.05 and out[0].margin is None
    assert out[1].price is None and out[1].side == "buy" and out[0].aggregated == "false" and out[0].month == "2024-01"


def test_margin_picks_the_series(spark, tmp_path):
    row = f"1,2,3,4,{JAN},false\n"
    files = {"binance|perp|trades|BTCUSDT|202401.csv": row, "binance|perp|trades|BTCUSD_PERP|202401.csv": row}
    out = {r.symbol: r for r in rows_of(spark, tmp_path, files, "binance", "trades")["trades"].collect()}
    assert out["BTCUSDT"].quoteSize == 4 and out["BTCUSDT"].margin == "linear"
    assert out["BTCUSD_PERP"].baseSize == 4 and out["BTCUSD_PERP"].quoteSize is None and out["BTCUSD_PERP"].margin == "inverse"


def test_wide_row_fails_and_short_row_is_padded(spark, tmp_path):
    files = {"gate|spot|trades|BTC_USDT|202401.csv": f"{JAN}.5,7,1.5,2,1\n{JAN},8,1.5\n"}
    out = rows_of(spark, tmp_path, files, "gate", "trades")["trades"].orderBy("tradeId").collect()
    assert out[0].ts == JAN * 10**6 + 500_000 and out[0].side == "buy" and out[1].size is None and out[1].side is None
    wide = {"gate|spot|trades|X_USDT|202401.csv": f"{JAN},7,1.5,2,1,9\n"}
    with pytest.raises(Exception, match="wider than declared"):
        rows_of(spark, tmp_path, wide, "gate", "trades")["trades"].collect()


def test_gate_signs_and_reversed_bars(spark, tmp_path):
    files = {"gate|perp|trades|BTC_USDT|202401.csv": f"{JAN},1,10,-3\n{JAN},2,10,4\n"}
    out = rows_of(spark, tmp_path, files, "gate", "trades")["trades"].orderBy("tradeId").collect()
    assert [(r.side, r["size"]) for r in out] == [("sell", 3.0), ("buy", 4.0)]
    files = {"gate|spot|klines,1m|BTC_USDT|202401.csv": f"{JAN},100,4,5,1,2\n"}
    bar = rows_of(spark, tmp_path, files, "gate", "klines")["klines"].first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume, bar.interval) == (2, 5, 1, 4, 100, "1m")


def test_headers_in_any_order_and_optional_columns(spark, tmp_path):
    files = {
        "okx|spot|trades|@|20240101.csv": f"instrument_name,trade_id,side,price,size,created_time\nBTC-USDT,1,BUY,2,3,{JAN}000\n",
        "okx|spot|trades|@|20240102.csv": f"source,size,created_time,price,side,trade_id,instrument_name\n0,5,{JAN}001,4,sell,2,ETH-USDT\n",
        "okx|spot|trades|@|20240103.csv": "",
    }
    out = rows_of(spark, tmp_path, files, "okx", "trades")["trades"].orderBy("tradeId").collect()
    assert [(r.symbol, r.side, r.price, r["size"], r.baseSize) for r in out] == [("BTC-USDT", "buy", 2, 3, 3), ("ETH-USDT", "sell", 4, 5, 5)]


def test_spill_is_clipped_and_repeats_are_dropped(spark, tmp_path):
    line = "BTC-USDT,1,2,0.5,1.5,10,None,7,{},1\n"
    head = "instrument_name,open,high,low,close,vol,vol_ccy,vol_quote,open_time,confirm\n"
    text = head + line.format(f"{JAN}000") * 2 + line.format(f"{JAN - 60}000")
    out = rows_of(spark, tmp_path, {"okx|spot|klines,1m|@|20240101.csv": text}, "okx", "klines")["klines"].collect()
    assert len(out) == 1 and out[0].ts == JAN * 10**6 and out[0].quoteVolume == 7


def test_bybit_zone_and_books(spark, tmp_path):
    out = rows_of(spark, tmp_path, {"bybit|perp|klines,1m|BTCUSDT|202401.csv": "2024.01.01 03:00,1,2,0.5,1.5,10\n"}, "bybit", "klines")["klines"].first()
    assert out.ts == JAN * 10**6
    lines = ('{"type":"snapshot","ts":%d000,"data":{"a":[["10","1"],["0","0"]],"b":[["9","2"]],"seq":5}}\n{"type":"delta","ts":%d001,"data":{"a":[],"b":[["9","0"]],"seq":6},"x":1}\nbroken\n' % (JAN, JAN))
    out = rows_of(spark, tmp_path, {"bybit|perp|books,incremental,500|BTCUSDT|20240101.json": lines}, "bybit", "books")["orderBook"].orderBy("ts", "side").collect()
    assert [(r.action, r.side, r.price, r["size"], r.sequence, r.kind, r.depth) for r in out] == [("snapshot", "ask", 10, 1, 5, "incremental", "500"), ("snapshot", "bid", 9, 2, 5, "incremental", "500"), ("set", "bid", 9, 0, 6, "incremental", "500")]


def test_htx_eras(spark, tmp_path):
    old, new = 1_767_225_600, 1_772_323_200  # 2026-01-01, 2026-03-01
    files = {"htx|spot|trades|BTC-USDT|202601.csv": f"1,{old}000,5,6,buy\n", "htx|spot|trades|BTC-USDT|202603.csv": f"instId,tradeId,px,side,size,ts\nBTC-USDT,2,7,sell,8,{new}000\n"}
    out = rows_of(spark, tmp_path, files, "htx", "trades")["trades"].orderBy("ts").collect()
    assert [(r.tradeId, r.price, r["size"], r.side) for r in out] == [("1", 5, 6, "buy"), ("2", 7, 8, "sell")]


def test_kucoin_lines_and_gate_words(spark, tmp_path):
    text = 'orderbook\n{"asks":[["2","1"]],"bids":[["1","3"]],"timestamp":%d000,"sequence":4}\n' % JAN
    out = rows_of(spark, tmp_path, {"kucoin|spot|books,snapshot,50|BTC-USDT|20240101.csv": text * 2}, "kucoin", "books")["orderBookSnapshot"].collect()
    assert len(out) == 1 and out[0].asks == [[2.0, 1.0]] and out[0].sequence == 4
    out = rows_of(spark, tmp_path, {f"gate|spot|indexPrice,ticks|@|202401010000.part{JAN}.txt": "  BTC_USDT   42000.5 \r\nETH_USDT\t2200\n"}, "gate", "indexPrice")["indexPrice"].orderBy("symbol").collect()
    assert [(r.symbol, r.price, r.ts) for r in out] == [("BTC_USDT", 42000.5, JAN * 10**6), ("ETH_USDT", 2200, JAN * 10**6)]


def sheet(rows):
    cells = lambda r, row: "".join(f'<c r="{chr(65 + i)}{r}" t="inlineStr"><is><t>{v}</t></is></c>' for i, v in enumerate(row))
    body = "".join(f'<row r="{k}">{cells(k, row)}</row>' for k, row in enumerate(rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def test_bitget_sheets(spark, tmp_path):
    data = sheet([["Timestamp", "ask_price", "bid_price", "ask_volume", "bid_volume"], [f"{JAN}000", "2", "-999999", "3", "1"]])
    out = rows_of(spark, tmp_path, {"bitget|perp|quotes|BTCUSDT|202401.xlsx": data}, "bitget", "quotes")["quotes"].first()
    assert (out.ts, out.askPrice, out.bidPrice, out.askSize, out.bidSize, out.margin) == (JAN * 10**6, 2, None, 3, 1, "linear")


def test_implausible_time_fails(spark, tmp_path):
    with pytest.raises(Exception, match="implausible time"):
        rows_of(spark, tmp_path, {"gate|spot|trades|A_B|202401.csv": "86400,7,1.5,2,1\n"}, "gate", "trades")["trades"].collect()


def test_ambiguous_rules_fail(spark):
    files = spark.createDataFrame([("okx", "spot", "trades", "", "A", "2024-01")], "venue string, market string, dataset string, variant string, symbol string, month string")
    twice = [s for s in SERIES if s.venue == "okx" and s.table == "trades" and s.market == "spot"] * 2
    with pytest.raises(Exception, match="two series claim"):
        normalise.assign_series(files, twice).collect()
    assert normalise.assign_series(files).first().table == "trades"


def test_clip_is_half_open(spark):
    rows = spark.range(1).select(F.explode(F.array(*[month_start_us(F.lit(m)) for m in ("2024-01", "2024-02")])).alias("ts"))
    assert normalise.clip_month(rows, "2024-01").count() == 1


def test_archives_are_opened(spark, tmp_path):
    """Zip and tar archives by line, with and without a header; a text table where a workbook may be; empty files."""
    from marketloom.plans.queries_files import pack

    def packed(key, members):
        (tmp_path / key).write_bytes(pack(key, members))
        return str(tmp_path / key), key

    files = [packed("binance|spot|trades|BTCUSDT|20240101.zip", {"a.csv": f"1,2,3,4,{JAN},true,x\n", "b.csv": f"2,2,3,4,{JAN},true,x\n\n"}), packed("binance|spot|trades|BTCUSDT|20240102.zip", {}),
             (put(str(tmp_path), "binance|spot|trades|BTCUSDT|20240103.zip", b""), "binance|spot|trades|BTCUSDT|20240103.zip")]
    out = normalise.normalise(spark, spark.createDataFrame(files, "path string, key string"), "binance", "trades")["trades"]
    assert sorted(r.tradeId for r in out.collect()) == ["1", "2"]
    wide = [packed("binance|spot|trades|ETHUSDT|20240101.zip", {"a.csv": f"1,2,3,4,{JAN},true,x,y\n"})]
    with pytest.raises(Exception, match="wider than declared"):
        normalise.normalise(spark, spark.createDataFrame(wide, "path string, key string"), "binance", "trades")["trades"].collect()
    head = "price,Size,trade_id,side,created_time,instrument_name\n"
    files = [packed("okx|spot|trades|@|20240101.tar.gz", {"a": head + f"2,3,1,buy,{JAN}000,A-B\n", "b": "instrument_name,trade_id,price,size,side,created_time\n" + f"C-D,2,5,6,SELL,{JAN}000\n"})]
    out = normalise.normalise(spark, spark.createDataFrame(files, "path string, key string"), "okx", "trades")["trades"]
    assert sorted((r.symbol, r.tradeId, r.price, r["size"], r.side) for r in out.collect()) == [("A-B", "1", 2, 3, "buy"), ("C-D", "2", 5, 6, "sell")]
    files = [packed("bitget|perp|quotes|BTCUSDT|20240101.csv", {"x": f"timestamp,bid_price\n{JAN}000,5\n"})]
    out = normalise.normalise(spark, spark.createDataFrame(files, "path string, key string"), "bitget", "quotes")["quotes"]
    assert [r.bidPrice for r in out.collect()] == [5]


def test_vault_is_pruned(spark, tmp_path):
    from marketloom.plans.queries_files import _trades
    from marketloom.sources import scans, sinks

    sinks.write_table(_trades(spark, "/root/testdata/sf0.001"), str(tmp_path), "trades")
    one = scans.read_table(spark, str(tmp_path), "trades", market="spot", month="2024-01", symbol=["U2", "U4"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(market" in plan and "In(symbol" in plan
    assert {r.symbol for r in one.collect()} == {"U2", "U4"}
