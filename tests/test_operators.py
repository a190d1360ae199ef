"""Operators on small frames, plus idempotence of the table writers."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.operators import indicators as IND
from candlewick.operators import universe as U
from candlewick.sinks import merge as MG


def test_intraday_candles_5m(spark):
    pts = spark.createDataFrame([
        ("PETR4", dt.datetime(2024, 6, 14, 14, 1), 10.0),
        ("PETR4", dt.datetime(2024, 6, 14, 14, 3), 12.0),
        ("PETR4", dt.datetime(2024, 6, 14, 14, 7), 11.0),
        ("PETR4", dt.datetime(2024, 6, 14, 14, 8), None),
    ], "ticker string, quoted_at timestamp_ntz, close_price double")
    out = C.intraday_candles(pts, "5m").orderBy("start_time").collect()
    assert len(out) == 2
    assert (out[0].open, out[0].close, out[0].high, out[0].low, out[0].point_count) == (10.0, 12.0, 12.0, 10.0, 2)
    assert out[0].start_time == dt.datetime(2024, 6, 14, 14, 0) and out[0].end_time == dt.datetime(2024, 6, 14, 14, 5)
    assert out[1].close == 11.0
    with pytest.raises(ValueError):
        C.intraday_candles(pts, "2h")


def test_last_candles_keeps_newest(spark):
    pts = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, h), float(h)) for h in range(10)],
                                "ticker string, quoted_at timestamp_ntz, close_price double")
    out = C.last_candles(C.intraday_candles(pts, "1h"), 3).orderBy("start_time").collect()
    assert [r.close for r in out] == [7.0, 8.0, 9.0]


def _closes(spark, values):
    return spark.createDataFrame([("T", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)],
                                 "ticker string, trade_date date, close double")


def test_sma_reference_example(spark):
    out = IND.sma(_closes(spark, [1, 2, 3, 4]), 2).orderBy("trade_date").collect()
    assert [r.value for r in out] == [None, 1.5, 2.5, 3.5]


def test_ema_seed_and_recurrence(spark):
    out = IND.ema(_closes(spark, [1, 2, 3, 4, 5]), 3).orderBy("trade_date").collect()
    assert [r.value for r in out] == [None, None, 2.0, 3.0, 4.0]


def test_rsi_all_gains_is_100_and_flat_is_50(spark):
    up = IND.rsi(_closes(spark, [1, 2, 3, 4, 5]), 2).orderBy("trade_date").collect()
    assert [r.value for r in up][:2] == [None, None] and up[2].value == 100.0
    flat = IND.rsi(_closes(spark, [5, 5, 5, 5]), 2).orderBy("trade_date").collect()
    assert flat[2].value == 50.0
    with pytest.raises(ValueError):
        IND.rsi(_closes(spark, [1]), 1)


def test_indicator_dispatch_rejects_unknown(spark):
    q = spark.createDataFrame([("T", dt.date(2024, 1, 1), 1.0)], "ticker string, trade_date date, last_price double")
    with pytest.raises(ValueError):
        IND.indicator_series(q, "MACD", 5)


def test_session_window(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 4, 12, 49, 59),), (dt.datetime(2024, 1, 4, 12, 50),),
                                (dt.datetime(2024, 1, 4, 20, 10),), (dt.datetime(2024, 1, 4, 20, 10, 1),)],
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(U.within_session("ts")).collect()]
    assert got == [False, True, True, False]   # 09:50 .. 17:10 local (UTC-3)


def test_universe_strict_and_master_only(spark):
    reg = spark.createDataFrame([
        (1, " petr4 ", "Cash", "EQUITY-CASH", "Shares", "01/01/2000", ""),
        (2, "VALE3", "CASH", "EQUITY-CASH", "SHARES", "", ""),
        (3, "OLD3", "CASH", "EQUITY-CASH", "SHARES", "", "31/12/2020"),
        (4, "FUT1", "Derivatives", "EQUITY-CASH", "SHARES", "", ""),
        (5, "TOTAL GERAL", "CASH", "EQUITY-CASH", "SHARES", "", ""),
        (6, "PETR4", "CASH", "EQUITY-CASH", "SHARES", "", ""),
    ], "line_no long, ticker string, segment string, market string, category string, start_date string, end_date string")
    act = spark.createDataFrame([("petr4", "3", "10,5"), ("vale3", "0", "1"), ("itub4", "2", "-")],
                                "ticker string, trade_count string, last_price string")
    master = U.master_list(reg, "2024-06-14")
    out = {r.ticker: (r.register_order, r.status) for r in U.ticker_universe(master, U.active_list(act)).collect()}
    assert out == {"PETR4": (1, "strict"), "VALE3": (2, "master_only")}


def test_upsert_and_insert_ignore_are_idempotent(spark):
    root = tempfile.mkdtemp(prefix="cw-test-")
    path = os.path.join(root, "trades")
    b1 = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0), ("B", dt.date(2024, 1, 1), 2.0)],
                               "ticker string, trade_date date, last_price double")
    b2 = spark.createDataFrame([("A", dt.date(2024, 1, 1), None), ("C", dt.date(2024, 1, 2), 3.0)],
                               "ticker string, trade_date date, last_price double")
    for _ in range(2):
        MG.upsert_partitions(spark, b1, path, ["ticker", "trade_date"], partition_col="trade_date", update=["last_price"])
        MG.upsert_partitions(spark, b2, path, ["ticker", "trade_date"], partition_col="trade_date", update=["last_price"])
    got = {(r.ticker, str(r.trade_date)): r.last_price for r in spark.read.parquet(path).collect()}
    assert got == {("A", "2024-01-01"): None, ("B", "2024-01-01"): 2.0, ("C", "2024-01-02"): 3.0}

    ipath = os.path.join(root, "points")
    pts = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 10), dt.date(2024, 1, 1), 1.0, 1),
                                 ("A", dt.datetime(2024, 1, 1, 10), dt.date(2024, 1, 1), 9.0, 2)],
                                "ticker string, quoted_at timestamp_ntz, trade_date date, close_price double, seq int")
    n1 = MG.insert_ignore_table(spark, pts, ipath, ["ticker", "quoted_at"], partition_col="trade_date", order=["seq"])
    n2 = MG.insert_ignore_table(spark, pts, ipath, ["ticker", "quoted_at"], partition_col="trade_date", order=["seq"])
    rows = spark.read.parquet(ipath).collect()
    assert (n1, n2, len(rows), rows[0].close_price) == (1, 0, 1, 1.0)


def test_merge_preserves_columns(spark):
    t = spark.createDataFrame([("A", "old", False)], "ticker string, asset_name string, is_active boolean")
    b = spark.createDataFrame([("A", None), ("B", "new")], "ticker string, asset_name string")
    out = {r.ticker: (r.asset_name, r.is_active) for r in
           MG.merge_upsert(t, b, ["ticker"], update=["asset_name"], preserve={"is_active": F.lit(True)}).collect()}
    assert out == {"A": (None, False), "B": ("new", True)}
