"""The summary that loads keep against the full recompute."""

import datetime as dt
import itertools
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from candlewick.operators import coverage as CV
from candlewick.operators import summary as SM

QUOTE = "ticker string, trade_date date, last_price double, min_price double, max_price double, variation_pct double, financial_volume double"
TRADE = "ticker string, trade_date date, open_price double, last_price double, financial_volume double, trade_count bigint"
POINT = "ticker string, quoted_at timestamp_ntz, close_price double, price_fluctuation_pct double"
ASSET = "ticker string, asset_name string, isin string, segment string"


def _day(n):
    return dt.date(2024, 1, n)


def _quotes(spark, *rows):
    return spark.createDataFrame([(t, _day(d), p, p, p, None, None) for t, d, p in rows], QUOTE)


def _trades(spark, *rows):
    return spark.createDataFrame([(t, _day(d), p, p, 2 * p, 1) for t, d, p in rows], TRADE)


def _points(spark, *rows):
    return spark.createDataFrame([(t, dt.datetime(2024, 1, d, 10), p, None) for t, d, p in rows], POINT)


@pytest.fixture()
def path():
    return os.path.join(tempfile.mkdtemp(prefix="cw-summary-"), "asset_summary")


def _sorted(df):
    return sorted(map(str, df.collect()))


def test_loads_in_any_order_equal_the_recompute(spark, path):
    quotes, trades, points = [("A", 3, 1.0), ("A", 5, 2.0), ("B", 4, 3.0)], [("A", 9, 4.0), ("C", 2, 5.0)], [("B", 1, 6.0), ("D", 8, 7.0)]
    assets = spark.createDataFrame([("A", "Alfa", "BR1", None), ("E", "Eco", "BR2", "CASH")], ASSET)
    hist = spark.createDataFrame([("A", _day(1)), ("F", _day(2))], "ticker string, trade_date date")
    SM.merge_load(spark, path, 0, {"quote": _quotes(spark, quotes[1], quotes[2]), "hist": hist}, shards=4)
    SM.merge_load(spark, path, 1, {"quote": _quotes(spark, quotes[0]), "asset": assets, "intraday": _points(spark, *points)}, shards=4)
    SM.merge_load(spark, path, 2, {"trade": _trades(spark, *trades)}, shards=4)
    whole = (assets, _quotes(spark, *quotes), _trades(spark, *trades), _points(spark, *points), hist)
    kept = spark.read.parquet(path)
    assert _sorted(SM.overview_of(kept)) == _sorted(CV.asset_overview(*whole))
    full = CV.asset_coverage(*whole)
    assert _sorted(SM.coverage_of(kept).select(*full.columns)) == _sorted(full)


@pytest.mark.parametrize("loads", list(itertools.permutations([0, 1, 2])))
def test_one_time_twice(spark, loads):
    """Daily rows: the later load wins.  Points: the first one stays."""
    rows = {n: {"quote": _quotes(spark, ("A", 3, float(n))), "intraday": _points(spark, ("A", 3, float(n)))} for n in (0, 1, 2)}
    parts = None
    for n in loads:
        more = SM.parts_of_load(n, rows[n], shards=4)
        parts = more if parts is None else parts.unionByName(more).groupBy("ticker", "shard").agg(*SM._merged())
    got = SM.overview_of(parts).first()
    assert (got.quote_last_price, got.intraday_close_price) == (2.0, 0.0)


def test_a_repeated_load_changes_nothing_and_others_shards_stay(spark, path):
    many = [(f"T{i}", 1 + i % 5, float(i)) for i in range(40)]
    SM.merge_load(spark, path, 0, {"quote": _quotes(spark, *many)}, shards=8)
    before = {f: os.path.getmtime(f) for f in spark.read.parquet(path).inputFiles() for f in [f.replace("file://", "")]}
    one = {"quote": _quotes(spark, ("T7", 20, 70.0))}
    SM.merge_load(spark, path, 1, one, shards=8)
    files = {f.replace("file://", "") for f in spark.read.parquet(path).inputFiles()}
    assert len(files - set(before)) == 1 and len(set(before) - files) == 1   # the shard of T7
    want = _sorted(SM.overview_of(spark.read.parquet(path)))
    SM.merge_load(spark, path, 1, one, shards=8)
    assert _sorted(SM.overview_of(spark.read.parquet(path))) == want
    assert SM.overview_of(spark.read.parquet(path)).where("ticker = 'T7'").first().quote_last_price == 70.0


def test_rows_without_a_ticker_and_empty_loads(spark, path):
    SM.merge_load(spark, path, 0, {"quote": _quotes(spark, ("A", 3, 1.0))}, shards=4)
    SM.merge_load(spark, path, 1, {"quote": _quotes(spark)}, shards=4)
    SM.merge_load(spark, path, 2, {"quote": _quotes(spark, (None, 4, 2.0))}, shards=4)
    assert {r.ticker: r.quotes_max for r in SM.overview_of(spark.read.parquet(path)).collect()} == {"A": _day(3), None: _day(4)}
    with pytest.raises(ValueError):
        SM.parts_of_load(3, {})
