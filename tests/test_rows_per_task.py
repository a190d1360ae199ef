"""Tasks and files in proportion to the rows; payload bodies of every shape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.operators import market as MK
from candlewick.operators import page_index as PX
from candlewick.operators import pages as PG
from candlewick.plans import market_tables as M
from candlewick.session import scratch_path
from candlewick.sources import payloads as PL


@pytest.fixture(scope="module")
def tables(spark):
    path = scratch_path(spark, "tables")
    i = F.col("id")
    at = F.timestamp_add("DAY", (i % 7).cast("int"), F.lit("1997-01-01").cast("timestamp_ntz"))
    spark.range(3_000).select(
        i.alias("l_orderkey"), (i % 11).alias("l_partkey"), F.when(i % 50 != 0, i % 23).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        (i % 5 + 1).cast("double").alias("l_quantity"), ((i * 37) % 101 + 1).cast("double").alias("l_extendedprice"),
        at.alias("l_shipdate")).write.parquet(path + "/lineitem.parquet")
    spark.range(2_000).select(i.alias("o_orderkey"), (i % 29).alias("o_custkey"), ((i * 31) % 97 + 1).cast("double").alias("o_totalprice"),
                              at.alias("o_orderdate")).write.parquet(path + "/orders.parquet")
    return path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_market_rows_are_sorted_in_tasks_of_bounded_size(spark, tables, monkeypatch):
    bars, quotes = rows(M.daily_bars(spark, tables)), rows(M.settled_quotes(spark, tables))
    want = rows(MK.market_overview(M.settled_quotes(spark, tables), M.daily_bars(spark, tables)))
    monkeypatch.setattr(M, "ROWS_PER_TASK", 50)
    got = M.daily_bars(spark, tables, by_rows=True)
    assert got.rdd.getNumPartitions() == 60 and rows(got) == bars
    assert M.settled_quotes(spark, tables).rdd.getNumPartitions() == 40 and rows(M.settled_quotes(spark, tables)) == quotes
    assert rows(MK.market_overview(M.settled_quotes(spark, tables), got)) == want


def test_an_index_of_many_ranges_is_few_files(spark, monkeypatch):
    monkeypatch.setattr(PX, "SHORT_RANGES", 3)
    table, order = spark.range(2_500).select(((F.col("id") * 7919) % 2_500).alias("key")), [F.col("key").desc()]
    path = scratch_path(spark, "index")
    PX.write_index(table, order, path, rows_per_range=100, fan_out=2)
    assert len(spark.read.parquet(path + "/rows").inputFiles()) == 3
    for limit, offset in ((10, 0), (60, 790), (900, 800), (10, 2_495), (5, 9_999)):
        assert [r.key for r in PX.indexed_page(spark, path, limit, offset).collect()] == [r.key for r in PG.page(table, order, limit, offset).collect()]


BODIES = {
    '{"codNeg":" abc ","tradeDate":"02/01/2024","lastPrice":"1 2,5","minPrice":"N/A","maxPrice":"-","avgPrice":"1e1","oscillationVal":""}': ("flat", "ABC", 12.5, 10.0),
    '{"results":[{"codNeg":"","ticker":"x","lastPrice":3}]}': ("flat", "X", 3.0, None),
    '{"r\\u0065sults":[{"ticker":"y","lastPrice":4}]}': ("flat", "Y", 4.0, None),
    '{"results":[],"ticker":"z"}': ("flat", "Z", None, None),
    '{"\\u0054radgFlr":{"date":"2024-01-02","scty":{"lstQtn":[{"closPric":1},{"closPric":"2,5"}]}}}': ("nested", "T", 2.5, None),
    '{"BizSts":{"cd":"OK"},"ticker":"no"}': ("nested", "T", None, None),
    '{"TradgFlr":null,"BizSts":null}': (None, "T", None, None),
    '{"note":"TradgFlr results"}': (None, "T", None, None),
    "{broken": (None, "T", None, None),
    "": (None, "T", None, None),
}


def test_bodies_of_every_shape(spark):
    day = dt.date(2024, 1, 2)
    landed = spark.createDataFrame([(" t ", b, 200, day) for b in [*BODIES, None]], "requested_ticker string, body string, http_status int, load_date date")
    got = PL.daily_fluctuation(landed.withColumn("n", F.lit(1))).collect()
    value = lambda v: None if v is None else float(v)
    assert [(r.payload_format, r.ticker, value(r.last_price), value(r.avg_price)) for r in got] == [*BODIES.values(), (None, "T", None, None)]
    assert all((r.trade_date == day) == (r.payload_format is not None) and (r.error is None) == (r.payload_format is not None) for r in got)


def test_a_payload_is_parsed_once(spark):
    landed = spark.createDataFrame([("t", "{}", 200, None)], "requested_ticker string, body string, http_status int, load_date date")
    plan = PL.daily_fluctuation(landed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 3   # nested, wrapped and plain
