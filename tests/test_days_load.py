"""The load of many days as its files grow: what is evaluated for every row, and what is kept how often."""

import datetime as dt
import os

from pyspark.sql import functions as F

from candlewick.functions.numbers import load_number
from candlewick.functions.text import strip
from candlewick.plans import jobs as J
from candlewick.plans import landing as LD
from candlewick.plans import transforms as TR
from candlewick.session import scratch_path
from candlewick.sinks import merge as MG
from candlewick.sources import lines as L
from candlewick.sources.tables import MARKET_TABLES


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def file(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_the_age_of_a_file_is_no_work_of_its_rows(spark):
    """patterns searched the whole path, five times for every row."""
    rows = [("/a/trades_2024-01-02.csv", 1, "T", "2024-01-01", "1"), ("/a/2025/trades.csv", 1, "T", "2024-01-01", "2"), ("/z/trades_20240103.csv", 2, "T", "2024-01-01", "3"),
            ("/z/trades_20240103.csv", 1, "T", "2024-01-01", "4"), ("/b/trades_2024-99-99.csv", 1, "U", "2024-01-01", "5"), (None, 1, "U", "2024-01-01", "6"), ("/c/0001-01-01.csv", 1, "V", "01/01/2024", "7"), ("/b/x.csv", 1, "V", "2024-01-01", "8")]
    df = spark.createDataFrame(rows, "file_name string, line_no int, ticker string, trade_date string, last_price string")
    daily = TR.keep_daily(TR.parse_daily(df, TR.TRADE_NUMERIC, aged=True), TR.TRADE_NUMERIC, newest_file=True)
    assert "regexp_extract" not in plan_of(daily)
    assert {r.ticker: (r.last_price, r.file_name) for r in daily.collect()} == {"T": (4.0, "/z/trades_20240103.csv"), "U": (6.0, None), "V": (8.0, "/b/x.csv")}
    assert daily.columns == ["ticker", "trade_date", *TR.TRADE_NUMERIC, "file_name"]


def test_base_names_without_a_pattern(spark):
    """F1."""
    paths = ["file:/a/b.csv", "b.csv", "/a/", "", "//x", "a/b\n", "a\n/b", "s3://k/ç d/é=1.csv", None]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    out = df.select(L.base_name("path").alias("name"), F.regexp_extract("path", r"([^/]*)$", 1).alias("was"))
    assert "regexp" not in plan_of(out.select("name"))
    assert [tuple(r) for r in out.collect()] == [(w, w) for w in ("b.csv", "b.csv", "", "", "x", "b\n", "b", "é=1.csv", None)]


def test_rules_of_texts_and_numbers_stay(spark):
    """cheaper forms of the same rules."""
    texts = ["a", "!x~", "", " ", " a ", "\u007fa", "a\u007f", "é a é", "é ", " x", "~", "a\tb\n", None]
    got = [r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select(strip("t").alias("x")).collect()]
    assert got == ["a", "!x~", "", "", "a", "\u007fa", "a\u007f", "é a é", "é", "x", "~", "a\tb", None]
    numbers = {"1,5": 1.5, " 1.500 ": 1.5, "1.234,56": None, "1,234.5": None, "1,2,3": None, ",5": 0.5, "5,": 5.0, ",": None, "-3e2": -300.0, "3,e2": 300.0, "1d": None, "NaN": None, "": None, "+,5e-1": 0.05, "1 ,5": None}
    df = spark.createDataFrame([(t,) for t in numbers], "t string")
    assert [tuple(r) for r in df.select(load_number("t"), F.get(TR.numbers([F.col("t")]), 0)).collect()] == [(v, v) for v in numbers.values()]


def test_days_are_typed_and_kept_once(spark, tmp_path, monkeypatch):
    """the rows of all days were kept five times, and their numbers typed for each table."""
    root = str(tmp_path)
    reg = file(root, "reg.csv", "TckrSymb;NmOfc;ISIN;Sgmt;DtRfrn\nAAAA3;A;I;S;2024-01-01\n")
    paths = [file(root, f"in/trades_2024-06-{d}.csv", "TckrSymb;RptDt;LastPric;Preço de abertura;Preço médio;Volume financeiro;TradQty\n" + "".join(f"T{k};{x}/06/2024;{d},0000005;{k},5;1e30;0,005;{k}\n" for k in range(4) for x in (d, 10))) for d in (10, 11, 12)]
    paths.append(file(root, "in/trades_2024-06-13.csv", "<html>\n<body>gone</body>\n"))
    kept, staged, checkpoints = [], [], []
    once, stage, upsert = J.once, MG._stage, J._upsert_daily
    monkeypatch.setattr(J, "once", lambda df, name="lines": kept.append(name) or once(df, name))
    monkeypatch.setattr(MG, "_stage", lambda df: staged.append(df.columns) or stage(df))
    monkeypatch.setattr(J, "_upsert_daily", lambda s, rows, table, r, **k: checkpoints.append((table, k, plan_of(rows).count("cast("))) or upsert(s, rows, table, r, **k))
    tables = os.path.join(root, "tables")
    verdicts = {r.file_name.rsplit("/", 1)[-1]: (r.status, r.rows_loaded) for r in J.load_days(spark, paths, tables, register_paths=reg).collect()}
    assert verdicts == {"trades_2024-06-10.csv": ("ok", 0), "trades_2024-06-11.csv": ("ok", 4), "trades_2024-06-12.csv": ("ok", 8), "trades_2024-06-13.csv": ("error", 0)}
    assert kept == ["daily"] and not [c for c in staged if "trade_count" in c]
    assert checkpoints == [("fact_daily_trades", {"staged": True}, 0), ("fact_daily_quotes", {"staged": True}, 0)]
    trades, quotes = (spark.read.parquet(os.path.join(tables, t)) for t in ("fact_daily_trades", "fact_daily_quotes"))
    assert dict(trades.dtypes) == MARKET_TABLES["fact_daily_trades"] and dict(quotes.dtypes) == MARKET_TABLES["fact_daily_quotes"]
    got = {(r.ticker, r.trade_date.day): (str(r.close_price), r.avg_price, str(r.financial_volume), r.source_file_name) for r in trades.collect()}
    day = {10: 12, 11: 11, 12: 12}   # the newest file corrects the 10th
    assert got == {(f"T{k}", x): (f"{d}.000001", None, "0.01", f"trades_2024-06-{d}.csv") for k in range(4) for x, d in day.items()}
    assert {(r.ticker, r.trade_date.day): str(r.last_price) for r in quotes.collect()} == {k: v[0] for k, v in got.items()}
    again = {r.file_name.rsplit("/", 1)[-1]: r.rows_loaded for r in J.load_days(spark, paths[:1], tables, register_paths=reg).collect()}
    assert again == {"trades_2024-06-10.csv": 4} and [c for c in staged if "trade_count" in c]   # merged with what is there: staged
    assert {str(r.close_price) for r in spark.read.parquet(os.path.join(tables, "fact_daily_trades")).where("day(trade_date) = 10").collect()} == {"10.000001"}


def test_lines_of_a_bar_come_from_one_pass(spark, tmp_path):
    """the bars were sorted by ticker once for the lines and once for the corrections."""
    at = F.timestamp_add("DAY", (F.col("id") % 40).cast("int"), F.lit(dt.datetime(2000, 1, 3)).cast("timestamp_ntz"))
    spark.range(300).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(1).cast("bigint").alias("l_partkey"), (F.col("id") % 3).alias("l_suppkey"), F.lit(2.0).alias("l_quantity"),
                            (F.col("id") * 2.0 + 2).alias("l_extendedprice"), at.alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    lines = LD.raw_trade_lines(spark, str(tmp_path))
    assert plan_of(lines).count("Window [") == 1
    rows = lines.where("line_no > 0").collect()
    bars = LD.M.daily_bars(spark, str(tmp_path)).collect()
    assert len(rows) == sum(1 + (b.trade_count >= 3) for b in bars) and any(b.trade_count >= 3 for b in bars) and any(b.trade_count < 3 for b in bars)
    by_no = {r.line_no: r.line.split(";") for r in rows}
    for b in bars:
        no = (b.trade_date - dt.date(1990, 1, 1)).days * 10_000_000 + int(b.ticker[1:]) * 2
        assert by_no[no][6] == str(b.last_price).replace(".", ",") and by_no.get(no + 1, [None] * 7)[6] == (str(b.last_price + 1).replace(".", ",") if b.trade_count >= 3 else None)
    assert lines.where("line_no <= 0").groupBy("file_name").count().collect()[0]["count"] == 4


def test_a_new_table_is_written_from_the_staged_batch(spark, monkeypatch):
    """without a target there is nothing to read to the end first."""
    staged, stage = [], MG._stage
    monkeypatch.setattr(MG, "_stage", lambda df: staged.append(1) or stage(df))
    path = scratch_path(spark, "new-table")
    rows = spark.range(20).select(F.col("id").cast("string").alias("ticker"), F.lit("2024-01-01").cast("date").alias("trade_date"), F.lit(1).alias("x"))
    put = lambda b: MG.upsert_partitions(spark, b, path, ["ticker", "trade_date"], partition_col="trade_date", update=["x"], staged=True)
    assert put(rows.checkpoint()) == 20 and staged == []
    assert put(rows.where("id < 5").withColumn("x", F.lit(9)).checkpoint()) == 5 and staged == [1]
    got = spark.read.parquet(path)
    assert sorted(got.columns) == ["ticker", "trade_date", "x"] and got.count() == 20 and got.where("x = 9").count() == 5
