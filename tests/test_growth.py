"""Work and memory of the load path as its tables grow: what is read, sorted and written once, and in how many files."""

import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from candlewick.operators import quality as Q
from candlewick.plans import q_analytics as QA
from candlewick.plans import q_files as QF
from candlewick.plans import transforms as TR
from candlewick.session import scratch_path
from candlewick.sinks import merge as MG
from candlewick.sources import lines as L


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_files_of_a_partition_value_follow_its_own_rows(spark, monkeypatch, request):
    """many days with few rows each make one file a day, a hot day several."""
    monkeypatch.setattr(MG, "ROWS_PER_FILE", 50)
    day = F.when(F.col("id") < 400, F.date_add(F.lit("2024-01-01"), (F.col("id") % 20).cast("int"))).otherwise(F.lit("2023-01-01").cast("date"))
    rows = spark.range(600).select(F.col("id").cast("string").alias("ticker"), day.alias("trade_date"), F.lit(1).alias("x"))
    path = scratch_path(spark, "spread")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # as if they were large
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    assert MG.upsert_partitions(spark, rows, path, ["ticker", "trade_date"], partition_col="trade_date", update=["x"]) == 600
    files = {d: len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{path}/trade_date=*")}
    hot = files.pop(f"{path}/trade_date=2023-01-01")
    assert set(files.values()) == {1} and len(files) == 20 and 2 <= hot <= 4
    assert spark.read.parquet(path).count() == 600


@pytest.mark.parametrize("n", [3, 10, 100])
def test_first_lines_without_sorting_the_files(spark, n):
    """Numbers with gaps, repeats and nulls, a short file and one without a name."""
    rows = [("a", (i * 7919) % 5000 - 40, f"a{i}") for i in range(3000)] + [("b", i, f"b{i}") for i in range(2)] + [("c", None, "none"), ("c", 5, "five"), (None, 1, "nameless")]
    rows += [("d", 7 + i // 4, f"d{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "file_name string, line_no bigint, line string").repartition(5)
    first = L.first_lines(df, n)
    assert "_bound" in plan_of(first)   # only lines up to a bound are ranked
    got = {}
    for r in first.collect():
        got.setdefault(r.file_name, []).append(r.line_no)
    want = {}
    for f, k, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        want.setdefault(f, []).append(k)
    order = lambda xs: sorted(xs, key=lambda k: (k is not None, k or 0))
    assert {f: order(x) for f, x in got.items()} == {f: x[:n] for f, x in want.items()}


def test_rules_of_numbers_are_spelled_out_once(spark):
    """one generated method holds no rule for every column."""
    names = [f"c{i}" for i in range(8)]
    texts = [" 1,5", "1.234,56", " 2\t", "", None, "abc", "1d", "-3e2"]
    df = spark.createDataFrame([tuple([t] * 8) for t in texts], ", ".join(f"{c} string" for c in names))
    out = df.select(TR.numbers([F.col(c) for c in names]).alias("x"))
    assert plan_of(out).count("RLIKE") == 1
    assert [r.x for r in out.collect()] == [[v] * 8 for v in (1.5, None, 2.0, None, None, None, None, -300.0)]
    daily = df.toDF("ticker", "trade_date", "open_price", "last_price", "min_price", "max_price", "avg_price", "trade_count").select("*", F.lit("f").alias("file_name"), F.lit(1).alias("line_no"))
    assert plan_of(TR.parse_daily(daily, TR.TRADE_NUMERIC)).count("[eE]") <= 2
    assert [r.open_price for r in TR.parse_daily(daily, TR.TRADE_NUMERIC).collect()] == [1.5, None, 2.0, None, None, None, None, -300.0]


def test_first_rows_hold_their_order_once(spark):
    """F3, F5, F14."""
    df = spark.createDataFrame([("k", "f2", 1, "x"), ("k", "f1", 9, "y"), ("k", "f1", 3, "z"), ("j", None, None, "n")], "k string, file_name string, line_no int, v string")
    out = TR.keep_first(df, ["k"])
    assert plan_of(out).count("struct(") == 1
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == [("j", None, None, "n"), ("k", "f1", 3, "z")]


def test_locale_profile_reads_its_rows_once(spark):
    """raw texts are parsed in one pass, counts and samples follow from it."""
    rows = [("f", "1,5", "a"), ("f", "x", "a"), ("f", "x", "b"), ("f", "w", "c"), ("f", "v", "d"), ("f", "-", None), ("g", None, "1")]
    out = Q.locale_profile(spark.createDataFrame(rows, "file_name string, p string, q string"), ["p", "q"])
    assert "RLIKE" not in plan_of(out)
    assert sorted(tuple(r) for r in out.collect()) == [
        ("f", "p", 5, 1, 4, ["v", "w", "x"]), ("f", "q", 5, 0, 5, ["a", "b", "c"]), ("g", "p", 0, 0, 0, []), ("g", "q", 1, 1, 0, [])]


@pytest.mark.parametrize("query", ["undated_files_load", "dialect_files_load"])
def test_more_rows_make_more_files(spark, tmp_path, monkeypatch, query):
    """the rows of the landed files stay the same, however many files there are."""
    spark.range(400).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(1).cast("bigint").alias("l_partkey"), (F.col("id") % 40).alias("l_suppkey"), F.lit(2.0).alias("l_quantity"),
        (F.col("id") * 2.0 + 2).alias("l_extendedprice"), F.lit(dt.datetime(2000, 1, 3)).cast("timestamp_ntz").alias("day"), F.col("id")).select(
        "*", F.expr("timestampadd(DAY, cast(id % 90 as int), day)").alias("l_shipdate")).drop("id", "day").write.parquet(f"{tmp_path}/lineitem.parquet")
    landed, land = [], QF._land
    monkeypatch.setattr(QF, "_land", lambda *a: landed.append(land(*a)) or landed[-1])
    run = lambda: sorted(map(tuple, getattr(QF, query)(spark, str(tmp_path)).collect()))
    few = run()
    monkeypatch.setattr(QF, "LINES_PER_FILE", 10)
    assert few and run() == few
    assert len(glob.glob(f"{landed[0]}/file_name=*")) <= 4 < 16 < len(glob.glob(f"{landed[1]}/file_name=*"))


def test_loads_of_the_summary_read_tables_made_once(spark, monkeypatch):
    """F13, F16."""
    day = F.lit("2024-01-03").cast("date")
    t = spark.range(6).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("ticker"), day.alias("trade_date"))
    priced = t.select("*", *[F.lit(1.0).alias(c) for c in ("open_price", "last_price", "min_price", "max_price", "avg_price", "variation_pct", "financial_volume")], F.lit(1).cast("bigint").alias("trade_count"), F.lit("x").alias("source_file_name"))
    points = t.select("*", F.lit("2024-01-03 10:00:00").cast("timestamp_ntz").alias("quoted_at"), F.lit(2.0).alias("close_price"), F.lit(0.0).alias("price_fluctuation_pct"), F.lit("p").alias("source_jsonl"))
    made = []

    def counted(name, df):
        return lambda *_: made.append(name) or df

    for name, df in (("settled_quotes", priced), ("daily_bars", priced), ("intraday_points", points)):
        monkeypatch.setattr(QA.M, name, counted(name, df))
    monkeypatch.setattr(QA, "hist_dates", counted("hist", t))
    monkeypatch.setattr(QA.M, "dim_assets", lambda *_: t.select("ticker", *[F.lit("a").alias(c) for c in ("asset_name", "isin", "segment")]))
    for query in (QA.coverage_kept, QA.overview_kept):
        assert query(spark, "nowhere").count() == 6
    assert sorted(made) == ["daily_bars", "hist", "intraday_points", "settled_quotes"]


def test_quoted_lines_are_split_as_by_the_pattern(spark):
    """pieces between quotes give the fields of the look-ahead pattern, also for an odd number of quotes."""
    texts = ['"a;b";c;"d ""e"" ;f"', '";"', 'a"b;c', ';"x";', '"open;b', 'a;"b";c"d;e', '""', '"a\u0001;b";c', ' "q" ; r;""""', 'é"ç;ñ";;']
    for sep in (";", ",", "\t", "|", "::"):
        df = spark.createDataFrame([(t.replace(";", sep), sep) for t in texts], "line string, sep string")
        row = df.select("line", L.split_fields(F.col("line"), F.col("sep")).alias("fields"))
        assert "?=" in plan_of(row) and "\u0001" in plan_of(row)
        for line, fields in row.collect():
            parts = re.split(re.escape(sep) + r'(?=(?:[^"]*"[^"]*")*[^"]*$)', line)
            want = [x.strip(" ")[1:-1].replace('""', '"') if re.fullmatch(r'".*"', x.strip(" ")) and len(x.strip(" ")) > 1 else x for x in parts]
            assert fields == want, line
