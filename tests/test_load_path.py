"""Loads from real files: lossless for any folder, encoding, quoting and naming; merges prune and publish whole versions."""

import datetime as dt
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from candlewick.plans import jobs as J
from candlewick.sinks import merge as MG
from candlewick.sources import lines as L
from candlewick.sources import manifest as MF


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="cw-load-")


def _file(root, name, text, encoding="utf-8"):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


REGISTER = "TckrSymb;NmOfc;ISIN;Sgmt\nAAAA3;Alfa;BRAAAAACNOR0;CASH\nBBBB4;Beta;BRBBBBACNPR1;CASH\n"


def test_files_without_a_date_column_take_the_load_date(spark, root):
    reg = _file(root, "reg.csv", REGISTER)
    t = _file(root, "trades.csv", "TckrSymb;LastPric;TradQty\nAAAA3;10,5;3\n")
    named = _file(root, "trades_2024-05-06.csv", "TckrSymb;LastPric;TradQty\nBBBB4;7,25;1\n")
    tables = os.path.join(root, "tables")
    assert J.load_daily_quotes(spark, [t, named], tables, target_date=dt.date(2024, 6, 14)) == 2
    assert J.load_daily_quotes(spark, [named], os.path.join(root, "by-name")) == 1
    got = spark.read.parquet(os.path.join(root, "by-name", "fact_daily_quotes")).first()
    assert got.trade_date == dt.date(2024, 5, 6) and got.last_price == 7.25
    J.load_register_and_trades(spark, reg, [t], tables, target_date="2024-06-14")
    row = spark.read.parquet(os.path.join(tables, "fact_daily_trades")).first()
    assert (row.ticker, row.close_price, row.trade_date) == ("AAAA3", 10.5, dt.date(2024, 6, 14))


def test_same_named_files_keep_their_own_layout(spark, root):
    a = _file(root, "a/neg.csv", "TckrSymb;RptDt;LastPric\nAAAA3;14/06/2024;1,5\n")
    b = _file(root, "b/neg.csv", "report\nLastPric,RptDt,TckrSymb\n2.5,2024-06-13,BBBB4\n")
    got = {r.ticker: (r.trade_date, r.last_price) for r in J.TR.transform_trades(J.read_trades(spark, [a, b])).collect()}
    assert got == {"AAAA3": (dt.date(2024, 6, 14), 1.5), "BBBB4": (dt.date(2024, 6, 13), 2.5)}


def test_latin1_quotes_and_zip(spark, root):
    text = 'TckrSymb;NmOfc;ISIN;Sgmt\nAAAA3;"Cia Pão; de ""Açúcar""";BR1;CASH\n\tBBBB4 ;Órion;BR2;CASH\n'
    a = _file(root, "latin.csv", text, "latin-1")
    with zipfile.ZipFile(os.path.join(root, "u.zip"), "w") as z:
        z.writestr("inner.csv", text.replace("AAAA3", "CCCC3").replace("BBBB4", "DDDD4"))
    rows = {r.ticker: r.asset_name for r in J.TR.transform_instruments(J.read_register(spark, [a, os.path.join(root, "u.zip")])).collect()}
    assert rows == {"AAAA3": 'Cia Pão; de "Açúcar"', "CCCC3": 'Cia Pão; de "Açúcar"', "BBBB4": "Órion", "DDDD4": "Órion"}


def test_unusable_headers_are_errors(spark, root):
    bad = _file(root, "x.csv", "a;b;c;d\n1;2;3;4\n")
    narrow = _file(root, "y.csv", "TckrSymb;NmOfc\nAAAA3;Alfa\n")
    for path in (bad, narrow):
        with pytest.raises(ValueError, match=os.path.basename(path)):
            J.read_register(spark, path)


def test_undated_historical_file_is_loaded_last(spark, root):
    def record(price):
        return ("01" + "20240614" + "02" + "PETR4".ljust(12) + "010" + "PETRO".ljust(12) + "PN".ljust(10) + "   " + "R$  " + price * 7
                + "00010" + "0" * 14 + "1000" + "0" * 18 + "0" * 13 + " " + "00000000" + "0000001" + "0" * 13 + "BRPETRACNPR6" + "100")

    first = _file(root, "COTAHIST_A2024.TXT", record("0000000001000") + "\n", "latin-1")
    extra = _file(root, "extra.txt", record("0000000002000") + "\n", "latin-1")
    tables = os.path.join(root, "tables")
    assert J.load_historical(spark, [extra, first], tables) == 2
    rows = spark.read.parquet(os.path.join(tables, "fact_cotahist_daily")).collect()
    assert len(rows) == 1 and float(rows[0].last_price) == 20.0 and rows[0].year == 2024


def test_line_order_survives_any_block_and_task(spark, root):
    path = _file(root, "long.txt", "".join(f"{i}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = [int(r.line) for r in L.scan(spark, path).orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(range(3000))


def test_upsert_reads_only_touched_partitions(spark, root):
    path = os.path.join(root, "t")
    df = spark.range(100).select((F.col("id") % 10).cast("string").alias("ticker"), F.expr("date_add(date'2024-01-01', cast(id / 10 as int))").alias("trade_date"), F.col("id").cast("double").alias("x"))
    assert MG.upsert_partitions(spark, df, path, ["ticker", "trade_date"], partition_col="trade_date", update=["x"]) == 100
    batch = df.where("trade_date = date'2024-01-03'").withColumn("x", F.lit(-1.0))
    touched = MG._touched(spark.read.parquet(path), batch, "trade_date")
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-03" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert MG.upsert_partitions(spark, batch, path, ["ticker", "trade_date"], partition_col="trade_date", update=["x"]) == 10
    got = spark.read.parquet(path)
    assert got.count() == 100 and got.where("x = -1").count() == 10
    assert MG.insert_ignore_table(spark, df.withColumn("ticker", F.concat("ticker", F.when(F.col("x") > 94, "n").otherwise(""))), path, ["ticker", "trade_date"], partition_col="trade_date") == 5


def test_register_survives_an_interrupted_publish(spark, root):
    path = os.path.join(root, "dim")
    one = spark.createDataFrame([("A", "x", 1)], "ticker string, name string, created int")
    MG.upsert_unpartitioned(spark, one, path, ["ticker"], update=["name"], preserve={"created": F.lit(1)})
    os.rename(path, path + ".previous")  # stopped between the two renames
    two = spark.createDataFrame([("A", "y"), ("B", "z")], "ticker string, name string")
    MG.upsert_unpartitioned(spark, two, path, ["ticker"], update=["name"], preserve={"created": F.lit(2)})
    assert sorted(map(tuple, MG.read_published(spark, path).select("ticker", "name", "created").collect())) == [("A", "y", 1), ("B", "z", 2)]


def test_failed_trades_leave_the_register_alone(spark, root):
    reg = _file(root, "reg.csv", REGISTER)
    bad = _file(root, "bad.csv", "nothing here\n1;2\n")
    tables = os.path.join(root, "tables")
    with pytest.raises(ValueError):
        J.load_register_and_trades(spark, reg, [bad], tables, target_date="2024-06-14")
    assert not os.path.exists(os.path.join(tables, "dim_assets"))
    assert J.load_register_and_trades(spark, reg, [], tables) == 2


def test_backfill_reports_every_day(spark, root):
    reg = _file(root, "reg.csv", REGISTER)
    _file(root, "in/trades_2024-06-13.csv", "TckrSymb;LastPric;TradQty\nAAAA3;10,5;3\n")
    _file(root, "in/trades_2024-06-14.csv", "x\n")
    tables = os.path.join(root, "tables")
    got = [(str(r.day), r.status) for r in J.backfill(spark, os.path.join(root, "in"), tables, "2024-06-12", "2024-06-14", register_paths=reg).orderBy("day").collect()]
    assert got == [("2024-06-12", "skipped"), ("2024-06-13", "ok"), ("2024-06-14", "error")]
    assert spark.read.parquet(os.path.join(tables, "fact_daily_trades")).count() == 1


def test_manifest_rules(spark, root):
    for name in ("reg_20240613.csv", "reg_2024-06-12.csv", "neg_20240613.csv", "neg_20240601.csv", "snap_20240613T100000.csv", "snap_20240613T180000.csv"):
        _file(root, name, "x\n")
    files = MF.manifest(spark, root).select("path", "name")
    assert MF.resolve_snapshot(files.where("name like 'reg%'"), "2024-06-14").first().name == "reg_20240613.csv"
    assert MF.latest_by_timestamp(files).first().name == "snap_20240613T180000.csv"
    pairs = {r.register_path.rsplit("/", 1)[-1]: r.trades_path.rsplit("/", 1)[-1] for r in MF.pair_siblings(files.where("name like 'reg%'"), files.where("name like 'neg%'")).collect()}
    assert pairs == {"reg_20240613.csv": "neg_20240613.csv", "reg_2024-06-12.csv": "neg_20240613.csv"}
    assert MF.resolve_by_patterns(files, "neg", "2024-06-01").first().name == "neg_20240601.csv"


def test_dated_folder_and_missing_snapshot(spark, root):
    _file(root, "2024-06-13/cadastro_normalizado.csv", "x\n")
    files = MF.manifest(spark, root).select("path", "name")
    assert MF.resolve_snapshot(files, "2024-06-14").first().name == "cadastro_normalizado.csv"
    with pytest.raises(FileNotFoundError):
        MF.resolve_snapshot(files, "2024-07-14")


def test_payload_batch_is_a_landing_run(spark, root):
    from candlewick.sinks import ledger as LG

    body = '{"BizSts":{"cd":"CLOSED"},"TradgFlr":{"date":"2024-06-14","scty":{"symb":"abcd3","lstQtn":[]}}}'
    landed = spark.createDataFrame([("WXYZ4F", body, 200, None), ("ABCD3", "oops", 200, None)], "requested_ticker string, body string, http_status int, load_date date")
    out = {r.request_succeeded: r.n for r in J.run_payload_batch(spark, landed, root).collect()}
    assert out == {True: 1, False: 1}
    line = spark.read.text(os.path.join(root, "jsonl")).first().value
    assert '"ticker_requested":"WXYZ4F"' in line and '"business_status_code":"CLOSED"' in line and '"points_count":0' in line
    run = LG.landing_runs(spark.read.parquet(os.path.join(root, "_runs"))).first()
    assert (run.status, run.retry_count) == ("SUCCESS", 0) and run.duration_ms >= 0


def test_tables_have_declared_types(spark, root):
    from candlewick.sources.tables import MARKET_TABLES, read_market_table

    t = _file(root, "t.csv", "TckrSymb;RptDt;LastPric;TradQty;NtlFinVol\nAAAA3;14/06/2024;10,1234565;3;5,005\n")
    J.load_daily_quotes(spark, [t], root)
    df = read_market_table(spark, root, "fact_daily_quotes")
    assert dict(df.dtypes) == MARKET_TABLES["fact_daily_quotes"]
    row = df.first()
    assert str(row.last_price) == "10.123457" and row.trade_count == 3


@pytest.mark.parametrize(("first", "then"), [(1, 6), (6, 1), (2, 3), (12, 2)])
def test_no_line_is_lost_when_files_are_packed_anew(spark, root, first, then):
    """Headers and data are told apart whatever the cores are when each is read."""
    paths = []
    for f in range(6):
        rows = [f"T{f:02d}{k:04d};2020-01-{1 + k % 28:02d};1,5;10" for k in range(200)]
        paths.append(_file(root, f"packed/t{f}.csv", "\n".join(["preamble", "", "TckrSymb;RptDt;LastPric;TradQty", *rows])))
    key = "spark.sql.files.minPartitionNum"
    try:
        spark.conf.set(key, first)
        out = J.read_trades(spark, paths)
        spark.conf.set(key, then)
        assert out.count() == 1200 and out.where("ticker = 'TckrSymb'").count() == 0
        assert out.select("ticker").distinct().count() == 1200
    finally:
        spark.conf.unset(key)


def test_first_lines_of_files_in_several_blocks(spark, root):
    path = _file(root, "blocks/long.txt", "\n".join(str(k) for k in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "17")  # a few lines a block
        kept = L.once(L.scan(spark, path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(int(r.line) for r in L.first_lines(kept, 10).collect()) == list(range(10))


def _header(spark, root, text, key="trades"):
    from candlewick.sources import delimited as D

    path = _file(root, f"h{len(os.listdir(root))}/x.csv", text)
    headers, data = D.normalize_lines(L.once(L.scan(spark, path)), key)
    return headers.first(), [r.fields for r in data.orderBy("line_no").collect()]


def test_dialects(spark, root):
    for sep in ";,\t|":
        rows = "\n".join(sep.join((f"T{k}", "2020-01-01", f'"1{"," if sep != "," else "."}5"', f'"a;b,c|{k}"')) for k in range(8))
        h, data = _header(spark, root, f"report of the day, all markets\n\n{sep.join(('TckrSymb', 'RptDt', 'LastPric', 'Note'))}\n{rows}\n")
        assert h.sep == sep and h.header == ["TckrSymb", "RptDt", "LastPric", "Note"] and h.token_detected
        assert len(data) == 8 and all(len(f) == 4 for f in data) and data[3][3] == "a;b,c|3"
    # Decimal commas are as regular as the tabs, but fewer lines have them.
    h, _ = _header(spark, root, "TckrSymb\tRptDt\tLastPric\nA\t2020-01-01\t1,5\nB\t2020-01-01\t2,5\n")
    assert h.sep == "\t"


def test_generic_header_and_data_likeness(spark, root):
    from candlewick.sources import delimited as D

    h, data = _header(spark, root, "1;2\n3;4\nname;5\n6;7\n", None)
    assert h.header == ["name", "5"] and data == [["6", "7"]] and not h.token_detected
    h, _ = _header(spark, root, "1;2\n3;4\n5;6\n7;8\n", None)
    assert h.header == ["5", "6"]
    h, _ = _header(spark, root, "1;2\n3;4\n", None)
    assert h.header == ["1", "2"]
    cases = [(["A1B2", "1.5", "x", ""], True), (["A1B2", "", "", "x"], False), (["-1", "5%", "a"], False), (["BRAAAAACNOR0", "b"], True), (["TICKER", "lower", "word"], False)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "f array<string>").select(D.looks_like_data(F.col("f")).alias("d"))
    assert [r.d for r in df.collect()] == [w for _, w in cases]


def test_days_are_one_load_with_a_verdict_for_each_file(spark, root):
    from candlewick.sinks import ledger as LG

    reg = _file(root, "reg.csv", REGISTER)
    head = "TckrSymb;RptDt;LastPric;TradQty\n"
    _file(root, "in/trades_2024-06-10.csv", head + "AAAA3;2024-06-10;1,5;3\n;2024-06-10;1;1\nBBBB4;x;1;1\n")
    _file(root, "in/trades_2024-06-11.csv", "TckrSymb;LastPric;TradQty\nAAAA3;2,5;3\n")      # takes the day of its name
    _file(root, "in/trades_2024-06-12.csv", head + "AAAA3;10/06/2024;9,5;4\nAAAA3;12/06/2024;3,5;4\n")  # corrects the 10th
    _file(root, "in/trades_2024-06-13.csv", "<html>\n<body>gone</body>\n")
    _file(root, "in/trades_2024-06-14.csv", "")
    _file(root, "in/trades_2024-06-15.zip", "no archive at all " * 10)
    with zipfile.ZipFile(os.path.join(root, "in", "trades_2024-06-16.zip"), "w") as z:
        z.writestr("t.csv", head + "BBBB4;16/06/2024;7;1\n")
    _file(root, "in/trades_2024-06-17.csv", "RptDt;LastPric;TradQty;Preço médio\n17/06/2024;7;1;1\n")
    tables = os.path.join(root, "tables")
    got = {str(r.day): (r.status, r.message) for r in J.backfill(spark, os.path.join(root, "in"), tables, "2024-06-09", "2024-06-17", register_paths=reg).collect()}
    assert {d: s for d, (s, _) in got.items()} == {
        "2024-06-09": "skipped", "2024-06-10": "ok", "2024-06-11": "ok", "2024-06-12": "ok", "2024-06-13": "error", "2024-06-14": "skipped",
        "2024-06-15": "error", "2024-06-16": "ok", "2024-06-17": "error"}
    assert "BadZipFile" in got["2024-06-15"][1] and got["2024-06-17"][1] == "no column for ticker"
    rows = {(r.ticker, str(r.trade_date)): float(r.close_price) for r in spark.read.parquet(os.path.join(tables, "fact_daily_trades")).collect()}
    assert rows == {("AAAA3", "2024-06-10"): 9.5, ("AAAA3", "2024-06-11"): 2.5, ("AAAA3", "2024-06-12"): 3.5, ("BBBB4", "2024-06-16"): 7.0}
    assert spark.read.parquet(os.path.join(tables, "fact_daily_quotes")).count() == 4
    runs = LG.current_runs(spark.read.parquet(os.path.join(tables, "_runs"))).collect()
    assert [(r.status, r.rows_inserted, r.rows_failed) for r in runs] == [("SUCCESS", 4 + 4 + 2, 2)]
    kept = {r.file_name.rsplit("/", 1)[-1]: (r.status, r.rows_loaded) for r in spark.read.parquet(os.path.join(tables, "_file_verdicts")).collect()}
    assert len(kept) == 7 and kept["trades_2024-06-12.csv"] == ("ok", 2) and kept["trades_2024-06-10.csv"] == ("ok", 0) and kept["trades_2024-06-13.csv"] == ("error", 0)


def test_one_broken_archive_keeps_no_other_year_out(spark, root):
    from candlewick.plans import market_tables as M
    from candlewick.sinks import ledger as LG

    lines = M.hist_lines(spark, "/root/testdata/sf0.001").where("file_name in ('COTAHIST_A1996.TXT', 'COTAHIST_A1998.TXT')").orderBy("file_name", "line_no").collect()
    good = [_file(root, name, "".join(r.line + "\n" for r in lines if r.file_name == name), "latin-1") for name in ("COTAHIST_A1996.TXT", "COTAHIST_A1998.TXT")]
    bad = _file(root, "COTAHIST_A1997.ZIP", "PK no archive")
    tables = os.path.join(root, "tables")
    with pytest.raises(ValueError, match="1 file.*COTAHIST_A1997.ZIP"):
        J.load_historical(spark, [*good, bad], tables)
    years = {r.year for r in spark.read.parquet(os.path.join(tables, "fact_cotahist_daily")).select("year").distinct().collect()}
    assert years == {1996, 1998}
    verdicts = {r.file_name.rsplit("/", 1)[-1]: r.status for r in spark.read.parquet(os.path.join(tables, "_file_verdicts")).collect()}
    assert verdicts == {"COTAHIST_A1996.TXT": "ok", "COTAHIST_A1998.TXT": "ok", "COTAHIST_A1997.ZIP": "error"}
    assert LG.current_runs(spark.read.parquet(os.path.join(tables, "_runs"))).first().status == "FAILED"
    n = J.load_historical(spark, good, tables)
    done = LG.current_runs(spark.read.parquet(os.path.join(tables, "_runs"))).where("status = 'SUCCESS'").first()
    short = sum(len(r.line) != 245 or r.line[:2] not in ("00", "01", "99") for r in lines)
    assert (done.rows_inserted, done.rows_failed) == (n, short) and short > 0


def test_counters_ride_on_the_pass_that_loads(spark, root):
    from pyspark.sql import Observation

    from candlewick.sinks import ledger as LG
    from candlewick.sources import jsonl as JS

    good = '{"ticker_requested":"AAAA3","trade_date":"2024-06-14","price_history":[{"quote_time":"10:00:00","close_price":"1,5"},{"quote_time":"10:01:00","close_price":"2"}]}'
    path = _file(root, "d.jsonl", good + "\n{oops\n\n" + '{"trade_date":"2024-06-14"}' + "\n")
    records, watch = JS.decode_records(JS.scan_jsonl_lines(spark, path)), Observation()
    points = JS.points_of(records.observe(watch, *JS.record_counters()))
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    assert points.checkpoint(eager=True).count() == 2 and watch.get == {"points": 2, "skipped": 2}
    tables = os.path.join(root, "tables")
    assert J.load_intraday(spark, path, tables) == 2 and J.load_intraday(spark, path, tables) == 0
    runs = LG.current_runs(spark.read.parquet(os.path.join(tables, "_runs"))).collect()
    assert sorted((r.rows_inserted, r.rows_failed) for r in runs) == [(0, 2), (2, 2)]


def test_counters_of_a_load_that_keeps_nothing(spark, root):
    from candlewick.sinks import ledger as LG

    t = _file(root, "t_2024-06-14.csv", "TckrSymb;LastPric;TradQty\n;1;1\n ;2;2\n")
    assert J.load_daily_quotes(spark, t, root) == 0
    run = LG.current_runs(spark.read.parquet(os.path.join(root, "_runs"))).first()
    assert (run.status, run.rows_inserted, run.rows_failed) == ("SUCCESS", 0, 2)
