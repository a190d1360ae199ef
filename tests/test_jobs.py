"""End-to-end jobs over files written from the rendered fixtures (sf0.001)."""

import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from candlewick.operators import coverage as CV
from candlewick.operators import summary as SM
from candlewick.plans import jobs as J
from candlewick.plans import landing as LD
from candlewick.plans import market_tables as M
from candlewick.sinks import ledger as LG
from candlewick.sources import archives as AR
from candlewick.sources import fixed_width as FW
from candlewick.sources import manifest as MF

SF = "/root/testdata/sf0.001"


def _write_files(df, folder, encoding="utf-8", only=None):
    os.makedirs(folder, exist_ok=True)
    files = {}
    for r in df.orderBy("file_name", "line_no").collect():
        if only and r.file_name not in only:
            continue
        files.setdefault(r.file_name, []).append(r.line)
    for name, lines in files.items():
        with open(os.path.join(folder, name), "w", encoding=encoding, newline="\n") as fh:
            fh.write("\n".join(lines) + "\n")
    return [os.path.join(folder, n) for n in sorted(files)]


def test_register_trades_quotes_intraday_jobs_are_idempotent(spark):
    root = tempfile.mkdtemp(prefix="cw-jobs-")
    reg = _write_files(LD.raw_register_lines(spark, SF), os.path.join(root, "in", "register"))
    trades_df = LD.raw_trade_lines(spark, SF)
    months = sorted({r.file_name for r in trades_df.select("file_name").distinct().collect()})[:3]
    trades = _write_files(trades_df, os.path.join(root, "in", "trades"), only=set(months))
    jsonl = _write_files(LD.jsonl_lines(spark, SF).withColumn("line_no", F.lit(0)), os.path.join(root, "in", "jsonl"))
    tables = os.path.join(root, "tables")
    first = J.run_daily(spark, register_paths=reg, trades_paths=trades, jsonl_paths=jsonl, tables_root=tables)
    snap = {t: spark.read.parquet(os.path.join(tables, t)).count()
            for t in ("dim_assets", "fact_daily_trades", "fact_daily_quotes", "fact_quotes")}
    second = J.run_daily(spark, register_paths=reg, trades_paths=trades, jsonl_paths=jsonl, tables_root=tables)
    again = {t: spark.read.parquet(os.path.join(tables, t)).count() for t in snap}
    assert snap == again
    assert second["intraday"] == 0 and first["intraday"] == snap["fact_quotes"]
    assert snap["dim_assets"] == M.dim_assets(spark, SF).count()
    runs = LG.current_runs(spark.read.parquet(os.path.join(tables, "_runs")))
    assert runs.where(F.col("status") == "SUCCESS").count() == 6   # three ledgered jobs per daily run, run twice
    daily = [spark.read.parquet(os.path.join(tables, t)) for t in ("dim_assets", "fact_daily_quotes", "fact_daily_trades", "fact_quotes")]
    daily[2] = daily[2].withColumnRenamed("close_price", "last_price")
    full = {r.ticker: r for r in CV.asset_overview(*daily).collect()}
    kept = {r.ticker: r for r in SM.overview_of(J.read_summary(spark, tables)).collect()}
    same = [c for c in full["S0000000001"].asDict() if not c.endswith("price") and c not in ("variation_pct_latest", "financial_volume_latest")]
    assert full.keys() == kept.keys() and all(full[t][c] == kept[t][c] for t in full for c in same)
    assert all(full[t].quote_last_price is None or float(full[t].quote_last_price) == kept[t].quote_last_price for t in full)
    files = MF.manifest(spark, os.path.join(root, "in", "trades"))
    status = {str(r.day): r.status for r in MF.backfill_status(spark, files, "1995-01-01", "1995-01-03").collect()}
    assert status["1995-01-01"] == "ok" and status["1995-01-02"] == "skipped"


def test_zipped_historical_member(spark):
    root = tempfile.mkdtemp(prefix="cw-zip-")
    lines = M.hist_lines(spark, SF).where(F.col("file_name") == "COTAHIST_A1998.TXT")
    [txt] = _write_files(lines, root, encoding="latin-1")
    zpath = os.path.join(root, "COTAHIST_A1998.ZIP")
    with zipfile.ZipFile(zpath, "w") as zf:
        zf.write(txt, "COTAHIST_A1998.TXT")
    z = AR.zip_lines(spark, zpath, kind="hist")
    assert z.select("file_year").distinct().collect()[0][0] == 1998
    parsed = FW.parse_lines(z.withColumnRenamed("member", "file_name"))
    assert parsed.count() == FW.parse_lines(lines).count()
    tables = os.path.join(root, "tables")
    n = J.load_historical(spark, [txt], tables)
    assert n == FW.dedupe_last(FW.parse_lines(lines)).count()


def test_member_rules():
    assert AR.pick_csv_member(["a.txt", "B.CSV"]) == "B.CSV"
    assert AR.pick_hist_member(["x/", "COTAHIST.A2001"]) == "COTAHIST.A2001"
    assert AR.pick_hist_member(["a.bin", "b.bin"]) is None
