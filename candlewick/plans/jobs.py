"""Composite load jobs.

Each job reads its files in one multi-file scan, cleans them with the
transforms, merges into the parquet tables under ``tables_root`` and records
RUNNING / SUCCESS / FAILED events in the run ledger.  Loads are idempotent, so
a failed job is repaired by running it again.
"""

from __future__ import annotations

import os
import time

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.headers import INSTRUMENT_COLUMN_MAP, TRADE_COLUMN_MAP
from candlewick.operators import summary as SM
from candlewick.plans import transforms as TR
from candlewick.sinks import ledger as LG
from candlewick.sinks import merge as MG
from candlewick.sinks import writers as WR
from candlewick.sources import delimited as D
from candlewick.sources import fixed_width as FW
from candlewick.sources import jsonl as JS
from candlewick.session import ensure_checkpoint_dir
from candlewick.sources.lines import base_name, once, per_file, same_path, scan_any
from candlewick.sources.manifest import backfill_status, historical_file_set, manifest
from candlewick.sources.tables import conform

TRADE_TARGETS = ["ticker", "trade_date", "open_price", "min_price", "max_price", "avg_price", "last_price",
                 "variation_pct", "financial_volume", "trade_count"]
REGISTER_TARGETS = ["ticker", "asset_name", "isin", "segment", "source_file_date"]


def _t(root: str, name: str) -> str:
    return os.path.join(root, name)


def _ledgered(spark, ledger, pipeline, fn, *, source_file=None, source_date=None):
    """Run ``fn(run_id)``, which returns the rows written and the rows dropped."""
    run = LG.start_run(spark, ledger, pipeline, source_file=source_file, source_date=source_date)
    try:
        n, dropped = fn(run)
    except Exception as e:
        LG.finish_run(spark, ledger, run, pipeline, status="FAILED", rows_failed=1, message=str(e))
        raise
    LG.finish_run(spark, ledger, run, pipeline, status="SUCCESS", rows_inserted=n, rows_failed=dropped)
    return n


def observed(watch: Observation, rows: DataFrame, counters: list) -> dict[str, int]:
    """What ``watch`` counted in the pass that staged a batch.  Where nothing
    was left of the batch, Spark may have cut the watched part out of the plan;
    only then are the rows counted by a job of their own.  A stage that ran
    again after a lost executor may have counted a task's rows twice."""
    try:
        return watch.get
    except Py4JError:
        return rows.agg(*counters).first().asDict()


def _watched_daily(rows: DataFrame, numeric: tuple[str, ...], target_date) -> tuple:
    """Daily rows of mapped files, and a function that gives the number of
    rows dropped for want of a ticker or a date once they are staged (P2, P3)."""
    parsed, watch = TR.parse_daily(rows, numeric, target_date), Observation()
    kept = TR.sourced(TR.keep_daily(parsed.observe(watch, *TR.daily_counters()), numeric))

    def dropped() -> int:
        seen = observed(watch, parsed, TR.daily_counters())
        return seen["no_ticker"] + seen["no_date"]

    return kept, dropped


def read_register(spark: SparkSession, paths) -> DataFrame:
    """Register files (plain or zipped) as mapped string columns."""
    return D.load_files(scan_any(spark, paths), "instruments", INSTRUMENT_COLUMN_MAP, REGISTER_TARGETS, min_fields=4, min_columns=4)


def read_trades(spark: SparkSession, paths, target_date=None) -> DataFrame:
    """Trades or daily-quote files (plain or zipped) as mapped string columns
    (S3, C13): rows of a file without a date column get ``target_date``, else
    the date in the file's name."""
    return D.load_files(scan_any(spark, paths), "trades", TRADE_COLUMN_MAP, TRADE_TARGETS, fallback={"trade_date": TR.undated(target_date)})


def load_register_and_trades(spark: SparkSession, register_paths, trades_paths, tables_root: str, *,
                             target_date=None, load_ts=None) -> int:
    """Register -> assets (K1) and trades -> daily trades (K2).

    Both batches are staged first.  The register must have rows; no trades
    files, or none with rows, is no error.  Trades are merged before the
    register is published, so a failure leaves the register as it was; the
    merge of trades is idempotent, so the next run completes the load.
    """
    ledger = _t(tables_root, "_runs")

    def work(run):
        reg = _staged_register(spark, register_paths, load_ts)
        n = dropped = 0
        if trades_paths:
            trades, counted = _watched_daily(read_trades(spark, trades_paths, target_date), TR.TRADE_NUMERIC, None)
            n += _upsert_daily(spark, trades.withColumnRenamed("last_price", "close_price"), "fact_daily_trades", tables_root)  # C25
            dropped = counted()
        return n + _publish_register(spark, reg, tables_root), dropped

    return _ledgered(spark, ledger, "instruments_and_trades", work, source_date=target_date)


def _staged_register(spark, paths, load_ts=None) -> DataFrame:
    ensure_checkpoint_dir(spark)
    now = F.current_timestamp() if load_ts is None else F.lit(load_ts)
    reg = conform(TR.transform_instruments(read_register(spark, paths)), "dim_assets").withColumn("updated_at", now.cast("timestamp_ntz")).checkpoint(eager=True)
    if reg.isEmpty():
        raise ValueError("the register produced zero rows")
    return reg


def _summarise(spark, tables_root: str, sources: dict[str, DataFrame]) -> None:
    """Merge a load's staged rows into the summary behind coverage and overview.
    A load that failed before this is repaired by running it again."""
    SM.merge_load(spark, _t(tables_root, "asset_summary"), time.time_ns() // 1000, sources)


def read_summary(spark: SparkSession, tables_root: str) -> DataFrame:
    """The summary that the loads keep: see ``summary.coverage_of`` and ``overview_of``."""
    return spark.read.parquet(_t(tables_root, "asset_summary"))


def _publish_register(spark, reg: DataFrame, tables_root: str) -> int:
    _summarise(spark, tables_root, {"asset": reg})
    return MG.upsert_unpartitioned(spark, reg, _t(tables_root, "dim_assets"), ["ticker"],
                                   update=["asset_name", "isin", "segment", "instrument_type", "source_file_date", "updated_at"],
                                   preserve={"is_active": F.lit(True), "created_at": F.col("updated_at")})


def _upsert_daily(spark, rows: DataFrame, table: str, tables_root: str, *, staged: bool = False) -> int:
    """``staged``: the rows are kept in the shared folder, with the types of the table."""
    ensure_checkpoint_dir(spark)
    if not staged:
        rows = conform(rows, table).checkpoint(eager=True)
    n = MG.upsert_partitions(spark, rows, _t(tables_root, table), ["ticker", "trade_date"], partition_col="trade_date",
                             update=[c for c in rows.columns if c not in ("ticker", "trade_date")], staged=True)
    if n:
        source = "trade" if table == "fact_daily_trades" else "quote"
        _summarise(spark, tables_root, {source: rows.withColumnRenamed("close_price", "last_price")})
    return n


def load_daily_quotes(spark: SparkSession, quotes_paths, tables_root: str, *, target_date=None) -> int:
    """Daily quotes (K3); zero rows is only a warning (returns 0)."""
    def work(run):
        quotes, counted = _watched_daily(read_trades(spark, quotes_paths, target_date).drop("open_price"), TR.QUOTE_NUMERIC, None)
        return _upsert_daily(spark, quotes, "fact_daily_quotes", tables_root), counted()

    return _ledgered(spark, _t(tables_root, "_runs"), "daily_quotes", work, source_date=target_date)


def load_intraday(spark: SparkSession, jsonl_paths, tables_root: str) -> int:
    """JSONL -> intraday points, insert-ignore (K4); returns rows really inserted."""
    def work(run):
        ensure_checkpoint_dir(spark)
        records, watch = JS.decode_records(JS.scan_jsonl_lines(spark, jsonl_paths)), Observation()
        # First write wins inside the batch: order = (file, line, point).
        keys, order = ["ticker", "quoted_at"], ["source_jsonl", "place"]
        points = conform(JS.points_of(records.observe(watch, *JS.record_counters())), "fact_quotes").checkpoint(eager=True)
        n = MG.insert_ignore_table(spark, points, _t(tables_root, "fact_quotes"), keys, partition_col="trade_date", order=order, staged=True)
        if not points.isEmpty():
            _summarise(spark, tables_root, {"intraday": TR.keep_first(points, keys, order)})
        return n, observed(watch, records, JS.record_counters())["skipped"]

    return _ledgered(spark, _t(tables_root, "_runs"), "intraday_quotes", work)


def load_historical(spark: SparkSession, paths: list[str], tables_root: str) -> int:
    """Fixed-width files (plain or zipped), last row per natural key
    (K6) and upsert by natural key (K5).  The last file wins.

    Multi-year sets are committed per two-year window, each one job over its
    files; files whose name holds no year form the last window.  An archive
    that cannot be read keeps none of the others out: what is good of all
    windows is committed and every file's verdict kept (``_file_verdicts``)
    before the run fails by naming the bad ones."""
    files = historical_file_set(spark.createDataFrame([(p, p.rsplit("/", 1)[-1]) for p in paths], "path string, name string"))
    by_window: dict[int, list[str]] = {}
    for r in files.select("load_window", "path").orderBy("sort_key").collect():  # the given paths
        by_window.setdefault(r.load_window, []).append(r.path)
    keys = list(FW.NATURAL_KEY)

    def work(run):
        ensure_checkpoint_dir(spark)
        total = skipped = failed = 0
        named = []
        for w in sorted(by_window):
            lines = once(scan_any(spark, by_window[w], kind="hist", encoding="ISO-8859-1", tolerant=True))
            verdicts = lines.groupBy("file_name").agg(
                F.min("problem").alias("message"), F.count_if((F.length("line") == FW.RECORD_LEN) & (F.substring("line", 1, 2) == FW.TIP_QUOTE)).alias("rows"))
            verdicts = per_file(verdicts)
            bad = verdicts.where(F.col("message").isNotNull())
            if n_bad := bad.count():
                failed += n_bad
                named += [f"{r.file_name} ({r.message})" for r in bad.orderBy("file_name").limit(D.NAMED_FILES - len(named)).collect()]
                lines = lines.join(bad, "file_name", "left_anti")
            lines, watch = lines.drop("problem"), Observation()
            rows = FW.dedupe_last(FW.parse_lines(lines.observe(watch, *FW.line_counters()))).withColumn("year", F.year("trade_date"))
            rows = rows.drop("file_name", "line_no").checkpoint(eager=True)
            if n := MG.upsert_partitions(spark, rows, _t(tables_root, "fact_cotahist_daily"), keys, partition_col="year",
                                         update=[c for c in rows.columns if c not in keys and c != "year"], staged=True):
                _summarise(spark, tables_root, {"hist": rows})
                total += n
            seen = observed(watch, lines, FW.line_counters())
            skipped += seen["skipped_wrong_length"] + seen["skipped_unknown_tip"]
            good = F.col("message").isNull()
            LG.record_files(verdicts.select("file_name", F.when(good, "ok").otherwise("error").alias("status"), "message",
                                            F.when(good, F.col("rows")).otherwise(0).alias("rows_loaded")), _t(tables_root, "_file_verdicts"), run, "historical")
        if failed:
            raise ValueError(f"{failed} file(s) in quarantine, the others are committed: {named}")
        return total, skipped

    return _ledgered(spark, _t(tables_root, "_runs"), "historical", work)


def backfill(spark: SparkSession, directory: str, tables_root: str, date_from, date_to, *, register_paths) -> DataFrame:
    """Load every day of the range that has a trades file; one row per
    day with status ok, skipped (no file) or error (with the message).

    All days are one load: one scan of their files, one merge into each table
    and one run in the ledger, however long the range.  An empty file is none.  Files of a later day
    win over earlier ones.  A file that cannot be loaded is an error of its
    day alone; a register that cannot be is one of every day."""
    ensure_checkpoint_dir(spark)
    days = backfill_status(spark, manifest(spark, directory), date_from, date_to).withColumn("path", same_path("path")).checkpoint(eager=True)
    paths = [r.path for r in days.where(F.col("status") == "ok").select("path").collect()]  # one a calendar day
    nothing = F.lit(None).cast("string")
    if not paths:
        return days.withColumn("message", nothing)
    try:
        verdicts = load_days(spark, paths, tables_root, register_paths=register_paths)
    except Exception as e:
        failed = F.col("status") == "ok"
        return days.select("day", F.when(failed, "error").otherwise(F.col("status")).alias("status"), "path", F.when(failed, F.lit(str(e))).alias("message"))
    v = verdicts.select(F.col("file_name").alias("path"), F.col("status").alias("verdict"), F.col("message").alias("why"))
    return days.join(v, "path", "left").select("day", F.coalesce("verdict", "status").alias("status"), "path", F.col("why").alias("message"))


def load_days(spark: SparkSession, trades_paths: list[str], tables_root: str, *, register_paths) -> DataFrame:
    """Register and the trades files of many days in one load.
    Returns (file_name, status, message, rows_loaded) of every file: ``error``
    for one that cannot be loaded, which keeps none of the others out.
    ``rows_loaded`` leaves out rows that a later file replaced."""
    out = []

    def work(run):
        reg = _staged_register(spark, register_paths)
        rows, verdicts = D.load_good_files(scan_any(spark, trades_paths, tolerant=True), "trades", TRADE_COLUMN_MAP, TRADE_TARGETS,
                                           fallback={"trade_date": TR.undated()})
        listed = spark.createDataFrame([(MG.qualified(spark, p),) for p in trades_paths], "path string").select(same_path("path").alias("file_name"))
        judged = listed.join(verdicts.select(same_path("file_name").alias("file_name"), F.lit(True).alias("read"), "problem"), "file_name", "left").select(
            "file_name", F.when(F.col("read").isNull(), "empty file").otherwise(F.col("problem")).alias("message"))
        judged = per_file(judged)
        n = dropped = 0
        loaded = spark.createDataFrame([], "file_name string, rows_loaded bigint")
        if not judged.where(F.col("message").isNull()).isEmpty():
            parsed, watch = TR.parse_daily(rows, TR.TRADE_NUMERIC, aged=True), Observation()
            daily = TR.keep_daily(parsed.observe(watch, *TR.daily_counters()), TR.TRADE_NUMERIC, newest_file=True)
            # Both tables declare the same type for a column that both have: typed and kept once.
            daily = daily.withColumn("source_file_name", base_name("file_name"))
            daily = once(conform(conform(daily, "fact_daily_quotes"), "fact_daily_trades"), "daily")
            seen = observed(watch, parsed, TR.daily_counters())
            dropped = seen["no_ticker"] + seen["no_date"]
            loaded = daily.groupBy(same_path("file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("rows_loaded"))
            named = daily.drop("file_name")
            n += _upsert_daily(spark, named.withColumnRenamed("last_price", "close_price"), "fact_daily_trades", tables_root, staged=True)  # C25
            n += _upsert_daily(spark, named.drop("open_price"), "fact_daily_quotes", tables_root, staged=True)
        n += _publish_register(spark, reg, tables_root)
        result = judged.join(per_file(loaded), "file_name", "left").select(
            "file_name", F.when(F.col("message").isNull(), "ok").otherwise("error").alias("status"), "message", F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded")).checkpoint(eager=True)
        LG.record_files(result, _t(tables_root, "_file_verdicts"), run, "days")
        out.append(result)
        return n, dropped

    _ledgered(spark, _t(tables_root, "_runs"), "days", work)
    return out[0]


def run_daily(spark: SparkSession, *, register_paths, trades_paths, jsonl_paths, tables_root: str, target_date=None,
              historical_paths=None) -> dict:
    """Historical (if given) -> register and trades -> quotes (same trades files) -> intraday."""
    out = {}
    if historical_paths:
        out["historical"] = load_historical(spark, historical_paths, tables_root)
    out["register_and_trades"] = load_register_and_trades(spark, register_paths, trades_paths, tables_root, target_date=target_date)
    out["daily_quotes"] = load_daily_quotes(spark, trades_paths, tables_root, target_date=target_date)
    out["intraday"] = load_intraday(spark, jsonl_paths, tables_root)
    return out


def run_payload_batch(spark: SparkSession, landed: DataFrame, out_dir: str) -> DataFrame:
    """Landed payloads -> JSONL histories (K8) and report (K9); a bad
    payload becomes a failure row, never an exception.  The run goes to the
    ledger under ``out_dir`` as a landing run (K12).  Returns A8 counts."""
    from candlewick.sources.payloads import batch_outcome

    ledger = _t(out_dir, "_runs")
    run = LG.start_run(spark, ledger, "payload_batch", kind="landing")
    try:
        WR.write_payload_records(landed, os.path.join(out_dir, "jsonl"))
        WR.write_report(landed, os.path.join(out_dir, "report"))
        report = spark.read.schema("ticker_requested string, ticker_returned string, trade_date string, http_status int, request_succeeded boolean, points_count int, error_message string")
        out = batch_outcome(report.option("header", True).csv(os.path.join(out_dir, "report")))
        n = {r.request_succeeded: r.n for r in out.collect()}  # two rows at most
    except Exception as e:
        LG.finish_run(spark, ledger, run, "payload_batch", status="FAILED", message=str(e), kind="landing")
        raise
    LG.finish_run(spark, ledger, run, "payload_batch", status="SUCCESS", rows_inserted=n.get(True, 0), rows_failed=n.get(False, 0), kind="landing")
    return out
