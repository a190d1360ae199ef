"""Table-maintenance queries: upserts, insert-ignore and the run ledger
(K1-K7, K11, J7, T8, F9, C27).  The merges are evaluated as DataFrames
(two batches folded), exactly what the table writers persist."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import pages as PG
from candlewick.plans import market_tables as M
from candlewick.plans.catalog import register
from candlewick.plans.oracle_views import V_ASSETS, V_INTRADAY, daily_views_for, ticker, with_views
from candlewick.plans.transforms import keep_first
from candlewick.sinks import ledger as LG
from candlewick.sinks import merge as MG

TRADE_MEASURES = ["open_price", "last_price", "min_price", "max_price", "avg_price", "variation_pct",
                  "financial_volume", "trade_count", "source_file_name"]
LOAD_TS = "2002-01-31 00:00:00"


@register("upsert_trades", with_views(daily_views_for("a", "l_returnflag = 'R'") + ",\n" + daily_views_for("b", "l_returnflag <> 'R'"), """
SELECT coalesce(b.ticker, a.ticker) AS ticker, coalesce(b.trade_date, a.trade_date) AS trade_date,
       CASE WHEN b.ticker IS NOT NULL THEN b.open_price ELSE a.open_price END AS open_price,
       CASE WHEN b.ticker IS NOT NULL THEN b.last_price ELSE a.last_price END AS last_price,
       CASE WHEN b.ticker IS NOT NULL THEN b.min_price ELSE a.min_price END AS min_price,
       CASE WHEN b.ticker IS NOT NULL THEN b.max_price ELSE a.max_price END AS max_price,
       CASE WHEN b.ticker IS NOT NULL THEN b.avg_price ELSE a.avg_price END AS avg_price,
       CASE WHEN b.ticker IS NOT NULL THEN b.variation_pct ELSE a.variation_pct END AS variation_pct,
       CASE WHEN b.ticker IS NOT NULL THEN b.financial_volume ELSE a.financial_volume END AS financial_volume,
       CASE WHEN b.ticker IS NOT NULL THEN b.trade_count ELSE a.trade_count END AS trade_count,
       CASE WHEN b.ticker IS NOT NULL THEN 'batch_b' ELSE 'batch_a' END AS source_file_name
FROM v_daily_a a FULL OUTER JOIN v_daily_b b ON a.ticker = b.ticker AND a.trade_date = b.trade_date"""))
def upsert_trades(spark, sf_dir):
    a = M.daily_bars(spark, sf_dir, F.col("l_returnflag") == "R").withColumn("source_file_name", F.lit("batch_a"))
    b = M.daily_bars(spark, sf_dir, F.col("l_returnflag") != "R").withColumn("source_file_name", F.lit("batch_b"))
    return MG.merge_upsert(a, b, ["ticker", "trade_date"], update=TRADE_MEASURES)


@register("upsert_assets", with_views(V_ASSETS, f"""
, batch AS (
  SELECT {ticker('c_custkey')} AS ticker, c_name AS asset_name, 'BRC' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS isin,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS segment, 'SHARES' AS instrument_type,
         DATE '2002-01-31' AS source_file_date
  FROM customer),
tgt AS (SELECT ticker, asset_name, isin, segment, instrument_type, source_file_date, acct_balance >= 0 AS is_active,
               TIMESTAMP '2001-12-31 00:00:00' AS created_at FROM v_assets)
SELECT coalesce(b.ticker, t.ticker) AS ticker,
       CASE WHEN b.ticker IS NOT NULL THEN b.asset_name ELSE t.asset_name END AS asset_name,
       CASE WHEN b.ticker IS NOT NULL THEN b.isin ELSE t.isin END AS isin,
       CASE WHEN b.ticker IS NOT NULL THEN b.segment ELSE t.segment END AS segment,
       CASE WHEN b.ticker IS NOT NULL THEN b.instrument_type ELSE t.instrument_type END AS instrument_type,
       CASE WHEN b.ticker IS NOT NULL THEN b.source_file_date ELSE t.source_file_date END AS source_file_date,
       coalesce(t.is_active, TRUE) AS is_active,
       coalesce(t.created_at, TIMESTAMP '{LOAD_TS}') AS created_at,
       CASE WHEN b.ticker IS NOT NULL THEN TIMESTAMP '{LOAD_TS}' END AS updated_at
FROM tgt t FULL OUTER JOIN batch b ON t.ticker = b.ticker"""))
def upsert_assets(spark, sf_dir):
    from candlewick.sources.tables import read_test_table
    c = read_test_table(spark, sf_dir, "customer")
    batch = c.select(
        M.ticker_of("c_custkey").alias("ticker"), F.col("c_name").alias("asset_name"),
        F.concat(F.lit("BRC"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("isin"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"),   # a null overwrites
        F.lit("SHARES").alias("instrument_type"), F.lit("2002-01-31").cast("date").alias("source_file_date"),
        F.lit(LOAD_TS).cast("timestamp_ntz").alias("updated_at"))
    target = M.dim_assets(spark, sf_dir).select(
        "ticker", "asset_name", "isin", "segment", "instrument_type", "source_file_date",
        (F.col("acct_balance") >= 0).alias("is_active"),
        F.lit("2001-12-31 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    return MG.merge_upsert(
        target, batch, ["ticker"],
        update=["asset_name", "isin", "segment", "instrument_type", "source_file_date", "updated_at"],
        preserve={"is_active": F.lit(True), "created_at": F.lit(LOAD_TS).cast("timestamp_ntz")})


@register("insert_ignore", with_views(V_INTRADAY, """
, pts AS (SELECT e.event_id, e.event_type, p.ticker, date_trunc('minute', p.quoted_at) AS quoted_at, p.trade_date,
                 p.close_price FROM v_intraday p JOIN events e ON e.user_id = CAST(substr(p.ticker, 2) AS BIGINT) AND e.ts = p.quoted_at),
tgt AS (SELECT ticker, quoted_at, arg_min(trade_date, event_id) AS trade_date, arg_min(close_price, event_id) AS close_price
        FROM pts WHERE event_type = 'view' GROUP BY ticker, quoted_at),
bat AS (SELECT ticker, quoted_at, arg_min(trade_date, event_id) AS trade_date, arg_min(close_price, event_id) AS close_price
        FROM pts WHERE event_type <> 'view' GROUP BY ticker, quoted_at)
SELECT ticker, quoted_at, trade_date, close_price FROM tgt
UNION ALL
SELECT b.ticker, b.quoted_at, b.trade_date, b.close_price FROM bat b
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.ticker = b.ticker AND t.quoted_at = b.quoted_at)"""))
def insert_ignore_q(spark, sf_dir):
    from candlewick.sources.tables import read_test_table
    ev = read_test_table(spark, sf_dir, "events")
    pts = ev.select(M.ticker_of("user_id").alias("ticker"), F.date_trunc("minute", "ts").alias("quoted_at"),
                    F.to_date("ts").alias("trade_date"), F.col("value").alias("close_price"), "event_id", "event_type")
    keys = ["ticker", "quoted_at"]
    target = keep_first(pts.where(F.col("event_type") == "view").drop("event_type"), keys, ["event_id"]).drop("event_id")
    batch = pts.where(F.col("event_type") != "view").drop("event_type")
    _, merged = MG.insert_ignore(target, batch, keys, order=["event_id"])
    return merged


_RUN_EVENTS = """, ev AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 'etl' AS kind,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'instruments_and_trades' WHEN '2-HIGH' THEN 'daily_quotes'
              WHEN '3-MEDIUM' THEN 'intraday_quotes' WHEN '4-NOT SPECIFIED' THEN 'historical_annual'
              ELSE 'historical_multi_year' END AS pipeline_name,
         CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'FAILED' ELSE 'RUNNING' END AS final_status,
         o_orderdate + to_seconds(o_custkey) AS started_at,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_seconds(o_custkey) + to_seconds(CAST(floor(o_totalprice / 100) AS BIGINT)) END AS finished_at,
         CAST(o_orderdate AS DATE) AS source_date,
         CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice / 1000) AS BIGINT) WHEN o_orderstatus = 'P' THEN 0 END AS rows_inserted,
         CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'P' THEN 1 END AS rows_failed,
         CASE WHEN o_orderstatus = 'P' THEN 'load failed' END AS message
  FROM orders)"""


def run_events(spark, sf_dir):
    """Ledger events rendered from orders: a RUNNING event per run and a
    SUCCESS / FAILED event for finished ones."""
    from candlewick.sources.tables import read_test_table
    o = read_test_table(spark, sf_dir, "orders")
    pipeline = (F.when(F.col("o_orderpriority") == "1-URGENT", "instruments_and_trades")
                .when(F.col("o_orderpriority") == "2-HIGH", "daily_quotes")
                .when(F.col("o_orderpriority") == "3-MEDIUM", "intraday_quotes")
                .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "historical_annual")
                .otherwise("historical_multi_year"))
    started = F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_custkey").cast("decimal(18,6)"))
    finished = started + F.make_dt_interval(secs=F.floor(F.col("o_totalprice") / 100).cast("decimal(18,6)"))
    final = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "P", "FAILED")
    base = o.select(F.col("o_orderkey").cast("string").alias("run_id"), F.lit("etl").alias("kind"),
                    pipeline.alias("pipeline_name"), started.alias("started"), finished.alias("finished"),
                    final.alias("final"), F.to_date("o_orderdate").alias("source_date"),
                    F.col("o_totalprice"))
    start_ev = base.select("run_id", "kind", "pipeline_name", F.lit("RUNNING").alias("status"),
                           F.lit(0).alias("event_seq"), F.col("started").alias("event_at"),
                           F.lit(None).cast("string").alias("source_file"), "source_date",
                           F.lit(None).cast("bigint").alias("rows_inserted"), F.lit(None).cast("bigint").alias("rows_failed"),
                           F.lit(0).alias("retry_count"), F.lit(None).cast("string").alias("message"))
    end_ev = base.where(F.col("final").isNotNull()).select(
        "run_id", "kind", "pipeline_name", F.col("final").alias("status"), F.lit(1).alias("event_seq"),
        F.col("finished").alias("event_at"), F.lit(None).cast("string").alias("source_file"),
        F.lit(None).cast("date").alias("source_date"),
        F.when(F.col("final") == "SUCCESS", F.floor(F.col("o_totalprice") / 1000).cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("rows_inserted"),
        F.when(F.col("final") == "SUCCESS", F.lit(0).cast("bigint")).otherwise(F.lit(1).cast("bigint")).alias("rows_failed"),
        F.lit(0).alias("retry_count"),
        F.when(F.col("final") == "FAILED", F.lit("load failed")).alias("message"))
    return start_ev.unionByName(end_ev)


_RUN_COLS = ("run_id, kind, pipeline_name, final_status AS status, started_at, finished_at, "
             "CAST(NULL AS VARCHAR) AS source_file, source_date, rows_inserted, rows_failed, 0 AS retry_count, message, "
             "CAST(epoch_us(finished_at) - epoch_us(started_at) AS DOUBLE) / 1000000.0 AS duration_seconds")


@register("run_ledger", with_views("o0 AS (SELECT 1)" + _RUN_EVENTS, f"SELECT {_RUN_COLS} FROM ev"))
def run_ledger(spark, sf_dir):
    return LG.current_runs(run_events(spark, sf_dir))


@register("run_page", with_views("o0 AS (SELECT 1)" + _RUN_EVENTS, f"""
, f AS (SELECT {_RUN_COLS}, CAST(run_id AS BIGINT) AS id FROM ev
        WHERE pipeline_name = 'daily_quotes' AND lower(final_status) = 'success'
          AND started_at >= TIMESTAMP '1997-01-01 00:00:00')
SELECT * EXCLUDE (id), (SELECT count(*) FROM f) AS total FROM f ORDER BY started_at DESC, id DESC LIMIT 30 OFFSET 10"""))
def run_page(spark, sf_dir):
    runs = LG.current_runs(run_events(spark, sf_dir)).withColumn("id", F.col("run_id").cast("bigint"))
    f = PG.runs_filtered(runs, pipeline_name="daily_quotes", status="success", started_from="1997-01-01 00:00:00")
    return PG.page(f, [F.col("started_at").desc(), F.col("id").desc()], 30, 10).drop("id")


@register("attach_asset_id", with_views(V_ASSETS + ",\n" + V_INTRADAY, """
SELECT p.ticker, p.quoted_at, a.ticker IS NOT NULL AS has_asset FROM v_intraday p LEFT JOIN v_assets a ON a.ticker = p.ticker"""))
def attach_asset_id(spark, sf_dir):
    """Points with the id of their register row."""
    out = MG.attach_asset_id(M.intraday_points(spark, sf_dir), M.dim_assets(spark, sf_dir))
    return out.select("ticker", "quoted_at", F.col("asset_id").isNotNull().alias("has_asset"))
