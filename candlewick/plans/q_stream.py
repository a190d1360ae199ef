"""Streaming queries (R1-R5): the events table is read as a file stream
(``availableNow``), processed by the streaming operators into tables under
the shared checkpoint folder, and the resulting tables are returned.  The
candle and latest streams read the events dealt over several files out of time
order, one file a micro-batch: however the points arrive, the tables equal the
batch operators, which is what the oracles state."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from candlewick.operators import universe as U
from candlewick.plans import market_tables as M
from candlewick.plans.catalog import register
from candlewick.plans.oracle_views import DAILY_VIEWS, V_INTRADAY, with_views
from candlewick.plans.q_candles import _intraday_body
from candlewick.plans.q_universe import REF, _REG
from candlewick.session import scratch_path
from candlewick.streaming import intraday as S

POINT_COLS = "ticker, quoted_at, trade_date, close_price, price_fluctuation_pct, source_jsonl"


def _points_stream(spark, sf_dir):
    schema = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).schema
    ev = S.file_stream(spark, sf_dir, schema, path_glob="events.parquet")
    return M.points_from_events(ev, with_order=True)


def _shuffled_points(spark, sf_dir, files: int = 3, replays: int = 1):
    """The events landed ``replays`` times in ``files`` files regardless of time, read one file a micro-batch."""
    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    folder = scratch_path(spark, "events-landed")
    for _ in range(replays):
        ev.repartition(files, F.xxhash64("event_id")).write.mode("append").parquet(folder)
    return M.points_from_events(S.file_stream(spark, folder, ev.schema, max_files_per_trigger=1), with_order=True)


@register("stream_ingest", with_views(V_INTRADAY, f"SELECT {POINT_COLS} FROM v_intraday"))
def stream_ingest(spark, sf_dir):
    pts = _points_stream(spark, sf_dir)
    table = S.run_to_table(spark, lambda t, c: S.ingest_points(pts, t, checkpoint=c, order=["event_id"]), "ingest")
    return spark.read.parquet(table).select(*POINT_COLS.split(", "))


@register("stream_candles", with_views(V_INTRADAY, _intraday_body("15m", 900)))
def stream_candles(spark, sf_dir):
    pts = _shuffled_points(spark, sf_dir)
    table = S.run_to_table(spark, lambda t, c: S.candle_stream(pts, "15m", t, points_table=f"{t}-points", checkpoint=c, order=["event_id"]), "candles")
    return S.candles(spark, table, "15m")


@register("stream_candles_open", with_views(V_INTRADAY, _intraday_body("15m", 900)))
def stream_candles_open(spark, sf_dir):
    """R1's table read as a stream, one file of points after another in time; open buckets are state."""
    pts = _points_stream(spark, sf_dir)
    stored = S.run_to_table(spark, lambda t, c: S.ingest_points(pts, t, checkpoint=c, order=["event_id"]), "ingest")
    schema = spark.read.parquet(stored).schema
    ordered = scratch_path(spark, "points-ordered")
    spark.read.parquet(stored).repartitionByRange(3, "quoted_at").write.parquet(ordered)
    stream = S.file_stream(spark, ordered, schema, max_files_per_trigger=1)
    table = S.run_to_table(spark, lambda t, c: S.open_candles(stream, "15m", t, delay="36500 days", checkpoint=c), "open-candles")
    return S.candles(spark, table, "15m")


@register("stream_first_points", with_views(V_INTRADAY, f"SELECT {POINT_COLS} FROM v_intraday"))
def stream_first_points(spark, sf_dir):
    """Every file of points arrives twice and out of time order; replays end in the state store."""
    pts = S.first_points(_shuffled_points(spark, sf_dir, replays=2), "36500 days")
    table = S.run_to_table(spark, lambda t, c: S.ingest_points(pts, t, checkpoint=c, order=["event_id"]), "first")
    return spark.read.parquet(table).select(*POINT_COLS.split(", "))


@register("stream_latest", with_views(V_INTRADAY, """
SELECT ticker, quoted_at, trade_date, close_price, price_fluctuation_pct FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY quoted_at DESC) AS rn FROM v_intraday) x
WHERE rn = 1"""))
def stream_latest(spark, sf_dir):
    pts = _shuffled_points(spark, sf_dir)
    table = S.run_to_table(spark, lambda t, c: S.latest_stream(pts, t, checkpoint=c), "latest")
    return S.latest_points(spark, table)


@register("stream_universe_gate", with_views(DAILY_VIEWS + ",\n" + V_INTRADAY, _REG + f"""
SELECT {POINT_COLS} FROM v_intraday
WHERE ticker IN (SELECT ticker FROM reg WHERE reject IS NULL AND ticker IN (SELECT ticker FROM act))"""))
def stream_universe_gate(spark, sf_dir):
    master = U.master_list(M.universe_register(spark, sf_dir), REF)
    strict = U.ticker_universe(master, U.active_list(M.activity_rows(spark, sf_dir))).where("in_strict")
    pts = S.universe_gate(_points_stream(spark, sf_dir), strict)
    table = S.run_to_table(spark, lambda t, c: S.ingest_points(pts, t, checkpoint=c, order=["event_id"]), "gate")
    return spark.read.parquet(table).select(*POINT_COLS.split(", "))
