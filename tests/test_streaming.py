"""Streams keep tables right for late, repeated and replayed points, and touch only what changed."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.session import scratch_path
from candlewick.sinks import merge as MG
from candlewick.streaming import intraday as S

SCHEMA = "ticker string, quoted_at timestamp_ntz, trade_date date, close_price double, price_fluctuation_pct double, event_id long"
DAY = dt.datetime(2024, 3, 1, 10)


def points(spark, *rows):
    return spark.createDataFrame([(t, DAY + dt.timedelta(minutes=m), (DAY + dt.timedelta(minutes=m)).date(), p, 0.0, k) for k, (t, m, p) in enumerate(rows)], SCHEMA)


def stream_of(spark, *batches):
    folder = scratch_path(spark, "points")
    for k, b in enumerate(batches):
        b.coalesce(1).write.mode("append").parquet(folder)
        for f in os.listdir(folder):
            if f.endswith(".parquet"):
                os.utime(f"{folder}/{f}", (1_700_000_000 + k, 1_700_000_000 + k)) if os.path.getmtime(f"{folder}/{f}") > 1_700_001_000 else None
    return S.file_stream(spark, folder, batches[0].schema, max_files_per_trigger=1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


BATCHES = [
    [("A", 0, 1.0), ("A", 5, 3.0), ("B", 1, 9.0), ("A", 20, 2.0)],
    [("A", 14, 0.5), ("A", 5, 77.0), ("C", 60 * 24 * 3, 4.0), ("B", 2, None)],
    [("A", 3, 8.0), ("B", -60 * 24 * 9, 6.0), ("A", 0, 55.0)],
]


def test_candles_merge_late_and_repeated_points(spark):
    batches = [points(spark, *b) for b in BATCHES]
    stream = stream_of(spark, *batches)
    table = S.run_to_table(spark, lambda t, c: S.candle_stream(stream, "15m", t, points_table=f"{t}-points", checkpoint=c, order=["event_id"]), "candles")
    seen, first = set(), []
    for b in BATCHES:
        for t, m, p in b:
            if (t, m) not in seen:
                seen.add((t, m))
                first.append((t, m, p))
    want = rows(C.intraday_candles(points(spark, *first), "15m").drop("volume"))
    assert rows(S.candles(spark, table, "15m").drop("volume")) == want


def test_a_repeated_batch_changes_nothing(spark):
    table = scratch_path(spark, "repeat")
    b = points(spark, *BATCHES[0])

    def write(batch_id):
        new = MG.insert_ignore_rows(spark, b, f"{table}-points", ["ticker", "quoted_at"], partition_col="trade_date", order=["event_id"], batch_id=batch_id)
        parts = S.partial_candles(new, "15m").withColumn("candle_date", F.to_date("start_time"))
        MG.combine_partitions(spark, parts, table, partition_col="candle_date", batch_id=batch_id, combine=S.merge_candles)
        return new.count(), rows(S.candles(spark, table, "15m").drop("volume"))

    n, first = write(0)
    assert n == 4 and write(0) == (4, first)
    n, later = write(1)  # the same points in another batch are no longer new
    assert n == 0 and later == first


def test_a_batch_that_failed_between_both_tables_is_completed(spark):
    table = scratch_path(spark, "half")
    b = points(spark, *BATCHES[0])
    MG.insert_ignore_rows(spark, b, f"{table}-points", ["ticker", "quoted_at"], partition_col="trade_date", order=["event_id"], batch_id=0)
    new = MG.insert_ignore_rows(spark, b, f"{table}-points", ["ticker", "quoted_at"], partition_col="trade_date", order=["event_id"], batch_id=0)
    MG.combine_partitions(spark, S.partial_candles(new, "15m").withColumn("candle_date", F.to_date("start_time")), table, partition_col="candle_date", batch_id=0, combine=S.merge_candles)
    assert S.candles(spark, table, "15m").agg(F.sum("point_count")).first()[0] == 4


def test_latest_writes_changed_tickers_only(spark):
    stream = stream_of(spark, points(spark, ("A", 0, 1.0), ("B", 0, 2.0)), points(spark, ("A", 5, 3.0)), points(spark, ("A", 1, 9.0), ("C", 0, 4.0)))
    table = S.run_to_table(spark, lambda t, c: S.latest_stream(stream, t, checkpoint=c), "latest")
    got = {r.ticker: r.close_price for r in S.latest_points(spark, table).collect()}
    assert got == {"A": 3.0, "B": 2.0, "C": 4.0}
    written = spark.read.parquet(table).groupBy("ticker").agg(F.collect_set("version").alias("v")).collect()
    assert {r.ticker: len(r.v) for r in written}["B"] == 1


def test_first_points_drop_replays_and_count_late_ones(spark):
    stream = stream_of(spark, points(spark, ("A", 0, 1.0), ("A", 600, 2.0)), points(spark, ("A", 600, 5.0), ("A", 599, 3.0)), points(spark, ("A", 1, 4.0)))
    table, queries = scratch_path(spark, "first"), []
    q = S.ingest_points(S.first_points(stream, "1 hour"), table, checkpoint=scratch_path(spark, "ckpt"), order=["event_id"])
    q.awaitTermination()
    queries.append(q)
    got = rows(spark.read.parquet(table).select("quoted_at", "close_price"))
    assert [p for _, p in got] == [1.0, 3.0, 2.0]
    assert sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"]) == 1


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_open_candles_in_any_time_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        b = [("A", 0, 1.0), ("A", 5, 3.0), ("B", 1, 9.0)], [("A", 20, 2.0), ("A", 29, 7.0)], [("A", 22, 0.5)]
        stream = stream_of(spark, *[points(spark, *x) for x in b])
        table = S.run_to_table(spark, lambda t, c: S.open_candles(stream, "15m", t, delay="1 hour", checkpoint=c), "open")
        want = rows(C.intraday_candles(points(spark, *sum(b, [])), "15m").drop("volume"))
        assert rows(S.candles(spark, table, "15m").drop("volume")) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
