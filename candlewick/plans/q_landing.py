"""Landing-zone queries: JSONL histories and quote payloads
(S10-S13, A7, A8, K8, K9, C11, C16, C18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.plans import landing as LD
from candlewick.plans import market_tables as M
from candlewick.plans.catalog import register
from candlewick.plans.oracle_views import DAILY_VIEWS, V_INTRADAY, with_views
from candlewick.sources import jsonl as JS
from candlewick.sources import payloads as PL

_FILE = "'daily_fluctuation_' || strftime(trade_date, '%Y%m%d') || 'T180000.jsonl'"


@register("jsonl_points", with_views(V_INTRADAY, f"""
SELECT ticker, date_trunc('second', quoted_at) AS quoted_at, trade_date,
       CAST(close_price AS DECIMAL(18,6)) AS close_price,
       CAST(price_fluctuation_pct AS DECIMAL(18,6)) AS price_fluctuation_pct,
       {_FILE} AS source_jsonl
FROM v_intraday
UNION ALL
SELECT DISTINCT ticker, TIMESTAMP '{LD.EXTRA_DAY} 00:00:00', DATE '{LD.EXTRA_DAY}',
       CAST(NULL AS DECIMAL(18,6)), CAST(NULL AS DECIMAL(18,6)), '{LD.EXTRA_FILE}'
FROM v_intraday"""))
def jsonl_points(spark, sf_dir):
    return JS.parse_jsonl(LD.jsonl_lines(spark, sf_dir))


@register("jsonl_counters", with_views(V_INTRADAY, f"""
SELECT {_FILE} AS source_jsonl, count(*) AS points, count(DISTINCT ticker) AS tickers, CAST(0 AS BIGINT) AS skipped
FROM v_intraday GROUP BY trade_date
UNION ALL
SELECT '{LD.EXTRA_FILE}', count(DISTINCT ticker), count(DISTINCT ticker), 3 * count(DISTINCT ticker) FROM v_intraday"""))
def jsonl_counters(spark, sf_dir):
    return JS.jsonl_counters(LD.jsonl_lines(spark, sf_dir))


@register("jsonl_writer_roundtrip", with_views(V_INTRADAY, """
SELECT ticker, date_trunc('second', quoted_at) AS quoted_at, trade_date,
       CAST(close_price AS DECIMAL(18,6)) AS close_price,
       CAST(price_fluctuation_pct AS DECIMAL(18,6)) AS price_fluctuation_pct,
       'roundtrip.jsonl' AS source_jsonl
FROM v_intraday"""))
def jsonl_writer_roundtrip(spark, sf_dir):
    recs = JS.write_jsonl_records(M.intraday_points(spark, sf_dir))
    return JS.parse_jsonl(recs.select(F.lit("roundtrip.jsonl").alias("file_name"), F.col("value").alias("line")))


_PTS = """, pe AS (
  SELECT *, row_number() OVER (PARTITION BY ticker, trade_date ORDER BY quoted_at) - 1 AS pos,
         count(*) OVER (PARTITION BY ticker, trade_date) AS n
  FROM v_intraday)"""


@register("payload_series", with_views(V_INTRADAY, _PTS + """
SELECT ticker, trade_date, strftime(trade_date, '%Y-%m-%d') || ' 18:00:00' AS message_datetime,
       CAST(pos AS INTEGER) AS pos, strftime(quoted_at, '%H:%M:%S') AS quote_time,
       CAST(close_price AS DECIMAL(18,6)) AS close_price,
       CAST(price_fluctuation_pct AS DECIMAL(10,4)) AS price_fluctuation_pct
FROM pe"""))
def payload_series(spark, sf_dir):
    return PL.payload_series(LD.landed_payloads(spark, sf_dir))


@register("payload_snapshot", with_views(V_INTRADAY, _PTS + f"""
SELECT ticker, trade_date, strftime(quoted_at, '%H:%M:%S') AS quote_time,
       CAST(close_price AS DECIMAL(18,6)) AS latest_close_price,
       CAST(price_fluctuation_pct AS DECIMAL(10,4)) AS latest_price_fluctuation_pct,
       CAST(n AS INTEGER) AS points_count
FROM pe WHERE pos = n - 1
UNION ALL
SELECT DISTINCT ticker, DATE '{LD.EXTRA_DAY}', NULL, NULL, NULL, 0 FROM v_intraday"""))
def payload_snapshot(spark, sf_dir):
    return PL.payload_snapshot(LD.landed_payloads(spark, sf_dir))


@register("payload_daily", with_views(V_INTRADAY + ",\n" + DAILY_VIEWS, _PTS + """
SELECT ticker, 'nested' AS payload_format, trade_date,
       CAST(close_price AS DECIMAL(18,6)) AS last_price,
       CAST(NULL AS DECIMAL(18,6)) AS min_price, CAST(NULL AS DECIMAL(18,6)) AS max_price,
       CAST(NULL AS DECIMAL(18,6)) AS avg_price,
       CAST(price_fluctuation_pct AS DECIMAL(10,4)) AS variation_pct, CAST(NULL AS VARCHAR) AS error
FROM pe WHERE pos = n - 1
UNION ALL
SELECT DISTINCT ticker, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'unrecognised payload' FROM v_intraday
UNION ALL
SELECT ticker, 'flat', trade_date, CAST(CAST(last_price AS VARCHAR) AS DECIMAL(18,6)),
       CAST(CAST(min_price AS VARCHAR) AS DECIMAL(18,6)), CAST(CAST(max_price AS VARCHAR) AS DECIMAL(18,6)),
       CAST(CAST(avg_price AS VARCHAR) AS DECIMAL(18,6)), CAST(CAST(variation_pct AS VARCHAR) AS DECIMAL(10,4)), NULL
FROM v_daily"""))
def payload_daily(spark, sf_dir):
    landed = LD.landed_payloads(spark, sf_dir).unionByName(LD.landed_flat_payloads(spark, sf_dir))
    return PL.daily_fluctuation(landed)


@register("batch_report", with_views(V_INTRADAY, _PTS + """
SELECT ticker AS ticker_requested, ticker AS ticker_returned, strftime(trade_date, '%Y-%m-%d') AS trade_date,
       200 AS http_status, TRUE AS request_succeeded, CAST(n AS INTEGER) AS points_count,
       CAST(NULL AS VARCHAR) AS error_message
FROM pe WHERE pos = 0
UNION ALL
SELECT DISTINCT ticker, NULL, NULL, 503, FALSE, 0, 'HTTP 503' FROM v_intraday"""))
def batch_report(spark, sf_dir):
    return PL.batch_report(LD.landed_payloads(spark, sf_dir))


@register("batch_outcome", with_views(V_INTRADAY, """
SELECT TRUE AS request_succeeded, count(*) AS n FROM (SELECT DISTINCT ticker, trade_date FROM v_intraday) x
UNION ALL
SELECT FALSE, count(DISTINCT ticker) FROM v_intraday"""))
def batch_outcome(spark, sf_dir):
    return PL.batch_outcome(PL.batch_report(LD.landed_payloads(spark, sf_dir)))


# A seventh of the points has no ticker, another no usable time (a clock time only).
_BAD = "CAST(second(quoted_at) AS BIGINT) % 7"


@register("intraday_transform", with_views(V_INTRADAY, f"""
SELECT ticker, date_trunc('second', quoted_at) AS quoted_at, trade_date, CAST(close_price AS DECIMAL(18,6)) AS close_price,
       CAST(price_fluctuation_pct AS DECIMAL(18,6)) AS price_fluctuation_pct, 'flat' AS source_jsonl
FROM v_intraday WHERE {_BAD} > 1"""))
def intraday_transform(spark, sf_dir):
    return JS.transform_intraday(_flat_points(spark, sf_dir))


@register("intraday_transform_counters", with_views(V_INTRADAY, f"""
SELECT CASE {_BAD} WHEN 0 THEN 'no_ticker' WHEN 1 THEN 'no_time' ELSE 'kept' END AS outcome, count(*) AS n
FROM v_intraday GROUP BY 1"""))
def intraday_transform_counters(spark, sf_dir):
    return JS.intraday_counters(_flat_points(spark, sf_dir))


def _flat_points(spark, sf_dir):
    """Flat records under other field names: ticker in one of two columns, times with and without zone, comma decimals."""
    p = M.intraday_points(spark, sf_dir)
    bad = F.second("quoted_at") % 7
    clock = F.date_format("quoted_at", "yyyy-MM-dd'T'HH:mm:ss")
    named = F.minute("quoted_at") % 2 == 0
    low = F.when(bad > 0, F.concat(F.lit(" "), F.lower("ticker")))
    return p.select(
        F.when(named, low).alias("symbol"), F.when(~named, low).alias("ticker_returned"),
        F.when(bad == 1, F.date_format("quoted_at", "HH:mm:ss")).when(named, clock).otherwise(F.concat(clock, F.lit("Z"))).alias("timestamp"),
        F.replace(F.col("close_price").cast("string"), F.lit("."), F.lit(",")).alias("closPric"),
        F.col("price_fluctuation_pct").alias("prcFlcn"), F.lit("flat").alias("source_jsonl"))


@register("payload_batch_records", with_views(V_INTRADAY, _PTS + """
SELECT ticker AS ticker_requested, ticker AS ticker_returned, 'OK' AS business_status_code,
       strftime(trade_date, '%Y-%m-%d') || ' 18:00:00' AS message_datetime, strftime(trade_date, '%Y-%m-%d') AS trade_date,
       CAST(NULL AS VARCHAR) AS collected_at, CAST(n AS INTEGER) AS points_count, CAST(pos AS INTEGER) AS pos,
       strftime(quoted_at, '%H:%M:%S') AS quote_time, CAST(close_price AS DECIMAL(18,6)) AS close_price,
       CAST(price_fluctuation_pct AS DECIMAL(10,4)) AS price_fluctuation_percentage
FROM pe
UNION ALL
SELECT DISTINCT ticker, ticker || 'F', 'CLOSED', NULL, '2003-01-02', '2003-01-02T21:00:00', 0, NULL, NULL, NULL, NULL FROM v_intraday"""))
def payload_batch_records(spark, sf_dir):
    """Every field of every record, empty histories included."""
    landed = LD.landed_payloads(spark, sf_dir).withColumn("collected_at", F.lit(None).cast("string"))
    closed = landed.select("requested_ticker").distinct().select(
        "requested_ticker",
        F.concat(F.lit('{"BizSts":{"cd":"CLOSED"},"Msg":{"dtTm":""},"TradgFlr":{"date":"2003-01-02","scty":{"symb":"'), F.lower("requested_ticker"), F.lit('f","lstQtn":[]}}}')).alias("body"),
        F.lit(200).alias("http_status"), F.lit("2003-01-02").cast("date").alias("load_date"), F.lit("2003-01-02T21:00:00").alias("collected_at"))
    r = PL.payload_records(landed.unionByName(closed)).select("record.*")
    head = [c for c in r.columns if c != "price_history"]
    x = r.select(*head, F.posexplode_outer("price_history").alias("pos", "p"))
    return x.select(*head, "pos", F.col("p.quote_time").alias("quote_time"), F.col("p.close_price").cast("decimal(18,6)").alias("close_price"),
                    F.col("p.price_fluctuation_percentage").cast("decimal(10,4)").alias("price_fluctuation_percentage"))
