"""Candle queries."""

from __future__ import annotations

from candlewick.operators import candles as C
from candlewick.plans import market_tables as M
from candlewick.plans.catalog import register
from candlewick.plans.oracle_views import DAILY_VIEWS, V_INTRADAY, with_views

LAST_N = 8


def _intraday_body(code: str, step: int) -> str:
    return f"""
SELECT ticker, '{code}' AS "interval",
       time_bucket(INTERVAL '{step} seconds', quoted_at, TIMESTAMP '1970-01-01') AS start_time,
       time_bucket(INTERVAL '{step} seconds', quoted_at, TIMESTAMP '1970-01-01') + INTERVAL '{step} seconds' AS end_time,
       arg_min(close_price, quoted_at) AS open,
       max(close_price) AS high,
       min(close_price) AS low,
       arg_max(close_price, quoted_at) AS close,
       CAST(NULL AS DOUBLE) AS volume,
       count(*) AS point_count
FROM v_intraday WHERE close_price IS NOT NULL
GROUP BY ticker, time_bucket(INTERVAL '{step} seconds', quoted_at, TIMESTAMP '1970-01-01')"""


def _intraday_sql(code: str, step: int) -> str:
    return with_views(V_INTRADAY, _intraday_body(code, step))


def _make_intraday(code: str):
    def q(spark, sf_dir):
        return C.intraday_candles(M.intraday_points(spark, sf_dir), code)
    q.__name__ = f"candles_{code}"
    return q


for _code, _step in C.INTRADAY_INTERVALS.items():
    register(f"candles_{_code}", _intraday_sql(_code, _step))(_make_intraday(_code))


@register("candles_1d", with_views(DAILY_VIEWS, """
SELECT ticker, '1d' AS "interval",
       CAST(trade_date AS TIMESTAMP) AS start_time,
       CAST(trade_date AS TIMESTAMP) + INTERVAL 1 DAY AS end_time,
       last_price AS open,
       coalesce(max_price, last_price) AS high,
       coalesce(min_price, last_price) AS low,
       last_price AS close,
       CAST(financial_volume AS DOUBLE) AS volume,
       CAST(NULL AS BIGINT) AS point_count
FROM v_quotes"""))
def candles_1d(spark, sf_dir):
    return C.daily_candles(M.daily_quotes(spark, sf_dir))


def _candles_cte(code: str, step: int) -> str:
    return f"candles AS ({_intraday_body(code, step)})"


@register("candles_15m_last_n", with_views(V_INTRADAY + ",\n" + _candles_cte("15m", 900), f"""
SELECT ticker, "interval", start_time, end_time, open, high, low, close, volume, point_count FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY start_time DESC) AS rn FROM candles) x
WHERE rn <= {LAST_N}"""))
def candles_15m_last_n(spark, sf_dir):
    return C.last_candles(C.intraday_candles(M.intraday_points(spark, sf_dir), "15m"), LAST_N)
