"""Universe and session-gate queries."""

from __future__ import annotations

from candlewick.operators import universe as U
from candlewick.plans import market_tables as M
from candlewick.plans.catalog import register
from candlewick.plans.oracle_views import DAILY_VIEWS, V_INTRADAY, ticker, with_views

REF = M.UNIVERSE_REFERENCE_DATE

_REG = f""", span AS (SELECT l_suppkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_suppkey),
reg AS (
  SELECT s.s_suppkey AS line_no, {ticker('s.s_suppkey')} AS ticker,
         CASE WHEN n.n_regionkey = 0 THEN 'segment'
              WHEN s.s_acctbal < 0 THEN 'market'
              WHEN n.n_regionkey = 4 THEN 'category'
              WHEN CAST(sp.first_ship AS DATE) > DATE '{REF}' THEN 'start'
              WHEN s.s_acctbal < 1000 AND CAST(sp.last_ship AS DATE) < DATE '{REF}' THEN 'end' END AS reject
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN span sp ON s.s_suppkey = sp.l_suppkey),
act AS (SELECT DISTINCT ticker FROM v_daily
        WHERE trade_date <= DATE '{REF}' AND trade_date > DATE '{REF}' - INTERVAL 30 DAY AND trade_count >= 2)"""


def _universe(spark, sf_dir):
    master = U.master_list(M.universe_register(spark, sf_dir), REF)
    return U.ticker_universe(master, U.active_list(M.activity_rows(spark, sf_dir)))


@register("universe", with_views(DAILY_VIEWS, _REG + """
SELECT ticker, line_no AS register_order, ticker IN (SELECT ticker FROM act) AS in_strict,
       ticker NOT IN (SELECT ticker FROM act) AS master_only,
       CASE WHEN ticker IN (SELECT ticker FROM act) THEN 'strict' ELSE 'master_only' END AS status
FROM reg WHERE reject IS NULL"""))
def universe(spark, sf_dir):
    return _universe(spark, sf_dir)


@register("universe_strict", with_views(DAILY_VIEWS, _REG + """
SELECT ticker, line_no AS register_order FROM reg WHERE reject IS NULL AND ticker IN (SELECT ticker FROM act)"""))
def universe_strict(spark, sf_dir):
    return _universe(spark, sf_dir).where("in_strict").select("ticker", "register_order")


@register("universe_master_only", with_views(DAILY_VIEWS, _REG + """
SELECT ticker, line_no AS register_order FROM reg WHERE reject IS NULL AND ticker NOT IN (SELECT ticker FROM act)"""))
def universe_master_only(spark, sf_dir):
    return _universe(spark, sf_dir).where("master_only").select("ticker", "register_order")


@register("universe_fallback", with_views(DAILY_VIEWS, _REG + """
SELECT ticker, line_no AS register_order, TRUE AS in_strict, FALSE AS master_only, 'master_only_fallback' AS status
FROM reg WHERE reject IS NULL"""))
def universe_fallback(spark, sf_dir):
    return U.ticker_universe(U.master_list(M.universe_register(spark, sf_dir), REF), None)


@register("universe_counters", with_views(DAILY_VIEWS, _REG + """
SELECT coalesce(reject, 'kept') AS outcome, count(*) AS rows FROM reg GROUP BY 1
UNION ALL SELECT 'noise', count(*) FROM nation"""))
def universe_counters(spark, sf_dir):
    return U.master_counters(M.universe_register(spark, sf_dir), REF)


@register("session_filter", with_views(V_INTRADAY, """
SELECT ticker, quoted_at, close_price FROM v_intraday
WHERE strftime((quoted_at AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo', '%H:%M:%S.%f')
      BETWEEN '09:50:00.000000' AND '17:10:00.000000'"""))
def session_filter(spark, sf_dir):
    return M.intraday_points(spark, sf_dir).where(U.within_session("quoted_at")).select("ticker", "quoted_at", "close_price")
