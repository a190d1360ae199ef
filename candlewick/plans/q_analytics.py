"""Coverage, overview and indicator queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import coverage as CV
from candlewick.operators import indicators as IND
from candlewick.operators import summary as SM
from candlewick.plans import landing as LD
from candlewick.plans import market_tables as M
from candlewick.plans.catalog import ORACLES, register
from candlewick.plans.oracle_views import ALL_MARKET_VIEWS, DAILY_VIEWS, HIST_VIEWS, half_up, with_settled_quotes, with_views
from candlewick.plans.q_hist import hist_dates
from candlewick.session import scratch_path

SMA_P, EMA_P, RSI_P = 5, 10, 14
WIN_IND, WIN_P, WIN_START, WIN_END, WIN_LIMIT = "EMA", 3, "1997-01-01", "1999-12-31", 20


def _sources(spark, sf_dir, trades):
    # The daily quotes are the daily trades without a column: one read for both.
    return M.dim_assets(spark, sf_dir), None, trades, M.intraday_points(spark, sf_dir), hist_dates(spark, sf_dir)


@register("coverage", with_views(ALL_MARKET_VIEWS + ",\n" + HIST_VIEWS, """
, u AS (
  SELECT ticker, 'asset' AS src, CAST(NULL AS DATE) AS d FROM v_assets
  UNION ALL SELECT ticker, 'quote', trade_date FROM v_quotes
  UNION ALL SELECT ticker, 'trade', trade_date FROM v_daily
  UNION ALL SELECT ticker, 'intraday', CAST(quoted_at AS DATE) FROM v_intraday
  UNION ALL SELECT ticker, 'hist', trade_date FROM hist)
SELECT ticker, bool_or(src = 'asset') AS has_asset_master,
       min(d) FILTER (WHERE src = 'quote') AS quote_min, max(d) FILTER (WHERE src = 'quote') AS quote_max,
       min(d) FILTER (WHERE src = 'trade') AS trade_min, max(d) FILTER (WHERE src = 'trade') AS trade_max,
       min(d) FILTER (WHERE src = 'intraday') AS intraday_min, max(d) FILTER (WHERE src = 'intraday') AS intraday_max,
       min(d) FILTER (WHERE src = 'hist') AS hist_min, max(d) FILTER (WHERE src = 'hist') AS hist_max
FROM u GROUP BY ticker"""))
def coverage(spark, sf_dir):
    # Date bounds of the daily bars are those of the trades they sum up.
    return CV.asset_coverage(*_sources(spark, sf_dir, M.unit_trades(spark, sf_dir)))


@register("overview", with_views(ALL_MARKET_VIEWS + ",\n" + HIST_VIEWS, """
, tk AS (SELECT ticker FROM v_assets UNION SELECT ticker FROM v_quotes UNION SELECT ticker FROM v_daily
         UNION SELECT ticker FROM v_intraday UNION SELECT ticker FROM hist),
lq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn FROM v_quotes) x WHERE rn = 1),
lt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn FROM v_daily) x WHERE rn = 1),
lf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY quoted_at DESC) AS rn FROM v_intraday) x WHERE rn = 1),
bq AS (SELECT ticker, min(trade_date) AS quotes_min, max(trade_date) AS quotes_max FROM v_quotes GROUP BY ticker),
bt AS (SELECT ticker, min(trade_date) AS trades_min, max(trade_date) AS trades_max FROM v_daily GROUP BY ticker),
bh AS (SELECT ticker, min(trade_date) AS hist_min, max(trade_date) AS hist_max FROM hist GROUP BY ticker)
SELECT tk.ticker, a.asset_name, a.isin, a.segment,
       lq.trade_date AS quote_date, lq.last_price AS quote_last_price,
       lt.trade_date AS trade_date, lt.last_price AS trade_last_price, lt.trade_count AS trade_count,
       lf.quoted_at AS intraday_at, lf.close_price AS intraday_close_price,
       quotes_min, quotes_max, trades_min, trades_max, hist_min, hist_max,
       lq.variation_pct AS variation_pct_latest,
       coalesce(lq.financial_volume, lt.financial_volume) AS financial_volume_latest,
       greatest(CAST(lq.trade_date AS TIMESTAMP), CAST(lt.trade_date AS TIMESTAMP), lf.quoted_at) AS latest_update_at,
       a.ticker IS NOT NULL AS has_asset, lq.ticker IS NOT NULL AS has_daily_quote,
       lt.ticker IS NOT NULL AS has_daily_trade, lf.ticker IS NOT NULL AS has_intraday
FROM tk
LEFT JOIN v_assets a ON a.ticker = tk.ticker
LEFT JOIN lq ON lq.ticker = tk.ticker
LEFT JOIN lt ON lt.ticker = tk.ticker
LEFT JOIN lf ON lf.ticker = tk.ticker
LEFT JOIN bq ON bq.ticker = tk.ticker
LEFT JOIN bt ON bt.ticker = tk.ticker
LEFT JOIN bh ON bh.ticker = tk.ticker"""))
def overview(spark, sf_dir):
    return CV.asset_overview(*_sources(spark, sf_dir, M.daily_bars(spark, sf_dir)))


def _two_tables(spark, sf_dir, trades):
    return M.dim_assets(spark, sf_dir), M.settled_quotes(spark, sf_dir), trades, M.intraday_points(spark, sf_dir), hist_dates(spark, sf_dir)


@register("coverage_two_tables", with_settled_quotes(ORACLES["coverage"]))
def coverage_two_tables(spark, sf_dir):
    """J5 with quotes and trades of different rows."""
    return CV.asset_coverage(*_two_tables(spark, sf_dir, M.unit_trades(spark, sf_dir)))


@register("overview_two_tables", with_settled_quotes(ORACLES["overview"]))
def overview_two_tables(spark, sf_dir):
    """J6 with quotes and trades of different rows."""
    return CV.asset_overview(*_two_tables(spark, sf_dir, M.daily_bars(spark, sf_dir)))


LOADS = 3


def _kept_summary(spark, sf_dir):
    """The summary after ``LOADS`` loads that bring the tables' rows in any order of their days."""
    part = F.pmod(F.xxhash64("ticker", F.col("day")), F.lit(LOADS))
    # Landed once: every load reads them.
    tables = {"quote": LD.landed(spark, sf_dir, "settled", M.settled_quotes), "trade": LD.landed(spark, sf_dir, "bars", M.daily_bars),
              "intraday": LD.landed(spark, sf_dir, "points", M.intraday_points), "hist": LD.landed(spark, sf_dir, "hist-dates", hist_dates)}
    path = scratch_path(spark, "summary")
    for load in range(LOADS):
        sources = {n: df.withColumn("day", F.col("trade_date")).where(part == load) for n, df in tables.items()}
        if load == 1:
            sources["asset"] = M.dim_assets(spark, sf_dir)
        SM.merge_load(spark, path, load, sources, shards=8)
    return spark.read.parquet(path)


@register("coverage_kept", ORACLES["coverage_two_tables"])
def coverage_kept(spark, sf_dir):
    """J5 from the summary that loads keep up to date."""
    return SM.coverage_of(_kept_summary(spark, sf_dir))


@register("overview_kept", ORACLES["overview_two_tables"])
def overview_kept(spark, sf_dir):
    """J6 from the summary that loads keep up to date."""
    return SM.overview_of(_kept_summary(spark, sf_dir))


def _series_cte(where: str = "") -> str:
    return f""", s AS (
  SELECT ticker, trade_date, last_price AS x, CAST(round(last_price * 1000000) AS BIGINT) AS xm,
         row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS i
  FROM v_quotes WHERE last_price IS NOT NULL {where})"""


def _sma_sql(p: int) -> str:
    return with_views(DAILY_VIEWS, _series_cte() + f"""
SELECT ticker, trade_date,
       CASE WHEN i >= {p} THEN floor((sum(xm) OVER (PARTITION BY ticker ORDER BY i ROWS BETWEEN {p - 1} PRECEDING AND CURRENT ROW) + {50 * p}) / {100 * p}) / CAST(10000 AS DOUBLE) END AS value
FROM s""")


def _ema_body(p: int) -> str:
    alpha = 2.0 / (p + 1)
    keep = 1.0 - alpha
    return f""",
ema(ticker, i, e) AS (
  SELECT ticker, CAST({p} AS BIGINT), CAST(sum(xm) AS DOUBLE) / CAST({p * 1_000_000} AS DOUBLE)
  FROM s WHERE i <= {p} GROUP BY ticker HAVING count(*) = {p}
  UNION ALL
  SELECT s.ticker, s.i, CAST('{alpha!r}' AS DOUBLE) * s.x + CAST('{keep!r}' AS DOUBLE) * ema.e
  FROM ema JOIN s ON s.ticker = ema.ticker AND s.i = ema.i + 1)"""


def _ema_sql(p: int, where: str = "", limit: int | None = None, label: str | None = None) -> str:
    extra = f", '{label}' AS indicator, {p} AS period" if label else ""
    body = f"""
SELECT s.ticker, s.trade_date, {half_up('ema.e', 4)} AS value{extra}
FROM s LEFT JOIN ema ON s.ticker = ema.ticker AND s.i = ema.i"""
    if limit is not None:
        body = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn FROM ({body}) y) z
WHERE rn <= {limit}"""
    return with_views(DAILY_VIEWS, _series_cte(where) + _ema_body(p) + body, recursive=True)


def _rsi_sql(p: int) -> str:
    rs = "CASE WHEN al = 0 AND ag = 0 THEN CAST(1 AS DOUBLE) WHEN al = 0 THEN CAST(1e9 AS DOUBLE) ELSE ag / al END"
    return with_views(DAILY_VIEWS, _series_cte() + f""",
g AS (
  SELECT ticker, trade_date, i,
         CASE WHEN xm - lag(xm) OVER (PARTITION BY ticker ORDER BY i) > 0 THEN xm - lag(xm) OVER (PARTITION BY ticker ORDER BY i) ELSE 0 END AS gm,
         CASE WHEN xm - lag(xm) OVER (PARTITION BY ticker ORDER BY i) < 0 THEN lag(xm) OVER (PARTITION BY ticker ORDER BY i) - xm ELSE 0 END AS lm
  FROM s),
r(ticker, i, ag, al) AS (
  SELECT ticker, CAST({p + 1} AS BIGINT), CAST(sum(gm) AS DOUBLE) / CAST({p} AS DOUBLE), CAST(sum(lm) AS DOUBLE) / CAST({p} AS DOUBLE)
  FROM g WHERE i BETWEEN 2 AND {p + 1} GROUP BY ticker HAVING count(*) = {p}
  UNION ALL
  SELECT g.ticker, g.i, (r.ag * CAST({p - 1} AS DOUBLE) + CAST(g.gm AS DOUBLE)) / CAST({p} AS DOUBLE),
         (r.al * CAST({p - 1} AS DOUBLE) + CAST(g.lm AS DOUBLE)) / CAST({p} AS DOUBLE)
  FROM r JOIN g ON g.ticker = r.ticker AND g.i = r.i + 1),
rv AS (SELECT ticker, i, CAST(100 AS DOUBLE) - CAST(100 AS DOUBLE) / (CAST(1 AS DOUBLE) + {rs}) AS v FROM r)
SELECT s.ticker, s.trade_date, {half_up('rv.v', 4)} AS value
FROM s LEFT JOIN rv ON s.ticker = rv.ticker AND s.i = rv.i""", recursive=True)


@register("sma", _sma_sql(SMA_P))
def sma_q(spark, sf_dir):
    return IND.sma(IND.daily_closes(M.daily_quotes(spark, sf_dir)), SMA_P)


@register("ema", _ema_sql(EMA_P))
def ema_q(spark, sf_dir):
    return IND.ema(IND.daily_closes(M.daily_quotes(spark, sf_dir)), EMA_P)


@register("rsi", _rsi_sql(RSI_P))
def rsi_q(spark, sf_dir):
    return IND.rsi(IND.daily_closes(M.daily_quotes(spark, sf_dir)), RSI_P)


@register("indicator_window", _ema_sql(WIN_P, f"AND trade_date BETWEEN DATE '{WIN_START}' AND DATE '{WIN_END}'",
                                       WIN_LIMIT, WIN_IND))
def indicator_window(spark, sf_dir):
    return IND.indicator_series(M.daily_quotes(spark, sf_dir), WIN_IND, WIN_P, start=WIN_START, end=WIN_END,
                                limit=WIN_LIMIT)


@register("indicator_envelope", with_views(DAILY_VIEWS, f"""
SELECT ticker, min(trade_date) AS source_start, max(trade_date) AS source_end, count(*) AS source_points
FROM v_quotes WHERE last_price IS NOT NULL AND trade_date BETWEEN DATE '{WIN_START}' AND DATE '{WIN_END}'
GROUP BY ticker"""))
def indicator_envelope(spark, sf_dir):
    return IND.indicator_envelope(M.daily_quotes(spark, sf_dir), start=WIN_START, end=WIN_END)
