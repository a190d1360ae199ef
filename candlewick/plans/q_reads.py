"""Read queries: latest values, histories, lookups, movers, pages
(J4, T1-T12, F5, F7, F8, A3-A5, C21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import latest as L
from candlewick.operators import market as MK
from candlewick.operators import page_index as PX
from candlewick.operators import pages as PG
from candlewick.plans import market_tables as M
from candlewick.plans.catalog import register
from candlewick.plans.oracle_views import ALL_MARKET_VIEWS, DAILY_VIEWS, V_ASSETS, V_INTRADAY, with_settled_quotes, with_views
from candlewick.session import scratch_path

# Fixed query parameters.
HISTORY_N = 5
RANGE_START, RANGE_END = "1998-01-01", "1998-03-31"
LOOKUP_TICKER, LOOKUP_DATE = "S0000000007", "1998-03-09"
INTRADAY_DAY = "2024-01-04"
OVERVIEW_DAY = "1998-03-09"
SEARCH_Q, PAGE_LIMIT, PAGE_OFFSET = "#00000001", 5, 2
TRADES_PAGE_LIMIT, TRADES_PAGE_OFFSET = 50, 20

QUOTE_COLS = "ticker, trade_date, last_price, min_price, max_price, avg_price, variation_pct, financial_volume, trade_count, source_file_name"
TRADE_COLS = "ticker, trade_date, open_price, last_price, min_price, max_price, avg_price, variation_pct, financial_volume, trade_count, source_file_name"
POINT_COLS = "ticker, quoted_at, trade_date, close_price, price_fluctuation_pct, source_jsonl"


@register("latest_per_ticker", with_views(DAILY_VIEWS, f"""
SELECT {QUOTE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn FROM v_quotes) x
WHERE rn = 1"""))
def latest_per_ticker(spark, sf_dir):
    return L.latest_per_key(M.daily_quotes(spark, sf_dir), "trade_date")


@register("latest_point", with_views(V_INTRADAY, f"""
SELECT {POINT_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY quoted_at DESC) AS rn FROM v_intraday) x
WHERE rn = 1"""))
def latest_point(spark, sf_dir):
    return L.latest_per_key(M.intraday_points(spark, sf_dir), "quoted_at")


@register("history_last_n", with_views(DAILY_VIEWS, f"""
SELECT {QUOTE_COLS}, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rank FROM v_quotes) x
WHERE rank <= {HISTORY_N}"""))
def history_last_n(spark, sf_dir):
    return L.history_top_n(M.daily_quotes(spark, sf_dir), HISTORY_N, "trade_date")


@register("history_chronological", with_views(DAILY_VIEWS, f"""
SELECT {QUOTE_COLS}, row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn FROM v_quotes) x
WHERE rn <= {HISTORY_N}"""))
def history_chronological(spark, sf_dir):
    return L.history_chronological(M.daily_quotes(spark, sf_dir), HISTORY_N, "trade_date")


@register("trades_range", with_views(DAILY_VIEWS, f"""
SELECT {TRADE_COLS} FROM v_daily WHERE trade_date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'"""))
def trades_range(spark, sf_dir):
    return L.trades_filtered(M.daily_bars(spark, sf_dir), start=RANGE_START, end=RANGE_END)


@register("trade_lookup", with_views(DAILY_VIEWS, f"""
SELECT {TRADE_COLS} FROM v_daily WHERE ticker = '{LOOKUP_TICKER}' AND trade_date = DATE '{LOOKUP_DATE}'"""))
def trade_lookup(spark, sf_dir):
    return L.trades_filtered(M.daily_bars(spark, sf_dir), ticker=LOOKUP_TICKER, trade_date=LOOKUP_DATE)


@register("asset_lookup", with_views(V_ASSETS, f"""
SELECT * FROM v_assets WHERE ticker = '{LOOKUP_TICKER}'"""))
def asset_lookup(spark, sf_dir):
    return M.dim_assets(spark, sf_dir).where(F.col("ticker") == LOOKUP_TICKER)


@register("day_points", with_views(V_INTRADAY, f"""
SELECT {POINT_COLS} FROM v_intraday WHERE ticker = '{LOOKUP_TICKER}' AND trade_date = DATE '{INTRADAY_DAY}'"""))
def day_points(spark, sf_dir):
    return L.day_points(M.intraday_points(spark, sf_dir), LOOKUP_TICKER, INTRADAY_DAY)


@register("intraday_range", with_views(V_INTRADAY, f"""
SELECT {POINT_COLS} FROM v_intraday
WHERE quoted_at BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'"""))
def intraday_range(spark, sf_dir):
    return L.in_range(M.intraday_points(spark, sf_dir), "quoted_at",
                      F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-12 12:00:00").cast("timestamp_ntz"))


@register("date_bounds", with_views(DAILY_VIEWS, """
SELECT ticker, min(trade_date) AS quotes_min, max(trade_date) AS quotes_max FROM v_quotes GROUP BY ticker"""))
def date_bounds(spark, sf_dir):
    return L.date_bounds(M.daily_quotes(spark, sf_dir), "trade_date", "quotes")


def _movers_sql(order: str) -> str:
    return with_views(DAILY_VIEWS, f"""
SELECT trade_date, ticker, variation_pct, last_price, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY {order}, ticker ASC) AS rank
  FROM v_quotes WHERE variation_pct IS NOT NULL) x
WHERE rank <= 10""")


def _ranks_sql(measure: str) -> str:
    return with_views(DAILY_VIEWS, f"""
SELECT trade_date, ticker, trade_count, financial_volume, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY {measure} DESC NULLS LAST, ticker ASC) AS rank
  FROM v_daily) x
WHERE rank <= 10""")


@register("top_gainers", _movers_sql("variation_pct DESC"))
def top_gainers(spark, sf_dir):
    return MK.top_gainers(M.daily_quotes(spark, sf_dir))


@register("top_losers", _movers_sql("variation_pct ASC"))
def top_losers(spark, sf_dir):
    return MK.top_losers(M.daily_quotes(spark, sf_dir))


@register("top_volume", _ranks_sql("financial_volume"))
def top_volume(spark, sf_dir):
    return MK.top_by(M.daily_bars(spark, sf_dir), "financial_volume")


@register("top_trade_count", _ranks_sql("trade_count"))
def top_trade_count(spark, sf_dir):
    return MK.top_by(M.daily_bars(spark, sf_dir), "trade_count")


@register("traded_assets", with_views(DAILY_VIEWS, """
SELECT trade_date, count(DISTINCT ticker) AS traded_assets_count FROM v_daily GROUP BY trade_date"""))
def traded_assets(spark, sf_dir):
    return MK.traded_assets(M.daily_bars(spark, sf_dir))


def _overview_sql(day_filter: str) -> str:
    return with_views(DAILY_VIEWS, f"""
, q AS (SELECT * FROM v_quotes {day_filter}),
t AS (SELECT * FROM v_daily {day_filter}),
g AS (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY variation_pct DESC, ticker) AS rank FROM q WHERE variation_pct IS NOT NULL),
l AS (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY variation_pct ASC, ticker) AS rank FROM q WHERE variation_pct IS NOT NULL),
v AS (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY financial_volume DESC NULLS LAST, ticker) AS rank FROM t),
c AS (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY trade_count DESC NULLS LAST, ticker) AS rank FROM t)
SELECT trade_date, 'top_gainers' AS section, CAST(rank AS INTEGER) AS rank, ticker, variation_pct, last_price, CAST(NULL AS BIGINT) AS trade_count, CAST(NULL AS DOUBLE) AS financial_volume FROM g WHERE rank <= 10
UNION ALL SELECT trade_date, 'top_losers', CAST(rank AS INTEGER), ticker, variation_pct, last_price, NULL, NULL FROM l WHERE rank <= 10
UNION ALL SELECT trade_date, s.section, CAST(rank AS INTEGER), ticker, NULL, NULL, trade_count, financial_volume
  FROM v CROSS JOIN (VALUES ('most_traded_by_volume'), ('most_traded_by_financial_volume')) s(section) WHERE rank <= 10
UNION ALL SELECT trade_date, 'highest_trade_count', CAST(rank AS INTEGER), ticker, NULL, NULL, trade_count, financial_volume FROM c WHERE rank <= 10
UNION ALL SELECT trade_date, 'traded_assets_count', NULL, NULL, NULL, NULL, count(DISTINCT ticker), NULL FROM t GROUP BY trade_date""")


@register("market_overview", _overview_sql(""))
def market_overview(spark, sf_dir):
    return MK.market_overview(None, M.daily_bars(spark, sf_dir, by_rows=True))


@register("market_overview_two_tables", with_settled_quotes(_overview_sql("")))
def market_overview_two_tables(spark, sf_dir):
    """T4 with quotes and trades of different rows."""
    return MK.market_overview(M.settled_quotes(spark, sf_dir), M.daily_bars(spark, sf_dir, by_rows=True))


@register("market_overview_day", _overview_sql(f"WHERE trade_date = DATE '{OVERVIEW_DAY}'"))
def market_overview_day(spark, sf_dir):
    return MK.market_overview(None, M.daily_bars(spark, sf_dir), trade_date=OVERVIEW_DAY)


@register("asset_search", with_views(V_ASSETS, f"""
SELECT *, (SELECT count(*) FROM v_assets WHERE contains(upper(ticker), '{SEARCH_Q}') OR contains(upper(asset_name), '{SEARCH_Q}')) AS total
FROM v_assets WHERE contains(upper(ticker), '{SEARCH_Q}') OR contains(upper(asset_name), '{SEARCH_Q}')
ORDER BY ticker LIMIT {PAGE_LIMIT} OFFSET {PAGE_OFFSET}"""))
def asset_search(spark, sf_dir):
    return PG.assets_page(M.dim_assets(spark, sf_dir), SEARCH_Q, PAGE_LIMIT, PAGE_OFFSET)


@register("asset_page", with_views(V_ASSETS, f"""
SELECT *, (SELECT count(*) FROM v_assets) AS total FROM v_assets ORDER BY ticker LIMIT 20 OFFSET 10"""))
def asset_page(spark, sf_dir):
    return PG.assets_page(M.dim_assets(spark, sf_dir), None, 20, 10)


@register("trades_page", with_views(DAILY_VIEWS, f"""
SELECT {TRADE_COLS}, (SELECT count(*) FROM v_daily WHERE trade_date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}') AS total
FROM v_daily WHERE trade_date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'
ORDER BY trade_date DESC, ticker ASC LIMIT {TRADES_PAGE_LIMIT} OFFSET {TRADES_PAGE_OFFSET}"""))
def trades_page(spark, sf_dir):
    t = L.trades_filtered(M.daily_bars(spark, sf_dir), start=RANGE_START, end=RANGE_END)
    return PG.trades_page(t, TRADES_PAGE_LIMIT, TRADES_PAGE_OFFSET)


DEEP_LIMIT, DEEP_OFFSET, DEEP_RANGE = 60, 4_970, 5_000


@register("deep_page", with_views(DAILY_VIEWS, f"""
SELECT {TRADE_COLS}, (SELECT count(*) FROM v_daily) AS total FROM v_daily
ORDER BY trade_date DESC, ticker ASC LIMIT {DEEP_LIMIT} OFFSET {DEEP_OFFSET}"""))
def deep_page(spark, sf_dir):
    """T6 far down the list: the page reads the ranges it touches of an index
    written once."""
    path = scratch_path(spark, "trades-index")
    PX.write_index(M.daily_bars(spark, sf_dir), [F.col("trade_date").desc(), F.col("ticker").asc()], path, rows_per_range=DEEP_RANGE)
    return PX.indexed_page(spark, path, DEEP_LIMIT, DEEP_OFFSET)
