"""Historical fixed-width queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import pages as PG
from candlewick.plans import landing as LD
from candlewick.plans import market_tables as M
from candlewick.plans.catalog import register
from candlewick.plans.oracle_views import HIST_VIEWS, with_views
from candlewick.sources import fixed_width as FW

HIST_COLS = ("file_name, line_no, trade_date, ticker, codneg, cod_bdi, tp_merc, nomres, especi, prazo_term_days, "
             "moeda_ref, open_price, max_price, min_price, avg_price, last_price, best_bid, best_ask, trade_count, "
             "quantity_total, volume_financial, strike_price, ind_opc, expiration_date, expiration_key, "
             "quotation_factor, strike_points, isin, distribution_num, source_file_name")
PAGE_START, PAGE_END = "1997-01-01", "1998-12-31"


def _lines(spark, sf_dir):
    return LD.landed(spark, sf_dir, "hist", M.hist_lines)


def historical(spark, sf_dir):
    """The historical table: parsed records, last row per natural key."""
    return FW.dedupe_last(FW.parse_lines(_lines(spark, sf_dir)))


def hist_dates(spark, sf_dir):
    """Ticker and trade date of every historical row; both are part of the
    natural key, so date bounds need no last-wins step."""
    return FW.parse_lines(_lines(spark, sf_dir)).select("ticker", "trade_date")


@register("fixed_width_parse", with_views(HIST_VIEWS, f"SELECT {HIST_COLS} FROM hist_rows"))
def fixed_width_parse(spark, sf_dir):
    return FW.parse_lines(_lines(spark, sf_dir))


@register("hist_dedupe_last", with_views(HIST_VIEWS, f"SELECT {HIST_COLS} FROM hist"))
def hist_dedupe_last(spark, sf_dir):
    return historical(spark, sf_dir)


@register("fixed_width_stats", with_views(HIST_VIEWS, """
, base AS (
  SELECT file_name, count(*) AS lines_read,
         count(*) FILTER (WHERE length(line) = 245 AND substr(line, 1, 2) = '00') AS header_rows,
         count(*) FILTER (WHERE length(line) = 245 AND substr(line, 1, 2) = '99') AS trailer_rows,
         count(*) FILTER (WHERE length(line) = 245 AND substr(line, 1, 2) = '01') AS quote_rows,
         count(*) FILTER (WHERE length(line) <> 245) AS skipped_wrong_length,
         count(*) FILTER (WHERE length(line) = 245 AND substr(line, 1, 2) NOT IN ('00', '01', '99')) AS skipped_unknown_tip
  FROM hist_lines GROUP BY file_name),
per_key AS (
  SELECT file_name, count(*) AS n FROM hist_rows
  GROUP BY file_name, trade_date, codneg, cod_bdi, tp_merc, especi, prazo_term_days, moeda_ref,
           expiration_key, isin, distribution_num, ind_opc),
dup AS (SELECT file_name, sum(n) AS normalized_valid, sum(n - 1) AS in_file_duplicate_keys FROM per_key GROUP BY file_name)
SELECT b.file_name, lines_read, header_rows, trailer_rows, quote_rows, skipped_wrong_length, skipped_unknown_tip,
       CAST(coalesce(normalized_valid, 0) AS BIGINT) AS normalized_valid,
       CAST(quote_rows - coalesce(normalized_valid, 0) AS BIGINT) AS normalized_invalid,
       CAST(coalesce(in_file_duplicate_keys, 0) AS BIGINT) AS in_file_duplicate_keys
FROM base b LEFT JOIN dup d ON b.file_name = d.file_name"""))
def fixed_width_stats(spark, sf_dir):
    return FW.parse_stats(_lines(spark, sf_dir))


_HP = r"^00COTAHIST\.(\d{4})BOVESPA (\d{8})"
_TP = r"^99COTAHIST\.(\d{4})BOVESPA (\d{8})(\d{11})"


@register("hist_meta", with_views(HIST_VIEWS, f"""
, m AS (
  SELECT file_name,
         arg_min(trim(line), line_no) FILTER (WHERE length(line) = 245 AND substr(line, 1, 2) = '00') AS h,
         arg_max(trim(line), line_no) FILTER (WHERE length(line) = 245 AND substr(line, 1, 2) = '99') AS t,
         count(*) FILTER (WHERE length(line) = 245 AND substr(line, 1, 2) = '01') AS quote_records
  FROM hist_lines GROUP BY file_name)
SELECT file_name,
       CASE WHEN regexp_matches(h, '{_HP}') THEN TRY_CAST(regexp_extract(h, '{_HP}', 1) AS INTEGER) END AS header_year,
       CASE WHEN regexp_matches(h, '{_HP}') THEN regexp_extract(h, '{_HP}', 2) END AS header_file_date,
       CASE WHEN regexp_matches(t, '{_TP}') THEN TRY_CAST(regexp_extract(t, '{_TP}', 1) AS INTEGER) END AS trailer_year,
       CASE WHEN regexp_matches(t, '{_TP}') THEN regexp_extract(t, '{_TP}', 2) END AS trailer_file_date,
       CASE WHEN regexp_matches(t, '{_TP}') THEN TRY_CAST(regexp_extract(t, '{_TP}', 3) AS BIGINT) END AS declared_records,
       quote_records,
       (CASE WHEN regexp_matches(t, '{_TP}') THEN TRY_CAST(regexp_extract(t, '{_TP}', 3) AS BIGINT) END) = quote_records AS count_matches
FROM m"""))
def hist_meta(spark, sf_dir):
    return FW.file_metadata(_lines(spark, sf_dir))


_PAGE_COLS = HIST_COLS.replace("last_price", "last_price AS close_price")


@register("hist_page", with_views(HIST_VIEWS, f"""
, f AS (SELECT * FROM hist WHERE tp_merc = '010' AND trade_date BETWEEN DATE '{PAGE_START}' AND DATE '{PAGE_END}')
SELECT {_PAGE_COLS}, (SELECT count(*) FROM f) AS total FROM f
ORDER BY trade_date DESC, ticker ASC, codneg, cod_bdi, tp_merc, especi, prazo_term_days, moeda_ref,
         expiration_key, isin, distribution_num, ind_opc
LIMIT 25 OFFSET 5"""))
def hist_page(spark, sf_dir):
    h = PG.hist_filtered(historical(spark, sf_dir), tp_merc="010", start=PAGE_START, end=PAGE_END)
    return PG.hist_page(h, 25, 5)


@register("hist_date_bounds", with_views(HIST_VIEWS, """
SELECT ticker, min(trade_date) AS hist_min, max(trade_date) AS hist_max FROM hist GROUP BY ticker"""))
def hist_date_bounds(spark, sf_dir):
    return hist_dates(spark, sf_dir).groupBy("ticker").agg(
        F.min("trade_date").alias("hist_min"), F.max("trade_date").alias("hist_max"))
