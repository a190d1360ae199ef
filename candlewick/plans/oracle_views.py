"""ANSI SQL (DuckDB dialect) text of the market-table derivations.

Each oracle query is ``WITH <views> SELECT ...`` over the driver's
pre-registered test tables.  The SQL is written independently of the Spark
operators; it restates the *meaning* of each derived table so that the two
engines can be compared value by value.
"""

from __future__ import annotations


def half_up(x: str, digits: int) -> str:
    """Same arithmetic as ``candlewick.functions.numbers.half_up``."""
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(sign({x}) * floor(abs({x}) * {scale} + 0.5) / {scale})"


def ticker(key: str) -> str:
    return f"('S' || lpad(CAST({key} AS VARCHAR), 10, '0'))"


V_ASSETS = f"""v_assets AS (
  SELECT {ticker('s.s_suppkey')} AS ticker,
         s.s_name AS asset_name,
         'BRS' || lpad(CAST(s.s_suppkey AS VARCHAR), 9, '0') AS isin,
         n.n_name AS segment,
         CASE WHEN s.s_acctbal < 0 THEN 'UNIT' ELSE 'SHARES' END AS instrument_type,
         TRUE AS is_active,
         DATE '2001-12-31' AS source_file_date,
         s.s_acctbal AS acct_balance
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

V_UNIT = f"""v_unit AS (
  SELECT {ticker('l_suppkey')} AS ticker,
         CAST(l_shipdate AS DATE) AS trade_date,
         {half_up('l_extendedprice / l_quantity', 6)} AS px,
         l_extendedprice AS notional,
         l_quantity AS quantity,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem)"""

V_BARS = f"""v_bars AS (
  SELECT ticker, trade_date,
         arg_min(px, (l_orderkey, l_linenumber, l_partkey, notional)) AS open_price,
         arg_max(px, (l_orderkey, l_linenumber, l_partkey, notional)) AS last_price,
         min(px) AS min_price,
         max(px) AS max_price,
         (2 * sum(CAST(round(px * 1000000) AS BIGINT)) + count(*)) // (2 * count(*)) / CAST(1000000 AS DOUBLE) AS avg_price,
         {half_up('sum(notional)', 2)} AS financial_volume,
         count(*) AS trade_count
  FROM v_unit GROUP BY ticker, trade_date)"""

V_DAILY = f"""v_prev AS (
  SELECT *, lag(last_price) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev_last FROM v_bars),
v_daily AS (
  SELECT ticker, trade_date, open_price, last_price, min_price, max_price, avg_price,
         {half_up('(last_price - prev_last) / prev_last * 100', 4)} AS variation_pct,
         financial_volume, trade_count, 'lineitem' AS source_file_name
  FROM v_prev),
v_quotes AS (
  SELECT ticker, trade_date, last_price, min_price, max_price, avg_price, variation_pct,
         financial_volume, trade_count, source_file_name FROM v_daily)"""

V_QUOTES_OF_BARS = V_DAILY[V_DAILY.index("v_quotes AS ("):]
V_SETTLED = f"""v_settled AS (
  SELECT {ticker('o_custkey')} AS ticker, CAST(o_orderdate AS DATE) AS trade_date, max(o_totalprice) AS last_price,
         min(o_totalprice) AS min_price, max(o_totalprice) AS max_price, CAST(NULL AS DOUBLE) AS avg_price,
         CASE WHEN count(*) > 1 THEN {half_up('(max(o_totalprice) - min(o_totalprice)) / min(o_totalprice) * 100', 4)} END AS variation_pct,
         CASE WHEN count(*) > 1 THEN CAST(CAST(round(max(o_totalprice) * 100) AS BIGINT) AS DOUBLE) END AS financial_volume,
         count(*) AS trade_count, 'orders' AS source_file_name
  FROM orders GROUP BY 1, 2),
v_quotes AS (SELECT * FROM v_settled)"""


def with_settled_quotes(sql: str) -> str:
    """An oracle's text over a table of quotes of its own instead of the bars'."""
    return sql.replace(V_QUOTES_OF_BARS, V_SETTLED)


V_INTRADAY = f"""v_intraday AS (
  SELECT {ticker('user_id')} AS ticker,
         ts AS quoted_at,
         CAST(ts AS DATE) AS trade_date,
         value AS close_price,
         (CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) - 50.0) / 10.0 AS price_fluctuation_pct,
         'events' AS source_jsonl
  FROM events)"""

DAILY_VIEWS = ",\n".join([V_UNIT, V_BARS, V_DAILY])
ALL_MARKET_VIEWS = ",\n".join([V_ASSETS, V_UNIT, V_BARS, V_DAILY, V_INTRADAY])


def with_views(views: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{views}\n{body}"


def _price13(x: str) -> str:
    return f"lpad(CAST(CAST(round(({x}) * 100) AS BIGINT) AS VARCHAR), 13, '0')"


V_HIST_LINES = f"""h_base AS (
  SELECT 'COTAHIST_A' || CAST(year(o_orderdate) AS VARCHAR) || '.TXT' AS file_name,
         CAST(year(o_orderdate) AS VARCHAR) AS yr, o_orderkey, o_orderstatus, o_orderpriority,
         '01' || strftime(CAST(date_trunc('quarter', o_orderdate) AS DATE), '%Y%m%d') || '02'
         || rpad('S' || lpad(CAST(o_custkey AS VARCHAR), 10, '0'), 12, ' ')
         || '010'
         || rpad('CUST' || CAST(o_custkey AS VARCHAR), 12, ' ')
         || rpad(o_orderstatus, 10, ' ')
         || '   ' || 'R$  '
         || {_price13('o_totalprice')} || {_price13('o_totalprice + 100')} || {_price13('o_totalprice - 100')}
         || {_price13('o_totalprice')} || {_price13('o_totalprice + 50')} || {_price13('o_totalprice + 49')}
         || {_price13('o_totalprice + 51')}
         || lpad(CAST(day(o_orderdate) AS VARCHAR), 5, '0')
         || lpad(CAST(o_orderkey AS VARCHAR), 18, '0')
         || lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) * 10 AS VARCHAR), 18, '0')
         || '0000000000000' || ' '
         || CASE WHEN o_orderstatus = 'O' THEN '99991231' ELSE '00000000' END
         || '0000001' || '0000000000000'
         || 'BRS' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
         || '100' AS rec
  FROM orders),
h_files AS (SELECT file_name, yr, count(*) AS n FROM h_base GROUP BY file_name, yr),
hist_lines AS (
  SELECT file_name, o_orderkey * 2 + 1 AS line_no, rec AS line FROM h_base
  UNION ALL
  SELECT file_name, o_orderkey * 2 + 2,
         CASE WHEN o_orderstatus = 'P' THEN substr(rec, 1, 200) ELSE '02' || substr(rec, 3, 243) END
  FROM h_base WHERE o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
  UNION ALL
  SELECT file_name, CAST(0 AS BIGINT), rpad('00COTAHIST.' || yr || 'BOVESPA ' || yr || '1231', 245, ' ') FROM h_files
  UNION ALL
  SELECT file_name, CAST(9223372036854775807 AS BIGINT),
         rpad('99COTAHIST.' || yr || 'BOVESPA ' || yr || '1231' || lpad(CAST(n AS VARCHAR), 11, '0'), 245, ' ') FROM h_files)"""


def _digits(x: str, typ: str, factor: str | None) -> str:
    body = f"CAST(trim({x}) AS DECIMAL(18,0))" if factor is None else f"CAST(trim({x}) AS DECIMAL(18,0)) * CAST({factor} AS DECIMAL(8,6))"
    return f"CASE WHEN regexp_full_match(trim({x}), '[0-9]+') THEN CAST({body} AS {typ}) END"


def _ymd(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[0-9]{{8}}') THEN CAST(try_strptime(trim({x}), '%Y%m%d') AS DATE) END"


def _code(x: str, n: int, blank: str | None = None) -> str:
    b = blank if blank is not None else " " * n
    return f"CASE WHEN trim({x}) = '' THEN '{b}' ELSE rpad(substr(trim({x}), 1, {n}), {n}, ' ') END"


V_HIST_ROWS = f"""h_rec AS (
  SELECT file_name, line_no,
         substr(line, 3, 8) AS trade_date_raw, substr(line, 11, 2) AS cod_bdi, substr(line, 13, 12) AS codneg,
         substr(line, 25, 3) AS tp_merc, substr(line, 28, 12) AS nomres, substr(line, 40, 10) AS especi,
         substr(line, 50, 3) AS prazot, substr(line, 53, 4) AS modref, substr(line, 57, 13) AS preabe,
         substr(line, 70, 13) AS premax, substr(line, 83, 13) AS premin, substr(line, 96, 13) AS premed,
         substr(line, 109, 13) AS preult, substr(line, 122, 13) AS preofc, substr(line, 135, 13) AS preofv,
         substr(line, 148, 5) AS totneg, substr(line, 153, 18) AS quatot, substr(line, 171, 18) AS voltot,
         substr(line, 189, 13) AS preexe, substr(line, 202, 1) AS indopc, substr(line, 203, 8) AS datven,
         substr(line, 211, 7) AS fatcot, substr(line, 218, 13) AS ptoexe, substr(line, 231, 12) AS codisin,
         substr(line, 243, 3) AS dismes
  FROM hist_lines WHERE length(line) = 245 AND substr(line, 1, 2) = '01'),
h_rows0 AS (
  SELECT file_name, line_no,
         {_ymd('trade_date_raw')} AS trade_date,
         substr(upper(trim(codneg)), 1, 20) AS ticker,
         substr(upper(trim(codneg)), 1, 12) AS codneg,
         {_code('cod_bdi', 2)} AS cod_bdi,
         {_code('tp_merc', 3, '000')} AS tp_merc,
         CASE WHEN substr(trim(nomres), 1, 12) <> '' THEN substr(trim(nomres), 1, 12) END AS nomres,
         substr(trim(especi), 1, 10) AS especi,
         coalesce(CASE WHEN regexp_full_match(trim(prazot), '[0-9]+') THEN TRY_CAST(trim(prazot) AS INTEGER) END, -1) AS prazo_term_days,
         {_code('modref', 4)} AS moeda_ref,
         {_digits('preabe', 'DECIMAL(18,6)', '0.01')} AS open_price,
         {_digits('premax', 'DECIMAL(18,6)', '0.01')} AS max_price,
         {_digits('premin', 'DECIMAL(18,6)', '0.01')} AS min_price,
         {_digits('premed', 'DECIMAL(18,6)', '0.01')} AS avg_price,
         {_digits('preult', 'DECIMAL(18,6)', '0.01')} AS last_price,
         {_digits('preofc', 'DECIMAL(18,6)', '0.01')} AS best_bid,
         {_digits('preofv', 'DECIMAL(18,6)', '0.01')} AS best_ask,
         CASE WHEN regexp_full_match(trim(totneg), '[0-9]+') THEN TRY_CAST(trim(totneg) AS BIGINT) END AS trade_count,
         {_digits('quatot', 'DECIMAL(24,4)', None)} AS quantity_total,
         {_digits('voltot', 'DECIMAL(24,4)', '0.01')} AS volume_financial,
         {_digits('preexe', 'DECIMAL(18,6)', '0.01')} AS strike_price,
         CASE WHEN substr(trim(indopc), 1, 1) = '' THEN ' ' ELSE substr(trim(indopc), 1, 1) END AS ind_opc,
         CASE WHEN regexp_full_match(trim(datven), '[0-9]{{8}}') AND trim(datven) <> '00000000' THEN {_ymd('datven')} END AS expiration_date,
         CASE WHEN regexp_full_match(trim(datven), '[0-9]{{8}}') THEN trim(datven) ELSE '00000000' END AS expiration_key,
         CASE WHEN regexp_full_match(trim(fatcot), '[0-9]+') THEN TRY_CAST(trim(fatcot) AS INTEGER) END AS quotation_factor,
         {_digits('ptoexe', 'DECIMAL(24,8)', '0.000001')} AS strike_points,
         substr(trim(codisin), 1, 12) AS isin,
         rpad(substr(coalesce(dismes, ''), 1, 3), 3, ' ') AS distribution_num,
         substr(file_name, 1, 255) AS source_file_name
  FROM h_rec),
hist_rows AS (SELECT * FROM h_rows0 WHERE trade_date IS NOT NULL AND codneg <> ''),
hist AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY trade_date, codneg, cod_bdi, tp_merc, especi, prazo_term_days,
                                 moeda_ref, expiration_key, isin, distribution_num, ind_opc
                                 ORDER BY file_name DESC, line_no DESC) AS rn
    FROM hist_rows) x WHERE rn = 1)"""

HIST_VIEWS = ",\n".join([V_HIST_LINES, V_HIST_ROWS])


def daily_views_for(suffix: str, where: str) -> str:
    """The daily views over a predicate-selected part of lineitem, renamed
    with ``suffix`` (v_unit_x, v_bars_x, v_prev_x, v_daily_x)."""
    text = ",\n".join([V_UNIT, V_BARS, V_DAILY.split(",\nv_quotes AS")[0]])
    text = text.replace("FROM lineitem)", f"FROM lineitem WHERE {where})")
    for name in ("v_unit", "v_bars", "v_prev", "v_daily"):
        text = text.replace(name, f"{name}_{suffix}")
    return text
