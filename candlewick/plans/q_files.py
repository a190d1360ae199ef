"""File-path queries: delimited scans, header mapping, transforms and
quality checks (S7, S7a-d, C1, C2, C5-C9, C13, C14, C17, F1, W5, P1-P3, A9, A10, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.functions.dates import DATE_FORMATS, try_date
from candlewick.functions.headers import INSTRUMENT_COLUMN_MAP, TRADE_COLUMN_MAP
from candlewick.functions.numbers import load_number, locale_number
from candlewick.operators import quality as Q
from candlewick.plans import jobs as J
from candlewick.plans import landing as LD
from candlewick.plans import market_tables as M
from candlewick.plans import transforms as TR
from candlewick.plans.catalog import register
from candlewick.plans.oracle_views import DAILY_VIEWS, HIST_VIEWS, V_ASSETS, with_views
from candlewick.session import scratch_path
from candlewick.sources import delimited as D
from candlewick.sources import fixed_width as FW
from candlewick.sources.manifest import manifest

TRADE_TARGETS = ["ticker", "trade_date", "open_price", "min_price", "max_price", "avg_price", "last_price",
                 "variation_pct", "financial_volume", "trade_count"]
REGISTER_TARGETS = ["ticker", "asset_name", "isin", "segment", "source_file_date"]

_FILE = "'negocios_consolidados_' || strftime(date_trunc('month', trade_date), '%Y%m%d') || '.csv'"
_LINE_NO = "(CAST(datediff('day', DATE '1990-01-01', trade_date) AS BIGINT) * 10000000 + CAST(substr(ticker, 2, 10) AS BIGINT) * 2)"


def _trade_lines(spark, sf_dir):
    return LD.landed(spark, sf_dir, "trades", LD.raw_trade_lines)


def mapped_trades(spark, sf_dir):
    headers, data = D.normalize_lines(_trade_lines(spark, sf_dir), "trades")
    return D.mapped_columns(data, D.header_positions(headers, TRADE_COLUMN_MAP), TRADE_TARGETS)


@register("csv_headers", with_views(DAILY_VIEWS, f"""
SELECT DISTINCT {_FILE} AS file_name, CAST(-1 AS BIGINT) AS header_line_no, ';' AS sep,
       TRUE AS token_detected, TRUE AS valid
FROM v_daily"""))
def csv_headers(spark, sf_dir):
    headers, _ = D.normalize_lines(_trade_lines(spark, sf_dir), "trades")
    return headers.drop("header")


@register("daily_csv_transform", with_views(DAILY_VIEWS, f"""
SELECT ticker, trade_date, open_price, last_price, CASE WHEN trade_count = 1 THEN NULL ELSE min_price END AS min_price,
       max_price, avg_price, variation_pct,
       CASE WHEN financial_volume >= 1000 THEN NULL ELSE financial_volume END AS financial_volume,
       trade_count, {_FILE} AS source_file_name
FROM v_daily"""))
def daily_csv_transform(spark, sf_dir):
    return TR.transform_trades(mapped_trades(spark, sf_dir))


@register("daily_quotes_transform", with_views(DAILY_VIEWS, f"""
SELECT ticker, trade_date, last_price, CASE WHEN trade_count = 1 THEN NULL ELSE min_price END AS min_price,
       max_price, avg_price, variation_pct,
       CASE WHEN financial_volume >= 1000 THEN NULL ELSE financial_volume END AS financial_volume,
       trade_count, {_FILE} AS source_file_name
FROM v_daily"""))
def daily_quotes_transform(spark, sf_dir):
    return TR.transform_daily_quotes(mapped_trades(spark, sf_dir))


@register("dedupe_first", with_views(DAILY_VIEWS, f"""
SELECT {_FILE} AS file_name, {_LINE_NO} AS line_no, '  ' || lower(ticker) || ' ' AS ticker,
       strftime(trade_date, '%d/%m/%Y') AS trade_date, replace(CAST(last_price AS VARCHAR), '.', ',') AS last_price
FROM v_daily"""))
def dedupe_first(spark, sf_dir):
    m = mapped_trades(spark, sf_dir).where(F.trim("ticker") != "")
    return TR.keep_first(m.select("file_name", "line_no", "ticker", "trade_date", "last_price"), ["ticker", "trade_date"])


@register("locale_number", with_views(DAILY_VIEWS, f"""
SELECT {_FILE} AS file_name, {_LINE_NO} AS line_no,
       CASE WHEN financial_volume >= 1000 THEN NULL ELSE financial_volume END AS load_value,
       financial_volume AS locale_value
FROM v_daily
UNION ALL
SELECT {_FILE}, {_LINE_NO} + 1, CASE WHEN financial_volume >= 1000 THEN NULL ELSE financial_volume END, financial_volume
FROM v_daily WHERE trade_count >= 3
UNION ALL
SELECT DISTINCT {_FILE}, CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM v_daily"""))
def locale_number_q(spark, sf_dir):
    m = mapped_trades(spark, sf_dir)
    return m.select("file_name", "line_no", load_number("financial_volume").alias("load_value"),
                    locale_number("financial_volume").alias("locale_value"))


@register("date_detect", with_views(DAILY_VIEWS, f"""
SELECT DISTINCT {_FILE} AS file_name, 'dd/MM/yyyy' AS date_format FROM v_daily"""))
def date_detect(spark, sf_dir):
    m = mapped_trades(spark, sf_dir)
    counts = m.groupBy("file_name").agg(F.count("trade_date").alias("n"),
                                        *[F.count(try_date("trade_date", f)).alias(f"f{i}") for i, f in enumerate(DATE_FORMATS)])
    pick = F.lit(None).cast("string")
    for i in reversed(range(len(DATE_FORMATS))):
        pick = F.when((F.col("n") > 0) & (F.col(f"f{i}") == F.col("n")), F.lit(DATE_FORMATS[i])).otherwise(pick)
    return counts.select("file_name", pick.alias("date_format"))


@register("validate_rules", with_views(DAILY_VIEWS, f"""
, f AS (SELECT {_FILE} AS scope, count(*) + count(*) FILTER (WHERE trade_count >= 3) + 1 AS rows,
               count(*) FILTER (WHERE trade_count >= 3) AS dups FROM v_daily GROUP BY 1)
SELECT scope, 'min_rows' AS rule, rows >= 1 AS ok, CAST(rows AS VARCHAR) AS detail FROM f
UNION ALL SELECT scope, 'max_rows', TRUE, CAST(rows AS VARCHAR) FROM f
UNION ALL SELECT scope, 'required_columns', TRUE, '' FROM f
UNION ALL SELECT scope, 'blank_keys', FALSE, '1' FROM f
UNION ALL SELECT scope, 'duplicate_keys', dups = 0, CAST(dups AS VARCHAR) FROM f"""))
def validate_rules(spark, sf_dir):
    m = mapped_trades(spark, sf_dir)
    return Q.validate_frame(m, required_columns=list(TR.REQUIRED_TRADE_COLUMNS), key_columns=["ticker", "trade_date"])


@register("locale_profile", with_views(DAILY_VIEWS, f"""
, f AS (SELECT {_FILE} AS file_name, count(*) + count(*) FILTER (WHERE trade_count >= 3) AS n FROM v_daily GROUP BY 1)
SELECT file_name, 'financial_volume' AS "column", n + 1 AS raw_count, n AS parsed_count, CAST(1 AS BIGINT) AS invalid_count,
       ['abc'] AS invalid_samples FROM f
UNION ALL
SELECT file_name, 'last_price', n + 1, n, 1, ['12..3'] FROM f"""))
def locale_profile(spark, sf_dir):
    return Q.locale_profile(mapped_trades(spark, sf_dir), ["financial_volume", "last_price"])


@register("register_transform", with_views(V_ASSETS, """
SELECT ticker, asset_name, isin, segment, CAST(NULL AS VARCHAR) AS instrument_type, source_file_date FROM v_assets"""))
def register_transform(spark, sf_dir):
    headers, data = D.normalize_lines(LD.landed(spark, sf_dir, "register", LD.raw_register_lines), "instruments", min_fields=4)
    m = D.mapped_columns(data, D.header_positions(headers, INSTRUMENT_COLUMN_MAP), REGISTER_TARGETS)
    return TR.transform_instruments(m)


@register("backfill_status", with_views(DAILY_VIEWS, f"""
, files AS (SELECT DISTINCT CAST(date_trunc('month', trade_date) AS DATE) AS day, {_FILE} AS path FROM v_daily),
days AS (SELECT CAST(d AS DATE) AS day FROM generate_series(DATE '1998-01-01', DATE '1998-03-31', INTERVAL 1 DAY) t(d))
SELECT days.day, CASE WHEN files.path IS NOT NULL THEN 'ok' ELSE 'skipped' END AS status, files.path
FROM days LEFT JOIN files ON days.day = files.day"""))
def backfill_status_q(spark, sf_dir):
    from candlewick.sources.manifest import backfill_status

    files = _trade_lines(spark, sf_dir).select(F.col("file_name").alias("name")).distinct() \
        .withColumn("path", F.col("name"))
    return backfill_status(spark, files, "1998-01-01", "1998-03-31")


#: Lines of a rendered file: more rows make more files, not longer ones.
LINES_PER_FILE = 1_000_000


def _file_numbers(bars, kinds):
    """Number of the file of a ticker's lines, whose residue by ``kinds`` is that of the ticker's hash."""
    return F.pmod(F.xxhash64("ticker"), F.lit(kinds * max(1, -(-bars.count() // (kinds * LINES_PER_FILE)))))


def _land(spark, lines, name):
    """Write (file_name, line_no, line) as real text files, one folder per file."""
    folder = scratch_path(spark, name)
    lines.repartition("file_name").sortWithinPartitions("file_name", "line_no").select("file_name", "line").write.partitionBy("file_name").text(folder)
    return folder


@register("daily_files_load", with_views(DAILY_VIEWS, """
SELECT ticker, trade_date, open_price, last_price, CASE WHEN trade_count = 1 THEN NULL ELSE min_price END AS min_price,
       max_price, avg_price, variation_pct,
       CASE WHEN financial_volume >= 1000 THEN NULL ELSE financial_volume END AS financial_volume, trade_count
FROM v_daily"""))
def daily_files_load(spark, sf_dir):
    """S3 + S7 + P2 over landed files (same base names in many folders)."""
    folder = _land(spark, _trade_lines(spark, sf_dir), "trades-landed")
    return TR.transform_trades(J.read_trades(spark, folder)).drop("source_file_name")


@register("undated_files_load", with_views(DAILY_VIEWS, """
, o AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS rn FROM v_daily)
SELECT ticker, DATE '2002-03-04' AS trade_date, open_price, last_price, trade_count FROM o WHERE rn = 1"""))
def undated_files_load(spark, sf_dir):
    """Trades files without a date column (comma separated, quoted
    fields, a preamble) take the load's date; first row per ticker wins."""
    b = LD.landed(spark, sf_dir, "bars", M.daily_bars)
    number = F.col("ticker")
    row = F.concat_ws(",", F.concat(F.lit('"'), number, F.lit('"')), F.concat(F.lit('"a, b"')), F.col("open_price").cast("string"), F.col("last_price").cast("string"), F.col("trade_count").cast("string"))
    rows = b.select(F.concat(F.lit("f"), _file_numbers(b, 4).cast("string")).alias("file_name"), F.datediff("trade_date", F.lit("1990-01-01")).cast("bigint").alias("line_no"), row.alias("line"))
    heads = rows.select("file_name").distinct().select("file_name", F.explode(F.array(
        F.struct(F.lit(-2).cast("bigint").alias("line_no"), F.lit("report").alias("line")),
        F.struct(F.lit(-1).cast("bigint").alias("line_no"), F.lit('TckrSymb,"Descrição, longa",Preço de abertura,LastPric,TradQty').alias("line")))).alias("x")).select("file_name", "x.line_no", "x.line")
    folder = _land(spark, rows.unionByName(heads), "undated-landed")
    out = TR.transform_trades(J.read_trades(spark, folder, "2002-03-04"))
    return out.select("ticker", "trade_date", "open_price", "last_price", "trade_count")


@register("dialect_files_load", with_views(DAILY_VIEWS, """
SELECT ticker, trade_date, open_price, last_price, trade_count FROM v_daily"""))
def dialect_files_load(spark, sf_dir):
    """Files of four dialects in one load, a preamble above each and all
    separators inside a quoted field."""
    b = LD.landed(spark, sf_dir, "bars", M.daily_bars)
    kind = _file_numbers(b, len(D.SEPARATORS)).cast("int")
    sep = F.element_at(F.array(*map(F.lit, D.SEPARATORS)), F.pmod("kind", F.lit(len(D.SEPARATORS))) + 1)

    def line(*fields):
        return F.array_join(F.array(*fields), "\u0001")

    note = F.lit('"a;b,c|d"')
    rows = b.select(kind.alias("kind"), F.datediff("trade_date", F.lit("1990-01-01")).cast("bigint").alias("line_no"), line(
        F.col("ticker"), F.col("trade_date").cast("string"), note, F.col("open_price").cast("string"), F.col("last_price").cast("string"), F.col("trade_count").cast("string")).alias("line"))
    heads = rows.select("kind").distinct().select("kind", F.explode(F.array(
        F.struct(F.lit(-2).cast("bigint").alias("line_no"), F.lit("report of the day").alias("line")),
        F.struct(F.lit(-1).cast("bigint").alias("line_no"), line(*map(F.lit, ("TckrSymb", "RptDt", '"Note, of all; markets"', "Preço de abertura", "LastPric", "TradQty"))).alias("line")))).alias("x")).select("kind", "x.line_no", "x.line")
    lines = rows.unionByName(heads).select(F.concat(F.lit("f"), F.col("kind").cast("string")).alias("file_name"), "line_no", F.replace("line", F.lit("\u0001"), sep).alias("line"))
    out = TR.transform_trades(J.read_trades(spark, _land(spark, lines, "dialects-landed")))
    return out.select("ticker", "trade_date", "open_price", "last_price", "trade_count")


BROKEN_PAGE = ("<html>", "<body>not found</body>")


@register("days_load", with_views(DAILY_VIEWS, f"""
SELECT {_FILE} AS file_name, 'ok' AS status, CAST(NULL AS VARCHAR) AS message, count(*) AS rows_loaded FROM v_daily GROUP BY 1
UNION ALL
SELECT DISTINCT 'broken_' || strftime(trade_date, '%Y') || '.csv', 'error', 'no usable header', CAST(0 AS BIGINT) FROM v_daily"""))
def days_load(spark, sf_dir):
    """The files of all days, some of them no tables at all,
    in one load into new tables; the verdict of every file."""
    lines = _trade_lines(spark, sf_dir)
    year = F.regexp_extract("file_name", r"_([0-9]{4})[0-9]{4}\.csv$", 1)
    broken = lines.select(F.concat(F.lit("broken_"), year, F.lit(".csv")).alias("file_name")).distinct().select("file_name", F.posexplode(F.array(*map(F.lit, BROKEN_PAGE))).alias("line_no", "line"))
    folder = _land(spark, lines.unionByName(broken.withColumn("line_no", F.col("line_no").cast("bigint"))), "days-landed")
    register = _land(spark, LD.landed(spark, sf_dir, "register", LD.raw_register_lines), "register-landed")
    paths = [r.path for r in manifest(spark, folder, "*.txt").select("path").collect()]  # one a file
    verdicts = J.load_days(spark, paths, scratch_path(spark, "days-tables"), register_paths=register)
    return verdicts.withColumn("file_name", F.regexp_extract("file_name", "file_name=([^/]+)/", 1))


@register("hist_files_load", with_views(HIST_VIEWS, """
SELECT trade_date, ticker, codneg, especi, isin, open_price, max_price, min_price, avg_price, last_price, trade_count,
       quantity_total, volume_financial, expiration_date, expiration_key
FROM hist"""))
def hist_files_load(spark, sf_dir):
    """S8 + K6 over landed files: records in file and line order, last wins."""
    folder = _land(spark, LD.landed(spark, sf_dir, "hist", M.hist_lines), "hist-landed")
    rows = FW.dedupe_last(FW.parse_lines(FW.scan_lines(spark, folder)))
    return rows.select("trade_date", "ticker", "codneg", "especi", "isin", "open_price", "max_price", "min_price", "avg_price", "last_price",
                       "trade_count", "quantity_total", "volume_financial", "expiration_date", "expiration_key")


@register("daily_discards", with_views(DAILY_VIEWS, f"""
SELECT {_FILE} AS file_name, CAST(count(*) + count(*) FILTER (WHERE trade_count >= 3) + 1 AS BIGINT) AS rows_read,
       CAST(1 AS BIGINT) AS no_ticker, CAST(0 AS BIGINT) AS no_date, count(*) FILTER (WHERE trade_count >= 3) AS repeated
FROM v_daily GROUP BY 1"""))
def daily_discards(spark, sf_dir):
    """P2 / P3 discard counters of every file."""
    return TR.discarded(mapped_trades(spark, sf_dir))
