"""Landing-zone data rendered from the test tables with Spark.

* ``jsonl_lines``     events -> JSONL quote-history lines, one file per day,
                      plus per-ticker junk / sentinel lines in an extra file.
* ``landed_payloads`` events -> nested quote payloads per (ticker, day) plus a
                      failed request per ticker; lineitem daily bars -> flat
                      payloads (wrapped in ``results`` when >= 2 trades).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.plans import market_tables as M
from candlewick.session import scratch_path

# Fixed values of the rendering.
EXTRA_DAY = "2024-02-01"
EXTRA_FILE = "daily_fluctuation_20240201T180000.jsonl"


def _file_of(day) -> F.Column:
    return F.concat(F.lit("daily_fluctuation_"), F.date_format(day, "yyyyMMdd"), F.lit("T180000.jsonl"))


def jsonl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = M.intraday_points(spark, sf_dir)
    point = F.struct(
        F.col("quoted_at"),
        F.struct(
            F.date_format("quoted_at", "HH:mm:ss").alias("quote_time"),
            F.replace(F.format_string("%.2f", F.col("close_price")), F.lit("."), F.lit(",")).alias("close_price"),
            F.col("price_fluctuation_pct").cast("string").alias("price_fluctuation_percentage"),
        ).alias("p"),
    )
    # One record per ticker-day: bounded by the quotes of one instrument in one day.
    g = pts.groupBy("ticker", "trade_date").agg(F.sort_array(F.collect_list(point)).alias("pts"))
    rec = F.to_json(F.struct(
        F.col("ticker").alias("ticker_requested"),
        F.col("ticker").alias("ticker_returned"),
        F.lit("OK").alias("business_status_code"),
        F.concat(F.date_format("trade_date", "yyyy-MM-dd"), F.lit("T18:00:00")).alias("message_datetime"),
        F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"),
        F.concat(F.date_format("trade_date", "yyyy-MM-dd"), F.lit("T21:00:00Z")).alias("collected_at"),
        F.size("pts").alias("points_count"),
        F.transform("pts", lambda x: x["p"]).alias("price_history"),
    ))
    records = g.select(_file_of(F.col("trade_date")).alias("file_name"), rec.alias("line"))
    tickers = pts.select("ticker").distinct()
    junk = tickers.select(F.lit(EXTRA_FILE).alias("file_name"), F.explode(F.array(
        F.lit(""),
        F.lit("{not json"),
        F.to_json(F.struct(F.col("ticker").alias("ticker_requested"), F.lit(EXTRA_DAY).alias("trade_date"),
                           F.array().cast("array<struct<quote_time:string>>").alias("price_history"))),
        F.to_json(F.struct(F.col("ticker").alias("ticker_returned"), F.lit("xx").alias("trade_date"))),
        F.to_json(F.struct(F.lit("").alias("ticker_requested"), F.lit(EXTRA_DAY).alias("trade_date"))),
    )).alias("line"))
    return records.unionByName(junk)


def landed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(requested_ticker, body, http_status, load_date)."""
    pts = M.intraday_points(spark, sf_dir)
    q = F.struct(
        F.col("quoted_at"),
        F.struct(F.col("close_price").alias("closPric"),
                 F.date_format("quoted_at", "HH:mm:ss").alias("dtTm"),
                 F.col("price_fluctuation_pct").alias("prcFlcn")).alias("q"),
    )
    g = pts.groupBy("ticker", "trade_date").agg(F.sort_array(F.collect_list(q)).alias("qs"))
    symb = F.when(F.dayofweek("trade_date") != 1, F.lower("ticker"))
    body = F.to_json(F.struct(
        F.struct(F.lit("OK").alias("cd")).alias("BizSts"),
        F.struct(F.concat(F.date_format("trade_date", "yyyy-MM-dd"), F.lit(" 18:00:00")).alias("dtTm")).alias("Msg"),
        F.struct(F.date_format("trade_date", "yyyy-MM-dd").alias("date"),
                 F.struct(symb.alias("symb"), F.transform("qs", lambda x: x["q"]).alias("lstQtn")).alias("scty")
                 ).alias("TradgFlr"),
    ))
    nested = g.select(F.col("ticker").alias("requested_ticker"), body.alias("body"),
                      F.lit(200).alias("http_status"), F.col("trade_date").alias("load_date"))
    failed = pts.select("ticker").distinct().select(
        F.col("ticker").alias("requested_ticker"), F.lit("").alias("body"), F.lit(503).alias("http_status"),
        F.lit(EXTRA_DAY).cast("date").alias("load_date"))
    return nested.unionByName(failed)


def landed_flat_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = M.daily_bars(spark, sf_dir)

    def br(c):
        return F.replace(F.col(c).cast("string"), F.lit("."), F.lit(","))

    flat = F.struct(
        F.col("ticker").alias("codNeg"),
        F.date_format("trade_date", "dd/MM/yyyy").alias("tradeDate"),
        br("last_price").alias("lastPrice"), br("min_price").alias("minPrice"),
        br("max_price").alias("maxPrice"), br("avg_price").alias("avgPrice"),
        br("variation_pct").alias("oscillationVal"),
    )
    body = F.when(F.col("trade_count") >= 2, F.to_json(F.struct(F.array(flat).alias("results")))).otherwise(F.to_json(flat))
    return bars.select(F.col("ticker").alias("requested_ticker"), body.alias("body"), F.lit(200).alias("http_status"),
                       F.col("trade_date").alias("load_date"))


# Headers of the rendered files (long labels / short codes).
TRADES_HEADER = ("Instrumento financeiro;Data do negócio;Preço de abertura;Preço mínimo;Preço máximo;"
                 "Preço médio;Preço de fechamento;Oscilação;Volume financeiro;Quantidade de negócios")
REGISTER_HEADER = "TckrSymb;NmOfc;ISIN;Sgmt;DtRfrn"
TRADES_PREAMBLE = "Negocios consolidados do pregao"
JUNK_TRADE_LINE = ";01/01/1998;1;1;1;1;12..3;;abc;1"


def _br(c) -> F.Column:
    return F.replace(F.col(c).cast("string"), F.lit("."), F.lit(","))


def trades_file_name(day) -> F.Column:
    return F.concat(F.lit("negocios_consolidados_"), F.date_format(F.trunc(day, "MM"), "yyyyMMdd"), F.lit(".csv"))


def trade_line_no(day, ticker) -> F.Column:
    key = F.substring(ticker, 2, 10).cast("bigint")
    return F.datediff(day, F.lit("1990-01-01").cast("date")).cast("bigint") * F.lit(10_000_000) + key * 2


def raw_trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly ``;`` trade files rendered from the daily bars: preamble, long
    header, pt-BR numbers (volume with thousands grouping), lower-case padded
    tickers, blank minimum for single-trade days, a later corrected duplicate
    of days with >= 3 trades and one junk line per file.
    (file_name, line_no, line)"""
    b = M.daily_bars(spark, sf_dir)
    vol = F.translate(F.format_number("financial_volume", 2), ",.", ".,")

    def line(last):
        return F.concat_ws(";",
                           F.concat(F.lit("  "), F.lower("ticker"), F.lit(" ")),
                           F.date_format("trade_date", "dd/MM/yyyy"),
                           _br("open_price"),
                           F.when(F.col("trade_count") == 1, F.lit("")).otherwise(_br("min_price")),
                           _br("max_price"), _br("avg_price"), last,
                           F.coalesce(_br("variation_pct"), F.lit("")),
                           vol, F.col("trade_count").cast("string"))

    fname = trades_file_name(F.col("trade_date"))
    ln = trade_line_no(F.col("trade_date"), F.col("ticker"))
    # Both lines of a bar in one pass over the bars.
    first = F.struct(ln.alias("line_no"), line(_br("last_price")).alias("line"))
    again = F.struct((ln + 1).alias("line_no"), line(F.replace((F.col("last_price") + 1).cast("string"), F.lit("."), F.lit(","))).alias("line"))
    rows = b.select(fname.alias("file_name"), F.explode(F.when(F.col("trade_count") >= 3, F.array(first, again)).otherwise(F.array(first))).alias("x")).select("file_name", "x.line_no", "x.line")
    files = b.select(fname.alias("file_name")).distinct()
    extra = files.select("file_name", F.explode(F.array(
        F.struct(F.lit(-3).cast("bigint").alias("line_no"), F.lit(TRADES_PREAMBLE).alias("line")),
        F.struct(F.lit(-2).cast("bigint").alias("line_no"), F.lit("").alias("line")),
        F.struct(F.lit(-1).cast("bigint").alias("line_no"), F.lit(TRADES_HEADER).alias("line")),
        F.struct(F.lit(0).cast("bigint").alias("line_no"), F.lit(JUNK_TRADE_LINE).alias("line")),
    )).alias("x")).select("file_name", "x.line_no", "x.line")
    return rows.unionByName(extra)


def raw_register_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register files (one per segment) rendered from the asset table:
    short-code header, lower-case padded tickers and ISINs, a later duplicate
    of every asset with a negative balance and one line without ticker."""
    a = M.dim_assets(spark, sf_dir)
    fname = F.concat(F.lit("cadastro_"), F.lower(F.regexp_replace("segment", "[^A-Za-z0-9]", "_")), F.lit(".csv"))
    key = F.substring("ticker", 2, 10).cast("bigint")

    def line(name):
        return F.concat_ws(";", F.concat(F.lit(" "), F.lower("ticker"), F.lit(" ")), name, F.lower("isin"),
                           F.col("segment"), F.date_format("source_file_date", "yyyy-MM-dd"))

    rows = a.select(fname.alias("file_name"), (key * 2 + 10).alias("line_no"), line(F.col("asset_name")).alias("line"))
    dups = a.where(F.col("acct_balance") < 0).select(fname.alias("file_name"), (key * 2 + 11).alias("line_no"),
                                                     line(F.lit("DUPLICATE")).alias("line"))
    files = a.select(fname.alias("file_name")).distinct()
    extra = files.select("file_name", F.explode(F.array(
        F.struct(F.lit(0).cast("bigint").alias("line_no"), F.lit(REGISTER_HEADER).alias("line")),
        F.struct(F.lit(1).cast("bigint").alias("line_no"), F.lit(";no ticker;;;2001-12-31").alias("line")),
    )).alias("x")).select("file_name", "x.line_no", "x.line")
    return rows.unionByName(dups).unionByName(extra)


_LANDED: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, render) -> DataFrame:
    """The rows of ``render(spark, sf_dir)`` as files in the shared folder.

    Landed once for a session and data folder and read by every query, the way
    files that a job receives are: parsing never repeats the rendering.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = scratch_path(spark, f"landed-{name}")
        render(spark, sf_dir).write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])
