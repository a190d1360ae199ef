"""Intraday JSONL quote histories.

One JSON record per (ticker, day) with a ``price_history`` array.  The scan is
``spark.read.text`` (line-splittable) + ``from_json`` with a declared schema +
``explode_outer``; nothing is parsed in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.dates import quoted_at as build_quoted_at
from candlewick.functions.dates import iso_timestamp
from candlewick.functions.numbers import NUMERIC_LITERAL
from candlewick.functions.text import blank_to_null
from candlewick.sources.lines import scan

POINT_SCHEMA = T.StructType([
    T.StructField("quote_time", T.StringType()),
    T.StructField("close_price", T.StringType()),
    T.StructField("price_fluctuation_percentage", T.StringType()),
])
RECORD_SCHEMA = T.StructType([
    T.StructField("ticker_requested", T.StringType()),
    T.StructField("ticker_returned", T.StringType()),
    T.StructField("business_status_code", T.StringType()),
    T.StructField("message_datetime", T.StringType()),
    T.StructField("trade_date", T.StringType()),
    T.StructField("collected_at", T.StringType()),
    T.StructField("points_count", T.IntegerType()),
    T.StructField("price_history", T.ArrayType(POINT_SCHEMA)),
])


def jsonl_decimal(c) -> Column:
    """Comma -> dot, then an exact decimal(18,6); anything else is null."""
    s = F.replace(F.trim((F.col(c) if isinstance(c, str) else c).cast("string")), F.lit(","), F.lit("."))
    return F.when(s.rlike(NUMERIC_LITERAL), s.try_cast("decimal(18,6)"))


def scan_jsonl_lines(spark: SparkSession, paths, *, path_glob: str | None = None) -> DataFrame:
    """(file_name, line_no, line); see ``sources.lines``."""
    return scan(spark, paths, path_glob=path_glob)


def decode_records(lines: DataFrame) -> DataFrame:
    """Lines -> typed records with a ``status`` column: ``blank``,
    ``undecodable``, ``no_ticker``, ``bad_date`` or ``ok``."""
    raw = F.trim(F.col("line"))
    rec = F.from_json(raw, RECORD_SCHEMA, {"mode": "PERMISSIVE"})
    place = [F.col("line_no")] if "line_no" in lines.columns else []
    parsed = lines.select("file_name", *place, raw.alias("raw"), rec.alias("r"))
    # A line is decodable when it is a JSON object (from_json gives a struct
    # of nulls for non-objects, so check the text as well).
    decodable = F.col("r").isNotNull() & F.col("raw").startswith("{") & F.col("raw").endswith("}") & \
        F.get_json_object(F.col("raw"), "$").isNotNull()

    def nonempty(c):
        return F.when(c != "", c)

    ticker = F.upper(F.coalesce(nonempty(F.col("r.ticker_requested")), nonempty(F.col("r.ticker_returned"))))
    td_text = F.trim(F.col("r.trade_date"))
    trade_date = F.when(td_text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(td_text, "yyyy-MM-dd"))
    status = (
        F.when(F.col("raw") == "", F.lit("blank"))
        .when(~decodable, F.lit("undecodable"))
        .when(ticker.isNull(), F.lit("no_ticker"))
        .when(trade_date.isNull(), F.lit("bad_date"))
        .otherwise(F.lit("ok"))
    )
    return parsed.select("file_name", *place, ticker.alias("ticker"), trade_date.alias("trade_date"),
                         F.col("r.price_history").alias("price_history"), status.alias("status"))


def parse_jsonl(lines: DataFrame) -> DataFrame:
    """S10 + C18 + C16: one row per price point; a record with an empty
    history yields one row at midnight with null prices."""
    return points_of(decode_records(lines))


def record_counters() -> list:
    """A7 counters of decoded records, for ``DataFrame.observe`` or ``agg``."""
    pts = F.when(F.col("status") == "ok", F.greatest(F.coalesce(F.size("price_history"), F.lit(0)), F.lit(1)))
    return [F.coalesce(F.sum(pts), F.lit(0)).cast("bigint").alias("points"),
            F.count_if(F.col("status").isin("undecodable", "no_ticker", "bad_date")).alias("skipped")]


def points_of(records: DataFrame) -> DataFrame:
    """The price points of decoded records."""
    ok = records.where(F.col("status") == "ok")
    place = [F.struct("line_no", "pos").alias("place")] if "line_no" in records.columns else []
    pts = ok.select("file_name", *(["line_no"] if place else []), "ticker", "trade_date", F.posexplode_outer("price_history").alias("pos", "p"))
    return pts.select(
        *place,
        "ticker",
        build_quoted_at(F.col("trade_date"), F.col("p.quote_time")).alias("quoted_at"),
        "trade_date",
        jsonl_decimal(F.col("p.close_price")).alias("close_price"),
        jsonl_decimal(F.col("p.price_fluctuation_percentage")).alias("price_fluctuation_pct"),
        F.col("file_name").alias("source_jsonl"),
    )


def jsonl_counters(lines: DataFrame) -> DataFrame:
    """Per file, points parsed, distinct tickers and skipped lines."""
    rec = decode_records(lines)
    points, skipped = record_counters()
    return rec.groupBy(F.col("file_name").alias("source_jsonl")).agg(
        points, F.countDistinct(F.when(F.col("status") == "ok", F.col("ticker"))).alias("tickers"), skipped)


# Names under which a flat intraday record may carry a field, in order of preference.
TICKER_NAMES = ("ticker_requested", "ticker_returned", "symbol", "ticker")
TIME_NAMES = ("quoted_at", "timestamp", "time", "dtTm")
PRICE_NAMES = ("close_price", "closPric", "price", "last_price")
FLUCTUATION_NAMES = ("price_fluctuation_pct", "price_fluctuation_percentage", "prcFlcn", "variation_pct", "oscillation_pct")


def first_of(df: DataFrame, names: tuple[str, ...]) -> Column:
    """First non-null of the named columns that ``df`` has (null if none)."""
    types = dict(df.dtypes)
    have = [
        F.date_format(f"`{n}`", "yyyy-MM-dd'T'HH:mm:ss") if types[n].startswith("timestamp") else F.col(f"`{n}`").cast("string")
        for n in names if n in types]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def intraday_rows(df: DataFrame) -> DataFrame:
    """P4 with its verdict per row: the point's columns and ``skipped``
    (``no_ticker``, ``no_time`` or null).

    ``trade_date`` is the row's own date column if it has one with a date,
    else the date of ``quoted_at``.
    """
    ticker = F.upper(blank_to_null(first_of(df, TICKER_NAMES)))
    raw = first_of(df, TIME_NAMES)
    at = iso_timestamp(raw).cast("timestamp_ntz")
    own = F.col("trade_date") if dict(df.dtypes).get("trade_date") == "date" else F.lit(None).cast("date")
    source = F.col("source_jsonl").cast("string") if "source_jsonl" in df.columns else F.lit(None).cast("string")
    return df.select(
        ticker.alias("ticker"), at.alias("quoted_at"), F.coalesce(own, at.cast("date")).alias("trade_date"),
        jsonl_decimal(first_of(df, PRICE_NAMES)).alias("close_price"),
        jsonl_decimal(first_of(df, FLUCTUATION_NAMES)).alias("price_fluctuation_pct"), source.alias("source_jsonl"),
        F.when(ticker.isNull(), F.lit("no_ticker")).when(at.isNull(), F.lit("no_time")).alias("skipped"))


def transform_intraday(df: DataFrame) -> DataFrame:
    """Flat intraday records under any of the known names to typed points;
    rows without a ticker or a time are dropped (see ``intraday_counters``)."""
    return intraday_rows(df).where(F.col("skipped").isNull()).drop("skipped")


def intraday_counters(df: DataFrame) -> DataFrame:
    """P4 counters: rows kept and rows dropped, by reason."""
    return intraday_rows(df).groupBy(F.coalesce("skipped", F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def record_json(record: Column) -> Column:
    """One JSONL line, nulls written out."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def write_jsonl_records(points: DataFrame) -> DataFrame:
    """One JSON record per (ticker, trade_date) of stored points, with
    ``points_count`` and the price history (prices as strings), as a ``value``
    column ready for ``write.text``; the payload's own header fields are null
    (``payloads.payload_records`` writes payloads with theirs).  The history of one ticker-day is bounded
    by the number of distinct quote seconds in a day (86 400)."""
    pt = F.struct(
        F.col("quoted_at"),
        F.struct(
            F.date_format("quoted_at", "HH:mm:ss").alias("quote_time"),
            F.col("close_price").cast("string").alias("close_price"),
            F.col("price_fluctuation_pct").cast("string").alias("price_fluctuation_percentage"),
        ).alias("p"),
    )
    g = points.groupBy("ticker", "trade_date").agg(F.sort_array(F.collect_list(pt)).alias("pts"))
    rec = F.struct(
        F.col("ticker").alias("ticker_requested"),
        F.col("ticker").alias("ticker_returned"),
        F.lit(None).cast("string").alias("business_status_code"),  # stored points carry no payload header
        F.lit(None).cast("string").alias("message_datetime"),
        F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"),
        F.lit(None).cast("string").alias("collected_at"),
        F.size("pts").alias("points_count"),
        F.transform("pts", lambda x: x["p"]).alias("price_history"),
    )
    return g.select("ticker", "trade_date", F.to_json(rec).alias("value"))
