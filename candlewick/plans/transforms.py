"""Cleaning transforms (P1-P3) over mapped string columns.

Input: a DataFrame of internal-name string columns plus ``file_name`` and
``line_no`` (file order).  Every step is a column expression or an aggregate;
the only per-file decision (which date layout a column uses, C9) is made by
one grouped aggregate: one row per file, broadcast if proven small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.dates import DATE_FORMATS, file_name_date, try_date
from candlewick.functions.numbers import LOAD_NUMBER_STEPS
from candlewick.functions.text import sanitize_asset_columns, strip
from candlewick.sources.lines import base_name, per_file

# Numeric columns of the daily tables and the required set.
TRADE_NUMERIC = ("open_price", "last_price", "min_price", "max_price", "avg_price", "variation_pct",
                 "financial_volume", "trade_count")
QUOTE_NUMERIC = ("last_price", "min_price", "max_price", "avg_price", "variation_pct", "financial_volume",
                 "trade_count")
REQUIRED_TRADE_COLUMNS = ("ticker", "trade_date", "last_price")


def trim_all(df: DataFrame, skip=("file_name", "line_no")) -> DataFrame:
    """C5 on every string column."""
    return df.select(*[
        strip(f.name).alias(f.name) if f.dataType.simpleString() == "string" and f.name not in skip else F.col(f.name)
        for f in df.schema.fields
    ])


def dates_by_file_format(df: DataFrame, column: str, key: str = "file_name", formats=DATE_FORMATS, of_key: dict[str, Column] | None = None) -> DataFrame:
    """C9 per file: the first layout under which every non-null value of the
    file parses; otherwise a lenient ISO cast.  ``of_key``: further columns that
    follow from the key, evaluated once for each file."""
    counts = df.groupBy(key).agg(
        F.count(F.col(column)).alias("_n"),
        *[F.count(try_date(column, f)).alias(f"_f{i}") for i, f in enumerate(formats)],
    )
    pick = F.lit(None).cast("int")
    for i in reversed(range(len(formats))):
        pick = F.when((F.col("_n") > 0) & (F.col(f"_f{i}") == F.col("_n")), F.lit(i)).otherwise(pick)
    chosen = counts.select(key, pick.alias("_fmt"), *[c.alias(n) for n, c in (of_key or {}).items()])

    def parse(v):
        parsed = F.lit(None).cast("date")
        for i, f in enumerate(formats):
            parsed = F.when(v["fmt"] == i, try_date(v["text"], f)).otherwise(parsed)
        return F.when(v["fmt"].isNull(), v["text"].try_cast("date")).otherwise(parsed)

    # As an array of one, like ``numbers``.
    text = F.struct(F.col(column).alias("text"), F.col("_fmt").alias("fmt"))
    return df.join(per_file(chosen), key, "left").withColumn(column, F.get(F.transform(F.array(text), parse), 0)).drop("_fmt")


def numbers(columns: list) -> Column:
    """C5 and C7 of several text columns, as one array.  The rules are a
    lambda's body: spelled out for every column they make one very long
    generated method, which took about twice the time in a measurement.  Each
    step is a lambda of its own: inside one, what is referred to twice is
    evaluated twice."""
    values = F.array(*columns)
    for step in (strip, *LOAD_NUMBER_STEPS):
        values = F.transform(values, step)
    return values


def keep_first(df: DataFrame, keys: list[str], order=("file_name", "line_no")) -> DataFrame:
    """First row per key in file order.  The smallest row struct that
    begins with the order: an aggregate combined map-side (no window over a
    hot key), whose rows hold the order once."""
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in others if c not in order])
    return df.groupBy(*keys).agg(F.min(row).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def undated(target_date=None):
    """The date text of a file that has no date column."""
    if target_date is not None:
        return F.lit(str(target_date))
    return F.date_format(file_name_date(base_name("file_name")), "yyyy-MM-dd")


#: Age of a file whose name holds no date: the oldest.
UNDATED_AGE = 719_162


def file_age() -> Column:
    """Smaller for a later date in the name of the file ``file_name`` (a path)."""
    return F.coalesce(-F.unix_date(file_name_date(base_name("file_name"))), F.lit(UNDATED_AGE))


def parse_daily(df: DataFrame, numeric: tuple[str, ...], target_date=None, *, aged: bool = False) -> DataFrame:
    """Every row of the files, typed (C5-C9, C13, C14); nothing is dropped yet.
    With ``aged`` the rows have the age of their file, ``_age``."""
    if "ticker" not in df.columns:
        raise ValueError(f"ticker column absent; columns: {df.columns}")
    if "trade_date" not in df.columns:
        # Column, else target date, else the date in the file name.
        df = df.withColumn("trade_date", undated(target_date))
    texts = [F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string") for c in numeric]
    df = df.select("file_name", "line_no", F.upper(strip("ticker")).alias("ticker"), strip("trade_date").alias("trade_date"),   # C5, C6
                   numbers(texts).alias("_numbers"))                         # C7 + C14
    df = dates_by_file_format(df, "trade_date", of_key={"_age": file_age()} if aged else None)   # C9
    typed = [F.get("_numbers", F.lit(i)).alias(c) for i, c in enumerate(numeric)]
    df = df.select("ticker", "trade_date", *typed, "file_name", "line_no", *([F.coalesce("_age", F.lit(UNDATED_AGE)).alias("_age")] if aged else []))
    return df.withColumn("trade_count", F.col("trade_count").cast("bigint"))


def _no_ticker():
    return F.col("ticker").isNull() | (F.col("ticker") == "")


def daily_counters() -> list:
    """P2 / P3 counters of ``parse_daily`` rows, for ``DataFrame.observe`` or ``agg``."""
    no_ticker = F.coalesce(_no_ticker(), F.lit(True))
    return [F.count(F.lit(1)).alias("rows_read"), F.count_if(no_ticker).alias("no_ticker"),
            F.count_if(~no_ticker & F.col("trade_date").isNull()).alias("no_date")]


def keep_daily(parsed: DataFrame, numeric: tuple[str, ...], *, newest_file: bool = False) -> DataFrame:
    """Rows with a ticker and a date, the first per (ticker, date)
    in file order; with ``newest_file`` the first one of the file whose name
    has the latest date, as loads of one file after the other leave it; their
    age is that of ``parse_daily`` with ``aged``.  ``file_name`` is the full path."""
    df = parsed.where(~_no_ticker() & F.col("trade_date").isNotNull())
    order = ["file_name", "line_no"]
    if newest_file:
        order = ["_age", *order]
    return keep_first(df, ["ticker", "trade_date"], order).select("ticker", "trade_date", *numeric, "file_name")


def _daily(df: DataFrame, numeric: tuple[str, ...], target_date=None) -> DataFrame:
    return sourced(keep_daily(parse_daily(df, numeric, target_date), numeric))


def sourced(rows: DataFrame) -> DataFrame:
    """Rows with the name of their file instead of its path."""
    return rows.select(*[c for c in rows.columns if c != "file_name"], base_name("file_name").alias("source_file_name"))


def transform_trades(df: DataFrame, target_date=None) -> DataFrame:
    """Trades rows keyed by (ticker, trade_date)."""
    return _daily(df, TRADE_NUMERIC, target_date)


def transform_daily_quotes(df: DataFrame, target_date=None) -> DataFrame:
    """Daily-quote rows; an ``open_price`` column is discarded (C14)."""
    return _daily(df.drop("open_price"), QUOTE_NUMERIC, target_date)


def transform_instruments(df: DataFrame, file_date=None) -> DataFrame:
    """P1 + C17: trimmed, upper tickers, no-ticker rows dropped, first row per
    ticker, source_file_date parsed (else ``file_date``), then sanitised and
    de-duplicated again (truncation can make two tickers equal)."""
    df = trim_all(df)
    df = df.withColumn("ticker", F.upper(F.col("ticker").cast("string")))
    df = df.where(F.col("ticker").isNotNull() & (F.col("ticker") != ""))
    if "source_file_date" in df.columns:
        df = dates_by_file_format(df, "source_file_date")
        if file_date is not None:
            df = df.withColumn("source_file_date", F.coalesce("source_file_date", F.lit(file_date).cast("date")))
    else:
        df = df.withColumn("source_file_date", F.lit(file_date).cast("date"))
    for c in ("asset_name", "isin", "segment", "instrument_type"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    cols = ["ticker", "asset_name", "isin", "segment", "instrument_type", "source_file_date", "file_name", "line_no"]
    first = keep_first(df.select(*cols), ["ticker"])
    clean = sanitize_asset_columns(first)
    return keep_first(clean, ["ticker"]).select(
        "ticker", "asset_name", "isin", "segment", "instrument_type", "source_file_date")


def discarded(df: DataFrame, target_date=None) -> DataFrame:
    """P2 / P3 counters per file: rows read, rows dropped for want of a ticker
    or a trade date, and rows that repeat an earlier (ticker, date)."""
    if "trade_date" not in df.columns:
        df = df.withColumn("trade_date", undated(target_date))
    d = dates_by_file_format(trim_all(df.select("file_name", "line_no", "ticker", "trade_date")), "trade_date")
    ticker = F.upper("ticker")
    no_ticker = ticker.isNull() | (ticker == "")
    keyed = d.select("file_name", no_ticker.alias("nt"), (~no_ticker & F.col("trade_date").isNull()).alias("nd"), ticker.alias("ticker"), "trade_date")
    per_key = keyed.groupBy("file_name", "nt", "nd", "ticker", "trade_date").agg(F.count(F.lit(1)).alias("n"))
    good = ~F.col("nt") & ~F.col("nd")
    return per_key.groupBy("file_name").agg(
        F.sum("n").alias("rows_read"), F.coalesce(F.sum(F.when(F.col("nt"), F.col("n"))), F.lit(0)).alias("no_ticker"),
        F.coalesce(F.sum(F.when(F.col("nd"), F.col("n"))), F.lit(0)).alias("no_date"),
        F.coalesce(F.sum(F.when(good, F.col("n") - 1)), F.lit(0)).alias("repeated"))
