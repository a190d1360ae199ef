"""Date and time column expressions.

Every parse uses the ``try_`` variants so that malformed input becomes null
instead of failing the task (ANSI mode is on in Spark 4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The date layouts tried for register/trade date columns, in order
# (year-month-day, day/month/4-digit year, day/month/2-digit year, compact).
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "dd/MM/yy", "yyyyMMdd")

# Timestamp layouts accepted for intraday quote times.
TIMESTAMP_FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss")

# File names carry a date as yyyy[-_]mm[-_]dd.
FILE_DATE_PATTERN = r"(\d{4})[-_]?(\d{2})[-_]?(\d{2})"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strict_layout(fmt: str) -> str:
    """Regex that a value must match before ``try_to_date`` sees it.

    Spark's datetime parser accepts one-digit fields for two-digit patterns
    ("1/2/2024" under dd/MM/yyyy); Python's strptime does too, so only the
    overall shape is enforced here.
    """
    return {
        "yyyy-MM-dd": r"^\d{4}-\d{1,2}-\d{1,2}$",
        "dd/MM/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
        "dd/MM/yy": r"^\d{1,2}/\d{1,2}/\d{2}$",
        "yyyyMMdd": r"^\d{8}$",
    }[fmt]


def try_date(c, fmt: str) -> Column:
    s = F.trim(_c(c).cast("string"))
    return F.when(s.rlike(_strict_layout(fmt)), F.try_to_date(s, fmt))


def row_date(c, formats=DATE_FORMATS) -> Column:
    """C10 row-level date parse: first format that parses this value."""
    return F.coalesce(*[try_date(c, f) for f in formats])


def detect_date_format(df: DataFrame, column: str, formats=DATE_FORMATS) -> str | None:
    """C9 column-level detection: the first format under which *every* non-null
    value parses.  One aggregate pass; returns the format or ``None``."""
    aggs = [F.count(F.col(column)).alias("n")]
    aggs += [F.count(try_date(column, f)).alias(f"f{i}") for i, f in enumerate(formats)]
    row = df.agg(*aggs).first()
    for i, f in enumerate(formats):
        if row["n"] > 0 and row[f"f{i}"] == row["n"]:
            return f
    return None


def payload_date(c, fallback=None) -> Column:
    """C11: ISO date, dd/MM/yyyy, ISO date-time (optionally with ``Z``); else ``fallback``."""
    s = F.trim(_c(c).cast("string"))
    parsed = F.coalesce(
        try_date(s, "yyyy-MM-dd"),
        try_date(s, "dd/MM/yyyy"),
        F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}T"), F.to_date(F.try_to_timestamp(F.regexp_replace(s, "Z$", "+00:00")))),
    )
    if fallback is None:
        return parsed
    return F.coalesce(parsed, fallback if isinstance(fallback, Column) else F.lit(fallback).cast("date"))


def file_name_date(c) -> Column:
    """Date embedded in a file name, null when absent or not a real date."""
    parts = [F.regexp_extract(_c(c), FILE_DATE_PATTERN, i) for i in (1, 2, 3)]
    return F.when(_c(c).rlike(FILE_DATE_PATTERN), F.try_to_date(F.concat_ws("-", *parts), "yyyy-MM-dd"))


def quoted_at(trade_date, quote_time) -> Column:
    """trade_date + ``HH[:MM[:SS]]`` as a UTC wall-clock timestamp.

    Missing or malformed times fall back to midnight.  A full ISO date-time in
    ``quote_time`` is accepted as is (documented divergence: the reference
    collapses those to midnight).
    """
    t = F.trim(_c(quote_time).cast("string"))
    hms = F.split(t, ":")
    hh = F.get(hms, 0).try_cast("int")
    mm = F.coalesce(F.get(hms, 1).try_cast("int"), F.lit(0))
    ss = F.coalesce(F.get(hms, 2).try_cast("double"), F.lit(0.0))
    td = _c(trade_date)
    clock = F.when(
        t.rlike(r"^\d{1,2}(:\d{1,2}(:\d{1,2})?)?$"),
        F.try_make_timestamp_ntz(F.year(td), F.month(td), F.dayofmonth(td), hh, mm, ss),
    )
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), F.to_timestamp_ntz(F.try_to_timestamp(F.regexp_replace(t, "Z$", "+00:00"))))
    return F.coalesce(iso, clock, td.cast("timestamp_ntz"))


def iso_timestamp(c) -> Column:
    """Three ISO layouts, naive values taken as UTC, time-only rejected."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in TIMESTAMP_FORMATS])


def yyyymmdd(c) -> Column:
    """Eight digits that form a real date, else null."""
    t = F.trim(_c(c))
    return F.when(t.rlike(r"^[0-9]{8}$"), F.try_to_date(t, "yyyyMMdd"))
