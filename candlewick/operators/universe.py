"""Tradable-ticker universe and session-hours gate.

The register side is filtered with column predicates (rules skipped when a
column is absent), reduced to one row per ticker keeping the first in file
order (an aggregate), and combined with the active set by semi / anti joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.dates import row_date
from candlewick.functions.numbers import load_number
from candlewick.functions.text import TICKER_MAX, lookup_key

# Structural rules of the register filter.
SEGMENT_CASH = "cash"
MARKET_EQUITY = "equity-cash"
CATEGORY_SHARES = "shares"
# Placeholders meaning "no close price".
EMPTY_PRICE_MARKERS = ("", "none", "null", "-")
# Exchange session (local clock) and padding in minutes.
SESSION_TZ = "America/Sao_Paulo"
SESSION_OPEN, SESSION_CLOSE = "10:00", "17:00"
PAD_BEFORE_MIN, PAD_AFTER_MIN = 10, 10


def _ticker(c: str) -> Column:
    return F.upper(F.trim(F.coalesce(F.col(c), F.lit(""))))


def register_rules(register: DataFrame, reference_date, *, ticker="ticker", segment="segment", market="market",
                   category="category", start="start_date", end="end_date") -> DataFrame:
    """F2 per row: adds ``reject`` (null when kept) naming the first failed rule."""
    cols = set(register.columns)
    ref = F.lit(str(reference_date)).cast("date")
    t = _ticker(ticker)
    reject = F.when((t == "") | t.contains(" ") | (F.length(t) > TICKER_MAX), F.lit("noise"))
    if segment in cols:
        reject = reject.when(lookup_key(F.coalesce(F.col(segment), F.lit(""))) != SEGMENT_CASH, F.lit("segment"))
    if market in cols:
        reject = reject.when(lookup_key(F.coalesce(F.col(market), F.lit(""))) != MARKET_EQUITY, F.lit("market"))
    if category in cols:
        reject = reject.when(lookup_key(F.coalesce(F.col(category), F.lit(""))) != CATEGORY_SHARES, F.lit("category"))
    if start in cols:
        reject = reject.when(row_date(start) > ref, F.lit("start"))
    if end in cols:
        reject = reject.when(row_date(end) < ref, F.lit("end"))
    return register.withColumn("ticker_norm", t).withColumn("reject", reject)


def master_list(register: DataFrame, reference_date, *, order: str = "line_no", **cols) -> DataFrame:
    """kept tickers, distinct, with their first-seen order."""
    r = register_rules(register, reference_date, **cols)
    return r.where(F.col("reject").isNull()).groupBy(F.col("ticker_norm").alias("ticker")).agg(
        F.min(order).alias("register_order"))


def master_counters(register: DataFrame, reference_date, **cols) -> DataFrame:
    """Per-rule skip counters, computed in the same kind of single pass."""
    r = register_rules(register, reference_date, **cols)
    return r.groupBy(F.coalesce("reject", F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


def active_list(trades: DataFrame, *, ticker="ticker", trade_count="trade_count", close="last_price") -> DataFrame:
    """tickers with trade count > 0 (comma decimals accepted) and a
    non-empty close price."""
    n = load_number(F.col(trade_count).cast("string"))
    c = F.lower(F.trim(F.coalesce(F.col(close).cast("string"), F.lit(""))))
    return (trades.where((n > 0) & ~c.isin(*EMPTY_PRICE_MARKERS))
            .select(_ticker(ticker).alias("ticker")).where(F.col("ticker") != "").distinct())


def ticker_universe(master: DataFrame, active: DataFrame | None) -> DataFrame:
    """Every register ticker with ``in_strict`` (also active) and
    ``master_only`` flags; without an activity set the strict list is the
    register (fallback).  Semi and anti joins, never a cross product."""
    if active is None:
        return master.select("ticker", "register_order", F.lit(True).alias("in_strict"),
                             F.lit(False).alias("master_only"), F.lit("master_only_fallback").alias("status"))
    strict = master.join(active, "ticker", "left_semi").select(
        "ticker", "register_order", F.lit(True).alias("in_strict"), F.lit(False).alias("master_only"),
        F.lit("strict").alias("status"))
    only = master.join(active, "ticker", "left_anti").select(
        "ticker", "register_order", F.lit(False).alias("in_strict"), F.lit(True).alias("master_only"),
        F.lit("master_only").alias("status"))
    return strict.unionByName(only)


def within_session(ts, *, tz: str = SESSION_TZ, open_hhmm: str = SESSION_OPEN, close_hhmm: str = SESSION_CLOSE,
                   pad_before: int = PAD_BEFORE_MIN, pad_after: int = PAD_AFTER_MIN) -> Column:
    """F11 as a row predicate: the local wall clock of a UTC timestamp lies in
    [open - pad_before, close + pad_after], inclusive, on any calendar day."""
    def minutes(hhmm: str) -> int:
        h, m = hhmm.split(":")
        return int(h) * 60 + int(m)

    start = minutes(open_hhmm) - pad_before
    end = minutes(close_hhmm) + pad_after
    if end <= start:
        raise ValueError("session end must be after start")
    # UTC wall clock -> exchange wall clock, independent of the session zone.
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz"))
    clock = F.date_format(local, "HH:mm:ss.SSSSSS")
    lo = f"{start // 60:02d}:{start % 60:02d}:00.000000"
    hi = f"{end // 60:02d}:{end % 60:02d}:00.000000"
    return (clock >= F.lit(lo)) & (clock <= F.lit(hi))
