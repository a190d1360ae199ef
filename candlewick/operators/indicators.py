"""Technical indicators on daily closes.

Prices are carried as exact integer micro-units (price x 10^6) wherever a sum
is taken, so results do not depend on summation order, and SMA's HALF_UP
rounding to four decimals is exact, as with the decimal arithmetic of the
original definitions.

* SMA is a sliding ``ROWS`` window over each ticker's daily series.
* EMA and RSI are recurrences of affine maps, composed by running sums inside
  chunks and a short fold over the chunks before: column expressions only.  A
  ticker's *daily* series has at most one row per calendar day, so a window's
  size is bounded by the date span (about 10 000 rows for 40 years), not by the
  data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.functions.numbers import half_up

# Accepted indicators and period bounds.
INDICATORS = ("SMA", "EMA", "RSI")
PERIOD_MIN, PERIOD_MAX = 2, 200
MICRO = 1_000_000
#: Rows that a running sum spans: keep^-CHUNK stays a double for every period.
CHUNK = 256


def check_period(period: int) -> None:
    if period < PERIOD_MIN or period > PERIOD_MAX:
        raise ValueError(f"period must be between {PERIOD_MIN} and {PERIOD_MAX} inclusive")


def micro(c) -> Column:
    """Price as exact integer micro-units."""
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x.cast("double") * MICRO).cast("bigint")


def daily_closes(quotes: DataFrame, *, key: str = "ticker", date: str = "trade_date",
                 price: str = "last_price") -> DataFrame:
    """Non-null closes (ticker, trade_date, close) as the indicator input."""
    return quotes.where(F.col(price).isNotNull()).select(
        F.col(key).alias("ticker"), F.col(date).alias("trade_date"), F.col(price).cast("double").alias("close"))


def sma(closes: DataFrame, period: int) -> DataFrame:
    """Mean of the last ``period`` closes, HALF_UP to 4 decimals; null
    until ``period`` closes exist."""
    check_period(period)
    w = Window.partitionBy("ticker").orderBy("trade_date")
    total = F.sum(micro("close")).over(w.rowsBetween(-(period - 1), 0))
    n = F.row_number().over(w)
    # round(total / (period * 10^6), 4) half-up == floor((total + 50 p) / (100 p)) / 10^4
    rounded = F.floor((total + F.lit(50 * period)) / F.lit(100 * period)) / F.lit(10_000.0)
    return closes.select("ticker", "trade_date", F.when(n >= period, rounded).alias("value"))


def _smoothed(series: DataFrame, names: list[str], seed_at: int, period: int, alpha: float) -> DataFrame:
    """Exponential means of the columns ``names``: the plain mean of ``period``
    values at row ``seed_at`` of a ticker, then ``(1 - alpha) * before + alpha * x``;
    null before that row.

    A step is the affine map e -> keep * e + b, and maps compose.  Inside a
    chunk of ``CHUNK`` rows the composition is a running sum of b / keep^j
    times keep^j; the full chunks before a row are folded into the value it
    carries on.  All of it are windows over the one exchange by ticker.
    """
    keep = 1.0 - alpha
    in_order = Window.partitionBy("ticker").orderBy("trade_date")
    k = F.row_number().over(in_order) - seed_at
    seeds = [(F.sum(x).over(in_order) / F.lit(period)).alias(f"_seed_{x}") for x in names]
    rows = series.select("*", k.alias("_k"), *seeds)
    rows = rows.withColumn("_chunk", F.floor(F.col("_k") / CHUNK)).withColumn("_j", F.pmod("_k", F.lit(CHUNK)))
    here = Window.partitionBy("ticker", "_chunk").orderBy("trade_date")
    before = Window.partitionBy("ticker").orderBy("_chunk", "trade_date").rowsBetween(Window.unboundedPreceding, -1)
    j = F.col("_j")
    for x in names:
        b = F.when(F.col("_k") == 0, F.col(f"_seed_{x}")).when(F.col("_k") > 0, F.lit(alpha) * F.col(x))
        rows = rows.withColumn(f"_here_{x}", F.pow(F.lit(keep), j) * F.sum(b * F.pow(F.lit(keep), -j)).over(here))
    out = []
    for x in names:
        ends = F.collect_list(F.when((j == CHUNK - 1) & (F.col("_k") >= 0), F.col(f"_here_{x}"))).over(before)   # one value a chunk
        carried = F.aggregate(ends, F.lit(0.0), lambda acc, end: acc * F.lit(keep ** CHUNK) + end)
        out.append(F.when(F.col("_k") >= 0, F.pow(F.lit(keep), j + 1) * carried + F.col(f"_here_{x}")).alias(f"smooth_{x}"))
    return rows.select("ticker", "trade_date", *out)


def ema(closes: DataFrame, period: int) -> DataFrame:
    """alpha = 2/(p+1), seeded with the mean of the first ``p`` closes at
    index p-1; state not rounded, outputs rounded to 4 decimals."""
    check_period(period)
    series = closes.select("ticker", "trade_date", micro("close").alias("x"))
    smooth = _smoothed(series, ["x"], period, period, 2.0 / (period + 1))
    return smooth.select("ticker", "trade_date", half_up(F.col("smooth_x") / MICRO, 4).alias("value"))


def rsi(closes: DataFrame, period: int) -> DataFrame:
    """Wilder RSI; first averages are plain means of the first ``p``
    gains / losses, then (prev * (p-1) + x) / p.  The share of the smoothed
    rises in all smoothed moves, in percent; 50 where nothing moved."""
    check_period(period)
    move = micro("close") - F.lag(micro("close")).over(Window.partitionBy("ticker").orderBy("trade_date"))
    series = closes.select("ticker", "trade_date", move.alias("move")).select(
        "ticker", "trade_date", F.greatest("move", F.lit(0)).alias("up"), F.greatest(-F.col("move"), F.lit(0)).alias("down"))
    smooth = _smoothed(series, ["up", "down"], period + 1, period, 1.0 / period)
    up, both = F.col("smooth_up"), F.col("smooth_up") + F.col("smooth_down")
    return smooth.select("ticker", "trade_date", F.when(both > 0, half_up(100.0 * up / both, 4)).when(both == 0, 50.0).alias("value"))


def indicator_series(quotes: DataFrame, indicator: str, period: int, *, start=None, end=None,
                     limit: int | None = None) -> DataFrame:
    """Dispatch by name on non-null closes of every ticker in
    ``[start, end]``; optionally keep the newest ``limit`` values per ticker."""
    check_period(period)
    ind = indicator.strip().upper()
    if ind not in INDICATORS:
        raise ValueError(f"unsupported indicator {indicator!r}")
    closes = daily_closes(quotes)
    if start is not None:
        closes = closes.where(F.col("trade_date") >= F.lit(start).cast("date"))
    if end is not None:
        closes = closes.where(F.col("trade_date") <= F.lit(end).cast("date"))
    out = {"SMA": sma, "EMA": ema, "RSI": rsi}[ind](closes, period)
    if limit is not None:
        rn = F.row_number().over(Window.partitionBy("ticker").orderBy(F.col("trade_date").desc()))
        out = out.withColumn("_rn", rn).where(F.col("_rn") <= limit).drop("_rn")
    return out.withColumn("indicator", F.lit(ind)).withColumn("period", F.lit(period))


def indicator_envelope(quotes: DataFrame, *, start=None, end=None) -> DataFrame:
    """First and last source date of each ticker's indicator input."""
    closes = daily_closes(quotes)
    if start is not None:
        closes = closes.where(F.col("trade_date") >= F.lit(start).cast("date"))
    if end is not None:
        closes = closes.where(F.col("trade_date") <= F.lit(end).cast("date"))
    return closes.groupBy("ticker").agg(F.min("trade_date").alias("source_start"),
                                        F.max("trade_date").alias("source_end"),
                                        F.count(F.lit(1)).alias("source_points"))
