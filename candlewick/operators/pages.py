"""Ordered pages with totals and the list filters behind them
(T5-T8, F5, F6, F9, A5, C25, C27).

A page is ``orderBy(unique order).offset(o).limit(n)``, which Spark plans as
a top-(o+n) per partition followed by one small merge.  The total is a scalar
subquery over the same filtered frame (``DataFrame.scalar()``), evaluated once
as a separate aggregate; no row is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page(df: DataFrame, order: list[Column], limit: int, offset: int = 0, *, total: bool = True) -> DataFrame:
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must be >= 0")
    out = df.orderBy(*order).offset(offset).limit(limit)
    if total:
        out = out.withColumn("total", df.select(F.count(F.lit(1))).scalar())
    return out


def search_assets(assets: DataFrame, q: str | None) -> DataFrame:
    """case-insensitive literal substring on ticker or name."""
    if not q:
        return assets
    needle = F.lit(q.strip().upper())
    return assets.where(F.contains(F.upper("ticker"), needle) | F.contains(F.upper("asset_name"), needle))


def assets_page(assets: DataFrame, q: str | None = None, limit: int = 50, offset: int = 0) -> DataFrame:
    """T5: assets ordered by ticker."""
    return page(search_assets(assets, q), [F.col("ticker").asc()], limit, offset)


def trades_page(trades: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    """trade_date desc, ticker asc."""
    return page(trades, [F.col("trade_date").desc(), F.col("ticker").asc()], limit, offset)


# The historical natural key (one row per key).
HIST_NATURAL_KEY = (
    "trade_date", "codneg", "cod_bdi", "tp_merc", "especi", "prazo_term_days",
    "moeda_ref", "expiration_key", "isin", "distribution_num", "ind_opc",
)


def hist_filtered(hist: DataFrame, *, ticker=None, trade_date=None, start=None, end=None, isin=None,
                  tp_merc=None, cod_bdi=None, expiration_date=None) -> DataFrame:
    """all given filters AND-ed; each becomes a parquet pushed filter."""
    conds = []
    if ticker is not None:
        conds.append(F.col("ticker") == ticker.strip().upper())
    if trade_date is not None:
        conds.append(F.col("trade_date") == F.lit(trade_date).cast("date"))
    if start is not None:
        conds.append(F.col("trade_date") >= F.lit(start).cast("date"))
    if end is not None:
        conds.append(F.col("trade_date") <= F.lit(end).cast("date"))
    if isin is not None:
        conds.append(F.col("isin") == isin.strip().upper())
    if tp_merc is not None:
        conds.append(F.col("tp_merc") == tp_merc)
    if cod_bdi is not None:
        conds.append(F.col("cod_bdi") == cod_bdi)
    if expiration_date is not None:
        conds.append(F.col("expiration_date") == F.lit(expiration_date).cast("date"))
    for c in conds:
        hist = hist.where(c)
    return hist


def hist_page(hist: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    """trade_date desc, ticker asc, then the natural key as tie-break
    (the reference breaks ties on a surrogate id).  ``last_price`` is served
    as ``close_price`` (C25)."""
    order = [F.col("trade_date").desc(), F.col("ticker").asc()] + [F.col(c).asc() for c in HIST_NATURAL_KEY[1:]]
    return page(hist.withColumnRenamed("last_price", "close_price"), order, limit, offset)


def runs_filtered(runs: DataFrame, *, pipeline_name=None, status=None, source_date=None,
                  started_from=None, started_to=None) -> DataFrame:
    """run-ledger filters (status compared lower-case)."""
    if pipeline_name is not None:
        runs = runs.where(F.col("pipeline_name") == pipeline_name)
    if status is not None:
        runs = runs.where(F.lower("status") == status.lower())
    if source_date is not None:
        runs = runs.where(F.col("source_date") == F.lit(source_date).cast("date"))
    if started_from is not None:
        runs = runs.where(F.col("started_at") >= F.lit(started_from).cast("timestamp_ntz"))
    if started_to is not None:
        runs = runs.where(F.col("started_at") <= F.lit(started_to).cast("timestamp_ntz"))
    return runs


def run_duration_seconds(started: str = "started_at", finished: str = "finished_at") -> Column:
    """Finished - started in seconds, null while running."""
    return (F.unix_micros(F.col(finished).cast("timestamp")) - F.unix_micros(F.col(started).cast("timestamp"))) / F.lit(1e6)
