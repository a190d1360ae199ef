"""Per-ticker coverage and overview across all market tables.

Instead of one join per source, every source is projected to a common shape
and unioned, then reduced with *one* aggregate on ticker: conditional
``min``/``max``/``max_by`` per source.  That is one shuffle of pre-aggregated
rows (partial aggregation runs map-side), whatever the number of sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def asset_coverage(assets: DataFrame, quotes: DataFrame | None, trades: DataFrame, points: DataFrame,
                   hist: DataFrame | None = None) -> DataFrame:
    """For every ticker seen anywhere: register flag and date bounds per table
    (intraday bounds as dates).  ``quotes`` None: quotes and trades are the
    same rows, read once."""
    both = ["trade"] if quotes is not None else ["quote", "trade"]
    parts = [
        assets.select("ticker", F.lit("asset").alias("src"), F.lit(None).cast("date").alias("d")),
        trades.select("ticker", F.explode(F.array(*map(F.lit, both))).alias("src"), F.col("trade_date").alias("d")),
        points.select("ticker", F.lit("intraday").alias("src"), F.to_date("quoted_at").alias("d")),
    ]
    if quotes is not None:
        parts.append(quotes.select("ticker", F.lit("quote").alias("src"), F.col("trade_date").alias("d")))
    if hist is not None:
        parts.append(hist.select("ticker", F.lit("hist").alias("src"), F.col("trade_date").alias("d")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    aggs = [F.max(F.col("src") == "asset").alias("has_asset_master")]
    for s in ("quote", "trade", "intraday") + (("hist",) if hist is not None else ()):
        d = F.when(F.col("src") == s, F.col("d"))
        aggs += [F.min(d).alias(f"{s}_min"), F.max(d).alias(f"{s}_max")]
    return u.groupBy("ticker").agg(*aggs)


# Fields carried for each latest-row section of the overview.
QUOTE_FIELDS = ["trade_date", "last_price", "min_price", "max_price", "variation_pct", "financial_volume"]
TRADE_FIELDS = ["trade_date", "open_price", "last_price", "financial_volume", "trade_count"]
POINT_FIELDS = ["quoted_at", "close_price", "price_fluctuation_pct"]


def asset_overview(assets: DataFrame, quotes: DataFrame | None, trades: DataFrame, points: DataFrame,
                   hist: DataFrame | None = None) -> DataFrame:
    """Register fields, latest quote / trade / intraday point, date ranges,
    derived latest variation and volume, latest update and section flags.
    ``quotes`` None: quotes and trades are the same rows, read once."""
    def shape(df, src, at):
        mine = ("quote", "trade") if src == "daily" else (src,)
        cols = [F.col("ticker"), F.lit(src).alias("src"), F.col(at).cast("timestamp_ntz").alias("at")]
        for s, fs in (("asset", ["asset_name", "isin", "segment"]), ("quote", QUOTE_FIELDS),
                      ("trade", TRADE_FIELDS), ("intraday", POINT_FIELDS)):
            if s in mine:
                cols.append(F.struct(*[F.col(c) for c in fs]).alias(f"p_{s}"))
            else:
                cols.append(F.lit(None).cast(struct_type(s)).alias(f"p_{s}"))
        return df.select(*cols)

    parts = [
        shape(assets.withColumn("_at", F.lit(None).cast("timestamp_ntz")), "asset", "_at"),
        shape(points, "intraday", "quoted_at"),
    ]
    if quotes is None:
        parts.append(shape(trades, "daily", "trade_date"))
    else:
        parts += [shape(quotes, "quote", "trade_date"), shape(trades, "trade", "trade_date")]
    if hist is not None:
        parts.append(shape(hist, "hist", "trade_date"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)

    def of(s):
        return F.col("src").isin(s, "daily") if s in ("quote", "trade") else F.col("src") == s

    def latest(s):
        on = of(s)
        return F.max_by(F.when(on, F.col(f"p_{s}")), F.when(on, F.col("at")))

    def bound(fn, s):
        return fn(F.when(of(s), F.col("at").cast("date")))

    agg = u.groupBy("ticker").agg(
        F.max_by(F.when(F.col("src") == "asset", F.col("p_asset")), F.when(F.col("src") == "asset", F.lit(1))).alias("asset"),
        latest("quote").alias("q"), latest("trade").alias("t"), latest("intraday").alias("f"),
        bound(F.min, "quote").alias("quotes_min"), bound(F.max, "quote").alias("quotes_max"),
        bound(F.min, "trade").alias("trades_min"), bound(F.max, "trade").alias("trades_max"),
        bound(F.min, "hist").alias("hist_min"), bound(F.max, "hist").alias("hist_max"),
    )
    return overview_columns(agg)


def overview_columns(agg: DataFrame) -> DataFrame:
    """The overview's columns from the latest rows (``asset``, ``q``, ``t``,
    ``f``) and the date bounds of every ticker."""
    return agg.select(
        "ticker",
        F.col("asset.asset_name").alias("asset_name"), F.col("asset.isin").alias("isin"),
        F.col("asset.segment").alias("segment"),
        F.col("q.trade_date").alias("quote_date"), F.col("q.last_price").alias("quote_last_price"),
        F.col("t.trade_date").alias("trade_date"), F.col("t.last_price").alias("trade_last_price"),
        F.col("t.trade_count").alias("trade_count"),
        F.col("f.quoted_at").alias("intraday_at"), F.col("f.close_price").alias("intraday_close_price"),
        "quotes_min", "quotes_max", "trades_min", "trades_max", "hist_min", "hist_max",
        F.col("q.variation_pct").alias("variation_pct_latest"),
        F.coalesce(F.col("q.financial_volume"), F.col("t.financial_volume")).alias("financial_volume_latest"),
        F.greatest(F.col("q.trade_date").cast("timestamp_ntz"), F.col("t.trade_date").cast("timestamp_ntz"),
                   F.col("f.quoted_at")).alias("latest_update_at"),
        F.col("asset").isNotNull().alias("has_asset"),
        F.col("q").isNotNull().alias("has_daily_quote"),
        F.col("t").isNotNull().alias("has_daily_trade"),
        F.col("f").isNotNull().alias("has_intraday"),
    )


def struct_type(section: str) -> str:
    return {
        "asset": "struct<asset_name:string,isin:string,segment:string>",
        "quote": "struct<trade_date:date,last_price:double,min_price:double,max_price:double,variation_pct:double,financial_volume:double>",
        "trade": "struct<trade_date:date,open_price:double,last_price:double,financial_volume:double,trade_count:bigint>",
        "intraday": "struct<quoted_at:timestamp_ntz,close_price:double,price_fluctuation_pct:double>",
    }[section]
