"""Market movers and market-day overview.

For one date the ranking is ``orderBy(...).limit(10)`` (``TakeOrderedAndProject``).
For all dates it is ``row_number() over (partition by trade_date ...) <= 10``,
which Spark plans as a partial ``WindowGroupLimit`` before the shuffle, so a
date with millions of tickers sends only ten rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RANK_LIMIT = 10

# Overview section names.
SECTIONS = (
    "top_gainers",
    "top_losers",
    "most_traded_by_volume",
    "most_traded_by_financial_volume",
    "highest_trade_count",
)


def _ranked(df: DataFrame, order, limit: int, trade_date=None) -> DataFrame:
    if trade_date is not None:
        df = df.where(F.col("trade_date") == F.lit(trade_date).cast("date"))
    w = Window.partitionBy("trade_date").orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def top_gainers(quotes: DataFrame, limit: int = RANK_LIMIT, trade_date=None) -> DataFrame:
    """Variation desc, ticker asc; rows without variation excluded."""
    q = quotes.where(F.col("variation_pct").isNotNull()).select("trade_date", "ticker", "variation_pct", "last_price")
    return _ranked(q, [F.col("variation_pct").desc(), F.col("ticker").asc()], limit, trade_date)


def top_losers(quotes: DataFrame, limit: int = RANK_LIMIT, trade_date=None) -> DataFrame:
    """Variation asc, ticker asc."""
    q = quotes.where(F.col("variation_pct").isNotNull()).select("trade_date", "ticker", "variation_pct", "last_price")
    return _ranked(q, [F.col("variation_pct").asc(), F.col("ticker").asc()], limit, trade_date)


def top_by(trades: DataFrame, measure: str, limit: int = RANK_LIMIT, trade_date=None) -> DataFrame:
    """Measure desc with nulls last, ticker asc."""
    t = trades.select("trade_date", "ticker", "trade_count", "financial_volume")
    return _ranked(t, [F.col(measure).desc_nulls_last(), F.col("ticker").asc()], limit, trade_date)


def traded_assets(trades: DataFrame, trade_date=None) -> DataFrame:
    """A3: distinct traded tickers per date."""
    if trade_date is not None:
        trades = trades.where(F.col("trade_date") == F.lit(trade_date).cast("date"))
    return trades.groupBy("trade_date").agg(F.countDistinct("ticker").alias("traded_assets_count"))


def market_overview(quotes: DataFrame | None, trades: DataFrame, trade_date=None, limit: int = RANK_LIMIT) -> DataFrame:
    """T4: long frame (trade_date, section, rank, ticker, measures) plus one
    ``traded_assets_count`` row per date.

    Every row is offered once to each of its rankings under a common sort
    value, and one ranking by (date, section) serves all of them: one read and
    one exchange, with only the best rows of each map task shuffled.  The
    volume ranking is served under both of its names.  ``quotes`` None: quotes
    and trades are the same rows, read once.
    """
    def rows(df):
        if trade_date is not None:
            df = df.where(F.col("trade_date") == F.lit(trade_date).cast("date"))
        have = {c: F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)
                for c, t in (("variation_pct", "double"), ("last_price", "double"), ("trade_count", "bigint"), ("financial_volume", "double"))}
        return df.select("trade_date", "ticker", *[c.alias(n) for n, c in have.items()])

    up, volume, count = F.col("variation_pct"), F.col("financial_volume"), F.col("trade_count").cast("double")
    movers = [("top_gainers", up), ("top_losers", -up)]
    actives = [("by_volume", volume), ("highest_trade_count", count)]

    def offered(df, sections):
        pair = F.explode(F.array(*[F.struct(F.lit(n).alias("section"), v.alias("value")) for n, v in sections])).alias("o")
        out = rows(df).select("*", pair)
        return out.where(F.col("o.value").isNotNull() | ~F.col("o.section").isin("top_gainers", "top_losers"))

    every = offered(trades, movers + actives) if quotes is None else offered(quotes, movers).unionByName(offered(trades, actives))
    best = Window.partitionBy("trade_date", "o.section").orderBy(F.col("o.value").desc_nulls_last(), F.col("ticker").asc())
    ranked = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    names = F.when(F.col("o.section") == "by_volume", F.array(F.lit("most_traded_by_volume"), F.lit("most_traded_by_financial_volume"))).otherwise(F.array("o.section"))
    mover = F.col("o.section").isin("top_gainers", "top_losers")

    def only(flag, c):
        return F.when(flag, F.col(c)).alias(c)

    top = ranked.select("trade_date", F.explode(names).alias("section"), "rank", "ticker", only(mover, "variation_pct"), only(mover, "last_price"),
                        only(~mover, "trade_count"), only(~mover, "financial_volume"))
    none = F.lit(None).cast("double")
    counts = traded_assets(trades, trade_date).select(
        "trade_date", F.lit("traded_assets_count").alias("section"), F.lit(None).cast("int").alias("rank"),
        F.lit(None).cast("string").alias("ticker"), none.alias("variation_pct"), none.alias("last_price"),
        F.col("traded_assets_count").alias("trade_count"), none.alias("financial_volume"))
    return top.unionByName(counts)
