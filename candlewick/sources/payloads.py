"""Landed quote payloads.

The payload job starts from a *landed* table (requested_ticker, body,
http_status, load_date); fetching is outside the library.  Bodies are parsed
with ``from_json`` against declared schemas; a bad body becomes an error row
instead of stopping the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.dates import payload_date
from candlewick.functions.numbers import payload_decimal

QUOTE_POINT = T.StructType([
    # The price and fluctuation may be numbers or text: read both as text.
    T.StructField("closPric", T.StringType()),
    T.StructField("dtTm", T.StringType()),
    T.StructField("prcFlcn", T.StringType()),
])
NESTED_SCHEMA = T.StructType([
    T.StructField("BizSts", T.StructType([T.StructField("cd", T.StringType())])),
    T.StructField("Msg", T.StructType([T.StructField("dtTm", T.StringType())])),
    T.StructField("TradgFlr", T.StructType([
        T.StructField("date", T.StringType()),
        T.StructField("scty", T.StructType([
            T.StructField("symb", T.StringType()),
            T.StructField("lstQtn", T.ArrayType(QUOTE_POINT)),
        ])),
    ])),
])
FLAT_FIELDS = ("codNeg", "ticker", "tradeDate", "lastPrice", "minPrice", "maxPrice", "avgPrice", "oscillationVal")
FLAT_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in FLAT_FIELDS])
FLAT_WRAPPED = T.StructType([T.StructField("results", T.ArrayType(FLAT_SCHEMA))])


def _nested(body: Column) -> Column:
    return F.from_json(body, NESTED_SCHEMA, {"mode": "PERMISSIVE"})


def _may_have(body: Column, *keys: str) -> Column:
    """False only where no key of the body can be one of ``keys``: neither is
    written out, and no escape could spell it.  Spares a parse for each of them."""
    found = body.contains("\\")
    for k in keys:
        found = found | body.contains(k)
    return found


def payload_series(landed: DataFrame, *, load_date=None) -> DataFrame:
    """Every quote point of every nested payload, with its position.
    Ticker = ``symb`` else the requested ticker (upper); the trade date comes
    from the floor block, else ``load_date`` (C11 fallback)."""
    p = landed.select("requested_ticker", _nested(F.col("body")).alias("b"),
                      (F.col("load_date") if load_date is None else F.lit(load_date).cast("date")).alias("_ld"))
    ticker = F.upper(F.trim(F.coalesce(F.col("b.TradgFlr.scty.symb"), F.col("requested_ticker"))))
    base = p.select(
        ticker.alias("ticker"),
        payload_date(F.col("b.TradgFlr.date"), F.col("_ld")).alias("trade_date"),
        F.col("b.Msg.dtTm").alias("message_datetime"),
        F.posexplode_outer("b.TradgFlr.scty.lstQtn").alias("pos", "q"),
    )
    return base.select(
        "ticker", "trade_date", "message_datetime", "pos",
        F.col("q.dtTm").alias("quote_time"),
        payload_decimal(F.col("q.closPric")).alias("close_price"),
        payload_decimal(F.col("q.prcFlcn"), 10, 4).alias("price_fluctuation_pct"),
    ).where(F.col("pos").isNotNull())


def payload_snapshot(landed: DataFrame, *, load_date=None) -> DataFrame:
    """Latest point per payload (the last array element); nulls when the
    list is empty."""
    p = landed.select("requested_ticker", _nested(F.col("body")).alias("b"),
                      (F.col("load_date") if load_date is None else F.lit(load_date).cast("date")).alias("_ld"))
    last = F.try_element_at(F.col("b.TradgFlr.scty.lstQtn"), F.lit(-1))
    return p.select(
        F.upper(F.trim(F.coalesce(F.col("b.TradgFlr.scty.symb"), F.col("requested_ticker")))).alias("ticker"),
        payload_date(F.col("b.TradgFlr.date"), F.col("_ld")).alias("trade_date"),
        last["dtTm"].alias("quote_time"),
        payload_decimal(last["closPric"]).alias("latest_close_price"),
        payload_decimal(last["prcFlcn"], 10, 4).alias("latest_price_fluctuation_pct"),
        F.coalesce(F.size("b.TradgFlr.scty.lstQtn"), F.lit(0)).alias("points_count"),
    )


def daily_fluctuation(landed: DataFrame, *, load_date=None) -> DataFrame:
    """One daily row per payload whatever its format.

    Nested payloads (``TradgFlr`` or ``BizSts`` present) give the last point's
    price and fluctuation; flat payloads (optionally wrapped as
    ``results[0]``) map codNeg/ticker, tradeDate, last/min/max/avg price and
    oscillation.  Bodies of neither shape get ``error``."""
    body = F.col("body")
    is_nested = _may_have(body, "TradgFlr", "BizSts") & (F.get_json_object(body, "$.TradgFlr").isNotNull() | F.get_json_object(body, "$.BizSts").isNotNull())
    ld = F.col("load_date") if load_date is None else F.lit(load_date).cast("date")
    shapes = landed.select("requested_ticker", "body", ld.alias("ld"), is_nested.alias("is_nested"))
    # A body is parsed as the shape it has, once for all columns.
    floor, flat = F.col("floor"), F.col("flat")
    wrapped = F.when(_may_have(body, "results"), F.try_element_at(F.from_json(body, FLAT_WRAPPED, {"mode": "PERMISSIVE"})["results"], F.lit(1)))
    parsed = shapes.select(
        "requested_ticker", "ld", "is_nested",
        F.when(F.col("is_nested"), _nested(body)["TradgFlr"]).alias("floor"),
        F.when(~F.col("is_nested"), F.coalesce(wrapped, F.from_json(body, FLAT_SCHEMA, {"mode": "PERMISSIVE"}))).alias("flat"))
    flat_ticker = F.coalesce(F.when(F.trim(flat["codNeg"]) != "", flat["codNeg"]), flat["ticker"])
    is_nested, is_flat = F.col("is_nested"), F.col("is_flat")

    def either(of_nested, of_flat):
        return F.when(is_nested, of_nested).otherwise(of_flat)

    # ``flat`` is null unless the body is a flat one with a ticker, so its fields are too.
    known = parsed.select("requested_ticker", "ld", "is_nested", "floor", F.try_element_at(floor["scty"]["lstQtn"], F.lit(-1)).alias("last"),
                          F.when(flat_ticker.isNotNull(), flat).alias("flat"), flat_ticker.alias("flat_ticker"), flat_ticker.isNotNull().alias("is_flat"))
    texts = known.select(
        "is_nested", "is_flat", "ld",
        F.coalesce(either(floor["scty"]["symb"], F.col("flat_ticker")), F.col("requested_ticker")).alias("ticker"),
        either(floor["date"], flat["tradeDate"]).alias("day"),
        either(F.col("last.closPric"), flat["lastPrice"]).alias("last_price"),
        *[flat[f].alias(c) for f, c in (("minPrice", "min_price"), ("maxPrice", "max_price"), ("avgPrice", "avg_price"))],
        either(F.col("last.prcFlcn"), flat["oscillationVal"]).alias("variation"))
    return texts.select(
        F.upper(F.trim("ticker")).alias("ticker"),
        F.when(is_nested, F.lit("nested")).when(is_flat, F.lit("flat")).alias("payload_format"),
        F.when(is_nested | is_flat, payload_date(F.col("day"), F.col("ld"))).alias("trade_date"),
        *[payload_decimal(F.col(c)).alias(c) for c in ("last_price", "min_price", "max_price", "avg_price")],
        payload_decimal(F.col("variation"), 10, 4).alias("variation_pct"),
        F.when(~is_nested & ~is_flat, F.lit("unrecognised payload")).alias("error"),
    )


def payload_records(landed: DataFrame, *, load_date=None) -> DataFrame:
    """One JSONL record per payload that could be read, with all its
    header fields and its points in order; an empty history is kept.

    ``collected_at`` comes from the landed column of that name, if there is one.
    """
    ld = F.col("load_date") if load_date is None else F.lit(load_date).cast("date")
    collected = F.col("collected_at").cast("string") if "collected_at" in landed.columns else F.lit(None).cast("string")
    p = landed.select("requested_ticker", "http_status", _nested(F.col("body")).alias("b"), ld.alias("ld"), collected.alias("collected_at"))
    good = p.where((F.col("http_status") == 200) & F.col("b.TradgFlr").isNotNull())
    points = F.coalesce(F.col("b.TradgFlr.scty.lstQtn"), F.array().cast(T.ArrayType(QUOTE_POINT)))
    day = payload_date(F.col("b.TradgFlr.date"), F.col("ld"))
    record = F.struct(
        F.col("requested_ticker").alias("ticker_requested"),
        F.upper(F.trim(F.coalesce(F.col("b.TradgFlr.scty.symb"), F.col("requested_ticker")))).alias("ticker_returned"),
        F.coalesce(F.col("b.BizSts.cd"), F.lit("")).alias("business_status_code"),
        F.when(F.col("b.Msg.dtTm") != "", F.col("b.Msg.dtTm")).alias("message_datetime"),
        F.date_format(day, "yyyy-MM-dd").alias("trade_date"),
        "collected_at",
        F.size(points).alias("points_count"),
        F.transform(points, lambda q: F.struct(
            F.when(q["dtTm"] != "", q["dtTm"]).alias("quote_time"),
            payload_decimal(q["closPric"]).cast("string").alias("close_price"),
            payload_decimal(q["prcFlcn"], 10, 4).cast("string").alias("price_fluctuation_percentage"))).alias("price_history"),
    )
    return good.select(day.alias("trade_date"), record.alias("record"))


def batch_report(landed: DataFrame) -> DataFrame:
    """K9: the per-ticker report (seven columns), success and failure rows."""
    nested = _nested(F.col("body"))
    n = F.coalesce(F.size(nested["TradgFlr"]["scty"]["lstQtn"]), F.lit(0))
    ok = (F.col("http_status") == 200) & nested["TradgFlr"].isNotNull()
    return landed.select(
        F.col("requested_ticker").alias("ticker_requested"),
        F.when(ok, F.upper(F.coalesce(nested["TradgFlr"]["scty"]["symb"], F.col("requested_ticker")))).alias("ticker_returned"),
        F.when(ok, nested["TradgFlr"]["date"]).alias("trade_date"),
        F.col("http_status"),
        ok.alias("request_succeeded"),
        F.when(ok, n).otherwise(F.lit(0)).alias("points_count"),
        F.when(~ok, F.concat(F.lit("HTTP "), F.col("http_status").cast("string"))).alias("error_message"),
    )


def batch_outcome(report: DataFrame) -> DataFrame:
    """Successes and failures."""
    return report.groupBy("request_succeeded").agg(F.count(F.lit(1)).alias("n"))
