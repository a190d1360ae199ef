"""Market tables derived from the driver's TPC-H-style test data.

The analytical operators work on the market schema (instrument register,
daily bars, intraday points, historical fixed-width rows, run ledger).  These
functions derive those tables from the given parquet tables with Spark, so
every registered query scales with the input:

* ``dim_assets``      supplier x nation           one row per supplier
* ``daily_bars``      lineitem by (supplier, day) one bar per ticker and date
* ``intraday_points`` events                      one point per (user, ts)
* ``hist_lines``      orders                      245-character historical records
* ``run_ledger``      orders                      ledger rows

Tickers share one name space across sources: ``'S'`` + the key zero-padded to
ten digits, so suppliers, event users and customers line up by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.functions.numbers import half_up
from candlewick.sources.tables import read_test_table

# Fixed values of the derivation.
ASSET_FILE_DATE = "2001-12-31"
SOURCE_DAILY = "lineitem"
SOURCE_INTRADAY = "events"

#: Stored rows for each task that sorts derived rows.  Tables with less for every
#: core of the session keep Spark's own number of partitions.
ROWS_PER_TASK = 250_000


def tasks_for(stored: DataFrame) -> int | None:
    """Tasks for what is derived from a stored table, by a count of its footers;
    None: few rows, Spark's own number will do."""
    tasks = -(-stored.count() // ROWS_PER_TASK)
    return tasks if tasks > stored.sparkSession.sparkContext.defaultParallelism else None


def spread(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    return df.repartition(tasks, *keys) if tasks else df


def ticker_of(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("S"), F.lpad(k.cast("string"), 10, "0"))


def dim_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument register: one row per supplier.  ``nation`` is a fixed
    25-row dimension, so it is broadcast."""
    s = read_test_table(spark, sf_dir, "supplier")
    n = read_test_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left")
        .select(
            ticker_of("s_suppkey").alias("ticker"),
            F.col("s_name").alias("asset_name"),
            F.concat(F.lit("BRS"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("isin"),
            F.col("n_name").alias("segment"),
            F.when(F.col("s_acctbal") < 0, F.lit("UNIT")).otherwise(F.lit("SHARES")).alias("instrument_type"),
            F.lit(True).alias("is_active"),
            F.lit(ASSET_FILE_DATE).cast("date").alias("source_file_date"),
            F.col("s_acctbal").alias("acct_balance"),
        )
    )


def unit_trades(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    """Every lineitem as one trade of a ticker on a day at unit price
    (``where``: optional lineitem predicate that splits the data into batches)."""
    li = read_test_table(spark, sf_dir, "lineitem")
    if where is not None:
        li = li.where(where)
    return li.select(
        ticker_of("l_suppkey").alias("ticker"),
        F.to_date("l_shipdate").alias("trade_date"),
        half_up(F.col("l_extendedprice") / F.col("l_quantity"), 6).alias("px"),
        F.col("l_extendedprice").alias("notional"),
        F.col("l_quantity").alias("quantity"),
        # Order of trades inside a (ticker, day) as one number, so that min_by /
        # max_by keep fixed-width state and stay in a hash aggregate.
        F.expr("shiftleft(l_orderkey, 24) | shiftleft(cast(l_linenumber AS bigint), 20) | (l_partkey & 1048575)").alias("seq"),
    )


def daily_bars(spark: SparkSession, sf_dir: str, where=None, by_rows: bool = False) -> DataFrame:
    """Daily trades table (open, last, min, max, avg, variation, volume, count).

    One partial/final hash aggregate on (ticker, trade_date); the variation
    needs the previous day's last price, a window per ticker whose size is
    bounded by the number of calendar days, not by the data volume.

    ``by_rows``: both exchanges have tasks in proportion to the rows, so that no
    task holds or sorts more of them as the table grows.  The trades are then
    dealt by ticker and day before they are combined: a hot ticker is spread over its days.
    """
    tasks = tasks_for(read_test_table(spark, sf_dir, "lineitem")) if by_rows else None
    t = spread(unit_trades(spark, sf_dir, where), tasks, "ticker", "trade_date")
    bars = t.groupBy("ticker", "trade_date").agg(
        F.min_by("px", "seq").alias("open_price"),
        F.max_by("px", "seq").alias("last_price"),
        F.min("px").alias("min_price"),
        F.max("px").alias("max_price"),
        # Exact: sum of integer micro-units, rounded half-up by integer division.
        F.sum(F.round(F.col("px") * 1_000_000).cast("bigint")).alias("_sum_micro"),
        half_up(F.sum("notional"), 2).alias("financial_volume"),
        F.count(F.lit(1)).alias("trade_count"),
    )
    bars = spread(bars, tasks, "ticker")
    avg_price = F.expr("(2 * _sum_micro + trade_count) div (2 * trade_count)") / F.lit(1_000_000.0)
    prev = F.lag("last_price").over(Window.partitionBy("ticker").orderBy("trade_date"))
    return bars.select(
        "ticker", "trade_date", "open_price", "last_price", "min_price", "max_price", avg_price.alias("avg_price"),
        half_up((F.col("last_price") - prev) / prev * 100, 4).alias("variation_pct"),
        "financial_volume", "trade_count",
        F.lit(SOURCE_DAILY).alias("source_file_name"),
    )


def daily_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quotes table: the daily bars without an open price."""
    return daily_bars(spark, sf_dir).drop("open_price")


def settled_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily quotes table with rows of its own: one per customer and order
    day, other tickers and days than the trades have, nulls among its measures."""
    o = read_test_table(spark, sf_dir, "orders")
    price, many = F.col("o_totalprice"), F.count(F.lit(1)) > 1
    low, high = F.min(price), F.max(price)
    days = o.select(ticker_of("o_custkey").alias("ticker"), F.to_date("o_orderdate").alias("trade_date"), "o_totalprice")
    return spread(days, tasks_for(o), "ticker", "trade_date").groupBy("ticker", "trade_date").agg(
        high.alias("last_price"), low.alias("min_price"), high.alias("max_price"), F.lit(None).cast("double").alias("avg_price"),
        F.when(many, half_up((high - low) / low * 100, 4)).alias("variation_pct"),
        F.when(many, F.round(high * 100).cast("bigint").cast("double")).alias("financial_volume"),
        F.count(F.lit(1)).alias("trade_count"), F.lit("orders").alias("source_file_name"))


def intraday_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday points (ticker, quoted_at unique): one per event."""
    return points_from_events(read_test_table(spark, sf_dir, "events"))


def points_from_events(ev: DataFrame, with_order: bool = False) -> DataFrame:
    """The intraday-point projection of an events frame (batch or stream);
    ``with_order`` keeps ``event_id`` as the arrival order."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return ev.select(
        ticker_of("user_id").alias("ticker"),
        F.col("ts").alias("quoted_at"),
        F.to_date("ts").alias("trade_date"),
        F.col("value").alias("close_price"),
        ((k.cast("double") - F.lit(50.0)) / F.lit(10.0)).alias("price_fluctuation_pct"),
        F.lit(SOURCE_INTRADAY).alias("source_jsonl"),
        *([F.col("event_id")] if with_order else []),
    )


# The end-of-data marker line number of a trailer record.
TRAILER_LINE_NO = 9223372036854775807


def _price13(x: Column) -> Column:
    return F.lpad(F.round(x * 100).cast("bigint").cast("string"), 13, "0")


def hist_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical fixed-width files rendered from ``orders``:
    (file_name, line_no, line), one file per order year.

    Each order gives one ``01`` record (trade date = first day of its quarter,
    ticker from the customer, prices from the total); pending orders add a
    truncated line and urgent fulfilled orders a record of unknown type; every
    file gets a ``00`` header and a ``99`` trailer with its record count.
    """
    o = read_test_table(spark, sf_dir, "orders")
    tp = F.col("o_totalprice")
    year = F.year("o_orderdate").cast("string")
    td = F.to_date(F.date_trunc("quarter", "o_orderdate"))
    cust = F.col("o_custkey").cast("string")
    rec = F.concat(
        F.lit("01"), F.date_format(td, "yyyyMMdd"), F.lit("02"),
        F.rpad(F.concat(F.lit("S"), F.lpad(cust, 10, "0")), 12, " "),
        F.lit("010"),
        F.rpad(F.concat(F.lit("CUST"), cust), 12, " "),
        F.rpad(F.col("o_orderstatus"), 10, " "),
        F.lit("   "), F.lit("R$  "),
        _price13(tp), _price13(tp + 100), _price13(tp - 100), _price13(tp),
        _price13(tp + 50), _price13(tp + 49), _price13(tp + 51),
        F.lpad(F.dayofmonth("o_orderdate").cast("string"), 5, "0"),
        F.lpad(F.col("o_orderkey").cast("string"), 18, "0"),
        F.lpad((F.round(tp * 100).cast("bigint") * 10).cast("string"), 18, "0"),
        F.lit("0" * 13), F.lit(" "),
        F.when(F.col("o_orderstatus") == "O", F.lit("99991231")).otherwise(F.lit("00000000")),
        F.lit("0000001"), F.lit("0" * 13),
        F.concat(F.lit("BRS"), F.lpad(cust, 9, "0")),
        F.lit("100"),
    )
    file_name = F.concat(F.lit("COTAHIST_A"), year, F.lit(".TXT"))
    base = o.select(
        file_name.alias("file_name"), year.alias("year"), F.col("o_orderkey"),
        F.col("o_orderstatus"), F.col("o_orderpriority"), rec.alias("rec"))
    records = base.select("file_name", (F.col("o_orderkey") * 2 + 1).alias("line_no"), F.col("rec").alias("line"))
    extras = base.where((F.col("o_orderstatus") == "P") | ((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))).select(
        "file_name", (F.col("o_orderkey") * 2 + 2).alias("line_no"),
        F.when(F.col("o_orderstatus") == "P", F.substring("rec", 1, 200))
        .otherwise(F.concat(F.lit("02"), F.substring("rec", 3, 243))).alias("line"))
    per_file = base.groupBy("file_name", "year").agg(F.count(F.lit(1)).alias("n"))
    stamp = F.concat(F.lit("COTAHIST."), F.col("year"), F.lit("BOVESPA "), F.col("year"), F.lit("1231"))
    headers = per_file.select("file_name", F.lit(0).cast("bigint").alias("line_no"),
                             F.rpad(F.concat(F.lit("00"), stamp), 245, " ").alias("line"))
    trailers = per_file.select("file_name", F.lit(TRAILER_LINE_NO).cast("bigint").alias("line_no"),
                              F.rpad(F.concat(F.lit("99"), stamp, F.lpad(F.col("n").cast("string"), 11, "0")), 245, " ").alias("line"))
    return records.unionByName(extras).unionByName(headers).unionByName(trailers)


# Reference date of the universe queries.
UNIVERSE_REFERENCE_DATE = "1998-06-01"


def universe_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument register with the structural columns of the universe filter,
    rendered from supplier, nation and each supplier's first/last ship date;
    plus one footer ("noise") row per nation."""
    s = read_test_table(spark, sf_dir, "supplier")
    n = read_test_table(spark, sf_dir, "nation")
    span = read_test_table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").join(span, s.s_suppkey == span.l_suppkey, "left")
    rows = j.select(
        F.col("s_suppkey").alias("line_no"),
        F.concat(F.lit(" "), F.lower(ticker_of("s_suppkey")), F.lit(" ")).alias("ticker"),
        F.when(F.col("n_regionkey") == 0, F.lit("Derivatives")).otherwise(F.lit("Cash")).alias("segment"),
        F.when(F.col("s_acctbal") < 0, F.lit("OPTIONS")).otherwise(F.lit("EQUITY-CASH")).alias("market"),
        F.when(F.col("n_regionkey") == 4, F.lit("Units")).otherwise(F.lit("Shares")).alias("category"),
        F.coalesce(F.date_format("first_ship", "dd/MM/yyyy"), F.lit("")).alias("start_date"),
        F.when(F.col("s_acctbal") < 1000, F.date_format("last_ship", "dd/MM/yyyy")).otherwise(F.lit("")).alias("end_date"),
    )
    noise = n.select((F.lit(-1) - F.col("n_nationkey")).cast("bigint").alias("line_no"),
                     F.concat(F.lit("TOTAL "), F.col("n_name")).alias("ticker"), F.lit("Cash").alias("segment"),
                     F.lit("EQUITY-CASH").alias("market"), F.lit("Shares").alias("category"),
                     F.lit("").alias("start_date"), F.lit("").alias("end_date"))
    return rows.unionByName(noise)


def activity_rows(spark: SparkSession, sf_dir: str, day: str = UNIVERSE_REFERENCE_DATE) -> DataFrame:
    """Consolidated-trades rows of the 30 days up to ``day`` as text:
    single-trade days carry the ``-`` placeholder instead of a close price."""
    d = F.lit(day).cast("date")
    b = daily_bars(spark, sf_dir).where((F.col("trade_date") <= d) & (F.col("trade_date") > F.date_sub(d, 30)))
    return b.select(F.lower("ticker").alias("ticker"), F.col("trade_count").cast("string").alias("trade_count"),
                    F.when(F.col("trade_count") == 1, F.lit("-")).otherwise(F.col("last_price").cast("string")).alias("last_price"))
