"""Landing-zone file manifests.

A manifest is a DataFrame of file paths (from ``binaryFile`` with only
``path``/``modificationTime``/``length`` selected, so file contents are not
read).  Every resolution rule is a filter / aggregate over it, so thousands
of dated files resolve in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.dates import file_name_date, try_date

# Naming patterns.
TIMESTAMP_TAG = r"(\d{8}T\d{6})"
DATE_TAG = r"(\d{8})"
HIST_CANONICAL = r"(?i)COTAHIST[._]A(\d{4})"
MAX_TICKER_LENGTH = 20
#: Load window of historical files without a year in their name.
UNDATED_WINDOW = 2**31 - 1
TICKER_COLUMN = "Instrumento financeiro"


def manifest(spark: SparkSession, directory: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(directory).select("path", "modificationTime", "length")
    return files.withColumn("name", F.element_at(F.split("path", "/"), -1))


def resolve_snapshot(files: DataFrame, target_date) -> DataFrame:
    """The file for the target date, else the day before.

    A file belongs to the date in its name; within a folder named by a date,
    one without a date in its name belongs to the folder's, after those that
    name it.  Within a day the greatest name wins.  No file is an error.
    """
    d = F.lit(str(target_date)).cast("date")
    own = file_name_date(F.col("name"))
    folder = try_date(F.element_at(F.split("path", "/"), -2), "yyyy-MM-dd") if "path" in files.columns else F.lit(None).cast("date")
    f = files.withColumn("file_date", F.coalesce(own, folder)).withColumn("named", own.isNotNull())
    cand = f.where(F.col("file_date").isin(d, F.date_sub(d, 1)))
    best = cand.orderBy(F.col("file_date").desc(), F.col("named").desc(), F.col("name").desc()).limit(1).drop("named")
    if best.isEmpty():
        raise FileNotFoundError(f"no file for {target_date} or the day before")
    return best


def pair_siblings(registers: DataFrame, trades: DataFrame) -> DataFrame:
    """Each register file with the trades file carrying the same
    yyyymmdd tag, else the last trades file by name."""
    r = registers.withColumn("tag", F.regexp_extract("name", DATE_TAG, 1))
    t = trades.withColumn("tag", F.regexp_extract("name", DATE_TAG, 1)).select("tag", F.col("path").alias("trades_path"))
    fallback = trades.select(F.max_by("path", "name")).scalar()   # scalar subquery, no join
    same = r.join(t.where(F.col("tag") != ""), "tag", "left")
    return same.select(F.col("path").alias("register_path"), F.coalesce("trades_path", fallback).alias("trades_path"))


def latest_by_timestamp(files: DataFrame) -> DataFrame:
    """The file with the greatest embedded ``yyyymmddTHHMMSS`` tag."""
    tagged = files.withColumn("tag", F.regexp_extract("name", TIMESTAMP_TAG, 1)).where(F.col("tag") != "")
    return tagged.orderBy(F.col("tag").desc(), F.col("name").desc()).limit(1)


def historical_file_set(files: DataFrame, *, years: list[int] | None = None, year_from: int | None = None,
                        year_to: int | None = None) -> DataFrame:
    """S18 + S19: historical files by year / year range (swapped when
    reversed), de-duplicated, ordered by (year, path) with non-canonical names
    last, grouped into two-year load windows anchored at the minimum year."""
    y = F.regexp_extract("name", HIST_CANONICAL, 1)
    f = files.withColumn("canonical", y != "").withColumn(
        "file_year", F.when(y != "", y.cast("int")).otherwise(F.regexp_extract("name", r"(\d{4})", 1).try_cast("int")))
    if year_from is not None and year_to is not None:
        lo, hi = sorted((year_from, year_to))
        f = f.where(F.col("file_year").between(lo, hi))
    if years:
        f = f.where(F.col("file_year").isin(years))
    f = f.dropDuplicates(["path"])
    first_year = f.select(F.min("file_year")).scalar()
    # A file whose name holds no year is loaded in a last window of its own.
    window = F.floor((F.col("file_year") - first_year) / 2).cast("int")
    return f.withColumn("load_window", F.coalesce(window, F.lit(UNDATED_WINDOW))) \
        .withColumn("sort_key", F.struct(~F.col("canonical"), F.col("file_year"), F.col("path")))


def resolve_by_patterns(files: DataFrame, base: str, target_date, patterns: tuple[str, ...] = ("{name}_{date}.csv", "{name}_{date}.zip", "{name}.csv", "{name}.zip")) -> DataFrame:
    """The first naming pattern that exists wins."""
    ds = str(target_date).replace("-", "")
    names = [p.format(name=base, date=ds) for p in patterns]
    rank = F.lit(None).cast("int")
    for i in reversed(range(len(names))):
        rank = F.when(F.col("name") == names[i], F.lit(i)).otherwise(rank)
    return files.withColumn("pattern_rank", rank).where(F.col("pattern_rank").isNotNull()) \
        .orderBy("pattern_rank").limit(1)


def ticker_list(register: DataFrame, column: str = TICKER_COLUMN, order: str = "line_no") -> DataFrame:
    """Valid tickers (upper, non-empty, <= 20 chars, no space), distinct,
    first-seen order."""
    if column not in register.columns:
        raise ValueError(f"column {column!r} is required")
    t = F.upper(F.trim(F.col(f"`{column}`")))
    ok = (t != "") & ~t.contains(" ") & (F.length(t) <= MAX_TICKER_LENGTH)
    return register.where(ok).groupBy(t.alias("ticker")).agg(F.min(order).alias("first_seen"))


def backfill_status(spark: SparkSession, files: DataFrame, date_from, date_to) -> DataFrame:
    """One row per day of [date_from, date_to]: ``ok`` when a file for
    that day exists, else ``skipped``."""
    if str(date_to) < str(date_from):
        raise ValueError("date_to must not be before date_from")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(str(date_from)).cast("date"),
                                                      F.lit(str(date_to)).cast("date"))).alias("day"))
    found = files.select(file_name_date(F.col("name")).alias("day"), "path").where(F.col("day").isNotNull()) \
        .groupBy("day").agg(F.min("path").alias("path"))
    return days.join(found, "day", "left").select(
        "day", F.when(F.col("path").isNotNull(), F.lit("ok")).otherwise(F.lit("skipped")).alias("status"), "path")
