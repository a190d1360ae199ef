"""Fixed-width historical quotation files.

A file is latin-1 text of 245-character records: ``00`` header, ``01`` quote
records, ``99`` trailer.  The scan is ``spark.read.text`` (splittable, one
task per block); the raw bytes are re-decoded as ISO-8859-1 and sliced with
``substring`` in one projection.  Every record carries
``(file_name, line_no)`` so that "last row wins" can be decided by file order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.dates import yyyymmdd
from candlewick.functions.numbers import digits_int, digits_scaled
from candlewick.functions.text import fixed_code
from candlewick.sources.lines import base_name
from candlewick.sources.lines import scan as lines_scan
from candlewick.sources.manifest import HIST_CANONICAL

# ---------------------------------------------------------------------------
# Record layout (0-based [start, end) character slices).
RECORD_LEN = 245
TIP_HEADER, TIP_QUOTE, TIP_TRAILER = "00", "01", "99"
LAYOUT = (
    ("tipreg", 0, 2),
    ("trade_date_raw", 2, 10),
    ("cod_bdi", 10, 12),
    ("codneg", 12, 24),
    ("tp_merc", 24, 27),
    ("nomres", 27, 39),
    ("especi", 39, 49),
    ("prazot", 49, 52),
    ("modref", 52, 56),
    ("preabe", 56, 69),
    ("premax", 69, 82),
    ("premin", 82, 95),
    ("premed", 95, 108),
    ("preult", 108, 121),
    ("preofc", 121, 134),
    ("preofv", 134, 147),
    ("totneg", 147, 152),
    ("quatot", 152, 170),
    ("voltot", 170, 188),
    ("preexe", 188, 201),
    ("indopc", 201, 202),
    ("datven", 202, 210),
    ("fatcot", 210, 217),
    ("ptoexe", 217, 230),
    ("codisin", 230, 242),
    ("dismes", 242, 245),
)
# Header / trailer patterns.
HEADER_PATTERN = r"^00COTAHIST\.(\d{4})BOVESPA (\d{8})"
TRAILER_PATTERN = r"^99COTAHIST\.(\d{4})BOVESPA (\d{8})(\d{11})"
# Natural key of a historical row.
NATURAL_KEY = (
    "trade_date", "codneg", "cod_bdi", "tp_merc", "especi", "prazo_term_days",
    "moeda_ref", "expiration_key", "isin", "distribution_num", "ind_opc",
)
# ---------------------------------------------------------------------------


def scan_lines(spark: SparkSession, paths, *, path_glob: str | None = None) -> DataFrame:
    """Read text files as (file_name, line_no, line), bytes as ISO-8859-1;
    ``line_no`` orders the lines of a file (see ``sources.lines``)."""
    return lines_scan(spark, paths, encoding="ISO-8859-1", path_glob=path_glob)


def _slice(line: Column, start: int, end: int) -> Column:
    return F.substring(line, start + 1, end - start)


def split_records(lines: DataFrame) -> DataFrame:
    """S8 + F4: records of the right length and type ``01``, sliced into the
    26 raw text fields (plus ``file_name``/``line_no``)."""
    line = F.col("line")
    quotes = lines.where((F.length(line) == RECORD_LEN) & (F.substring(line, 1, 2) == TIP_QUOTE))
    return quotes.select("file_name", "line_no", *[_slice(line, s, e).alias(n) for n, s, e in LAYOUT])


def _expiration_key(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.rlike(r"^[0-9]{8}$"), t).otherwise(F.lit("00000000"))


def normalize(raw: DataFrame) -> DataFrame:
    """Typed historical rows; rows without a valid trade date or
    without a ticker are dropped (counted as invalid by ``parse_stats``)."""
    codneg = F.upper(F.trim("codneg"))
    exp_key = _expiration_key(F.col("datven"))
    dist = F.substring(F.coalesce(F.col("dismes"), F.lit("")), 1, 3)
    ind = F.substring(F.trim("indopc"), 1, 1)
    nomres = F.substring(F.trim("nomres"), 1, 12)
    out = raw.select(
        "file_name", "line_no",
        yyyymmdd("trade_date_raw").alias("trade_date"),
        F.substring(codneg, 1, 20).alias("ticker"),
        F.substring(codneg, 1, 12).alias("codneg"),
        fixed_code(F.col("cod_bdi"), 2).alias("cod_bdi"),
        fixed_code(F.col("tp_merc"), 3, "000").alias("tp_merc"),
        F.when(nomres != "", nomres).alias("nomres"),
        F.substring(F.trim("especi"), 1, 10).alias("especi"),
        F.coalesce(digits_int("prazot", "int"), F.lit(-1)).alias("prazo_term_days"),
        fixed_code(F.col("modref"), 4).alias("moeda_ref"),
        digits_scaled("preabe", 13, 100, "decimal(18,6)").alias("open_price"),
        digits_scaled("premax", 13, 100, "decimal(18,6)").alias("max_price"),
        digits_scaled("premin", 13, 100, "decimal(18,6)").alias("min_price"),
        digits_scaled("premed", 13, 100, "decimal(18,6)").alias("avg_price"),
        digits_scaled("preult", 13, 100, "decimal(18,6)").alias("last_price"),
        digits_scaled("preofc", 13, 100, "decimal(18,6)").alias("best_bid"),
        digits_scaled("preofv", 13, 100, "decimal(18,6)").alias("best_ask"),
        digits_int("totneg", "bigint").alias("trade_count"),
        digits_scaled("quatot", 18, 1, "decimal(24,4)").alias("quantity_total"),
        digits_scaled("voltot", 18, 100, "decimal(24,4)").alias("volume_financial"),
        digits_scaled("preexe", 13, 100, "decimal(18,6)").alias("strike_price"),
        F.when(ind == "", F.lit(" ")).otherwise(ind).alias("ind_opc"),
        F.when(exp_key == "00000000", F.lit(None).cast("date")).otherwise(yyyymmdd(exp_key)).alias("expiration_date"),
        exp_key.alias("expiration_key"),
        digits_int("fatcot", "int").alias("quotation_factor"),
        digits_scaled("ptoexe", 13, 1000000, "decimal(24,8)").alias("strike_points"),
        F.substring(F.trim("codisin"), 1, 12).alias("isin"),
        F.rpad(dist, 3, " ").alias("distribution_num"),
        F.substring(base_name("file_name"), 1, 255).alias("source_file_name"),
    )
    return out.where(F.col("trade_date").isNotNull() & (F.col("codneg") != ""))


def parse_lines(lines: DataFrame) -> DataFrame:
    return normalize(split_records(lines))


def file_order(path) -> Column:
    """Canonical names by year, then the others; paths within."""
    year = F.regexp_extract(base_name(path), HIST_CANONICAL, 1)
    return F.struct((year == "").alias("other"), year.alias("year"), F.col(path).alias("path"))


def dedupe_last(rows: DataFrame, key=NATURAL_KEY) -> DataFrame:
    """One row per natural key, the last in file order and line order.

    An aggregate (``max_by`` of the row struct) instead of a window, so it is
    combined map-side and a hot key does not gather its rows in one task."""
    others = [c for c in rows.columns if c not in key]
    order = F.struct(file_order("file_name").alias("file"), "line_no")
    return rows.groupBy(*key).agg(F.max_by(F.struct(*others), order).alias("_r")).select(
        *key, *[F.col(f"_r.{c}").alias(c) for c in others])


def line_counters() -> list:
    """A6 counters of scanned lines, for ``DataFrame.observe`` or ``agg``."""
    is_len = F.length("line") == RECORD_LEN
    tip = F.substring("line", 1, 2)
    return [
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(is_len & (tip == TIP_HEADER)).alias("header_rows"),
        F.count_if(is_len & (tip == TIP_TRAILER)).alias("trailer_rows"),
        F.count_if(is_len & (tip == TIP_QUOTE)).alias("quote_rows"),
        F.count_if(~is_len).alias("skipped_wrong_length"),
        F.count_if(is_len & ~tip.isin(TIP_HEADER, TIP_QUOTE, TIP_TRAILER)).alias("skipped_unknown_tip"),
    ]


def file_metadata(lines: DataFrame) -> DataFrame:
    """Per file, the first header and the last trailer (year, file date,
    declared record count) next to the counted ``01`` records, so the
    declared count can be reconciled."""
    line = F.col("line")
    trimmed = F.trim(line)
    is_len = F.length(line) == RECORD_LEN
    tip = F.substring(line, 1, 2)
    hdr = is_len & (tip == TIP_HEADER)
    trl = is_len & (tip == TIP_TRAILER)
    order = F.col("line_no")
    m = lines.groupBy("file_name").agg(
        F.min_by(F.when(hdr, trimmed), F.when(hdr, order)).alias("_h"),
        F.max_by(F.when(trl, trimmed), F.when(trl, order)).alias("_t"),
        F.count_if(is_len & (tip == TIP_QUOTE)).alias("quote_records"),
    )

    def grp(c, pat, i, typ):
        return F.when(F.col(c).rlike(pat), F.regexp_extract(c, pat, i).try_cast(typ))

    return m.select(
        "file_name",
        grp("_h", HEADER_PATTERN, 1, "int").alias("header_year"),
        grp("_h", HEADER_PATTERN, 2, "string").alias("header_file_date"),
        grp("_t", TRAILER_PATTERN, 1, "int").alias("trailer_year"),
        grp("_t", TRAILER_PATTERN, 2, "string").alias("trailer_file_date"),
        grp("_t", TRAILER_PATTERN, 3, "bigint").alias("declared_records"),
        "quote_records",
        (grp("_t", TRAILER_PATTERN, 3, "bigint") == F.col("quote_records")).alias("count_matches"),
    )


def parse_stats(lines: DataFrame) -> DataFrame:
    """One row of counters per file.  Duplicate keys are
    ``valid - count(distinct key)`` computed by Spark, so tracking them never
    holds keys in driver memory."""
    base = lines.groupBy("file_name").agg(*line_counters())
    valid = parse_lines(lines)
    per_key = valid.groupBy("file_name", *NATURAL_KEY).agg(F.count(F.lit(1)).alias("n"))
    dup = per_key.groupBy("file_name").agg(
        F.sum("n").alias("normalized_valid"), F.sum(F.col("n") - 1).alias("in_file_duplicate_keys"))
    return (
        base.join(dup, "file_name", "left")
        .select(
            "file_name", "lines_read", "header_rows", "trailer_rows", "quote_rows",
            "skipped_wrong_length", "skipped_unknown_tip",
            F.coalesce("normalized_valid", F.lit(0)).cast("bigint").alias("normalized_valid"),
            (F.col("quote_rows") - F.coalesce("normalized_valid", F.lit(0))).cast("bigint").alias("normalized_invalid"),
            F.coalesce("in_file_duplicate_keys", F.lit(0)).cast("bigint").alias("in_file_duplicate_keys"),
        )
    )
