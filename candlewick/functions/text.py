"""String column expressions (C4, C17, C24, C26) and the ticker rule.

Everything here is a ``Column`` built from built-in functions; nothing calls
Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Latin accented letters and their plain forms, used to strip
# accents inside expressions (``translate`` works on code points).
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY"

# Column length limits of the instrument table.
TICKER_MAX = 20
ISIN_MAX = 20
ASSET_NAME_MAX = 200
SEGMENT_MAX = 100
INSTRUMENT_TYPE_MAX = 50


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Without white space of any kind (tabs, no-break spaces, ...) at either end.
    A text between two visible ASCII characters stays as it is."""
    s = _c(c).cast("string")
    last = F.substring(s, -1, 1)
    tight = (s >= "!") & (s < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(tight, s).otherwise(F.regexp_replace(s, r"(?U)^\s+|\s+$", ""))


def blank_to_null(c) -> Column:
    s = strip(c)
    return F.when(s != "", s)


def clip(c, n: int) -> Column:
    """Trim, keep at most ``n`` characters, empty -> null (C17)."""
    s = F.substring(strip(c), 1, n)
    return F.when(s != "", s)


def ticker_from(*cols) -> Column:
    """C4: first non-empty of the candidate ticker columns, trimmed, upper."""
    return F.upper(F.coalesce(*[blank_to_null(c) for c in cols]))


def sanitize_asset_columns(df: DataFrame) -> DataFrame:
    """C17 asset sanitising; rows without a ticker are dropped."""
    def opt(name):
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    out = df.select(
        F.upper(clip(opt("ticker"), TICKER_MAX)).alias("ticker"),
        clip(opt("asset_name"), ASSET_NAME_MAX).alias("asset_name"),
        F.upper(clip(opt("isin"), ISIN_MAX)).alias("isin"),
        clip(opt("segment"), SEGMENT_MAX).alias("segment"),
        clip(opt("instrument_type"), INSTRUMENT_TYPE_MAX).alias("instrument_type"),
        *[F.col(c) for c in df.columns if c not in ("ticker", "asset_name", "isin", "segment", "instrument_type")],
    )
    return out.where(F.col("ticker").isNotNull())


def fixed_code(c, n: int, blank: str | None = None) -> Column:
    """C24 padded code: trimmed, cut to ``n`` and right-padded with spaces;
    a blank value becomes ``blank`` (default ``n`` spaces)."""
    t = F.trim(_c(c))
    padded = F.rpad(F.substring(t, 1, n), n, " ")
    return F.when(t == "", F.lit(blank if blank is not None else " " * n)).otherwise(padded)


def strip_accents(c) -> Column:
    return F.translate(_c(c), ACCENTED, PLAIN)


def lookup_key(c) -> Column:
    """C26 register lookup key: lower, trim, accents stripped, punctuation kept."""
    return F.lower(strip(strip_accents(_c(c))))


def header_key(c) -> Column:
    """C1 as a data expression: accents stripped, punctuation removed, words
    joined by one space, lower case."""
    words = F.split(F.lower(strip_accents(_c(c))), r"[\s\u00A0\u0085]+")
    kept = F.transform(words, lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}_]", ""))
    return F.array_join(F.filter(kept, lambda w: w != ""), " ")
