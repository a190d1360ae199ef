"""Numeric column expressions.

All expressions are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen.  ANSI mode is on in Spark 4, so every text-to-number step
goes through ``try_cast`` behind a strict numeric regex (Spark's own cast would
also accept forms such as ``1d`` or ``1.0f``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal literal: optional sign, digits with optional fraction, optional exponent.
NUMERIC_LITERAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(c, digits: int) -> Column:
    """Round half away from zero to ``digits`` decimals, as a double.

    Written as ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d`` so that the result is
    a pure function of the input bits; the same arithmetic in any SQL engine
    gives the same double.
    """
    x = _c(c).cast("double")
    scale = float(10 ** digits)
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / F.lit(scale)


def _trimmed(c) -> Column:
    return F.trim(_c(c).cast("string"))


def _literal(s: Column) -> Column:
    return F.when(s.rlike(NUMERIC_LITERAL), s.try_cast("double"))


def _dotted(s: Column) -> Column:
    return F.replace(s, F.lit(","), F.lit("."))  # with a second comma it is no literal either way


#: What ``load_number`` does to a trimmed text, as steps that refer to their input alone.
LOAD_NUMBER_STEPS = (_dotted, _literal)


def strict_double(c) -> Column:
    """``try_cast(c as double)`` restricted to plain decimal literals."""
    return _literal(_trimmed(c))


def load_number(c) -> Column:
    """C7 load-path cast: strip, replace the *first* comma by a dot, lenient cast.

    ``"1.234,56"`` -> null and ``"1.500"`` -> 1.5, as on the reference load path.
    """
    s = _trimmed(c)
    for step in LOAD_NUMBER_STEPS:
        s = step(s)
    return s


def locale_number(c) -> Column:
    """C8 pt-BR aware number parse used by file validation.

    null / "" / "-" -> null; one trailing ``%`` dropped; with a comma the dots
    are thousands separators; dots only: more than one dot, or exactly three
    digits after a single dot, means thousands grouping; otherwise a plain
    decimal.  Garbage gives null.
    """
    t = F.trim(_c(c).cast("string"))
    t2 = F.trim(F.regexp_replace(t, "%$", ""))
    sign = F.regexp_extract(t2, r"^([+-]?)", 1)
    body_no_dots = F.regexp_replace(F.regexp_replace(t2, r"^[+-]", ""), r"\.", "")
    grouped = F.concat(sign, body_no_dots)
    return (
        F.when(t.isNull() | t.isin("", "-"), F.lit(None).cast("double"))
        .when(t2.contains(","), strict_double(F.replace(F.replace(t2, F.lit("."), F.lit("")), F.lit(","), F.lit("."))))
        .when(t2.rlike(r"^[+-]?[0-9]+(\.[0-9]+){2,}$"), strict_double(grouped))
        .when(t2.rlike(r"^[+-]?[0-9]+\.[0-9]{3}$"), strict_double(grouped))
        .otherwise(strict_double(t2))
    )


def payload_decimal(c, precision: int = 18, scale: int = 6) -> Column:
    """C16 decimal parse for payload values: inner spaces removed, comma -> dot,
    ``""``, ``-`` and ``N/A`` are null, unparsable text is null."""
    s = F.regexp_replace(F.trim(_c(c).cast("string")), r"\s+", "")
    cleaned = F.replace(s, F.lit(","), F.lit("."))
    return F.when(cleaned.rlike(NUMERIC_LITERAL), cleaned.try_cast(f"decimal({precision},{scale})"))   # no literal: those three, null, garbage


def digits_scaled(c, digits_precision: int, divisor: int, out_type: str) -> Column:
    """C23 fixed-width numeric field: trimmed all-digit text / ``divisor``.

    Anything that is not all digits (including blank) is null.  The division is
    exact decimal arithmetic, then cast to ``out_type``.
    """
    t = F.trim(_c(c))
    as_dec = t.try_cast(f"decimal({max(digits_precision, 1)},0)")
    if divisor == 1:
        value = as_dec
    else:
        # Multiply by an exact 10^-k: stays on the 64-bit decimal fast path,
        # where a decimal division widens to a 38-digit BigDecimal result.
        k = len(str(divisor)) - 1
        if divisor != 10 ** k:
            raise ValueError("divisor must be a power of ten")
        value = as_dec * F.lit(f"0.{'0' * (k - 1)}1").cast(f"decimal({k},{k})")
    return F.when(t.rlike(r"^[0-9]+$"), value.cast(out_type))


def digits_int(c, out_type: str = "bigint") -> Column:
    """C23 integer field: trimmed digits -> integer, else null."""
    t = F.trim(_c(c))
    return F.when(t.rlike(r"^[0-9]+$"), t.try_cast(out_type))
