"""Column expressions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlewick.functions import dates, headers, numbers, text
from candlewick.sources import fixed_width as FW

def _locale_cases():
    """Amounts written out by the rule: dot groups of three, comma or dot decimals, sign, percent, blanks."""
    for whole in (7, 250, 3_481, 96_204, 5_000_000):
        grouped = f"{whole:,}".replace(",", ".")
        for sign, factor in (("", 1), ("-", -1)):
            yield f"{sign}{whole}", factor * whole
            yield f"{sign}{grouped},75", factor * (whole + 0.75)
            yield f"  {sign}{whole},5% ", factor * (whole + 0.5)
            yield f"{sign}{whole}.25", factor * (whole + 0.25)
            if whole >= 1000:
                yield f"{sign}{grouped}", factor * whole
    yield from ((blank, None) for blank in ("", "\t ", "-", None, "n/d", "4..4"))


def _eval(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_locale_number(spark):
    cases = list(_locale_cases())
    got = _eval(spark, [raw for raw, _ in cases], numbers.locale_number)
    for (raw, exp), g in zip(cases, got):
        if exp is None:
            assert g is None, raw
        else:
            assert g == pytest.approx(exp), raw


def test_load_number_replaces_first_comma_only(spark):
    got = _eval(spark, ["1.234,56", "1.500", "12,5", " 7 ", "1d", "x"], numbers.load_number)
    assert got == [None, 1.5, 12.5, 7.0, None, None]


def test_half_up_is_away_from_zero(spark):
    got = _eval(spark, [0.125, -0.125, 2.5, None], lambda c: numbers.half_up(c, 2), "double")
    assert got[:2] == [0.13, -0.13]
    assert got[3] is None


def test_fixed_width_numbers(spark):
    got = _eval(spark, ["0000000001050", "  ", "12a"], lambda c: numbers.digits_scaled(c, 13, 100, "decimal(18,6)"))
    assert got == [Decimal("10.500000"), None, None]
    got = _eval(spark, ["000000000000010000"], lambda c: numbers.digits_scaled(c, 18, 1, "decimal(24,4)"))
    assert got == [Decimal("10000.0000")]


def test_yyyymmdd_and_expiration(spark):
    got = _eval(spark, ["20240614", "00000000", "2024061", "20241341"], dates.yyyymmdd)
    assert got == [dt.date(2024, 6, 14), None, None, None]


def test_row_date_formats(spark):
    got = _eval(spark, ["2024-06-14", "14/06/2024", "14/06/24", "20240614", "junk"], dates.row_date)
    assert got[:2] == [dt.date(2024, 6, 14)] * 2
    assert got[3] == dt.date(2024, 6, 14)
    assert got[4] is None


def test_quoted_at_builds_wall_clock(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 14), "10:05"), (dt.date(2024, 6, 14), "25:00"),
                                (dt.date(2024, 6, 14), None), (dt.date(2024, 6, 14), "10:05:07")], "d date, t string")
    got = [r[0] for r in df.select(dates.quoted_at("d", "t")).collect()]
    assert got == [dt.datetime(2024, 6, 14, 10, 5), dt.datetime(2024, 6, 14), dt.datetime(2024, 6, 14),
                   dt.datetime(2024, 6, 14, 10, 5, 7)]


def test_file_name_date(spark):
    got = _eval(spark, ["negocios_2024-06-14.csv", "x_20240230.csv", "none.csv"], dates.file_name_date)
    assert got == [dt.date(2024, 6, 14), None, None]


def test_header_mapping_is_accent_and_case_insensitive():
    cols = ["Instrumento financeiro", "Preço de fechamento", "Quantidade de negócios", "TckrSymb"]
    m = headers.map_columns(cols, headers.TRADE_COLUMN_MAP)
    assert m["ticker"] == "Instrumento financeiro"      # left-most wins
    assert m["last_price"] == "Preço de fechamento"
    assert m["trade_count"] == "Quantidade de negócios"
    assert headers.normalize_name("  Preço   Médio. ") == "preco medio"


def test_header_guard():
    with pytest.raises(ValueError):
        headers.validate_instrument_header(["a", "b"], "f.csv")
    with pytest.raises(ValueError):
        headers.validate_instrument_header(["a", "b", "c", "d"], "f.csv")
    headers.validate_instrument_header(["TckrSymb", "NmOfc", "ISIN", "Sgmt"], "f.csv")


def test_accent_tables_align():
    assert len(text.ACCENTED) == len(text.PLAIN)


def test_asset_sanitize(spark):
    df = spark.createDataFrame([(" petr4 ", "  Petrobras  ", "br123", "", None), ("", "x", None, None, None),
                                ("a" * 30, "n", None, None, None)],
                               "ticker string, asset_name string, isin string, segment string, instrument_type string")
    rows = text.sanitize_asset_columns(df).orderBy("ticker").collect()
    assert [r.ticker for r in rows] == ["A" * 20, "PETR4"]
    assert rows[1].asset_name == "Petrobras" and rows[1].isin == "BR123" and rows[1].segment is None


def test_fixed_width_record_roundtrip(spark):
    line = ("01" + "20240614" + "02" + "PETR4".ljust(12) + "010" + "PETROBRAS".ljust(12) + "PN".ljust(10) + "   "
            + "R$  " + "0000000001050" * 7 + "00010" + "000000000000010000" + "000000000000105000" + "0" * 13
            + " " + "00000000" + "0000001" + "0" * 13 + "BRPETRACNPR6" + "100")
    assert len(line) == FW.RECORD_LEN
    lines = spark.createDataFrame([("f.txt", 1, line), ("f.txt", 2, line), ("f.txt", 3, "short")],
                                  "file_name string, line_no long, line string")
    rows = FW.parse_lines(lines).collect()
    assert len(rows) == 2
    r = rows[0]
    assert r.open_price == Decimal("10.500000") and r.quantity_total == Decimal("10000.0000")
    assert r.volume_financial == Decimal("1050.0000")
    assert r.expiration_date is None and r.expiration_key == "00000000" and r.ind_opc == " "
    stats = FW.parse_stats(lines).collect()[0]
    assert (stats.normalized_valid, stats.in_file_duplicate_keys, stats.skipped_wrong_length) == (2, 1, 1)
    assert FW.dedupe_last(FW.parse_lines(lines)).collect()[0].line_no == 2
