"""Edge values of the column expressions."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.functions import dates, masking as M, normalize as N, numbers
from salesmart.operators.calendar import build_calendar


def values(spark, texts, *exprs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", *[e(F.col("t")).alias(f"c{k}") for k, e in enumerate(exprs)]).orderBy("i").collect()
    return [r[1] for r in rows] if len(exprs) == 1 else [tuple(r)[1:] for r in rows]


def test_dates(spark):
    texts = ["2024-01-05", " 2024/1/6 ", "07-01-2024", "8/1/2024", "2024-13-07", "2024-02-30", "24-01-06",
             "", None, "2024-01/05", "2024-01-05x", "2024"]
    assert values(spark, texts, N.normalize_date) == [
        date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7), date(2024, 1, 8)] + [None] * 8


def test_numbers(spark):
    texts = ["2", " 2.0 ", "1.5", "1e3", "abc", "", None, "NaN", "-2", "0", "99999999999999999999"]
    assert values(spark, texts, N.to_integer) == [2, 2, None, 1000, None, None, None, None, -2, 0, None]
    prices = ["19.999", "NaN", "Infinity", "-1", "", "12345678901.00"]
    assert values(spark, prices, N.to_decimal) == [Decimal("20.00"), None, None, Decimal("-1.00"), None, None]


def test_channels_and_sellers(spark):
    texts = ["ONLINE", " tienda ", "Marketplace", "Teléfono ", "", "  ", None]
    assert values(spark, texts, N.normalize_channel) == ["Online", "Tienda", "Marketplace", "Teléfono", None, None, None]
    assert values(spark, texts, N.is_miscased_channel) == [True, True, False, False, False, False, False]
    assert values(spark, ["Ana", " ", None], N.seller_or_default) == ["Ana", "SIN_ASIGNAR", "SIN_ASIGNAR"]
    assert values(spark, ["NA", "null", "", "x"], N.missing_to_null) == [None, None, None, "x"]


def test_usual_spellings_need_no_pattern(spark, monkeypatch):
    """Patterns are for the rest: whole numbers and known channels are told by their bytes, with the patterns' results."""
    odd = ["5\x7f", "\x7f5", "5\t", "2.", "+4", "0E-10", "1e-10", "--3", "\u0663", "9223372036854775808", "1L", "-0"]
    assert values(spark, odd, N.to_integer) == [None, None, 5, 2, 4, 0, None, None, 3, None, None, 0]
    assert values(spark, ["mar\u212aetplace", "online\n"], N.normalize_channel) == ["mar\u212aetplace", "Online\n"]
    monkeypatch.setattr(N.F, "regexp_extract", lambda *_: F.lit(None))
    monkeypatch.setattr(N.F, "regexp_replace", lambda *_: F.lit("pattern"))
    assert values(spark, ["2", " -30 ", "9223372036854775807"], N.to_integer) == [2, -30, 9223372036854775807]
    assert values(spark, ["ONLINE", " tienda ", "Marketplace", " "], N.normalize_channel) == ["Online", "Tienda", "Marketplace", None]


def test_usual_dates_need_no_pattern(spark, monkeypatch):
    """Ten bytes with separators in their places are dates by their bytes, with the patterns' results."""
    odd = ["5\t-01-2024", "\t5-01-2024", "2024-01-5\n", "2024-01-5\t", "2024-01-1T", "+024-01-05", "05-01/2024", "20240-01-5",
           "\u0661-01-2024", "2024-01-05\n", "2024--1-05"]
    assert values(spark, odd, N.normalize_date) == [None, None, date(2024, 1, 5)] + [None] * 6 + [date(2024, 1, 5), None]
    monkeypatch.setattr(N.F, "regexp_extract", lambda *_: F.lit("1999-01-01"))
    usual = ["2024-01-05", " 2024/01/06 ", "07-01-2024", "08/01/2024", "2024-13-07", "2024-02-30", "29/02/2023"]
    assert values(spark, usual, N.normalize_date) == [
        date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7), date(2024, 1, 8), None, None, None]


def test_email_and_phone(spark):
    texts = ["a.b-c@d.co", "josé@x.co", "a@b", "@x.com", "", None, "a@b.c"]
    assert values(spark, texts, N.is_valid_email) == [True, True, False, False, False, False, False]
    assert values(spark, ["3001234567", "300123456", None], N.is_valid_phone) == [True, False, False]


def test_masks(spark):
    assert values(spark, ["juan@g.com", "nada", "", None], M.mask_email) == ["***@g.com", "***@", None, None]
    assert values(spark, ["3001234567", "123", "1234", "12345", None], M.mask_phone) == [
        "******4567", "**********", "1234", "*2345", "**********"]
    assert values(spark, ["Juan Pérez", " ana", "", None, "SIN_ASIGNAR"], M.mask_name) == [
        "J. Anónimo", "a. Anónimo", "", None, "SIN_ASIGNAR"]
    assert values(spark, ["3001234567", None], M.report_phone) == ["******4567", "******"]
    assert values(spark, ["7", "x", None], M.fake_email) == ["cliente_7@anonimo.test", None, None]
    import hashlib
    assert values(spark, ["v", None], lambda c: M.pseudonym(c, "s")) == [hashlib.sha256(b"vs").hexdigest(), None]
    with pytest.raises(ValueError):
        M.pseudonym(F.lit("v"), "")


def test_labels_and_ratios(spark):
    df = spark.createDataFrame([(0.123, 1.0, 0.0), (-0.0456, 2.0, 4.0)], "p double, a double, b double")
    rows = df.select(numbers.signed_pct_label(F.col("p")), numbers.safe_ratio(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in rows] == [("▲ 12.3%", 0.0), ("▼ 4.6%", 0.5)]
    case = lambda new: numbers.growth_label(F.lit(Decimal(new)), F.lit(Decimal("100.00")))
    row = spark.range(1).select(*[case(v) for v in ("111.00", "110.00", "100.00", "95.00", "90.00")]).first()
    assert list(row) == ["Crecimiento fuerte (>10%)", "Crecimiento moderado", "Estable", "Caída moderada", "Caída fuerte (>10%)"]


def test_calendar(spark):
    calendar = build_calendar(spark).cache()
    assert calendar.count() == 4018
    assert calendar.where("es_festivo").count() == 143
    assert {r["count"] for r in calendar.where("es_festivo").groupBy("anio").count().collect()} == {13}
    day = calendar.where("fecha = date'2024-01-08'").first()
    assert (day.nombre_festivo, day.nombre_mes, day.nombre_dia_semana, day.dia_semana) == ("Reyes Magos", "Enero", "Lunes", 1)
    assert calendar.where("dia_semana = 7 and not es_fin_semana").isEmpty()
    row = spark.range(1).select(dates.next_monday(F.lit(date(2024, 1, 6))), dates.next_monday(F.lit(date(2024, 1, 8))),
                                dates.month_name(F.lit(None).cast("int"))).first()
    assert list(row) == [date(2024, 1, 8), date(2024, 1, 8), None]
    calendar.unpersist()
