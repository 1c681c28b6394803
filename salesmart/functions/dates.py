"""Calendar parts and date keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Month and weekday names of the calendar (Monday first).
MONTH_NAMES = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
               "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")
DAY_NAMES = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")


def _pick(names: tuple[str, ...], position: Column) -> Column:
    # a null position must be guarded: element_at of literals claims to be never null
    names = F.array(*[F.lit(n) for n in names])
    return F.when(position.isNotNull(), F.element_at(names, position.cast("int")))


def date_key(col: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def month_key(key: Column) -> Column:
    """``YYYYMM`` from a date key."""
    return F.floor(key / 100).cast("int")


def iso_weekday(col: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(col) + 1


def next_monday(col: Column) -> Column:
    """The date itself when it is a Monday, else the Monday after it."""
    return F.date_add(col, (7 - F.weekday(col)) % 7)


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar (the anonymous computus)."""
    y = year.cast("int")
    div = lambda a, b: F.floor(a / b).cast("int")
    century, golden = div(y, 100), y % 19
    moon = (19 * golden + century - div(century, 4) - div(century - div(century + 8, 25) + 1, 3) + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * div(y % 100, 4) - moon - (y % 100) % 4) % 7
    late = div(golden + 11 * moon + 22 * weekday, 451)
    days = moon + weekday - 7 * late + 114
    return F.make_date(y, div(days, 31), days % 31 + 1)


def month_name(month: Column) -> Column:
    return _pick(MONTH_NAMES, month)


def day_name(weekday: Column) -> Column:
    return _pick(DAY_NAMES, weekday)


def month_start(col: Column) -> Column:
    return F.trunc(col, "month")


def month_label(col: Column) -> Column:
    return F.date_format(col, "MMM yyyy")
