"""Calendar dimension with holidays."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmart.functions.dates import (date_key, day_name, easter, iso_weekday, month_name,
                                       next_monday)
from salesmart.sources.seeds import HOLIDAYS, MOVABLE_FEASTS

# Default range of the calendar.
FIRST_DAY, LAST_DAY = date(2020, 1, 1), date(2030, 12, 31)


def day_series(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("fecha"))


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """The day series between two date columns of a one-row table."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("fecha"))


def holiday_name(day: Column, movable: bool = False) -> Column:
    """Name of the holiday on a date, null on other days.

    A moved holiday falls on the Monday of the week after its nominal date,
    so each rule is a comparison with a date of the same year. ``movable``
    adds the feasts that follow Easter; they win where both fall on a day.
    """
    out = F.lit(None).cast("string")
    # later rules win, as the last update of a day does
    for month, dom, name, moved in HOLIDAYS:
        nominal = F.make_date(F.year(day), F.lit(month), F.lit(dom))
        observed = next_monday(nominal) if moved else nominal
        out = F.when(day == observed, F.lit(name)).otherwise(out)
    for days, name in MOVABLE_FEASTS if movable else ():
        out = F.when(F.datediff(day, easter(F.year(day))) == days, F.lit(name)).otherwise(out)
    return out


def calendar_of(days: DataFrame, movable: bool = False) -> DataFrame:
    """All calendar attributes for a table of dates."""
    d = F.col("fecha")
    weekday = iso_weekday(d)
    return days.select(
        date_key(d).alias("fecha_key"), d,
        F.year(d).alias("anio"), F.month(d).alias("mes"), F.dayofmonth(d).alias("dia"),
        month_name(F.month(d)).alias("nombre_mes"), F.quarter(d).alias("trimestre"),
        F.weekofyear(d).alias("semana_anio"), weekday.alias("dia_semana"),
        day_name(weekday).alias("nombre_dia_semana"), (weekday >= 6).alias("es_fin_semana"),
        holiday_name(d, movable).isNotNull().alias("es_festivo"),
        holiday_name(d, movable).alias("nombre_festivo"),
        F.date_format(d, "yyyy-MM").alias("anio_mes"))


def build_calendar(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY, movable: bool = False) -> DataFrame:
    return calendar_of(day_series(spark, first, last), movable)


def holidays_of(calendar: DataFrame) -> DataFrame:
    return calendar.where("es_festivo").select("fecha", "anio", "nombre_festivo", "dia_semana")
