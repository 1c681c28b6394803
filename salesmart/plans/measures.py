"""Dashboard measures over a filtered, grouped sales table.

A filter context is a ``where`` on the table, the axis of a visual is
``by``. Measures that ignore filters take the unfiltered table as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.functions.dates import month_label, month_start
from salesmart.functions.numbers import kpi_colour, safe_ratio, signed_pct_label
from salesmart.operators.ranking import with_rank
from salesmart.plans.analytics import sale_count
from salesmart.session import materialise


def base_measures(sales: DataFrame, by: list[str], customer: str = "cliente_key") -> DataFrame:
    """Totals, ticket, units, net, customers and days with sales per axis value.

    ``customer`` is the surrogate key, so versions of one customer count
    separately; pass the natural id to count persons.
    """
    sums = sales.groupBy(*by).agg(
        F.sum("monto_total").alias("ventas_totales"), sale_count(sales).alias("total_transacciones"),
        F.sum("cantidad").alias("total_unidades"), F.sum("monto_neto").alias("monto_neto_total"),
        F.count_distinct(customer).alias("clientes_unicos"),
        F.count_distinct("fecha_venta").alias("dias_con_ventas"))
    total = F.col("ventas_totales")
    return sums.select(
        *by, total, "total_transacciones", safe_ratio(total, F.col("total_transacciones")).alias("ticket_promedio"),
        "total_unidades", "monto_neto_total", "clientes_unicos", "dias_con_ventas",
        safe_ratio(total, F.col("dias_con_ventas")).alias("ventas_promedio_diario"))


def monthly_sales(sales: DataFrame, by: list[str]) -> DataFrame:
    return sales.groupBy(*by, month_start(F.col("fecha_venta")).alias("mes")).agg(
        F.sum("monto_total").alias("ventas"), F.min("fecha_venta").alias("_first"))


def _shifted(months: DataFrame, by: list[str], n: int, out: str) -> DataFrame:
    """Sales of each month under the month that lies ``n`` later."""
    return months.select(*by, F.add_months("mes", n).alias("mes"), F.col("ventas").alias(out))


def month_over_month(sales: DataFrame, by: list[str]) -> DataFrame:
    """Against the previous calendar month; a missing month counts as no sales."""
    months = monthly_sales(sales, by)
    joined = months.join(_shifted(months, by, 1, "ventas_mes_anterior"), [*by, "mes"], "left")
    old = F.col("ventas_mes_anterior")
    growth = F.col("ventas") - F.coalesce(old, F.lit(0))
    ratio = safe_ratio(growth, old)
    return joined.select(*by, "mes", month_label(F.col("_first")).alias("etiqueta_mes"), "ventas",
                         "ventas_mes_anterior", growth.alias("crecimiento_mom"),
                         ratio.alias("crecimiento_mom_pct"), signed_pct_label(ratio).alias("variacion_mom_texto"))


def year_over_year(sales: DataFrame, by: list[str]) -> DataFrame:
    months = monthly_sales(sales, by)
    joined = months.join(_shifted(months, by, 12, "ventas_anio_anterior"), [*by, "mes"], "left")
    old = F.col("ventas_anio_anterior")
    growth = F.col("ventas") - F.coalesce(old, F.lit(0))
    return joined.select(*by, "mes", "ventas", "ventas_anio_anterior",
                         safe_ratio(growth, old).alias("crecimiento_yoy_pct"))


def year_to_date(sales: DataFrame, by: list[str]) -> DataFrame:
    """Running sales of the year per month, and the same month a year before.

    Every year that has sales gets its twelve months, so the running sum of
    the year before is there even when that very month had no sales. The
    months, one row each per axis value, are written once and read three times.
    """
    months = materialise(monthly_sales(sales, by).select(*by, "mes", "ventas"))
    year = F.trunc("mes", "year")
    spine = (months.select(*by, year.alias("_year")).distinct()
             .withColumn("mes", F.explode(F.sequence(
                 F.col("_year"), F.add_months("_year", 11), F.expr("interval 1 month")))))
    running = Window.partitionBy(*by, "_year").orderBy("mes").rowsBetween(Window.unboundedPreceding, 0)
    filled = (spine.join(months, [*by, "mes"], "left")
              .withColumn("ventas_ytd", F.sum("ventas").over(running)))
    before = filled.select(*by, F.add_months("mes", 12).alias("mes"),
                           F.col("ventas_ytd").alias("ventas_ytd_anio_anterior"))
    return (filled.where("ventas is not null").join(before, [*by, "mes"], "left")
            .select(*by, "mes", "ventas", "ventas_ytd", "ventas_ytd_anio_anterior"))


def shares(sales: DataFrame, visible: DataFrame, by: list[str]) -> DataFrame:
    """Share of all sales and of the sales visible under the outer filters."""
    everything = sales.agg(F.sum("monto_total")).scalar()
    shown = visible.groupBy(*by).agg(F.sum("monto_total").alias("ventas_totales"))
    selected = shown.agg(F.sum("ventas_totales")).scalar()
    total = F.col("ventas_totales")
    return shown.select(*by, total, safe_ratio(total, everything).alias("participacion"),
                        safe_ratio(total, selected).alias("participacion_filtrada"))


def dense_ranks(totals: DataFrame, value: str, out: str, bound: DataFrame | None = None) -> DataFrame:
    """Dense rank over all members by descending ``value``."""
    return with_rank(totals, value, out, method="dense", bound=bound)


def kpi_light(sales: DataFrame, calendar: DataFrame, months: str = "calendar") -> DataFrame:
    """Month by month colour against 105 % of the average month.

    The average divides by the months of the calendar, or with
    ``months="active"`` by the months that have sales.
    """
    per_month = monthly_sales(sales, []).drop("_first")
    total = per_month.agg(F.sum("ventas").cast("double")).scalar()
    source = calendar.select(month_start(F.col("fecha")).alias("mes")) if months == "calendar" else per_month
    n = source.agg(F.count_distinct("mes")).scalar()
    actual = F.col("ventas").cast("double")
    return (per_month.withColumn("meta", F.try_divide(total, n) * 1.05)
            .select("mes", "ventas", "meta", kpi_colour(actual, F.col("meta")).alias("color_kpi")))


def daily_average(sales: DataFrame, by: list[str]) -> DataFrame:
    """Average of the daily totals over the days with sales."""
    days = sales.groupBy(*by, "fecha_venta").agg(F.sum("monto_total").alias("_day"))
    return days.groupBy(*by).agg(
        F.sum("_day").alias("_sum"), F.count(F.lit(1)).alias("dias_con_ventas")).select(
            *by, "dias_con_ventas", safe_ratio(F.col("_sum"), F.col("dias_con_ventas")).alias("ventas_por_dia"))


def max_month(sales: DataFrame, by: list[str]) -> DataFrame:
    """Largest monthly total, and the label of the earliest month."""
    months = monthly_sales(sales, by)
    return months.groupBy(*by).agg(F.max("ventas").alias("max_ventas_periodo"),
                                   F.min("_first").alias("_first")).select(
        *by, "max_ventas_periodo", month_label(F.col("_first")).alias("etiqueta_mes"))


def seller_sales(own_rows: DataFrame) -> DataFrame:
    """Sales of the signed-in seller, from rows already filtered to that seller."""
    return own_rows.agg(F.sum("monto_total").alias("mis_ventas"), F.count(F.lit(1)).alias("ventas"))


def distinct_by_month(sales: DataFrame, by: list[str], customer: str = "cliente_key") -> DataFrame:
    """Customers of each month and axis value as exact bitmaps: an aggregate to store, from which any span is merged.

    A row holds the customers of one bucket of 32,768 neighbouring keys in 4 KiB.
    """
    key = F.col(customer).cast("bigint")
    return (sales.where(key.isNotNull())
            .groupBy(*by, month_start(F.col("fecha_venta")).alias("mes"), F.bitmap_bucket_number(key).alias("grupo"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits")))


def distinct_over(months: DataFrame, by: list[str], span: str) -> DataFrame:
    """Customers per axis value and ``span`` (month, quarter, year) from ``distinct_by_month``; the sales aren't read."""
    merged = months.groupBy(*by, F.trunc("mes", span).alias("desde"), "grupo").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by, "desde").agg(F.sum(F.bitmap_count("bits")).alias("clientes_unicos"))


def distinct_sketches(sales: DataFrame, by: list[str], customer: str = "cliente_key", lg: int = 12) -> DataFrame:
    """As ``distinct_by_month`` with one sketch of fixed size per month; relative error about 1.04 / sqrt(2 ** lg)."""
    return sales.groupBy(*by, month_start(F.col("fecha_venta")).alias("mes")).agg(
        F.hll_sketch_agg(customer, F.lit(lg)).alias("sketch"))


def distinct_estimate(months: DataFrame, by: list[str], span: str) -> DataFrame:
    return months.groupBy(*by, F.trunc("mes", span).alias("desde")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("clientes_unicos"))
