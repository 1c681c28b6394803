"""Safe ratios, amounts and text labels for numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_ratio(a: Column, b: Column, default: float | None = 0.0) -> Column:
    """``a / b`` as double, ``default`` when ``b`` is zero or either is null."""
    ratio = F.try_divide(a.cast("double"), b.cast("double"))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def pct_change(new: Column, old: Column, digits: int = 1) -> Column:
    """Rounded percentage from ``old`` to ``new``; null without a base."""
    return F.round(F.try_divide((new - old).cast("double"), old.cast("double")) * 100, digits)


def line_amount(quantity: Column, price: Column) -> Column:
    """Quantity times price as decimal(15,2); null when it does not fit."""
    return (quantity.cast("decimal(10,0)") * price).try_cast("decimal(15,2)")


def net_amount(amount: Column, discount: Column, taxes: Column) -> Column:
    return (amount - discount + taxes).cast("decimal(15,2)")


def growth_label(new: Column, old: Column) -> Column:
    """Six-way trend class of a yearly change."""
    return (F.when(old.isNull(), "Primer año")
            .when(new > old * F.lit("1.10").cast("decimal(3,2)"), "Crecimiento fuerte (>10%)")
            .when(new > old, "Crecimiento moderado")
            .when(new == old, "Estable")
            .when(new > old * F.lit("0.90").cast("decimal(3,2)"), "Caída moderada")
            .otherwise("Caída fuerte (>10%)"))


def tercile_label(tile: Column) -> Column:
    return F.when(tile == 1, "Alto").when(tile == 2, "Medio").otherwise("Bajo")


def kpi_colour(actual: Column, target: Column) -> Column:
    return (F.when(actual >= target, "Verde")
            .when(actual >= target * 0.90, "Amarillo")
            .otherwise("Rojo"))


def signed_pct_label(ratio: Column) -> Column:
    """``▲ 12.3%`` or ``▼ 4.5%``."""
    text = F.format_string("%.1f%%", F.round(F.abs(ratio) * 100, 1))
    return F.concat(F.when(ratio >= 0, "▲ ").otherwise("▼ "), text)
