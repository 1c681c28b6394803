"""Fact load: star lookup, split of unresolved rows, idempotent insert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.functions.dates import date_key
from salesmart.functions.numbers import net_amount
from salesmart.operators.cleaning import split_loaded
from salesmart.operators.scd2 import as_of, current_version
from salesmart.session import broadcast_if_small

# lookups in the order their absence is reported: key, natural column, dimension column
LOOKUPS = (
    ("fecha_key", "fecha", "fecha"),
    ("cliente_key", "id_cliente", "id_cliente"),
    ("producto_key", "id_producto", "id_producto"),
    ("vendedor_key", "vendedor", "nombre_vendedor"),
    ("canal_key", "canal", "nombre_canal"),
    ("ciudad_key", "ciudad", "nombre_ciudad"),
)

# what ``fact_rows`` reads of a resolved row
FACT_INPUT = ("id_venta", "fecha", "cliente_key", "producto_key", "vendedor_key", "canal_key", "ciudad_key",
              "cantidad", "precio_unitario", "monto_total")


def _lookup(dims: dict[str, DataFrame], key: str, natural: str, column: str) -> DataFrame:
    dim = dims["dim_" + key.removesuffix("_key")]
    if key == "cliente_key":
        dim = current_version(dim)
    return broadcast_if_small(dim.select(F.col(column).alias(natural), key), dim)


def resolve_keys(clean: DataFrame, dims: dict[str, DataFrame], by_date: bool = False) -> DataFrame:
    """All clean rows with six keys and ``motivo``, the first missing lookup.

    The customer key is that of the current version, or with ``by_date``
    that of the version valid on the day of the sale.
    """
    rows = clean
    for key, natural, column in LOOKUPS:
        if key == "cliente_key" and by_date:
            rows = as_of(rows, dims["dim_cliente"])
        else:
            rows = rows.join(_lookup(dims, key, natural, column), natural, "left")
    missing = [F.when(F.col(key).isNull(), F.concat(
        F.lit(f"{key} no encontrado para "), F.coalesce(F.col(natural).cast("string"), F.lit("null"))))
        for key, natural, _ in LOOKUPS]
    return rows.withColumn("motivo", F.coalesce(*missing))


def resolved(rows: DataFrame) -> DataFrame:
    return rows.where("motivo is null").drop("motivo")


def unresolved(rows: DataFrame) -> DataFrame:
    return rows.where("motivo is not null").select("id_venta", "motivo")


def star_rows(clean: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The set-based lookup with inner joins: rows without a member drop out."""
    rows = clean
    for key, natural, column in LOOKUPS:
        rows = rows.join(_lookup(dims, key, natural, column), natural)
    return rows


def fact_rows(keyed: DataFrame, batch_id: str, stamp: Column, start: Column | None = None) -> DataFrame:
    """Fact columns of resolved rows; discount and taxes default to zero.

    A ``venta_key`` that the rows have is kept. Otherwise it only has to be
    unique: the row's place in its task above ``start``, no shuffle, gaps allowed.
    """
    zero = F.lit(0).cast("decimal(10,2)")
    base = F.coalesce(start, F.lit(0)).cast("bigint") if start is not None else F.lit(0).cast("bigint")
    return keyed.select(
        F.col("venta_key") if "venta_key" in keyed.columns
        else (base + 1 + F.monotonically_increasing_id()).alias("venta_key"), "id_venta",
        date_key(F.col("fecha")).alias("fecha_key"), "cliente_key", "producto_key", "vendedor_key",
        "canal_key", "ciudad_key", "cantidad", "precio_unitario", "monto_total",
        zero.alias("descuento"), zero.alias("impuestos"),
        net_amount(F.col("monto_total"), zero, zero).alias("monto_neto"),
        F.col("fecha").alias("fecha_venta"), stamp.alias("fecha_carga"),
        F.lit(batch_id).alias("id_batch"))


def insert_new(existing: DataFrame, new: DataFrame, key: str = "id_venta") -> tuple[DataFrame, DataFrame]:
    """(rows to append, rows skipped because their key is stored)."""
    return split_loaded(new, existing, key)
