"""Seed members of the dimensions and the holiday rules (fixed values)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

# Holidays as (month, day, name, moved to the next Monday).
# Feasts that move with Easter: days from Easter Sunday, name.
MOVABLE_FEASTS = (
    (-3, "Jueves Santo"),
    (-2, "Viernes Santo"),
    (43, "Ascensión del Señor"),
    (64, "Corpus Christi"),
    (71, "Sagrado Corazón"),
)
HOLIDAYS = (
    (1, 1, "Año Nuevo", False),
    (1, 6, "Reyes Magos", True),
    (3, 19, "San José", True),
    (5, 1, "Día del Trabajo", False),
    (6, 29, "San Pedro y San Pablo", True),
    (7, 20, "Independencia de Colombia", False),
    (8, 7, "Batalla de Boyacá", False),
    (8, 15, "Asunción de la Virgen", True),
    (10, 12, "Día de la Raza", True),
    (11, 1, "Todos los Santos", True),
    (11, 11, "Independencia de Cartagena", True),
    (12, 8, "Inmaculada Concepción", False),
    (12, 25, "Navidad", False),
)

# Channel, kind, description, commission %.
CHANNEL_ROWS = (
    ("Online", "Digital", "Ventas directas por plataforma web o app propia", "0.00"),
    ("Tienda", "Físico", "Ventas en punto de venta físico", "0.00"),
    ("Marketplace", "Digital", "Ventas a través de plataformas terceras (MercadoLibre etc)", "5.00"),
)

# City, department, region, population, latitude, longitude.
CITY_ROWS = (
    ("Bogotá", "Cundinamarca", "Andina", 8380000, "4.710989", "-74.072092"),
    ("Medellín", "Antioquia", "Andina", 2700000, "6.244203", "-75.581211"),
    ("Cali", "Valle", "Pacífica", 2300000, "3.451647", "-76.531985"),
    ("Barranquilla", "Atlántico", "Caribe", 1300000, "10.963889", "-74.796387"),
    ("Cartagena", "Bolívar", "Caribe", 1000000, "10.391049", "-75.479426"),
    ("Bucaramanga", "Santander", "Andina", 600000, "7.119349", "-73.122742"),
    ("Pereira", "Risaralda", "Andina", 490000, "4.813333", "-75.696111"),
    ("Manizales", "Caldas", "Andina", 430000, "5.070000", "-75.513056"),
)

# Product id, name, category, subcategory, reference price, unit.
PRODUCT_ROWS = (
    (501, "Audífonos Bluetooth Pro", "Electrónica", "Audio", "35000", "Unidad"),
    (502, "Silla Ergonómica Plus", "Hogar", "Muebles", "45000", "Unidad"),
    (503, "Camiseta Deportiva Dry-Fit", "Ropa", "Deportiva", "15000", "Unidad"),
    (504, "Licuadora 600W", "Hogar", "Electrodomésticos", "22000", "Unidad"),
    (505, "Mochila Impermeable 30L", "Accesorios", "Bolsos", "25000", "Unidad"),
    (506, 'Monitor LED 24"', "Electrónica", "Monitores", "55000", "Unidad"),
    (507, "Teclado Mecánico RGB", "Electrónica", "Periféricos", "80000", "Unidad"),
    (508, "Lámpara LED Escritorio", "Hogar", "Iluminación", "30000", "Unidad"),
    (509, "Maletín Ejecutivo", "Accesorios", "Bolsos", "20000", "Unidad"),
    (510, "Zapatillas Running", "Ropa", "Calzado", "12000", "Par"),
    (511, "Smartwatch Fitness", "Electrónica", "Wearables", "95000", "Unidad"),
    (512, "Cafetera Espresso Manual", "Hogar", "Electrodomésticos", None, "Unidad"),
)

# Seller, home city, region, zone, state.
SELLER_ROWS = (
    ("SIN_ASIGNAR", None, None, None, "Activo"),
    ("Juan Pérez", "Bogotá", "Andina", "Centro", "Activo"),
    ("Ana Torres", "Bogotá", "Andina", "Centro", "Activo"),
    ("Laura Díaz", "Cali", "Pacífica", "Sur", "Activo"),
    ("Camilo Rojas", "Medellín", "Andina", "Norte", "Activo"),
    ("Roberto Vega", "Barranquilla", "Caribe", "Costa", "Activo"),
)


def _decimal(text: str | None) -> Decimal | None:
    return None if text is None else Decimal(text)


def _members(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """The rows as one literal array: Spark knows that it is small, while a list that passes through an RDD has no size.

    A join with a table of unknown size is shuffled by its key, here a handful of names, and as many tasks.
    """
    members = [F.struct(*[F.lit(value) for value in row]).cast(f"struct<{schema}>") for row in rows]
    return spark.range(1).select(F.inline(F.array(*members)))


def seed_dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    """The starting members of each dimension, keyed 1..n in listed order."""
    channels = [(i, *row[:3], _decimal(row[3])) for i, row in enumerate(CHANNEL_ROWS, 1)]
    cities = [(i, *row[:4], _decimal(row[4]), _decimal(row[5]))
              for i, row in enumerate(CITY_ROWS, 1)]
    products = [(i, *row[:4], _decimal(row[4]), row[5], True)
                for i, row in enumerate(PRODUCT_ROWS, 1)]
    sellers = [(i, *row[:4], None, row[4], None) for i, row in enumerate(SELLER_ROWS, 1)]
    from salesmart.schemas import CHANNEL, CITY, PRODUCT, SELLER
    return {
        "dim_canal": _members(spark, channels, CHANNEL),
        "dim_ciudad": _members(spark, cities, CITY),
        "dim_producto": _members(spark, products, PRODUCT),
        "dim_vendedor": _members(spark, sellers, SELLER),
    }
