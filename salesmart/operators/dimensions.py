"""Dimension loads: insert-if-absent members and overwrite-on-change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.functions.normalize import channel_kind, product_label
from salesmart.operators.ranking import assign_keys


def absent(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet."""
    return new.join(existing.select(key), key, "left_anti")


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``existing`` plus the rows of ``new`` with an unknown key; run twice, same result."""
    return existing.unionByName(absent(new, existing, key), allowMissingColumns=True)


def new_members(existing: DataFrame, names: DataFrame, name: str, key: str,
                attributes: dict[str, Column], bound: DataFrame | None = None,
                start: int | None = None) -> DataFrame:
    """Members seen in ``names`` but not in ``existing``, with keys above ``start`` (default: the highest in use)."""
    fresh = absent(names.select(name).where(F.col(name).isNotNull()).distinct(), existing, name)
    start = existing.agg(F.max(key)).scalar() if start is None else start
    keyed = assign_keys(fresh, [name], key, start, bound=bound)
    return keyed.select(key, name, *[c.alias(a) for a, c in attributes.items()])


MEMBER_COLUMNS = ("canal", "ciudad", "vendedor", "id_producto")


def member_names(clean: DataFrame) -> DataFrame:
    """Distinct (kind, name) of all four member columns, from one pass over the sales."""
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("name")) for c in MEMBER_COLUMNS])
    return clean.select(F.explode(pairs).alias("p")).select("p.kind", "p.name").where("name is not null").distinct()


def names_of(names: DataFrame, column: str) -> DataFrame:
    """One kind of ``member_names`` under the name and type it has in the sales."""
    kind = "bigint" if column == "id_producto" else "string"
    return names.where(F.col("kind") == column).select(F.col("name").cast(kind).alias(column))


def new_channels(existing: DataFrame, clean: DataFrame, start: int | None = None) -> DataFrame:
    names = clean.select(F.col("canal").alias("nombre_canal"))
    return new_members(existing, names, "nombre_canal", "canal_key",
                       {"tipo_canal": channel_kind(F.col("nombre_canal")),
                        "comision_pct": F.lit(0).cast("decimal(5,2)")}, bound=clean, start=start)


def new_cities(existing: DataFrame, clean: DataFrame, start: int | None = None) -> DataFrame:
    names = clean.select(F.col("ciudad").alias("nombre_ciudad"))
    return new_members(existing, names, "nombre_ciudad", "ciudad_key", {}, bound=clean, start=start)


def new_sellers(existing: DataFrame, clean: DataFrame, start: int | None = None) -> DataFrame:
    names = clean.select(F.col("vendedor").alias("nombre_vendedor"))
    return new_members(existing, names, "nombre_vendedor", "vendedor_key",
                       {"estado": F.lit("Activo")}, bound=clean, start=start)


def new_products(existing: DataFrame, clean: DataFrame, start: int | None = None) -> DataFrame:
    return new_members(existing, clean, "id_producto", "producto_key",
                       {"nombre_producto": product_label(F.col("id_producto")),
                        "categoria": F.lit("Sin Categoría"), "unidad_medida": F.lit("Unidad"),
                        "activo": F.lit(True)}, bound=clean, start=start)


def overwrite_changed(existing: DataFrame, incoming: DataFrame, natural: str, key: str,
                      bound: DataFrame | None = None, start: int | None = None) -> DataFrame:
    """Overwrite attributes with the incoming ones where given, add unknown members."""
    attributes = [c for c in incoming.columns if c != natural]
    new = incoming.select(natural, *[F.col(c).alias(f"_new_{c}") for c in attributes])
    kept = [c for c in existing.columns if c not in (natural, key)]
    joined = existing.join(new, natural, "full_outer").select(
        key, natural, *[(F.coalesce(f"_new_{c}", c) if c in attributes else F.col(c)).alias(c)
                        for c in kept])
    start = existing.agg(F.max(key)).scalar() if start is None else start
    added = assign_keys(joined.where(F.col(key).isNull()).drop(key), [natural], key, start, bound=bound)
    return joined.where(F.col(key).isNotNull()).unionByName(added)
