"""Masked copies, erasure and portability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.functions import masking as M
from salesmart.functions.normalize import to_integer
from salesmart.session import broadcast_if_small


def _replace(df: DataFrame, **new: Column) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def anonymise_sales(sales: DataFrame) -> DataFrame:
    """Fake e-mail, masked phone; ids and seller stay. For raw and clean sales alike."""
    return _replace(sales, email_cliente=M.fake_email(F.col("id_cliente")),
                    telefono_cliente=M.mask_phone(F.col("telefono_cliente")))


def customers_for_development(customers: DataFrame) -> DataFrame:
    keep = [c for c in ("cliente_key", "id_cliente", "email_cliente", "telefono_cliente", "ciudad",
                        "fecha_vigencia_desde", "fecha_vigencia_hasta", "es_registro_actual",
                        "fecha_creacion") if c in customers.columns]
    return anonymise_sales(customers.select(*keep))


def customers_for_reports(customers: DataFrame) -> DataFrame:
    keep = [c for c in ("cliente_key", "id_cliente", "email_cliente", "telefono_cliente", "ciudad",
                        "fecha_vigencia_desde", "fecha_vigencia_hasta", "es_registro_actual")
            if c in customers.columns]
    return clean_for_reports(customers.select(*keep))


def clean_for_reports(sales: DataFrame) -> DataFrame:
    return _replace(sales, email_cliente=M.report_email(F.col("email_cliente")),
                    telefono_cliente=M.report_phone(F.col("telefono_cliente")))


def pseudonymise(df: DataFrame, columns: list[str], salt: str) -> DataFrame:
    return _replace(df, **{c: M.pseudonym(F.col(c).cast("string"), salt) for c in columns})


def customer_id(df: DataFrame) -> Column:
    """The customer of a row as cleaning reads it, so that ``' 2001'`` and ``2001.0`` are found too."""
    col = F.col("id_cliente")
    return to_integer(col) if dict(df.dtypes)["id_cliente"] == "string" else col.cast("bigint")


def erase(df: DataFrame, requests: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Replace e-mail and phone of the requested customers; rows and keys stay.

    ``requests`` is a table of ``id_cliente``: any number of requests is one
    pass. Works on customer history, raw (text ids) and clean sales.
    """
    ids = requests.select(F.col("id_cliente").cast("bigint").alias("_erase")).distinct()
    joined = df.join(broadcast_if_small(ids, requests), customer_id(df) == F.col("_erase"), "left")
    hit = F.col("_erase").isNotNull()
    new = {"email_cliente": F.when(hit, M.fake_email(F.col("_erase"))).otherwise(F.col("email_cliente")),
           "telefono_cliente": F.when(hit, M.PHONE_STARS).otherwise(F.col("telefono_cliente"))}
    if stamp is not None and "fecha_actualizacion" in df.columns:
        new["fecha_actualizacion"] = F.when(hit, stamp).otherwise(F.col("fecha_actualizacion"))
    return _replace(joined, **new).select(*df.columns)


def portability(requests: DataFrame, customers: DataFrame, fact: DataFrame,
                canal: DataFrame, ciudad: DataFrame) -> DataFrame:
    """All data of the requested customers as (id, field, value, source, time).

    The id of every version, the other attributes of the current version,
    and one line per purchase.
    """
    ids = requests.select("id_cliente").distinct()
    mine = customers.join(broadcast_if_small(ids, requests), "id_cliente", "left_semi")
    created = F.col("fecha_creacion") if "fecha_creacion" in customers.columns else F.lit(None).cast("timestamp")
    cells = [F.struct(F.lit("id_cliente").alias("campo"), F.col("id_cliente").cast("string").alias("valor"))]
    cells += [F.when(F.col("es_registro_actual"), F.struct(F.lit(c).alias("campo"), F.col(c).alias("valor")))
              for c in ("email_cliente", "telefono_cliente", "ciudad")]
    facts_of = mine.select("cliente_key", F.col("id_cliente"))
    own = (mine.select("id_cliente", created.alias("fecha_registro"),
                       F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c"))
           .select("id_cliente", "c.campo", "c.valor", F.lit("dwh.dim_cliente").alias("tabla_origen"),
                   "fecha_registro"))
    loaded = F.col("fecha_carga") if "fecha_carga" in fact.columns else F.lit(None).cast("timestamp")
    # a customer has many versions, so what bounds these keys is the table of customers
    bought = (fact.join(broadcast_if_small(facts_of, customers), "cliente_key")
              .join(canal.select("canal_key", "nombre_canal"), "canal_key")
              .join(ciudad.select("ciudad_key", "nombre_ciudad"), "ciudad_key"))
    line = F.concat(F.lit("fecha="), F.col("fecha_venta").cast("string"),
                    F.lit(", monto="), F.col("monto_total").cast("string"),
                    F.lit(", canal="), "nombre_canal", F.lit(", ciudad="), "nombre_ciudad")
    history = bought.select("id_cliente", F.concat(F.lit("venta_id_"), F.col("id_venta").cast("string")).alias("campo"),
                            line.alias("valor"), F.lit("dwh.fact_ventas").alias("tabla_origen"),
                            loaded.alias("fecha_registro"))
    return own.unionByName(history)
