"""Checks after a load and batch reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesmart.operators.cleaning import stored_keys_near
from salesmart.session import materialise


def batch_summary(fact: DataFrame) -> DataFrame:
    loaded = [F.max("fecha_carga").alias("ultima_carga")] if "fecha_carga" in fact.columns else []
    n = F.sum("n_ventas") if "n_ventas" in fact.columns else F.count(F.lit(1))
    return fact.groupBy("id_batch").agg(
        n.alias("total_ventas"), F.sum("monto_total").alias("monto_total_cargado"),
        F.min("fecha_venta").alias("fecha_min"), F.max("fecha_venta").alias("fecha_max"), *loaded)


def stage_vs_fact(stage: DataFrame, fact: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Rows and amount on both sides of the load, of one batch or of each."""
    def totals(df, name):
        df = df if batch_id is None else df.where(F.col("id_batch") == batch_id)
        return df.groupBy("id_batch").agg(
            F.count(F.lit(1)).alias("total_registros"), F.sum("monto_total").alias("monto_total"),
        ).withColumn("origen", F.lit(name))
    return totals(stage, "staging_clean").unionByName(totals(fact, "fact_ventas"))


def orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Per dimension, how many facts point to no member; a null key points to none.

    The fact is read once: its rows are counted per key of each dimension,
    in each task first, and written down, so the checks join distinct keys.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("dim"), F.col(name.removeprefix("dim_") + "_key").cast("bigint").alias("key"))
                      for name in dims])
    counts = materialise(fact.select(F.explode(pairs).alias("p")).groupBy("p.dim", "p.key").agg(
        F.count(F.lit(1)).alias("n")))
    out = None
    for name, dim in dims.items():
        key = name.removeprefix("dim_") + "_key"
        keys = counts.where(F.col("dim") == name).select(F.col("key").alias(key), "n")
        lost = keys.join(dim.select(F.col(key).cast("bigint").alias(key)), key, "left_anti").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("filas")).select(
                F.lit(f"fact sin {name}").alias("problema"), "filas")
        out = lost if out is None else out.unionByName(lost)
    return out


def list_batches(fact: DataFrame) -> DataFrame:
    return fact.groupBy("id_batch").agg(F.min("fecha_carga").alias("fecha_carga"))


def duplicates_raw(raw: DataFrame) -> DataFrame:
    return raw.groupBy("id_venta").agg(F.count(F.lit(1)).alias("ocurrencias")).where("ocurrencias > 1")


def duplicates_incremental(clean: DataFrame, fact: DataFrame) -> DataFrame:
    """Clean rows whose sale is already in the fact, with its first load time."""
    near = stored_keys_near(fact, clean, columns=("fecha_carga",))
    loaded = near.select("id_venta", F.col("fecha_carga").alias("fecha_carga_original"))
    return clean.select("id_venta", "fecha").join(loaded, "id_venta").withColumn(
        "tipo_problema", F.lit("DUPLICADO_INCREMENTAL"))


def amount_mismatch(fact: DataFrame, tolerance: float = 0.01) -> DataFrame:
    expected = F.col("cantidad") * F.col("precio_unitario")
    gap = F.abs(F.col("monto_total") - expected)
    return fact.where(gap > tolerance).select(
        "id_venta", "cantidad", "precio_unitario", "monto_total",
        expected.alias("monto_calculado"), gap.alias("diferencia"))


def staging_footprint(raw: DataFrame, clean: DataFrame) -> DataFrame:
    def extent(df, name, stamp):
        return df.agg(F.count(F.lit(1)).alias("registros"), F.min(stamp).alias("mas_antiguo"),
                      F.max(stamp).alias("mas_reciente")).withColumn("tabla", F.lit(name))
    return extent(raw, "ventas_raw", "fecha_carga").unionByName(
        extent(clean, "ventas_clean", "fecha_procesamiento"))


def latest_quality(log: DataFrame, limit: int = 20) -> DataFrame:
    """The newest entries of the quality log; the limit is the report's own."""
    return log.orderBy(F.col("fecha_validacion").desc(), "regla_calidad").limit(limit)


def expired(df: DataFrame, stamp: str, days: int, now) -> DataFrame:
    return df.where(F.col(stamp) < F.lit(now) - F.make_dt_interval(F.lit(days)))


def kept(df: DataFrame, stamp: str, days: int, now) -> DataFrame:
    return df.where(F.col(stamp) >= F.lit(now) - F.make_dt_interval(F.lit(days)))
