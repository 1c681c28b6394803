"""Cleaning: parse, normalise, reject with a reason, dedupe, skip loaded keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.functions import normalize as N
from salesmart.functions.numbers import line_amount
from salesmart.operators.quality import FIRST_DATE, LAST_DATE

ARRIVAL = ("fecha_carga", "archivo_origen", "row_seq")
CLEAN_COLUMNS = ("id_venta", "fecha", "id_cliente", "id_producto", "cantidad", "precio_unitario",
                 "canal", "ciudad", "vendedor", "email_cliente", "telefono_cliente", "monto_total")


def _at_least_one(col: Column) -> Column:
    return F.coalesce(col >= 1, F.lit(False))


def typed(raw: DataFrame) -> DataFrame:
    """Parsed columns next to ``_raw_id``; unparseable values are null."""
    price, quantity = N.to_decimal(F.col("precio_unitario")), N.to_integer(F.col("cantidad"), "int")
    keep = [c for c in (*ARRIVAL, "id_batch") if c in raw.columns]
    return raw.select(
        F.col("id_venta").alias("_raw_id"), N.to_integer(F.col("id_venta")).alias("id_venta"),
        N.normalize_date(F.col("fecha")).alias("fecha"),
        N.to_integer(F.col("id_cliente")).alias("id_cliente"),
        N.to_integer(F.col("id_producto")).alias("id_producto"),
        quantity.alias("cantidad"), price.alias("precio_unitario"),
        N.normalize_channel(F.col("canal")).alias("canal"),
        # a blank city stays a city of its own unless the strict rules reject it
        F.coalesce(N.clean_text(F.col("ciudad")), F.lit("")).alias("ciudad"),
        N.seller_or_default(F.col("vendedor")).alias("vendedor"),
        N.clean_text(F.col("email_cliente")).alias("email_cliente"),
        N.clean_text(F.col("telefono_cliente")).alias("telefono_cliente"),
        line_amount(quantity, price).alias("monto_total"), *keep)


def reject_reason(strict: bool = False) -> Column:
    """First failing step of a typed row, null when the row is good.

    ``strict`` also applies the written governance rules: known channel,
    city present, date inside the calendar.
    """
    reason = F.when(F.col("fecha").isNull(), "FECHA_INVALIDA")
    if strict:
        reason = reason.when(~F.col("fecha").between(F.lit(FIRST_DATE), F.lit(LAST_DATE)),
                             "FECHA_FUERA_RANGO")
    reason = reason.when(F.col("canal").isNull(), "CANAL_INVALIDO")
    if strict:
        reason = (reason.when(~N.is_known_channel(F.col("canal")), "CANAL_INVALIDO")
                  .when(N.is_blank(F.col("ciudad")), "CIUDAD_VACIA"))
    price_ok = F.coalesce(F.col("precio_unitario") > 0, F.lit(False))
    ids_ok = (_at_least_one(F.col("id_venta")) & _at_least_one(F.col("id_cliente"))
              & _at_least_one(F.col("id_producto")))
    return (reason.when(~price_ok, "PRECIO_INVALIDO")
            .when(~_at_least_one(F.col("cantidad")), "CANTIDAD_INVALIDA")
            .when(~ids_ok, "ID_INVALIDO")
            .when(F.col("monto_total").isNull(), "MONTO_INVALIDO"))


def judge(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Typed rows with ``motivo``: one narrow stage over the raw table."""
    return with_reason(typed(raw), reject_reason(strict))


def with_reason(rows: DataFrame, reason: Column) -> DataFrame:
    """Add ``motivo`` as the output of a generator of one row.

    A filter on a plain column would be pushed below the parsing and repeat
    it all inside the filter; a generated column is computed once.
    """
    return rows.select("*", F.explode(F.array(reason)).alias("motivo"))


def rejected_rows(judged: DataFrame) -> DataFrame:
    keep = [c for c in ("id_batch",) if c in judged.columns]
    return judged.where("motivo is not null").select(
        F.col("_raw_id").alias("id_venta"), "motivo", *keep)


def dedupe_first(rows: DataFrame, key: str = "id_venta", order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """First arrival per key; each task forwards one row per key to the shuffle."""
    first = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def stored_keys_near(existing: DataFrame, wanted: DataFrame, key: str = "id_venta",
                     columns: tuple[str, ...] = ()) -> DataFrame:
    """Keys (and ``columns``) of ``existing`` inside the key range of ``wanted``.

    The range is two scalar subqueries that reach the scan of the stored
    table, where keys grow with time: old row groups are not read.
    """
    low, high = wanted.agg(F.min(key)).scalar(), wanted.agg(F.max(key)).scalar()
    return existing.select(key, *columns).where((F.col(key) >= low) & (F.col(key) <= high))


def with_loaded(rows: DataFrame, existing: DataFrame, key: str = "id_venta",
                wanted: DataFrame | None = None) -> DataFrame:
    """``rows`` with a flag ``_loaded``: its key is stored already. One join.

    ``wanted`` is a cheap table with at least the keys of ``rows``; given, it
    bounds the part of the stored table that is read.
    """
    near = existing.select(key) if wanted is None else stored_keys_near(existing, wanted, key)
    near = near.distinct().withColumn("_stored", F.lit(True))
    return rows.join(near, key, "left").withColumn("_loaded", F.col("_stored").isNotNull()).drop("_stored")


def split_loaded(rows: DataFrame, existing: DataFrame, key: str = "id_venta",
                 wanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new rows, rows whose key is already stored); see ``with_loaded``."""
    flagged = with_loaded(rows, existing, key, wanted)
    return flagged.where(~F.col("_loaded")).drop("_loaded"), flagged.where("_loaded").drop("_loaded")


def outcome(raw: DataFrame, existing: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Typed rows with ``motivo``, without later copies of good sales, parsed once.

    Good rows are numbered per sale; rejected ones, which take no part in
    that, are spread by their place so that no reason gathers in one task.
    ``existing`` holds the keys already in the fact table; good rows among
    them get the reason ``DUPLICADO_EN_DWH``.
    """
    judged = judge(raw, strict)
    good, told = F.col("motivo").isNull(), F.col("id_venta").cast("string")
    spread = F.when(~good, F.xxhash64("_raw_id", *[c for c in ARRIVAL if c in judged.columns]))
    # the text of a good id is shuffled only where the number doesn't tell it
    judged = judged.withColumn("_raw_id", F.when(~good | (F.col("_raw_id") != told), F.col("_raw_id")))
    first = Window.partitionBy(F.when(good, F.col("id_venta")), spread).orderBy(*ARRIVAL)
    rows = judged.withColumn("_n", F.row_number().over(first)).where(~good | (F.col("_n") == 1)).drop("_n")
    rows = rows.withColumn("_raw_id", F.when(good, F.coalesce("_raw_id", told)).otherwise(F.col("_raw_id")))
    if existing is None:
        return rows
    ids = raw.select(N.to_integer(F.col("id_venta")).alias("id_venta"))
    known = F.col("_loaded") & F.col("motivo").isNull()
    return with_loaded(rows, existing, wanted=ids).withColumn(
        "motivo", F.when(known, "DUPLICADO_EN_DWH").otherwise(F.col("motivo"))).drop("_loaded")


def to_split(rows: DataFrame) -> DataFrame:
    """The columns of an ``outcome`` that ``split`` reads; the text of the id stays with rejected rows alone."""
    keep = [c for c in ("id_batch",) if c in rows.columns]
    raw_id = F.when(F.col("motivo").isNotNull(), F.col("_raw_id")).alias("_raw_id")
    return rows.select(raw_id, *CLEAN_COLUMNS, "motivo", *keep)


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with their reason) of an ``outcome``."""
    keep = [c for c in ("id_batch",) if c in rows.columns]
    return rows.where("motivo is null").select(*CLEAN_COLUMNS, *keep), rejected_rows(rows)


def clean(raw: DataFrame, existing: DataFrame | None = None,
          strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with their reason).

    Later copies of a sale are dropped silently. ``existing`` holds the keys
    already in the fact table; they come back as ``DUPLICADO_EN_DWH``.
    """
    judged = judge(raw, strict)
    keep = [c for c in ("id_batch",) if c in judged.columns]
    good = dedupe_first(judged.where("motivo is null"))
    rejected = rejected_rows(judged)
    if existing is not None:
        ids = raw.select(N.to_integer(F.col("id_venta")).alias("id_venta"))
        good, known = split_loaded(good, existing, wanted=ids)
        rejected = rejected.unionByName(known.select(
            F.col("_raw_id").alias("id_venta"), F.lit("DUPLICADO_EN_DWH").alias("motivo"), *keep))
    return good.select(*CLEAN_COLUMNS, *keep), rejected


def profile_clean(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The profiler's variant: only a missing price or a quantity of zero or less rejects."""
    rows = typed(raw)
    reason = (F.when(F.col("fecha").isNull(), "FECHA_INVALIDA")
              .when(F.col("precio_unitario").isNull(), "PRECIO_NULO")
              .when(F.coalesce(F.col("cantidad") <= 0, F.lit(False)), "CANTIDAD_INVALIDA")
              .when(F.col("id_venta").isNull() | F.col("id_cliente").isNull()
                    | F.col("id_producto").isNull() | F.col("cantidad").isNull(), "ID_INVALIDO"))
    judged = with_reason(rows, reason)
    return (dedupe_first(judged.where("motivo is null")).select(*CLEAN_COLUMNS),
            rejected_rows(judged))
