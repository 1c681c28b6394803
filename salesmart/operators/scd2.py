"""Customer history: slowly changing dimension of type 2."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.functions.normalize import blank_to_null
from salesmart.operators.ranking import assign_keys
from salesmart.session import broadcast_if_small, is_small, materialise

TRACKED = ("email_cliente", "telefono_cliente", "ciudad")


def latest_attributes(clean: DataFrame) -> DataFrame:
    """Attributes of each customer's last sale, ordered by date then sale id."""
    last = Window.partitionBy("id_cliente").orderBy(F.col("fecha").desc(), F.col("id_venta").desc())
    return (clean.select("id_cliente", *TRACKED, "fecha", "id_venta")
            .withColumn("_n", F.row_number().over(last)).where("_n = 1")
            .select("id_cliente", *TRACKED))


def _differs(tracked) -> Column:
    same = F.lit(True)
    for c in tracked:
        same = same & blank_to_null(F.col(c)).eqNullSafe(F.col(f"_new_{c}"))
    return ~same


def news(current: DataFrame, incoming: DataFrame, tracked=TRACKED) -> DataFrame:
    """Rows of ``incoming`` that a merge into ``current`` would act on: unknown customers and changed attributes."""
    new = incoming.select("id_cliente", *[blank_to_null(F.col(c)).alias(f"_new_{c}") for c in tracked])
    known = current.where("es_registro_actual").select("id_cliente", F.lit(True).alias("_known"), *tracked)
    acted = new.join(known, "id_cliente", "left").where(F.col("_known").isNull() | _differs(tracked))
    return incoming.join(acted.select("id_cliente"), "id_cliente", "left_semi")


def scd2_versions(current: DataFrame, incoming: DataFrame, eff_date: date, batch_id: str,
                  stamp: Column, tracked=TRACKED) -> DataFrame:
    """Versions after one merge: kept, closed and opened, from a single join.

    Opened versions have no ``cliente_key`` yet. A second change on the day
    a version was opened updates it in place, so no interval ends before it
    starts.
    """
    new = incoming.select("id_cliente", F.lit(True).alias("_has_new"),
                          *[blank_to_null(F.col(c)).alias(f"_new_{c}") for c in tracked])
    joined = current.join(new, "id_cliente", "full_outer")
    has_new = F.coalesce("_has_new", F.lit(False))
    known = F.col("cliente_key").isNotNull()
    changed = known & has_new & _differs(tracked)
    same_day = F.col("fecha_vigencia_desde") == F.lit(eff_date)
    close, in_place = changed & ~same_day, changed & same_day

    def version(key, attrs, since, until, active, created, touched, opened, closed):
        return F.struct(
            key.cast("bigint").alias("cliente_key"), F.col("id_cliente"),
            *[a.alias(c) for c, a in zip(tracked, attrs)],
            since.cast("date").alias("fecha_vigencia_desde"), until.cast("date").alias("fecha_vigencia_hasta"),
            active.alias("es_registro_actual"), created.cast("timestamp").alias("fecha_creacion"),
            touched.cast("timestamp").alias("fecha_actualizacion"),
            opened.cast("string").alias("id_batch_open"), closed.cast("string").alias("id_batch_close"))

    null = F.lit(None)
    kept = F.when(known, version(
        F.col("cliente_key"),
        [F.when(in_place, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in tracked],
        F.col("fecha_vigencia_desde"),
        F.when(close, F.lit(eff_date - timedelta(days=1))).otherwise(F.col("fecha_vigencia_hasta")),
        ~close, F.col("fecha_creacion"),
        F.when(changed, stamp).otherwise(F.col("fecha_actualizacion")),
        F.col("id_batch_open"), F.when(close, F.lit(batch_id)).otherwise(F.col("id_batch_close"))))
    opened = F.when((has_new & ~known) | close, version(
        null, [F.col(f"_new_{c}") for c in tracked], F.lit(eff_date), null, F.lit(True),
        stamp, null, F.lit(batch_id), null))
    return joined.select(F.explode(F.filter(F.array(kept, opened), lambda v: v.isNotNull())).alias("v")).select("v.*")


def edited_in_place(history: DataFrame, incoming: DataFrame, eff_date: date, stamp: Column,
                    tracked=TRACKED) -> DataFrame:
    """What a merge on ``eff_date`` replaces in versions that were opened that day."""
    new = incoming.select("id_cliente", *[blank_to_null(F.col(c)).alias(f"_new_{c}") for c in tracked])
    today = history.where(F.col("es_registro_actual") & (F.col("fecha_vigencia_desde") == F.lit(eff_date)))
    return today.join(new, "id_cliente").where(_differs(tracked)).select(
        "cliente_key", "id_cliente", *tracked, "fecha_actualizacion", stamp.alias("fecha_edicion"))


def scd2_merge(history: DataFrame, incoming: DataFrame, eff_date: date, batch_id: str,
               stamp: Column | None = None, tracked=TRACKED, start: Column | int | None = None) -> DataFrame:
    """The whole history after merging one snapshot of incoming attributes.

    Closed versions and customers that aren't incoming are passed through;
    only touched customers meet the incoming ones. Opened versions get keys
    above ``start`` (default: the highest key in use).
    """
    stamp = F.lit(eff_date).cast("timestamp") if stamp is None else stamp
    active = F.col("es_registro_actual")
    ids = broadcast_if_small(incoming.select("id_cliente"), incoming)
    touched = history.where(active).join(ids, "id_cliente", "left_semi")
    untouched = (history.where(~active).unionByName(history.where(active).join(ids, "id_cliente", "left_anti"))
                 .select(*history.columns))
    versions = scd2_versions(touched, incoming, eff_date, batch_id, stamp, tracked)
    # upper bound of what gets a key: one version per incoming customer
    small = is_small(incoming)
    if not (small and is_small(history)):  # read twice below
        versions = materialise(versions)
    start = history.agg(F.max("cliente_key")).scalar() if start is None else start
    opened = assign_keys(versions.where("cliente_key is null").drop("cliente_key"), ["id_cliente"],
                         "cliente_key", start, bound=incoming if small else None)
    return (untouched.unionByName(versions.where("cliente_key is not null"))
            .unionByName(opened))


def current_version(history: DataFrame) -> DataFrame:
    return history.where("es_registro_actual")


def undo_batch(history: DataFrame, batch_id: str, stamp: Column,
               previous: DataFrame | None = None, tracked=TRACKED) -> DataFrame:
    """Drop the versions a batch opened, reopen the ones it closed, take back its edits in place.

    ``previous`` holds what the batch replaced (``edited_in_place``). A closed
    version whose key is active already is left out: it was reopened by a
    call that was cut off.
    """
    kept = history.where(F.coalesce(F.col("id_batch_open") != batch_id, F.lit(True)))
    mine = F.coalesce(F.col("id_batch_close") == batch_id, F.lit(False))
    active = kept.where("es_registro_actual")
    reopened = kept.where(mine).join(active.select("cliente_key"), "cliente_key", "left_anti").withColumns({
        "fecha_vigencia_hasta": F.lit(None).cast("date"), "es_registro_actual": F.lit(True),
        "fecha_actualizacion": stamp, "id_batch_close": F.lit(None).cast("string")})
    if previous is not None:
        before = previous.select("cliente_key", F.lit(True).alias("_edited"),
                                 *[F.col(c).alias(f"_old_{c}") for c in (*tracked, "fecha_actualizacion")])
        active = active.join(before, "cliente_key", "left").select(*[
            F.when(F.col("_edited"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c)
            if c in (*tracked, "fecha_actualizacion") else F.col(c) for c in history.columns])
    closed = kept.where(~F.col("es_registro_actual") & ~mine)
    return closed.unionByName(active).unionByName(reopened)


def timelines(history: DataFrame) -> DataFrame:
    """One row per customer: its versions in order of validity.

    A customer has at most one version per day, so the array is bounded by
    the length of the calendar.
    """
    version = F.struct("fecha_vigencia_desde", "fecha_vigencia_hasta", "cliente_key")
    return history.groupBy("id_cliente").agg(F.sort_array(F.collect_list(version)).alias("_versions"))


def as_of(sales: DataFrame, history: DataFrame, day: str = "fecha") -> DataFrame:
    """Customer version valid on the day of each sale; null when there is none.

    The first version counts from the beginning of time. The join has one
    row per customer on the right, so no sale meets more than its own
    timeline and a customer with very many sales can be split.
    """
    first = F.col("_versions")[0]
    inside = F.filter("_versions", lambda v: (F.col(day) >= v["fecha_vigencia_desde"])
                      & (v["fecha_vigencia_hasta"].isNull() | (F.col(day) <= v["fecha_vigencia_hasta"])))
    early = F.col(day) < first["fecha_vigencia_desde"]
    key = F.when(early, first["cliente_key"]).otherwise(F.get(inside, F.lit(0))["cliente_key"])
    return (sales.join(timelines(history), "id_cliente", "left")
            .withColumn("cliente_key", key).drop("_versions"))


def broken_history(history: DataFrame) -> DataFrame:
    """Customers without exactly one active version, or with gaps or overlaps."""
    nxt = F.lead("fecha_vigencia_desde").over(
        Window.partitionBy("id_cliente").orderBy("fecha_vigencia_desde"))
    joint = F.coalesce(nxt != F.date_add("fecha_vigencia_hasta", 1), F.lit(False))
    open_end = nxt.isNotNull() & F.col("fecha_vigencia_hasta").isNull()
    return (history.withColumn("_bad", joint | open_end).groupBy("id_cliente").agg(
        F.count(F.lit(1)).alias("total_versiones"), F.count_if("es_registro_actual").alias("versiones_activas"),
        F.count_if("_bad").alias("cortes"))
        .where((F.col("versiones_activas") != 1) | (F.col("cortes") > 0)))
