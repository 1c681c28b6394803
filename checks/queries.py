"""Registered queries: ``name -> callable(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.functions import dates, masking, normalize as N
from salesmart.operators import (access, cleaning, dimensions, facts, key_index, privacy, profiling, quality,
                                 reconcile, scd2)
from salesmart.operators.calendar import build_calendar, calendar_of, days_between
from salesmart.operators.ranking import assign_keys, with_ntile, with_rank, with_row_number
from salesmart.plans import analytics, measures
from salesmart.plans.batch_load import KEY_INDEX_T, Warehouse, run_summary as summary_of
from salesmart.schemas import BUSINESS_COLUMNS
from salesmart.session import configure, materialise, scratch_of_job, scratch_path
from salesmart.sources.csv_files import read_after, read_csv, stamp_lineage
from salesmart.sources.raw_sample import RAW_EXPRESSIONS, raw_sales
from salesmart.sources.seeds import seed_dimensions
from salesmart.sources.star import TABLE_SCHEMAS, Star, order_star, read
from salesmart.sources.tables import RETENTION_DAYS, Store
from salesmart.streaming.ingest import (daily_quality, daily_totals, dedupe_late, file_stream, ingest, new_only,
                                        quality_by_day, with_final, write_updated)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame) -> DataFrame:
    """Output types both engines share: bigint, double, string."""
    out = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind in ("int", "smallint", "tinyint", "boolean"):
            col = col.cast("bigint")
        elif kind.startswith("decimal") or kind == "float":
            col = col.cast("double")
        elif kind == "date":
            col = col.cast("string")
        elif kind.startswith("timestamp"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        out.append(col.alias(name))
    return df.select(*out)


def register(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(configure(spark), sf_dir))
    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


def _on_star(plan, name=None):
    def run(spark, sf_dir):
        return plan(order_star(spark, sf_dir))
    run.__name__, run.__doc__ = name or plan.__name__, plan.__doc__
    register(run)


for _plan in (analytics.top_customers, analytics.monthly_trend, analytics.city_analysis,
              analytics.seller_ranking, analytics.product_analysis, analytics.channel_analysis,
              analytics.product_yoy, analytics.sales_view, analytics.city_rollup, analytics.product_rollup):
    _on_star(_plan)


# Two customers in three move on this day: sales before it belong to an earlier version of theirs.
MOVE_DAY = date(1998, 4, 1)


def _moved_star(spark, sf_dir):
    """The order star with a second version of customers; version keys are twice the id, plus one from the move on."""
    star = order_star(spark, sf_dir)
    moves = F.col("id_cliente") % 3 > 0
    key = F.col("id_cliente") * 2
    now = star.cliente.withColumn("cliente_key", key + 1).withColumn(
        "fecha_vigencia_desde", F.when(moves, F.lit(MOVE_DAY)).otherwise(F.col("fecha_vigencia_desde")))
    before = (star.cliente.where(moves).withColumn("cliente_key", key).withColumn("es_registro_actual", F.lit(False))
              .withColumn("ciudad", F.concat(F.lit("Antes de "), "ciudad")).withColumn("fecha_vigencia_hasta", F.lit(MOVE_DAY)))
    sold_to = F.col("cliente_key") * 2 + F.when(
        (F.col("cliente_key") % 3 > 0) & (F.col("fecha_venta") < F.lit(MOVE_DAY)), 0).otherwise(1)
    return Star(fact=star.totals().withColumn("cliente_key", sold_to), cliente=now.unionByName(before))


@register
def top_customers_all_versions(spark, sf_dir):
    """Best customers by the sales of all their versions, where two in three have moved."""
    return analytics.top_customers(_moved_star(spark, sf_dir), by_id=True)


@register
def top_customers_current_version(spark, sf_dir):
    """Best customers by the sales of their current version alone, over the same star."""
    return analytics.top_customers(_moved_star(spark, sf_dir))


# ---- raw rows: parsing, quality, profiles, cleaning -------------------------

def _raw(spark, sf_dir):
    return raw_sales(spark, sf_dir)


def _first_load(raw):
    """Raw rows of the first file."""
    return raw.where(F.col("archivo_origen") == "ventas_raw.csv")


def _second_load(raw):
    return raw.where(F.col("archivo_origen") == "ventas_nuevas.csv")


def _loaded_ids(raw):
    return (_first_load(raw).select(N.to_integer(F.col("id_venta")).alias("id_venta"))
            .where("id_venta is not null").distinct())


@register
def normalized_dates(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return (raw.groupBy(F.col("fecha").alias("texto")).agg(F.count(F.lit(1)).alias("filas"))
            .withColumn("fecha", N.normalize_date(F.col("texto")))
            .select("texto", "filas", "fecha", dates.date_key(F.col("fecha")).alias("fecha_key"),
                    dates.iso_weekday(F.col("fecha")).alias("dia_semana"),
                    dates.next_monday(F.col("fecha")).alias("lunes"),
                    dates.month_name(F.month("fecha")).alias("nombre_mes")))


@register
def normalized_channel(spark, sf_dir):
    canal = F.col("texto")
    return (_raw(spark, sf_dir).groupBy(F.col("canal").alias("texto"))
            .agg(F.count(F.lit(1)).alias("filas"))
            .select("texto", "filas", N.normalize_channel(canal).alias("canal"),
                    N.is_known_channel(canal).alias("conocido"),
                    N.is_miscased_channel(canal).alias("mal_escrito"),
                    N.channel_kind(N.normalize_channel(canal)).alias("tipo_canal")))


@register
def typed_numbers(spark, sf_dir):
    rows = cleaning.typed(_raw(spark, sf_dir))
    return rows.select(F.col("_raw_id").alias("texto_id"), "id_venta", "id_cliente", "id_producto",
                       "cantidad", "precio_unitario", "monto_total", "vendedor",
                       N.product_label(F.col("id_producto")).alias("nombre_producto"))


@register
def email_phone_checks(spark, sf_dir):
    e, p = F.col("email_cliente"), F.col("telefono_cliente")
    return (_raw(spark, sf_dir).groupBy(e, p).agg(F.count(F.lit(1)).alias("filas"))
            .select("email_cliente", "telefono_cliente", "filas",
                    N.is_valid_email(e).alias("email_ok"), N.is_valid_phone(p).alias("telefono_ok")))


@register
def quality_log(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return quality.quality_log(raw, _loaded_ids(raw), order_star(spark, sf_dir).lines())


@register
def profile_quality_log(spark, sf_dir):
    return quality.profile_log(_raw(spark, sf_dir))


@register
def quality_scores(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    log = quality.quality_log(raw)
    a = quality.score_mean_of_rules(log).select(F.lit("A").alias("formula"), "score")
    b = quality.score_pooled(quality.profile_log(raw)).select(F.lit("B").alias("formula"), "score")
    c = quality.score_dimensions(log).select(F.lit("C").alias("formula"),
                                             (F.col("score") / 100).alias("score"))
    return (a.unionByName(b).unionByName(c)
            .withColumn("estado", quality.gate_level(F.col("score")))
            .withColumn("score", F.round("score", 4)))


@register
def violations(spark, sf_dir):
    return quality.violations(_raw(spark, sf_dir))


@register
def key_violations(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return quality.key_violations(_second_load(raw), _loaded_ids(raw))


@register
def table_stats(spark, sf_dir):
    return profiling.table_stats(_raw(spark, sf_dir))


@register
def column_profile(spark, sf_dir):
    return profiling.column_profile(_raw(spark, sf_dir))


@register
def numeric_profile(spark, sf_dir):
    return profiling.numeric_profile(_raw(spark, sf_dir))


@register
def iqr_outliers(spark, sf_dir):
    return profiling.iqr_outliers(_raw(spark, sf_dir))


@register
def iqr_sketch(spark, sf_dir):
    """Whether the ranks of sketched quartiles are within the stated accuracy of the exact ones, per column."""
    cells = materialise(profiling.numeric_cells(_raw(spark, sf_dir), ("cantidad", "precio_unitario")))
    accuracy, points = 100, {"q1": 0.25, "q3": 0.75}
    found = F.broadcast(profiling.percentiles(cells, points, accuracy))  # a row per profiled column
    value = F.col("valor").cast("double")
    below = [f(c).alias(f"{c}_{n}") for c in points for n, f in (
        ("menos", lambda c: F.count_if(value < F.col(c))), ("hasta", lambda c: F.count_if(value <= F.col(c))))]
    ranks = cells.join(found, "columna").groupBy("columna", "n").agg(*below)
    off = F.ceil(F.col("n") / accuracy)
    return ranks.select("columna", "n", *[
        ((F.col(f"{c}_menos") <= F.col("n") * p + off) & (F.col(f"{c}_hasta") >= F.col("n") * p - off)).alias(f"{c}_dentro")
        for c, p in points.items()])


@register
def value_frequencies(spark, sf_dir):
    return profiling.value_frequencies(_raw(spark, sf_dir))


@register
def clean_rows(spark, sf_dir):
    return cleaning.clean(_raw(spark, sf_dir))[0]


@register
def rejected_rows(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return cleaning.clean(_second_load(raw), _loaded_ids(raw))[1]


@register
def clean_rows_strict(spark, sf_dir):
    good, bad = cleaning.split(materialise(cleaning.outcome(_raw(spark, sf_dir), strict=True)))
    return (good.groupBy(F.lit("LIMPIA").alias("motivo")).agg(F.count(F.lit(1)).alias("filas"))
            .unionByName(bad.groupBy("motivo").agg(F.count(F.lit(1)).alias("filas"))))


@register
def profile_clean_rows(spark, sf_dir):
    good, bad = cleaning.profile_clean(_raw(spark, sf_dir))
    return (good.groupBy(F.lit("LIMPIA").alias("motivo")).agg(F.count(F.lit(1)).alias("filas"))
            .unionByName(bad.groupBy("motivo").agg(F.count(F.lit(1)).alias("filas"))))


@register
def dedupe_first(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return cleaning.dedupe_first(raw).select("id_venta", "fecha_carga", "row_seq", "cantidad")


@register
def exclude_loaded(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return cleaning.clean(_second_load(raw), _loaded_ids(raw))[0].select("id_venta", "fecha", "monto_total")


# ---- dimensions, history, facts ---------------------------------------------

EFFECTIVE = date(2002, 1, 1)


def _table(spark, sf_dir, name):
    return read(spark, sf_dir, name)


@register
def calendar_dim(spark, sf_dir):
    """The calendar of all years that have orders, with the orders of each day."""
    day = F.col("o_orderdate").cast("date")
    orders = _table(spark, sf_dir, "orders").groupBy(day.alias("fecha")).agg(F.count(F.lit(1)).alias("pedidos"))
    years = orders.agg(F.trunc(F.min("fecha"), "year").alias("a"),
                       F.last_day(F.add_months(F.trunc(F.max("fecha"), "year"), 11)).alias("b"))
    return calendar_of(days_between(years, "a", "b")).join(orders, "fecha", "left").fillna({"pedidos": 0})


@register
def holidays(spark, sf_dir):
    """Sales of each holiday of the years that have orders."""
    orders = order_star(spark, sf_dir).totals().groupBy(F.col("fecha_venta").alias("fecha")).agg(
        F.sum("n_ventas").alias("ventas"), F.sum("monto_total").alias("monto_total"))
    return _holiday_sales(orders, False)


def _holiday_sales(orders, movable):
    return (calendar_of(orders.select("fecha"), movable).where("es_festivo")
            .join(orders, "fecha").select("fecha", "nombre_festivo", "dia_semana", "ventas", "monto_total"))


@register
def holidays_movable(spark, sf_dir):
    """The same with the feasts that follow Easter."""
    orders = order_star(spark, sf_dir).totals().groupBy(F.col("fecha_venta").alias("fecha")).agg(
        F.sum("n_ventas").alias("ventas"), F.sum("monto_total").alias("monto_total"))
    return _holiday_sales(orders, True)


@register
def assigned_keys(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    start = _table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).scalar()
    return assign_keys(customers, ["c_name"], "cliente_key", start)


@register
def global_ranks(spark, sf_dir):
    """Ranks, positions and tiles of all parts by sales without any one-task window."""
    sums = order_star(spark, sf_dir).sales().groupBy("producto_key").agg(
        F.sum("monto_total").alias("monto_total"), F.sum("cantidad").alias("unidades"))
    ranked = with_rank(sums, "monto_total", "rango")
    ranked = with_rank(ranked, "unidades", "rango_denso", method="dense")
    ranked = with_row_number(ranked, "unidades", "producto_key", "posicion")
    return with_ntile(ranked, 7, "unidades", "producto_key", "tramo")


@register
def ranks_with_gaps(spark, sf_dir):
    """Ranks by both ways over null values, null groups, ties, negatives and doubles."""
    customer = _table(spark, sf_dir, "customer")
    rows = customer.select(
        "c_custkey", "c_name", F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("grupo"),
        F.when(F.col("c_custkey") % 7 != 0, F.floor(F.col("c_acctbal").cast("double") / 100) / 4).alias("valor"))
    for suffix, bound in (("ventana", customer), ("rangos", None)):
        rows = with_rank(rows, "valor", f"rango_{suffix}", by=["grupo"], bound=bound)
        rows = with_rank(rows, "valor", f"denso_{suffix}", by=["grupo"], method="dense", descending=False, bound=bound)
        rows = with_rank(rows, "valor", f"global_{suffix}", bound=bound)
        rows = with_row_number(rows, "valor", "c_name", f"posicion_{suffix}", bound=bound)
        rows = with_ntile(rows, 5, "valor", "c_name", f"tramo_{suffix}", bound=bound)
    return rows.drop("c_name")


@register
def new_dim_members(spark, sf_dir):
    """Members of the clean sales that the stored dimensions lack."""
    stored = _test_dims(spark, sf_dir)
    names = materialise(dimensions.member_names(cleaning.clean(_raw(spark, sf_dir))[0]))
    out = None
    for kind, natural, maker in (("canal", "nombre_canal", dimensions.new_channels),
                                 ("ciudad", "nombre_ciudad", dimensions.new_cities),
                                 ("vendedor", "nombre_vendedor", dimensions.new_sellers),
                                 ("producto", "id_producto", dimensions.new_products)):
        column = "id_producto" if kind == "producto" else kind
        rows = maker(stored[f"dim_{kind}"], dimensions.names_of(names, column)).select(
            F.lit(kind).alias("dimension"), F.col(f"{kind}_key").alias("clave"),
            F.col(natural).cast("string").alias("miembro"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register
def scd1_overwrite(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id_producto"), F.col("p_name").alias("nombre_producto"), "p_size",
        F.col("p_retailprice").cast("decimal(12,2)").alias("precio_referencia"))
    stored = part.where("p_size <= 25").select((F.col("id_producto") * 2 + 1).alias("producto_key"),
                                               "id_producto", "nombre_producto", "precio_referencia")
    incoming = part.where("p_size >= 10").select("id_producto", "nombre_producto", F.when(
        F.col("p_size") % 2 == 0, F.col("precio_referencia") + 1).cast("decimal(12,2)").alias("precio_referencia"))
    return dimensions.overwrite_changed(stored, incoming, "id_producto", "producto_key", bound=part)


def _customer_history(spark, sf_dir):
    """Stored versions: two for wealthy customers, none for one market segment."""
    c = (_table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'")
         .join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")))
    two = F.col("c_acctbal") > 5000
    email = F.concat(F.lit("c"), "c_custkey", F.lit("@mail.com"))
    phone = F.lpad(F.col("c_custkey").cast("string"), 10, "3")
    def version(key, city, since, until, active, opened, closed):
        return F.struct(
            key.cast("bigint").alias("cliente_key"), F.col("c_custkey").alias("id_cliente"),
            email.alias("email_cliente"), phone.alias("telefono_cliente"), city.alias("ciudad"),
            since.cast("date").alias("fecha_vigencia_desde"), until.cast("date").alias("fecha_vigencia_hasta"),
            active.alias("es_registro_actual"), F.lit("1995-01-01 00:00:00").cast("timestamp").alias("fecha_creacion"),
            F.lit(None).cast("timestamp").alias("fecha_actualizacion"),
            opened.alias("id_batch_open"), closed.cast("string").alias("id_batch_close"))
    old = F.when(two, version(F.col("c_custkey") * 2, F.lit("Origen"), F.lit("1995-06-01"), F.lit("1997-12-31"),
                              F.lit(False), F.lit("b0"), F.lit("b1")))
    since = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit("2002-01-01"))
             .when(two, F.lit("1998-01-01")).otherwise(F.lit("1995-06-01")))
    now = version(F.col("c_custkey") * 2 + 1, F.col("n_name"), since, F.lit(None), F.lit(True),
                  F.when(two, "b1").otherwise("b0"), F.lit(None))
    return c.select(F.explode(F.filter(F.array(old, now), lambda v: v.isNotNull())).alias("v")).select("v.*")


def _customer_snapshot(spark, sf_dir):
    """Incoming attributes of all customers: indebted ones moved, some lost their phone."""
    c = _table(spark, sf_dir, "customer").join(
        _table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(
        F.col("c_custkey").alias("id_cliente"), F.concat(F.lit("c"), "c_custkey", F.lit("@mail.com")).alias("email_cliente"),
        F.when(F.col("c_acctbal") > 9500, " ").otherwise(
            F.lpad(F.col("c_custkey").cast("string"), 10, "3")).alias("telefono_cliente"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("Nueva "), "n_name")).otherwise(F.col("n_name")).alias("ciudad"))


def _merged_history(spark, sf_dir):
    return scd2.scd2_merge(_customer_history(spark, sf_dir), _customer_snapshot(spark, sf_dir), EFFECTIVE, "b2")


@register
def scd2_history(spark, sf_dir):
    return _merged_history(spark, sf_dir)


@register
def scd2_undo(spark, sf_dir):
    """The merge undone: the stored history again, same-day edits too; reopened versions carry the time of the undo."""
    edited = scd2.edited_in_place(_customer_history(spark, sf_dir), _customer_snapshot(spark, sf_dir), EFFECTIVE,
                                  F.lit("2002-01-01").cast("timestamp"))
    return scd2.undo_batch(_merged_history(spark, sf_dir), "b2", F.lit("2002-01-02").cast("timestamp"), edited)


@register
def scd2_invariant(spark, sf_dir):
    """Broken customers of the merge, and of a history whose flags were all set."""
    merged = _merged_history(spark, sf_dir)
    good = scd2.broken_history(merged).withColumn("caso", F.lit("merge"))
    bad = scd2.broken_history(merged.withColumn("es_registro_actual", F.lit(True))).withColumn("caso", F.lit("roto"))
    return good.unionByName(bad)


@register
def asof_customer(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("id_cliente"), F.col("o_orderdate").cast("date").alias("fecha"))
    return scd2.as_of(orders, _merged_history(spark, sf_dir).drop("fecha_creacion"))


@register
def latest_customer_attributes(spark, sf_dir):
    return scd2.latest_attributes(cleaning.clean(_raw(spark, sf_dir))[0])


def _test_dims(spark, sf_dir):
    """Dimensions that lack some members of the clean sales."""
    supplier, part = _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "part")
    seeds = seed_dimensions(spark)
    sellers = supplier.where("s_nationkey < 20").select(
        F.concat(F.lit("Vendedor "), (F.col("s_suppkey") % 50).cast("string")).alias("nombre_vendedor")).distinct()
    return {
        "dim_fecha": build_calendar(spark),
        "dim_cliente": supplier.select((F.col("s_suppkey") + 1).alias("id_cliente"), F.col("s_suppkey").alias("cliente_key"),
                                       (F.col("s_acctbal") > 0).alias("es_registro_actual")),
        "dim_producto": part.where("p_type <> 'PROMO'").select(
            (F.col("p_partkey") + 1).alias("id_producto"), F.col("p_partkey").alias("producto_key")),
        "dim_vendedor": sellers.select("nombre_vendedor", F.split_part(
            "nombre_vendedor", F.lit(" "), F.lit(2)).cast("bigint").alias("vendedor_key")),
        "dim_canal": seeds["dim_canal"], "dim_ciudad": seeds["dim_ciudad"]}


def _keyed(spark, sf_dir):
    return facts.resolve_keys(cleaning.clean(_raw(spark, sf_dir))[0], _test_dims(spark, sf_dir))


_KEYS = ("fecha_key", "cliente_key", "producto_key", "vendedor_key", "canal_key", "ciudad_key")


@register
def fact_resolved(spark, sf_dir):
    return facts.resolved(_keyed(spark, sf_dir)).select("id_venta", *_KEYS, "cantidad", "precio_unitario", "monto_total")


@register
def fact_star_join(spark, sf_dir):
    return facts.star_rows(cleaning.clean(_raw(spark, sf_dir))[0], _test_dims(spark, sf_dir)).select(
        "id_venta", *_KEYS, "monto_total")


@register
def fact_unresolved(spark, sf_dir):
    return facts.unresolved(_keyed(spark, sf_dir))


@register
def fact_insert_new(spark, sf_dir):
    """Rows to add and rows skipped when the first file is already in the fact."""
    flagged = materialise(cleaning.with_loaded(facts.resolved(_keyed(spark, sf_dir)), _loaded_ids(_raw(spark, sf_dir))))
    new, known = flagged.where(~F.col("_loaded")), flagged.where("_loaded")
    rows = facts.fact_rows(new, "b9", F.lit("2024-01-01").cast("timestamp")).select(
        "id_venta", "fecha_key", "monto_total", "descuento", "impuestos", "monto_neto", "id_batch")
    skipped = known.select("id_venta", F.lit(None).cast("int").alias("fecha_key"), "monto_total",
                           F.lit(0).alias("descuento"), F.lit(0).alias("impuestos"),
                           F.lit(0).alias("monto_neto"), F.lit("omitida").alias("id_batch"))
    return rows.unionByName(skipped)


@register
def fact_insert_indexed(spark, sf_dir):
    """The same as ``fact_insert_new``, with the stored keys looked up in their index."""
    keyed = materialise(facts.resolved(_keyed(spark, sf_dir)))
    index = materialise(key_index.key_bitmaps(_loaded_ids(_raw(spark, sf_dir)), scattered=True))
    new, known = facts.insert_new(materialise(key_index.known_keys(index, keyed)), keyed)
    rows = facts.fact_rows(new, "b9", F.lit("2024-01-01").cast("timestamp")).select(
        "id_venta", "fecha_key", "monto_total", "descuento", "impuestos", "monto_neto", "id_batch")
    zero = F.lit(0)
    return rows.unionByName(known.select(
        "id_venta", F.lit(None).cast("int").alias("fecha_key"), "monto_total", zero.alias("descuento"),
        zero.alias("impuestos"), zero.alias("monto_neto"), F.lit("omitida").alias("id_batch")))


# ---- reconciliation -----------------------------------------------------------

@register
def batch_summary(spark, sf_dir):
    return reconcile.batch_summary(order_star(spark, sf_dir).totals())


def _loaded_fact(spark, sf_dir):
    keyed = facts.resolved(_keyed(spark, sf_dir))
    return keyed.select("id_venta", "monto_total", F.col("fecha").alias("fecha_venta"), "id_batch",
                        F.col("fecha").cast("timestamp").alias("fecha_carga"))


@register
def stage_vs_fact(spark, sf_dir):
    return reconcile.stage_vs_fact(cleaning.clean(_raw(spark, sf_dir))[0], _loaded_fact(spark, sf_dir))


@register
def list_batches(spark, sf_dir):
    return reconcile.list_batches(_loaded_fact(spark, sf_dir))


@register
def orphans(spark, sf_dir):
    star = order_star(spark, sf_dir)
    return reconcile.orphans(star.fact, {
        "dim_fecha": star.fecha.where(F.col("fecha") < date(2001, 1, 1)),
        "dim_cliente": star.cliente.where("es_registro_actual"),
        "dim_producto": star.producto.where("categoria <> 'PROMO'"),
        "dim_vendedor": star.vendedor.where("nombre_vendedor <> 'SIN_ASIGNAR'"),
        "dim_canal": star.canal, "dim_ciudad": star.ciudad.where("region <> 'ASIA'")})


@register
def duplicates_raw(spark, sf_dir):
    return reconcile.duplicates_raw(_raw(spark, sf_dir))


@register
def duplicates_incremental(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    first = cleaning.clean(_first_load(raw))[0].withColumn("fecha_carga", F.col("fecha").cast("timestamp"))
    return reconcile.duplicates_incremental(cleaning.clean(_second_load(raw))[0], first)


@register
def amount_mismatch(spark, sf_dir):
    return reconcile.amount_mismatch(order_star(spark, sf_dir).sales())


@register
def staging_footprint(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    clean = cleaning.clean(raw)[0].withColumn("fecha_procesamiento", F.col("fecha").cast("timestamp"))
    return reconcile.staging_footprint(raw, clean)


@register
def latest_quality(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    stamp = lambda log, text: log.withColumn("fecha_validacion", F.lit(text).cast("timestamp"))
    return reconcile.latest_quality(
        stamp(quality.quality_log(raw), "2024-02-02").unionByName(stamp(quality.profile_log(raw), "2024-02-01")))


@register
def expired_rows(spark, sf_dir):
    return reconcile.expired(_raw(spark, sf_dir), "fecha_carga", 365, datetime(2026, 6, 1)).groupBy("id_batch").agg(
        F.count(F.lit(1)).alias("vencidas"), F.max("fecha_carga").alias("ultima"))


# ---- measures --------------------------------------------------------------------

def _sales_by_place(spark, sf_dir):
    star = order_star(spark, sf_dir)
    cities = star.lookup("ciudad").select("ciudad_key", F.col("nombre_ciudad").alias("ciudad_venta"),
                                          F.col("region").alias("region_ciudad"))
    return star.totals("ciudad").join(cities, "ciudad_key")


@register
def base_measures(spark, sf_dir):
    sales = _sales_by_place(spark, sf_dir).withColumn("anio", F.year("fecha_venta"))
    return measures.base_measures(sales, ["region_ciudad", "anio"])


@register
def mom(spark, sf_dir):
    return measures.month_over_month(_sales_by_place(spark, sf_dir), ["ciudad_venta"])


@register
def yoy(spark, sf_dir):
    return measures.year_over_year(_sales_by_place(spark, sf_dir), ["ciudad_venta"])


@register
def ytd(spark, sf_dir):
    return measures.year_to_date(_sales_by_place(spark, sf_dir), ["ciudad_venta"])


@register
def shares(spark, sf_dir):
    sales = _sales_by_place(spark, sf_dir)
    return measures.shares(sales, sales.where("region_ciudad in ('ASIA', 'EUROPE')"), ["ciudad_venta"])


@register
def dense_ranks(spark, sf_dir):
    star = order_star(spark, sf_dir)
    # products and sellers from one reading of the line items, without the orders
    lines = materialise(star.lines().groupingSets([["producto_key"], ["vendedor_key"]], "producto_key", "vendedor_key").agg(
        F.sum("monto_total").alias("monto_total"), F.sum("cantidad").alias("cantidad")))
    def ranked(fact, dim, name, value, label):
        key = f"{dim}_key"
        sums = fact.groupBy(key).agg(F.sum(value).alias("valor")).join(
            star.lookup(dim).select(key, name), key).groupBy(name).agg(F.sum("valor").alias("valor"))
        out = measures.dense_ranks(sums, "valor", "ranking", star.bound(dim))
        return out.select(F.lit(label).alias("medida"), F.col(name).alias("miembro"),
                          F.col("valor").cast("double").alias("valor"), "ranking")
    return (ranked(star.totals("ciudad"), "ciudad", "nombre_ciudad", "monto_total", "ciudad")
            .unionByName(ranked(lines, "vendedor", "nombre_vendedor", "monto_total", "vendedor"))
            .unionByName(ranked(lines, "producto", "nombre_producto", "monto_total", "producto_monto"))
            .unionByName(ranked(lines, "producto", "nombre_producto", "cantidad", "producto_unidades")))


@register
def kpi_light(spark, sf_dir):
    star = order_star(spark, sf_dir)
    by_calendar = measures.kpi_light(star.totals(), star.fecha).withColumn("base", F.lit("calendar"))
    active = measures.kpi_light(star.totals(), star.fecha, months="active").withColumn("base", F.lit("active"))
    return by_calendar.unionByName(active)


@register
def daily_average(spark, sf_dir):
    return measures.daily_average(_sales_by_place(spark, sf_dir), ["region_ciudad"])


@register
def max_month(spark, sf_dir):
    return measures.max_month(_sales_by_place(spark, sf_dir), ["ciudad_venta"])


@register
def seller_own_sales(spark, sf_dir):
    star = order_star(spark, sf_dir)
    return measures.seller_sales(access.seller_rows(star.sales(), star.vendedor, "v7@ventas.test", star.bound("vendedor")))


# ---- privacy and access --------------------------------------------------------

@register
def masked_customers(spark, sf_dir):
    c = order_star(spark, sf_dir).cliente
    dev = privacy.customers_for_development(c).select("cliente_key", F.col("email_cliente").alias("email_dev"),
                                                      F.col("telefono_cliente").alias("telefono_dev"))
    rep = privacy.customers_for_reports(c).select("cliente_key", F.col("email_cliente").alias("email_rep"),
                                                  F.col("telefono_cliente").alias("telefono_rep"))
    names = c.select("cliente_key", masking.mask_email(F.col("email_cliente")).alias("email_mask"),
                     masking.mask_name(F.col("ciudad")).alias("nombre_mask"))
    return names.join(dev, "cliente_key").join(rep, "cliente_key")


@register
def pseudonyms(spark, sf_dir):
    return privacy.pseudonymise(order_star(spark, sf_dir).cliente, ["email_cliente"], "sal-de-prueba").select(
        "id_cliente", "email_cliente")


@register
def anonymised_sales(spark, sf_dir):
    return privacy.anonymise_sales(cleaning.clean(_raw(spark, sf_dir))[0]).select(
        "id_venta", "id_cliente", "vendedor", "email_cliente", "telefono_cliente", "monto_total")


@register
def anonymised_raw(spark, sf_dir):
    raw = privacy.anonymise_sales(_raw(spark, sf_dir))
    return raw.groupBy("id_cliente", "email_cliente", "telefono_cliente").agg(F.count(F.lit(1)).alias("filas"))


@register
def report_sales(spark, sf_dir):
    rows = privacy.clean_for_reports(cleaning.clean(_raw(spark, sf_dir))[0])
    return rows.groupBy("email_cliente", "telefono_cliente").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("monto_total").alias("monto_total"))


def _requests(spark, sf_dir):
    return _table(spark, sf_dir, "customer").where("c_acctbal < -900").select(F.col("c_custkey").alias("id_cliente"))


@register
def erased_customers(spark, sf_dir):
    return privacy.erase(_merged_history(spark, sf_dir), _requests(spark, sf_dir)).select(
        "cliente_key", "id_cliente", "email_cliente", "telefono_cliente", "ciudad")


@register
def portability_report(spark, sf_dir):
    star = order_star(spark, sf_dir)
    return privacy.portability(_requests(spark, sf_dir), star.cliente, star.fact, star.canal, star.ciudad).select(
        "id_cliente", "campo", "valor", "tabla_origen")


@register
def seller_rows(spark, sf_dir):
    star = order_star(spark, sf_dir)
    return access.rows_for("seller", star.sales(), star.vendedor, "v3@ventas.test", star.bound("vendedor")).select(
        "id_venta", "vendedor_key", "monto_total")


@register
def region_rows(spark, sf_dir):
    star = order_star(spark, sf_dir)
    mine = access.rows_for("report", star.sales(), star.vendedor, "v1@ventas.test", star.bound("vendedor"))
    nobody = access.rows_for("report", star.sales(), star.vendedor, "nadie@ventas.test", star.bound("vendedor"))
    return mine.unionByName(nobody).groupBy("vendedor_key").agg(
        F.count(F.lit(1)).alias("ventas"), F.sum("monto_total").alias("monto_total"))


USERS = [("v3@ventas.test", "seller"), ("v1@ventas.test", "report"), ("v2@ventas.test", "manager"), ("jefe@ventas.test", "admin"),
         ("nadie@ventas.test", "report"), ("nadie@ventas.test", "seller"), ("v4@ventas.test", "otro")]


@register
def policy_rows(spark, sf_dir):
    """What each of several users sees, from one scan: by seller, with the policy in a table."""
    star = order_star(spark, sf_dir)
    users = spark.createDataFrame(USERS, "usuario string, rol string")
    seen = access.rows_of_users(star.lines(), star.vendedor, users, access.row_policy(spark), star.bound("vendedor"))
    return seen.groupBy("usuario", "rol", "vendedor_key").agg(F.count(F.lit(1)).alias("ventas"), F.sum("monto_total").alias("monto_total"))


@register
def policy_columns(spark, sf_dir):
    """Personal columns of all customers as each role sees them, from one plan."""
    customers = order_star(spark, sf_dir).cliente.select("id_cliente", "email_cliente", "telefono_cliente")
    roles = F.explode(F.array(*[F.lit(r) for r in ("admin", "report", "seller", "otro")]))
    return access.mask_by_role(customers.select(roles.alias("rol"), "*"), access.column_policy(spark))


@register
def role_columns(spark, sf_dir):
    c = order_star(spark, sf_dir).cliente.select("id_cliente", "email_cliente", "telefono_cliente")
    seller = access.columns_for("seller", c).select("id_cliente")
    report = access.columns_for("report", c)
    etl = access.columns_for("etl", c).select("id_cliente", F.col("email_cliente").alias("email_etl"))
    return seller.join(report, "id_cliente").join(etl, "id_cliente")


@register
def access_log(spark, sf_dir):
    """One audit row per erased customer with the versions that were changed."""
    merged = _merged_history(spark, sf_dir)
    hit = merged.join(_requests(spark, sf_dir), "id_cliente", "left_semi")
    counts = hit.groupBy(F.col("id_cliente").alias("_id")).agg(F.count(F.lit(1)).alias("n"))
    return access.access_entries(counts, "etl", "DERECHO_AL_OLVIDO_COMPLETADO", "DELETE", datetime(2026, 3, 1)).drop("fecha_hora")


# ---- increments, streams, whole jobs ------------------------------------------

@register
def watermark_increment(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    loaded = events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return read_after(events, "ts", loaded).select("event_id", "user_id", "event_type", "value")


def _event_stream(spark, sf_dir):
    schema = _table(spark, sf_dir, "events").schema
    return file_stream(spark, sf_dir, schema, pattern="events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@register
def stream_ingest(spark, sf_dir):
    """All events through a stream into a batch table, drained twice without duplicates."""
    root = scratch_path(spark, "stream-ingest")
    store = Store(spark, root)
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, id_batch string"
    def stored():
        return store.read("events", schema)
    for _ in range(2):
        stream = dedupe_late(_event_stream(spark, sf_dir), "event_id", "ts", "1 hour").select(
            "event_id", "ts", "user_id", "event_type", "value")
        ingest(stream, store, "events", f"{root}/checkpoint", new_only(stored, "event_id"))
    return stored().select("event_id", "user_id", "event_type", "value")


@register
def stream_daily(spark, sf_dir):
    root = scratch_path(spark, "stream-daily")
    for _ in range(2):  # the second drain finds nothing new
        write_updated(daily_totals(_event_stream(spark, sf_dir), "ts", ["event_type"], "value", "1 day"),
                      ["event_type"], f"{root}/out", f"{root}/checkpoint")
    return with_final(spark.read.parquet(f"{root}/out"), "1 day").select(
        "dia", "event_type", "filas", F.round("total", 4).alias("total"), "final")


@register
def stream_quality(spark, sf_dir):
    """Quality of all raw sales by the day they came, as a stream; the second drain finds nothing new."""
    root = scratch_path(spark, "stream-quality")
    for _ in range(2):
        lines = file_stream(spark, sf_dir, TABLE_SCHEMAS["lineitem"], pattern="lineitem.parquet")
        raw = lines.selectExpr(*[f"{sql} AS {name}" for name, sql in RAW_EXPRESSIONS.items()])
        write_updated(daily_quality(raw, "fecha_carga", "1 day"), ["dia"], f"{root}/out", f"{root}/checkpoint", folder="mes")
    return quality_by_day(spark.read.parquet(f"{root}/out"))


@register
def customers_by_span(spark, sf_dir):
    """Distinct customers per region and quarter or year, merged from stored months."""
    star = order_star(spark, sf_dir)
    sales = star.totals("ciudad").join(star.lookup("ciudad").select("ciudad_key", "region"), "ciudad_key")
    months = materialise(measures.distinct_by_month(sales, ["region"]))
    return measures.distinct_over(months, ["region"], "quarter").withColumn("tramo", F.lit("trimestre")).unionByName(
        measures.distinct_over(months, ["region"], "year").withColumn("tramo", F.lit("año")))


def _loaded(spark, sf_dir):
    """A warehouse with both files loaded as batches; built once per session, read by several queries."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _LOADED:
        house = Warehouse(spark, scratch_path(spark, "house"))
        house.seed()
        raw = _raw(spark, sf_dir)
        rows = lambda part: part.select(*BUSINESS_COLUMNS, "archivo_origen", "row_seq")
        options = {"threshold": 0.5, "retention": {}}
        house.run(rows(_first_load(raw)), "initial", "b1", datetime(2026, 3, 1), **options)
        house.run(rows(_second_load(raw)), "incremental", "b2", datetime(2026, 3, 2), **options)
        _LOADED[known] = house.store.root
    return Warehouse(spark, _LOADED[known])


_LOADED: dict[tuple[str, str], str] = {}


def _copy_of(house):
    """A copy of a warehouse that a query may change. Tasks copy the files; only their names pass the driver.

    Rows are never changed inside a file: where the file system has hard links, the copies of Parquet files are links.
    """
    target = scratch_path(house.spark, "copy")
    files, source = house.store._path(house.store.root)
    source, to = (str(files.makeQualified(p).toString()) for p in (source, house.store._path(target)[1]))
    names, found = [], files.listFiles(house.store._path(source)[1], True)
    while found.hasNext():
        names.append((found.next().getPath().toString()[len(source) + 1:],))

    def link(old, new):
        import contextlib
        import os
        with contextlib.suppress(FileNotFoundError):
            os.unlink(new)  # left by an attempt before: to write into a link would change the source
        try:
            os.link(old, new)
        except OSError:  # no links here, or not between these folders
            return False
        return True

    def copy(batches):
        from pyarrow import fs
        (old, here), (new, there) = fs.FileSystem.from_uri(source), fs.FileSystem.from_uri(to)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                new.create_dir(f"{there}/{name}".rsplit("/", 1)[0], recursive=True)
                local = isinstance(old, fs.LocalFileSystem) and isinstance(new, fs.LocalFileSystem)
                if local and name.endswith(".parquet") and link(f"{here}/{name}", f"{there}/{name}"):
                    continue
                with (old.open_input_stream(f"{here}/{name}", compression=None) as data,
                      new.open_output_stream(f"{there}/{name}", compression=None) as out):
                    while part := data.read(1 << 23):
                        out.write(part)
            yield batch

    listed = house.spark.createDataFrame(names, "name string").repartition(min(len(names), 64))
    listed.mapInArrow(copy, "name string").write.format("noop").mode("overwrite").save()
    return Warehouse(house.spark, target)


def _written(house, rows):
    """A few rows read from a warehouse that only this query has, written down; the warehouse goes."""
    rows = materialise(rows)
    house.remove()
    return rows


@register
def warehouse_city_analysis(spark, sf_dir):
    """The city analysis over the loaded warehouse."""
    return analytics.city_analysis(_loaded(spark, sf_dir).star()).select(
        "ranking_nacional", "nombre_ciudad", "total_transacciones", "monto_total", "unidades_vendidas")


@register
def warehouse_seller_rows(spark, sf_dir):
    """Row filters on the loaded warehouse after sellers were given e-mails and regions."""
    house = _copy_of(_loaded(spark, sf_dir))
    sellers = house.members("dim_vendedor").where("nombre_vendedor like 'Vendedor %'")
    number = F.split_part("nombre_vendedor", F.lit(" "), F.lit(2))
    house.update_members("dim_vendedor", sellers.select(
        "nombre_vendedor", F.concat(F.lit("v"), number, F.lit("@ventas.test")).alias("email_vendedor"),
        F.when(number.cast("int") % 2 == 0, "Par").otherwise("Impar").alias("region")), "m1")
    star = house.star()
    def seen(role, user):
        rows = access.rows_for(role, star.fact, star.vendedor, user).groupBy("vendedor_key").agg(
            F.count(F.lit(1)).alias("ventas"), F.sum("monto_total").alias("monto_total"))
        return rows.join(star.vendedor.select("vendedor_key", "nombre_vendedor"), "vendedor_key").select(
            F.lit(role).alias("rol"), "nombre_vendedor", "ventas", "monto_total")
    out = seen("seller", "v3@ventas.test").unionByName(seen("report", "v4@ventas.test")).unionByName(seen("admin", "x"))
    return _written(house, out)


@register
def run_log_state(spark, sf_dir):
    """Rows of the run log per batch and state, after a third attempt that failed."""
    house = _copy_of(_loaded(spark, sf_dir))
    bad = _second_load(_raw(spark, sf_dir)).where("fecha = ''").select(*BUSINESS_COLUMNS, "archivo_origen", "row_seq")
    for _ in range(2):
        try:
            house.run(bad, "incremental", "b3", datetime(2026, 3, 3), threshold=0.999, retention={})
        except quality.QualityGateError:
            pass
    return _written(house, house.run_log().groupBy("id_batch", "proceso", "estado").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("registros_procesados").alias("procesados")))


@register
def key_index_state(spark, sf_dir):
    """Keys and buckets that the index of the loaded warehouse has of each batch."""
    index = _loaded(spark, sf_dir).store.read(KEY_INDEX_T, key_index.KEY_INDEX)
    return key_index.keys_in(index).groupBy("id_batch").agg(F.sum("n").alias("llaves"), F.count(F.lit(1)).alias("grupos"),
                                                            F.min("bucket").alias("primero"), F.max("bucket").alias("ultimo"))


@register
def batch_footprint(spark, sf_dir):
    """Rows and age of each stored batch, from the manifests alone."""
    return _loaded(spark, sf_dir).footprint()


@register
def quality_json(spark, sf_dir):
    """The quality log written as JSON lines and read back."""
    path = scratch_path(spark, "quality-json")
    _loaded(spark, sf_dir).export_quality_log(path)
    return spark.read.json(path).groupBy("id_batch").agg(
        F.count(F.lit(1)).alias("reglas"), F.sum("registros_evaluados").alias("evaluados"))


@register
def test_copy(spark, sf_dir):
    """The anonymised copy of the clean sales as it lies on disk."""
    house = _copy_of(_loaded(spark, sf_dir))
    house.write_test_copy()
    return spark.read.parquet(house.store.path("test_data/ventas_anonimo")).select(
        "id_venta", "email_cliente", "telefono_cliente", "monto_total")


@register
def erased_state(spark, sf_dir):
    """Stored e-mails of the requested customers after erasure, by table; and what was logged."""
    house = _copy_of(_loaded(spark, sf_dir))
    house.erase_customers(spark.range(2, 12).withColumnRenamed("id", "id_cliente"), "dpo", datetime(2026, 3, 5))
    number = N.to_integer(F.col("id_cliente").cast("string"))
    out = None
    for name, df in (("raw", house.raw()), ("clean", house.clean())):
        rows = df.where(number.between(2, 11)).groupBy(F.lit(name).alias("tabla"), F.col("email_cliente").alias("valor")).agg(
            F.count(F.lit(1)).alias("filas"))
        out = rows if out is None else out.unionByName(rows)
    left = house.customers().where(F.col("id_cliente").between(2, 11) & ~F.col("email_cliente").endswith("@anonimo.test"))
    log = house.access_log().where("tabla_accedida like '%:id_cliente=%'")
    for name, df in (("clientes con datos", left), ("auditoria", log)):
        out = out.unionByName(df.agg(F.lit(name).alias("tabla"), F.lit("-").alias("valor"), F.count(F.lit(1)).alias("filas")))
    return _written(house, out)


@register
def retention_state(spark, sf_dir):
    """Rows left per staging table after each has outlived its days."""
    house = _copy_of(_loaded(spark, sf_dir))
    from salesmart.plans.batch_load import CLEAN_T, KEYED, KEYED_T, RAW_T, REJECT_T
    from salesmart.schemas import CLEAN, RAW, REJECTED
    tables = {RAW_T: RAW, CLEAN_T: CLEAN, KEYED_T: KEYED, REJECT_T: REJECTED}
    for name, schema in tables.items():
        # b1 is a day older than b2: one second before b2 would go, only b1 does
        stamp, days = RETENTION_DAYS[name]
        house.store.expire(name, schema, stamp, days, datetime(2026, 3, 2) + timedelta(days=days))
    out = None
    for name, schema in tables.items():
        rows = house.store.read(name, schema).groupBy(F.lit(name).alias("tabla"), "id_batch").agg(F.count(F.lit(1)).alias("filas"))
        out = rows if out is None else out.unionByName(rows)
    return _written(house, out)


@register
def csv_roundtrip(spark, sf_dir):
    """Raw sales written as CSV files in two folders and read back with their lineage."""
    root = scratch_path(spark, "csv")
    raw = _raw(spark, sf_dir).select(*BUSINESS_COLUMNS)
    for folder, part in (("a", raw.where("canal = 'Online'")), ("b", raw.where("canal <> 'Online'"))):
        part.write.options(header="true", emptyValue="", ignoreLeadingWhiteSpace="false",
                           ignoreTrailingWhiteSpace="false").csv(f"{root}/{folder}")
    rows = stamp_lineage(read_csv(spark, [f"{root}/a", f"{root}/b"]), "b1", datetime(2026, 3, 1))
    return rows.select("id_venta", "fecha", "id_cliente", "cantidad", "precio_unitario", "vendedor", "canal", "id_batch",
                       (F.col("row_seq").isNotNull() & F.col("archivo_origen").endswith(".csv")).alias("con_origen"))


@register
def run_summary(spark, sf_dir):
    """The report of a run, taken from its return value."""
    house = _copy_of(_loaded(spark, sf_dir))
    rows = _second_load(_raw(spark, sf_dir)).select(*BUSINESS_COLUMNS, "archivo_origen", "row_seq")
    result = house.run(rows, "incremental", "b2", datetime(2026, 3, 2), threshold=0.5, retention={})
    house.remove()
    return summary_of(result, spark).drop("score")


@register
def admin_rows(spark, sf_dir):
    star = order_star(spark, sf_dir)
    return access.rows_for("admin", star.sales(), star.vendedor, "nadie@ventas.test", star.bound("vendedor")).select(
        "id_venta", "vendedor_key", "monto_total")


@register
def profile_report(spark, sf_dir):
    """Rows of each part of the full profile, and a digest of all their values."""
    with scratch_of_job(spark, "profile"):
        # several parts read the rows: they are derived once
        report = profiling.full_report(materialise(_raw(spark, sf_dir).select(*BUSINESS_COLUMNS), compression="zstd"))
        out = None
        for part, values in report.items():
            rows = plain(values).select(_row_digest(plain(values)).alias("h")).agg(
                F.lit(part).alias("parte"), F.count(F.lit(1)).alias("filas"), F.sum("h").alias("huella"))
            out = rows if out is None else out.unionByName(rows)
        return spark.createDataFrame(out.collect(), out.schema)  # a row per part


def _row_digest(df):
    """28 bits of the MD5 of a row's values, by column name; doubles with six places."""
    said = [F.col(name).cast("decimal(30,6)") if kind == "double" else F.col(name) for name, kind in sorted(df.dtypes)]
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("NULL")) for c in said])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint")


def _load_twice(spark, sf_dir):
    """Both files as batches, then the second one again."""
    house = Warehouse(spark, scratch_path(spark, "batch"), last=date(2030, 12, 31))
    house.seed()
    raw = _raw(spark, sf_dir)
    rows = lambda part: part.select(*BUSINESS_COLUMNS, "archivo_origen", "row_seq")
    options = {"threshold": 0.5, "retention": {}}
    house.run(rows(_first_load(raw)), "initial", "b1", datetime(2026, 3, 1), **options)
    house.run(rows(_second_load(raw)), "incremental", "b2", datetime(2026, 3, 2), **options)
    before = _state(house)
    house.run(rows(_second_load(raw)), "incremental", "b2", datetime(2026, 3, 2), **options)
    return house, before


def _state(house):
    """Rows and amount per table and batch, written down before the next run changes them."""
    tables = (house.raw().select(F.lit("raw").alias("tabla"), "id_batch", F.lit(0).cast("decimal(15,2)").alias("m")),
              house.clean().select(F.lit("clean").alias("tabla"), "id_batch", F.col("monto_total").alias("m")),
              house.fact().select(F.lit("fact").alias("tabla"), "id_batch", F.col("monto_total").alias("m")),
              house.customers().select(F.lit("cliente").alias("tabla"), F.col("id_batch_open").alias("id_batch"),
                                       F.lit(0).cast("decimal(15,2)").alias("m")))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return materialise(out.groupBy("tabla", "id_batch").agg(F.count(F.lit(1)).alias("filas"), F.sum("m").alias("monto")))


@register
def batch_rerun(spark, sf_dir):
    """State after two batches and after running the second one again."""
    house, before = _load_twice(spark, sf_dir)
    return _written(house, before.withColumn("corrida", F.lit(1)).unionByName(_state(house).withColumn("corrida", F.lit(2))))


@register
def customer_versions(spark, sf_dir):
    """All customer versions of the loaded warehouse, with their keys, from the buckets and the closed rows."""
    return _loaded(spark, sf_dir).customers().drop("fecha_creacion", "fecha_actualizacion")


@register
def rollback_state(spark, sf_dir):
    """State after the second batch was rolled back."""
    house, _ = _load_twice(spark, sf_dir)
    house.rollback("b2", datetime(2026, 3, 3))
    broken = scd2.broken_history(house.customers()).agg(F.count(F.lit(1)).alias("filas")).select(
        F.lit("historia_rota").alias("tabla"), F.lit("b1").alias("id_batch"), "filas",
        F.lit(0).cast("decimal(25,2)").alias("monto"))
    return _written(house, _state(house).unionByName(broken))
