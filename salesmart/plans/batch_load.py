"""The batch load end to end, its rollback and its privacy jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.functions.normalize import to_integer
from salesmart.operators import access, cleaning, dimensions, facts, key_index, privacy, quality, scd2
from salesmart.operators.calendar import build_calendar
from salesmart.operators.ranking import assign_keys
from salesmart.schemas import (ACCESS_LOG, BUSINESS_COLUMNS, CHANNEL, CITY, CLEAN, CUSTOMER, FACT, KEY_MARK,
                               PREVIOUS, PRODUCT, QUALITY_LOG, RAW, REJECTED, RUN_LOG, SELLER)
from salesmart.session import broadcast_if_small, is_small, materialise, scratch_of_job, scratch_path
from salesmart.sources.csv_files import read_csv, stamp_lineage
from salesmart.sources.seeds import seed_dimensions
from salesmart.sources.star import Star
from salesmart.sources.tables import RETENTION_DAYS, Store

RAW_T, CLEAN_T, KEYED_T = "staging/ventas_raw", "staging/ventas_clean", "staging/ventas_llaves"
FACT_T, KEY_INDEX_T, REJECT_T = "dwh/fact_ventas", "dwh/fact_ventas_llaves", "control/rechazos"
RUN_T, QUALITY_T, ACCESS_T = ("control/etl_execution_log", "control/data_quality_log",
                              "control/auditoria_accesos")
ACTIVE_T, CLOSED_T = "dwh/dim_cliente_actual", "dwh/dim_cliente_cerrado"
PREVIOUS_T, MARK_T = "dwh/dim_cliente_previo", "control/llaves"
# Hash buckets that the active customers of a new warehouse are kept in; a batch rewrites those it touches.
CUSTOMER_BUCKETS = 16
MEMBER_TABLES = {"dim_canal": CHANNEL, "dim_ciudad": CITY, "dim_vendedor": SELLER, "dim_producto": PRODUCT}
# no personal columns: the keys don't need them, and erasure needn't come here
KEYED = (CLEAN.replace(", id_batch string", "").replace(", email_cliente string", "")
         .replace(", telefono_cliente string", "")) + (
    ", fecha_key int, cliente_key bigint, producto_key bigint, vendedor_key bigint, "
    "canal_key bigint, ciudad_key bigint, motivo string, id_batch string")


def _with_batch(schema: str) -> str:
    return schema + ", id_batch string"


@dataclass(frozen=True)
class BatchResult:
    batch_id: str
    mode: str
    extracted: int
    clean: int
    rejected: int
    loaded: int
    skipped: int
    unresolved: int
    score: float


class Warehouse:
    """The tables of one warehouse and the jobs that change them.

    Times and batch ids are arguments, so a repeated run gives the same rows.
    """

    def __init__(self, spark: SparkSession, root: str, first: date = date(2020, 1, 1),
                 last: date = date(2030, 12, 31), customer_buckets: int = CUSTOMER_BUCKETS):
        self.spark, self.store = spark, Store(spark, root, {ACTIVE_T: ("id_cliente", customer_buckets)})
        self.first, self.last = first, last

    # -- tables ----------------------------------------------------------------

    def seed(self) -> None:
        """Starting members of the dimensions; running it again adds nothing."""
        for name, rows in seed_dimensions(self.spark).items():
            natural = rows.columns[1]
            self.store.append_batch(f"dwh/{name}", dimensions.absent(rows, self.members(name), natural)
                                    .coalesce(1), "seed")

    def remove(self) -> None:
        """Delete the warehouse with all its tables."""
        self.store.remove()

    def members(self, name: str) -> DataFrame:
        return self.store.read(f"dwh/{name}", _with_batch(MEMBER_TABLES[name])).drop("id_batch")

    def active(self, buckets: list[int] | None = None) -> DataFrame:
        """Current customer versions, all or those of some buckets."""
        return self.store.read_snapshot(ACTIVE_T, CUSTOMER, buckets=buckets)

    def customers(self) -> DataFrame:
        active = self.active()
        closed = self.store.read(CLOSED_T, _with_batch(CUSTOMER)).drop("id_batch")
        return active.unionByName(closed)

    def calendar(self) -> DataFrame:
        return build_calendar(self.spark, self.first, self.last)

    def dims(self) -> dict[str, DataFrame]:
        out = {name: self.members(name) for name in MEMBER_TABLES}
        out["dim_cliente"] = self.active()
        out["dim_fecha"] = self.calendar()
        return out

    def star(self) -> Star:
        """The loaded warehouse as the star that the analytical queries and measures take."""
        dims = {name.removeprefix("dim_"): self.members(name) for name in MEMBER_TABLES}
        return Star(fact=self.fact(), cliente=self.customers(), fecha=self.calendar(), **dims)

    def fact(self) -> DataFrame:
        return self.store.read(FACT_T, FACT)

    def raw(self) -> DataFrame:
        return self.store.read(RAW_T, RAW)

    def clean(self) -> DataFrame:
        return self.store.read(CLEAN_T, CLEAN)

    def run_log(self) -> DataFrame:
        return self.store.read(RUN_T, RUN_LOG)

    def quality_log(self) -> DataFrame:
        return self.store.read(QUALITY_T, QUALITY_LOG)

    # -- the load --------------------------------------------------------------

    def run_csv(self, path, mode: str, batch_id: str, now: datetime, **options) -> BatchResult:
        """Load a CSV file or folder; see ``run``."""
        return self.run(read_csv(self.spark, path), mode, batch_id, now, **options)

    def run(self, rows: DataFrame, mode: str, batch_id: str, now: datetime, *,
            threshold: float = quality.STOP_BELOW, strict: bool = False,
            by_date: bool = False, retention: dict | None = None) -> BatchResult:
        """One batch: stage, validate, clean, dimensions, fact, retention.

        Every step reads what the step before stored. ``incremental`` skips
        sales that other batches loaded; ``by_date`` looks customers up by
        the day of the sale.
        """
        if mode not in ("initial", "incremental"):
            raise ValueError("mode must be initial or incremental")
        log: list[tuple] = []
        step = "extract"
        # stays behind if the driver dies; the end of this attempt replaces it
        self._write_log([(step, now, None, "INICIADO", 0, 0, 0, None, batch_id)], batch_id, now)
        try:
            with scratch_of_job(self.spark, "load") as scratch:
                extracted = self.store.overwrite_batch(RAW_T, stamp_lineage(rows, batch_id, now).select(
                    *BUSINESS_COLUMNS, "fecha_carga", "archivo_origen", "row_seq"), batch_id)["filas"]
                raw = self.store.read_batch(RAW_T, RAW, batch_id)
                self._log(log, step, now, extracted, extracted, 0, batch_id)

                step = "validate"
                loaded = None
                if mode == "incremental":  # looked up once, for the rule and for the cleaning
                    # parsed once: the search reads its keys several times
                    ids = materialise(raw.select(to_integer(F.col("id_venta")).alias("id_venta")))
                    loaded = materialise(self.stored_keys(ids, batch_id))
                    scratch.drop(ids)
                score = self._validate(raw, loaded, batch_id, now)
                quality.check_gate(score, threshold)
                self._log(log, step, now, extracted, extracted, 0, batch_id)

                step = "clean"
                # judged once and written down: both tables are cut from the same rows
                stamp = F.lit(now).cast("timestamp")
                judged = materialise(cleaning.to_split(cleaning.outcome(raw.drop("id_batch"), loaded, strict)), compression="zstd")
                good, rejected = cleaning.split(judged)
                n_clean = self.store.overwrite_batch(CLEAN_T, good.withColumn("fecha_procesamiento", stamp), batch_id)["filas"]
                n_rejected = self.store.overwrite_batch(REJECT_T, rejected.withColumn("fecha_rechazo", stamp), batch_id)["filas"]
                scratch.drop(judged)
                clean = self.store.read_batch(CLEAN_T, CLEAN, batch_id)
                self._log(log, step, now, extracted, n_clean, n_rejected, batch_id)

                step = "dimensions"
                keys = self._reserve(batch_id, n_clean)
                self._load_dimensions(clean, batch_id, now, keys)
                self._log(log, step, now, n_clean, n_clean, 0, batch_id)

                step = "fact"
                n_fact, n_skipped, n_lost = self._load_fact(clean, batch_id, now, by_date, keys)
                self._log(log, step, now, n_fact + n_lost + n_skipped, n_fact, n_lost, batch_id)

                step = "cleanup"
                for name, (stamp, days) in (RETENTION_DAYS if retention is None else retention).items():
                    schema = {RAW_T: RAW, CLEAN_T: CLEAN, QUALITY_T: QUALITY_LOG, RUN_T: RUN_LOG,
                              KEYED_T: KEYED, REJECT_T: REJECTED}[name]
                    self.store.expire(name, schema, stamp, days, now)
                self._log(log, step, now, 0, 0, 0, batch_id)
        except Exception as error:
            self._log(log, step, now, 0, 0, 0, batch_id, "FALLIDO", str(error))
            raise
        finally:
            self._write_log(log, batch_id, now)
        return BatchResult(batch_id, mode, extracted, n_clean, n_rejected, n_fact, n_skipped, n_lost, score)

    def _write_log(self, rows: list[tuple], batch_id: str, attempt: datetime | None = None) -> None:
        """Add the rows of an attempt to the batch's log, in place of its start; without one, replace the log."""
        kept = []
        if attempt is not None:  # a few rows per attempt
            kept = [tuple(r) for r in self.store.read_batch(RUN_T, RUN_LOG, batch_id).collect()
                    if not (r.estado == "INICIADO" and r.fecha_inicio == attempt)]
        log = self.spark.createDataFrame([*kept, *rows], RUN_LOG)
        self.store.overwrite_batch(RUN_T, log.coalesce(1), batch_id)

    def _log(self, log, step, now, seen, good, bad, batch_id, state=None, error=None):
        state = state or ("PARCIAL" if step == "fact" and bad else "EXITOSO")
        log.append((step, now, now, state, seen, good, bad, error, batch_id))

    def footprint(self) -> DataFrame:
        """Rows and age of every batch of the staging tables and the fact, from their manifests."""
        return self.store.footprint({RAW_T: (RAW, "fecha_carga"), CLEAN_T: (CLEAN, "fecha_procesamiento"),
                                     KEYED_T: (KEYED, "fecha_procesamiento"), FACT_T: (FACT, "fecha_carga")})

    def _validate(self, raw, loaded, batch_id, now) -> float:
        log = quality.quality_log(raw, loaded)
        self.store.overwrite_batch(QUALITY_T, log.select(
            F.lit("staging.ventas_raw").alias("tabla_origen"), "regla_calidad",
            F.lit(now).cast("timestamp").alias("fecha_validacion"), "registros_evaluados",
            "registros_validos", "registros_invalidos", "porcentaje_calidad", "detalles").coalesce(1), batch_id)
        stored = self.store.read_batch(QUALITY_T, QUALITY_LOG, batch_id)
        return float(quality.score_mean_of_rules(stored).first().score)

    def _reserve(self, batch_id: str, rows: int) -> dict[str, int]:
        """The key above which a batch of ``rows`` sales may number, by table.

        A batch keeps what it once reserved, so that a rerun gives the same
        keys. Marks are never lowered, so no key is given twice, also after a
        rollback. Without any mark the highest keys in use are where to start.
        """
        mine = F.col("id_batch") == batch_id
        marks = {r.tabla: r for r in self.store.read(MARK_T, KEY_MARK).groupBy("tabla").agg(
            F.max("hasta").alias("hasta"), F.max(F.when(mine, F.col("desde"))).alias("desde"),
            F.max(F.when(mine, F.col("hasta"))).alias("propio")).collect()}  # a row per table
        tables = {"fact_ventas": lambda: self.fact().agg(F.max("venta_key")),
                  "dim_cliente": lambda: self.customers().agg(F.max("cliente_key"))}
        for name in MEMBER_TABLES:
            key = name.removeprefix("dim_") + "_key"
            tables[name] = lambda name=name, key=key: self.members(name).agg(F.max(key))
        out = {}
        for name, highest in tables.items():
            mark = marks.get(name)
            if mark is not None and mark.desde is not None and mark.propio - mark.desde >= rows:
                out[name] = (mark.desde, mark.propio)
            else:
                top = mark.hasta if mark is not None else highest().first()[0] or 0
                out[name] = (top, top + rows)
        if any(name not in marks or marks[name].desde != low for name, (low, _) in out.items()):
            self.store.overwrite_batch(MARK_T, self.spark.createDataFrame(
                [(name, low, high, batch_id) for name, (low, high) in out.items()], KEY_MARK).coalesce(1), batch_id)
        return {name: low for name, (low, _) in out.items()}

    def _load_dimensions(self, clean: DataFrame, batch_id: str, now: datetime, keys: dict[str, int]) -> None:
        makers = {"dim_canal": dimensions.new_channels, "dim_ciudad": dimensions.new_cities,
                  "dim_vendedor": dimensions.new_sellers, "dim_producto": dimensions.new_products}
        names = materialise(dimensions.member_names(clean))
        for (name, maker), column in zip(makers.items(), dimensions.MEMBER_COLUMNS, strict=True):
            new = materialise(maker(self.members(name), dimensions.names_of(names, column), keys[name]))
            if new.isEmpty():
                continue
            missing = [F.lit(None).cast(kind).alias(c) for c, kind in
                       (field.strip().split(" ") for field in _fields(MEMBER_TABLES[name])) if c not in new.columns]
            self.store.append_batch(f"dwh/{name}", new.select("*", *missing), batch_id)

        self._load_customers(materialise(scd2.latest_attributes(clean)), batch_id, now, keys["dim_cliente"])

    def _load_customers(self, incoming: DataFrame, batch_id: str, now: datetime, start: int) -> None:
        """Merge attributes into the customer history; reads and writes only the buckets where something is new."""
        stamp = F.lit(now).cast("timestamp")
        incoming = materialise(scd2.news(self.active(self.store.buckets_of(ACTIVE_T, incoming)), incoming))
        touched = self.store.buckets_of(ACTIVE_T, incoming)
        if not touched:
            return
        active = self.active(touched)
        edited = scd2.edited_in_place(active, incoming, now.date(), stamp)
        known = self.store.read_batch(PREVIOUS_T, PREVIOUS, batch_id)
        edited = materialise(edited.join(known.select("cliente_key"), "cliente_key", "left_anti"))
        if not edited.isEmpty():  # before the edit itself: what is replaced is on record first
            self.store.append_batch(PREVIOUS_T, edited, batch_id)
        merged = materialise(scd2.scd2_merge(active, incoming, now.date(), batch_id, stamp, start=start))
        just_closed = merged.where(~F.col("es_registro_actual") & (F.col("id_batch_close") == batch_id))
        known = self.store.read_batch(CLOSED_T, _with_batch(CUSTOMER), batch_id)
        # closed rows first: a run cut off in between is repaired by running the batch again
        self.store.append_batch(CLOSED_T, just_closed.join(known.select("cliente_key"), "cliente_key", "left_anti"),
                                batch_id)
        self.store.write_buckets(ACTIVE_T, merged.where("es_registro_actual"), touched)

    def _load_fact(self, clean, batch_id, now, by_date, keys) -> tuple[int, int, int]:
        dims = self.dims()
        if by_date:
            dims["dim_cliente"] = self.customers()
        keyed = facts.resolve_keys(clean, dims, by_date)
        names = [field.strip().split(" ")[0] for field in _fields(KEYED)]
        seen = self.store.overwrite_batch(KEYED_T, keyed.select(*names), batch_id, {"perdidas": F.count("motivo")})
        keyed = self.store.read_batch(KEYED_T, KEYED, batch_id)
        # written down, its size is known: where few keys are stored, no row of the batch is shuffled to meet them
        stored = materialise(self.stored_keys(keyed, batch_id))
        new, _ = facts.insert_new(stored, facts.resolved(keyed).select(*facts.FACT_INPUT))
        # numbered in the order of sale ids: same keys on a rerun, and sorted files, whose
        # statistics let the search for stored keys skip row groups
        numbered = assign_keys(new, ["id_venta"], "venta_key", keys["fact_ventas"],
                               bound=keyed if is_small(keyed) else None)
        # the index of what is being replaced goes first: a batch without one is indexed when it is asked for
        self.store.drop_batch(KEY_INDEX_T, batch_id)
        loaded = self.store.overwrite_batch(FACT_T, facts.fact_rows(
            numbered, batch_id, F.lit(now).cast("timestamp")), batch_id)["filas"]
        self._index(batch_id)
        return loaded, seen["filas"] - loaded - seen["perdidas"], seen["perdidas"]

    def _index(self, batch_id: str) -> None:
        keys = key_index.key_bitmaps(self.store.read_batch(FACT_T, FACT, batch_id))
        self.store.overwrite_batch(KEY_INDEX_T, keys.sortWithinPartitions("bucket"), batch_id)

    def stored_keys(self, wanted: DataFrame, batch_id: str) -> DataFrame:
        """Sale ids of ``wanted`` that batches other than ``batch_id`` have stored, found in the key index."""
        for other in sorted(set(self.store.batches(FACT_T)) - set(self.store.batches(KEY_INDEX_T)) - {batch_id}):
            self._index(other)
        return key_index.known_keys(self.store.read_other(KEY_INDEX_T, key_index.KEY_INDEX, batch_id), wanted)

    # -- operations ------------------------------------------------------------

    def update_members(self, name: str, incoming: DataFrame, batch_id: str) -> None:
        """Overwrite attributes of dimension members where ``incoming`` gives them, and add unknown members.

        ``incoming`` has the natural key and any of the dimension's attributes,
        such as the e-mail and region of sellers. Keys stay; new ones come
        from what the batch reserves. Only batches with a changed member are rewritten.
        """
        schema = _with_batch(MEMBER_TABLES[name])
        stored = self.store.read(f"dwh/{name}", schema)
        key, natural = stored.columns[:2]
        given = materialise(incoming)
        start = self._reserve(batch_id, given.count())[name]
        after = dimensions.overwrite_changed(stored.drop("id_batch"), given, natural, key, start=start)
        old = stored.select(F.col(key).alias("_key"), F.col("id_batch").alias("_batch"))
        after = after.join(old, F.col(key) == F.col("_key"), "left").withColumn(
            "id_batch", F.coalesce("_batch", F.lit(batch_id))).select(*stored.columns)
        touched = after.join(given.select(natural), natural, "left_semi").select("id_batch").distinct()
        after = after.join(touched, "id_batch", "left_semi").select(*stored.columns)
        scratch = scratch_path(self.spark, "members")
        try:  # the folders being replaced are also being read
            after.write.parquet(scratch)
            self.store.rewrite_batches(f"dwh/{name}", self.spark.read.schema(schema).parquet(scratch))
        finally:
            self.store._drop(scratch)

    def rollback(self, batch_id: str, now: datetime) -> None:
        """Undo a batch: facts, customer versions, edits in place, staging; the run log says so.

        Refused when a later batch has sold to, closed or edited a customer
        version that this batch opened or edited: undo that batch first. May
        be repeated after it was cut off.
        """
        self._refuse_if_built_on(batch_id)
        stamp = F.lit(now).cast("timestamp")
        previous = self.store.read_batch(PREVIOUS_T, PREVIOUS, batch_id)
        closed = self.store.read_batch(CLOSED_T, _with_batch(CUSTOMER), batch_id).drop("id_batch")
        opened = self.active().where(F.col("id_batch_open") == batch_id)
        concerned = opened.select("id_cliente").unionByName(closed.select("id_cliente")).unionByName(previous.select("id_cliente"))
        touched = self.store.buckets_of(ACTIVE_T, concerned)
        restored = scd2.undo_batch(self.active(touched).unionByName(closed), batch_id, stamp, previous)
        for name in (KEY_INDEX_T, FACT_T):
            self.store.drop_batch(name, batch_id)
        self.store.write_buckets(ACTIVE_T, restored.where("es_registro_actual"), touched)
        for name in (CLOSED_T, PREVIOUS_T, RAW_T, CLEAN_T, KEYED_T, REJECT_T):
            self.store.drop_batch(name, batch_id)
        if batch_id in self.store.batches(RUN_T):
            log = self.store.read_batch(RUN_T, RUN_LOG, batch_id).collect()  # a few rows per batch
            marked = [(*row[:3], "REVERTIDO", *row[4:7], "Rollback manual ejecutado", row[8]) for row in log]
            self._write_log(marked, batch_id)

    def _refuse_if_built_on(self, batch_id: str) -> None:
        customers, previous = self.customers(), self.store.read(PREVIOUS_T, PREVIOUS)
        other = F.coalesce(F.col("id_batch") != batch_id, F.lit(True))
        opened = customers.where(F.col("id_batch_open") == batch_id).select("cliente_key")
        edited = previous.where(~other).select("cliente_key", F.col("fecha_edicion").alias("_mine"))
        ours = opened.unionByName(edited.select("cliente_key"))
        closed = customers.where(F.coalesce(F.col("id_batch_close") != batch_id, F.lit(False))).join(
            ours, "cliente_key", "left_semi")
        sold = self.fact().where(other).join(opened, "cliente_key", "left_semi")
        again = previous.where(other).join(opened, "cliente_key", "left_semi")
        after = previous.where(other).join(edited, "cliente_key").where("fecha_edicion >= _mine")
        for found, what in ((closed, "changed"), (sold, "sold to"), (again, "edited"), (after, "edited")):
            if not found.isEmpty():
                raise ValueError(f"a later batch {what} customers opened or edited by {batch_id}; undo it first")

    def erase_customers(self, requests: DataFrame, user: str, now: datetime) -> int:
        """Replace the personal data of the requested customers everywhere; audited by customer.

        Only batches that hold a requested customer are rewritten, and no
        earlier snapshot stays. Returns the customer versions affected.
        """
        stamp = F.lit(now).cast("timestamp")
        ids = requests.select(F.col("id_cliente").cast("bigint").alias("_id")).distinct()

        def concerned(df):
            # names of batches, a few: a join on them would send each batch whole to one task
            hits = df.join(broadcast_if_small(ids, requests), privacy.customer_id(df) == F.col("_id"), "left_semi")
            return df.where(F.col("id_batch").isin([r.id_batch for r in hits.select("id_batch").distinct().collect()]))

        self._audit_each(ids.withColumn("n", F.lit(0).cast("bigint")), user, "DERECHO_AL_OLVIDO", now)
        versions = self.customers().join(ids, F.col("id_cliente") == F.col("_id"))
        counts = materialise(ids.join(versions.groupBy("_id").agg(F.count(F.lit(1)).alias("n")), "_id", "left")
                             .select("_id", F.coalesce("n", F.lit(0)).alias("n")))
        touched = self.store.buckets_of(ACTIVE_T, ids, "_id")
        self.store.write_buckets(ACTIVE_T, privacy.erase(self.active(touched), requests, stamp), touched, keep=1)
        for name, schema in ((CLOSED_T, _with_batch(CUSTOMER)), (PREVIOUS_T, PREVIOUS), (RAW_T, RAW), (CLEAN_T, CLEAN)):
            if not self.store.batches(name):
                continue
            erased = privacy.erase(concerned(self.store.read(name, schema)), requests, stamp)
            self.store.rewrite_batches(name, erased, same_rows=True)
        self._audit_each(counts, user, "DERECHO_AL_OLVIDO_COMPLETADO", now)
        return counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def _audit_each(self, counts: DataFrame, user: str, what: str, now: datetime) -> None:
        """One audit row per customer of ``counts(_id, n)``."""
        self.store.append_batch(ACCESS_T, access.access_entries(counts, user, what, "DELETE", now), f"{now:%Y%m%d}")

    def portability(self, requests: DataFrame, user: str, now: datetime) -> DataFrame:
        """All data of the requested customers; the read is audited."""
        self._audit(user, "PORTABILIDAD", "SELECT", now, None)
        return privacy.portability(requests, self.customers(), self.fact(),
                                   self.members("dim_canal"), self.members("dim_ciudad"))

    def write_test_copy(self, name: str = "test_data/ventas_anonimo") -> None:
        """Anonymised copy of the clean sales, replaced on every run."""
        privacy.anonymise_sales(self.clean().drop("fecha_procesamiento")).write.mode("overwrite").parquet(
            self.store.path(name))

    def _audit(self, user, what, operation, now, affected):
        entry = access.access_entry(self.spark, user, what, operation, now, affected)
        self.store.append_batch(ACCESS_T, entry.coalesce(1), f"{now:%Y%m%d}")

    def access_log(self) -> DataFrame:
        return self.store.read(ACCESS_T, _with_batch(ACCESS_LOG)).drop("id_batch")

    def export_quality_log(self, path: str) -> None:
        """The quality log as JSON lines."""
        self.quality_log().write.mode("overwrite").json(path)


def _fields(schema: str) -> list[str]:
    """Split DDL text at the commas between fields."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(schema[start:i])
            start = i + 1
    return out + [schema[start:]]


def run_summary(result: BatchResult, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(result.batch_id, result.mode, result.extracted, result.clean,
                                   result.loaded, result.score)],
                                 "id_batch string, modo string, extraidos bigint, limpios bigint, "
                                 "en_fact bigint, score double")
