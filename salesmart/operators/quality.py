"""Validation rules, quality log, scores and the gate.

A rule is a name and a predicate. All per-row rules of a log run in one
scan that shuffles one row per task; only the uniqueness rules shuffle, and
they read the key column alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.functions import normalize as N
from salesmart.session import is_small

# Fields that must have a value, and numeric minimums.
REQUIRED = ("id_venta", "fecha", "id_cliente", "id_producto", "cantidad", "precio_unitario",
            "canal", "ciudad", "email_cliente", "telefono_cliente")
NUMERIC_MINIMUM = {"id_venta": "1", "id_cliente": "1", "id_producto": "1", "cantidad": "1",
                   "precio_unitario": "0.01"}
FIRST_DATE, LAST_DATE = date(2020, 1, 1), date(2030, 12, 31)

# Gate levels.
STOP_BELOW, EXCELLENT_FROM = 0.75, 0.95

# Incoming keys below this estimate are joined with the stored ones, more are grouped with them.
FEW_KEYS_BYTES = 4 * 1024 * 1024


@dataclass(frozen=True)
class Rule:
    """``invalid`` is a predicate that is true on bad rows and never null."""

    name: str
    field: str
    invalid: Column
    issue: str


def _c(field: str) -> Column:
    return F.col(field)


def _minimum(field: str) -> Column:
    return F.lit(NUMERIC_MINIMUM[field]).cast("decimal(12,2)")


def _not_a_number(field: str) -> Column:
    return ~N.is_blank(_c(field)) & N.to_number(_c(field)).isNull()


def _too_low(field: str) -> Column:
    return F.coalesce(N.to_number(_c(field)) < _minimum(field), F.lit(False))


def _no_number_from(field: str, least: Column, strict: bool = False) -> Column:
    number = N.to_number(_c(field))
    low = number <= least if strict else number < least
    return F.coalesce(low, F.lit(True))


def _out_of_range(field: str = "fecha") -> Column:
    return F.coalesce(~N.normalize_date(_c(field)).between(F.lit(FIRST_DATE), F.lit(LAST_DATE)),
                      F.lit(False))


def load_rules() -> list[Rule]:
    """Per-row rules of the batch load."""
    zero, one = F.lit(0), F.lit(1)
    rules = [Rule(f"COMPLETENESS:{f}", f, N.is_blank(_c(f)), "NULO_EN_CAMPO_REQUERIDO")
             for f in REQUIRED]
    return rules + [
        Rule("VALIDITY:fecha", "fecha", N.normalize_date(_c("fecha")).isNull(), "FECHA_INVALIDA"),
        Rule("VALIDITY:cantidad", "cantidad", _no_number_from("cantidad", one), "VALOR_FUERA_RANGO"),
        Rule("VALIDITY:precio_unitario", "precio_unitario",
             _no_number_from("precio_unitario", zero, strict=True), "VALOR_FUERA_RANGO"),
        Rule("VALIDITY:canal", "canal", ~N.is_known_channel(_c("canal")), "CANAL_VALOR_INVALIDO"),
    ]


def profile_rules() -> list[Rule]:
    """Per-row rules of the profiler; several predicates may share a log name."""
    rules = [Rule(f"NULLS:{f}", f, N.is_blank(_c(f)), "NULO_EN_CAMPO_REQUERIDO") for f in REQUIRED]
    rules += [
        Rule("DATE_FORMAT:fecha", "fecha", N.normalize_date(_c("fecha")).isNull(), "FECHA_INVALIDA"),
        Rule("DATE_FORMAT:fecha", "fecha", _out_of_range(), "FECHA_FUERA_RANGO"),
    ]
    for field in NUMERIC_MINIMUM:
        rules += [Rule(f"NUMERIC_RANGE:{field}", field, _not_a_number(field), "TIPO_DATO_INVALIDO"),
                  Rule(f"NUMERIC_RANGE:{field}", field, _too_low(field), "VALOR_FUERA_RANGO")]
    return rules + [
        Rule("CANAL_VALUES:canal", "canal",
             ~N.is_known_channel(_c("canal")) & ~N.is_blank(_c("canal")), "CANAL_VALOR_INVALIDO"),
        Rule("EMAIL_FORMAT:email_cliente", "email_cliente",
             ~N.is_valid_email(_c("email_cliente")), "EMAIL_INVALIDO"),
    ]


def alert_rules() -> list[Rule]:
    """Findings that are reported but never count as invalid."""
    return [
        Rule("CANAL_CASE:canal", "canal", N.is_miscased_channel(_c("canal")),
             "CANAL_CAPITALIZACIÓN_INCORRECTA"),
        Rule("PHONE_FORMAT:telefono_cliente", "telefono_cliente",
             ~N.is_valid_phone(_c("telefono_cliente")), "TELEFONO_INVALIDO"),
    ]


def rule_names(rules: list[Rule]) -> list[str]:
    return list(dict.fromkeys(r.name for r in rules))


def broken_counts(rules: list[Rule]) -> list[Column]:
    """One aggregate per rule name, ``r0``, ``r1``, ..: rows that break it."""
    return [sum((F.count_if(r.invalid) for r in rules if r.name == name), F.lit(0)).alias(f"r{i}")
            for i, name in enumerate(rule_names(rules))]


def count_invalid(raw: DataFrame, rules: list[Rule]) -> DataFrame:
    """``regla_calidad, registros_evaluados, registros_invalidos``, one scan for all rules."""
    names = rule_names(rules)
    wide = raw.agg(F.count(F.lit(1)).alias("registros_evaluados"), *broken_counts(rules))
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate(names))
    return wide.selectExpr(
        "registros_evaluados",
        f"stack({len(names)}, {pairs}) as (regla_calidad, registros_invalidos)")


def repeated_rows(raw: DataFrame, key: str = "id_venta") -> DataFrame:
    """One row: all rows, and rows whose key occurs more than once (every copy counts)."""
    copies = raw.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("registros_evaluados"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("registros_invalidos"))


def loaded_keys(raw: DataFrame, existing: DataFrame, key: str = "id_venta") -> DataFrame:
    """Distinct keys of ``raw`` that already exist.

    For a small ``raw`` the existing table is the side that gets filtered:
    Spark broadcasts or Bloom-filters the incoming keys, so the stored table
    is not shuffled whole. Otherwise both sides are grouped by key: a task
    holds one row per key, where a join would also sort both sides.
    """
    incoming = raw.select(N.to_integer(F.col(key)).alias(key)).where(F.col(key).isNotNull())
    stored = existing.select(F.col(key).cast("bigint").alias(key))
    if is_small(incoming, FEW_KEYS_BYTES):
        return stored.join(incoming.distinct(), key, "left_semi").distinct()
    new = F.col("_new")
    both = stored.where(F.col(key).isNotNull()).withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return both.groupBy(key).agg(F.min(new).alias("_from"), F.max(new).alias("_to")).where("_from < _to").select(key)


def with_percent(log: DataFrame) -> DataFrame:
    n, bad = F.col("registros_evaluados"), F.col("registros_invalidos")
    good = (n - bad).alias("registros_validos")
    pct = F.round(F.coalesce(F.try_divide((n - bad) * F.lit(100.0), n), F.lit(0.0)), 2)
    detail = F.when(bad == 0, "OK").otherwise(
        F.concat(bad.cast("string"), F.lit(" filas, ver violaciones")))
    return log.select("regla_calidad", "registros_evaluados", good, "registros_invalidos",
                      pct.alias("porcentaje_calidad"), detail.alias("detalles"))


def one_pass_log(raw: DataFrame, rules: list[Rule], unique: str, existing: DataFrame | None = None,
                 key: str = "id_venta") -> DataFrame:
    """All rules, the rule ``unique`` for repeated keys, and against ``existing`` the cross-file rule, in one scan.

    Broken rules are counted per key, in each task first, and the counts are
    summed; a frequent key is one row by then. The stored keys meet the keys
    of the batch, not its rows.
    """
    names = rule_names(rules)
    keys = raw.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *broken_counts(rules))
    zero = lambda column: F.coalesce(F.sum(column), F.lit(0))
    sums = [zero("n").alias("registros_evaluados"), *[zero(f"r{i}").alias(f"r{i}") for i in range(len(names))],
            zero(F.when(F.col("n") > 1, F.col("n"))).alias(f"r{len(names)}")]
    names = [*names, unique]
    if existing is not None:
        stored = existing.select(F.col(key).cast("bigint").alias("_stored")).distinct()
        keys = keys.withColumn("_id", N.to_integer(F.col(key))).join(stored, F.col("_id") == F.col("_stored"), "left")
        sums.append(F.count_distinct("_stored").alias(f"r{len(names)}"))
        names.append("UNIQUENESS:cross_file")
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate(names))
    return keys.agg(*sums).selectExpr(
        f"stack({len(names)}, {pairs}) as (regla_calidad, registros_invalidos)", "registros_evaluados").select(
            "regla_calidad", "registros_evaluados", "registros_invalidos")


def counted_log(counts: DataFrame, rules: list[Rule], unique: str, key: str = "id_venta") -> DataFrame:
    """``one_pass_log`` from the values of each column and how often they occur; a rule sees its field alone, each value once."""
    names, n = rule_names(rules), F.col("n")
    of = lambda field: F.col("columna") == field
    fields = dict.fromkeys([key, *(r.field for r in rules)])
    values = counts.select("columna", "n", *[F.when(of(f), F.col("valor")).alias(f) for f in fields])
    zero = lambda column: F.coalesce(F.sum(column), F.lit(0))
    broken = lambda name: sum((zero(F.when(of(r.field), F.when(r.invalid, n))) for r in rules if r.name == name), F.lit(0))
    sums = [zero(F.when(of(key), n)).alias("registros_evaluados"), *[broken(name).alias(f"r{i}") for i, name in enumerate(names)],
            zero(F.when(of(key) & (n > 1), n)).alias(f"r{len(names)}")]
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate([*names, unique]))
    return values.agg(*sums).selectExpr(
        f"stack({len(names) + 1}, {pairs}) as (regla_calidad, registros_invalidos)", "registros_evaluados").select(
            "regla_calidad", "registros_evaluados", "registros_invalidos")


def quality_log(raw: DataFrame, existing: DataFrame | None = None,
                stored: DataFrame | None = None) -> DataFrame:
    """Log of the batch load; ``existing`` adds the cross-file rule, stored facts the consistency of amounts."""
    log = one_pass_log(raw, load_rules(), "UNIQUENESS:id_venta", existing)
    if stored is not None:
        off = F.abs(F.col("monto_total") - F.col("cantidad") * F.col("precio_unitario")) > 0.01
        log = log.unionByName(stored.agg(
            F.count(F.lit(1)).alias("registros_evaluados"),
            F.count_if(off).alias("registros_invalidos")).withColumn(
                "regla_calidad", F.lit("CONSISTENCY:monto_total")))
    return with_percent(log)


def profile_log(raw: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Log of the profiler, from the rows or from ``profiling.value_counts`` of them."""
    rules, unique = profile_rules(), "DUPLICATES:id_venta"
    return with_percent(one_pass_log(raw, rules, unique) if counts is None else counted_log(counts, rules, unique))


def score_mean_of_rules(log: DataFrame) -> DataFrame:
    """Unweighted mean of the rule ratios; an empty table scores 1."""
    ratio = F.coalesce(F.try_divide(F.col("registros_validos").cast("double"),
                                    F.col("registros_evaluados").cast("double")), F.lit(1.0))
    return log.agg(F.round(F.avg(ratio), 4).alias("score"))


def score_pooled(log: DataFrame) -> DataFrame:
    """All valid checks over all checks."""
    return log.agg(F.round(F.coalesce(F.try_divide(
        F.sum("registros_validos").cast("double"), F.sum("registros_evaluados").cast("double")),
        F.lit(0.0)), 4).alias("score"))


def score_dimensions(log: DataFrame) -> DataFrame:
    """Mean of the four dimension means, in percent."""
    dimension = F.split_part("regla_calidad", F.lit(":"), F.lit(1))
    ratio = F.coalesce(F.try_divide(F.col("registros_validos") * F.lit(100.0),
                                    F.col("registros_evaluados")), F.lit(100.0))
    return (log.groupBy(dimension.alias("dimension")).agg(F.avg(ratio).alias("pct"))
            .agg(F.round(F.avg("pct"), 3).alias("score")))


def gate_level(score: Column) -> Column:
    return (F.when(score < STOP_BELOW, "Inaceptable")
            .when(score < EXCELLENT_FROM, "Aceptable").otherwise("Excelente"))


class QualityGateError(ValueError):
    """The score of a batch is below the threshold."""


def check_gate(score: float, threshold: float = STOP_BELOW) -> float:
    if score < threshold:
        raise QualityGateError(f"score {score:.2%} is below the threshold {threshold:.0%}")
    return score


def violations(raw: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per broken rule and sale, in one scan: rule, field, id, value, issue type."""
    rules = profile_rules() + alert_rules() if rules is None else rules
    # rules are judged in a plain projection, which is compiled; below a filter of an array they would be interpreted.
    # Generated, the answers are not pulled back into that filter.
    fields = dict.fromkeys(["id_venta", *(r.field for r in rules)])
    judged = raw.select(*fields, F.array(*[r.invalid for r in rules]).alias("_judged"))
    broken = judged.select(*fields, F.explode(F.array("_judged")).alias("_broken")).where(F.array_contains("_broken", F.lit(True)))
    found = F.array(*[F.when(F.col("_broken")[i], F.struct(
        F.lit(r.name).alias("regla"), F.lit(r.field).alias("campo"),
        F.col(r.field).alias("valor"), F.lit(r.issue).alias("tipo"))) for i, r in enumerate(rules)])
    return broken.select("id_venta", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("v")).select(
        "v.regla", "v.campo", "id_venta", "v.valor", "v.tipo")


def key_violations(raw: DataFrame, existing: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Repeated keys, and keys found in ``existing``: one row per key with its copies."""
    copies = (raw.groupBy("id_venta").agg(F.count(F.lit(1)).alias("copias")) if counts is None else
              counts.where("columna = 'id_venta'").select(F.col("valor").alias("id_venta"), F.col("n").alias("copias")))
    out = copies.where("copias > 1").select("id_venta", "copias", F.lit("DUPLICADO_ID_VENTA").alias("tipo"))
    if existing is None:
        return out
    cross = loaded_keys(raw, existing).select(
        F.col("id_venta").cast("string").alias("id_venta"), F.lit(1).cast("bigint").alias("copias"),
        F.lit("DUPLICADO_ENTRE_ARCHIVOS").alias("tipo"))
    return out.unionByName(cross)
