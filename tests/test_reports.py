"""Running quality, mergeable counts, sketched percentiles, policy tables, roll-ups and movable feasts."""

import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from salesmart.functions.dates import easter
from salesmart.operators import access, profiling, quality
from salesmart.operators.calendar import build_calendar
from salesmart.plans import analytics, measures
from salesmart.schemas import BUSINESS_COLUMNS
from salesmart.streaming.ingest import daily_quality, file_stream, quality_by_day, write_updated

RAW = ", ".join(f"{c} string" for c in BUSINESS_COLUMNS) + ", fecha_carga timestamp"
GOOD = ("1", "2024-01-05", "7", "501", "2", "100.00", "Online", "Cali", "Ana Torres", "a@b.co", "3001234567")


def raw_row(stamp, **changes):
    return tuple(changes.get(c, v) for c, v in zip(BUSINESS_COLUMNS, GOOD, strict=True)) + (stamp,)


def test_running_quality_equals_the_batch_log_of_each_day(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def arrive(*rows):
        spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(folder)

    def drain(checkpoint="c", table=out):
        write_updated(daily_quality(file_stream(spark, folder, RAW), "fecha_carga", "1 day"), ["dia"], table,
                      str(tmp_path / checkpoint), folder="mes")
        return sorted(map(tuple, quality_by_day(spark.read.parquet(table)).select(
            "dia", "regla_calidad", "registros_evaluados", "registros_invalidos", "score").collect()))

    def batch(day, *rows):
        names, rules = quality.rule_names(quality.load_rules()), quality.load_rules()
        log = quality.count_invalid(spark.createDataFrame(rows, RAW), rules)
        found = {r.regla_calidad: (r.registros_evaluados, r.registros_invalidos) for r in log.collect()}
        score = quality.score_mean_of_rules(quality.with_percent(log)).first().score
        return [(day, name, *found[name], score) for name in names]

    one = [raw_row(datetime(2024, 1, 30, 3)), raw_row(datetime(2024, 1, 30, 4), fecha="x", canal=None), raw_row(datetime(2024, 1, 30, 5), cantidad="")]
    two = [raw_row(datetime(2024, 2, 1, 1), precio_unitario="-1")]
    arrive(*one, *two)
    first = sorted(batch(date(2024, 1, 30), *one) + batch(date(2024, 2, 1), *two))
    assert drain() == first
    assert drain() == first  # nothing new
    # a day late, but within the delay: counted in its day, other days stay
    late = [raw_row(datetime(2024, 1, 31, 23), id_cliente=" "), raw_row(datetime(2024, 2, 1, 2))]
    arrive(*late)
    second = sorted(batch(date(2024, 1, 30), *one) + batch(date(2024, 1, 31), late[0]) + batch(date(2024, 2, 1), *two, late[1]))
    assert drain() == second
    assert drain("other", str(tmp_path / "again")) == second  # a replay of everything


def test_customers_of_any_span_come_from_the_months(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), date(2023 + rng.randrange(2), rng.randrange(1, 13), rng.randrange(1, 28)),
             rng.choice([rng.randrange(1, 40), rng.randrange(1, 200_000)])) for _ in range(3000)] + [("a", date(2023, 5, 5), None)]
    sales = spark.createDataFrame(rows, "zona string, fecha_venta date, cliente_key bigint").repartition(4)
    months, sketches = measures.distinct_by_month(sales, ["zona"]), measures.distinct_sketches(sales, ["zona"])
    assert months.where("octet_length(bits) <> 4096").isEmpty()
    for span in ("month", "quarter", "year"):
        exact = {(r.zona, r.desde): r.n for r in sales.groupBy("zona", F.trunc("fecha_venta", span).alias("desde")).agg(
            F.count_distinct("cliente_key").alias("n")).collect()}
        assert {(r.zona, r.desde): r.clientes_unicos for r in measures.distinct_over(months, ["zona"], span).collect()} == exact
        for r in measures.distinct_estimate(sketches, ["zona"], span).collect():
            assert abs(r.clientes_unicos - exact[r.zona, r.desde]) <= max(1, 4 * 1.04 / 64 * exact[r.zona, r.desde])


def test_sketched_quartiles_are_within_their_accuracy(spark):
    rng = random.Random(4)
    values = [round(rng.lognormvariate(3, 1), 2) for _ in range(20_000)]
    raw = spark.createDataFrame([(str(i), str(v), "1") for i, v in enumerate(values)], "id_venta string, precio_unitario string, cantidad string")
    ordered, found = sorted(values), profiling.iqr_bounds(raw, ("precio_unitario",), accuracy=200).first()
    for p, got in ((0.25, found.q1), (0.75, found.q3)):
        assert got in set(values)
        assert abs(ordered.index(got) - p * len(ordered)) <= len(ordered) / 200 + 1
    exact = profiling.iqr_outliers(raw, ("precio_unitario",)).count()
    assert abs(profiling.iqr_outliers(raw, ("precio_unitario",), accuracy=10_000).count() - exact) <= 0.05 * exact
    assert profiling.numeric_profile(raw, ("precio_unitario",), accuracy=200).first().mediana in set(values)


def test_policy_tables_agree_with_the_one_user_filters(spark):
    sellers = spark.createDataFrame([(1, "N", "a@x"), (2, "N", "b@x"), (3, "S", "c@x"), (4, None, None)],
                                    "vendedor_key bigint, region string, email_vendedor string")
    fact = spark.createDataFrame([(i, i % 6 or None) for i in range(60)], "id_venta bigint, vendedor_key bigint")
    users = [("a@x", "seller"), ("a@x", "report"), ("c@x", "manager"), ("z", "admin"), ("z", "seller"), ("z", "report"), ("a@x", "nada")]
    table = spark.createDataFrame([*users, users[0]], "usuario string, rol string")
    seen = access.rows_of_users(fact, sellers, table, access.row_policy(spark))
    assert seen.columns == ["id_venta", "vendedor_key", "usuario", "rol"]
    got = {}
    for r in seen.collect():
        got.setdefault((r.usuario, r.rol), []).append(r.id_venta)
    for user, role in users:
        expected = sorted(r.id_venta for r in access.rows_for(role, fact, sellers, user).collect())
        assert sorted(got.get((user, role), [])) == expected, (user, role)
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("LogicalRDD.*id_venta", plan)) == 1 and "Cartesian" not in plan
    # a changed table changes what is seen
    none = access.rows_of_users(fact, sellers, table, spark.createDataFrame([("report", "propio")], "rol string, alcance string"))
    assert {(r.usuario, r.rol) for r in none.collect()} == {("a@x", "report")}


def test_roll_ups_tell_subtotals_from_missing_members(spark):
    sales = spark.createDataFrame([(1, 10, 1), (1, 5, 2), (2, 7, 1), (3, 1, 1), (9, 2, 1)], "k bigint, monto_total bigint, cantidad bigint")
    members = spark.createDataFrame([(1, "A", "x"), (2, "A", None), (3, None, "y")], "k bigint, arriba string, abajo string")
    rows = {(r.arriba, r.abajo, r.nivel): (r.total_transacciones, r.monto_total, r.total_unidades)
            for r in analytics.rolled_up(sales, "k", members, ["arriba", "abajo"]).collect()}
    assert rows == {("A", "x", 0): (2, 15, 3), ("A", None, 0): (1, 7, 1), (None, "y", 0): (1, 1, 1), (None, None, 0): (1, 2, 1),
                    ("A", None, 1): (3, 22, 4), (None, None, 1): (2, 3, 2), (None, None, 2): (5, 25, 6)}


# Dates of Easter from published tables.
EASTER = {1900: (4, 15), 1943: (4, 25), 2000: (4, 23), 2008: (3, 23), 2020: (4, 12), 2021: (4, 4), 2022: (4, 17), 2023: (4, 9), 2024: (3, 31),
          2025: (4, 20), 2026: (4, 5), 2027: (3, 28), 2028: (4, 16), 2029: (4, 1), 2030: (4, 21), 2038: (4, 25), 2285: (3, 22)}


def test_easter_and_the_feasts_that_follow_it(spark):
    years = spark.createDataFrame([(y,) for y in EASTER], "y int").select("y", easter(F.col("y")).alias("e"))
    assert {r.y: (r.e.month, r.e.day) for r in years.collect()} == EASTER
    plain, moved = (build_calendar(spark, movable=m).where("es_festivo") for m in (False, True))
    assert {r.n for r in plain.groupBy("anio").agg(F.count(F.lit(1)).alias("n")).collect()} == {13}
    names = moved.groupBy("anio").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("fecha")).alias("dias")).collect()
    assert {r.n for r in names} <= {17, 18}  # two feasts may fall on one Monday
    of_2024 = {r.fecha: r.nombre_festivo for r in moved.where("anio = 2024").collect()}
    assert of_2024[date(2024, 3, 28)] == "Jueves Santo" and of_2024[date(2024, 5, 13)] == "Ascensión del Señor"
    assert of_2024[date(2024, 6, 3)] == "Corpus Christi" and of_2024[date(2024, 6, 10)] == "Sagrado Corazón" and len(of_2024) == 18
    weekdays = {r.nombre_festivo: r.dia_semana for r in moved.collect()}
    assert weekdays["Viernes Santo"] == 5 and weekdays["Corpus Christi"] == 1


@pytest.mark.parametrize("name,reads", [("policy_rows", 1), ("customers_by_span", 0)])
def test_scans_of_the_lines(spark, name, reads):
    from checks.queries import QUERIES
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"FileScan parquet [^\n]*lineitem", plan)) == reads
