"""The full profile reads values counted per column; every part must be as it is from the rows."""

from salesmart.operators import profiling, quality
from salesmart.schemas import BUSINESS_COLUMNS
from tests.test_profile_size import plan

ROWS = [("1", "2024-01-05", "7", "8", "1", "9.5", "Online", "Cali", "v", "a@uno.co", "3001234567"),
        ("1", "2035-01-05", "-1", "x", "1", "9.5", "online", "Cali", "v", "mal", "1"),
        ("1", "2024-13-05", "7", "8", "500", "0", "otro", "", None, "", None),
        (None, None, None, None, None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None, None, None),
        ("X2", "05/01/2024", "7.0", "8", "2", "1E2", " Tienda", "Cali", "v", "a@uno.co", "3001234567"),
        ("", " ", " 3 ", "8", "3", "100", "Online", "Cali", "v", "a@uno.co", "3001234567"),
        ("9", "2024-01-05", "7", "8", "2", "NaN", "Online", "Cali", "v", "a@uno.co", "3001234567")]


def same(one, two):
    return one.dtypes == two.dtypes and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_every_part_is_as_from_the_rows(spark):
    table = spark.createDataFrame(ROWS, ", ".join(f"{c} string" for c in BUSINESS_COLUMNS))
    for raw in (table, table.limit(1), table.limit(0)):
        report = profiling.full_report(raw)
        log = quality.profile_log(raw)
        for part, rows in {"stats": profiling.table_stats(raw), "por_columna": profiling.column_profile(raw),
                           "key_issues": quality.key_violations(raw), "outliers": profiling.iqr_outliers(raw),
                           "numericas": profiling.numeric_profile(raw), "quality_log": log,
                           "score": quality.score_pooled(log)}.items():
            got = report[part].drop("pass_threshold")
            assert same(got, rows), part


def test_parts_of_one_column_do_not_scan_the_sales_again(spark):
    raw = spark.range(3).selectExpr(*[f"cast(id as string) as {c}" for c in BUSINESS_COLUMNS])
    report = profiling.full_report(raw)
    assert all("Range" not in plan(report[part]) for part in ("por_columna", "numericas", "key_issues", "quality_log", "score"))
