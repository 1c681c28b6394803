"""Profiles and key checks whose shuffles and tasks must stay small beside their input."""

from salesmart.operators import profiling, quality


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_rows_meet_as_digests(spark):
    rows = [("1", "a", None), ("1", "a", None), ("1", None, "a"), ("1", "", "a"), ("1", "a", ""), (None, None, None),
            (None, None, None), ("2", "1:a", "b"), ("2", "1", "a:b"), ("2", "1:a", "b"), ("2", "-", None), ("2", None, "-")]
    df = spark.createDataFrame(rows, "k string, a string, b string")
    stats = profiling.table_stats(df, "k", ("k", "a", "b"))
    assert tuple(stats.first()) == (12, 3, 9, 3)
    shuffles = [line for line in plan(stats).splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and not any("a#" in line or "b#" in line for line in shuffles)

def test_many_keys_are_grouped_not_joined(spark, monkeypatch):
    raw = spark.createDataFrame([(t,) for t in ("1", "1", " 2.0", "x", None, "7", "9")], "id_venta string")
    stored = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,), (9,)], "id_venta bigint")
    few = quality.loaded_keys(raw, stored)
    monkeypatch.setattr(quality, "is_small", lambda *_: False, raising=False)
    many = quality.loaded_keys(raw, stored)
    assert "Join" not in plan(many)
    assert sorted(r[0] for r in many.collect()) == sorted(r[0] for r in few.collect()) == [1, 2, 9]


def test_score_of_the_report_does_not_scan_the_sales_again(spark):
    raw = spark.range(3).selectExpr(*[f"cast(id as string) as {c}" for c in profiling.BUSINESS_COLUMNS])
    report = profiling.full_report(raw)
    assert "Range" not in plan(report["score"]) and report["score"].count() == 1
