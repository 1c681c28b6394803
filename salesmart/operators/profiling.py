"""Table and column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.functions.normalize import to_decimal
from salesmart.operators import quality
from salesmart.operators.ranking import exact_percentiles
from salesmart.schemas import BUSINESS_COLUMNS
from salesmart.session import materialise

NUMERIC_COLUMNS = ("id_venta", "id_cliente", "id_producto", "cantidad", "precio_unitario")
WIDE = "decimal(18,2)"


def _whole_row(columns) -> Column:
    """128 bits of the SHA-256 of a row; lengths and marks of nulls keep neighbouring values apart."""
    said = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
            for c in (F.col(name).cast("string") for name in columns)]
    return F.substring(F.unhex(F.sha2(F.concat(*said), 256)), 1, 16)


def table_stats(raw: DataFrame, key: str = "id_venta", columns=BUSINESS_COLUMNS,
                counts: DataFrame | None = None) -> DataFrame:
    """Rows, columns, copies of a key beyond the first, whole-row copies beyond the first.

    Whole rows meet as digests: what is shuffled of a row doesn't grow with its texts.
    """
    data = raw.select(*columns)
    beyond = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    copies = data.groupBy(key).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts.where(F.col("columna") == key)
    by_key = copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_registros"), beyond.alias("duplicados_id_venta"))
    whole = data.groupBy(_whole_row(columns).alias("_row")).agg(F.count(F.lit(1)).alias("n")).agg(beyond)
    return by_key.select("total_registros", F.lit(len(columns)).alias("total_columnas"),
                         "duplicados_id_venta",
                         whole.scalar().alias("filas_completamente_duplicadas"))


def long_form(df: DataFrame, columns) -> DataFrame:
    """(columna, valor): one row per cell."""
    return df.select(*columns).unpivot([], list(columns), "columna", "valor")


def value_counts(raw: DataFrame, columns=BUSINESS_COLUMNS) -> DataFrame:
    """(columna, valor, n): how often each value occurs in each column, nulls too.

    Operators that look at one column at a time take it as ``counts`` instead
    of reading the rows: they see each value once.
    """
    return long_form(raw, columns).groupBy("columna", "valor").agg(F.count(F.lit(1)).alias("n"))


def column_profile(raw: DataFrame, columns=BUSINESS_COLUMNS, counts: DataFrame | None = None) -> DataFrame:
    """Per column: missing cells, distinct values and the most common value.

    Cells are counted per (column, value) before the shuffle, so a value
    that fills a third of a column is one row per task. Ties for the most
    common value go to the smallest text.
    """
    counts = value_counts(raw, columns) if counts is None else counts.where(F.col("columna").isin(*columns))
    blank = F.col("valor").isNull() | (F.col("valor") == "")
    best = F.min(F.when(F.col("valor").isNotNull(), F.struct((-F.col("n")).alias("o"), "valor")))
    return counts.groupBy("columna").agg(
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("nulos"),
        F.sum("n").alias("_rows"), F.count("valor").alias("distintos"),
        best["valor"].alias("valor_mas_comun"),
    ).select("columna", "nulos",
             F.round(F.col("nulos") * 100.0 / F.col("_rows"), 2).alias("pct_nulos"),
             "distintos", "valor_mas_comun")


def numeric_cells(raw: DataFrame, columns=NUMERIC_COLUMNS) -> DataFrame:
    cells = long_form(raw, columns)
    return cells.select("columna", to_decimal(F.col("valor"), WIDE).alias("valor")).where("valor is not null")


def counted_cells(counts: DataFrame, columns=NUMERIC_COLUMNS) -> DataFrame:
    """``numeric_cells`` with each text once and its number of cells ``n``."""
    cells = counts.where(F.col("columna").isin(*columns))
    return cells.select("columna", to_decimal(F.col("valor"), WIDE).alias("valor"), "n").where("valor is not null")


def percentiles(cells: DataFrame, points: dict[str, float], accuracy: int | None = None) -> DataFrame:
    """n and percentiles per column: exact, or with ``accuracy`` from a sketch of bounded size.

    A sketch gives a value of the column whose rank is off by at most n / accuracy.
    ``cells`` may be counted (``counted_cells``) where they are exact.
    """
    if accuracy is None:
        return exact_percentiles(cells, "columna", "valor", points, "n" if "n" in cells.columns else None)
    found = cells.groupBy("columna").agg(F.count("valor").alias("n"), F.percentile_approx(
        F.col("valor").cast("double"), list(points.values()), accuracy).alias("_p"))
    return found.select("columna", "n", *[F.col("_p")[i].alias(name) for i, name in enumerate(points)])


def numeric_profile(raw: DataFrame, columns=NUMERIC_COLUMNS, accuracy: int | None = None,
                    counts: DataFrame | None = None) -> DataFrame:
    """Per numeric column: min, max, mean and the median, exact or by sketch (``percentiles``)."""
    counted = counts is not None and accuracy is None
    cells = counted_cells(counts, columns) if counted else numeric_cells(raw, columns)
    total, many = (F.sum(F.col("valor") * F.col("n")), F.sum("n")) if counted else (F.sum("valor"), F.count("valor"))
    basic = cells.groupBy("columna").agg(
        F.min("valor").alias("min"), F.max("valor").alias("max"), total.alias("_sum"), many.alias("_n"))
    median = percentiles(cells, {"mediana": 0.5}, accuracy).drop("n")
    return basic.join(median, "columna").select(
        "columna", "min", "max",
        F.round(F.col("_sum").cast("double") / F.col("_n"), 2).alias("media"), "mediana")


def iqr_bounds(raw: DataFrame, columns=("cantidad", "precio_unitario"), accuracy: int | None = None,
               counts: DataFrame | None = None) -> DataFrame:
    """Per column the quartiles and the accepted range; columns under four values are left out."""
    cells = numeric_cells(raw, columns) if counts is None or accuracy is not None else counted_cells(counts, columns)
    quartiles = percentiles(cells, {"q1": 0.25, "q3": 0.75}, accuracy).where("n >= 4")
    spread = (F.col("q3") - F.col("q1")) * 1.5
    return quartiles.select("columna", "q1", "q3", (F.col("q1") - spread).alias("desde"),
                            (F.col("q3") + spread).alias("hasta"))


def iqr_outliers(raw: DataFrame, columns=("cantidad", "precio_unitario"), accuracy: int | None = None,
                 counts: DataFrame | None = None) -> DataFrame:
    """Sales whose quantity or price is outside the quartile range; with ``accuracy`` of sketched quartiles."""
    cells = raw.select("id_venta", *columns).unpivot(["id_venta"], list(columns), "columna", "texto")
    cells = cells.withColumn("valor", to_decimal(F.col("texto"), WIDE)).where("valor is not null")
    # one row of bounds per profiled column, so this side has a fixed size
    bounds = F.broadcast(iqr_bounds(raw, columns, accuracy, counts).select("columna", "desde", "hasta"))
    value = F.col("valor").cast("double")
    return (cells.join(bounds, "columna").where((value < F.col("desde")) | (value > F.col("hasta")))
            .select("id_venta", "columna", "valor", F.lit("OUTLIER_DETECTADO").alias("tipo")))


def value_frequencies(raw: DataFrame, columns=("canal", "ciudad", "vendedor")) -> DataFrame:
    return long_form(raw, columns).groupBy("columna", "valor").agg(
        F.count(F.lit(1)).alias("frecuencia"))


def full_report(raw: DataFrame, existing: DataFrame | None = None) -> dict[str, DataFrame]:
    """All profile tables plus the pooled score with its pass flag.

    Values are counted once per column. What looks at one column reads the
    counts; whole rows, violations and outliers read the rows.
    """
    counts = materialise(value_counts(raw), compression="zstd")
    log = materialise(quality.profile_log(raw, counts))  # a row per rule, read twice
    score = quality.score_pooled(log).select(
        "score", (F.col("score") >= quality.STOP_BELOW).alias("pass_threshold"))
    return {
        "stats": table_stats(raw, counts=counts),
        "por_columna": column_profile(raw, counts=counts),
        "numericas": numeric_profile(raw, counts=counts),
        "issues": quality.violations(raw),
        "key_issues": quality.key_violations(raw, existing, counts),
        "outliers": iqr_outliers(raw, counts=counts),
        "quality_log": log,
        "score": score,
    }
