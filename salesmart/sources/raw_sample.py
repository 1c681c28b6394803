"""Messy raw sales derived from the line items, as all-string rows.

The expressions are plain SQL that Spark and the SQL twins both read, so
the two sides start from the same dirty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.sources.star import read

_K = "(l_orderkey * 10 + l_linenumber)"
_DAY = "CAST(CAST(CAST(l_shipdate AS DATE) + INTERVAL '25' YEAR AS DATE) AS STRING)"

RAW_EXPRESSIONS = {
    "id_venta": f"CASE WHEN {_K} % 211 = 7 THEN concat('X', CAST({_K} AS STRING)) "
                f"WHEN {_K} % 223 = 9 THEN NULL ELSE CAST({_K} AS STRING) END",
    "fecha": f"CASE WHEN {_K} % 101 = 3 THEN '2024-13-07' WHEN {_K} % 103 = 5 THEN '' "
             f"WHEN {_K} % 107 = 11 THEN '2035-01-01' "
             f"WHEN {_K} % 3 = 0 THEN replace({_DAY}, '-', '/') "
             f"WHEN {_K} % 7 = 1 THEN concat(substr({_DAY}, 9, 2), '-', substr({_DAY}, 6, 2), '-', substr({_DAY}, 1, 4)) "
             f"WHEN {_K} % 7 = 2 THEN concat(' ', {_DAY}) ELSE {_DAY} END",
    "id_cliente": f"CASE WHEN {_K} % 197 = 2 THEN '-1' WHEN {_K} % 193 = 6 THEN 'n/d' "
                  "ELSE CAST(l_suppkey + 1 AS STRING) END",
    "id_producto": f"CASE WHEN {_K} % 199 = 4 THEN 'abc' ELSE CAST(l_partkey + 1 AS STRING) END",
    "cantidad": f"CASE WHEN {_K} % 89 = 1 THEN '-2' WHEN {_K} % 83 = 2 THEN '' WHEN {_K} % 79 = 3 THEN '1.5' "
                f"WHEN {_K} % 997 = 4 THEN '900' "
                "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
    "precio_unitario": f"CASE WHEN {_K} % 97 = 0 THEN NULL WHEN {_K} % 113 = 6 THEN 'NaN' WHEN {_K} % 127 = 8 THEN '0' "
                       "ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END",
    "canal": f"CASE WHEN {_K} % 131 = 1 THEN '' WHEN {_K} % 137 = 2 THEN ' Telefono ' "
             f"WHEN {_K} % 4 = 0 THEN 'Online' WHEN {_K} % 4 = 1 THEN ' Tienda' "
             f"WHEN {_K} % 4 = 2 THEN 'marketplace' ELSE 'ONLINE' END",
    "ciudad": f"CASE WHEN {_K} % 139 = 5 THEN '' WHEN l_returnflag = 'A' THEN 'Bogotá' "
              "WHEN l_returnflag = 'N' THEN ' Medellín ' WHEN l_linestatus = 'F' THEN 'Cali' ELSE 'Leticia' END",
    "vendedor": f"CASE WHEN {_K} % 13 = 0 THEN ' ' ELSE concat(' Vendedor ', CAST(l_suppkey % 50 AS STRING)) END",
    "email_cliente": f"CASE WHEN {_K} % 61 = 1 THEN 'mal-correo' WHEN {_K} % 67 = 2 THEN '' "
                     f"WHEN {_K} % 71 = 3 THEN 'josé@correo.co' "
                     "ELSE concat('c', CAST(l_suppkey AS STRING), '@mail.com') END",
    "telefono_cliente": f"CASE WHEN {_K} % 59 = 3 THEN '12345' WHEN {_K} % 53 = 4 THEN NULL "
                        "ELSE concat('300', lpad(CAST(l_suppkey AS STRING), 7, '0')) END",
    "fecha_carga": "CAST(CAST(CAST(l_shipdate AS DATE) + INTERVAL '25' YEAR AS DATE) AS TIMESTAMP)",
    "archivo_origen": "CASE WHEN l_shipdate < CAST('1998-01-01' AS DATE) THEN 'ventas_raw.csv' ELSE 'ventas_nuevas.csv' END",
    "row_seq": "l_partkey * 1000000000 + CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)",
    "id_batch": "concat('b', substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 4))",
}

RAW_SQL = "SELECT " + ",\n  ".join(f"{sql} AS {name}" for name, sql in RAW_EXPRESSIONS.items()) + "\nFROM lineitem"


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a raw sale."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        *[f"{sql} AS {name}" for name, sql in RAW_EXPRESSIONS.items()])
