"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from salesmart.sources.raw_sample import RAW_SQL

# The sales star over the order tables.
STAR = """
places AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
lines AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(15,2)) AS monto, CAST(l_quantity AS BIGINT) AS q,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS dcto
  FROM lineitem),
fact AS (
  SELECT l_orderkey * 10 + l_linenumber AS id_venta, o_custkey AS cliente_key, l_partkey AS producto_key,
         l_suppkey AS vendedor_key, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS canal_key,
         c_nationkey AS ciudad_key, q AS cantidad, monto AS monto_total,
         CAST((2 * CAST(monto * 100 AS BIGINT) + q) // (2 * q) AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2)) AS precio_unitario,
         dcto AS descuento, CAST((monto - dcto) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS impuestos,
         monto - dcto + CAST((monto - dcto) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS monto_neto,
         CAST(o_orderdate AS DATE) AS fecha, 'b' || CAST(year(o_orderdate) AS VARCHAR) AS id_batch
  FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
cliente AS (
  SELECT c_custkey AS cliente_key, c_custkey AS id_cliente, n_name AS ciudad,
         c_mktsegment <> 'HOUSEHOLD' AS actual
  FROM customer JOIN places ON c_nationkey = n_nationkey),
vendedor AS (
  SELECT s_suppkey AS vendedor_key, CASE WHEN s_acctbal < 0 THEN 'SIN_ASIGNAR' ELSE s_name END AS nombre_vendedor,
         n_name AS ciudad_base, r_name AS region, 'v' || CAST(s_suppkey AS VARCHAR) || '@ventas.test' AS email_vendedor
  FROM supplier JOIN places ON s_nationkey = n_nationkey),
canal AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS canal_key, min(o_orderpriority) AS nombre_canal,
         CASE WHEN substr(min(o_orderpriority), 1, 1) = '5' THEN 'Físico' ELSE 'Digital' END AS tipo_canal,
         CAST(substr(min(o_orderpriority), 1, 1) AS BIGINT) - 1 AS comision
  FROM orders GROUP BY 1)
"""

MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"

ORACLE: dict[str, str] = {}

_TOP = """
SELECT ranking, id_cliente, ciudad_actual, total_transacciones, CAST(m AS DOUBLE) AS monto_total,
       round(CAST(m AS DOUBLE) / total_transacciones, 0) AS ticket_promedio,
       CAST(a AS VARCHAR) AS primera_compra, CAST(b AS VARCHAR) AS ultima_compra
FROM (
  SELECT rank() OVER (ORDER BY sum(f.monto_total) DESC) AS ranking, c.id_cliente, c.ciudad AS ciudad_actual,
         count(*) AS total_transacciones, sum(f.monto_total) AS m, min(f.fecha) AS a, max(f.fecha) AS b
  FROM fact f JOIN cliente c USING (cliente_key) WHERE c.actual GROUP BY c.id_cliente, c.ciudad)
WHERE ranking <= 5
"""
ORACLE["top_customers"] = f"WITH {STAR} {_TOP}"
# two customers in three have an earlier version, which owns their sales before the move
_MOVED = f"""WITH {STAR},
moved AS (SELECT *, cliente_key % 3 = 0 OR fecha >= DATE '1998-04-01' AS de_version_actual FROM fact),
"""
ORACLE["top_customers_all_versions"] = f"{_MOVED} all_fact AS (SELECT * FROM moved) {_TOP.replace('FROM fact f', 'FROM all_fact f')}"
ORACLE["top_customers_current_version"] = (
    f"{_MOVED} now_fact AS (SELECT * FROM moved WHERE de_version_actual) {_TOP.replace('FROM fact f', 'FROM now_fact f')}")

ORACLE["monthly_trend"] = f"""
WITH {STAR}, m AS (
  SELECT year(fecha) AS anio, month(fecha) AS num_mes, count(*) AS n, sum(monto_total) AS s,
         count(DISTINCT cliente_key) AS clientes_unicos
  FROM fact GROUP BY 1, 2),
t AS (SELECT *, lag(s) OVER (ORDER BY anio, num_mes) AS p FROM m)
SELECT anio, num_mes, {MONTHS}[num_mes] AS mes, n AS total_transacciones, CAST(s AS DOUBLE) AS monto_total,
       round(CAST(s AS DOUBLE) / n, 0) AS ticket_promedio, clientes_unicos,
       CAST(coalesce(p, 0) AS DOUBLE) AS monto_mes_anterior,
       coalesce(round(CAST(s - p AS DOUBLE) / nullif(CAST(p AS DOUBLE), 0) * 100, 1), 0.0) + 0.0 AS variacion_pct
FROM t
"""

ORACLE["city_analysis"] = f"""
WITH {STAR}, c AS (
  SELECT n_name AS nombre_ciudad, r_name AS region, count(*) AS n, sum(monto_total) AS s,
         count(DISTINCT cliente_key) AS k, sum(cantidad) AS u
  FROM fact JOIN places ON ciudad_key = n_nationkey GROUP BY 1, 2)
SELECT rank() OVER (ORDER BY s DESC) AS ranking_nacional, nombre_ciudad,
       'Departamento ' || nombre_ciudad AS departamento, region,
       rank() OVER (PARTITION BY region ORDER BY s DESC) AS ranking_regional,
       n AS total_transacciones, CAST(s AS DOUBLE) AS monto_total,
       round(CAST(s AS DOUBLE) / n, 0) AS promedio_por_transaccion, k AS clientes_unicos,
       CAST(u AS BIGINT) AS unidades_vendidas,
       round(CAST(s AS DOUBLE) * 100.0 / CAST(sum(s) OVER () AS DOUBLE), 1) AS participacion_pct
FROM c
"""

ORACLE["seller_ranking"] = f"""
WITH {STAR}, s AS (
  SELECT vendedor_key, nombre_vendedor, region, ciudad_base, count(*) AS n, sum(monto_total) AS m,
         sum(cantidad) AS u, count(DISTINCT cliente_key) AS k, min(fecha) AS a, max(fecha) AS b
  FROM fact JOIN vendedor USING (vendedor_key) WHERE nombre_vendedor <> 'SIN_ASIGNAR' GROUP BY 1, 2, 3, 4)
SELECT rank() OVER (ORDER BY m DESC) AS ranking, nombre_vendedor, region, ciudad_base,
       n AS total_transacciones, CAST(m AS DOUBLE) AS monto_total,
       round(CAST(m AS DOUBLE) / n, 0) AS ticket_promedio, CAST(u AS BIGINT) AS unidades_vendidas,
       k AS clientes_atendidos, CAST(a AS VARCHAR) AS primera_venta, CAST(b AS VARCHAR) AS ultima_venta,
       CASE ntile(3) OVER (ORDER BY m DESC, vendedor_key) WHEN 1 THEN 'Alto' WHEN 2 THEN 'Medio' ELSE 'Bajo' END AS "nivel_desempeño"
FROM s
"""

ORACLE["product_analysis"] = f"""
WITH {STAR}, p AS (
  SELECT p_partkey, p_name, p_type, p_brand, p_retailprice, count(*) AS n, sum(cantidad) AS u,
         sum(monto_total) AS m, sum(precio_unitario) AS pr, count(DISTINCT cliente_key) AS k
  FROM fact JOIN part ON producto_key = p_partkey GROUP BY 1, 2, 3, 4, 5)
SELECT p_partkey AS id_producto, p_name AS nombre_producto, p_type AS categoria, p_brand AS subcategoria,
       n AS total_transacciones, CAST(u AS BIGINT) AS total_unidades, CAST(m AS DOUBLE) AS monto_total,
       round(CAST(pr AS DOUBLE) / n, 0) AS precio_promedio_venta, p_retailprice AS precio_referencia,
       k AS clientes_distintos, rank() OVER (ORDER BY u DESC) AS rank_por_unidades,
       rank() OVER (ORDER BY m DESC) AS rank_por_monto,
       rank() OVER (ORDER BY m DESC) - rank() OVER (ORDER BY u DESC) AS diferencia_rankings
FROM p
"""

ORACLE["channel_analysis"] = f"""
WITH {STAR}, c AS (
  SELECT nombre_canal, tipo_canal, comision, count(*) AS n, sum(monto_total) AS m, sum(cantidad) AS u,
         count(DISTINCT cliente_key) AS k, count(DISTINCT producto_key) AS p
  FROM fact JOIN canal USING (canal_key) GROUP BY 1, 2, 3)
SELECT rank() OVER (ORDER BY m DESC) AS ranking, nombre_canal, tipo_canal, n AS total_transacciones,
       CAST(m AS DOUBLE) AS monto_total, round(CAST(m AS DOUBLE) / n, 0) AS ticket_promedio,
       CAST(u AS BIGINT) AS total_unidades,
       round(CAST(m AS DOUBLE) * 100.0 / CAST(sum(m) OVER () AS DOUBLE), 1) AS participacion_pct,
       round(CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER () AS DOUBLE), 1) AS participacion_transacciones_pct,
       k AS clientes_unicos, p AS productos_distintos,
       round(CAST(m AS DOUBLE) * CAST(comision AS DOUBLE) / 100.0, 0) AS costo_comision,
       round(CAST(m AS DOUBLE) * (1 - CAST(comision AS DOUBLE) / 100.0), 0) AS monto_neto_canal
FROM c
"""

_ROLLED = "sum(cantidad) AS total_unidades, count(*) AS total_transacciones, CAST(sum(monto_total) AS DOUBLE) AS monto_total"
ORACLE["city_rollup"] = f"""
WITH {STAR}
SELECT r_name AS region, 'Departamento ' || n_name AS departamento, n_name AS nombre_ciudad,
       bit_count(grouping(r_name, 'Departamento ' || n_name, n_name)) AS nivel, {_ROLLED}
FROM fact JOIN places ON ciudad_key = n_nationkey GROUP BY ROLLUP (r_name, 'Departamento ' || n_name, n_name)
"""
ORACLE["product_rollup"] = f"""
WITH {STAR}
SELECT p_type AS categoria, p_brand AS subcategoria, bit_count(grouping(p_type, p_brand)) AS nivel, {_ROLLED}
FROM fact JOIN part ON producto_key = p_partkey GROUP BY ROLLUP (p_type, p_brand)
"""
ORACLE["product_yoy"] = f"""
WITH {STAR}, y AS (
  SELECT p_partkey, p_name, p_type, year(fecha) AS anio, count(*) AS n, sum(cantidad) AS u,
         sum(monto_total) AS m, sum(precio_unitario) AS pr
  FROM fact JOIN part ON producto_key = p_partkey GROUP BY 1, 2, 3, 4),
t AS (SELECT *, lag(m) OVER (PARTITION BY p_partkey ORDER BY anio) AS o,
             lag(u) OVER (PARTITION BY p_partkey ORDER BY anio) AS ou FROM y)
SELECT p_partkey AS id_producto, p_name AS nombre_producto, p_type AS categoria, anio,
       n AS total_transacciones, CAST(u AS BIGINT) AS total_unidades, CAST(m AS DOUBLE) AS monto_total,
       round(CAST(pr AS DOUBLE) / n, 0) AS precio_promedio, CAST(coalesce(o, 0) AS DOUBLE) AS monto_anio_anterior,
       CAST(ou AS BIGINT) AS unidades_anio_anterior,
       CASE WHEN o IS NULL OR o = 0 THEN NULL ELSE round(CAST(m - o AS DOUBLE) / CAST(o AS DOUBLE) * 100, 1) + 0.0 END AS yoy_growth_pct,
       CASE WHEN o IS NULL THEN 'Primer año'
            WHEN m > o * 1.10 THEN 'Crecimiento fuerte (>10%)'
            WHEN m > o THEN 'Crecimiento moderado'
            WHEN m = o THEN 'Estable'
            WHEN m > o * 0.90 THEN 'Caída moderada'
            ELSE 'Caída fuerte (>10%)' END AS tendencia
FROM t
"""

# Holiday rules written out per date part, independent of the calendar code.
HOLIDAY = """
CASE
  WHEN month(d) = 12 AND day(d) = 25 THEN 'Navidad'
  WHEN month(d) = 12 AND day(d) = 8 THEN 'Inmaculada Concepción'
  WHEN isodow(d) = 1 AND d BETWEEN make_date(year(d), 11, 11) AND make_date(year(d), 11, 17) THEN 'Independencia de Cartagena'
  WHEN isodow(d) = 1 AND d BETWEEN make_date(year(d), 11, 1) AND make_date(year(d), 11, 7) THEN 'Todos los Santos'
  WHEN isodow(d) = 1 AND d BETWEEN make_date(year(d), 10, 12) AND make_date(year(d), 10, 18) THEN 'Día de la Raza'
  WHEN isodow(d) = 1 AND d BETWEEN make_date(year(d), 8, 15) AND make_date(year(d), 8, 21) THEN 'Asunción de la Virgen'
  WHEN month(d) = 8 AND day(d) = 7 THEN 'Batalla de Boyacá'
  WHEN month(d) = 7 AND day(d) = 20 THEN 'Independencia de Colombia'
  WHEN isodow(d) = 1 AND d BETWEEN make_date(year(d), 6, 29) AND make_date(year(d), 7, 5) THEN 'San Pedro y San Pablo'
  WHEN month(d) = 5 AND day(d) = 1 THEN 'Día del Trabajo'
  WHEN isodow(d) = 1 AND d BETWEEN make_date(year(d), 3, 19) AND make_date(year(d), 3, 25) THEN 'San José'
  WHEN isodow(d) = 1 AND d BETWEEN make_date(year(d), 1, 6) AND make_date(year(d), 1, 12) THEN 'Reyes Magos'
  WHEN month(d) = 1 AND day(d) = 1 THEN 'Año Nuevo'
END
"""

ORACLE["sales_view"] = f"""
WITH {STAR}
SELECT f.id_venta, CAST(f.fecha AS VARCHAR) AS fecha, year(f.fecha) AS anio, {MONTHS}[month(f.fecha)] AS nombre_mes,
       quarter(f.fecha) AS trimestre, CAST(h.hol IS NOT NULL AS BIGINT) AS es_festivo, c.id_cliente,
       c.ciudad AS ciudad_cliente, p_name AS nombre_producto, p_type AS categoria, p_brand AS subcategoria,
       nombre_vendedor, v.region AS region_vendedor, nombre_canal, n_name AS ciudad_venta,
       'Departamento ' || n_name AS departamento, r_name AS region_ciudad, f.cantidad,
       CAST(f.precio_unitario AS DOUBLE) AS precio_unitario, CAST(f.monto_total AS DOUBLE) AS monto_total,
       CAST(f.descuento AS DOUBLE) AS descuento, CAST(f.impuestos AS DOUBLE) AS impuestos,
       CAST(f.monto_neto AS DOUBLE) AS monto_neto, f.id_batch
FROM fact f JOIN cliente c USING (cliente_key) JOIN part ON f.producto_key = p_partkey
JOIN vendedor v USING (vendedor_key) JOIN canal USING (canal_key) JOIN places ON f.ciudad_key = n_nationkey
JOIN (SELECT d, {HOLIDAY} AS hol FROM (SELECT DISTINCT fecha AS d FROM fact)) h ON h.d = f.fecha
"""

# ---- raw rows ----------------------------------------------------------------

RAW = f"raw AS (\n{RAW_SQL})"


def _date(c):
    formats = ("%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%d/%m/%Y")
    return "CAST(coalesce(" + ", ".join(f"try_strptime(trim({c}), '{f}')" for f in formats) + ") AS DATE)"


def _num(c):
    return f"TRY_CAST(trim({c}) AS DECIMAL(28,6))"


def _int(c):
    return f"CASE WHEN {_num(c)} = floor({_num(c)}) THEN CAST({_num(c)} AS BIGINT) END"


def _blank(c):
    return f"coalesce(trim({c}) = '', true)"


_CANAL = ("CASE WHEN lower(trim(canal)) = 'online' THEN 'Online' WHEN lower(trim(canal)) = 'tienda' THEN 'Tienda' "
          "WHEN lower(trim(canal)) = 'marketplace' THEN 'Marketplace' WHEN trim(canal) = '' THEN NULL ELSE trim(canal) END")
_KNOWN = "coalesce(lower(trim(canal)) IN ('online', 'tienda', 'marketplace'), false)"
_MISCASED = f"({_KNOWN} AND trim(canal) NOT IN ('Online', 'Tienda', 'Marketplace'))"
_EMAIL_OK = r"coalesce(regexp_full_match(trim(email_cliente), '[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]{2,}'), false)"
_PHONE_OK = "coalesce(regexp_full_match(trim(telefono_cliente), '[0-9]{10}'), false)"
_PRICE = "TRY_CAST(trim(precio_unitario) AS DECIMAL(12,2))"

TYPED = f"""
typed AS (
  SELECT id_venta AS raw_id, {_int('id_venta')} AS id_venta, {_date('fecha')} AS fecha,
         {_int('id_cliente')} AS id_cliente, {_int('id_producto')} AS id_producto, {_int('cantidad')} AS cantidad,
         {_PRICE} AS precio_unitario, {_CANAL} AS canal, trim(ciudad) AS ciudad,
         CASE WHEN {_blank('vendedor')} THEN 'SIN_ASIGNAR' ELSE trim(vendedor) END AS vendedor,
         trim(email_cliente) AS email_cliente, trim(telefono_cliente) AS telefono_cliente,
         CAST({_int('cantidad')} * {_PRICE} AS DECIMAL(15,2)) AS monto_total,
         fecha_carga, row_seq, archivo_origen, id_batch
  FROM raw),
judged AS (
  SELECT *, CASE WHEN fecha IS NULL THEN 'FECHA_INVALIDA' WHEN canal IS NULL THEN 'CANAL_INVALIDO'
                 WHEN precio_unitario IS NULL OR precio_unitario <= 0 THEN 'PRECIO_INVALIDO'
                 WHEN cantidad IS NULL OR cantidad < 1 THEN 'CANTIDAD_INVALIDA'
                 WHEN coalesce(id_venta, 0) < 1 OR coalesce(id_cliente, 0) < 1 OR coalesce(id_producto, 0) < 1 THEN 'ID_INVALIDO'
            END AS motivo FROM typed),
loaded AS (SELECT DISTINCT {_int('id_venta')} AS id_venta FROM raw WHERE archivo_origen = 'ventas_raw.csv' AND {_int('id_venta')} IS NOT NULL),
good AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_venta ORDER BY fecha_carga, archivo_origen, row_seq) AS rn
                 FROM judged WHERE motivo IS NULL) WHERE rn = 1)
"""
RAW_WITH = f"{RAW},\n{TYPED}"

ORACLE["normalized_dates"] = f"""
WITH {RAW}, t AS (SELECT fecha AS texto, count(*) AS filas FROM raw GROUP BY 1),
p AS (SELECT *, {_date('texto')} AS d FROM t)
SELECT texto, filas, CAST(d AS VARCHAR) AS fecha, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS fecha_key,
       isodow(d) AS dia_semana,
       CAST(CASE WHEN isodow(d) = 1 THEN d ELSE d + CAST(8 - isodow(d) AS INTEGER) END AS VARCHAR) AS lunes,
       {MONTHS}[month(d)] AS nombre_mes
FROM p
"""

ORACLE["normalized_channel"] = f"""
WITH {RAW}, t AS (SELECT canal, count(*) AS filas FROM raw GROUP BY 1)
SELECT canal AS texto, filas, {_CANAL} AS canal, CAST({_KNOWN} AS BIGINT) AS conocido,
       CAST({_MISCASED} AS BIGINT) AS mal_escrito,
       CASE WHEN lower(trim(canal)) = 'tienda' THEN 'Físico' ELSE 'Digital' END AS tipo_canal
FROM t
"""

ORACLE["typed_numbers"] = f"""
WITH {RAW_WITH}
SELECT raw_id AS texto_id, id_venta, id_cliente, id_producto, cantidad, CAST(precio_unitario AS DOUBLE) AS precio_unitario,
       CAST(monto_total AS DOUBLE) AS monto_total, vendedor,
       'Producto ' || CAST(id_producto AS VARCHAR) AS nombre_producto FROM typed
"""

ORACLE["email_phone_checks"] = f"""
WITH {RAW}
SELECT email_cliente, telefono_cliente, count(*) AS filas, CAST({_EMAIL_OK} AS BIGINT) AS email_ok,
       CAST({_PHONE_OK} AS BIGINT) AS telefono_ok
FROM raw GROUP BY email_cliente, telefono_cliente
"""

_REQUIRED = ("id_venta", "fecha", "id_cliente", "id_producto", "cantidad", "precio_unitario",
             "canal", "ciudad", "email_cliente", "telefono_cliente")
_LOAD_CHECKS = [(f"COMPLETENESS:{f}", _blank(f)) for f in _REQUIRED] + [
    ("VALIDITY:fecha", f"{_date('fecha')} IS NULL"),
    ("VALIDITY:cantidad", f"coalesce({_num('cantidad')} < 1, true)"),
    ("VALIDITY:precio_unitario", f"coalesce({_num('precio_unitario')} <= 0, true)"),
    ("VALIDITY:canal", f"NOT {_KNOWN}")]
_MIN = {"id_venta": "1", "id_cliente": "1", "id_producto": "1", "cantidad": "1", "precio_unitario": "0.01"}
_PROFILE_CHECKS = [(f"NULLS:{f}", f, _blank(f), "NULO_EN_CAMPO_REQUERIDO") for f in _REQUIRED] + [
    ("DATE_FORMAT:fecha", "fecha", f"{_date('fecha')} IS NULL", "FECHA_INVALIDA"),
    ("DATE_FORMAT:fecha", "fecha",
     f"coalesce({_date('fecha')} NOT BETWEEN DATE '2020-01-01' AND DATE '2030-12-31', false)", "FECHA_FUERA_RANGO")]
for _f, _m in _MIN.items():
    _PROFILE_CHECKS += [
        (f"NUMERIC_RANGE:{_f}", _f, f"(NOT {_blank(_f)} AND {_num(_f)} IS NULL)", "TIPO_DATO_INVALIDO"),
        (f"NUMERIC_RANGE:{_f}", _f, f"coalesce({_num(_f)} < {_m}, false)", "VALOR_FUERA_RANGO")]
_PROFILE_CHECKS += [
    ("CANAL_VALUES:canal", "canal", f"(NOT {_KNOWN} AND NOT {_blank('canal')})", "CANAL_VALOR_INVALIDO"),
    ("EMAIL_FORMAT:email_cliente", "email_cliente", f"NOT {_EMAIL_OK}", "EMAIL_INVALIDO")]
_ALERT_CHECKS = [
    ("CANAL_CASE:canal", "canal", _MISCASED, "CANAL_CAPITALIZACIÓN_INCORRECTA"),
    ("PHONE_FORMAT:telefono_cliente", "telefono_cliente", f"NOT {_PHONE_OK}", "TELEFONO_INVALIDO")]

_LOAD_LOG = "\nUNION ALL ".join(
    f"SELECT '{name}' AS r, count(*) AS n, count(*) FILTER ({bad}) AS bad FROM raw" for name, bad in _LOAD_CHECKS)
_DUPS = ("SELECT '{name}' AS r, sum(c) AS n, coalesce(sum(c) FILTER (c > 1), 0) AS bad "
         "FROM (SELECT count(*) AS c FROM raw GROUP BY id_venta)")
_PROFILE_NAMES = list(dict.fromkeys(c[0] for c in _PROFILE_CHECKS))
_PROFILE_LOG = "\nUNION ALL ".join(
    "SELECT '{0}' AS r, count(*) AS n, {1} AS bad FROM raw".format(
        name, " + ".join(f"count(*) FILTER ({c[2]})" for c in _PROFILE_CHECKS if c[0] == name))
    for name in _PROFILE_NAMES)
_LOG_SELECT = """
SELECT r AS regla_calidad, CAST(n AS BIGINT) AS registros_evaluados, CAST(n - bad AS BIGINT) AS registros_validos,
       CAST(bad AS BIGINT) AS registros_invalidos, round(CAST(n - bad AS DOUBLE) * 100.0 / CAST(n AS DOUBLE), 2) AS porcentaje_calidad,
       CASE WHEN bad = 0 THEN 'OK' ELSE CAST(CAST(bad AS BIGINT) AS VARCHAR) || ' filas, ver violaciones' END AS detalles
FROM log
"""
ORACLE["quality_log"] = f"""
WITH {RAW_WITH}, log AS (
{_LOAD_LOG}
UNION ALL {_DUPS.format(name='UNIQUENESS:id_venta')}
UNION ALL SELECT 'UNIQUENESS:cross_file', (SELECT count(*) FROM raw),
  (SELECT count(*) FROM (SELECT DISTINCT {_int('id_venta')} AS i FROM raw) WHERE i IN (SELECT id_venta FROM loaded))
UNION ALL SELECT 'CONSISTENCY:monto_total', count(*), count(*) FILTER (abs(monto_total - cantidad * precio_unitario) > 0.01) FROM (
  SELECT CAST(l_quantity AS INTEGER) AS cantidad, CAST(l_extendedprice AS DECIMAL(15,2)) AS monto_total,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) / CAST(l_quantity AS INTEGER) AS DECIMAL(12,2)) AS precio_unitario FROM lineitem))
{_LOG_SELECT}
"""
ORACLE["profile_quality_log"] = f"""
WITH {RAW}, log AS (
{_PROFILE_LOG}
UNION ALL {_DUPS.format(name='DUPLICATES:id_venta')})
{_LOG_SELECT}
"""
ORACLE["quality_scores"] = f"""
WITH {RAW}, la AS (
{_LOAD_LOG}
UNION ALL {_DUPS.format(name='UNIQUENESS:id_venta')}),
lb AS (
{_PROFILE_LOG}
UNION ALL {_DUPS.format(name='DUPLICATES:id_venta')}),
s AS (
  SELECT 'A' AS formula, round(avg((n - bad) / n), 4) AS score FROM la
  UNION ALL SELECT 'B', round(sum(n - bad) / sum(n), 4) FROM lb
  UNION ALL SELECT 'C', round(avg(p), 3) / 100 FROM (SELECT split_part(r, ':', 1) AS d, avg((n - bad) * 100.0 / n) AS p FROM la GROUP BY 1))
SELECT formula, round(score, 4) AS score,
       CASE WHEN score < 0.75 THEN 'Inaceptable' WHEN score < 0.95 THEN 'Aceptable' ELSE 'Excelente' END AS estado FROM s
"""
ORACLE["violations"] = f"WITH {RAW}\n" + "\nUNION ALL ".join(
    f"SELECT '{name}' AS regla, '{field}' AS campo, id_venta, {field} AS valor, '{issue}' AS tipo FROM raw WHERE {bad}"
    for name, field, bad, issue in _PROFILE_CHECKS + _ALERT_CHECKS)
ORACLE["key_violations"] = f"""
WITH {RAW_WITH}
SELECT id_venta, count(*) AS copias, 'DUPLICADO_ID_VENTA' AS tipo FROM raw WHERE archivo_origen = 'ventas_nuevas.csv'
GROUP BY id_venta HAVING count(*) > 1
UNION ALL SELECT CAST(i AS VARCHAR), 1, 'DUPLICADO_ENTRE_ARCHIVOS'
FROM (SELECT DISTINCT {_int('id_venta')} AS i FROM raw WHERE archivo_origen = 'ventas_nuevas.csv') WHERE i IN (SELECT id_venta FROM loaded)
"""

_BUSINESS = _REQUIRED[:8] + ("vendedor",) + _REQUIRED[8:]
ORACLE["table_stats"] = f"""
WITH {RAW}
SELECT (SELECT count(*) FROM raw) AS total_registros, 11 AS total_columnas,
       (SELECT CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM raw GROUP BY id_venta)) AS duplicados_id_venta,
       (SELECT CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM raw GROUP BY {', '.join(_BUSINESS)})) AS filas_completamente_duplicadas
"""
_CELLS = "cells AS (" + "\nUNION ALL ".join(f"SELECT '{c}' AS columna, {c} AS valor FROM raw" for c in _BUSINESS) + ")"
ORACLE["column_profile"] = f"""
WITH {RAW}, {_CELLS}, c AS (SELECT columna, valor, count(*) AS n FROM cells GROUP BY 1, 2),
best AS (SELECT columna, valor FROM (SELECT *, row_number() OVER (PARTITION BY columna ORDER BY n DESC, valor) AS rn FROM c WHERE valor IS NOT NULL) WHERE rn = 1)
SELECT c.columna, CAST(coalesce(sum(n) FILTER (c.valor IS NULL OR c.valor = ''), 0) AS BIGINT) AS nulos,
       round(CAST(coalesce(sum(n) FILTER (c.valor IS NULL OR c.valor = ''), 0) AS DOUBLE) * 100.0 / CAST(sum(n) AS DOUBLE), 2) AS pct_nulos,
       count(c.valor) AS distintos, min(best.valor) AS valor_mas_comun
FROM c JOIN best ON c.columna = best.columna GROUP BY c.columna
"""
_NUMBERS = "nums AS (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS columna, id_venta, TRY_CAST(trim({c}) AS DECIMAL(18,2)) AS v FROM raw" for c in _MIN) + ")"
ORACLE["numeric_profile"] = f"""
WITH {RAW}, {_NUMBERS}
SELECT columna, CAST(min(v) AS DOUBLE) AS min, CAST(max(v) AS DOUBLE) AS max,
       round(CAST(sum(v) AS DOUBLE) / count(v), 2) AS media, quantile_cont(CAST(v AS DOUBLE), 0.5) AS mediana
FROM nums WHERE v IS NOT NULL GROUP BY columna
"""
ORACLE["iqr_outliers"] = f"""
WITH {RAW}, {_NUMBERS}, q AS (
  SELECT columna, quantile_cont(CAST(v AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(v AS DOUBLE), 0.75) AS q3
  FROM nums WHERE v IS NOT NULL AND columna IN ('cantidad', 'precio_unitario') GROUP BY 1)
SELECT n.id_venta, n.columna, CAST(n.v AS DOUBLE) AS valor, 'OUTLIER_DETECTADO' AS tipo
FROM nums n JOIN q ON n.columna = q.columna
WHERE CAST(v AS DOUBLE) < q1 - (q3 - q1) * 1.5 OR CAST(v AS DOUBLE) > q3 + (q3 - q1) * 1.5
"""
ORACLE["iqr_sketch"] = f"""
WITH {RAW}, {_NUMBERS}
SELECT columna, count(v) AS n, 1 AS q1_dentro, 1 AS q3_dentro FROM nums
WHERE v IS NOT NULL AND columna IN ('cantidad', 'precio_unitario') GROUP BY 1
"""
ORACLE["value_frequencies"] = f"""
WITH {RAW}, {_CELLS}
SELECT columna, valor, count(*) AS frecuencia FROM cells WHERE columna IN ('canal', 'ciudad', 'vendedor') GROUP BY 1, 2
"""
_CLEAN_OUT = """id_venta, CAST(fecha AS VARCHAR) AS fecha, id_cliente, id_producto, cantidad,
  CAST(precio_unitario AS DOUBLE) AS precio_unitario, canal, ciudad, vendedor, email_cliente, telefono_cliente,
  CAST(monto_total AS DOUBLE) AS monto_total"""
ORACLE["clean_rows"] = f"WITH {RAW_WITH} SELECT {_CLEAN_OUT}, id_batch FROM good"
_SECOND = """second AS (
  SELECT *, row_number() OVER (PARTITION BY id_venta ORDER BY fecha_carga, archivo_origen, row_seq) AS rn
  FROM judged WHERE motivo IS NULL AND archivo_origen = 'ventas_nuevas.csv')"""
ORACLE["rejected_rows"] = f"""
WITH {RAW_WITH}, {_SECOND}
SELECT raw_id AS id_venta, motivo, id_batch FROM judged WHERE motivo IS NOT NULL AND archivo_origen = 'ventas_nuevas.csv'
UNION ALL SELECT raw_id, 'DUPLICADO_EN_DWH', id_batch FROM second WHERE rn = 1 AND id_venta IN (SELECT id_venta FROM loaded)
"""
ORACLE["exclude_loaded"] = f"""
WITH {RAW_WITH}, {_SECOND}
SELECT id_venta, CAST(fecha AS VARCHAR) AS fecha, CAST(monto_total AS DOUBLE) AS monto_total
FROM second WHERE rn = 1 AND id_venta NOT IN (SELECT id_venta FROM loaded)
"""
ORACLE["clean_rows_strict"] = f"""
WITH {RAW_WITH}, s AS (
  SELECT *, CASE WHEN motivo = 'FECHA_INVALIDA' THEN motivo
                 WHEN fecha NOT BETWEEN DATE '2020-01-01' AND DATE '2030-12-31' THEN 'FECHA_FUERA_RANGO'
                 WHEN canal IS NULL OR canal NOT IN ('Online', 'Tienda', 'Marketplace') THEN 'CANAL_INVALIDO'
                 WHEN ciudad = '' THEN 'CIUDAD_VACIA' ELSE motivo END AS m FROM judged)
SELECT coalesce(m, 'LIMPIA') AS motivo, CASE WHEN m IS NULL THEN count(DISTINCT id_venta) ELSE count(*) END AS filas
FROM s GROUP BY m
"""
ORACLE["profile_clean_rows"] = f"""
WITH {RAW_WITH}, s AS (
  SELECT *, CASE WHEN fecha IS NULL THEN 'FECHA_INVALIDA' WHEN precio_unitario IS NULL THEN 'PRECIO_NULO'
                 WHEN cantidad <= 0 THEN 'CANTIDAD_INVALIDA'
                 WHEN id_venta IS NULL OR id_cliente IS NULL OR id_producto IS NULL OR cantidad IS NULL THEN 'ID_INVALIDO' END AS m FROM typed)
SELECT coalesce(m, 'LIMPIA') AS motivo, CASE WHEN m IS NULL THEN count(DISTINCT id_venta) ELSE count(*) END AS filas
FROM s GROUP BY m
"""
ORACLE["dedupe_first"] = f"""
WITH {RAW}
SELECT id_venta, strftime(fecha_carga, '%Y-%m-%d %H:%M:%S') AS fecha_carga, row_seq, cantidad
FROM (SELECT *, row_number() OVER (PARTITION BY id_venta ORDER BY fecha_carga, archivo_origen, row_seq) AS rn FROM raw) WHERE rn = 1
"""

# ---- dimensions, history, facts -------------------------------------------------

ORACLE["calendar_dim"] = f"""
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
days AS (
  SELECT CAST(unnest(generate_series(CAST(make_date(min(year(d)), 1, 1) AS TIMESTAMP), CAST(make_date(max(year(d)), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
  FROM o),
h AS (SELECT d, {HOLIDAY} AS hol FROM days)
SELECT CAST(strftime(h.d, '%Y%m%d') AS BIGINT) AS fecha_key, CAST(h.d AS VARCHAR) AS fecha, year(h.d) AS anio, month(h.d) AS mes,
       day(h.d) AS dia, {MONTHS}[month(h.d)] AS nombre_mes, quarter(h.d) AS trimestre, weekofyear(h.d) AS semana_anio,
       isodow(h.d) AS dia_semana, ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(h.d)] AS nombre_dia_semana,
       CAST(isodow(h.d) >= 6 AS BIGINT) AS es_fin_semana, CAST(hol IS NOT NULL AS BIGINT) AS es_festivo, hol AS nombre_festivo,
       strftime(h.d, '%Y-%m') AS anio_mes, coalesce(o.n, 0) AS pedidos
FROM h LEFT JOIN o ON o.d = h.d
"""
ORACLE["holidays"] = f"""
WITH {STAR}, h AS (SELECT d, {HOLIDAY} AS hol FROM (SELECT DISTINCT fecha AS d FROM fact))
SELECT CAST(d AS VARCHAR) AS fecha, hol AS nombre_festivo, isodow(d) AS dia_semana, count(*) AS ventas, CAST(sum(monto_total) AS DOUBLE) AS monto_total
FROM h JOIN fact ON fecha = d WHERE hol IS NOT NULL GROUP BY d, hol
"""
_CENTURY, _GOLDEN = "(y // 100)", "(y % 19)"
_MOON = f"((19 * {_GOLDEN} + {_CENTURY} - {_CENTURY} // 4 - ({_CENTURY} - ({_CENTURY} + 8) // 25 + 1) // 3 + 15) % 30)"
_WEEKDAY = f"((32 + 2 * ({_CENTURY} % 4) + 2 * ((y % 100) // 4) - {_MOON} - (y % 100) % 4) % 7)"
_EASTER = f"({_MOON} + {_WEEKDAY} - 7 * (({_GOLDEN} + 11 * {_MOON} + 22 * {_WEEKDAY}) // 451) + 114)"
ORACLE["holidays_movable"] = f"""
WITH {STAR}, years AS (SELECT y, make_date(y, {_EASTER} // 31, {_EASTER} % 31 + 1) AS e FROM (SELECT DISTINCT year(fecha) AS y FROM fact)),
h AS (SELECT d, coalesce(CASE date_diff('day', e, d) WHEN -3 THEN 'Jueves Santo' WHEN -2 THEN 'Viernes Santo' WHEN 43 THEN 'Ascensión del Señor'
                         WHEN 64 THEN 'Corpus Christi' WHEN 71 THEN 'Sagrado Corazón' END, {HOLIDAY}) AS hol
      FROM (SELECT DISTINCT fecha AS d FROM fact) JOIN years ON y = year(d))
SELECT CAST(d AS VARCHAR) AS fecha, hol AS nombre_festivo, isodow(d) AS dia_semana, count(*) AS ventas, CAST(sum(monto_total) AS DOUBLE) AS monto_total
FROM h JOIN fact ON fecha = d WHERE hol IS NOT NULL GROUP BY d, hol
"""
ORACLE["assigned_keys"] = """
SELECT c_name, c_custkey, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name) AS cliente_key FROM customer
"""
ORACLE["global_ranks"] = f"""
WITH {STAR}, s AS (SELECT producto_key, sum(monto_total) AS m, sum(cantidad) AS u FROM fact GROUP BY 1)
SELECT producto_key, CAST(m AS DOUBLE) AS monto_total, CAST(u AS BIGINT) AS unidades, rank() OVER (ORDER BY m DESC) AS rango,
       dense_rank() OVER (ORDER BY u DESC) AS rango_denso, row_number() OVER (ORDER BY u DESC, producto_key) AS posicion,
       ntile(7) OVER (ORDER BY u DESC, producto_key) AS tramo
FROM s
"""
ORACLE["ranks_with_gaps"] = """
WITH r AS (SELECT c_custkey, c_name, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS grupo,
                  CASE WHEN c_custkey % 7 <> 0 THEN floor(CAST(c_acctbal AS DOUBLE) / 100) / 4 END AS valor FROM customer),
k AS (SELECT *, rank() OVER (PARTITION BY grupo ORDER BY valor DESC NULLS LAST) AS r1,
             dense_rank() OVER (PARTITION BY grupo ORDER BY valor ASC NULLS LAST) AS d1,
             rank() OVER (ORDER BY valor DESC NULLS LAST) AS g1,
             row_number() OVER (ORDER BY valor DESC NULLS LAST, c_name) AS p1,
             ntile(5) OVER (ORDER BY valor DESC NULLS LAST, c_name) AS t1 FROM r)
SELECT c_custkey, grupo, valor, r1 AS rango_ventana, d1 AS denso_ventana, g1 AS global_ventana, p1 AS posicion_ventana, t1 AS tramo_ventana,
       r1 AS rango_rangos, d1 AS denso_rangos, g1 AS global_rangos, p1 AS posicion_rangos, t1 AS tramo_rangos
FROM k
"""
_FIRST_GOOD = """
g1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_venta ORDER BY fecha_carga, archivo_origen, row_seq) AS rn
                      FROM judged WHERE motivo IS NULL AND archivo_origen = 'ventas_raw.csv') WHERE rn = 1),
g2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_venta ORDER BY fecha_carga, archivo_origen, row_seq) AS rn
                      FROM judged WHERE motivo IS NULL AND archivo_origen = 'ventas_nuevas.csv') WHERE rn = 1)
"""
ORACLE["scd1_overwrite"] = """
SELECT CASE WHEN p_size <= 25 THEN p_partkey * 2 + 1
            ELSE (SELECT max(p_partkey) * 2 + 1 FROM part WHERE p_size <= 25)
                 + row_number() OVER (PARTITION BY p_size <= 25 ORDER BY p_partkey) END AS producto_key,
       p_partkey AS id_producto, p_name AS nombre_producto,
       CASE WHEN p_size < 10 THEN p_retailprice WHEN p_size % 2 = 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) + 1 AS DOUBLE)
            WHEN p_size <= 25 THEN p_retailprice END AS precio_referencia
FROM part
"""
HISTORY = """
cust AS (SELECT c_custkey, c_acctbal, c_mktsegment, n_name, 'c' || CAST(c_custkey AS VARCHAR) || '@mail.com' AS email,
                lpad(CAST(c_custkey AS VARCHAR), 10, '3') AS phone
         FROM customer JOIN nation ON c_nationkey = n_nationkey),
known AS (SELECT * FROM cust WHERE c_mktsegment <> 'MACHINERY'),
stored AS (
  SELECT c_custkey * 2 AS cliente_key, c_custkey AS id_cliente, email AS email_cliente, phone AS telefono_cliente, 'Origen' AS ciudad,
         DATE '1995-06-01' AS desde, DATE '1997-12-31' AS hasta, false AS actual, 'b0' AS opened, 'b1' AS closed
  FROM known WHERE c_acctbal > 5000
  UNION ALL
  SELECT c_custkey * 2 + 1, c_custkey, email, phone, n_name,
         CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '2002-01-01' WHEN c_acctbal > 5000 THEN DATE '1998-01-01' ELSE DATE '1995-06-01' END,
         NULL, true, CASE WHEN c_acctbal > 5000 THEN 'b1' ELSE 'b0' END, NULL
  FROM known),
incoming AS (
  SELECT c_custkey AS id_cliente, email, CASE WHEN c_acctbal > 9500 THEN NULL ELSE phone END AS phone,
         CASE WHEN c_acctbal < 0 THEN 'Nueva ' || n_name ELSE n_name END AS ciudad, c_mktsegment FROM cust),
moved AS (
  SELECT i.*, s.cliente_key AS old_key, s.desde = DATE '2002-01-01' AS same_day,
         s.cliente_key IS NOT NULL AND (s.email_cliente IS DISTINCT FROM i.email OR s.telefono_cliente IS DISTINCT FROM i.phone OR s.ciudad IS DISTINCT FROM i.ciudad) AS changed
  FROM incoming i LEFT JOIN stored s ON s.id_cliente = i.id_cliente AND s.actual),
merged AS (
  SELECT s.cliente_key, s.id_cliente,
         CASE WHEN m.changed AND m.same_day AND s.actual THEN m.email ELSE s.email_cliente END AS email_cliente,
         CASE WHEN m.changed AND m.same_day AND s.actual THEN m.phone ELSE s.telefono_cliente END AS telefono_cliente,
         CASE WHEN m.changed AND m.same_day AND s.actual THEN m.ciudad ELSE s.ciudad END AS ciudad,
         s.desde, CASE WHEN s.actual AND m.changed AND NOT m.same_day THEN DATE '2001-12-31' ELSE s.hasta END AS hasta,
         s.actual AND NOT (m.changed AND NOT m.same_day) AS actual,
         '1995-01-01 00:00:00' AS creada, CASE WHEN s.actual AND m.changed THEN '2002-01-01 00:00:00' END AS tocada,
         s.opened, CASE WHEN s.actual AND m.changed AND NOT m.same_day THEN 'b2' ELSE s.closed END AS closed
  FROM stored s JOIN moved m ON m.id_cliente = s.id_cliente
  UNION ALL
  SELECT (SELECT max(cliente_key) FROM stored) + row_number() OVER (ORDER BY id_cliente), id_cliente, email, phone, ciudad,
         DATE '2002-01-01', NULL, true, '2002-01-01 00:00:00', NULL, 'b2', NULL
  FROM moved WHERE old_key IS NULL OR (changed AND NOT same_day))
"""
ORACLE["scd2_history"] = f"""
WITH {HISTORY}
SELECT cliente_key, id_cliente, email_cliente, telefono_cliente, ciudad, CAST(desde AS VARCHAR) AS fecha_vigencia_desde,
       CAST(hasta AS VARCHAR) AS fecha_vigencia_hasta, CAST(actual AS BIGINT) AS es_registro_actual, creada AS fecha_creacion,
       tocada AS fecha_actualizacion, opened AS id_batch_open, closed AS id_batch_close
FROM merged
"""
ORACLE["scd2_undo"] = f"""
WITH {HISTORY}
SELECT s.cliente_key, s.id_cliente, s.email_cliente, s.telefono_cliente, s.ciudad, CAST(s.desde AS VARCHAR) AS fecha_vigencia_desde,
       CAST(s.hasta AS VARCHAR) AS fecha_vigencia_hasta, CAST(s.actual AS BIGINT) AS es_registro_actual,
       '1995-01-01 00:00:00' AS fecha_creacion,
       CASE WHEN s.actual AND m.changed AND NOT m.same_day THEN '2002-01-02 00:00:00' END AS fecha_actualizacion,
       s.opened AS id_batch_open, s.closed AS id_batch_close
FROM stored s JOIN moved m ON m.id_cliente = s.id_cliente
"""
_BROKEN = """
SELECT id_cliente, count(*) AS total_versiones, count(*) FILTER ({flag}) AS versiones_activas, count(*) FILTER (gap) AS cortes, '{case}' AS caso
FROM (SELECT *, coalesce(lead(desde) OVER w <> hasta + 1, false) OR (lead(desde) OVER w IS NOT NULL AND hasta IS NULL) AS gap
      FROM merged WINDOW w AS (PARTITION BY id_cliente ORDER BY desde))
GROUP BY id_cliente HAVING count(*) FILTER ({flag}) <> 1 OR count(*) FILTER (gap) > 0
"""
ORACLE["scd2_invariant"] = (f"WITH {HISTORY}" + _BROKEN.format(flag="actual", case="merge")
                            + " UNION ALL " + _BROKEN.format(flag="true", case="roto"))
ORACLE["asof_customer"] = f"""
WITH {HISTORY}, spans AS (
  SELECT cliente_key, id_cliente, hasta,
         CASE WHEN row_number() OVER (PARTITION BY id_cliente ORDER BY desde) = 1 THEN DATE '0001-01-01' ELSE desde END AS desde FROM merged)
SELECT o_orderkey, o_custkey AS id_cliente, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fecha, s.cliente_key
FROM orders LEFT JOIN spans s ON s.id_cliente = o_custkey AND CAST(o_orderdate AS DATE) >= s.desde
     AND (s.hasta IS NULL OR CAST(o_orderdate AS DATE) <= s.hasta)
"""
ORACLE["latest_customer_attributes"] = f"""
WITH {RAW_WITH}
SELECT id_cliente, email_cliente, telefono_cliente, ciudad
FROM (SELECT *, row_number() OVER (PARTITION BY id_cliente ORDER BY fecha DESC, id_venta DESC) AS k FROM good) WHERE k = 1
"""
KEYED = f"""
seller AS (SELECT DISTINCT 'Vendedor ' || CAST(s_suppkey % 50 AS VARCHAR) AS nombre, s_suppkey % 50 AS vendedor_key FROM supplier WHERE s_nationkey < 20),
keyed AS (
  SELECT g.*, CASE WHEN g.fecha BETWEEN DATE '2020-01-01' AND DATE '2030-12-31' THEN CAST(strftime(g.fecha, '%Y%m%d') AS BIGINT) END AS fecha_key,
         s_suppkey AS cliente_key, p_partkey AS producto_key, seller.vendedor_key,
         CASE g.canal WHEN 'Online' THEN 1 WHEN 'Tienda' THEN 2 WHEN 'Marketplace' THEN 3 END AS canal_key,
         CASE g.ciudad WHEN 'Bogotá' THEN 1 WHEN 'Medellín' THEN 2 WHEN 'Cali' THEN 3 END AS ciudad_key
  FROM good g LEFT JOIN supplier ON s_suppkey + 1 = g.id_cliente AND s_acctbal > 0
  LEFT JOIN part ON p_partkey + 1 = g.id_producto AND p_type <> 'PROMO'
  LEFT JOIN seller ON seller.nombre = g.vendedor),
lookup AS (
  SELECT *, CASE WHEN fecha_key IS NULL THEN 'fecha_key no encontrado para ' || CAST(fecha AS VARCHAR)
                 WHEN cliente_key IS NULL THEN 'cliente_key no encontrado para ' || CAST(id_cliente AS VARCHAR)
                 WHEN producto_key IS NULL THEN 'producto_key no encontrado para ' || CAST(id_producto AS VARCHAR)
                 WHEN vendedor_key IS NULL THEN 'vendedor_key no encontrado para ' || vendedor
                 WHEN canal_key IS NULL THEN 'canal_key no encontrado para ' || canal
                 WHEN ciudad_key IS NULL THEN 'ciudad_key no encontrado para ' || ciudad END AS falta FROM keyed)
"""
_STORED = {"canal": ("canal", "SELECT unnest(['Online', 'Tienda', 'Marketplace'])", "3"),
           "ciudad": ("ciudad", "SELECT unnest(['Bogotá', 'Medellín', 'Cali', 'Barranquilla', 'Cartagena', 'Bucaramanga', 'Pereira', 'Manizales'])", "8"),
           "vendedor": ("vendedor", "SELECT nombre FROM seller", "(SELECT max(vendedor_key) FROM seller)"),
           "producto": ("id_producto", "SELECT p_partkey + 1 FROM part WHERE p_type <> 'PROMO'",
                        "(SELECT max(p_partkey) FROM part WHERE p_type <> 'PROMO')")}
ORACLE["new_dim_members"] = f"WITH {RAW_WITH}, {KEYED}\n" + "\nUNION ALL ".join(
    f"SELECT '{kind}' AS dimension, {start} + row_number() OVER (ORDER BY {c}) AS clave, CAST({c} AS VARCHAR) AS miembro "
    f"FROM (SELECT DISTINCT {c} FROM good WHERE {c} NOT IN ({stored}))"
    for kind, (c, stored, start) in _STORED.items())
_SIX = "fecha_key, cliente_key, producto_key, vendedor_key, canal_key, ciudad_key"
ORACLE["fact_resolved"] = f"""
WITH {RAW_WITH}, {KEYED}
SELECT id_venta, {_SIX}, cantidad, CAST(precio_unitario AS DOUBLE) AS precio_unitario, CAST(monto_total AS DOUBLE) AS monto_total
FROM lookup WHERE falta IS NULL
"""
ORACLE["fact_star_join"] = f"WITH {RAW_WITH}, {KEYED} SELECT id_venta, {_SIX}, CAST(monto_total AS DOUBLE) AS monto_total FROM lookup WHERE falta IS NULL"
ORACLE["fact_unresolved"] = f"WITH {RAW_WITH}, {KEYED} SELECT id_venta, falta AS motivo FROM lookup WHERE falta IS NOT NULL"
ORACLE["fact_insert_new"] = f"""
WITH {RAW_WITH}, {KEYED}
SELECT id_venta, fecha_key, CAST(monto_total AS DOUBLE) AS monto_total, CAST(0 AS DOUBLE) AS descuento, CAST(0 AS DOUBLE) AS impuestos, CAST(monto_total AS DOUBLE) AS monto_neto, 'b9' AS id_batch
FROM lookup WHERE falta IS NULL AND id_venta NOT IN (SELECT id_venta FROM loaded)
UNION ALL SELECT id_venta, NULL, CAST(monto_total AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), 'omitida'
FROM lookup WHERE falta IS NULL AND id_venta IN (SELECT id_venta FROM loaded)
"""

# ---- reconciliation ---------------------------------------------------------------

ORACLE["fact_insert_indexed"] = ORACLE["fact_insert_new"]
ORACLE["batch_summary"] = f"""
WITH {STAR}
SELECT id_batch, count(*) AS total_ventas, CAST(sum(monto_total) AS DOUBLE) AS monto_total_cargado,
       CAST(min(fecha) AS VARCHAR) AS fecha_min, CAST(max(fecha) AS VARCHAR) AS fecha_max FROM fact GROUP BY id_batch
"""
ORACLE["stage_vs_fact"] = f"""
WITH {RAW_WITH}, {KEYED}
SELECT 'staging_clean' AS origen, id_batch, count(*) AS total_registros, CAST(sum(monto_total) AS DOUBLE) AS monto_total FROM good GROUP BY id_batch
UNION ALL SELECT 'fact_ventas', id_batch, count(*), CAST(sum(monto_total) AS DOUBLE) FROM lookup WHERE falta IS NULL GROUP BY id_batch
"""
ORACLE["list_batches"] = f"""
WITH {RAW_WITH}, {KEYED}
SELECT id_batch, strftime(min(fecha), '%Y-%m-%d %H:%M:%S') AS fecha_carga FROM lookup WHERE falta IS NULL GROUP BY id_batch
"""
ORACLE["orphans"] = f"""
WITH {STAR}
SELECT 'fact sin dim_fecha' AS problema, count(*) AS filas FROM fact WHERE fecha >= DATE '2001-01-01'
UNION ALL SELECT 'fact sin dim_cliente', count(*) FROM fact LEFT JOIN (SELECT * FROM cliente WHERE actual) c USING (cliente_key) WHERE c.id_cliente IS NULL
UNION ALL SELECT 'fact sin dim_producto', count(*) FROM fact LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') p ON p_partkey = producto_key WHERE p_partkey IS NULL
UNION ALL SELECT 'fact sin dim_vendedor', count(*) FROM fact LEFT JOIN (SELECT vendedor_key AS k FROM vendedor WHERE nombre_vendedor <> 'SIN_ASIGNAR') v ON k = vendedor_key WHERE k IS NULL
UNION ALL SELECT 'fact sin dim_canal', count(*) FROM fact LEFT JOIN (SELECT canal_key AS k FROM canal) v ON k = canal_key WHERE k IS NULL
UNION ALL SELECT 'fact sin dim_ciudad', count(*) FROM fact LEFT JOIN (SELECT n_nationkey AS k FROM places WHERE r_name <> 'ASIA') v ON k = ciudad_key WHERE k IS NULL
"""
ORACLE["duplicates_raw"] = f"WITH {RAW} SELECT id_venta, count(*) AS ocurrencias FROM raw GROUP BY id_venta HAVING count(*) > 1"
ORACLE["duplicates_incremental"] = f"""
WITH {RAW_WITH}, {_FIRST_GOOD}
SELECT g2.id_venta, CAST(g2.fecha AS VARCHAR) AS fecha, strftime(g1.fecha, '%Y-%m-%d %H:%M:%S') AS fecha_carga_original, 'DUPLICADO_INCREMENTAL' AS tipo_problema
FROM g2 JOIN g1 USING (id_venta)
"""
ORACLE["amount_mismatch"] = f"""
WITH {STAR}
SELECT id_venta, cantidad, CAST(precio_unitario AS DOUBLE) AS precio_unitario, CAST(monto_total AS DOUBLE) AS monto_total,
       CAST(cantidad * precio_unitario AS DOUBLE) AS monto_calculado, CAST(abs(monto_total - cantidad * precio_unitario) AS DOUBLE) AS diferencia
FROM fact WHERE abs(monto_total - cantidad * precio_unitario) > 0.01
"""
ORACLE["staging_footprint"] = f"""
WITH {RAW_WITH}
SELECT 'ventas_raw' AS tabla, count(*) AS registros, strftime(min(fecha_carga), '%Y-%m-%d %H:%M:%S') AS mas_antiguo, strftime(max(fecha_carga), '%Y-%m-%d %H:%M:%S') AS mas_reciente FROM raw
UNION ALL SELECT 'ventas_clean', count(*), strftime(min(fecha), '%Y-%m-%d %H:%M:%S'), strftime(max(fecha), '%Y-%m-%d %H:%M:%S') FROM good
"""
ORACLE["latest_quality"] = f"""
WITH {RAW}, la AS (
{_LOAD_LOG}
UNION ALL {_DUPS.format(name='UNIQUENESS:id_venta')}),
lb AS (
{_PROFILE_LOG}
UNION ALL {_DUPS.format(name='DUPLICATES:id_venta')}),
log AS (SELECT *, '2024-02-02 00:00:00' AS t FROM la UNION ALL SELECT *, '2024-02-01 00:00:00' FROM lb)
{_LOG_SELECT.replace('FROM log', ', t AS fecha_validacion FROM log ORDER BY t DESC, r LIMIT 20')}
"""
ORACLE["expired_rows"] = f"""
WITH {RAW}
SELECT id_batch, count(*) AS vencidas, strftime(max(fecha_carga), '%Y-%m-%d %H:%M:%S') AS ultima
FROM raw WHERE fecha_carga < TIMESTAMP '2026-06-01' - INTERVAL 365 DAY GROUP BY id_batch
"""

# ---- measures ---------------------------------------------------------------------

PLACE = "sales AS (SELECT f.*, n_name AS ciudad_venta, r_name AS region_ciudad FROM fact f JOIN places ON ciudad_key = n_nationkey)"
MONTHLY = ("months AS (SELECT ciudad_venta, CAST(date_trunc('month', fecha) AS DATE) AS mes, sum(monto_total) AS s, min(fecha) AS first_day "
           "FROM sales GROUP BY 1, 2)")
ORACLE["base_measures"] = f"""
WITH {STAR}, {PLACE}
SELECT region_ciudad, year(fecha) AS anio, CAST(sum(monto_total) AS DOUBLE) AS ventas_totales, count(*) AS total_transacciones,
       CAST(sum(monto_total) AS DOUBLE) / count(*) AS ticket_promedio, CAST(sum(cantidad) AS BIGINT) AS total_unidades,
       CAST(sum(monto_neto) AS DOUBLE) AS monto_neto_total, count(DISTINCT cliente_key) AS clientes_unicos,
       count(DISTINCT fecha) AS dias_con_ventas, CAST(sum(monto_total) AS DOUBLE) / count(DISTINCT fecha) AS ventas_promedio_diario
FROM sales GROUP BY 1, 2
"""
_LABEL = "strftime({0}, '%b %Y')"
ORACLE["mom"] = f"""
WITH {STAR}, {PLACE}, {MONTHLY}, j AS (
  SELECT a.*, b.s AS p, coalesce(CAST(a.s - coalesce(b.s, 0) AS DOUBLE) / nullif(CAST(b.s AS DOUBLE), 0), 0.0) AS g
  FROM months a LEFT JOIN months b ON a.ciudad_venta = b.ciudad_venta AND b.mes = a.mes - INTERVAL 1 MONTH)
SELECT ciudad_venta, CAST(mes AS VARCHAR) AS mes, {_LABEL.format('first_day')} AS etiqueta_mes, CAST(s AS DOUBLE) AS ventas,
       CAST(p AS DOUBLE) AS ventas_mes_anterior, CAST(s - coalesce(p, 0) AS DOUBLE) AS crecimiento_mom, g AS crecimiento_mom_pct,
       CASE WHEN g >= 0 THEN '▲ ' ELSE '▼ ' END || printf('%.1f%%', round(abs(g) * 100, 1)) AS variacion_mom_texto
FROM j
"""
ORACLE["yoy"] = f"""
WITH {STAR}, {PLACE}, {MONTHLY}
SELECT a.ciudad_venta, CAST(a.mes AS VARCHAR) AS mes, CAST(a.s AS DOUBLE) AS ventas, CAST(b.s AS DOUBLE) AS ventas_anio_anterior,
       coalesce(CAST(a.s - coalesce(b.s, 0) AS DOUBLE) / nullif(CAST(b.s AS DOUBLE), 0), 0.0) AS crecimiento_yoy_pct
FROM months a LEFT JOIN months b ON a.ciudad_venta = b.ciudad_venta AND b.mes = a.mes - INTERVAL 12 MONTH
"""
ORACLE["ytd"] = f"""
WITH {STAR}, {PLACE}, {MONTHLY}
SELECT a.ciudad_venta, CAST(a.mes AS VARCHAR) AS mes, CAST(a.s AS DOUBLE) AS ventas,
       (SELECT CAST(sum(b.s) AS DOUBLE) FROM months b WHERE b.ciudad_venta = a.ciudad_venta AND year(b.mes) = year(a.mes) AND b.mes <= a.mes) AS ventas_ytd,
       (SELECT CAST(sum(b.s) AS DOUBLE) FROM months b WHERE b.ciudad_venta = a.ciudad_venta AND year(b.mes) = year(a.mes) - 1 AND month(b.mes) <= month(a.mes)) AS ventas_ytd_anio_anterior
FROM months a
"""
ORACLE["shares"] = f"""
WITH {STAR}, {PLACE}, v AS (SELECT ciudad_venta, sum(monto_total) AS s FROM sales WHERE region_ciudad IN ('ASIA', 'EUROPE') GROUP BY 1)
SELECT ciudad_venta, CAST(s AS DOUBLE) AS ventas_totales, CAST(s AS DOUBLE) / (SELECT CAST(sum(monto_total) AS DOUBLE) FROM fact) AS participacion,
       CAST(s AS DOUBLE) / (SELECT CAST(sum(s) AS DOUBLE) FROM v) AS participacion_filtrada
FROM v
"""
ORACLE["dense_ranks"] = f"""
WITH {STAR}, r AS (
  SELECT 'ciudad' AS medida, n_name AS miembro, sum(monto_total) AS valor FROM fact JOIN places ON ciudad_key = n_nationkey GROUP BY 2
  UNION ALL SELECT 'vendedor', nombre_vendedor, sum(monto_total) FROM fact JOIN vendedor USING (vendedor_key) GROUP BY 2
  UNION ALL SELECT 'producto_monto', p_name, sum(monto_total) FROM fact JOIN part ON producto_key = p_partkey GROUP BY 2
  UNION ALL SELECT 'producto_unidades', p_name, sum(cantidad) FROM fact JOIN part ON producto_key = p_partkey GROUP BY 2)
SELECT medida, miembro, CAST(valor AS DOUBLE) AS valor, dense_rank() OVER (PARTITION BY medida ORDER BY valor DESC) AS ranking FROM r
"""
ORACLE["kpi_light"] = f"""
WITH {STAR}, m AS (SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes, sum(monto_total) AS s FROM fact GROUP BY 1),
t AS (SELECT 'calendar' AS base, CAST(sum(s) AS DOUBLE) / ((year(max(mes)) - year(min(mes)) + 1) * 12) * 1.05 AS meta FROM m
      UNION ALL SELECT 'active', CAST(sum(s) AS DOUBLE) / count(*) * 1.05 FROM m)
SELECT base, CAST(mes AS VARCHAR) AS mes, CAST(s AS DOUBLE) AS ventas, meta,
       CASE WHEN CAST(s AS DOUBLE) >= meta THEN 'Verde' WHEN CAST(s AS DOUBLE) >= meta * 0.90 THEN 'Amarillo' ELSE 'Rojo' END AS color_kpi
FROM m, t
"""
ORACLE["daily_average"] = f"""
WITH {STAR}, {PLACE}
SELECT region_ciudad, count(DISTINCT fecha) AS dias_con_ventas, CAST(sum(monto_total) AS DOUBLE) / count(DISTINCT fecha) AS ventas_por_dia
FROM sales GROUP BY 1
"""
ORACLE["max_month"] = f"""
WITH {STAR}, {PLACE}, {MONTHLY}
SELECT ciudad_venta, CAST(max(s) AS DOUBLE) AS max_ventas_periodo, {_LABEL.format('min(first_day)')} AS etiqueta_mes FROM months GROUP BY 1
"""
ORACLE["seller_own_sales"] = f"""
WITH {STAR}
SELECT CAST(sum(monto_total) AS DOUBLE) AS mis_ventas, count(*) AS ventas FROM fact
WHERE vendedor_key IN (SELECT vendedor_key FROM vendedor WHERE email_vendedor = 'v7@ventas.test')
"""

# ---- privacy and access -------------------------------------------------------------

_PHONE = "'300' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')"
_MAIL = "'cliente' || CAST(c_custkey AS VARCHAR) || '@mail.com'"
ORACLE["masked_customers"] = f"""
SELECT c_custkey AS cliente_key, '***@mail.com' AS email_mask, substr(n_name, 1, 1) || '. Anónimo' AS nombre_mask,
       'cliente_' || CAST(c_custkey AS VARCHAR) || '@anonimo.test' AS email_dev, '******' || right({_PHONE}, 4) AS telefono_dev,
       '***@mail.com' AS email_rep, '******' || right({_PHONE}, 4) AS telefono_rep
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
ORACLE["pseudonyms"] = f"SELECT c_custkey AS id_cliente, sha256({_MAIL} || 'sal-de-prueba') AS email_cliente FROM customer"
_STAR_PHONE = "CASE WHEN telefono_cliente IS NULL OR length(telefono_cliente) < 4 THEN '**********' ELSE repeat('*', length(telefono_cliente) - 4) || right(telefono_cliente, 4) END"
ORACLE["anonymised_sales"] = f"""
WITH {RAW_WITH}
SELECT id_venta, id_cliente, vendedor, 'cliente_' || CAST(id_cliente AS VARCHAR) || '@anonimo.test' AS email_cliente,
       {_STAR_PHONE} AS telefono_cliente, CAST(monto_total AS DOUBLE) AS monto_total FROM good
"""
ORACLE["anonymised_raw"] = f"""
WITH {RAW}
SELECT id_cliente, 'cliente_' || CAST(TRY_CAST(id_cliente AS BIGINT) AS VARCHAR) || '@anonimo.test' AS email_cliente,
       {_STAR_PHONE} AS telefono_cliente, count(*) AS filas FROM raw GROUP BY 1, 2, 3
"""
ORACLE["report_sales"] = f"""
WITH {RAW_WITH}
SELECT regexp_replace(email_cliente, '^[^@]+', '***') AS email_cliente, concat('******', right(telefono_cliente, 4)) AS telefono_cliente,
       count(*) AS filas, CAST(sum(monto_total) AS DOUBLE) AS monto_total
FROM good GROUP BY 1, 2
"""
ORACLE["erased_customers"] = f"""
WITH {HISTORY}, req AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal < -900)
SELECT cliente_key, id_cliente, CASE WHEN k IS NULL THEN email_cliente ELSE 'cliente_' || CAST(id_cliente AS VARCHAR) || '@anonimo.test' END AS email_cliente,
       CASE WHEN k IS NULL THEN telefono_cliente ELSE '**********' END AS telefono_cliente, ciudad
FROM merged LEFT JOIN req ON k = id_cliente
"""
ORACLE["portability_report"] = f"""
WITH {STAR}, req AS (SELECT c.*, c_custkey AS k, {_MAIL} AS mail, {_PHONE} AS phone FROM cliente c JOIN customer ON c_custkey = id_cliente WHERE c_acctbal < -900)
SELECT k AS id_cliente, 'id_cliente' AS campo, CAST(k AS VARCHAR) AS valor, 'dwh.dim_cliente' AS tabla_origen FROM req
UNION ALL SELECT k, 'email_cliente', mail, 'dwh.dim_cliente' FROM req WHERE actual
UNION ALL SELECT k, 'telefono_cliente', phone, 'dwh.dim_cliente' FROM req WHERE actual
UNION ALL SELECT k, 'ciudad', ciudad, 'dwh.dim_cliente' FROM req WHERE actual
UNION ALL SELECT k, 'venta_id_' || CAST(id_venta AS VARCHAR),
  'fecha=' || CAST(fecha AS VARCHAR) || ', monto=' || CAST(monto_total AS VARCHAR) || ', canal=' || nombre_canal || ', ciudad=' || n_name, 'dwh.fact_ventas'
FROM req JOIN fact USING (cliente_key) JOIN canal USING (canal_key) JOIN places ON ciudad_key = n_nationkey
"""
ORACLE["seller_rows"] = f"WITH {STAR} SELECT id_venta, vendedor_key, CAST(monto_total AS DOUBLE) AS monto_total FROM fact WHERE vendedor_key = 3"
ORACLE["region_rows"] = f"""
WITH {STAR}
SELECT vendedor_key, count(*) AS ventas, CAST(sum(monto_total) AS DOUBLE) AS monto_total FROM fact
WHERE vendedor_key IN (SELECT vendedor_key FROM vendedor WHERE region = (SELECT region FROM vendedor WHERE email_vendedor = 'v1@ventas.test'))
GROUP BY 1
"""
ORACLE["policy_rows"] = f"""
WITH {STAR}, users(usuario, rol) AS (VALUES ('v3@ventas.test', 'seller'), ('v1@ventas.test', 'report'), ('v2@ventas.test', 'manager'),
  ('jefe@ventas.test', 'admin'), ('nadie@ventas.test', 'report'), ('nadie@ventas.test', 'seller'), ('v4@ventas.test', 'otro'))
SELECT usuario, rol, vendedor_key, count(*) AS ventas, CAST(sum(monto_total) AS DOUBLE) AS monto_total
FROM users JOIN (fact LEFT JOIN vendedor v USING (vendedor_key)) ON rol = 'admin' OR (rol = 'seller' AND v.email_vendedor = usuario)
  OR (rol IN ('report', 'manager') AND v.region = (SELECT min(m.region) FROM vendedor m WHERE m.email_vendedor = usuario))
GROUP BY ALL
"""
ORACLE["policy_columns"] = f"""
SELECT 'admin' AS rol, c_custkey AS id_cliente, {_MAIL} AS email_cliente, {_PHONE} AS telefono_cliente FROM customer
UNION ALL SELECT 'report', c_custkey, '***@mail.com', '******' || right({_PHONE}, 4) FROM customer
UNION ALL SELECT unnest(['seller', 'otro']), c_custkey, NULL, NULL FROM customer
"""
ORACLE["role_columns"] = f"""
SELECT c_custkey AS id_cliente, '***@mail.com' AS email_cliente, '******' || right({_PHONE}, 4) AS telefono_cliente, {_MAIL} AS email_etl FROM customer
"""
ORACLE["access_log"] = f"""
WITH {HISTORY}
SELECT 'etl' AS usuario_db, 'DERECHO_AL_OLVIDO_COMPLETADO:id_cliente=' || CAST(id_cliente AS VARCHAR) AS tabla_accedida, 'DELETE' AS operacion, count(*) AS filas_afectadas
FROM merged WHERE id_cliente IN (SELECT c_custkey FROM customer WHERE c_acctbal < -900) GROUP BY id_cliente
"""

# ---- increments, streams, whole jobs ---------------------------------------------

ORACLE["watermark_increment"] = "SELECT event_id, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-20'"
ORACLE["stream_ingest"] = "SELECT event_id, user_id, event_type, value FROM events"
ORACLE["stream_daily"] = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dia, event_type, count(*) AS filas, round(sum(value), 4) AS total,
       CAST(CAST(ts AS DATE) + 1 <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY AS BIGINT) AS final
FROM events GROUP BY CAST(ts AS DATE), event_type
"""
_DAY_LOG = "\nUNION ALL ".join(
    f"SELECT CAST(fecha_carga AS DATE) AS dia, '{name}' AS r, count(*) AS n, count(*) FILTER ({bad}) AS bad FROM raw GROUP BY 1"
    for name, bad in _LOAD_CHECKS)
ORACLE["stream_quality"] = f"""
WITH {RAW}, log AS ({_DAY_LOG})
SELECT CAST(dia AS VARCHAR) AS dia, r AS regla_calidad, n AS registros_evaluados, n - bad AS registros_validos, bad AS registros_invalidos,
       round(avg(CAST(n - bad AS DOUBLE) / n) OVER (PARTITION BY dia), 4) AS score
FROM log
"""
ORACLE["customers_by_span"] = f"""
WITH {STAR}, s AS (SELECT r_name AS region, fecha, cliente_key FROM fact JOIN places ON ciudad_key = n_nationkey)
SELECT region, CAST(CAST(date_trunc('quarter', fecha) AS DATE) AS VARCHAR) AS desde, count(DISTINCT cliente_key) AS clientes_unicos, 'trimestre' AS tramo
FROM s GROUP BY ALL
UNION ALL SELECT region, CAST(CAST(date_trunc('year', fecha) AS DATE) AS VARCHAR), count(DISTINCT cliente_key), 'año' FROM s GROUP BY ALL
"""
_BATCHES = f"""
f1 AS (SELECT * FROM g1 WHERE fecha BETWEEN DATE '2020-01-01' AND DATE '2030-12-31'),
fresh AS (SELECT * FROM g2 WHERE id_venta NOT IN (SELECT id_venta FROM f1)),
f2 AS (SELECT * FROM fresh WHERE fecha BETWEEN DATE '2020-01-01' AND DATE '2030-12-31'),
state AS (
  SELECT 'raw' AS tabla, CASE archivo_origen WHEN 'ventas_raw.csv' THEN 'b1' ELSE 'b2' END AS id_batch, count(*) AS filas, CAST(0 AS DOUBLE) AS monto FROM raw GROUP BY 2
  UNION ALL SELECT 'clean', 'b1', count(*), CAST(sum(monto_total) AS DOUBLE) FROM g1
  UNION ALL SELECT 'clean', 'b2', count(*), CAST(sum(monto_total) AS DOUBLE) FROM fresh
  UNION ALL SELECT 'fact', 'b1', count(*), CAST(sum(monto_total) AS DOUBLE) FROM f1
  UNION ALL SELECT 'fact', 'b2', count(*), CAST(sum(monto_total) AS DOUBLE) FROM f2)
"""
# one load stamps all its rows alike, so arrival is the file order
_FILE_GOOD = _FIRST_GOOD.replace("fecha_carga, ", "")
# attributes of each customer's last sale of a batch; a batch opens versions for customers that are new or differ
_LAST = """SELECT id_cliente, nullif(trim(email_cliente), '') AS email_cliente, nullif(trim(telefono_cliente), '') AS telefono_cliente,
  nullif(trim(ciudad), '') AS ciudad
FROM (SELECT *, row_number() OVER (PARTITION BY id_cliente ORDER BY fecha DESC, id_venta DESC) AS k FROM {0}) WHERE k = 1"""
_VERSIONS = f"""
att1 AS ({_LAST.format('g1')}), att2 AS ({_LAST.format('fresh')}),
v1 AS (SELECT row_number() OVER (ORDER BY id_cliente) AS cliente_key, * FROM att1),
moved AS (
  SELECT att2.*, v1.cliente_key AS old_key FROM att2 LEFT JOIN v1 USING (id_cliente)
  WHERE v1.cliente_key IS NULL OR v1.email_cliente IS DISTINCT FROM att2.email_cliente
     OR v1.telefono_cliente IS DISTINCT FROM att2.telefono_cliente OR v1.ciudad IS DISTINCT FROM att2.ciudad),
versions AS (
  SELECT v1.cliente_key, v1.id_cliente, v1.email_cliente, v1.telefono_cliente, v1.ciudad, '2026-03-01' AS fecha_vigencia_desde,
         CASE WHEN old_key IS NOT NULL THEN '2026-03-01' END AS fecha_vigencia_hasta, CAST(old_key IS NULL AS BIGINT) AS es_registro_actual,
         'b1' AS id_batch_open, CASE WHEN old_key IS NOT NULL THEN 'b2' END AS id_batch_close
  FROM v1 LEFT JOIN moved ON old_key = v1.cliente_key
  UNION ALL
  SELECT (SELECT count(*) FROM g1) + row_number() OVER (ORDER BY id_cliente), id_cliente, email_cliente, telefono_cliente, ciudad,
         '2026-03-02', NULL, 1, 'b2', NULL FROM moved)
"""
ORACLE["batch_rerun"] = f"""
WITH {RAW_WITH}, {_FILE_GOOD}, {_BATCHES}, {_VERSIONS},
all_state AS (SELECT * FROM state UNION ALL SELECT 'cliente', id_batch_open, count(*), CAST(0 AS DOUBLE) FROM versions GROUP BY 2)
SELECT *, 1 AS corrida FROM all_state UNION ALL SELECT *, 2 FROM all_state
"""
ORACLE["customer_versions"] = f"WITH {RAW_WITH}, {_FILE_GOOD}, {_BATCHES}, {_VERSIONS} SELECT * FROM versions"
ORACLE["rollback_state"] = f"""
WITH {RAW_WITH}, {_FILE_GOOD}, {_BATCHES}
SELECT * FROM state WHERE id_batch = 'b1'
UNION ALL SELECT 'cliente', 'b1', count(DISTINCT id_cliente), CAST(0 AS DOUBLE) FROM g1
UNION ALL SELECT 'historia_rota', 'b1', 0, CAST(0 AS DOUBLE)
"""

_HOUSE = f"WITH {RAW_WITH}, {_FILE_GOOD}, {_BATCHES}, f AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2)"
ORACLE["warehouse_city_analysis"] = _HOUSE + """
SELECT rank() OVER (ORDER BY sum(monto_total) DESC) AS ranking_nacional, ciudad AS nombre_ciudad, count(*) AS total_transacciones,
       CAST(sum(monto_total) AS DOUBLE) AS monto_total, sum(cantidad) AS unidades_vendidas FROM f GROUP BY ciudad
"""
ORACLE["warehouse_seller_rows"] = _HOUSE + """,
t AS (SELECT vendedor, count(*) AS ventas, CAST(sum(monto_total) AS DOUBLE) AS monto_total FROM f GROUP BY 1)
SELECT 'seller' AS rol, vendedor AS nombre_vendedor, ventas, monto_total FROM t WHERE vendedor = 'Vendedor 3'
UNION ALL SELECT 'report', * FROM t WHERE vendedor <> 'SIN_ASIGNAR' AND CAST(split_part(vendedor, ' ', 2) AS INTEGER) % 2 = 0
UNION ALL SELECT 'admin', * FROM t
"""
ORACLE["run_log_state"] = _HOUSE + """,
n AS (SELECT 'b1' AS b, (SELECT count(*) FROM raw WHERE archivo_origen = 'ventas_raw.csv') AS seen,
             (SELECT count(*) FROM g1) AS good, (SELECT count(*) FROM f1) AS kept
      UNION ALL SELECT 'b2', (SELECT count(*) FROM raw WHERE archivo_origen = 'ventas_nuevas.csv'),
             (SELECT count(*) FROM fresh), (SELECT count(*) FROM f2))
SELECT b AS id_batch, p AS proceso, CASE WHEN p = 'fact' AND good > kept THEN 'PARCIAL' ELSE 'EXITOSO' END AS estado, 1 AS filas,
       CASE WHEN p IN ('extract', 'validate', 'clean') THEN seen WHEN p = 'cleanup' THEN 0 ELSE good END AS procesados
FROM n, (SELECT unnest(['extract', 'validate', 'clean', 'dimensions', 'fact', 'cleanup']) AS p)
UNION ALL SELECT 'b3', 'extract', 'EXITOSO', 2, 2 * (SELECT count(*) FROM raw WHERE archivo_origen = 'ventas_nuevas.csv' AND fecha = '')
UNION ALL SELECT 'b3', 'validate', 'FALLIDO', 2, 0
"""
ORACLE["key_index_state"] = _HOUSE + """
SELECT id_batch, count(*) AS llaves, count(DISTINCT (id_venta - 1) // 32768) AS grupos, min((id_venta - 1) // 32768 + 1) AS primero,
       max((id_venta - 1) // 32768 + 1) AS ultimo
FROM (SELECT 'b1' AS id_batch, id_venta FROM f1 UNION ALL SELECT 'b2', id_venta FROM f2) GROUP BY 1
"""
ORACLE["batch_footprint"] = _HOUSE + """
SELECT t.tabla, id_batch, filas AS registros, stamp AS mas_antiguo, stamp AS mas_reciente
FROM (SELECT *, CASE id_batch WHEN 'b1' THEN '2026-03-01 00:00:00' ELSE '2026-03-02 00:00:00' END AS stamp FROM state) s
JOIN (VALUES ('staging/ventas_raw', 'raw'), ('staging/ventas_clean', 'clean'), ('staging/ventas_llaves', 'clean'),
             ('dwh/fact_ventas', 'fact')) t(tabla, de) ON s.tabla = t.de
"""
ORACLE["quality_json"] = f"""
WITH {RAW_WITH}, {_FILE_GOOD}, rules AS (SELECT count(*) AS r FROM ({_LOAD_LOG}))
SELECT CASE archivo_origen WHEN 'ventas_raw.csv' THEN 'b1' ELSE 'b2' END AS id_batch,
       any_value(r) + 1 + CAST(any_value(archivo_origen) = 'ventas_nuevas.csv' AS BIGINT) AS reglas,
       (any_value(r) + 1 + CAST(any_value(archivo_origen) = 'ventas_nuevas.csv' AS BIGINT)) * count(*) AS evaluados
FROM raw, rules GROUP BY archivo_origen
"""
ORACLE["test_copy"] = _HOUSE + f""",
c AS (SELECT * FROM g1 UNION ALL SELECT * FROM fresh)
SELECT id_venta, 'cliente_' || CAST(id_cliente AS VARCHAR) || '@anonimo.test' AS email_cliente,
       {_STAR_PHONE} AS telefono_cliente, CAST(monto_total AS DOUBLE) AS monto_total FROM c
"""
ORACLE["erased_state"] = _HOUSE + f""",
r AS (SELECT {_int('id_cliente')} AS i FROM raw), c AS (SELECT id_cliente FROM g1 UNION ALL SELECT id_cliente FROM fresh)
SELECT 'raw' AS tabla, 'cliente_' || CAST(i AS VARCHAR) || '@anonimo.test' AS valor, count(*) AS filas FROM r WHERE i BETWEEN 2 AND 11 GROUP BY i
UNION ALL SELECT 'clean', 'cliente_' || CAST(id_cliente AS VARCHAR) || '@anonimo.test', count(*) FROM c WHERE id_cliente BETWEEN 2 AND 11 GROUP BY id_cliente
UNION ALL SELECT 'clientes con datos', '-', 0 UNION ALL SELECT 'auditoria', '-', 20
"""
ORACLE["retention_state"] = _HOUSE + """
SELECT 'staging/ventas_raw' AS tabla, 'b2' AS id_batch, count(*) AS filas FROM raw WHERE archivo_origen = 'ventas_nuevas.csv'
UNION ALL SELECT 'staging/ventas_clean', 'b2', count(*) FROM fresh
UNION ALL SELECT 'staging/ventas_llaves', 'b2', count(*) FROM fresh
UNION ALL SELECT 'control/rechazos', 'b2', (SELECT count(*) FROM judged WHERE archivo_origen = 'ventas_nuevas.csv' AND motivo IS NOT NULL)
       + (SELECT count(*) FROM g2) - (SELECT count(*) FROM fresh)
"""
_TOKEN = "nullif(nullif({0}, ''), 'NaN')"
ORACLE["csv_roundtrip"] = f"""
WITH {RAW}
SELECT {_TOKEN.format('id_venta')} AS id_venta, {_TOKEN.format('fecha')} AS fecha, {_TOKEN.format('id_cliente')} AS id_cliente,
       {_TOKEN.format('cantidad')} AS cantidad, {_TOKEN.format('precio_unitario')} AS precio_unitario, vendedor,
       {_TOKEN.format('canal')} AS canal, 'b1' AS id_batch, 1 AS con_origen FROM raw
"""
ORACLE["run_summary"] = _HOUSE + """
SELECT 'b2' AS id_batch, 'incremental' AS modo, (SELECT count(*) FROM raw WHERE archivo_origen = 'ventas_nuevas.csv') AS extraidos,
       (SELECT count(*) FROM fresh) AS limpios, (SELECT count(*) FROM f2) AS en_fact
"""
ORACLE["admin_rows"] = f"WITH {STAR} SELECT id_venta, vendedor_key, CAST(monto_total AS DOUBLE) AS monto_total FROM fact"


def _digest(part: str, sql: str, columns: str) -> str:
    """Rows and digest of a part of the report; of ``columns`` those marked with * are doubles."""
    said = " || '|' || ".join(f"coalesce(CAST({f'CAST({c[:-1]} AS DECIMAL(30,6))' if c.endswith('*') else c} AS VARCHAR), 'NULL')"
                              for c in sorted(columns.split()))
    return (f"SELECT '{part}' AS parte, count(*) AS filas, "
            f"CAST(sum(CAST('0x' || substr(md5({said}), 1, 7) AS BIGINT)) AS BIGINT) AS huella FROM ({sql})")


ORACLE["profile_report"] = " UNION ALL ".join(_digest(*part) for part in (
    ("stats", ORACLE["table_stats"], "total_registros total_columnas duplicados_id_venta filas_completamente_duplicadas"),
    ("por_columna", ORACLE["column_profile"], "columna nulos pct_nulos* distintos valor_mas_comun"),
    ("numericas", ORACLE["numeric_profile"], "columna min* max* media* mediana*"),
    ("issues", ORACLE["violations"], "regla campo id_venta valor tipo"),
    ("key_issues", f"WITH {RAW} SELECT id_venta, count(*) AS copias, 'DUPLICADO_ID_VENTA' AS tipo FROM raw GROUP BY id_venta "
                   "HAVING count(*) > 1", "id_venta copias tipo"),
    ("outliers", ORACLE["iqr_outliers"], "id_venta columna valor* tipo"),
    ("quality_log", ORACLE["profile_quality_log"], "regla_calidad registros_evaluados registros_validos registros_invalidos "
                                                   "porcentaje_calidad* detalles"),
    ("score", f"SELECT score, CAST(score >= 0.75 AS BIGINT) AS pass_threshold FROM ({ORACLE['quality_scores']}) WHERE formula = 'B'",
     "score* pass_threshold")))
