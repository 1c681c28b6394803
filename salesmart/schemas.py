"""Table schemas of the warehouse, as DDL text."""

from __future__ import annotations

BUSINESS_COLUMNS = ("id_venta", "fecha", "id_cliente", "id_producto", "cantidad",
                    "precio_unitario", "canal", "ciudad", "vendedor",
                    "email_cliente", "telefono_cliente")


RAW_CSV = ", ".join(f"{name} string" for name in BUSINESS_COLUMNS)

RAW = (RAW_CSV + ", fecha_carga timestamp, archivo_origen string, row_seq bigint, id_batch string")

CLEAN = (
    "id_venta bigint, fecha date, id_cliente bigint, id_producto bigint, cantidad int, "
    "precio_unitario decimal(12,2), canal string, ciudad string, vendedor string, "
    "email_cliente string, telefono_cliente string, monto_total decimal(15,2), "
    "fecha_procesamiento timestamp, id_batch string")

REJECTED = "id_venta string, motivo string, fecha_rechazo timestamp, id_batch string"

# attributes that an edit in place replaced, so that a rollback can bring them back
PREVIOUS = (
    "cliente_key bigint, id_cliente bigint, email_cliente string, telefono_cliente string, ciudad string, "
    "fecha_actualizacion timestamp, fecha_edicion timestamp, id_batch string")

# keys reserved for a batch: above ``desde`` up to ``hasta``; never given again
KEY_MARK = "tabla string, desde bigint, hasta bigint, id_batch string"

CUSTOMER = (
    "cliente_key bigint, id_cliente bigint, email_cliente string, telefono_cliente string, "
    "ciudad string, fecha_vigencia_desde date, fecha_vigencia_hasta date, "
    "es_registro_actual boolean, fecha_creacion timestamp, fecha_actualizacion timestamp, "
    "id_batch_open string, id_batch_close string")

PRODUCT = (
    "producto_key bigint, id_producto bigint, nombre_producto string, categoria string, "
    "subcategoria string, precio_referencia decimal(12,2), unidad_medida string, activo boolean")

SELLER = (
    "vendedor_key bigint, nombre_vendedor string, ciudad_base string, region string, "
    "zona string, fecha_ingreso date, estado string, email_vendedor string")

CHANNEL = (
    "canal_key bigint, nombre_canal string, tipo_canal string, descripcion string, "
    "comision_pct decimal(5,2)")

CITY = (
    "ciudad_key bigint, nombre_ciudad string, departamento string, region string, "
    "poblacion int, latitud decimal(9,6), longitud decimal(9,6)")

FACT = (
    "venta_key bigint, id_venta bigint, fecha_key int, cliente_key bigint, producto_key bigint, "
    "vendedor_key bigint, canal_key bigint, ciudad_key bigint, cantidad int, "
    "precio_unitario decimal(12,2), monto_total decimal(15,2), descuento decimal(10,2), "
    "impuestos decimal(10,2), monto_neto decimal(15,2), fecha_venta date, "
    "fecha_carga timestamp, id_batch string")

RUN_LOG = (
    "proceso string, fecha_inicio timestamp, fecha_fin timestamp, estado string, "
    "registros_procesados bigint, registros_exitosos bigint, registros_fallidos bigint, "
    "mensaje_error string, id_batch string")

QUALITY_LOG = (
    "tabla_origen string, regla_calidad string, fecha_validacion timestamp, "
    "registros_evaluados bigint, registros_validos bigint, registros_invalidos bigint, "
    "porcentaje_calidad double, detalles string, id_batch string")

ACCESS_LOG = (
    "usuario_db string, tabla_accedida string, operacion string, fecha_hora timestamp, "
    "filas_afectadas bigint")

RUN_STATES = ("INICIADO", "EXITOSO", "PARCIAL", "FALLIDO", "REVERTIDO")
SELLER_STATES = ("Activo", "Inactivo", "Vacaciones")
ACCESS_OPERATIONS = ("SELECT", "INSERT", "UPDATE", "DELETE")
