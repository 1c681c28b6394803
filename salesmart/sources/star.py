"""The star schema as a set of DataFrames, and its mapping from order tables."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.functions.dates import date_key
from salesmart.operators.calendar import calendar_of, days_between
from salesmart.session import broadcast_if_small

# Column types of the order tables; naming them saves a footer read per table.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}



class Star:
    """Fact, six dimensions, and the table that bounds the size of each dimension.

    Subclasses or instances provide ``fact`` and the dimensions by name.
    """

    bounds: dict[str, DataFrame] = {}

    def __init__(self, **tables: DataFrame):
        self.__dict__.update(tables)

    def bound(self, dim: str) -> DataFrame:
        """A table the dimension cannot outgrow."""
        return self.bounds.get(dim, getattr(self, dim))

    def lookup(self, dim: str) -> DataFrame:
        """The dimension, broadcast when its bound is checked and small."""
        return broadcast_if_small(getattr(self, dim), self.bound(dim))

    def sales(self, *dims: str) -> DataFrame:
        """Fact rows with date, customer, product, seller, channel, and the named dimensions."""
        return self.fact

    def totals(self, *dims: str) -> DataFrame:
        """Fact at the coarsest grain that has date, customer, channel, and the named dimensions."""
        return self.fact


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _line_measures(line: DataFrame) -> DataFrame:
    money = F.col("l_extendedprice").cast("decimal(15,2)")
    discount = (money * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(15,2)")
    taxes = ((money - discount) * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(15,2)")
    units = F.col("l_quantity").cast("int")
    return line.select(
        "l_orderkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_venta"),
        F.col("l_partkey").alias("producto_key"), F.col("l_suppkey").alias("vendedor_key"),
        units.alias("cantidad"), (money / units).cast("decimal(12,2)").alias("precio_unitario"),
        money.alias("monto_total"), discount.alias("descuento"), taxes.alias("impuestos"),
        (money - discount + taxes).cast("decimal(15,2)").alias("monto_neto"))


class OrderStar(Star):
    """The order tables of ``sf_dir`` read as a sales star; parts are built when used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)

    @cached_property
    def bounds(self) -> dict[str, DataFrame]:
        # one decimal digit is the channel key, so there are at most ten channels
        return {"cliente": self.table("customer"), "producto": self.table("part"),
                "vendedor": self.table("supplier"), "ciudad": self.table("nation"),
                "canal": self.spark.range(10)}

    @cached_property
    def _lines(self) -> DataFrame:
        return _line_measures(self.table("lineitem"))

    def _orders(self, dims: tuple[str, ...]) -> DataFrame:
        """Orders; the city hangs on the customer, so that join is only made when asked for."""
        day = F.col("o_orderdate").cast("date")
        orders, city = self.table("orders"), []
        if "ciudad" in dims:
            city = [F.col("c_nationkey").alias("ciudad_key")]
            orders = orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return orders.select(
            "o_orderkey", F.col("o_custkey").alias("cliente_key"), *city,
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("canal_key"),
            date_key(day).alias("fecha_key"), day.alias("fecha_venta"),
            F.concat(F.lit("b"), F.year(day)).alias("id_batch"))

    @cached_property
    def fact(self) -> DataFrame:
        return self.sales("ciudad")

    def lines(self) -> DataFrame:
        """Line items with product, seller and amounts only: no join with orders."""
        return self._lines.drop("l_orderkey")

    def sales(self, *dims: str) -> DataFrame:
        return (self._lines.join(self._orders(dims), F.col("l_orderkey") == F.col("o_orderkey"))
                .drop("l_orderkey", "o_orderkey"))

    def totals(self, *dims: str) -> DataFrame:
        """Line items summed per order *before* the join with orders.

        The sum runs map-side, the join reuses its partitioning, and a giant
        order is one row by then.
        """
        per_order = self._lines.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_ventas"), F.sum("cantidad").alias("cantidad"),
            F.sum("monto_total").cast("decimal(18,2)").alias("monto_total"),
            F.sum("monto_neto").cast("decimal(18,2)").alias("monto_neto"))
        return (per_order.join(self._orders(dims), F.col("l_orderkey") == F.col("o_orderkey"))
                .drop("l_orderkey", "o_orderkey"))

    @cached_property
    def _places(self) -> DataFrame:
        return (self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .select("n_nationkey", "n_name", "r_name"))

    def _near(self) -> DataFrame:
        return broadcast_if_small(self._places, self.table("nation"))

    @cached_property
    def fecha(self) -> DataFrame:
        """All days of the years that have orders."""
        day = F.col("o_orderdate").cast("date")
        years = self.table("orders").agg(
            F.trunc(F.min(day), "year").alias("a"),
            F.last_day(F.add_months(F.trunc(F.max(day), "year"), 11)).alias("b"))
        return calendar_of(days_between(years, "a", "b"))

    @cached_property
    def ciudad(self) -> DataFrame:
        return self._places.select(
            F.col("n_nationkey").alias("ciudad_key"), F.col("n_name").alias("nombre_ciudad"),
            F.concat(F.lit("Departamento "), "n_name").alias("departamento"),
            F.col("r_name").alias("region"))

    @cached_property
    def cliente(self) -> DataFrame:
        return self.table("customer").join(self._near(), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("cliente_key"), F.col("c_custkey").alias("id_cliente"),
            F.concat(F.lit("cliente"), "c_custkey", F.lit("@mail.com")).alias("email_cliente"),
            F.concat(F.lit("300"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("telefono_cliente"),
            F.col("n_name").alias("ciudad"), F.lit(date(1990, 1, 1)).alias("fecha_vigencia_desde"),
            F.lit(None).cast("date").alias("fecha_vigencia_hasta"),
            (F.col("c_mktsegment") != "HOUSEHOLD").alias("es_registro_actual"))

    @cached_property
    def producto(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("producto_key"), F.col("p_partkey").alias("id_producto"),
            F.col("p_name").alias("nombre_producto"), F.col("p_type").alias("categoria"),
            F.col("p_brand").alias("subcategoria"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("precio_referencia"))

    @cached_property
    def vendedor(self) -> DataFrame:
        return self.table("supplier").join(self._near(), F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("vendedor_key"),
            F.when(F.col("s_acctbal") < 0, "SIN_ASIGNAR").otherwise(F.col("s_name")).alias("nombre_vendedor"),
            F.col("n_name").alias("ciudad_base"), F.col("r_name").alias("region"),
            F.concat(F.lit("v"), "s_suppkey", F.lit("@ventas.test")).alias("email_vendedor"))

    @cached_property
    def canal(self) -> DataFrame:
        priority = F.col("o_orderpriority")
        digit = F.substring(priority, 1, 1).cast("bigint")
        # distinct first: it hashes, while the smallest text of a group is found by sorting
        return (self.table("orders").select(priority, digit.alias("canal_key")).distinct()
                .groupBy("canal_key").agg(F.min(priority).alias("nombre_canal"))
                .select("canal_key", "nombre_canal",
                        F.when(F.col("canal_key") == 5, "Físico").otherwise("Digital").alias("tipo_canal"),
                        (F.col("canal_key") - 1).cast("decimal(5,2)").alias("comision_pct")))


def order_star(spark: SparkSession, sf_dir: str) -> OrderStar:
    return OrderStar(spark, sf_dir)
