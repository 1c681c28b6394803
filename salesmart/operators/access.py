"""Row filters, column policies and the access log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.functions import masking as M
from salesmart.schemas import ACCESS_LOG, ACCESS_OPERATIONS
from salesmart.session import broadcast_if_small

# What each role sees of the personal columns.
COLUMN_POLICY = {
    "admin": {"email_cliente": "visible", "telefono_cliente": "visible"},
    "etl": {"email_cliente": "visible", "telefono_cliente": "visible"},
    "report": {"email_cliente": "masked", "telefono_cliente": "masked"},
    "seller": {"email_cliente": "hidden", "telefono_cliente": "hidden"},
}
# Which sales each role sees; other roles see none.
ROW_POLICY = {"admin": "todo", "etl": "todo", "report": "region", "manager": "region", "seller": "propio"}
MASKS = {"email_cliente": M.report_email, "telefono_cliente": M.report_phone}


def _of_sellers(fact: DataFrame, sellers: DataFrame, bound: DataFrame) -> DataFrame:
    return fact.join(broadcast_if_small(sellers.select("vendedor_key"), bound), "vendedor_key", "left_semi")


def seller_rows(fact: DataFrame, sellers: DataFrame, user: str, bound: DataFrame | None = None) -> DataFrame:
    """Sales of the signed-in seller."""
    return _of_sellers(fact, sellers.where(F.col("email_vendedor") == user),
                       sellers if bound is None else bound)


def region_rows(fact: DataFrame, sellers: DataFrame, user: str, bound: DataFrame | None = None) -> DataFrame:
    """Sales of all sellers in the user's region; an unknown user sees nothing."""
    mine = sellers.where(F.col("email_vendedor") == user).agg(F.min("region"))
    return _of_sellers(fact, sellers.where(F.col("region") == mine.scalar()),
                       sellers if bound is None else bound)


def rows_for(role: str, fact: DataFrame, sellers: DataFrame, user: str,
             bound: DataFrame | None = None) -> DataFrame:
    """Row filter of a role; unknown roles see nothing."""
    if role in ("admin", "etl"):
        return fact
    if role in ("report", "manager"):
        return region_rows(fact, sellers, user, bound)
    if role == "seller":
        return seller_rows(fact, sellers, user, bound)
    return fact.where(F.lit(False))


def columns_for(role: str, df: DataFrame, policy: dict | None = None) -> DataFrame:
    """Visible, masked or dropped columns of a role; unknown roles lose all personal columns."""
    rules = (policy or COLUMN_POLICY).get(role, {c: "hidden" for c in MASKS})
    out = []
    for c in df.columns:
        how = rules.get(c, "visible")
        if how == "masked":
            out.append(MASKS[c](F.col(c)).alias(c))
        elif how == "visible":
            out.append(F.col(c))
    return df.select(*out)


def row_policy(spark: SparkSession) -> DataFrame:
    """(rol, alcance): the rows of a role, as a table that may be stored and changed."""
    return spark.createDataFrame(list(ROW_POLICY.items()), "rol string, alcance string")


def column_policy(spark: SparkSession) -> DataFrame:
    """(rol, columna, regla): what a role sees of the personal columns, as a table."""
    return spark.createDataFrame([(role, column, rule) for role, rules in COLUMN_POLICY.items() for column, rule in rules.items()],
                                 "rol string, columna string, regla string")


def grants(users: DataFrame, sellers: DataFrame, policy: DataFrame) -> DataFrame:
    """(usuario, rol, ambito) of ``users(usuario, rol)``: all sales, those of a region, or those of one seller.

    Users of roles without a policy, and sellers or regions that don't exist, get no row.
    """
    own = sellers.where("email_vendedor is not null").groupBy(F.col("email_vendedor").alias("usuario")).agg(F.min("region").alias("_region"))
    scope = (F.when(F.col("alcance") == "todo", "todo")
             .when(F.col("alcance") == "region", F.concat(F.lit("region:"), "_region"))
             .when((F.col("alcance") == "propio") & F.col("_mine"), F.concat(F.lit("propio:"), "usuario")))
    return (users.select("usuario", "rol").distinct().join(policy, "rol").join(own.withColumn("_mine", F.lit(True)), "usuario", "left")
            .select("usuario", "rol", scope.alias("ambito")).where("ambito is not null"))


def rows_of_users(fact: DataFrame, sellers: DataFrame, users: DataFrame, policy: DataFrame,
                  bound: DataFrame | None = None) -> DataFrame:
    """Each user's sales, with ``usuario`` and ``rol``: one plan and one scan of the fact for all users.

    A sale belongs to three scopes (all, its seller's region, its seller); the
    users' grants are joined on them. Sales without a known seller are seen by
    those who see all.
    """
    known = sellers.select("vendedor_key", "region", "email_vendedor")
    marked = fact.join(broadcast_if_small(known.withColumnsRenamed({"region": "_region", "email_vendedor": "_email"}),
                                          sellers if bound is None else bound), "vendedor_key", "left")
    scopes = F.array(F.lit("todo"), F.concat(F.lit("region:"), "_region"), F.concat(F.lit("propio:"), "_email"))
    spread = marked.select(*fact.columns, F.explode(F.array_compact(scopes)).alias("ambito"))
    return spread.join(broadcast_if_small(grants(users, sellers, policy), users), "ambito").drop("ambito")


def mask_by_role(rows: DataFrame, policy: DataFrame) -> DataFrame:
    """Personal columns of ``rows`` as the role in ``rol`` sees them: as they are, masked, or null where hidden or unknown."""
    rules = policy.groupBy("rol").agg(F.map_from_entries(F.collect_list(F.struct("columna", "regla"))).alias("_rules"))
    joined = rows.join(broadcast_if_small(rules, policy), "rol", "left")
    seen = {c: F.when(F.col("_rules")[c] == "visible", F.col(c)).when(F.col("_rules")[c] == "masked", mask(F.col(c)))
            for c, mask in MASKS.items() if c in rows.columns}
    return joined.withColumns(seen).select(*rows.columns)


def access_entry(spark: SparkSession, user: str, table: str, operation: str,
                 when: datetime, affected: int | None = None) -> DataFrame:
    """One summary row for a job that read or changed personal data."""
    if operation not in ACCESS_OPERATIONS:
        raise ValueError(f"operation must be one of {ACCESS_OPERATIONS}")
    return spark.createDataFrame([(user, table, operation, when, affected)], ACCESS_LOG)


def access_entries(counts: DataFrame, user: str, what: str, operation: str, when: datetime) -> DataFrame:
    """One row per customer of ``counts(_id, n)``: what was done to it, and to how many rows."""
    if operation not in ACCESS_OPERATIONS:
        raise ValueError(f"operation must be one of {ACCESS_OPERATIONS}")
    return counts.select(
        F.lit(user).alias("usuario_db"), F.concat(F.lit(f"{what}:id_cliente="), F.col("_id").cast("string")).alias("tabla_accedida"),
        F.lit(operation).alias("operacion"), F.lit(when).cast("timestamp").alias("fecha_hora"),
        F.col("n").cast("bigint").alias("filas_afectadas"))
