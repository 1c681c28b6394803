"""Masking and pseudonym expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from salesmart.functions.normalize import UNASSIGNED

# What replaces a personal value.
PHONE_STARS = "**********"
FAKE_EMAIL_DOMAIN = "@anonimo.test"
NAME_SUFFIX = ". Anónimo"


def mask_email(col: Column) -> Column:
    """Keep the domain; null and empty give null."""
    return F.when(col != "", F.concat(F.lit("***@"), F.split_part(col, F.lit("@"), F.lit(2))))


def mask_phone(col: Column) -> Column:
    """Keep the last four characters; null or shorter gives ten stars."""
    masked = F.concat(F.repeat(F.lit("*"), F.length(col) - 4), F.right(col, F.lit(4)))
    return F.when(F.length(col) >= 4, masked).otherwise(PHONE_STARS)


def fake_email(customer_id: Column) -> Column:
    """A made-up address that is the same for the same customer."""
    return F.concat(F.lit("cliente_"), customer_id.try_cast("bigint").cast("string"),
                    F.lit(FAKE_EMAIL_DOMAIN))


def mask_name(col: Column) -> Column:
    initial = F.concat(F.substring(F.trim(col), 1, 1), F.lit(NAME_SUFFIX))
    return F.when(col.isNull() | (col == "") | (col == UNASSIGNED), col).otherwise(initial)


def pseudonym(col: Column, salt: str) -> Column:
    """Salted SHA-256 in hex; the salt comes from configuration."""
    if not salt:
        raise ValueError("a salt is required")
    return F.sha2(F.concat(col, F.lit(salt)), 256)


def report_email(col: Column) -> Column:
    """Report variant: the part before the @ becomes three stars."""
    return F.regexp_replace(col, "^[^@]+", "***")


def report_phone(col: Column) -> Column:
    """Report variant: always six stars, then the last four characters if any."""
    return F.concat_ws("", F.lit("******"), F.right(col, F.lit(4)))
