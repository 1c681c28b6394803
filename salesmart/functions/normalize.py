"""Parsing and normalising of raw text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted date layouts, year first or year last, one separator.
YEAR_LAST = r"^(\d{1,2})([-/])(\d{1,2})\2(\d{4})$"
YEAR_FIRST_SLASH = r"^(\d{4})/(\d{1,2})/(\d{1,2})$"
YEAR_FIRST = r"^\d{4}-\d{1,2}-\d{1,2}$"
WHOLE_NUMBER = r"^(-?\d+)(\.0+|E-10)?$"

# The sales channels by lower-case spelling.
CHANNELS = {"online": "Online", "tienda": "Tienda", "marketplace": "Marketplace"}

# Label of sales without a seller, e-mail and phone patterns.
UNASSIGNED = "SIN_ASIGNAR"
EMAIL_PATTERN = r"(?U)^[\w.-]+@[\w.-]+\.\w{2,}$"
PHONE_PATTERN = r"^\d{10}$"

# Texts a CSV reader of the Python data world treats as missing.
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                  "n/a", "nan", "null")


def missing_to_null(col: Column) -> Column:
    return F.when(~col.isin(*MISSING_TOKENS), col)


def is_blank(col: Column) -> Column:
    """Null, empty or only spaces; never null itself."""
    return F.coalesce(F.trim(col) == "", F.lit(True))


def clean_text(col: Column) -> Column:
    return F.trim(col)


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


# Dates, channels and whole numbers know the usual spellings by their bytes, at
# a fraction of the patterns' cost, and leave all other texts to the patterns;
# their input should be a column.

def normalize_date(col: Column) -> Column:
    """Date of a text in one of the layouts, null for anything else.

    The text is put in ISO order and cast; that is far cheaper than trying
    one parser after the other, each of which fails with an exception.
    """
    text = F.trim(col)
    part = lambda start, length: F.substring(text, start, length)
    joined = lambda *parts: F.concat_ws("-", *[part(*p) for p in parts])
    # ten bytes with separators in their places; the cast refuses all but digits, save at the ends, where it trims
    iso = F.when(F.octet_length(text) == 10,
                 F.when((part(5, 1) == "-") & (part(8, 1) == "-"), text)
                 .when((part(5, 1) == "/") & (part(8, 1) == "/"), joined((1, 4), (6, 2), (9, 2)))
                 .when(part(3, 1).isin("-", "/") & (part(3, 1) == part(6, 1)), joined((7, 4), (4, 2), (1, 2))))
    plain = F.substring(iso, 1, 1).between("0", "9") & F.substring(iso, -1, 1).between("0", "9")
    other = F.regexp_replace(text, YEAR_LAST, "$4-$3-$1")
    other = F.regexp_replace(other, YEAR_FIRST_SLASH, "$1-$2-$3")
    return F.when(plain, iso.try_cast("date")).otherwise(F.regexp_extract(other, YEAR_FIRST, 0).try_cast("date"))


def normalize_channel(col: Column) -> Column:
    """Known spellings become canonical, unknown ones pass trimmed, blank is null."""
    text = F.trim(col)
    other, out = text, F.when(text == "", F.lit(None).cast("string"))
    for spelling, name in CHANNELS.items():
        # as many bytes: letters outside ASCII that lower-case to one of it are not the spelling
        out = out.when((F.octet_length(text) == len(spelling)) & (F.lower(text) == spelling), name)
        other = F.regexp_replace(other, f"(?i)^{spelling}$", name)
    return out.otherwise(other)


def is_known_channel(col: Column) -> Column:
    return F.coalesce(F.lower(F.trim(col)).isin(*CHANNELS), F.lit(False))


def is_miscased_channel(col: Column) -> Column:
    return is_known_channel(col) & ~F.trim(col).isin(*CHANNELS.values())


def to_decimal(col: Column, dtype: str = "decimal(12,2)") -> Column:
    return F.trim(col).try_cast(dtype)


def to_number(col: Column) -> Column:
    """A wide decimal for rule checks; text that is no finite number is null."""
    return F.trim(col).try_cast("decimal(38,10)")


def to_integer(col: Column, dtype: str = "bigint") -> Column:
    """Whole numbers only: ``2`` and ``2.0`` pass, ``1.5`` and text are null."""
    text = F.trim(col)
    # digits from end to end, so far as the cast doesn't tell: it cuts off decimals and skips control characters
    plain = (text >= "-") & (text < ":") & F.substring(text, -1, 1).between("0", "9") & ~F.contains(text, F.lit("."))
    return F.coalesce(F.when(plain, text.try_cast(dtype)),
                      F.regexp_extract(to_number(col).cast("string"), WHOLE_NUMBER, 1).try_cast(dtype))


def seller_or_default(col: Column) -> Column:
    return F.coalesce(blank_to_null(col), F.lit(UNASSIGNED))


def is_valid_email(col: Column) -> Column:
    return F.coalesce(F.trim(col).rlike(EMAIL_PATTERN), F.lit(False))


def is_valid_phone(col: Column) -> Column:
    return F.coalesce(F.trim(col).rlike(PHONE_PATTERN), F.lit(False))


def channel_kind(name: Column) -> Column:
    return F.when(name == "Tienda", F.lit("Físico")).otherwise(F.lit("Digital"))


def product_label(product_id: Column) -> Column:
    return F.concat(F.lit("Producto "), product_id.cast("string"))
