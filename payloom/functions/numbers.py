"""Number expressions; nothing here throws, bad input becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from payloom.functions.patterns import ascii_digits
from payloom.functions.text import strip

MONEY = (12, 2)
STAGING_MONEY = (10, 2)
# Fixed value: float literal grammar (underscores only between digits).
_FLOAT = (
    r"^[+-]?(?:\d+(?:_\d+)*(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)"
    r"(?:[eE][+-]?\d+(?:_\d+)*)?$"
)


def brl_number(c: Column) -> Column:
    """Digits of any script with ``.`` thousands and ``,`` decimals -> double (pattern captures)."""
    plain = F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    # a text with digits of another script is no number before they are ASCII
    return F.coalesce(plain.try_cast("double"), ascii_digits(c, ",.", ".").try_cast("double"))


def parse_brl_money(c: Column) -> Column:
    """``R$ 1.234,56`` -> 1234.56; every dot is a thousands mark; NULL if unreadable."""
    plain = ascii_digits(strip(F.replace(c, F.lit("R$"), F.lit(""))), ",.", ".")
    return F.when(plain.rlike(_FLOAT), F.replace(plain, F.lit("_"), F.lit("")).try_cast("double"))


def parse_money_variant(v: Column) -> Column:
    """Money from a JSON value: numbers pass through, strings use the BRL rules."""
    kind = F.schema_of_variant(v)
    return (
        F.when(kind == "STRING", parse_brl_money(F.try_variant_get(v, "$", "string")))
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double"))
        .otherwise(F.try_variant_get(v, "$", "double"))
    )


def to_decimal_safe(c: Column, precision: int = 10, scale: int = 2) -> Column:
    """Half-up decimal; blank, invalid and out-of-range values become NULL."""
    return c.try_cast(f"decimal({precision},{scale})")


def decimal_or_reject(c: Column, precision: int = 10, scale: int = 2) -> Column:
    """``(value, lost)``: the decimal, and the text of an amount that it cannot hold."""
    value = to_decimal_safe(c, precision, scale)
    return F.struct(value.alias("value"), F.when(c.isNotNull() & value.isNull(), c.cast("string")).alias("lost"))


def safe_numeric_cast(c: Column, precision: int = 12, scale: int = 2) -> Column:
    """Keep ``0-9 . -`` of a text, then cast; NULL when nothing readable is left."""
    return F.regexp_replace(c, "[^0-9.-]", "").try_cast(f"decimal({precision},{scale})")


def nullable_int(c: Column) -> Column:
    return c.try_cast("double").try_cast("bigint")


def to_boolean(c: Column) -> Column:
    return c.try_cast("boolean")
