"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from payloom.functions import patterns as P

# The characters a Unicode strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NBSP = "\xa0"
# Texts that mean "no value".
TEXT_SENTINELS = ("N/A", "", "nan", "None", "NULL")
STAGING_SENTINELS = ("nan", "None")


def strip(c: Column) -> Column:
    """Trim every Unicode whitespace character from both ends (no regex)."""
    return F.trim(c, F.lit(WHITESPACE))


def null_if_in(c: Column, values: tuple[str, ...]) -> Column:
    return F.when(~c.isin(*values), c)


def _visible_ascii(c: Column) -> Column:
    return (c >= "!") & (c < "\x7f")


def clean_text(c: Column) -> Column:
    """Strip, delete every NBSP, then map the sentinel texts to NULL.

    Texts with visible ASCII characters at both ends and no NBSP, nearly all, need no cleaning;
    comparing the ends costs a tenth of a trim, which tries each whitespace character in turn.
    """
    clean = _visible_ascii(c) & _visible_ascii(F.right(c, F.lit(1))) & ~c.contains(NBSP)
    cleaned = F.replace(strip(c), F.lit(NBSP), F.lit(""))
    return F.when(clean, null_if_in(c, TEXT_SENTINELS)).otherwise(null_if_in(cleaned, TEXT_SENTINELS))


def sentinel_to_null(c: Column) -> Column:
    return null_if_in(c, STAGING_SENTINELS)


def clean_digits(c: Column) -> Column:
    """Keep digits only; '' when there is none."""
    return F.regexp_replace(c, P.NO_DIGIT, "")


def clean_cpf(c: Column) -> Column:
    """Keep digits only; NULL when there is none."""
    return F.when(c.rlike(P.ANY_DIGIT), clean_digits(c))


def name_suffix_strip(name: Column, status: Column) -> Column:
    """Drop a trailing status and then a trailing ``label:`` token from a name."""
    ends = F.lower(name).endswith(F.lower(status))
    without = (
        F.when(status.isNull(), name)
        .when(status == "", F.lit(""))
        .when(ends, strip(F.left(name, F.length(name) - F.length(status))))
        .otherwise(name)
    )
    # a name without a colon has no label, and needs no search for one
    return strip(F.when(name.contains(":"), F.regexp_replace(without, P.NOME_LABEL_END, "")).otherwise(without))


def one_line(c: Column) -> Column:
    return strip(F.replace(c, F.lit("\n"), F.lit(" ")))


def null_name_salt(key: Column, *spread_by: Column) -> Column:
    """Join key that spreads NULL keys over tasks; salted values match no digit key.

    NULL keys never match anyway, but all of them hash to one shuffle partition.
    """
    return F.coalesce(key, F.concat(F.lit("\x00"), F.xxhash64(*spread_by).cast("string")))
