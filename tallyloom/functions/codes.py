"""Security codes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exchange by code prefix, first match wins.
EXCHANGE_BY_PREFIX = (
    ("6", "sh"),
    ("0", "sz"),
    ("3", "sz"),
    ("8", "bj"),
    ("4", "bj"),
    ("92", "bj"),
)
DEFAULT_EXCHANGE = "sz"

_BLANKS = " \t\n\r\f\v"


def exchange(code: Column) -> Column:
    """Lower-case exchange of a bare code; null for a null code."""
    branches = F.when(code.isNull(), None)
    for prefix, name in EXCHANGE_BY_PREFIX:
        branches = branches.when(code.startswith(prefix), name)
    return branches.otherwise(DEFAULT_EXCHANGE)


def full_symbol(code: Column, form: str = "prefix") -> Column:
    """``sh600000`` for the prefix form, ``600000.SH`` for ``suffix`` or ``hz``."""
    if form.lower() in ("suffix", "hz"):
        return F.concat(code, F.lit("."), F.upper(exchange(code)))
    return F.concat(exchange(code), code)


def strip_exchange(code: Column) -> Column:
    """Remove every ``sh``, then every ``sz``, then surrounding blanks."""
    bare = F.replace(F.replace(code, F.lit("sh"), F.lit("")), F.lit("sz"), F.lit(""))
    return F.btrim(bare, F.lit(_BLANKS))


def strip_to_suffix(code: Column) -> Column:
    """Stripped code with a two-exchange suffix: ``.SH`` for 6xxxxx, ``.SZ`` for the rest."""
    bare = strip_exchange(code)
    return F.concat(bare, F.when(bare.startswith("6"), ".SH").otherwise(".SZ"))


def first_digits(text: Column) -> Column:
    """First run of digits, null when there is none."""
    return F.regexp_substr(text, F.lit(r"\d+"))
