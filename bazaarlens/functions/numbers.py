"""Column functions that turn counts, fees and prices written as text into numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlens.constants import PRICE_SIGN

# A whole number that may carry decimals; group 1 is the part an int keeps.
_WHOLE_PART = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"


def to_int(text: Column) -> Column:
    """Text to int, dropping decimals; null for anything that is not a number or does not fit."""
    return F.regexp_extract(text, _WHOLE_PART, 1).try_cast("int")


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def k_number(text: Column, strict: bool = False) -> Column:
    """Spell out a shortened count: ``3,2k`` -> ``3200``, ``3k`` -> ``3000``.

    The default puts two zeros behind any comma number, whatever its digits (``3,25k`` -> ``32500``).
    ``strict`` reads the comma as a decimal point instead (``3,25k`` -> ``3250``).
    """
    if strict:
        scale = F.when(F.contains(text, F.lit("k")), 1000).otherwise(1)
        amount = F.replace(F.replace(text, F.lit("k"), F.lit("")), F.lit(","), F.lit("."))
        return F.try_multiply(amount.try_cast("decimal(28,6)"), scale).try_cast("bigint").cast("string")
    zeros = F.when(F.contains(text, F.lit(",")), F.lit("00")).otherwise(F.lit("000"))
    return F.replace(F.replace(text, F.lit("k"), zeros), F.lit(","), F.lit(""))


def k_int(text: Column, strict: bool = False) -> Column:
    return to_int(k_number(text, strict))


def price_text(text: Column) -> Column:
    """Digits behind the last price sign of a line; a range keeps its upper end."""
    return F.replace(F.regexp_replace(text, f".*{PRICE_SIGN}", ""), F.lit("."), F.lit(""))


def log_price(price: Column) -> Column:
    """Base-10 logarithm, null where the price is not positive."""
    return F.log10(price)


def price_from_log(value: Column) -> Column:
    return F.pow(F.lit(10.0), value)
