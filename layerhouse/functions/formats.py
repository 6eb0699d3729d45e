"""Formatted business keys and times. The formats are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def digits(number: Column, width: int) -> Column:
    """Zero-padded whole number; one wider than ``width`` keeps all its digits."""
    text = number.cast("bigint").cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), digits(number, width))


def store_key(region: Column, number: Column) -> Column:
    return F.concat(F.lit("IT-"), region, F.lit("-"), digits(number, 3))


def product_key(number: Column) -> Column:
    return padded("P-", number, 5)


def loyalty_card(number: Column) -> Column:
    return padded("TF-", number, 6)


def order_key(number: Column) -> Column:
    return padded("ORD-", number, 7)


def time_of_day(hour: Column, minute: Column) -> Column:
    return F.concat(digits(hour, 2), F.lit(":"), digits(minute, 2), F.lit(":00"))
