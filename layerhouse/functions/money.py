"""Amounts: always decimal, never floating point."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Tax rate in percent by product category; every other category pays the default.
TAX_RATE_BY_CATEGORY = {
    "Vini": 22,
    "Pulizia Casa": 22,
    "Cancelleria": 22,
    "Carne": 10,
    "Pesce": 10,
}
TAX_RATE_DEFAULT = 4

# Fixed value: the divisor that takes the flat rate out of a gross amount.
FLAT_NET_RATE = Decimal("1.10")


def net_amount(gross: Column, divisor: Column | Decimal = FLAT_NET_RATE) -> Column:
    """Gross amount without tax: a flat divisor, or one per row."""
    if isinstance(divisor, Decimal):
        divisor = F.lit(divisor).cast("decimal(5,4)")
    return F.round(gross / divisor, 2).cast("decimal(12,2)")


def tax_divisor(percent: Column) -> Column:
    """1.22 for a rate of 22 percent."""
    return (F.lit(1) + percent.cast("decimal(5,2)") / F.lit(100)).cast("decimal(5,4)")


def line_amount(quantity: Column, unit_price: Column) -> Column:
    return F.round(quantity.cast("int") * unit_price.cast("decimal(10,2)"), 2).cast("decimal(10,2)")


def lookup_rate(category: Column, rates: dict[str, int], default: int) -> Column:
    """Rate of a category; a small fixed table becomes one CASE expression."""
    chain = None
    for rate in sorted(set(rates.values())):
        hit = category.isin(*[c for c, r in rates.items() if r == rate])
        chain = F.when(hit, rate) if chain is None else chain.when(hit, rate)
    chosen = F.lit(default) if chain is None else chain.otherwise(default)
    return chosen.cast("int")
