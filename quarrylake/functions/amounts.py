"""Units, money, ratios and coordinates."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Euros per unit of a currency; any other currency is left as is.
EUR_RATES = {"SEK": Decimal("0.088")}


def metres(text: Column) -> Column:
    """Distance text in metres: `0.35km` is 350, a bare number is taken as metres.

    Kilometres go through a decimal so that the product is exact; a negative
    distance is a sign error and is repaired, unreadable text is null.
    """
    kilometres = F.trim(text, F.lit("km ")).try_cast("decimal(20,6)")
    value = F.when(text.contains("km"), (kilometres * F.lit(1000)).cast("double")).otherwise(
        text.try_cast("double")
    )
    return F.abs(value)


def in_euros(amount: Column, currency: Column, rates: Mapping[str, Decimal] = EUR_RATES) -> Column:
    """Amount times its currency's rate; unlisted and missing currencies stay unchanged."""
    rate = F.coalesce(*[F.when(currency == code, F.lit(r)) for code, r in rates.items()])
    return F.when(rate.isNotNull(), amount * rate).otherwise(amount)


def from_minor_units(minor: Column) -> Column:
    """Cents to a two-digit decimal, exactly."""
    return (minor.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).try_cast("decimal(10,2)")


def as_fraction(value: Column) -> Column:
    """A ratio on the 0-1 scale; values above one are percentages."""
    share = F.when(value > 1, value * F.lit(Decimal("0.01"))).otherwise(value)
    return share.try_cast("decimal(10,4)")


def off_null_island(value: Column, lat: Column, lon: Column) -> Column:
    """Null where both coordinates are zero, the mark of a device without a fix."""
    return F.when((lat == 0) & (lon == 0), None).otherwise(value)
