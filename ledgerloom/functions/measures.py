"""Numbers, times and keys."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import _col

# Fixed values.
KJ_PER_KCAL = Decimal("4.184")
LIQUID_UNITS = ("ml", "cl", "l")
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"

# 18 decimals hold the digits of a float written as text; times a 3-decimal
# factor the result is exactly DECIMAL(38,21), so nothing is rounded.
AMOUNT = T.DecimalType(33, 18)
CONVERTED = T.DecimalType(38, 21)
AMOUNT_LIMIT = 1e15  # what has more than 15 whole digits does not fit, and is carried as a double


def to_amount(column: Column | str) -> Column:
    """Exact decimal, NULL where the text is no number or has over 15 whole digits."""
    return _col(column).try_cast(AMOUNT)


def finite(column: Column | str) -> Column:
    """The number as a double; NULL where there is none, or none that is finite."""
    number = _col(column).try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def large_amount(column: Column | str) -> Column:
    """The number, as a double, if the exact decimal can't hold it."""
    number = finite(column)
    return F.when(F.abs(number) >= AMOUNT_LIMIT, number)


def epoch_to_timestamp(column: Column | str) -> Column:
    return F.timestamp_seconds(_col(column))


def surrogate_key(*columns: Column | str) -> Column:
    """32 hex digits over the parts; a NULL part has its own marker."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def _in_kcal(name: Column | str, unit: Column | str) -> Column:
    return (_col(name) == "energy") & (F.lower(_col(unit)) == "kcal")


def energy_in_kj(name: Column | str, unit: Column | str, amount: Column | str) -> Column:
    """The generic energy entry converted from kcal; every other amount unchanged."""
    amount = _col(amount)
    converted = amount * F.lit(KJ_PER_KCAL)
    return F.when(_in_kcal(name, unit), converted).otherwise(amount.cast(CONVERTED))


def large_energy_in_kj(name: Column | str, unit: Column | str, amount: Column | str) -> Column:
    """The same for an amount that is carried as a double."""
    amount = _col(amount)
    return F.when(_in_kcal(name, unit), amount * float(KJ_PER_KCAL)).otherwise(amount)


def nutrition_basis(stated: Column | str, unit: Column | str) -> Column:
    """A stated basis first, then a liquid unit, then 100g."""
    stated = _col(stated)
    return (
        F.when(stated == "100ml", "100ml")
        .when(stated == "100g", "100g")
        .when(F.lower(_col(unit)).isin(*LIQUID_UNITS), "100ml")
        .otherwise("100g")
    )


def outside_tolerance(
    value: Column | str, part: Column | str, ratio: str, relative: str, absolute: str
) -> Column:
    """``value`` differs from ``part * ratio`` by more than both tolerances allow."""
    value, part = _col(value), _col(part)
    allowed = F.greatest(value * F.lit(Decimal(relative)), F.lit(Decimal(absolute)))
    return F.abs(value - part * F.lit(Decimal(ratio))) > allowed


def older_than(timestamp: Column | str, as_of: dt.datetime, hours: int) -> Column:
    """``as_of`` is an argument, so a check gives the same answer when run again."""
    limit = F.lit(as_of).cast("timestamp") - F.expr(f"interval {hours} hours")
    return _col(timestamp) < limit
