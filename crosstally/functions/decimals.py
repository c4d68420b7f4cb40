"""Exact decimal expressions.

Spark trims the scale of a decimal result whose precision would pass 38 digits.
The helpers narrow one operand first, so that no digit of the result is lost.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(20, 8)
RATE = DecimalType(18, 10)
USD = DecimalType(38, 18)

_USD_OPERAND = DecimalType(37, 18)
_FRACTION = DecimalType(17, 12)
_MAX_EXPONENT = 8


def tolerant(text: Column | str, dtype: DecimalType = MONEY) -> Column:
    """Text to decimal; unreadable text becomes NULL instead of failing the job."""
    return _col(text).try_cast(dtype)


def decimal_comma(text: Column | str, dtype: DecimalType = MONEY) -> Column:
    """Tolerant cast of numbers written with a decimal comma."""
    return F.replace(_col(text), F.lit(","), F.lit(".")).try_cast(dtype)


def minor_to_major(amount: Column | str, exponent: Column | str) -> Column:
    """Shift an integer count of minor units by a power of ten, 0 to 8 digits, exactly."""
    digits = _col(exponent).try_cast("smallint")
    factors = F.array(*(F.lit(Decimal(1).scaleb(-k)).cast(DecimalType(9, 8)) for k in range(_MAX_EXPONENT + 1)))
    power = F.when(digits.between(0, _MAX_EXPONENT), F.try_element_at(factors, digits + 1))
    units = _col(amount).try_cast(DecimalType(28, 0))
    return (units * power).try_cast(MONEY)


def convert(amount: Column | str, rate: Column | str) -> Column:
    """amount x rate with all 18 fractional digits kept, for every rate of its type.

    The whole and the fractional part of the rate are multiplied apart, as one product
    would pass 38 digits. A value beyond 19 whole digits fails the job; none becomes NULL.
    """
    money, rate = _col(amount).cast(MONEY), _col(rate).cast(RATE)
    part = rate % F.lit(Decimal(1))
    whole = (rate - part).cast(DecimalType(8, 0))
    return (money * whole).cast(_USD_OPERAND) + (money * part.cast(DecimalType(10, 10))).cast(_USD_OPERAND)


def invert_rate(rate: Column | str) -> Column:
    """1 / rate as a rate; NULL for zero."""
    return F.try_divide(F.lit(1).cast("double"), _col(rate).cast("double")).cast(RATE)


def minus(left: Column | str, right: Column | str) -> Column:
    """left - right at USD scale, without the digit Spark would trim."""
    return _col(left).cast(_USD_OPERAND) - _col(right).cast(_USD_OPERAND)


def cents(value: Column | str) -> Column:
    """Round half away from zero to two digits."""
    return F.round(_col(value), 2)


def percent_fee(
    principal: Column, percent: Column, fixed: Column, *, wide: bool = False, rounding: str = "exact"
) -> Column:
    """round(principal x percent / 100 + fixed, 2).

    `wide` is for a principal that is not negative and carries 18 fractional digits (a
    converted amount). A fee beyond 12 whole digits fails the job; none becomes NULL.
    rounding="exact" keeps the product decimal; "float" goes through binary
    floating point, where an exact half cent may land on either side.
    """
    if rounding == "float":
        product = principal.cast("double") * percent.cast("double") / F.lit(100.0) + fixed.cast("double")
        return (F.round(product * F.lit(100.0), 0) / F.lit(100.0)).cast(MONEY)
    if rounding != "exact":
        raise ValueError(f"unknown rounding {rounding!r}")
    fraction = (percent.cast(RATE) * F.lit(Decimal("0.01"))).cast(_FRACTION)
    if wide:
        # 12 digits decide a half cent: what is cut off below them cannot cross it.
        part = principal.cast(USD) % F.lit(Decimal(1))
        whole = F.floor(principal.cast(USD)).cast(DecimalType(20, 0))
        below = F.floor(part.cast(DecimalType(18, 18)) * fraction, F.lit(12))
        total = ((whole * fraction).cast(DecimalType(37, 12)) + below).cast(DecimalType(36, 12)) + fixed.cast(MONEY)
    else:
        total = (principal.cast(MONEY) * fraction).cast(DecimalType(37, 20)) + fixed.cast(MONEY)
    return F.round(total, 2).cast(MONEY)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
