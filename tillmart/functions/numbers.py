"""Number parsing and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Plain decimal or exponent notation. Testing the text first keeps bad values
# out of the number parsers, where each one would cost a Java exception, and
# refuses number suffixes, hexadecimal forms, NaN and infinities.
_UNSIGNED = r"([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
_PLAIN = rf"^[+-]?{_UNSIGNED}$"
_NOT_NEGATIVE = rf"^(\+?{_UNSIGNED}|-(0+\.?0*|\.0+)([eE][+-]?[0-9]+)?)$"


def non_negative_double(value: Column) -> Column:
    """Double at least zero or NULL."""
    text = F.trim(value)
    return F.when(text.rlike(_NOT_NEGATIVE), text.try_cast("double"))


def bounded_double(
    value: Column, low: float | None = None, high: float | None = None
) -> Column:
    """Double inside ``[low, high]`` or NULL."""
    text = F.trim(value)
    number = F.when(text.rlike(_PLAIN), text.try_cast("double"))
    fits = F.lit(True)
    if low is not None:
        fits = fits & (number >= low)
    if high is not None:
        fits = fits & (number <= high)
    return F.when(fits, number)


def fixed_decimal(value: Column, precision: int, scale: int, rounding: bool = False) -> Column:
    """Non-negative decimal or NULL; surplus digits are cut unless ``rounding``."""
    text = F.trim(value)
    wide = text.try_cast("decimal(38,12)")
    kept = wide if rounding else F.floor(wide, F.lit(scale))
    return F.when(text.rlike(_NOT_NEGATIVE), kept.try_cast(f"decimal({precision},{scale})"))


def amount_or_zero(value: Column, precision: int = 18, scale: int = 2) -> Column:
    """Non-negative amount, zero if missing or no amount; NULL if it does not fit."""
    parsed = fixed_decimal(value, precision, scale)
    zero = F.lit(0).cast(f"decimal({precision},{scale})")
    return F.when(F.trim(value).rlike(_NOT_NEGATIVE), parsed).otherwise(zero)


def quantity_or_one(value: Column, precision: int = 18, scale: int = 3) -> Column:
    """Positive quantity, one if missing, zero or no quantity; NULL if it does not fit."""
    kind = f"decimal({precision},{scale})"
    parsed = fixed_decimal(value, precision, scale)
    fits = F.when(parsed.isNull() | (parsed > 0), parsed).otherwise(F.lit(1).cast(kind))
    return F.when(F.trim(value).rlike(_NOT_NEGATIVE), fits).otherwise(F.lit(1).cast(kind))


def small_positive_int(value: Column) -> Column:
    """Whole number 1..65535 or NULL."""
    number = F.trim(value).try_cast("int")
    return F.when(number.between(1, 65535), number)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` in percent of ``whole``; NULL for an empty whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def share(part: Column, whole: Column) -> Column:
    """Ratio with NULL counted as zero and the denominator at least one."""
    return F.coalesce(part, F.lit(0)) / F.greatest(F.coalesce(whole, F.lit(1)), F.lit(1))
