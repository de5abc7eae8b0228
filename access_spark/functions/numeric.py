"""Number columns: rounding, ratios and guarded casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(col: Column, digits: int = 0) -> Column:
    """Half-to-even rounding of a double, scaled the way array libraries do it."""
    scale = float(10**digits)
    return F.rint(col.cast("double") * scale) / scale


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, null when either is missing or the whole is zero."""
    ratio = 100.0 * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return round_even(ratio, digits)


def finite(col: Column) -> Column:
    """The value, or null when it is NaN or infinite."""
    value = col.cast("double")
    bad = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(~bad, value)


def number(col: Column) -> Column:
    """Text to double; anything that is not a plain number gives null."""
    text = F.trim(col.cast("string"))
    plain = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(plain, text.try_cast("double"))


def comma_number(col: Column) -> Column:
    """Number with a decimal comma or point."""
    return number(F.replace(col.cast("string"), F.lit(","), F.lit(".")))


def flag(cond: Column) -> Column:
    """Condition as 0/1, unknown counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def any_nonzero(*cols: Column) -> Column:
    """1 when one of the columns holds a number other than zero."""
    return F.greatest(*[flag(F.coalesce(number(c), F.lit(0.0)) != 0.0) for c in cols])


def any_positive(*cols: Column) -> Column:
    return F.greatest(*[flag(F.coalesce(number(c), F.lit(0.0)) > 0.0) for c in cols])


def reach_flag(minutes: Column, band: int) -> Column:
    """1 when the travel time is known, finite and within the band."""
    return flag(finite(minutes) <= float(band))
