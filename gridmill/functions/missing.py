"""Missing values. Inside the engine missing is always NULL, never NaN.

Spark keeps the two apart: an average over a set with a NaN is NaN, and NaN is greater than
every number. So each measure passes ``nan_to_null`` before anything is computed from it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.schemas import FILL_FALLBACK

# What counts as a number in text; Java's parser would also take "1d", "1f" and hex floats. Text is held
# against the pattern before it is cast: a cast that fails costs an exception per value, a pattern does not.
NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
SHORT_DIGITS, DIGITS = r"^\s*[+-]?\d{1,18}\s*$", r"^\s*[+-]?\d+\s*$"  # up to 18 always fit a bigint
LONG = 2.0**63


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def not_fill(c: Column | str, fill: float | str | None = None, dtype: T.DataType | None = None) -> Column:
    """True for values that are neither a fill nor NaN.

    A declared numeric ``fill`` is matched exactly and nothing else counts as one, in the
    precision of the data: pass the column's ``dtype`` so that a float column is compared as
    float. Without a usable declaration every value from 9e35 upwards is a fill; NaN sorts above
    all numbers in Spark and goes the same way.
    """
    c = _col(c)
    try:
        value = None if fill is None else float(fill)
    except (TypeError, ValueError):
        value = None
    if value is None:
        return c < F.lit(FILL_FALLBACK)
    literal = F.lit(value)
    if isinstance(dtype, T.FloatType):
        literal = literal.cast("float")
    return (c != literal) & ~F.isnan(c)


def mask_fill(c: Column | str, fill: float | str | None = None, dtype: T.DataType | None = None) -> Column:
    """Fill values become NULL, whatever else the row holds stays."""
    return F.when(not_fill(c, fill, dtype), _col(c))


def mask_range(c: Column | str, low: float, high: float) -> Column:
    """Values outside the inclusive range become NULL; the row stays."""
    c = _col(c)
    return F.when(c.between(F.lit(low), F.lit(high)), c)


def to_number(c: Column | str, dtype: T.DataType) -> Column:
    """Any column as double; what is not a number becomes NULL."""
    c = _col(c)
    if isinstance(dtype, T.StringType):
        c = F.when(c.rlike(NUMBER_TEXT), c.try_cast("double"))
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        c = c.cast("double")
    else:
        return F.lit(None).cast("double")
    return nan_to_null(c)


def to_integer(c: Column | str, dtype: T.DataType) -> Column:
    """Any column as bigint; fractions and non-numbers become NULL instead of being truncated."""
    c = _col(c)
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    number = to_number(c, dtype)
    whole = F.when(number == F.floor(number), F.floor(number))
    large = F.when((number >= -LONG) & (number < LONG), whole)
    if isinstance(dtype, T.StringType):
        # from 2**53 on the double is not exact, the digits are
        large = F.when(c.rlike(DIGITS), c.try_cast("bigint")).otherwise(large)
    found = F.when(number.isNull(), F.lit(None).cast("bigint")).when(F.abs(number) < F.lit(2.0**53), whole).otherwise(large)
    # most text is a plain integer: one pattern and one cast
    return F.when(c.rlike(SHORT_DIGITS), c.try_cast("bigint")).otherwise(found) if isinstance(dtype, T.StringType) else found


def is_missing(c: Column | str, dtype: T.DataType) -> Column:
    """NULL, or NaN in a floating-point column."""
    c = _col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()
