"""Coercion to a fixed schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.functions.missing import to_integer, to_number
from gridmill.schemas import SPARK_TYPES

# Text that can be a day, with or without a time: other text is not cast, as a failing cast costs an
# exception. A time alone is no day (a cast would take today's).
DAY_TEXT = r"^\s*[+-]?\d{4,7}(-\d{1,2}(-\d{1,2}([ T].*)?)?)?\s*$"
_DATE_LIKE = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _coerced(name: str, wanted: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    if wanted == "double":
        return to_number(c, dtype)
    if wanted == "bigint":
        return to_integer(c, dtype)
    if wanted == "string":
        return c.cast("string")
    # date, timestamp
    if isinstance(dtype, T.StringType):
        return F.when(c.rlike(DAY_TEXT), c.try_cast(wanted))
    return c.try_cast(wanted) if isinstance(dtype, _DATE_LIKE) else F.lit(None).cast(wanted)


def coerce(df: DataFrame, schema: Iterable[tuple]) -> DataFrame:
    """Columns brought to the schema's types, bad values to NULL.

    Schema columns the frame lacks are skipped, unknown types and other columns left alone. All
    in one projection.
    """
    changes = {
        name: _coerced(name, SPARK_TYPES[kind.upper()], df.schema[name].dataType)
        for name, kind, *_ in schema
        if name in df.columns and kind.upper() in SPARK_TYPES
    }
    return df.withColumns(changes) if changes else df
