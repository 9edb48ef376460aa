"""Conversions that must not change a value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def altered(raw: Column, typed: Column, dtype: T.DataType) -> Column:
    """Whether a conversion changed the value: digits behind the point that the
    type does not hold, a time of day lost to a plain date."""
    if isinstance(dtype, T.DecimalType):
        # digits beyond the scale must be zeros; a number with an exponent is
        # compared at the widest scale that holds its whole part
        wide = T.DecimalType(38, 38 - (dtype.precision - dtype.scale))
        text = F.trim(raw.cast("string"))
        plain = F.rtrim(F.regexp_extract(text, r"^[+-]?[0-9]*\.([0-9]*)$", 1), F.lit("0"))
        return F.coalesce((F.char_length(plain) > dtype.scale)
                          | (raw.try_cast(wide) != typed), F.lit(False))
    if isinstance(dtype, T.DateType):
        ts = T.TimestampNTZType()
        return F.coalesce(raw.try_cast(ts) != typed.cast(ts), F.lit(False))
    if isinstance(dtype, T.IntegralType):
        return F.coalesce(raw.try_cast(T.DecimalType(38, 18)) != typed, F.lit(False))
    return F.lit(False)
