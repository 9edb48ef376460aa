"""Filter criteria of a request -> Spark ``Column`` predicates.

Every predicate keeps the form ``column <op> literal`` so that Catalyst can
push it into the Parquet / JDBC scan; literals are typed like the column
(constant-folded casts) so no cast lands on the column side.  A number between
two values that the column can hold is not rounded to one of them: comparisons
move to the value below it, which gives the same rows.

Semantics follow the declared column type:

* numbers, strings, timestamps: plain comparison / BETWEEN / IN;
* ``DATE`` (carries a time of day): BETWEEN compares instants with midnight
  bounds, so rows later on the last day fall out; the six comparison
  operators compare by *day* and are written as half-open ranges.
"""

from __future__ import annotations

import datetime as _dt
import operator as _op
from decimal import ROUND_FLOOR, Context, Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import ColumnMeta, FilterSpec

COMPARISONS = ("=", "!=", ">", "<", ">=", "<=")


def typed_literal(value: str, dtype: T.DataType) -> Column:
    """A literal of the column's type, folded by the optimizer."""
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.lit(int(Decimal(str(value).strip())))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.lit(float(value))
    if isinstance(dtype, T.DecimalType):
        return F.lit(Decimal(str(value).strip())).cast(dtype)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.lit(str(value).strip()).cast(dtype)
    return F.lit(str(value))


def _exact_scale(dtype: T.DataType) -> int | None:
    """Digits behind the point that a column of exact numbers holds, else None."""
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return 0
    return dtype.scale if isinstance(dtype, T.DecimalType) else None


_WHOLE_MAX = {T.ByteType: 2**7 - 1, T.ShortType: 2**15 - 1, T.IntegerType: 2**31 - 1,
              T.LongType: 2**63 - 1}
_NUMBERS = Context(prec=400)


def number_comparison(col: Column, cond: str, value: str, dtype: T.DataType) -> Column:
    """F1 / F6 on whole numbers and decimals, exact whatever the literal's scale:
    with ``low`` the greatest number of the column's scale not above the value,
    ``col > value`` is ``col > low``, and nothing equals a value above ``low``.
    A value beyond the column's range compares the same with every row."""
    scale = _exact_scale(dtype)
    v = Decimal(str(value).strip())
    if not v.is_finite():
        raise ValueError(f"{value!r} is no number")
    unit = Decimal(1).scaleb(-scale)
    low = v.quantize(unit, rounding=ROUND_FLOOR, context=_NUMBERS)
    top = (Decimal(10) ** dtype.precision - 1) * unit if isinstance(dtype, T.DecimalType) \
        else Decimal(_WHOLE_MAX[type(dtype)])
    bottom = -top if isinstance(dtype, T.DecimalType) else -top - 1
    every, none = col.isNotNull(), F.lit(False)
    if low > top or low < bottom:
        true = ("!=", ">", ">=") if low < bottom else ("!=", "<", "<=")
        return every if cond in true else none
    lit = F.lit(int(low)) if not isinstance(dtype, T.DecimalType) else F.lit(low).cast(dtype)
    exact = low == v
    if cond == "=":
        return col == lit if exact else none
    if cond == "!=":
        return col != lit if exact else every
    if cond in (">", "<="):
        return _PY_OPS[cond](col, lit)
    return _PY_OPS[cond](col, lit) if exact else (col > lit if cond == ">=" else col <= lit)


def _moment(value: str) -> _dt.datetime:
    """A date, or a date with a time of day; anything else is an error."""
    return _dt.datetime.fromisoformat(str(value).strip())


def _has_time(value: str) -> bool:
    return len(str(value).strip()) > 10


def _next_day(value: str, dtype: T.DataType) -> Column:
    day = _moment(value).date() + _dt.timedelta(days=1)
    return F.lit(day.isoformat()).cast(dtype)


def _day_start(value: str, dtype: T.DataType) -> Column:
    """The bound as given: the start of its day, or the moment it names.  A
    time of day cannot be compared with a column of plain dates."""
    if _has_time(value):
        if isinstance(dtype, T.DateType):
            raise ValueError(f"{value!r} has a time of day, the column holds dates")
        return F.lit(_moment(value).isoformat(sep=" ")).cast(dtype)
    return F.lit(_moment(value).date().isoformat()).cast(dtype)


def day_comparison(col: Column, cond: str, value: str, dtype: T.DataType) -> Column:
    """compare a DATE column with a day, written as a half-open range."""
    if _has_time(value):                  # a moment, not a day
        return _PY_OPS[cond](col, _day_start(value, dtype))
    lo, hi = _day_start(value, dtype), _next_day(value, dtype)
    return {
        "=": (col >= lo) & (col < hi),
        "!=": (col < lo) | (col >= hi),
        ">": col >= hi,
        "<=": col < hi,
        "<": col < lo,
        ">=": col >= lo,
    }[cond]


_PY_OPS = {"=": _op.eq, "!=": _op.ne, ">": _op.gt, "<": _op.lt, ">=": _op.ge, "<=": _op.le}


def _held(value: str, dtype: T.DataType) -> bool:
    """Whether a column of exact numbers can hold the value."""
    v, scale = Decimal(str(value).strip()), _exact_scale(dtype)
    if v != v.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_FLOOR, context=_NUMBERS):
        return False
    if isinstance(dtype, T.DecimalType):
        return abs(v) < Decimal(10) ** (dtype.precision - scale)
    return -_WHOLE_MAX[type(dtype)] - 1 <= v <= _WHOLE_MAX[type(dtype)]


def condition(spec: FilterSpec, meta: ColumnMeta, dtype: T.DataType) -> Column:
    """One filter entry -> predicate."""
    col = F.col(spec.column)
    cond = spec.condition.strip().upper()
    is_date = meta.kind == "date"
    if cond == "BETWEEN":
        if len(spec.values) != 2:
            raise ValueError(
                f"BETWEEN on {spec.column} needs exactly two values, got {len(spec.values)}")
        a, b = spec.values
        if is_date:
            return col.between(_day_start(a, dtype), _day_start(b, dtype))
        if _exact_scale(dtype) is not None:
            return number_comparison(col, ">=", a, dtype) & number_comparison(col, "<=", b, dtype)
        return col.between(typed_literal(a, dtype), typed_literal(b, dtype))
    if cond == "IN":
        if _exact_scale(dtype) is not None:
            held = [v for v in spec.values if _held(v, dtype)]
            return col.isin([typed_literal(v, dtype) for v in held]) if held else F.lit(False)
        return col.isin([typed_literal(v, dtype) for v in spec.values])
    if cond in COMPARISONS:
        if not spec.values:
            raise ValueError(f"condition {cond} on {spec.column} needs a value")
        if is_date:
            return day_comparison(col, cond, spec.values[0], dtype)
        if _exact_scale(dtype) is not None:
            return number_comparison(col, cond, spec.values[0], dtype)
        return _PY_OPS[cond](col, typed_literal(spec.values[0], dtype))
    raise ValueError(f"unexpected filter condition: {spec.condition!r}")


def fold(conditions: list[Column], operator: str = "AND") -> Column | None:
    """all conditions joined by one operator."""
    if not conditions:
        return None
    op = operator.strip().upper()
    if op not in ("AND", "OR"):
        raise ValueError(f"unknown operator {operator!r}")
    return reduce(_op.and_ if op == "AND" else _op.or_, conditions)


def request_filter(meta, schema: T.StructType) -> Column | None:
    """All filter criteria of a table request folded with its operator."""
    conds = []
    for spec in meta.filters:
        conds.append(condition(spec, meta.column(spec.column), schema[spec.column].dataType))
    return fold(conds, meta.operator)
