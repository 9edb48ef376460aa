"""Mask choices -> Column expressions, including nested JSON paths."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rules import Choice

IdentityField = Callable[[str], Column]


def derived_fields(choice: Choice) -> set[str]:
    """Identity fields a choice reads."""
    if choice.kind != "identity":
        return set()
    f = choice.field
    if f in ("month", "year", "day"):
        return {"cm_dob"}
    if f == "full_name":
        return {"first_nm", "mid_nm", "lst_nm"}
    if f == "full_address":
        return {"addr_line1", "addr_line2", "city", "state", "zip_code"}
    return {f}


def constant_column(value, dtype: T.DataType) -> Column:
    """A fixed value in the column's own type (so the schema is unchanged);
    a value the type cannot hold becomes NULL of that type."""
    if isinstance(value, _dt.date):
        lit = F.lit(value.isoformat()).cast("date")
    else:
        lit = F.lit(value)
    return lit.try_cast(dtype)


def identity_value(choice: Choice, idf: IdentityField) -> Column:
    f = choice.field
    if f == "month":
        return F.month(idf("cm_dob"))
    if f == "year":
        return F.year(idf("cm_dob"))
    if f == "day":
        return F.dayofmonth(idf("cm_dob"))
    if f == "full_name":
        return F.concat_ws(" ", idf("first_nm"), idf("mid_nm"), idf("lst_nm"))
    if f == "full_address":
        return F.concat_ws(", ", idf("addr_line1"), idf("addr_line2"), idf("city"),
                           idf("state"), idf("zip_code"))
    return idf(f)


def choice_column(choice: Choice, original: Column, dtype: T.DataType,
                  idf: IdentityField, fallback=None) -> Column:
    """The masked value of one column.  ``fallback`` (a constant) replaces an
    identity value that is missing (left join without a match)."""
    if choice.kind == "keep":
        return original
    if choice.kind == "null":
        return F.lit(None).cast(dtype)
    if choice.kind == "constant":
        return constant_column(choice.value, dtype)
    value = identity_value(choice, idf)
    if isinstance(dtype, T.StringType) and choice.field == "cm_dob":
        value = F.date_format(value, "yyyy-MM-dd")
    out = value.cast(dtype)
    if fallback is not None:
        out = F.coalesce(out, constant_column(fallback, dtype))
    return out


def mask_variant(node: Column, path: list[str], value: Callable[[T.DataType], Column],
                 arrays: int = 3) -> Column:
    """Replace the attribute at ``path`` of a JSON node (VARIANT), whatever
    shape the node has in this row.

    Objects get the attributes of that name (in any case) replaced, arrays are
    mapped element by element (up to ``arrays`` arrays inside one another), an
    absent attribute and an explicit null stay as they are.  A node that the
    path cannot enter (a plain value, an array nested too deep) may itself
    hold what the path was to mask, so it becomes null: nothing passes.
    """
    null = F.parse_json(F.lit("null"))
    kind = F.schema_of_variant(node)
    empty = node.isNull() | F.is_variant_null(node)
    parts = F.try_variant_get(node, "$", "array<variant>")
    in_array = F.to_variant_object(F.transform(
        parts, lambda x: mask_variant(x, path, value, arrays - 1))) if arrays else null
    if not path:
        def as_type(dtype: T.DataType) -> Column:
            return F.coalesce(value(dtype).cast("variant"), null)
        return (F.when(empty, node)
                .when(kind == "BIGINT", as_type(T.LongType()))
                .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), as_type(T.DoubleType()))
                .when(kind == "BOOLEAN", as_type(T.BooleanType()))
                .when(kind.startswith("ARRAY"), in_array)
                .otherwise(as_type(T.StringType())))
    name = path[0].lower()
    fields = F.try_variant_get(node, "$", "map<string,variant>")
    in_object = F.to_variant_object(F.transform_values(fields, lambda k, v: F.when(
        F.lower(k) == name, mask_variant(v, path[1:], value, arrays)).otherwise(v)))
    return (F.when(empty, node)
            .when(kind.startswith("OBJECT"), in_object)
            .when(kind.startswith("ARRAY"), in_array)
            .otherwise(null))


def _bound(path: list[str], value: Callable[[T.DataType], Column]):
    return lambda node: mask_variant(node, path, value)


def mask_json(col: Column, items: list[tuple[list[str], Callable[[T.DataType], Column]]]) -> Column:
    """JSON text with every path of ``items`` masked.  Text that is no JSON
    cannot be searched for personal data and becomes NULL.  Attributes that no
    path names keep their values; white space and key order are the writer's."""
    node = F.try_parse_json(col)
    for path, value in items:
        # bind the node to a lambda variable, so that it is one expression
        node = F.element_at(F.transform(F.array(node), _bound(path, value)), 1)
    return F.to_json(node)
