"""Checks of rows against their declared metadata before a load (U4, U8)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import TableMeta
from ..functions.exact import altered
from .protect import BINARY_KINDS, BINARY_TEXT_CHARS, binary_text
from .subset import key_column

_STRINGS = ("varchar", "varchar2", "char", "nvarchar2", "nchar", "string", "character varying")


def _checks(df: DataFrame, meta: TableMeta) -> list[tuple[str, str, F.Column]]:
    out = []
    for cm in meta.columns:
        if cm.name not in df.columns:
            if not cm.is_nullable:         # a declared column that is not there fails
                out.append((cm.name, "missing", F.lit(True)))
            continue
        c = F.col(cm.name)
        if not cm.is_nullable:
            out.append((cm.name, "not_null", c.isNull()))
        if cm.kind in _STRINGS and cm.length:
            out.append((cm.name, "max_length", F.length(c) > cm.length))
        if cm.kind in BINARY_KINDS:            # as the text it is extracted as
            out.append((cm.name, "max_length",
                        F.char_length(binary_text(c)) > (cm.length or BINARY_TEXT_CHARS)))
        dt = cm.spark_type()
        if isinstance(dt, T.DecimalType) and dt.precision - dt.scale < 38:
            bound = F.lit(str(10 ** (dt.precision - dt.scale))).cast(T.DecimalType(38, 0))
            out.append((cm.name, "precision", F.abs(c) >= bound))
    return out


def validate_rows(df: DataFrame, meta: TableMeta) -> DataFrame:
    """U4: failures per (column, check) in ONE pass over the data; a long
    (column_name, check_name, failures) table, zero counts included."""
    checks = _checks(df, meta)
    if not checks:
        return df.sparkSession.createDataFrame([], "column_name string, check_name string, "
                                                   "failures bigint")
    aggs = [F.count(F.when(cond, 1)).alias(f"{name}|{check}") for name, check, cond in checks]
    wide = df.agg(*aggs)
    long = wide.unpivot([], [f"{n}|{c}" for n, c, _ in checks], "check", "failures")
    parts = F.split(F.col("check"), r"\|")
    return long.select(parts[0].alias("column_name"), parts[1].alias("check_name"),
                       F.col("failures").cast("bigint").alias("failures"))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """U4: primary-key values held by more than one row (partial aggregate)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("duplicates")) \
        .where(F.col("duplicates") > 1)


def _typed_and_reason(meta: TableMeta):
    """Per declared column: the typed value; the first failing column's name
    and raw value (NULL when the row is good); and all failing columns with
    their raw values."""
    typed_cols, fails = [], []
    for cm in meta.columns:
        raw = F.col(f"`{cm.name}`")
        dt = cm.spark_type()
        typed = raw.try_cast(dt) if not isinstance(dt, T.StringType) else raw
        bad = raw.isNotNull() & (typed.isNull() | altered(raw, typed, dt))
        if cm.kind in _STRINGS and cm.length:
            bad = bad | (F.length(raw) > cm.length)
        if not cm.is_nullable:
            bad = bad | raw.isNull()
        bad = F.coalesce(bad, F.lit(False))
        typed_cols.append(typed.alias(cm.name))
        fails.append((cm.name, bad))
    reason = F.coalesce(*[F.when(b, F.lit(n)) for n, b in fails])
    value = F.coalesce(*[F.when((reason == n) & b, F.col(f"`{n}`").cast("string"))
                         for n, b in fails])
    every = F.filter(F.array(*[F.when(b, F.struct(
        F.lit(n).alias("column"), F.col(f"`{n}`").cast("string").alias("value")))
        for n, b in fails]), lambda x: x.isNotNull())
    return typed_cols, reason, value, every


def _free(names: Sequence[str], *wanted: str) -> list[str]:
    """The wanted names, lengthened where the table has a column called so."""
    taken, out = {n.lower() for n in names}, []
    for w in wanted:
        while w.lower() in taken:
            w += "_"
        taken.add(w.lower())
        out.append(w)
    return out


@dataclass(frozen=True)
class SplitNames:
    """What the split of a table's rows calls its marks: names that no column of
    the table has."""

    column: str = "reject_column"       # the first failing column
    value: str = "reject_value"         # and its raw value
    every: str = "rejects"              # all failing columns with their raw values
    row: str = "reject_row"             # the raw row as JSON
    status: str = "status"              # good / rejected

    @classmethod
    def of(cls, names: Sequence[str]) -> SplitNames:
        default = cls()
        return cls(*_free(names, default.column, default.value, default.every, default.row,
                          default.status))


def split_typed(text: DataFrame, meta: TableMeta) -> tuple[DataFrame, DataFrame]:
    """U8: text rows -> (rows typed as declared, rejected rows).

    A value is rejected when it is present but does not convert to its type
    (``try_cast`` gives NULL), when the type cannot hold it as it is (``1.239``
    with two digits behind the point is not rounded), or when it is longer than
    its declared length.  The rejected side names the first failing column and
    its raw value.  Writing both sides: ``write_typed_split`` does it in one
    pass."""
    typed_cols, reason, value, _ = _typed_and_reason(meta)
    pk = meta.primary_key
    n = SplitNames.of([*meta.names, *text.columns])
    marked = text.select(F.struct(*typed_cols).alias("typed"), F.struct(
        *[F.col(f"`{k}`").try_cast(meta.column(k).spark_type()).alias(k) for k in pk],
        reason.alias(n.column), value.alias(n.value)).alias("mark"))
    failed = F.col("mark")[n.column].isNotNull()
    return marked.where(~failed).select("typed.*"), marked.where(failed).select("mark.*")


def write_typed_split(text: DataFrame, meta: TableMeta, path: str, *,
                      fmt: str = "parquet") -> dict[str, str]:
    """U8 in one pass: typed rows and rejected rows written by ONE job,
    partitioned by ``status`` (``good`` / ``rejected``), instead of two
    scans of the text.  A rejected row also holds every failing column with
    its raw value (``rejects``) and the raw row as JSON (``reject_row``, NULLs
    included).  Marks are called so unless the table has such a column (see
    ``SplitNames``).  Returns the two folders."""
    typed_cols, reason, value, every = _typed_and_reason(meta)
    raw = F.to_json(F.struct(*[F.col(f"`{c}`") for c in text.columns]),
                    {"ignoreNullFields": "false"})
    n = SplitNames.of(meta.names)
    out = text.select(*typed_cols, reason.alias(n.column), value.alias(n.value),
                      every.alias(n.every), F.when(reason.isNotNull(), raw).alias(n.row),
                      F.when(reason.isNull(), F.lit("good")).otherwise(F.lit("rejected"))
                      .alias(n.status))
    out.write.mode("overwrite").format(fmt).partitionBy(n.status).save(path)
    return {"good": f"{path}/{n.status}=good", "rejected": f"{path}/{n.status}=rejected"}


def unique_key_tables(tables, primary_keys) -> dict[str, list[str]]:
    """The declared keys that hold in the data: one distributed duplicate
    check per table (partial aggregate; ``isEmpty`` stops at the first
    duplicate found).  Plans may skip de-duplicating a key set only for
    these (see ``mask.identity_link``).  Text keys that differ in padding only
    are one key, as joins compare them."""
    out = {}
    for table, key in primary_keys.items():
        if table not in tables or not key:
            continue
        keys = tables[table].select(*[key_column(tables[table], k).alias(k) for k in key])
        if duplicate_keys(keys, key).isEmpty():
            out[table] = list(key)
    return out
