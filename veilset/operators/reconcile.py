"""Comparison of two tables as multisets of rows.

A row's fingerprint is two 64-bit hashes of all its columns, NULLs told apart
from absent values; a table's is the number of rows and the sums of both, which
no order changes and which a doubled row changes as much as a lost one.  Sums are
exact decimals, so they never wrap.

``reconcile`` compares per hash bucket of the key first: one partial aggregate
over each side, a row per bucket.  Only rows of buckets that differ are looked at
again, grouped by key and fingerprint, and reported by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 4096


def _hashable(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.MapType):          # entries in a fixed order
        return F.array_sort(F.map_entries(col))
    if isinstance(dtype, T.VariantType):
        return F.to_json(col)
    return col


def row_hashes(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row; a NULL counts as itself, whatever follows it."""
    parts: list[Column] = []
    for name in columns or df.columns:
        col = _hashable(F.col(f"`{name}`"), df.schema[name].dataType)
        parts += [col.isNull(), col]
    return F.xxhash64(F.lit(0), *parts), F.xxhash64(F.lit(1), *parts)


def _sums(h1: Column, h2: Column) -> list[Column]:
    exact = T.DecimalType(20, 0)
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(h1.cast(exact)), F.lit(0)).alias("sum1"),
            F.coalesce(F.sum(h2.cast(exact)), F.lit(0)).alias("sum2")]


@dataclass(frozen=True)
class Fingerprint:
    rows: int
    sum1: int
    sum2: int


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with its fingerprint observed by the job that reads it."""
    obs = Observation(name)
    return df.observe(obs, *_sums(*row_hashes(df))), obs


def seen(obs: Observation) -> Fingerprint:
    got = obs.get
    return Fingerprint(int(got["rows"]), int(got["sum1"]), int(got["sum2"]))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> Fingerprint:
    """Rows and both sums of a table: one partial aggregate."""
    r = df.agg(*_sums(*row_hashes(df, columns))).first()
    return Fingerprint(int(r["rows"]), int(r["sum1"]), int(r["sum2"]))


def bucket_of(key: Sequence[str], buckets: int = BUCKETS) -> Column:
    """The hash bucket of a key."""
    cols = [x for k in key for x in (F.col(f"`{k}`").isNull(), F.col(f"`{k}`"))]
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def bucket_sums(df: DataFrame, key: Sequence[str], columns: Sequence[str],
                buckets: int = BUCKETS) -> DataFrame:
    """bucket, rows, sum1, sum2: at most a row per bucket."""
    return df.groupBy(bucket_of(key, buckets).alias("bucket")).agg(
        *_sums(*row_hashes(df, columns)))


def differing_buckets(expected: DataFrame, actual: DataFrame, key: Sequence[str],
                      columns: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Buckets whose fingerprints differ; at most ``buckets`` numbers."""
    both = bucket_sums(expected, key, columns, buckets).unionAll(
        bucket_sums(actual, key, columns, buckets))
    # equal on both sides: two rows and one value of each sum
    same = (F.count(F.lit(1)) == 2)
    for c in ("rows", "sum1", "sum2"):
        same = same & (F.min(c) == F.max(c))
    found = both.groupBy("bucket").agg(same.alias("same")).where(~F.col("same"))
    return sorted(r["bucket"] for r in found.select("bucket").collect())


def reconcile(expected: DataFrame, actual: DataFrame, key: Sequence[str] | None = None, *,
              columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """What ``actual`` holds otherwise than ``expected``, per key: the key, a
    status, the rows of either side.

    ``lost`` (fewer rows, the others equal), ``added`` (rows of a new key, or new
    rows beside the old), ``doubled`` (known rows more often), ``changed`` (rows
    lost and others added).  Without a key a row is its own key (a key holds no map).  A column's type
    must be the same on both sides.  Equal tables give no rows and are read once;
    beyond that only rows of differing buckets are grouped."""
    columns = list(columns or expected.columns)
    key = list(key or columns)
    maps = [k for k in key if isinstance(expected.schema[k].dataType, T.MapType)]
    if maps:
        raise ValueError(f"rows cannot be grouped by maps {maps}: give a key without them")
    for c in columns:
        a, b = expected.schema[c].dataType, actual.schema[c].dataType
        if a != b:
            raise ValueError(f"column {c} is {a.simpleString()} and {b.simpleString()}")
    wrong = differing_buckets(expected, actual, key, columns, buckets)

    def rows(df: DataFrame, side: int) -> DataFrame:
        h1, h2 = row_hashes(df, columns)
        return df.where(bucket_of(key, buckets).isin(wrong) if wrong else F.lit(False)).select(
            F.struct(*[F.col(f"`{k}`") for k in key]).alias("key"), h1.alias("h1"),
            h2.alias("h2"), F.lit(1 - side).cast("long").alias("e"),
            F.lit(side).cast("long").alias("a"))

    # partial sums: rows repeated a million times travel as one
    by_row = rows(expected, 0).unionAll(rows(actual, 1)).groupBy("key", "h1", "h2").agg(
        F.sum("e").alias("e"), F.sum("a").alias("a"))
    missing = F.sum(F.greatest(F.col("e") - F.col("a"), F.lit(0)))
    extra = F.sum(F.greatest(F.col("a") - F.col("e"), F.lit(0)))
    unknown = F.sum(F.when(F.col("e") == 0, F.col("a")).otherwise(0))
    by_key = by_row.groupBy("key").agg(
        F.sum("e").alias("expected_rows"), F.sum("a").alias("actual_rows"),
        missing.alias("missing"), extra.alias("extra"), unknown.alias("unknown"))
    status = (F.when(F.col("extra") == 0, "lost")
              .when(F.col("missing") > 0, "changed")
              .when(F.col("unknown") > 0, "added").otherwise("doubled"))
    return by_key.where("missing > 0 OR extra > 0").select(
        "key.*", status.alias("status"), "expected_rows", "actual_rows")
