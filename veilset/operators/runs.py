"""Key sets as a few intervals of keys that a scan can skip by.

A join sees every row of a table before it can drop one; a pushed ``BETWEEN``
lets Parquet skip row groups and files by their statistics, and a database use
its index.  ``key_runs`` covers a key set of any size by at most ``n`` intervals,
cut at the widest gaps between neighbouring keys; the exact join follows.

Keys are dealt out by range and sorted; a key's gap is the distance to the one
before it.  Only the widest ``n`` gaps and each range's ends reach the driver.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS = 64


def _distance(dtype: T.DataType):
    """The gap between two keys as a number, None where the type has none."""
    if isinstance(dtype, T.NumericType):
        return lambda a, b: b.cast("double") - a.cast("double")
    if isinstance(dtype, T.DateType):
        return lambda a, b: F.datediff(b, a).cast("double")
    if isinstance(dtype, T.TimestampType | T.TimestampNTZType):
        return lambda a, b: F.unix_micros(b.cast("timestamp")).cast("double") - \
            F.unix_micros(a.cast("timestamp")).cast("double")
    return None


def key_runs(keys: DataFrame, column: str, n: int = RUNS) -> list[tuple]:
    """At most ``n`` disjoint intervals (low, high), both ends held by a key, that
    hold every non-NULL key of ``keys[column]``; in ascending order.  Text keys
    have no gaps to measure: they are cut into intervals of about equally many."""
    if n < 1:
        raise ValueError("at least one interval")
    spark, dtype = keys.sparkSession, keys.schema[column].dataType
    away = _distance(dtype)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) if away else n
    ranged = (keys.select(F.col(column).alias("k")).where("k IS NOT NULL")
              .repartitionByRange(parts, "k").select("k", F.spark_partition_id().alias("p")))
    ends = sorted((r["lo"], r["hi"]) for r in ranged.groupBy("p").agg(
        F.min("k").alias("lo"), F.max("k").alias("hi")).collect())
    if not ends or away is None:
        return ends
    before = F.lag("k").over(Window.partitionBy("p").orderBy("k"))
    gaps = ranged.select("k", before.alias("b")).where("b IS NOT NULL AND b <> k").select(
        "b", "k", away(F.col("b"), F.col("k")).alias("gap")).orderBy(F.desc("gap"), "k").limit(n)
    found = {(r["b"], r["k"]): r["gap"] for r in gaps.collect()}
    # between two ranges: the last key of one, the first of the next
    between = [(a[1], b[0]) for a, b in zip(ends, ends[1:], strict=False) if a[1] != b[0]]
    if between:
        some = spark.createDataFrame(between, T.StructType([
            T.StructField("b", dtype), T.StructField("k", dtype)]))
        found |= {(r["b"], r["k"]): r["gap"] for r in some.select(
            "b", "k", away(F.col("b"), F.col("k")).alias("gap")).collect()}
    cuts = sorted(sorted(found, key=lambda c: (-found[c], c))[:n - 1])
    starts = [ends[0][0], *(k for _, k in cuts)]
    stops = [*(b for b, _ in cuts), ends[-1][1]]
    return list(zip(starts, stops, strict=True))


def in_runs(column: Column, dtype: T.DataType, runs: list[tuple]) -> Column:
    """``column`` within one of the intervals, as comparisons with literals that a
    scan takes as pushed filters.  Text may be padded in the column: its upper end
    is raised beyond every padded form of the interval's last key."""
    def bounds(low, high) -> Column:
        if isinstance(dtype, T.StringType):
            return (column >= low) & (column < re.split("[\x00-\x1f]", high)[0] + "!")
        return (column >= F.lit(low).cast(dtype)) & (column <= F.lit(high).cast(dtype))

    return reduce(lambda a, b: a | b, [bounds(*r) for r in runs]) if runs else F.lit(False)
