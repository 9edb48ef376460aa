"""Dense numbers for keys of any type (S12): 0, 1, 2, ... in key order.

Distinct keys are dealt out by range and sorted; a key's number is its place in
its range plus the keys of the ranges before, a sum over one count per range.  So
numbers depend on the keys alone, not on how they were partitioned, and no task
sees more than its range.  They are the domain on which ``fpe`` gives text keys
numbers that no two keys share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_path
from .subset import key_column


def dense_numbers(keys: DataFrame, column: str, *, known: DataFrame | None = None,
                  unique: bool = False) -> DataFrame:
    """``column``, ``number``: every non-NULL key once (text without padding).

    With ``known`` (a table this function made before) its keys keep their
    numbers and new keys are numbered behind them, so a person's number stays when
    others join.  ``unique`` states that the keys are distinct already."""
    spark = keys.sparkSession
    new = keys.select(key_column(keys, column).alias(column)).where(F.col(column).isNotNull())
    new = new if unique else new.distinct()
    first = 0
    if known is not None:
        known = known.select(column, F.col("number").cast("bigint").alias("number"))
        new = new.join(known, column, "left_anti")
        first = int(known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written once: range bounds are drawn from a sample, numbers must not be
    path = stage_path(spark, "dense")
    new.repartitionByRange(parts, column).select(
        column, F.spark_partition_id().alias("part")).write.parquet(path)
    ranged = spark.read.parquet(path)
    counts = sorted((r["part"], r["n"]) for r in ranged.groupBy("part").agg(
        F.count(F.lit(1)).alias("n")).collect())          # a row per range
    before, offsets = first, []
    for part, n in counts:
        offsets.append((part, before))
        before += n
    at = spark.createDataFrame(offsets, "part int, before bigint")
    place = F.row_number().over(Window.partitionBy("part").orderBy(column)) - 1
    numbered = ranged.select(column, "part", place.cast("bigint").alias("place")) \
        .join(F.broadcast(at), "part").select(column, (F.col("before") + F.col("place"))
                                              .alias("number"))
    return numbered if known is None else known.unionByName(numbered)
