"""Joins whose big side has a few very frequent keys.

All rows of a key meet in one task of a plain join; adaptive execution splits such
a task only if nothing stands between both shuffles and the join.  ``split_join``
needs no such shape:

1. a frequent-items sketch of the big side's hashed keys (bounded: no more than
   ``1 / support`` of them, none above that share missing) finds the candidates;
2. their exact counts give each a number of salts, in proportion to its rows;
3. its rows are dealt out over its salts, the small side's rows of that key are
   repeated once per salt; all other keys have the salt 0.

The candidates (at most ``1 / support`` rows) are broadcast; the repeated rows are
at most twice as many as shuffle partitions, times the small side's rows per key.
Every row meets the same rows as in the plain join, so the result is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .subset import key_column, same_key

HOWS = ("inner", "left", "left_semi", "left_anti")
_HASH, _SALTS, _SALT = "__key_hash", "__salts", "__salt"


def _key_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    cols = [key_column(df, c) for c in columns]
    no_key = reduce(lambda a, b: a | b, [c.isNull() for c in cols])
    return F.when(~no_key, F.xxhash64(*cols))


def hot_keys(df: DataFrame, columns: Sequence[str], support: float = 0.001) -> dict[int, int]:
    """Rows per hashed key, for the keys that hold a share of ``support`` or more
    (and perhaps some below); at most ``1 / support`` entries.  NULL keys meet
    nothing and are left out."""
    hashed = df.select(_key_hash(df, columns).alias("h")).where("h IS NOT NULL")
    found = hashed.stat.freqItems(["h"], support).first()[0] or []
    if not found:
        return {}
    return {r["h"]: r["n"] for r in hashed.where(F.col("h").isin(found)).groupBy("h").agg(
        F.count(F.lit(1)).alias("n")).collect()}


def split_join(big: DataFrame, small: DataFrame, pairs: Sequence[tuple[str, str]],
               how: str = "inner", *, support: float = 0.001) -> DataFrame:
    """``big`` joined with ``small`` on ``pairs`` (column of big, column of small),
    text compared without padding; the columns of both (of ``big`` alone for
    semi and anti joins).  Keys must have the same type on both sides."""
    if how not in HOWS:
        raise ValueError(f"unknown join {how!r}; one of {HOWS}")
    for a, b in pairs:
        if big.schema[a].dataType != small.schema[b].dataType:
            raise ValueError(f"{a} and {b} are of different types")
    spark = big.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = hot_keys(big, [a for a, _ in pairs], support)
    rows = max(1, big.count()) if counts else 1
    # a key of as many rows as a partition has on average needs no second salt
    salts = [(h, -(-2 * n * parts // rows)) for h, n in sorted(counts.items())]
    salts = [(h, s) for h, s in salts if s > 1]
    plain = reduce(lambda a, b: a & b, [same_key(big, a, small, b) for a, b in pairs])
    if not salts:
        return big.join(small, plain, how)
    # at most 1 / support rows
    hot = F.broadcast(spark.createDataFrame(salts, f"{_HASH} bigint, {_SALTS} int"))
    left = big.withColumn(_HASH, _key_hash(big, [a for a, _ in pairs])).join(
        hot, _HASH, "left").withColumn(_SALT, F.when(
            F.col(_SALTS).isNotNull(), F.monotonically_increasing_id() % F.col(_SALTS))
        .otherwise(0).cast("int")).drop(_HASH, _SALTS)
    right = small.withColumn(_HASH, _key_hash(small, [b for _, b in pairs])).join(
        hot, _HASH, "left").withColumn(_SALT, F.explode(F.sequence(
            F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))).drop(_HASH, _SALTS)
    cond = reduce(lambda a, b: a & b, [same_key(left, a, right, b) for a, b in pairs],
                  left[_SALT] == right[_SALT])
    return left.join(right, cond, how).drop(left[_SALT]).drop(right[_SALT]) \
        if how in ("inner", "left") else left.join(right, cond, how).drop(_SALT)
