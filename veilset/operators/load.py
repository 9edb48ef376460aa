"""Load into a target: full refresh, append, upsert.

Upsert = incoming rows (one survivor per key) + stored rows whose key is not
incoming.  A plan that reads and overwrites the same table in one job loses data
(JDBC: truncated to nothing without an error; files: fails), so no target is
overwritten in place:

* files: written beside the target, read back, compared by fingerprint
  (``reconcile``), then swapped in by renames;
* files under a manifest (``versioned.VersionedTarget``): only the files that hold
  an incoming key are rewritten, a version file switches the table;
* a database table: written to a stage first, then to the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import csvio
from ..session import path_exists, remove_path, stage_path, swap_path
from ..sources import jdbc
from . import reconcile
from .hot import split_join
from .subset import key_column, same_key
from .versioned import VersionedTarget

MODES = ("full_refresh", "load_append", "upsert")


def survivors(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the greatest by ``order`` (ties broken by the
    remaining columns, so the survivor is always the same row).

    A ``max`` over a struct is a partial aggregate: each map task keeps one row
    per key before the shuffle, so a key holding a third of all rows costs no
    more than any other key."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in key]
    if not rest:                                  # key columns only: plain distinct
        return df.dropDuplicates(list(key))
    best = F.max(F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order_cols)],
                          F.struct(*rest).alias("__row")))
    return (df.groupBy(*key).agg(best.alias("__best"))
            .select(*key, *[F.col(f"__best.__row.{c}").alias(c) for c in rest])
            .select(*df.columns))


def upsert(stored: DataFrame, incoming: DataFrame, key: Sequence[str], *,
           order: Sequence[Column | str] | None = None,
           incoming_unique: bool = False) -> DataFrame:
    """Incoming wins; stored rows are kept when their key is not incoming.

    Incoming rows sharing a key are reduced to one survivor (W5): the greatest
    by ``order``, ties (or no order) broken by the whole row, so the result is
    the same on every run.  ``incoming_unique=True`` skips that aggregate for
    input already known to have unique keys."""
    inc = incoming.select(*stored.columns)
    if not incoming_unique:
        inc = survivors(inc, key, order or [])
    kept = stored.join(inc.select(*key), list(key), "left_anti")
    return inc.unionByName(kept)


def union_rows(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows of both, matched by column name."""
    return stored.unionByName(incoming.select(*stored.columns))


def subtract_rows(df: DataFrame, other: DataFrame, *, keep_duplicates: bool = False) -> DataFrame:
    """Rows of ``df`` not in ``other`` (EXCEPT; EXCEPT ALL with duplicates)."""
    other = other.select(*df.columns)
    return df.exceptAll(other) if keep_duplicates else df.subtract(other)


def restore_keys(df: DataFrame, mapping: DataFrame, column: str, *, enabled: bool = True,
                 test_col: str = "test_key", prod_col: str = "prod_key",
                 unique_map: bool = False, split_hot: bool = False) -> DataFrame:
    """Replace test keys by production keys where the map has them.

    One production key per test key, so the left join never multiplies rows;
    unmapped keys stay as they are; text keys are compared without padding.  ``unique_map=True`` states the map's test
    key is unique (its primary key): no aggregate then sits between the map's
    shuffle and the join, and AQE can split a hot key of ``df``.  Otherwise the
    map is reduced to one production key per test key (partial aggregate); a
    test key with several production keys is an error.  ``split_hot=True`` looks
    for test keys that many rows of ``df`` have and deals those out over several
    tasks (``hot.split_join``)."""
    if not enabled:
        return df
    m = mapping.select(key_column(mapping, test_col).alias("__t"), F.col(prod_col).alias("__p"))
    if not unique_map:
        clash = F.raise_error(F.concat(F.lit("several production keys for test key "),
                                       F.col("__t").cast("string")))
        m = m.groupBy("__t").agg(F.min("__p").alias("__p"), F.max("__p").alias("__q")).select(
            "__t", F.when(F.col("__p").eqNullSafe(F.col("__q")), F.col("__p")).otherwise(
                clash.cast(mapping.schema[prod_col].dataType)).alias("__p"))
    if split_hot:
        m = m.select(F.col("__t").cast(df.schema[column].dataType).alias("__t"), "__p")
        out = split_join(df, m, [(column, "__t")], "left")
        return out.select(*[F.coalesce(F.col("__p").cast(df.schema[c].dataType), F.col(c)).alias(c)
                            if c == column else F.col(f"`{c}`") for c in df.columns])
    out = df.join(m, same_key(df, column, m, "__t"), "left")
    return out.select(*[F.coalesce(F.col("__p").cast(df.schema[column].dataType),
                                   df[column]).alias(column)
                        if c == column else df[c] for c in df.columns])


# ---------------------------------------------------------------------------
# targets

@dataclass(frozen=True)
class FileTarget:
    path: str
    fmt: str = "parquet"

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, self.path)

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        r = spark.read.format(self.fmt)
        if self.fmt == "csv":
            r = r.options(**csvio.READ).option("header", True)
        if schema is not None:
            r = r.schema(schema)
        return r.load(self.path)

    def write(self, df: DataFrame, mode: str) -> None:
        w = df.write.format(self.fmt).mode(mode)
        if self.fmt == "csv":
            w = w.options(**csvio.WRITE).option("header", True)
        w.save(self.path)

    def replace(self, df: DataFrame) -> int:
        """Make ``df`` (which may read this target) the target: written beside it,
        read back and compared, then renamed into its place.  Returns its rows.  A
        failure before the renames leaves the target as it was."""
        spark = df.sparkSession
        folder, name = self.path.rstrip("/").rsplit("/", 1)
        mark = uuid.uuid4().hex[:12]
        new, old = f"{folder}/_{name}-new-{mark}", f"{folder}/_{name}-old-{mark}"
        beside = FileTarget(new, self.fmt)
        rows, obs = reconcile.observed(df, "replaced")
        try:
            beside.write(rows, "errorifexists")
            wrote, got = reconcile.seen(obs), reconcile.fingerprint(beside.read(spark, df.schema))
            if wrote != got:
                raise RuntimeError(f"load check failed: wrote {wrote}, files hold {got}")
            swap_path(spark, new, self.path, old)
        except BaseException:
            remove_path(spark, new)
            raise
        remove_path(spark, old)
        return got.rows


@dataclass(frozen=True)
class JdbcTarget:
    source: jdbc.JdbcSource
    table: str

    def exists(self, spark: SparkSession) -> bool:
        return True           # a database table is created by its owner

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        return jdbc.read_table(spark, self.source, self.table)

    def write(self, df: DataFrame, mode: str) -> None:
        jdbc.write_table(df, self.source, self.table, mode)


def load(spark: SparkSession, incoming: DataFrame, target, mode: str, *,
         key: Sequence[str] = (), order: Sequence[Column | str] | None = None,
         stage: str | None = None, report: dict | None = None) -> int:
    """K8: write ``incoming`` to ``target``; returns the rows now in the target
    for ``upsert`` / ``full_refresh``, else the rows appended.

    An upsert evaluates ``incoming`` once: it is reduced to one row per key,
    staged and counted, before the target is touched.  Rows with a NULL in
    their key cannot be told apart and are an error.  A target that does not
    exist yet is empty.  ``report`` (if given) gets the rows read, the rows that
    lost to another row of their key and, for a versioned target, the files
    rewritten.  Stages hold production data: they are removed when the load ends,
    however it ends; but if writing to a database fails after its table was
    emptied, the stage (``stage``, if given) is the only copy and stays, named in
    the error."""
    if mode not in MODES:
        raise ValueError(f"unknown load mode {mode!r}; one of {MODES}")
    if mode == "load_append":
        obs = Observation("appended")
        target.write(incoming.observe(obs, F.count(F.lit(1)).alias("rows")), "append")
        return int(obs.get["rows"])
    if mode == "full_refresh":
        return _replace(spark, incoming, target, stage)
    if not key:
        raise ValueError("upsert needs the primary key")
    unique, counts = _stage_unique(spark, incoming, key, order)
    try:
        if report is not None:
            report.update(counts)
        rows = unique.read(spark, incoming.schema)
        if isinstance(target, VersionedTarget):
            if tuple(key) != target.key:
                raise ValueError(f"the table's files are indexed by {target.key}, not {key}")
            files = target.upsert(rows, counts["incoming"] - counts["duplicates"])
            if report is not None:
                report["rewritten"] = files
            return int(target.index(spark).agg(F.sum("rows")).first()[0] or 0)
        merged = upsert(target.read(spark, incoming.schema), rows, key, incoming_unique=True) \
            if target.exists(spark) else rows
        return _replace(spark, merged, target, stage)
    finally:
        remove_path(spark, unique.path)


def _replace(spark: SparkSession, merged: DataFrame, target, stage: str | None) -> int:
    """Make ``merged`` the target's rows; returns their number."""
    if isinstance(target, FileTarget):
        return target.replace(merged)
    if isinstance(target, VersionedTarget):
        target.write(merged, "overwrite")
        return int(target.index(spark).agg(F.sum("rows")).first()[0] or 0)
    # a database: stage first, as the table is emptied before it is written
    staged = FileTarget(stage or stage_path(spark, "load-stage"), "parquet")
    obs = Observation("staged")
    try:
        staged.write(merged.observe(obs, F.count(F.lit(1)).alias("rows")), "overwrite")
        n_stage = int(obs.get["rows"])
    except BaseException:
        remove_path(spark, staged.path)
        raise
    try:
        target.write(staged.read(spark), "overwrite")
        # its column types may pad or round what they store: rows are counted
        n_target = target.read(spark, merged.schema).count()
        if n_stage != n_target:
            raise RuntimeError(f"load check failed: stage has {n_stage} rows, target {n_target}")
    except Exception as e:
        raise RuntimeError(f"writing the target failed; its rows are in {staged.path}") from e
    remove_path(spark, staged.path)
    return n_target


def _stage_unique(spark: SparkSession, incoming: DataFrame, key: Sequence[str],
                  order: Sequence[Column | str] | None) -> tuple[FileTarget, dict]:
    """``incoming`` with one row per key, written to a stage and counted."""
    seen, left = Observation("incoming"), Observation("unique")
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    rows = incoming.observe(seen, F.count(F.lit(1)).alias("rows"),
                            F.count_if(no_key).alias("no_key"))
    unique = survivors(rows, key, order or []).observe(left, F.count(F.lit(1)).alias("rows"))
    out = FileTarget(stage_path(spark, "load-incoming"), "parquet")
    try:
        out.write(unique, "overwrite")
    except BaseException:
        remove_path(spark, out.path)
        raise
    if seen.get["no_key"]:
        remove_path(spark, out.path)
        raise ValueError(f"{seen.get['no_key']} incoming rows have no value in their key "
                         f"{list(key)}")
    n = int(seen.get["rows"])
    return out, {"incoming": n, "duplicates": n - int(left.get["rows"])}
