"""Load job as DataFrame steps: files -> typed rows and rejects -> key restore
-> key check -> full refresh / append / upsert through a stage -> audit record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import TableMeta
from ..operators import audit, load, validate
from ..session import remove_path, stage_path
from ..sinks.files import write_files
from ..sources.files import read_declared_text


def run_load(spark: SparkSession, path: str, meta: TableMeta, target, mode: str, *,
             fmt: str = "csv", restore_map: DataFrame | None = None,
             restore_column: str | None = None, order: Sequence[Column | str] | None = None,
             fail_on_invalid: bool = True, rejects_path: str | None = None,
             check_keys: bool | None = None, audit_path: str | None = None) -> DataFrame:
    """Load one table's files into ``target``; returns the audit record.

    The files are read once, as text, and split into rows that fit their
    declared types, lengths and NOT NULL columns, and rejects.  With
    ``fail_on_invalid`` any reject fails the job before the target is touched;
    otherwise the good rows are loaded, and the rejects (raw row, and every
    failing column with its raw value) are written to ``rejects_path`` (by
    default a folder of the shared scratch root).  A
    primary key that repeats fails the job too (``check_keys``, by default as
    ``fail_on_invalid``; an upsert keeps one row per key instead).  With
    ``audit_path`` the record is appended there, with FAILED if the job fails.
    """
    rejects_path = rejects_path or stage_path(spark, "load-rejects")
    check = fail_on_invalid if check_keys is None else check_keys
    with audit.recorded(spark, meta.request_id, "LOAD", audit_path) as done:
        stage = stage_path(spark, "load-split")
        try:
            done.records = _load(spark, path, meta, target, mode, stage, fmt, restore_map,
                                 restore_column, order, fail_on_invalid, rejects_path, check)
        finally:
            remove_path(spark, stage)         # production rows, however the job ends
    return done.record()


def _load(spark: SparkSession, path: str, meta: TableMeta, target, mode: str, stage: str,
          fmt: str, restore_map, restore_column, order, fail_on_invalid: bool,
          rejects_path: str, check: bool) -> int:
    text = read_declared_text(spark, path, meta, fmt)
    validate.write_typed_split(text, meta, stage)
    mark = validate.SplitNames.of(meta.names)
    split = spark.read.parquet(stage)
    rejected = split.where(F.col(mark.status) == "rejected")
    # a row per column at most
    kinds = rejected.groupBy(F.col(mark.column).alias("column")).count().collect()
    if kinds and fail_on_invalid:
        raise ValueError(f"{meta.table_name}: rows fail their metadata: " + ", ".join(
            sorted(f"{r['column']}={r['count']}" for r in kinds)))
    if kinds:
        write_files(rejected.drop(mark.status, *meta.names), rejects_path, "parquet")
    rows = split.where(F.col(mark.status) == "good").select(*meta.names)
    if restore_map is not None and restore_column:
        rows = load.restore_keys(rows, restore_map, restore_column)
    if check and mode != "upsert" and meta.primary_key and \
            not validate.duplicate_keys(rows, meta.primary_key).isEmpty():
        raise ValueError(f"{meta.table_name}: the primary key {meta.primary_key} repeats")
    return load.load(spark, rows, target, mode, key=meta.primary_key, order=order)
