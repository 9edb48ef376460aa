"""File and table sinks (K1-K5, K7).

Writers are executed by the executors in parallel straight to the target URI
(local path, HDFS, ``s3a://``); nothing is funnelled through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import csvio

FORMATS = ("csv", "parquet", "json", "orc")


def write_files(df: DataFrame, path: str, fmt: str = "csv", *, header: bool = True,
                mode: str = "overwrite", compression: str | None = None,
                partition_by: list[str] | None = None) -> str:
    """K1 / K2: write ``df`` as files of one format.

    ``mode``: overwrite | append | ignore (skip when the path exists, K5) |
    error.  ``compression="none"`` writes uncompressed files (K2).
    """
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unknown output format {fmt!r}; one of {FORMATS}")
    w = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        w = w.options(**csvio.WRITE).option("header", header).option(
            "maxRecordsPerFile", csvio.RECORDS_PER_FILE)
    if compression is not None:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_table(df: DataFrame, name: str, *, path: str | None = None,
                mode: str = "overwrite", fmt: str = "parquet") -> str:
    """K3 / K4: (re)create a catalogue table from ``df``.  With ``path`` the
    table's files live in that (shared) location."""
    w = df.write.format(fmt).mode(mode)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def stage_copy(spark: SparkSession, src: str, dst: str, fmt: str, *,
               header: bool = True, counted: Observation | None = None) -> str:
    """K7: copy of a table without PII (``<table>_stg``), same format; ``counted``
    (if given) observes its ``rows``."""
    if fmt == "csv":
        df = spark.read.options(**csvio.READ).option("header", header).csv(src)
    else:
        df = spark.read.format(fmt).load(src)
    if counted is not None:
        df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    return write_files(df, dst, fmt, header=header)


def write_sized(df: DataFrame, path: str, fmt: str = "parquet", *, rows_per_file: int,
                partition_by: list[str] | None = None, mode: str = "overwrite",
                compression: str | None = None) -> int:
    """K1 / K2 with files of a wanted size: every file but the last of a task has
    ``rows_per_file`` rows; returns the rows written, counted by the same job.

    ``partition_by`` on a skewed column would make one small file per value and
    task, and let the task of a frequent value write its files one after another.
    The rows are therefore rebalanced by these columns first: adaptive execution
    joins small partitions and splits large ones into tasks of the advisory size,
    whatever the values' shares."""
    if rows_per_file < 1:
        raise ValueError("a file has at least one row")
    obs = Observation("sized")
    even = df.hint("rebalance", *[F.col(c) for c in partition_by or ()])
    w = even.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if fmt == "csv":
        w = w.options(**csvio.WRITE).option("header", True)
        rows_per_file = min(rows_per_file, csvio.RECORDS_PER_FILE)
    if compression is not None:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("maxRecordsPerFile", rows_per_file).save(path)
    return int(obs.get["rows"])
