"""One large CSV file read by many tasks, records over several lines included.

Whether a line break ends a record depends on every quote before it in the file,
which is why Spark reads such a file in one task.  But only the quotes' parity
counts, and parities add up:

1. the text source deals a file out in ranges; each range counts its quotes;
2. a running sum over the ranges (a row per range) tells whether a range starts
   inside a quoted field, and which record is open there;
3. with that, every line of a range knows its record.  Lines that are a record by
   themselves stay where they are; the lines of longer ones are put together,
   across ranges where need be, and ``from_csv`` reads each record.

The files are read twice (the sums, the lines); lines are sorted within their range
only, and only records over several lines are shuffled a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import csvio

MAX_LINES = 100_000        # of one record; an unclosed quote would never end

# of the reading options, those that say how a record is taken apart
_FIELDS = {k: v for k, v in csvio.READ.items()
           if k not in ("multiLine", "enforceSchema", "lineSep")}


def _quotes(line: Column) -> Column:
    return F.char_length(line) - F.char_length(F.replace(line, F.lit('"')))


def record_lines(spark: SparkSession, paths: str | Sequence[str],
                 max_lines: int = MAX_LINES) -> DataFrame:
    """file, first, record: the text of every CSV record of the files, without its
    line end; ``first`` marks the first record of a file.  A record of more than
    ``max_lines`` lines is an error."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"), F.col("value").alias("line"))
    # the same lines twice: a range's sums need no order
    sums = lines.groupBy("file", "block").agg((F.sum(_quotes(F.col("line"))) % 2).alias("odd"))
    of_file = Window.partitionBy("file").orderBy("block")           # a row per range
    before = of_file.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("file").alias("f"), F.col("block").alias("b"), (F.coalesce(
        F.sum("odd").over(before), F.lit(0)) % 2).alias("open"))
    # joined by range: a row per range, AQE broadcasts it when it is small
    in_range = Window.partitionBy("file", "block").orderBy("nth")
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lines.join(sums, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    rows = rows.select("file", "block", "nth", "line", (
        (F.col("open") + F.sum(_quotes(F.col("line"))).over(so_far)) % 2).alias("open_after"),
        F.col("open"))
    starts = F.coalesce(F.lag("open_after").over(in_range), F.col("open")) == 0
    # a file's first record is the first line of its first range
    first = (F.col("block") == 0) & (F.row_number().over(in_range) == 1)
    rows = rows.select("file", "block", "nth", "line", "open_after", starts.alias("starts"),
                       first.alias("first"))
    rows = rows.withColumn("own", F.max(F.when(F.col("starts"), F.col("nth"))).over(so_far))
    # lines before a range's first start belong to the last record begun before it
    ends = rows.groupBy("file", "block").agg(
        F.max(F.when(F.col("starts"), F.col("nth"))).alias("last"))
    ends = ends.select(F.col("file").alias("f"), F.col("block").alias("b"),
                       F.last("last", ignorenulls=True).over(before).alias("carried"))
    single = rows.where(F.col("starts") & (F.col("open_after") == 0)).select(
        "file", "first", "line")
    longer = rows.where(~(F.col("starts") & (F.col("open_after") == 0)))
    inside = longer.where("own IS NOT NULL").select("file", "block", "nth", "line", "first", "own")
    carried = longer.where("own IS NULL").join(
        ends, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).select(
        "file", "block", "nth", "line", "first", F.col("carried").alias("own"))
    many = inside.unionByName(carried).groupBy("file", "own").agg(
        F.count(F.lit(1)).alias("n"), F.max("first").alias("first"),
        F.sort_array(F.collect_list(F.struct("block", "nth", "line"))).alias("parts"))
    too_long = F.raise_error(F.concat(F.lit("a record has more lines than allowed, is a quote "
                                            "left open in "), F.col("file"))).cast("string")
    many = many.select("file", "first", F.when(
        F.col("n") > max_lines, too_long).otherwise(F.array_join(
            F.transform("parts", lambda p: p["line"]), "\n")).alias("line"))
    return single.unionByName(many).select(
        "file", "first", F.regexp_replace("line", "\r$", "").alias("record"))


def read_csv_split(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, *,
                   max_lines: int = MAX_LINES) -> DataFrame:
    """CSV files with a header row and declared columns, each file read by as
    many tasks as it has splits.  Columns are found by name, as ``files.read_csv``
    does; a file whose header differs from the others', and a record that does not
    fit, are errors."""
    from .files import as_declared
    head = spark.read.options(**csvio.READ).option("header", True).csv(
        paths if isinstance(paths, str) else list(paths)).columns
    by_name = {c.strip().lower(): c for c in head}
    absent = [f.name for f in schema.fields if f.name.lower() not in by_name]
    if absent:
        raise ValueError(f"columns {absent} are not in the header {head}")
    records = record_lines(spark, paths, max_lines)
    text = T.StructType([T.StructField(c, T.StringType()) for c in head])
    fields = F.from_csv("record", _ddl(text), _FIELDS)
    rows = records.where(F.col("first") | (F.trim("record") != "")).select(
        "file", "first", fields.alias("r"))
    same = F.lit(True)
    for c in head:
        same = same & F.col("r")[c].eqNullSafe(F.lit(c))
    other = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
    rows = rows.where(~F.when(F.col("first") & ~same, other).otherwise(F.col("first")))
    return rows.select(*[as_declared(F.col("r")[by_name[f.name.lower()]], f).alias(f.name)
                         for f in schema.fields])


def _ddl(schema: T.StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema.fields)
