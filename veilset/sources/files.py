"""File sources.

All readers return lazy DataFrames; the only driver-side work is a bounded
look at *which* file extensions a folder holds (S8).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import csvio
from ..catalog import TableMeta, normalise_name
from ..functions.exact import altered

KNOWN_FORMATS = ("csv", "parquet")
STAGE_SUFFIX = "_stg"


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files or folders."""
    return spark.read.parquet(*paths)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
             *, header: bool = True, split: bool = False, **options) -> DataFrame:
    """CSV with a header row.  With a declared schema no inference pass is
    made; without one the schema is inferred (an extra pass over the files).

    Declared columns are found by their name in the header, whatever its
    order; a file whose header differs from the first one's, a declared column
    that is absent and a value that its type cannot hold as it is (one digit too
    many behind the point) are errors (see ``validate`` for reading with rejects).
    Without a header columns go by position.

    A record may span lines, so Spark reads a file in one task; ``split=True`` (with
    a schema and a header) reads large files by many (``splitcsv``)."""
    if split:
        from .splitcsv import read_csv_split
        if schema is None or not header or options:
            raise ValueError("a split read needs a schema and a header, and takes no options")
        return read_csv_split(spark, paths, schema)
    r = spark.read.options(**csvio.READ).option("header", header).options(**options)
    paths = paths if isinstance(paths, str) else list(paths)
    if schema is None:
        return r.option("inferSchema", True).csv(paths)
    if not header:
        return r.schema(schema).csv(paths)
    found = r.csv(paths)                       # names from the header, all text
    by_name = {c.strip().lower(): c for c in found.columns}
    absent = [f.name for f in schema.fields if f.name.lower() not in by_name]
    if absent and found.columns:
        raise ValueError(f"columns {absent} are not in the header {found.columns}")
    if not found.columns:                      # no file holds a line
        return spark.createDataFrame([], schema)
    text = r.schema(T.StructType([T.StructField(c, T.StringType()) for c in found.columns]))
    return text.csv(paths).select(*[
        as_declared(F.col(f"`{by_name[f.name.lower()]}`"), f).alias(f.name)
        for f in schema.fields])


def as_declared(raw: Column, field: T.StructField) -> Column:
    """A value as its declared type, an error where that would round it."""
    typed = raw.cast(field.dataType)
    if not isinstance(field.dataType, (T.DecimalType, T.DateType)):
        return typed
    return F.when(altered(raw, raw.try_cast(field.dataType), field.dataType), F.raise_error(
        F.concat(F.lit(f"{field.name} cannot hold as {field.dataType.simpleString()}: "),
                 raw.cast("string")))
        .cast(field.dataType)).otherwise(typed)


def declared_schema(meta: TableMeta) -> T.StructType:
    """The table's StructType from its column metadata."""
    return meta.struct_type()


def read_declared(spark: SparkSession, path: str, meta: TableMeta, fmt: str = "csv",
                  **options) -> DataFrame:
    """Read with the metadata types.  CSV is parsed straight into them;
    self-describing formats are read as they are and cast where they differ."""
    schema = declared_schema(meta)
    if fmt == "csv":
        return read_csv(spark, path, schema, **options)
    df = spark.read.format(fmt).load(path)
    return df.select(*[
        (F.col(f.name) if df.schema[f.name].dataType == f.dataType
         else as_declared(F.col(f.name), f)).alias(f.name)
        for f in schema.fields])


def read_declared_text(spark: SparkSession, path: str, meta: TableMeta,
                       fmt: str = "csv") -> DataFrame:
    """The declared columns before any conversion: CSV as text, found by name
    in the header; self-describing formats as they are.  For splitting into
    typed rows and rejects (``validate``)."""
    names = meta.names
    if fmt == "csv":
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        return read_csv(spark, path, text)
    df = spark.read.format(fmt).load(path)
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"columns {absent} are not in {df.columns}")
    return df.select(*names)


def folder_formats(spark: SparkSession, path: str, limit: int = 32) -> list[str]:
    """File extensions present under ``path`` (hidden and ``_`` files skipped).

    Listed with the binaryFile source selecting only ``path`` (contents are
    not read); at most ``limit`` distinct extensions reach the driver.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(path).select("path"))
    ext = F.lower(F.regexp_extract(F.col("path"), r"\.([A-Za-z0-9]+)$", 1))
    rows = files.select(ext.alias("ext")).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} file kinds under {path}")
    return sorted(r.ext for r in rows)


def read_folder(spark: SparkSession, path: str, schema: T.StructType, *,
                formats: Sequence[str] = KNOWN_FORMATS, header: bool = True,
                skip_suffix: str = STAGE_SUFFIX) -> DataFrame:
    """A folder holding CSV and / or Parquet files, read per format and
    unioned by name.  Sub-folders ending in ``skip_suffix`` (stage copies) are
    left out; an unknown extension is an error, not a silent skip."""
    exts = [e for e in folder_formats(spark, path) if e not in ("crc",)]
    # stage folders are looked for below the base only, not in its own path
    base = _folder_uri(spark, path)
    below = F.substr(F.col("_metadata.file_path"), F.lit(len(base) + 1))
    unknown = [e for e in exts if e not in formats]
    if unknown:
        raise ValueError(f"unknown file kinds {unknown} under {path}")
    parts = []
    for ext in exts:
        r = (spark.read.schema(schema).option("recursiveFileLookup", "true")
             .option("pathGlobFilter", f"*.{ext}"))
        df = r.options(**csvio.READ).option("header", header).csv(path) if ext == "csv" \
            else r.parquet(path)
        if skip_suffix:
            df = df.where(~F.contains(below, F.lit(f"{skip_suffix}/")))
        parts.append(df.select(*schema.fieldNames()))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), parts)


def _folder_uri(spark: SparkSession, path: str) -> str:
    """``path`` as the files below it report it (full URI, escaped)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toUri().toString().rstrip("/") + "/"


def normalise_columns(df: DataFrame) -> DataFrame:
    """Header names lower case, '.' -> '_'."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def read_key_table(spark: SparkSession, path: str, *, fmt: str = "csv") -> DataFrame:
    """A key table written with a header row of ``TABLE.COLUMN`` names.

    The header option drops the header row (no positional row drop, no RDD);
    names come back normalised (``table_column``)."""
    if fmt == "csv":
        df = spark.read.options(**csvio.READ).option("header", True).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return normalise_columns(df)


def read_key_list(spark: SparkSession, path: str, columns: Sequence[str],
                  types: Sequence[T.DataType | str] | None = None, *,
                  sep: str = ",") -> DataFrame:
    """Driver key list, one key per line, parts of a composite key
    separated by ``sep``.  Values are trimmed (lists arrive right-padded),
    typed, and de-duplicated; blank lines are skipped."""
    lines = spark.read.text(path).where(F.trim(F.col("value")) != "")
    parts = F.split(F.col("value"), "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E", -1)
    # a line with more or fewer parts than the key is an error, not a shorter key
    parts = F.when(F.size(parts) == len(columns), parts).otherwise(F.raise_error(F.concat(
        F.lit(f"key list: {len(columns)} parts expected in line: "), F.col("value")))
        .cast("array<string>"))
    cols = []
    for i, name in enumerate(columns):
        c = F.trim(parts.getItem(i))
        if types is not None:
            c = c.cast(types[i])
        cols.append(c.alias(name))
    return lines.select(*cols).distinct()
