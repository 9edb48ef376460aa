"""Helpers shared by the training-data operators.

Conventions every operator follows:

* an operator selects the columns it names and carries the rest of the row, if
  it returns it, inside one struct column, so extra columns of the input never
  clash with working columns, whatever they are called;
* a NULL text counts as the empty text, a NULL id is a value like any other;
* repeated rows stay repeated, unless the operator's purpose is to remove them;
* intermediate tables go to the cluster's shared folder (``spark.checkpoint.dir``)
  as Parquet, never to a local folder, so a lost executor costs a re-read.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_path

# The word and white-space classes of the contracts (ASCII white space only).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder, read by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_code(spark: SparkSession | None = None) -> None:
    """Give the executors this package (``addPyFile``), once per context, so
    that Python functions find it on a cluster that has no copy of it."""
    sc = (spark or SparkSession.active()).sparkContext
    if getattr(sc, "_veilset_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="veilset-code-"), "veilset.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._veilset_shipped = True


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(col: Column | str) -> Column:
    """UTF-8 bytes of a text column, NULL as empty."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string").cast("binary"), F.lit(b""))


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct (``row``)."""
    return F.struct(*[F.col(_quoted(c)) for c in df.columns]).alias("row")


def unpack_row(df: DataFrame) -> DataFrame:
    """The columns that :func:`whole_row` packed, in their order."""
    return df.select("row.*")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rows_to_struct(rows: list[tuple], schema: pa.StructType) -> pa.Array:
    """Python tuples to an Arrow struct array of the given type."""
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.StructArray.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(cols, schema, strict=True)],
        fields=list(schema))


def bytes_udf(fn, ddl: str, schema: pa.StructType):
    """Arrow UDF applying ``fn(bytes) -> tuple`` to every value of a binary
    column.  Marked non-deterministic so that the optimizer neither repeats
    it in a pushed filter nor drops it into several projections."""
    ship_code()

    @F.arrow_udf(ddl)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield rows_to_struct([fn(v.as_py() or b"") for v in batch], schema)

    return run.asNondeterministic()
