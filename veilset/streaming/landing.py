"""The scrub job over a landing folder, as a Structured Streaming query.

Extract files arrive in a folder per table; each file is masked exactly once.
The stream reads the folder with the table's declared schema, joins the
static identity link (stream-static inner / left join) and writes Parquet
with a checkpoint in the shared checkpoint folder, so a restarted or failed
run resumes where it stopped.  ``availableNow`` processes what has arrived
and stops, which fits a scheduled job; a processing-time trigger keeps it
running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..catalog import TableMeta
from .. import csvio
from ..operators import mask


def landing_stream(spark: SparkSession, path: str, meta: TableMeta, *, fmt: str = "csv",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the files landing under ``path``."""
    r = spark.readStream.schema(meta.struct_type())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        return r.options(**csvio.READ).option("header", True).csv(path)
    return r.format(fmt).load(path)


def start_scrub(spark: SparkSession, meta: TableMeta, landing: str, out_path: str, *,
                identity: DataFrame | None = None, link: DataFrame | None = None, pairs=(),
                how: str = "inner", fmt: str = "csv", checkpoint: str | None = None,
                available_now: bool = True) -> StreamingQuery:
    """Start masking the files under ``landing`` into Parquet at ``out_path``.

    The checkpoint belongs to the output: unless one is given it lies below
    ``out_path`` (readers skip names that start with an underscore), so a
    second call on the same output resumes there, and files that have landed
    since are added once."""
    rows = landing_stream(spark, landing, meta, fmt=fmt)
    masked = mask.scrub(rows, meta, identity, link=link, pairs=pairs, how=how)
    w = (masked.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint or f"{out_path.rstrip('/')}/_scrub_checkpoint")
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
