"""Row counts and job records (A1, A2, K9).

The count of a written extract comes from an ``Observation`` on the write
itself: one pass over the source instead of the reference's count-then-write
(two full scans).
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = ("request_id string, status string, job_type string, "
                "records_processed bigint")
STATUS_COMPLETE = "COMPLETE"
STATUS_FAILED = "FAILED"


def write_counted(df: DataFrame, write: Callable[[DataFrame], object],
                  name: str = "written") -> int:
    """A1: run ``write`` on ``df`` and return the rows it wrote."""
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


def audit_record(spark: SparkSession, request_id: str, status: str, job_type: str,
                 records: int) -> DataFrame:
    """K9: the one-row status record of a job."""
    return spark.createDataFrame([(request_id, status, job_type, int(records))], AUDIT_SCHEMA)


@dataclass
class Outcome:
    """What a job has to report when it ends."""

    spark: SparkSession
    request_id: str
    job_type: str
    records: int = 0
    status: str = STATUS_COMPLETE

    def record(self) -> DataFrame:
        return audit_record(self.spark, self.request_id, self.status, self.job_type, self.records)


@contextmanager
def recorded(spark: SparkSession, request_id: str, job_type: str, path: str | None):
    """K9 around a job: its record is appended to ``path`` (if given) when it
    ends, with FAILED when it ends in an error, which is passed on."""
    done = Outcome(spark, request_id, job_type)
    try:
        yield done
    except Exception:
        done.status, done.records = STATUS_FAILED, 0
        raise
    finally:
        if path is not None:
            append_audit(done.record(), path)


def gated_write(df: DataFrame, write: Callable[[DataFrame], object], *,
                probe: bool = True, undo: Callable[[], object] | None = None) -> int:
    """A2: an empty extract records 0, encrypts nothing and leaves no files;
    otherwise the write is counted.

    ``probe=True`` checks ``isEmpty`` first and writes nothing at all for an
    empty result: right for plans without a shuffle, where the probe stops at
    the first row.  For plans with shuffles (relational extracts) a probe
    would run every map stage once more, so ``probe=False`` writes in a single
    counted pass; ``undo`` then removes what an empty result has written (and
    what an earlier run left there)."""
    n = 0 if probe and df.isEmpty() else write_counted(df, write)
    if not n and undo is not None:
        undo()
    return n


def append_audit(record: DataFrame, path: str) -> None:
    """K9: append a record to the audit table (files in the shared store)."""
    record.write.mode("append").parquet(path)
