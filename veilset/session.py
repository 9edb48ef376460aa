"""Session helpers: the shared scratch folder and recommended settings.

The library never builds its own SparkSession; callers own it.  Staged
tables (upsert stages, key tables, round trips) go to the folder the cluster
names in ``spark.checkpoint.dir`` so that every executor can read them and a
lost executor does not lose them.  Only when that setting is absent (local
tests) is a folder created here.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans are written for.  AQE re-plans joins from runtime sizes
# (broadcast only after a shuffle stage proved the side small) and splits
# skewed partitions of inner / semi / anti / outer joins.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when that needs one more shuffle after it
    # (a hot key joined twice on the same column)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # broadcast only what a finished shuffle stage measured as small: no
    # broadcast from file-size estimates, AQE converts to a broadcast join
    # when the runtime size is under the adaptive threshold
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    # keys handed to aes_encrypt / aes_decrypt appear as literals in plans;
    # keep them out of explain output and logs
    "spark.sql.redaction.string.regex": r"(?i)0x[0-9a-f]{32,}|secret|password",
}


# Sizing for a large cluster (not applied automatically; depends on the
# cluster): many initial shuffle partitions that AQE coalesces to ~128 MB,
# scan splits of 256 MB, and a bounded number of in-flight map outputs.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.shuffle.partitions": "32768",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16MB",
    "spark.reducer.maxReqsInFlight": "256",
    "spark.shuffle.io.maxRetries": "10",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def apply_recommended_conf(spark: SparkSession) -> None:
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged data: the session's checkpoint directory.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context); sets a local one only when none is configured, as in tests.
    """
    try:
        sc = spark.sparkContext
    except Exception:             # noqa: BLE001 - a connect session has no context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = (spark.conf.get("spark.master", None)
                  or (sc.master if sc is not None else "") or "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster; "
                             "a machine-local folder would lose staged data")
        configured = tempfile.mkdtemp(prefix="veilset-ckpt-")
    if sc is None:
        return configured.rstrip("/")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared scratch root."""
    return f"{scratch_root(spark)}/veilset/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of staged data on whatever file system holds it."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)


def swap_path(spark: SparkSession, new: str, path: str, old: str) -> None:
    """Put folder ``new`` in the place of ``path``, which (if there) becomes
    ``old``; if the second rename fails, the first is taken back."""
    sc = spark.sparkContext
    new_p, at, old_p = (sc._jvm.org.apache.hadoop.fs.Path(x) for x in (new, path, old))
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    had = fs.exists(at)
    if had and not fs.rename(at, old_p):
        raise RuntimeError(f"cannot rename {path}")
    if not fs.rename(new_p, at):
        if had:
            fs.rename(old_p, at)
        raise RuntimeError(f"cannot rename {new} to {path}")
