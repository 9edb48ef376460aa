"""A table of files under a manifest: an upsert rewrites the files it touches.

Below the table's folder:

* ``data/<commit>/``: Parquet files, never changed once written;
* ``manifest/<commit>/``: the table's files, each with its rows and the range of
  its keys (Parquet, one row per file);
* ``versions/<number>``: a small file naming the commit whose manifest is the
  table; the highest number counts.

A writer adds its files and its manifest, then creates the next version file,
which fails if that exists already: the one step that switches the table.  Until
then readers see the old version, and a writer that fails removes what it wrote.

An upsert first drops files whose key range meets none of the incoming keys'
intervals (``runs.key_runs``), then finds the files that hold an incoming key by a
semi-join over their key columns alone, and rewrites these, split by key into
files of narrow ranges.  File names reach the driver, as for any file scan; keys
and rows do not.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists, remove_path
from . import reconcile, runs

_RELATIVE = r"/data/([^/]+/[^/]+)$"


@dataclass(frozen=True)
class VersionedTarget:
    path: str
    key: tuple[str, ...]
    rows_per_file: int = 4_000_000

    # -- versions -----------------------------------------------------------

    def _fs(self, spark: SparkSession):
        sc = spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions")
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), sc._jvm.org.apache.hadoop.fs.Path

    def versions(self, spark: SparkSession) -> list[tuple[int, str]]:
        """Version numbers and their commits, ascending; one whose writer died
        before it named its commit is left out."""
        if not path_exists(spark, f"{self.path}/versions"):
            return []
        rows = spark.read.option("wholetext", True).text(f"{self.path}/versions").select(
            F.regexp_extract(F.col("_metadata.file_path"), r"/([0-9]+)$", 1).alias("n"),
            F.trim("value").alias("commit")).collect()
        return sorted((int(r["n"]), r["commit"]) for r in rows if r["commit"])

    def _switch(self, spark: SparkSession, after: int, commit: str) -> None:
        """Make ``commit`` the table, if no version came after number ``after``."""
        fs, path = self._fs(spark)
        # create() without overwrite: of two writers one fails here
        try:
            out = fs.create(path(f"{self.path}/versions/{after + 1:012d}"), False)
        except Exception as e:
            raise RuntimeError(f"{self.path}: another writer made version {after + 1}") from e
        try:
            out.write(bytearray(commit.encode()))
        finally:
            out.close()

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.versions(spark))

    # -- reading ------------------------------------------------------------

    def index(self, spark: SparkSession) -> DataFrame:
        """file, rows, low, high (structs of the key columns) of the table's files."""
        _, commit = self.versions(spark)[-1]
        return spark.read.parquet(f"{self.path}/manifest/{commit}")

    def _scan(self, spark: SparkSession, files: Sequence[str], schema=None) -> DataFrame:
        """The given files; as they all have one schema, one footer tells it."""
        full = [f"{self.path}/data/{f}" for f in files]
        schema = schema or spark.read.parquet(full[0]).schema
        return spark.read.schema(schema).parquet(*full)

    def read(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        files = sorted(r["file"] for r in self.index(spark).select("file").collect())
        if files:
            return self._scan(spark, files, schema)
        if schema is None:
            raise ValueError(f"{self.path} holds no file to tell its schema")
        return spark.createDataFrame([], schema)

    # -- writing ------------------------------------------------------------

    def _write_files(self, df: DataFrame, commit: str, rows: int | None = None) -> DataFrame:
        """Rows in files of narrow key ranges, read back and compared by
        fingerprint; the files' index rows."""
        spark = df.sparkSession
        n = [max(1, -(-rows // self.rows_per_file))] if rows is not None else []
        data, obs = reconcile.observed(
            df.repartitionByRange(*n, *self.key).sortWithinPartitions(*self.key), "written")
        (data.write.option("maxRecordsPerFile", self.rows_per_file)
         .parquet(f"{self.path}/data/{commit}"))
        found = spark.read.schema(df.schema).parquet(f"{self.path}/data/{commit}")
        wrote, got = reconcile.seen(obs), reconcile.fingerprint(found)
        if wrote != got:
            raise RuntimeError(f"load check failed: wrote {wrote}, files hold {got}")
        key = F.struct(*self.key)
        return found.groupBy(F.regexp_extract(F.col("_metadata.file_path"), _RELATIVE, 1)
                             .alias("file")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))

    def _commit(self, spark: SparkSession, make, after: int) -> None:
        """``make(commit)`` writes data and returns the index; then the switch."""
        commit = uuid.uuid4().hex
        try:
            make(commit).coalesce(1).write.parquet(f"{self.path}/manifest/{commit}")
            self._switch(spark, after, commit)
        except BaseException:
            for part in ("data", "manifest"):
                remove_path(spark, f"{self.path}/{part}/{commit}")
            raise

    def _last(self, spark: SparkSession) -> int:
        """The number of the last version file, named or not."""
        fs, path = self._fs(spark)
        folder = path(f"{self.path}/versions")
        if not fs.exists(folder):
            return 0
        return max([int(s.getPath().getName()) for s in fs.listStatus(folder)], default=0)

    def write(self, df: DataFrame, mode: str) -> None:
        """``overwrite``: these rows are the table; ``append``: they join it."""
        if mode not in ("overwrite", "append"):
            raise ValueError(f"unknown write mode {mode!r}")
        spark, after = df.sparkSession, self._last(df.sparkSession)

        def make(commit: str) -> DataFrame:
            new = self._write_files(df, commit)
            if mode == "append" and self.exists(spark):
                new = self.index(spark).unionByName(new)
            return new

        self._commit(spark, make, after)

    def touched(self, incoming: DataFrame) -> tuple[list[str], int]:
        """Files that hold a key of ``incoming``, and their rows."""
        spark, index = incoming.sparkSession, self.index(incoming.sparkSession)
        first, dtype = self.key[0], incoming.schema[self.key[0]].dataType
        wide = runs.key_runs(incoming, first)
        if not wide:
            return [], 0
        low, high = F.col("low")[first], F.col("high")[first]
        near = F.lit(False)
        for a, b in wide:
            near = near | ((high >= F.lit(a).cast(dtype)) & (low <= F.lit(b).cast(dtype)))
        near_files = {r["file"]: r["rows"] for r in index.where(near).collect()}
        if not near_files:
            return [], 0
        stored = self._scan(spark, sorted(near_files)).select(
            *self.key, F.regexp_extract(F.col("_metadata.file_path"), _RELATIVE, 1).alias("file"))
        stored = stored.where(runs.in_runs(F.col(first), dtype, wide))
        hit = stored.join(incoming.select(*self.key), list(self.key), "left_semi")
        files = sorted(r["file"] for r in hit.select("file").distinct().collect())
        return files, sum(near_files[f] for f in files)

    def upsert(self, incoming: DataFrame, rows: int) -> list[str]:
        """Incoming rows (``rows`` of them, one per key) win over stored rows of
        their key; returns the files that were rewritten.  All others stay in the
        table as they are, name and bytes."""
        spark, after = incoming.sparkSession, self._last(incoming.sparkSession)
        if not self.exists(spark):
            self._commit(spark, lambda c: self._write_files(incoming, c, rows), after)
            return []
        index = self.index(spark)
        files, held = self.touched(incoming)
        merged = incoming
        if files:
            old = self._scan(spark, files)
            kept = old.join(incoming.select(*self.key), list(self.key), "left_anti")
            merged = incoming.select(*old.columns).unionByName(kept)
        rest = index.where(~F.col("file").isin(files)) if files else index

        def make(commit: str) -> DataFrame:
            return rest.unionByName(self._write_files(merged, commit, rows + held))

        self._commit(spark, make, after)
        return files

    def vacuum(self, spark: SparkSession, keep: int = 1) -> list[str]:
        """Remove versions but the last ``keep``, and data that none of these
        names; returns the removed commits.  Not beside a running writer."""
        versions = self.versions(spark)
        kept = versions[-keep:]
        used = set()
        for _, commit in kept:
            used.add(commit)
            used |= {r["file"].split("/")[0] for r in spark.read.parquet(
                f"{self.path}/manifest/{commit}").select("file").collect()}
        fs, path = self._fs(spark)
        for number, commit in versions[:-keep]:
            remove_path(spark, f"{self.path}/versions/{number:012d}")
            remove_path(spark, f"{self.path}/manifest/{commit}")
        gone = [s.getPath().getName() for s in fs.listStatus(path(f"{self.path}/data"))
                if s.getPath().getName() not in used]
        for commit in gone:
            remove_path(spark, f"{self.path}/data/{commit}")
        return gone
