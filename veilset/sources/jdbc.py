"""JDBC sources (S1-S5) and the JDBC side of load targets (K8).

Only options are built here; Spark's JDBC data source does the reading, in
parallel when a partition column is given.  Filters written as DataFrame
predicates on a ``dbtable`` scan are pushed into the database query by
Catalyst; a semi join with a key DataFrame is not, so small key sets are
turned into an ``IN`` filter after a size check (see ``subset.semi_join``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# fixed values: JDBC URL form and driver class per database kind
KINDS = {
    "oracle": ("jdbc:oracle:thin:@//{host}:{port}/{database}", "oracle.jdbc.OracleDriver"),
    "sqlserver": ("jdbc:sqlserver://{host}:{port};databaseName={database}",
                  "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    "postgresql": ("jdbc:postgresql://{host}:{port}/{database}", "org.postgresql.Driver"),
    "derby": ("jdbc:derby:{database}", "org.apache.derby.jdbc.EmbeddedDriver"),
}
DEFAULT_FETCH_SIZE = 10000


@dataclass(frozen=True)
class JdbcSource:
    """Where and how to reach one database (credentials passed by the caller)."""
    kind: str
    host: str = ""
    port: int | None = None
    database: str = ""
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    fetch_size: int | None = DEFAULT_FETCH_SIZE
    extra: tuple[tuple[str, str], ...] = ()

    def url(self) -> str:
        if self.kind not in KINDS:
            raise ValueError(f"no JDBC form for database kind {self.kind!r}")
        return KINDS[self.kind][0].format(host=self.host, port=self.port or "",
                                           database=self.database)

    def options(self) -> dict[str, str]:
        """Options for ``spark.read.format('jdbc')`` of this kind."""
        opts = {"url": self.url(), "driver": KINDS[self.kind][1]}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.fetch_size:
            opts["fetchsize"] = str(self.fetch_size)
        opts.update(dict(self.extra))
        return opts


def read_table(spark: SparkSession, src: JdbcSource, table: str) -> DataFrame:
    """S3: a whole table; later DataFrame filters / projections are pushed."""
    return spark.read.format("jdbc").options(**src.options()).option("dbtable", table).load()


def read_query(spark: SparkSession, src: JdbcSource, sql: str) -> DataFrame:
    """The result of a query (no partitioning)."""
    return spark.read.format("jdbc").options(**src.options()).option("query", sql).load()


def partition_options(column: str, lower: int | str, upper: int | str,
                      partitions: int) -> dict[str, str]:
    """Stride partitioning of a scan over ``column``."""
    if partitions < 1:
        raise ValueError("partitions must be positive")
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions)}


def partitioned_scan_options(src: JdbcSource, table_or_query: str, *, column: str,
                             lower, upper, partitions: int) -> dict[str, str]:
    """All options of a parallel scan.  A query is wrapped as a derived
    table (``query`` and ``partitionColumn`` cannot be combined)."""
    t = table_or_query.strip()
    dbtable = f"({t}) q" if t.lower().startswith(("select", "with")) else t
    return {**src.options(), "dbtable": dbtable,
            **partition_options(column, lower, upper, partitions)}


def read_partitioned(spark: SparkSession, src: JdbcSource, table_or_query: str, *,
                     column: str, lower, upper, partitions: int) -> DataFrame:
    """Parallel scan, one range of ``column`` per task."""
    return spark.read.format("jdbc").options(**partitioned_scan_options(
        src, table_or_query, column=column, lower=lower, upper=upper,
        partitions=partitions)).load()


def write_options(src: JdbcSource, table: str, *, truncate: bool = True,
                  batch_size: int = 10000, max_connections: int = 32) -> dict[str, str]:
    """K8: options of a JDBC write.  ``numPartitions`` caps the concurrent
    connections (Spark coalesces to it), so a plan with thousands of tasks
    does not open thousands of sessions on the database."""
    return {**src.options(), "dbtable": table, "truncate": str(truncate).lower(),
            "batchsize": str(batch_size), "numPartitions": str(max_connections)}


def write_table(df: DataFrame, src: JdbcSource, table: str, mode: str, **kw) -> None:
    """K8: overwrite (truncate, table kept) or append rows."""
    df.write.format("jdbc").options(**write_options(src, table, **kw)).mode(mode).save()


def request_scan_options(src: JdbcSource, meta, *, partitions: int | None = None,
                         default_partitions: int = 64) -> dict[str, str]:
    """S5 from a table request: the whole table, or - when the request names a
    partition column and its range - a parallel scan over that range.
    ``partitions`` defaults to ``default_partitions`` (one task each)."""
    table = f"{meta.schema_name}.{meta.table_name}" if meta.schema_name else meta.table_name
    if meta.partition_column and meta.partition_range:
        lo, hi = meta.partition_range
        return partitioned_scan_options(src, table, column=meta.partition_column, lower=lo,
                                        upper=hi, partitions=partitions or default_partitions)
    return {**src.options(), "dbtable": table}


def read_request_table(spark: SparkSession, src: JdbcSource, meta, **kw) -> DataFrame:
    """Scan of a request's table (see ``request_scan_options``); request
    filters and the extract projection applied afterwards are pushed into the
    database query by Catalyst."""
    return spark.read.format("jdbc").options(**request_scan_options(src, meta, **kw)).load()
