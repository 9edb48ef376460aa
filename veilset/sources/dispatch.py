"""One entry point per source kind.

Relational kinds go through the JDBC source (whole table, query, or
partitioned scan); file kinds through the file readers; a Cassandra table
through its Spark connector when that package is on the classpath (it is not
bundled: loading fails with Spark's own "data source not found" error).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import files, jdbc

FILE_KINDS = ("parquet", "csv", "json", "orc")
CONNECTOR_FORMATS = {"cassandra": "org.apache.spark.sql.cassandra"}


def reader_kind(kind: str) -> str:
    """'jdbc', 'file' or 'connector' for a database / file kind."""
    k = kind.strip().lower()
    if k in jdbc.KINDS:
        return "jdbc"
    if k in FILE_KINDS:
        return "file"
    if k in CONNECTOR_FORMATS:
        return "connector"
    raise ValueError(f"unknown source kind {kind!r}")


def read_source(spark: SparkSession, kind: str, *, table: str | None = None,
                query: str | None = None, path: str | None = None, schema=None,
                jdbc_source: jdbc.JdbcSource | None = None, options: dict | None = None,
                partition: dict | None = None) -> DataFrame:
    """Read one table of any supported kind (lazy)."""
    how = reader_kind(kind)
    if how == "jdbc":
        src = jdbc_source or jdbc.JdbcSource(kind.lower())
        if partition:
            return jdbc.read_partitioned(spark, src, query or table, **partition)
        if query:
            return jdbc.read_query(spark, src, query)
        return jdbc.read_table(spark, src, table)
    if how == "file":
        k = kind.lower()
        if k == "csv":
            return files.read_csv(spark, path, schema, **(options or {}))
        r = spark.read.format(k)
        if schema is not None:
            r = r.schema(schema)
        return r.options(**(options or {})).load(path)
    keyspace, _, name = (table or "").partition(".")
    return (spark.read.format(CONNECTOR_FORMATS[kind.lower()])
            .options(keyspace=keyspace, table=name, **(options or {})).load())
