"""Source and sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import samples
from ..operators import subset
from ..registry import query
from ..session import stage_path
from ..sinks.files import stage_copy, write_files, write_sized, write_table
from ..sources.splitcsv import read_csv_split
from ..sources import files

def driver():
    return F.col("c_mktsegment") == "BUILDING"



def _t(spark, sf):
    return samples.load_tables(spark, sf, ("customer", "orders", "part"))


@query("src_parquet", "SELECT * FROM orders")
def src_parquet(spark, sf):
    return files.read_parquet(spark, f"{sf.rstrip('/')}/orders.parquet")


@query("src_csv", "SELECT * FROM customer")
def src_csv(spark, sf):
    """CSV files with a header row, parsed into the declared types."""
    path = write_files(_t(spark, sf)["customer"], stage_path(spark, "customer-csv"), "csv")
    return files.read_csv(spark, path, files.declared_schema(samples.META["customer"]))


@query("src_declared_schema", "SELECT * FROM orders")
def src_declared_schema(spark, sf):
    """The StructType comes from the column metadata (NUMBER, CHAR,
    VARCHAR2, DATE with time of day)."""
    path = write_files(_t(spark, sf)["orders"], stage_path(spark, "orders-csv"), "csv")
    return files.read_declared(spark, path, samples.META["orders"], "csv")


@query("src_mixed_dir", "SELECT * FROM orders")
def src_mixed_dir(spark, sf):
    """One folder with CSV and Parquet parts; a ``_stg`` copy inside is
    not read."""
    o = _t(spark, sf)["orders"]
    base = stage_path(spark, "orders-mixed")
    write_files(o.where(F.col("o_orderstatus") == "F"), f"{base}/part_csv", "csv")
    write_files(o.where(F.col("o_orderstatus") != "F"), f"{base}/part_parquet", "parquet")
    write_files(o, f"{base}/orders_stg", "parquet")
    return files.read_folder(spark, base, files.declared_schema(samples.META["orders"]))


@query("src_key_table", """
SELECT DISTINCT c.c_custkey AS customer_c_custkey, o.o_orderkey AS orders_o_orderkey
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey WHERE c.c_mktsegment = 'BUILDING'""")
def src_key_table(spark, sf):
    """Key table files with ``TABLE.COLUMN`` headers, names normalised."""
    t = _t(spark, sf)
    chain = subset.key_chain(t, samples.META["orders"], samples.PRIMARY_KEYS,
                             driver_filter=driver())
    path = write_files(subset.dotted(chain), stage_path(spark, "keys-orders"), "csv")
    keys = files.read_key_table(spark, path)
    return keys.select(F.col("customer_c_custkey").cast("bigint"),
                       F.col("orders_o_orderkey").cast("bigint"))


@query("src_key_list", """
SELECT DISTINCT c_custkey, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'""")
def src_key_list(spark, sf):
    """A right-padded text key list with composite keys."""
    t = _t(spark, sf)
    lines = t["customer"].where(driver()).select(
        F.rpad(F.concat_ws(",", "c_custkey", "c_nationkey"), 24, " ").alias("value"))
    path = stage_path(spark, "driver-keys")
    lines.write.text(path)
    return files.read_key_list(spark, path, ["c_custkey", "c_nationkey"], ["bigint", "int"])


@query("sink_csv_roundtrip", "SELECT * FROM orders")
def sink_csv_roundtrip(spark, sf):
    """K1: CSV with header, overwrite; read back with the declared schema."""
    o = _t(spark, sf)["orders"]
    path = stage_path(spark, "orders-out")
    write_files(o.where(F.col("o_orderstatus") == "F"), path, "csv")
    write_files(o, path, "csv", mode="overwrite")
    return files.read_csv(spark, path, files.declared_schema(samples.META["orders"]))


@query("sink_parquet_roundtrip", "SELECT * FROM orders")
def sink_parquet_roundtrip(spark, sf):
    """K2: uncompressed Parquet."""
    path = write_files(_t(spark, sf)["orders"], stage_path(spark, "orders-pq"), "parquet",
                       compression="none")
    return files.read_parquet(spark, path)


@query("sink_table", "SELECT * FROM orders")
def sink_table(spark, sf):
    """K3 / K4: (re)create a catalogue table whose files are in the shared store."""
    name = f"veilset_orders_{uuid.uuid4().hex[:8]}"
    write_table(_t(spark, sf)["orders"], name, path=stage_path(spark, name))
    return spark.table(name)


@query("stage_copy", "SELECT * FROM part")
def stage_copy_query(spark, sf):
    """K7: a table without PII is copied to ``<table>_stg`` unchanged."""
    src = write_files(_t(spark, sf)["part"], stage_path(spark, "part"), "csv")
    dst = stage_copy(spark, src, src + "_stg", "csv")
    return files.read_csv(spark, dst, _t(spark, sf)["part"].schema)


# ---------------------------------------------------------------------------
# CSV keeps what it is given: line breaks, quotes, blanks, empty strings, NULLs

def _csv_text(name):
    @query(f"sink_csv_{name}", f"SELECT * FROM {name}")
    def roundtrip(spark, sf):
        """K1 + S6 on long texts: written as CSV, read back as it was."""
        df = samples.load_tables(spark, sf, (name,))[name]
        path = write_files(df, stage_path(spark, f"{name}-csv"), "csv")
        return files.read_csv(spark, path, df.schema)

    return roundtrip


for _name in ("documents", "pages", "conversations"):
    _csv_text(_name)


@query("sink_csv_odd_text", """
SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' || c_name
  WHEN 3 THEN c_name || ' ' WHEN 4 THEN c_name || chr(10) || c_name WHEN 5 THEN '"' || c_name || ',"'
  WHEN 6 THEN '\\' || c_name || '\\' ELSE chr(13) || chr(10) || c_name || chr(9) END AS note
FROM customer""")
def sink_csv_odd_text(spark, sf):
    """K1 / K7: NULL beside the empty string, blanks at both ends, line breaks,
    quotes and backslashes; copied once more as a stage before it is read."""
    c = _t(spark, sf)["customer"]
    k = F.col("c_custkey") % 8
    note = (F.when(k == 0, F.lit(None)).when(k == 1, F.lit(""))
            .when(k == 2, F.concat(F.lit("  "), "c_name")).when(k == 3, F.concat("c_name", F.lit(" ")))
            .when(k == 4, F.concat("c_name", F.lit("\n"), "c_name"))
            .when(k == 5, F.concat(F.lit('"'), "c_name", F.lit(',"')))
            .when(k == 6, F.concat(F.lit("\\"), "c_name", F.lit("\\")))
            .otherwise(F.concat(F.lit("\r\n"), "c_name", F.lit("\t"))))
    df = c.select("c_custkey", note.alias("note"))
    src = write_files(df, stage_path(spark, "odd-csv"), "csv")
    return files.read_csv(spark, stage_copy(spark, src, src + "_stg", "csv"), df.schema)


@query("src_csv_reordered", "SELECT * FROM orders")
def src_csv_reordered(spark, sf):
    """The header's columns come in another order, with one more among
    them; declared columns are found by name."""
    o = _t(spark, sf)["orders"]
    mixed = o.select(*reversed(o.columns), F.lit("x").alias("extra"))
    path = write_files(mixed, stage_path(spark, "orders-reordered"), "csv")
    return files.read_declared(spark, path, samples.META["orders"], "csv")


@query("src_mixed_dir_below_stage", "SELECT * FROM orders")
def src_mixed_dir_below_stage(spark, sf):
    """S8 on a base folder that itself lies below a folder named as a stage."""
    o = _t(spark, sf)["orders"]
    base = stage_path(spark, "area_stg") + "_stg/run"
    late = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    write_files(o.where(late), f"{base}/part_csv", "csv")
    write_files(o.where(~late), f"{base}/part_parquet", "parquet")
    write_files(o, f"{base}/orders_stg", "parquet")
    return files.read_folder(spark, base, files.declared_schema(samples.META["orders"]))


@query("src_csv_split", """
SELECT doc_id, text, lang, source, n_chars FROM documents""")
def src_csv_split(spark, sf):
    """Texts of many lines in CSV files of adaptive execution's size (one, if they
    are few), each read by several tasks (splits far smaller than the file), records
    over line and split borders put together."""
    docs = samples.load_tables(spark, sf, ("documents",))["documents"]
    path = write_files(docs.hint("rebalance"), stage_path(spark, "large-csv"), "csv")
    key = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        out = read_csv_split(spark, path, docs.schema)
        # splits are dealt out when the plan runs: written here, under the setting
        kept = write_files(out, stage_path(spark, "split-read"), "parquet")
    finally:
        spark.conf.set(key, was)
    return spark.read.parquet(kept)


@query("sink_sized", """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_returnflag END AS part, count(*) AS rows,
       true AS within FROM lineitem
GROUP BY ALL""")
def sink_sized(spark, sf):
    """K1: files of at most a tenth of the rows, partitioned by a column of which one
    value holds a third of all rows; no value in more small files than tasks need."""
    li = samples.load_tables(spark, sf, ("lineitem",))["lineitem"]
    df = li.withColumn("part", F.when(F.col("l_orderkey") % 3 == 0, "hot")
                       .otherwise(F.col("l_returnflag")))
    path, most = stage_path(spark, "sized"), max(1, li.count() // 10)
    n = write_sized(df, path, rows_per_file=most, partition_by=["part"])
    back = spark.read.parquet(path)
    of = back.groupBy("part", F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n"))
    out = of.groupBy("part").agg(F.sum("n").alias("rows"), (
        (F.max("n") <= most) & (F.count(F.lit(1)) <= F.ceil(F.sum("n") / most) + 8)).alias("within"))
    return out if n == li.count() else out.limit(0)
