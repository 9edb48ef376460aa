"""The three jobs end to end: extract to files, scrub those files, load them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from .. import samples
from ..catalog import TableMeta
from ..operators import load, mask, validate
from ..plans.extract import run_extract
from ..plans.load import run_load
from ..plans.scrub import run_scrub
from ..registry import query
from ..session import stage_path
from ..sinks.files import write_files
from ..operators.subset import undotted
from ..sources.files import read_declared
from .extract import read_key_table_raw
from .mask import GENERATOR, IDS_ALL, _lineitem_sql

DRIVER_SQL = "c_mktsegment = 'BUILDING'"
RESTORE_OFFSET = 5_000_000


def driver():
    return F.col("c_mktsegment") == "BUILDING"


def _t(spark, sf):
    return samples.load_tables(spark, sf, ("customer", "orders", "lineitem"))


def _extract(spark, t, table, keys=None):
    meta = samples.META[table]
    out = stage_path(spark, f"extract-{table}")
    run_extract(spark, t, meta, out, driver_filter=driver(),
                key_base=keys or stage_path(spark, "keys"), primary_keys=samples.PRIMARY_KEYS)
    return read_declared(spark, out, meta, "csv")


@query("extract_job", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       CAST(NULL AS DOUBLE) AS l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       l_shipdate
FROM lineitem WHERE l_orderkey IN (
  SELECT o_orderkey FROM orders WHERE o_custkey IN (
    SELECT c_custkey FROM customer WHERE {DRIVER_SQL}))""")
def extract_job(spark, sf):
    """Extract job: hops, PII nulled, CSV files and key tables written, counted;
    the files are read back with the declared schema."""
    return _extract(spark, _t(spark, sf), "lineitem")


@query("scrub_job", _lineitem_sql(IDS_ALL))
def scrub_job(spark, sf):
    """Scrub job over the extract's files: the driver link comes from the key
    tables the extract wrote (no source table is read again), then mask and
    write."""
    t = _t(spark, sf)
    keys = stage_path(spark, "keys")
    rows = _extract(spark, t, "lineitem", keys)
    meta = samples.META["lineitem"]
    levels = {name: undotted(read_key_table_raw(spark, f"{keys}/{name}"))
              for name in ("customer", "orders")}
    levels = {name: df.select(*[F.col(c).cast("bigint") for c in df.columns])
              for name, df in levels.items()}
    link, pairs = mask.link_from_key_tables(levels, meta, samples.UNIQUE_KEYS)
    out = stage_path(spark, "scrubbed")
    run_scrub(spark, rows, meta, out, identity=GENERATOR, link=link, pairs=pairs)
    return spark.read.parquet(out)


@query("load_job", f"""
WITH ext AS (
  SELECT o_orderkey, o_custkey + {RESTORE_OFFSET} AS o_custkey, o_orderstatus,
         CAST(NULL AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE {DRIVER_SQL}))
SELECT * FROM ext
UNION ALL SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ext)""")
def load_job(spark, sf):
    """Load job: extracted order files, keys restored to production keys,
    validated, upserted into the stored orders through a stage."""
    t = _t(spark, sf)
    meta = samples.META["orders"]
    out = stage_path(spark, "extract-orders")
    run_extract(spark, t, meta, out, driver_filter=driver())
    target = load.FileTarget(stage_path(spark, "target-orders"), "parquet")
    target.write(t["orders"], "overwrite")
    restore = t["customer"].where(driver()).select(
        F.col("c_custkey").alias("test_key"), (F.col("c_custkey") + RESTORE_OFFSET).alias("prod_key"))
    run_load(spark, out, meta, target, "upsert", restore_map=restore, restore_column="o_custkey")
    return target.read(spark)


# ---------------------------------------------------------------------------
# jobs on what is not clean, and with their options

ENV_KEY = samples.TEST_ENV_KEY


@query("load_job_rejects", """
SELECT o_orderkey, 'good' AS side, CAST(NULL AS VARCHAR) AS columns, CAST(NULL AS VARCHAR) AS vals
FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL
SELECT o_orderkey, 'rejected', CASE WHEN o_orderkey % 2 = 0 THEN 'o_custkey,o_orderdate'
         ELSE 'o_orderdate' END,
       CASE WHEN o_orderkey % 2 = 0 THEN 'c' || CAST(o_custkey AS VARCHAR) || ',not a date'
         ELSE 'not a date' END
FROM orders WHERE o_orderkey % 7 = 0""")
def load_job_rejects(spark, sf):
    """U4 + U8 + K8: a file with bad keys and dates; the good rows are loaded,
    every reject keeps its failing columns with their raw values."""
    o = _t(spark, sf)["orders"]
    meta = samples.META["orders"]
    bad = F.col("o_orderkey") % 7 == 0
    worse = bad & (F.col("o_orderkey") % 2 == 0)
    text = o.select(*[F.col(c).cast("string").alias(c) for c in o.columns]).withColumns({
        "o_orderdate": F.when(bad, F.lit("not a date")).otherwise(F.col("o_orderdate")),
        "o_custkey": F.when(worse, F.concat(F.lit("c"), "o_custkey"))
        .otherwise(F.col("o_custkey"))})
    src = write_files(text, stage_path(spark, "orders-bad"), "csv")
    target = load.FileTarget(stage_path(spark, "target-orders"), "parquet")
    rejects = stage_path(spark, "rejects")
    run_load(spark, src, meta, target, "full_refresh", fail_on_invalid=False,
             rejects_path=rejects)
    none = F.lit(None).cast("string")
    good = target.read(spark).select("o_orderkey", F.lit("good").alias("side"),
                                     none.alias("columns"), none.alias("vals"))
    raw = F.get_json_object("reject_row", "$.o_orderkey").cast("bigint")
    return good.unionAll(spark.read.parquet(rejects).select(
        raw, F.lit("rejected"),
        F.array_join(F.transform("rejects", lambda x: x["column"]), ","),
        F.array_join(F.transform("rejects", lambda x: x["value"]), ",")))


@query("load_job_failed", f"""
SELECT '{samples.META['orders'].request_id}' AS request_id, 'FAILED' AS status,
       'LOAD' AS job_type, CAST(0 AS BIGINT) AS records_processed""")
def load_job_failed(spark, sf):
    """K9: orders whose primary key repeats fail the load before the target is
    touched; the audit table has the FAILED record."""
    o = _t(spark, sf)["orders"]
    src = write_files(o.unionAll(o.where("o_orderstatus = 'F'")), stage_path(spark, "twice"), "csv")
    target = load.FileTarget(stage_path(spark, "target-orders"), "parquet")
    log = stage_path(spark, "audit")
    try:
        run_load(spark, src, samples.META["orders"], target, "full_refresh", audit_path=log)
    except ValueError:
        pass
    record = spark.read.parquet(log)
    return record if not target.exists(spark) else record.limit(0)


@query("extract_job_ordered", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice, o_orderdate,
       o_orderpriority
FROM (SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25)""")
def extract_job_ordered(spark, sf):
    """The limit follows the order of a PII column's own values, which the
    extract then leaves out."""
    meta = replace(samples.META["orders"], edges=(), relational=False, extract_type="F",
                   order=("o_totalprice", "o_orderkey"), limit=25)
    out = stage_path(spark, "ordered")
    run_extract(spark, _t(spark, sf), meta, out)
    return read_declared(spark, out, meta, "csv")


@query("extract_job_encrypted", f"""
SELECT o_orderkey, o_orderstatus, true AS differs
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE {DRIVER_SQL})""")
def extract_job_encrypted(spark, sf):
    """E1 in the job: a primary key that is PII is written as ciphertext
    (``differs``: no cipher equals its plain value, and all are distinct)."""
    from ..operators import protect
    t = _t(spark, sf)
    meta = samples.META["orders"]
    secret = replace(meta, columns=tuple(
        replace(c, is_pii=True) if c.name == "o_orderkey" else c for c in meta.columns))
    out = stage_path(spark, "encrypted")
    run_extract(spark, t, secret, out, fmt="parquet", env_key=ENV_KEY, driver_filter=driver(),
                primary_keys=samples.PRIMARY_KEYS)
    cipher = spark.read.parquet(out).select(F.col("o_orderkey").alias("cipher"), "o_orderkey",
                                            "o_orderstatus")
    plain = protect.decrypt_columns(cipher, ["o_orderkey"], ENV_KEY, types={"o_orderkey": "bigint"})
    n = plain.groupBy("cipher").agg(F.count("*").alias("n")).withColumnRenamed("cipher", "c")
    return plain.join(n, F.col("cipher") == F.col("c")).select(
        "o_orderkey", "o_orderstatus",
        ((F.col("cipher") != F.col("o_orderkey").cast("string")) & (F.col("n") == 1))
        .alias("differs"))


def _priced(t):
    """orders with a price of two digits, as text with three in every seventh row."""
    three = F.format_string("%d.%03d", F.col("o_orderkey"), (F.col("o_orderkey") % 9 + 1)
                            .cast("int"))
    two = F.format_string("%d.%02d0", F.col("o_orderkey"), (F.col("o_orderkey") % 90 + 10)
                          .cast("int"))
    return t["orders"].select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.when(
        F.col("o_orderkey") % 7 == 0, three).otherwise(two).alias("price"))


_PRICED = TableMeta.from_document(samples.request("priced", [
    samples.col("o_orderkey", "NUMBER", 22, precision=18, pk=True),
    samples.col("price", "NUMBER", 22, precision=18, scale=2)], driver=None))


@query("load_job_scale_rejects", """
SELECT o_orderkey, CAST(o_orderkey || '.' || (o_orderkey % 90 + 10) AS DOUBLE) AS price,
       CAST(NULL AS VARCHAR) AS rejected FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL
SELECT o_orderkey, NULL, o_orderkey || '.00' || (o_orderkey % 9 + 1)
FROM orders WHERE o_orderkey % 7 = 0""")
def load_job_scale_rejects(spark, sf):
    """U8 + K8: a price with a third digit behind the point is rejected with its raw
    value, not rounded; a third digit of zero is no loss."""
    src = write_files(_priced(_t(spark, sf)), stage_path(spark, "priced"), "csv")
    target = load.FileTarget(stage_path(spark, "target-priced"), "parquet")
    rejects = stage_path(spark, "rejects")
    run_load(spark, src, _PRICED, target, "full_refresh", fail_on_invalid=False,
             rejects_path=rejects)
    none = F.lit(None)
    return target.read(spark).select(
        "o_orderkey", F.col("price").cast("double"), none.cast("string").alias("rejected")) \
        .unionAll(spark.read.parquet(rejects).select(
            F.get_json_object("reject_row", "$.o_orderkey").cast("bigint"),
            none.cast("double"), "reject_value"))


_MARKED = TableMeta.from_document(samples.request("marked", [
    samples.col("o_orderkey", "NUMBER", 22, precision=18, pk=True),
    samples.col("status", "CHAR", 1), samples.col("rejects", "VARCHAR2", 30),
    samples.col("Reject_Column", "INTEGER"), samples.col("reject_row", "VARCHAR2", 30)],
    driver=None))


@query("load_job_status_column", """
SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS rejects,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 3 END AS "Reject_Column", 'r' AS reject_row,
       o_orderkey % 5 = 0 AS refused
FROM orders""")
def load_job_status_column(spark, sf):
    """U8: a table whose own columns are called as the job's marks; good rows and
    rejects keep them."""
    o = _t(spark, sf)["orders"]
    bad = F.col("o_orderkey") % 5 == 0
    text = o.select("o_orderkey", F.col("o_orderstatus").alias("status"),
                    F.col("o_orderpriority").alias("rejects"),
                    F.when(bad, "three").otherwise("3").alias("Reject_Column"),
                    F.lit("r").alias("reject_row"))
    src = write_files(text, stage_path(spark, "marked"), "csv")
    target = load.FileTarget(stage_path(spark, "target-marked"), "parquet")
    rejects = stage_path(spark, "rejects")
    run_load(spark, src, _MARKED, target, "full_refresh", fail_on_invalid=False,
             rejects_path=rejects)
    mark = validate.SplitNames.of(_MARKED.names)
    raw = F.from_json(mark.row, "o_orderkey string, status string, rejects string, "
                                "Reject_Column string, reject_row string")
    back = spark.read.parquet(rejects).where(F.col(mark.value) == "three").select(raw.alias("r"))
    return target.read(spark).withColumn("refused", F.lit(False)).unionAll(back.select(
        F.col("r.o_orderkey").cast("bigint"), "r.status", "r.rejects",
        F.lit(None).cast("int"), "r.reject_row", F.lit(True)))


@query("scrub_job_unmatched", f"""
SELECT c_custkey, c_acctbal < 0 AS unmatched FROM customer""")
def scrub_job_unmatched(spark, sf):
    """J10 + K9 in the scrub job: rows without an identity are left out of the masked
    files and their keys reported beside them."""
    from .mask import _S
    t = _t(spark, sf)
    meta, out, log = samples.META["customer"], stage_path(spark, "scrubbed"), \
        stage_path(spark, "audit")
    ids = mask.identity_table(t["customer"].where("c_acctbal >= 0"), "c_custkey", seed=_S,
                              unique=True)
    run_scrub(spark, t["customer"], meta, out, identity=ids, audit_path=log)
    told = spark.read.parquet(log).first()["records_processed"]
    masked = spark.read.parquet(out)
    report = masked.select("c_custkey", F.lit(False).alias("unmatched")).unionAll(
        spark.read.parquet(f"{out}_unmatched").select("c_custkey", F.lit(True)))
    return report if told == masked.count() else report.limit(0)


@query("scrub_job_stage_copy", "SELECT p_partkey, p_name FROM part")
def scrub_job_stage_copy(spark, sf):
    """K7 in the scrub job: a table without PII is copied to its stage as it is."""
    from ..plans.scrub import run_scrub_folder
    t = samples.load_tables(spark, sf, ("part",))["part"].select("p_partkey", "p_name")
    base = stage_path(spark, "request")
    write_files(t, f"{base}/part", "csv")
    meta = TableMeta.from_document(samples.request("part", [
        samples.col("p_partkey", "NUMBER", 22, precision=18, pk=True),
        samples.col("p_name", "VARCHAR2", 60)], driver=None))
    done = run_scrub_folder(spark, base, [meta], fmt="csv")["part"].first()
    out = read_declared(spark, f"{base}/part_stg", meta, "csv")
    return out if done["records_processed"] == out.count() else out.limit(0)


@query("scrub_job_failed", f"""
SELECT '{samples.META['customer'].request_id}' AS request_id, 'FAILED' AS status,
       'SCRUB' AS job_type, CAST(0 AS BIGINT) AS records_processed FROM region LIMIT 1""")
def scrub_job_failed(spark, sf):
    """K9: a scrub that fails (its source lacks a column) leaves a FAILED record."""
    t, log = _t(spark, sf), stage_path(spark, "audit")
    try:
        run_scrub(spark, t["customer"].withColumnRenamed("c_acctbal", "x"),
                  samples.META["customer"], stage_path(spark, "scrubbed"), identity=GENERATOR,
                  audit_path=log)
    except (PySparkException, KeyError):
        pass
    return spark.read.parquet(log)


COLUMN_KEY = b"a column key of 32 bytes, sample"


@query("extract_job_column_keys", f"""
SELECT o_orderkey, o_orderstatus, true AS ciphered
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE {DRIVER_SQL})""")
def extract_job_column_keys(spark, sf):
    """E3 + E1 in the extract job: a key that the source stores under its own
    column key is decrypted with that, then encrypted with the request's key."""
    from ..functions import crypto
    from ..operators import protect
    t = _t(spark, sf)
    meta = samples.META["orders"]
    secret = replace(meta, columns=tuple(replace(
        c, is_pii=True, is_encrypted=True, key_name="k1", use_iv=True)
        if c.name == "o_orderkey" else c for c in meta.columns))
    t["orders"] = t["orders"].withColumn("o_orderkey", crypto.encrypt(
        F.col("o_orderkey"), COLUMN_KEY, "GCM"))
    out = stage_path(spark, "encrypted")
    run_extract(spark, t, secret, out, fmt="parquet", env_key=ENV_KEY, driver_filter=driver(),
                primary_keys=samples.PRIMARY_KEYS, column_keys={"k1": COLUMN_KEY})
    got = spark.read.parquet(out).select("o_orderkey", "o_orderstatus",
                                         F.col("o_orderkey").alias("cipher"))
    plain = protect.decrypt_columns(got, ["o_orderkey"], ENV_KEY, types={"o_orderkey": "bigint"})
    return plain.select("o_orderkey", "o_orderstatus", (
        F.col("cipher") != F.col("o_orderkey").cast("string")).alias("ciphered"))
