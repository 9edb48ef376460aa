"""Load, validation and audit queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .. import samples
from ..operators import audit, load, reconcile, subset, validate
from ..operators.versioned import VersionedTarget
from ..registry import query
from ..session import stage_path
from ..sinks.files import write_files
from .extract import EXTRACT_2HOP_SQL, driver

NEW_KEY_OFFSET = 1_000_000_000_000
RESTORE_OFFSET = 5_000_000
_ORDER_COLS = "o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _t(spark, sf):
    return samples.load_tables(spark, sf, ("customer", "orders", "lineitem"))


def _incoming(orders):
    """Changed prices for urgent orders (existing keys) and low-priority
    orders under new keys."""
    upd = orders.where(F.col("o_orderpriority") == "1-URGENT") \
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = orders.where(F.col("o_orderpriority") == "5-LOW") \
        .withColumn("o_orderkey", F.col("o_orderkey") + NEW_KEY_OFFSET)
    return upd.unionByName(new)


_INCOMING_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
       o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL
SELECT o_orderkey + {NEW_KEY_OFFSET} AS o_orderkey, {_ORDER_COLS}
FROM orders WHERE o_orderpriority = '5-LOW'"""


def _target_with(spark, df, name):
    target = load.FileTarget(stage_path(spark, name), "parquet")
    target.write(df, "overwrite")
    return target


@query("load_upsert", f"""
WITH inc AS ({_INCOMING_SQL})
SELECT * FROM inc
UNION ALL SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM inc)""")
def load_upsert(spark, sf):
    """J8 + K8: stored orders, incoming updates and inserts, via a stage."""
    o = _t(spark, sf)["orders"]
    target = _target_with(spark, o, "target-orders")
    load.load(spark, _incoming(o), target, "upsert", key=["o_orderkey"])
    return target.read(spark)


@query("load_upsert_first", f"SELECT * FROM ({_INCOMING_SQL})")
def load_upsert_first(spark, sf):
    """J8 into a target that does not exist yet; every incoming row comes
    twice, and one row per key is loaded."""
    inc = _incoming(_t(spark, sf)["orders"])
    target = load.FileTarget(stage_path(spark, "target-new"), "parquet")
    report = {}
    n = load.load(spark, inc.unionAll(inc), target, "upsert", key=["o_orderkey"], report=report)
    out = target.read(spark)
    return out if report["duplicates"] == n and report["incoming"] == 2 * n else out.limit(0)


@query("load_full_refresh", f"""
SELECT * FROM orders WHERE o_custkey IN (
  SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def load_full_refresh(spark, sf):
    """K8 full refresh: the target holds exactly the incoming extract."""
    t = _t(spark, sf)
    target = _target_with(spark, t["orders"], "target-orders")
    incoming = subset.extract_related(t, samples.META["orders"], driver_filter=driver())
    load.load(spark, incoming, target, "full_refresh")
    return target.read(spark)


@query("load_append", "SELECT * FROM orders")
def load_append(spark, sf):
    o = _t(spark, sf)["orders"]
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    target = _target_with(spark, o.where(first), "target-orders")
    load.load(spark, o.where(~first), target, "load_append")
    return target.read(spark)


@query("load_union", f"""
SELECT * FROM orders UNION ALL {_INCOMING_SQL}""")
def load_union(spark, sf):
    """Stored rows and incoming rows (columns matched by name)."""
    o = _t(spark, sf)["orders"]
    inc = _incoming(o)
    return load.union_rows(o, inc.select(*reversed(inc.columns)))


@query("load_dedup", f"""
WITH inc AS (SELECT * FROM orders UNION ALL {_INCOMING_SQL})
SELECT o_orderkey, {_ORDER_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey
                               ORDER BY o_totalprice DESC, o_custkey DESC) AS rn FROM inc)
WHERE rn = 1""")
def load_dedup(spark, sf):
    """One survivor per key among duplicated incoming rows."""
    o = _t(spark, sf)["orders"]
    inc = o.unionByName(_incoming(o))
    return load.survivors(inc, ["o_orderkey"], ["o_totalprice", "o_custkey"])


_RESTORE_MAP_SQL = (f"SELECT c_custkey AS test_key, c_custkey + {RESTORE_OFFSET} AS prod_key "
                    "FROM customer WHERE c_mktsegment = 'BUILDING'")


def _restore_map(t):
    return t["customer"].where(driver()).select(
        F.col("c_custkey").alias("test_key"),
        (F.col("c_custkey") + RESTORE_OFFSET).alias("prod_key"))


@query("load_restore_keys", f"""
SELECT o.o_orderkey, coalesce(m.prod_key, o.o_custkey) AS o_custkey, o.o_orderstatus,
       o.o_totalprice, o.o_orderdate, o.o_orderpriority
FROM orders o LEFT JOIN ({_RESTORE_MAP_SQL}) m ON o.o_custkey = m.test_key""")
def load_restore_keys(spark, sf):
    """Test keys replaced by production keys through the restore map."""
    t = _t(spark, sf)
    return load.restore_keys(t["orders"], _restore_map(t), "o_custkey", unique_map=True)


@query("load_restore_off", "SELECT * FROM orders")
def load_restore_off(spark, sf):
    """J9 with the flag off: keys written as they are."""
    t = _t(spark, sf)
    return load.restore_keys(t["orders"], _restore_map(t), "o_custkey", enabled=False)


@query("load_restore_roundtrip", "SELECT * FROM orders")
def load_restore_roundtrip(spark, sf):
    """restore(test -> prod) then the inverse map gives the input back."""
    t = _t(spark, sf)
    m = _restore_map(t)
    there = load.restore_keys(t["orders"], m, "o_custkey", unique_map=True)
    back = m.select(F.col("prod_key").alias("test_key"), F.col("test_key").alias("prod_key"))
    return load.restore_keys(there, back, "o_custkey")


@query("set_subtract", """
SELECT o_custkey, o_orderstatus FROM orders
EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'""")
def set_subtract(spark, sf):
    o = _t(spark, sf)["orders"].select("o_custkey", "o_orderstatus", "o_orderpriority")
    urgent = o.where(F.col("o_orderpriority") == "1-URGENT")
    return load.subtract_rows(o.select("o_custkey", "o_orderstatus"),
                              urgent.select("o_custkey", "o_orderstatus"))


@query("set_subtract_all", """
SELECT o_custkey, o_orderstatus FROM orders
EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'""")
def set_subtract_all(spark, sf):
    o = _t(spark, sf)["orders"]
    urgent = o.where(F.col("o_orderpriority") == "1-URGENT")
    return load.subtract_rows(o.select("o_custkey", "o_orderstatus"),
                              urgent.select("o_custkey", "o_orderstatus"), keep_duplicates=True)


# ---------------------------------------------------------------------------
# validation

def _strict_orders():
    meta = samples.META["orders"]
    cols = tuple(replace(c, length=10) if c.name == "o_orderpriority" else c
                 for c in meta.columns)
    return replace(meta, columns=cols)


@query("validate_rows", """
SELECT 'o_orderkey' AS column_name, 'not_null' AS check_name,
       count(*) FILTER (WHERE o_orderkey IS NULL) AS failures FROM orders
UNION ALL SELECT 'o_custkey', 'not_null', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
UNION ALL SELECT 'o_orderstatus', 'max_length', count(*) FILTER (WHERE length(o_orderstatus) > 1) FROM orders
UNION ALL SELECT 'o_orderpriority', 'max_length', count(*) FILTER (WHERE length(o_orderpriority) > 10) FROM orders""")
def validate_rows(spark, sf):
    """U4: NOT NULL and length checks of every row in one pass."""
    return validate.validate_rows(_t(spark, sf)["orders"], _strict_orders())


@query("validate_pk", """
SELECT l_orderkey, l_linenumber, count(*) AS duplicates FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def validate_pk(spark, sf):
    """U4: primary-key values held by more than one row."""
    return validate.duplicate_keys(_t(spark, sf)["lineitem"], samples.PRIMARY_KEYS["lineitem"])


def _orders_text(spark, sf):
    """orders as staged CSV text files, read back without types."""
    path = write_files(_t(spark, sf)["orders"], stage_path(spark, "orders-text"), "csv")
    return spark.read.option("header", True).csv(path)


@query("validate_types", """
SELECT o_orderkey, 'o_orderpriority' AS reject_column, o_orderpriority AS reject_value
FROM orders WHERE length(o_orderpriority) > 10""")
def validate_types(spark, sf):
    """U8: rows of a text file that fail their declared type or length."""
    _, rejected = validate.split_typed(_orders_text(spark, sf), _strict_orders())
    return rejected


@query("validate_types_split", """
SELECT o_orderkey, 'o_orderpriority' AS reject_column, o_orderpriority AS reject_value
FROM orders WHERE length(o_orderpriority) > 10""")
def validate_types_split(spark, sf):
    """U8 written in one pass (good and rejected rows partitioned by status);
    the rejected side read back."""
    paths = validate.write_typed_split(_orders_text(spark, sf), _strict_orders(),
                                       stage_path(spark, "orders-split"))
    return spark.read.parquet(paths["rejected"]).select(
        "o_orderkey", "reject_column", "reject_value")


@query("validate_types_good", "SELECT * FROM orders WHERE length(o_orderpriority) <= 10")
def validate_types_good(spark, sf):
    good, _ = validate.split_typed(_orders_text(spark, sf), _strict_orders())
    return good


# ---------------------------------------------------------------------------
# audit

_REQ = samples.META["lineitem"].request_id


@query("audit_count", f"SELECT count(*) AS records FROM ({EXTRACT_2HOP_SQL})")
def audit_count(spark, sf):
    """A1: rows written, observed during the write (no second scan)."""
    rows = subset.extract_related(_t(spark, sf), samples.META["lineitem"], driver_filter=driver())
    path = stage_path(spark, "extract")
    n = audit.write_counted(rows, lambda d: write_files(d, path, "csv"))
    return spark.read.option("header", True).csv(path).agg(F.count(F.lit(1)).alias("records")) \
        .where(F.col("records") == n)


@query("audit_record", f"""
SELECT '{_REQ}' AS request_id, 'COMPLETE' AS status, 'EXTRACT' AS job_type,
       count(*) AS records_processed FROM ({EXTRACT_2HOP_SQL})""")
def audit_record(spark, sf):
    """K9: status record of an extract job, appended to the audit table."""
    rows = subset.extract_related(_t(spark, sf), samples.META["lineitem"], driver_filter=driver())
    path = stage_path(spark, "extract")
    n = audit.gated_write(rows, lambda d: write_files(d, path, "csv"))
    rec = audit.audit_record(spark, _REQ, audit.STATUS_COMPLETE, "EXTRACT", n)
    table = stage_path(spark, "audit")
    audit.append_audit(rec, table)
    return spark.read.parquet(table)


@query("gate_empty", f"""
SELECT '{_REQ}' AS request_id, 'COMPLETE' AS status, 'EXTRACT' AS job_type,
       count(*) AS records_processed FROM orders WHERE o_custkey IN (
  SELECT c_custkey FROM customer WHERE c_mktsegment = 'NO SUCH SEGMENT')""")
def gate_empty(spark, sf):
    """A2: an empty extract writes nothing and records 0 rows."""
    t = _t(spark, sf)
    keys = t["customer"].where(F.col("c_mktsegment") == "NO SUCH SEGMENT") \
        .select(F.col("c_custkey").alias("key"))
    rows = subset.extract_rows(t["orders"], keys=keys, pairs=[("o_custkey", "key")])
    path = stage_path(spark, "extract")
    n = audit.gated_write(rows, lambda d: write_files(d, path, "csv"))
    return audit.audit_record(spark, _REQ, audit.STATUS_COMPLETE, "EXTRACT", n)


# ---------------------------------------------------------------------------
# file-level upsert, reconciliation

_NARROW = "o_orderkey <= (SELECT max(o_orderkey) FROM orders) // 20"


@query("load_upsert_touched", f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN {_NARROW} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority, 'kept' AS untouched
FROM orders
UNION ALL
SELECT o_orderkey + {NEW_KEY_OFFSET}, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, 'kept' FROM orders WHERE {_NARROW}""")
def load_upsert_touched(spark, sf):
    """K8 + J8 on files under a manifest: a twentieth of the keys is changed, as many
    are new; only files that hold a changed key are rewritten, all others are the
    same files as before."""
    o = _t(spark, sf)["orders"]
    top, rows = o.agg(F.max("o_orderkey"), F.count(F.lit(1))).first()
    target = VersionedTarget(stage_path(spark, "versioned"), ("o_orderkey",),
                             rows_per_file=max(1, rows // 40))
    target.write(o, "overwrite")
    before = {r["file"]: r["rows"] for r in target.index(spark).collect()}
    narrow = o.where(F.col("o_orderkey") <= top // 20)
    inc = narrow.withColumn("o_totalprice", F.col("o_totalprice") + 1).unionByName(
        narrow.withColumn("o_orderkey", F.col("o_orderkey") + NEW_KEY_OFFSET))
    report = {}
    load.load(spark, inc, target, "upsert", key=["o_orderkey"], report=report)
    after = {r["file"] for r in target.index(spark).collect()}
    gone = set(before) - after
    few = gone == set(report["rewritten"]) and 0 < len(gone) < len(before) // 2
    return target.read(spark).withColumn("untouched", F.lit("kept" if few else "rewritten"))


@query("load_reconcile", """
SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 1 THEN 'lost' WHEN o_orderkey % 100 = 2 THEN 'changed'
         WHEN o_orderkey % 100 = 3 THEN 'doubled' ELSE 'added' END AS status,
       CAST(CASE WHEN o_orderkey < 0 THEN 0 ELSE 1 END AS BIGINT) AS expected_rows,
       CAST(CASE WHEN o_orderkey % 100 = 1 THEN 0 WHEN o_orderkey % 100 = 3 THEN 2 ELSE 1 END
            AS BIGINT) AS actual_rows
FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 100 IN (1, 2, 3)
      UNION ALL SELECT -o_orderkey - 1 FROM orders WHERE o_orderkey % 1000 = 0)""")
def load_reconcile(spark, sf):
    """A table with lost, changed, doubled and added rows against what was
    loaded; a changed row differs in a NULL that moved to the next column."""
    o = _t(spark, sf)["orders"].withColumn("o_clerk", F.lit(None).cast("string"))
    k = F.col("o_orderkey") % 100
    wrong = o.where(k != 1).withColumn("o_clerk", F.when(k == 2, F.col("o_orderpriority"))) \
        .withColumn("o_orderpriority", F.when(k != 2, F.col("o_orderpriority")))
    wrong = wrong.unionAll(wrong.where(k == 3)).unionAll(
        o.where("o_orderkey % 1000 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    return reconcile.reconcile(o, wrong.repartition(7), ["o_orderkey"], buckets=64)
