"""Queries over subsets, filters and key tables (F, J1-J5, A3-A4, W, K5)."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import samples
from ..catalog import FilterSpec, TableMeta
from ..functions.predicates import condition
from ..operators import subset
from ..registry import query
from ..session import stage_path

def driver():
    return F.col("c_mktsegment") == "BUILDING"


DRIVER_SQL = "c_mktsegment = 'BUILDING'"


def _t(spark, sf):
    return samples.load_tables(spark, sf, ("customer", "orders", "lineitem", "events"))


def _building_keys(t):
    return t["customer"].where(driver()).select(F.col("c_custkey").alias("key"))


def _with_filters(meta: TableMeta, filters, operator="AND") -> TableMeta:
    return replace(meta, filters=tuple(FilterSpec(c, op, tuple(v)) for c, op, v in filters),
                   operator=operator)


# --------------------------------------------------------------------------
# F12-F16, J1, J5

@query("extract_full", "SELECT * FROM orders")
def extract_full(spark, sf):
    t = _t(spark, sf)
    return subset.extract_rows(t["orders"], samples.META["orders"])


@query("extract_keys", f"""
SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE {DRIVER_SQL})""")
def extract_keys(spark, sf):
    t = _t(spark, sf)
    return subset.extract_rows(t["orders"], keys=_building_keys(t), pairs=[("o_custkey", "key")])


_ORDER_FILTERS = [("o_orderpriority", "IN", ["1-URGENT", "2-HIGH"]),
                  ("o_totalprice", ">", ["100000"])]


@query("extract_filter", """
SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000""")
def extract_filter(spark, sf):
    t = _t(spark, sf)
    meta = _with_filters(samples.META["orders"], _ORDER_FILTERS)
    return subset.extract_rows(t["orders"], meta)


@query("extract_keys_filter", f"""
SELECT * FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE {DRIVER_SQL})
  AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000""")
def extract_keys_filter(spark, sf):
    t = _t(spark, sf)
    meta = _with_filters(samples.META["orders"], _ORDER_FILTERS)
    return subset.extract_rows(t["orders"], meta, keys=_building_keys(t),
                               pairs=[("o_custkey", "key")])


@query("extract_no_keys", """
SELECT * FROM orders WHERE o_custkey IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment = 'NO SUCH SEGMENT')""")
def extract_no_keys(spark, sf):
    t = _t(spark, sf)
    keys = t["customer"].where(F.col("c_mktsegment") == "NO SUCH SEGMENT").select(
        F.col("c_custkey").alias("key"))
    return subset.extract_rows(t["orders"], keys=keys, pairs=[("o_custkey", "key")])


def _pair_keys(t):
    li = t["lineitem"]
    return li.where((F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
                    & (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))) \
        .select(F.col("l_orderkey").alias("k_order"), F.col("l_linenumber").alias("k_line"))


_PAIR_KEYS_SQL = ("SELECT l_orderkey AS k_order, l_linenumber AS k_line FROM lineitem "
                  "WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1996-01-01'")


@query("extract_tuple_keys", f"""
SELECT l.* FROM lineitem l WHERE EXISTS (
  SELECT 1 FROM ({_PAIR_KEYS_SQL}) k WHERE k.k_order = l.l_orderkey AND k.k_line = l.l_linenumber)""")
def extract_tuple_keys(spark, sf):
    t = _t(spark, sf)
    return subset.extract_rows(t["lineitem"], keys=_pair_keys(t), match="tuple",
                               pairs=[("l_orderkey", "k_order"), ("l_linenumber", "k_line")])


@query("extract_per_column_keys", f"""
SELECT l.* FROM lineitem l
WHERE l.l_orderkey IN (SELECT k_order FROM ({_PAIR_KEYS_SQL}))
  AND l.l_linenumber IN (SELECT k_line FROM ({_PAIR_KEYS_SQL}))""")
def extract_per_column_keys(spark, sf):
    t = _t(spark, sf)
    return subset.extract_rows(t["lineitem"], keys=_pair_keys(t), match="per_column",
                               pairs=[("l_orderkey", "k_order"), ("l_linenumber", "k_line")])


_ORDERS_1HOP_SQL = f"""
SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE {DRIVER_SQL})"""


@query("extract_1hop", _ORDERS_1HOP_SQL)
def extract_1hop(spark, sf):
    return subset.extract_related(_t(spark, sf), samples.META["orders"], driver_filter=driver(),
                                  primary_keys=samples.PRIMARY_KEYS)


EXTRACT_2HOP_SQL = f"""
SELECT * FROM lineitem WHERE l_orderkey IN (
  SELECT o_orderkey FROM orders WHERE o_custkey IN (
    SELECT c_custkey FROM customer WHERE {DRIVER_SQL}))"""


@query("extract_2hop", EXTRACT_2HOP_SQL)
def extract_2hop(spark, sf):
    return subset.extract_related(_t(spark, sf), samples.META["lineitem"], driver_filter=driver(),
                                  primary_keys=samples.PRIMARY_KEYS)


# --------------------------------------------------------------------------
# W1, W2

@query("extract_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def extract_limit(spark, sf):
    t = _t(spark, sf)
    meta = replace(samples.META["orders"], limit=100)
    return subset.apply_order_limit(subset.extract_rows(t["orders"], meta), meta)


@query("extract_topk", f"""
SELECT * FROM ({_ORDERS_1HOP_SQL}) ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def extract_topk(spark, sf):
    meta = replace(samples.META["orders"], limit=20)
    rows = subset.extract_related(_t(spark, sf), meta, driver_filter=driver())
    return subset.apply_order_limit(rows, order=[F.desc("o_totalprice"), "o_orderkey"],
                                    limit=meta.limit)


# --------------------------------------------------------------------------
# J2, J3, A3, K5

KEYS_CHAIN_SQL = f"""
SELECT DISTINCT c.c_custkey AS customer__c_custkey, o.o_orderkey AS orders__o_orderkey,
       l.l_linenumber AS lineitem__l_linenumber
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE c.{DRIVER_SQL}"""


@query("keys_chain", KEYS_CHAIN_SQL)
def keys_chain(spark, sf):
    return subset.key_chain(_t(spark, sf), samples.META["lineitem"], samples.PRIMARY_KEYS,
                            driver_filter=driver())


def _composite_tables(spark, sf):
    t = _t(spark, sf)
    t["returned_lines"] = samples.returned_lines(t["lineitem"])
    return t


def urgent():
    return F.col("o_orderpriority") == "1-URGENT"


_RETURNED_SQL = ("SELECT l_orderkey AS r_orderkey, l_linenumber AS r_linenumber, "
                 "l_quantity AS r_quantity FROM lineitem WHERE l_returnflag = 'R'")


@query("join_composite", f"""
SELECT r.* FROM ({_RETURNED_SQL}) r WHERE EXISTS (
  SELECT 1 FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE o.o_orderpriority = '1-URGENT'
    AND l.l_orderkey = r.r_orderkey AND l.l_linenumber = r.r_linenumber)""")
def join_composite(spark, sf):
    return subset.extract_related(_composite_tables(spark, sf), samples.META["returned_lines"],
                                  driver_filter=urgent())


@query("keys_chain_composite", f"""
SELECT DISTINCT o.o_orderkey AS orders__o_orderkey, l.l_linenumber AS lineitem__l_linenumber
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
JOIN ({_RETURNED_SQL}) r ON r.r_orderkey = l.l_orderkey AND r.r_linenumber = l.l_linenumber
WHERE o.o_orderpriority = '1-URGENT'""")
def keys_chain_composite(spark, sf):
    return subset.key_chain(_composite_tables(spark, sf), samples.META["returned_lines"],
                            samples.PRIMARY_KEYS, driver_filter=urgent())


@query("keys_distinct", "SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def keys_distinct(spark, sf):
    t = _t(spark, sf)
    return t["orders"].where(urgent()).select("o_custkey").distinct()


@query("keys_level", f"""
SELECT DISTINCT c.c_custkey AS customer__c_custkey, o.o_orderkey AS orders__o_orderkey
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE c.{DRIVER_SQL}""")
def keys_level(spark, sf):
    """K5: every level's key table written once (skipped if present), then
    the orders level read back from its files."""
    meta = samples.META["lineitem"]
    chain = subset.key_chain(_t(spark, sf), meta, samples.PRIMARY_KEYS, driver_filter=driver(),
                             fold=False)
    base = stage_path(spark, "keys")
    paths = subset.write_level_keys(chain, meta, samples.PRIMARY_KEYS, base)
    back = subset.undotted(read_key_table_raw(spark, paths["orders"]))
    return back.select(F.col("customer__c_custkey").cast("bigint"),
                       F.col("orders__o_orderkey").cast("bigint"))


def read_key_table_raw(spark, path):
    return spark.read.option("header", True).csv(path)


@query("key_trim", f"""
SELECT * FROM customer WHERE c_name IN (
  SELECT rtrim(rpad(c_name, 30, ' ')) FROM customer WHERE {DRIVER_SQL})""")
def key_trim(spark, sf):
    """Right-padded key values are trimmed before they are compared."""
    t = _t(spark, sf)
    padded = t["customer"].where(driver()).select(F.rpad("c_name", 30, " ").alias("key"))
    return subset.semi_join(t["customer"], padded, [("c_name", "key")])


@query("key_trim_table", f"""
SELECT c_custkey, rpad(c_name, 30, ' ') AS c_name FROM customer WHERE {DRIVER_SQL}""")
def key_trim_table(spark, sf):
    """The table's column is padded (a CHAR column), the keys are not."""
    t = _t(spark, sf)
    padded = t["customer"].select("c_custkey", F.rpad("c_name", 30, " ").alias("c_name"))
    keys = t["customer"].where(driver()).select(F.col("c_name").alias("key"))
    return subset.semi_join(padded, keys, [("c_name", "key")])


# --------------------------------------------------------------------------
# F1-F10 on single tables

def _filter_query(name, table, filters, sql_where, operator="AND", meta_patch=None):
    def fn(spark, sf):
        t = _t(spark, sf)
        meta = samples.META[table]
        if meta_patch:
            meta = meta_patch(meta)
        return subset.extract_rows(t[table], _with_filters(meta, filters, operator))
    query(name, f"SELECT * FROM {table} WHERE {sql_where}")(fn)


def _ts_events(meta: TableMeta) -> TableMeta:
    cols = tuple(replace(c, data_type="TIMESTAMP(6)") if c.name == "ts" else c
                 for c in meta.columns)
    return replace(meta, columns=cols)


_filter_query("filter_between_num", "orders", [("o_totalprice", "BETWEEN", ["100000", "200000"])],
              "o_totalprice BETWEEN 100000 AND 200000")
_filter_query("filter_between_date", "events", [("ts", "BETWEEN", ["2024-01-05", "2024-01-07"])],
              "ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-07'")
_filter_query("filter_between_str", "customer",
              [("c_mktsegment", "BETWEEN", ["AUTOMOBILE", "FURNITURE"])],
              "c_mktsegment BETWEEN 'AUTOMOBILE' AND 'FURNITURE'")
_filter_query("filter_between_ts", "events",
              [("ts", "BETWEEN", ["2024-01-05 06:00:00", "2024-01-07 18:30:00"])],
              "ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-07 18:30:00'",
              meta_patch=_ts_events)
_filter_query("filter_in", "orders", [("o_orderpriority", "IN", ["1-URGENT", "5-LOW"])],
              "o_orderpriority IN ('1-URGENT', '5-LOW')")

_OPS = {"eq": "=", "ne": "!=", "gt": ">", "lt": "<", "ge": ">=", "le": "<="}
_SQL_OPS = {"=": "=", "!=": "<>", ">": ">", "<": "<", ">=": ">=", "<=": "<="}

for _suffix, _op in _OPS.items():
    _main = _suffix == "eq"
    _filter_query("filter_cmp_num" if _suffix == "ge" else f"filter_cmp_num_{_suffix}",
                  "lineitem", [("l_quantity", _op, ["25"])], f"l_quantity {_SQL_OPS[_op]} 25")
    _filter_query("filter_cmp_date" if _main else f"filter_cmp_date_{_suffix}",
                  "events", [("ts", _op, ["2024-01-10"])],
                  f"strftime(ts, '%Y-%m-%d') {_SQL_OPS[_op]} '2024-01-10'")
    _filter_query("filter_cmp_str" if _suffix == "gt" else f"filter_cmp_str_{_suffix}",
                  "customer", [("c_mktsegment", _op, ["FURNITURE"])],
                  f"c_mktsegment {_SQL_OPS[_op]} 'FURNITURE'")
    _filter_query("filter_cmp_ts" if _suffix == "ge" else f"filter_cmp_ts_{_suffix}",
                  "events", [("ts", _op, ["2024-01-15 12:00:00"])],
                  f"ts {_SQL_OPS[_op]} TIMESTAMP '2024-01-15 12:00:00'", meta_patch=_ts_events)

_AND_OR = [("o_orderpriority", "=", ["1-URGENT"]), ("o_orderstatus", "=", ["F"]),
           ("o_totalprice", "<", ["150000"])]
_filter_query("filter_and", "orders", _AND_OR,
              "o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND o_totalprice < 150000")
_filter_query("filter_or", "orders", _AND_OR,
              "o_orderpriority = '1-URGENT' OR o_orderstatus = 'F' OR o_totalprice < 150000",
              operator="OR")


# ---------------------------------------------------------------------------
# exact literals and keys, key runs, hot keys, large limits, key levels

_CMP_SCALE = [("eq", "=", ["1234.239"]), ("ne", "!=", ["1234.239"]), ("gt", ">", ["150000.239"]),
              ("lt", "<", ["150000.239"]), ("ge", ">=", ["150000.235"]),
              ("le", "<=", ["150000.235"]), ("far", "<", ["1e15"]), ("below", ">", ["-1e15"]),
              ("between", "BETWEEN", ["99999.991", "150000.009"]),
              ("listed", "IN", ["99999.991", "1"])]
_KEY_SCALE = [("key_gt", ">", ["1000.5"]), ("key_lt", "<", ["1000.5"]), ("key_eq", "=", ["1000.5"]),
              ("key_far", ">", ["9007199254740992.5"]), ("key_huge", "<=", ["1e30"])]


@query("filter_cmp_scale", """
SELECT o_orderkey, p = 1234.239 AS eq, p <> 1234.239 AS ne, p > 150000.239 AS gt,
       p < 150000.239 AS lt, p >= 150000.235 AS ge, p <= 150000.235 AS le, true AS far,
       true AS below, p BETWEEN 99999.991 AND 150000.009 AS between, p = 1 AS listed,
       o_orderkey >= 1001 AS key_gt, o_orderkey <= 1000 AS key_lt, false AS key_eq,
       false AS key_far, true AS key_huge
FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12, 2)) + CAST(0.24 AS DECIMAL(3, 2)) AS p
      FROM orders)""")
def filter_cmp_scale(spark, sf):
    """literals between two values of the column's scale, and beyond its
    range, on a decimal and on a whole number; NULL-free results per row."""
    dec = T.DecimalType(12, 2)
    o = _t(spark, sf)["orders"].select("o_orderkey", (F.col("o_totalprice").cast(dec) + F.lit(
        "0.24").cast(T.DecimalType(3, 2))).cast(dec).alias("p"))
    meta = TableMeta.from_document(samples.request("o", [
        samples.col("o_orderkey", "NUMBER", 22, precision=18, pk=True),
        samples.col("p", "NUMBER", 22, precision=12, scale=2)], driver=None))

    def flag(column, cases):
        return [condition(FilterSpec(column, op, tuple(v)), meta.column(column),
                          o.schema[column].dataType).alias(name) for name, op, v in cases]

    return o.select("o_orderkey", *flag("p", _CMP_SCALE), *flag("o_orderkey", _KEY_SCALE))


@query("key_lossy_refused", """
SELECT o_orderkey, 5 AS refused FROM orders WHERE o_orderkey % 3 = 0""")
def key_lossy_refused(spark, sf):
    """Keys wider than the column but of its values match it; a fraction, a
    third digit behind the point (as number and as text), a time of day for a plain
    date (as timestamp and as text) are refused, not matched to another key."""
    dec = T.DecimalType(12, 2)
    o = _t(spark, sf)["orders"].select(
        "o_orderkey", F.col("o_totalprice").cast(dec).alias("price"),
        F.to_date("o_orderdate").alias("day"))
    some = o.where("o_orderkey % 3 = 0")
    wide = some.select(F.col("o_orderkey").cast("decimal(30,4)").alias("k"))
    late = F.to_timestamp("day") + F.expr("INTERVAL 10 HOURS")
    lossy = [("o_orderkey", F.col("o_orderkey") + F.lit("0.5").cast("decimal(2,1)")),
             ("price", F.col("price") + F.lit("0.004").cast("decimal(4,3)")),
             ("price", (F.col("price") + F.lit("0.004").cast("decimal(4,3)")).cast("string")),
             ("day", late), ("day", F.date_format(late, "yyyy-MM-dd HH:mm:ss"))]
    refused = 0
    for column, key in lossy:
        try:
            subset.semi_join(o, some.select(key.alias("k")), [(column, "k")]).count()
        except PySparkException as e:
            refused += "key for" in str(e)
    return subset.semi_join(o, wide, [("o_orderkey", "k")]).select(
        "o_orderkey", F.lit(refused).alias("refused"))


_RUN_KEYS_SQL = """
SELECT o_orderkey FROM orders, (SELECT max(o_orderkey) AS m FROM orders)
WHERE (o_orderkey < m / 10 OR o_orderkey > m - m / 10) AND o_orderkey % 2 = 0"""


@query("extract_key_runs", f"SELECT * FROM lineitem WHERE l_orderkey IN ({_RUN_KEYS_SQL})")
def extract_key_runs(spark, sf):
    """A key list at both ends of the key range, covered by intervals that
    the scan takes as pushed filters before the exact join."""
    t = _t(spark, sf)
    top, o = t["orders"].agg(F.max("o_orderkey")).first()[0], F.col("o_orderkey")
    keys = t["orders"].where(((o < top / 10) | (o > top - top / 10)) & (o % 2 == 0))
    return subset.semi_join(t["lineitem"], keys.select(o.alias("k")), [("l_orderkey", "k")],
                            strategy="runs")


_HOT_SQL = """
SELECT CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_orderkey END AS b_order,
       CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_linenumber END AS b_line,
       l_partkey, l_suppkey, l_shipdate
FROM lineitem"""
_HOT_SMALL_SQL = """
SELECT l_orderkey AS s_order, l_linenumber AS s_line, min(l_quantity) AS least
FROM lineitem WHERE l_returnflag = 'R' OR l_orderkey = 7 GROUP BY l_orderkey, l_linenumber"""


@query("join_hot_composite", f"""
SELECT b.*, s.least, s.least IS NOT NULL AS semi, s.least IS NULL AS anti
FROM ({_HOT_SQL}) b LEFT JOIN ({_HOT_SMALL_SQL}) s ON b_order = s_order AND b_line = s_line""")
def join_hot_composite(spark, sf):
    """A composite key that a third of the rows hold, its rows dealt
    out over salts; left, semi and anti join."""
    from ..operators.hot import split_join
    li = _t(spark, sf)["lineitem"]
    third = F.col("l_partkey") % 3 == 0
    big = li.select(F.when(third, F.lit(7).cast("bigint")).otherwise(F.col("l_orderkey"))
                    .alias("b_order"),
                    F.when(third, F.lit(1).cast("int")).otherwise(F.col("l_linenumber"))
                    .alias("b_line"), "l_partkey", "l_suppkey", "l_shipdate")
    big = big.withColumn("b_line", F.col("b_line").cast(li.schema["l_linenumber"].dataType))
    small = li.where("l_returnflag = 'R' OR l_orderkey = 7").groupBy(
        F.col("l_orderkey").alias("s_order"), F.col("l_linenumber").alias("s_line")).agg(
        F.min("l_quantity").alias("least"))
    pairs = [("b_order", "s_order"), ("b_line", "s_line")]
    left = split_join(big, small, pairs, "left").select(*big.columns, "least")
    semi = split_join(big, small, pairs, "left_semi")
    anti = split_join(big, small, pairs, "left_anti")
    # both halves, marked, beside the left join they must agree with
    halves = semi.select("*", F.lit(True).alias("semi")).unionByName(
        anti.select("*", F.lit(False).alias("semi")))
    group = [*big.columns]
    n = halves.groupBy(*group, "semi").agg(F.count(F.lit(1)).alias("n"))
    m = left.groupBy(*group, "least").agg(F.count(F.lit(1)).alias("m"))
    cond = reduce(lambda a, b: a & b, [m[c].eqNullSafe(n[c]) for c in group], m["m"] == n["n"])
    both = m.join(n, cond).select(*[m[c] for c in group], "least", "semi", "m")
    return both.select("*", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("i")) \
        .select(*group, "least", "semi", (~F.col("semi")).alias("anti"))


@query("extract_limit_large", """
SELECT l_orderkey, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)
            AS n, count(*) OVER () AS every FROM lineitem)
WHERE n <= every // 2""")
def extract_limit_large(spark, sf):
    """The first half of the table by date and key, cut at its rank by
    ranges of the order columns until it falls between two rows: a filter."""
    li = _t(spark, sf)["lineitem"]
    n = li.count() // 2
    rows = subset.first_rows(li, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
                                  "l_suppkey"], n, one_task=1)
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query("keys_level_resume", f"""
SELECT 'customer,orders,lineitem' AS first, 'customer,orders,lineitem' AS stale,
       'orders,lineitem' AS broken, '' AS good, count(*) AS keys
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM ({EXTRACT_2HOP_SQL}))""")
def keys_level_resume(spark, sf):
    """K5: levels of another request's driver filter are stale and written again; of
    good levels, one whose files are foreign and one without its record are
    written again and the others kept; good ones are kept.  The order of levels
    written, and the keys of the last level in the end."""
    from ..operators.subset import write_level_keys
    from ..session import remove_path
    from ..sinks.files import write_files
    t, meta = _t(spark, sf), samples.META["lineitem"]
    base, said = stage_path(spark, "levels"), {}

    def run(step, filter_):
        chain = subset.key_chain(t, meta, samples.PRIMARY_KEYS, driver_filter=filter_, fold=False)
        written = []
        paths = write_level_keys(chain, meta, samples.PRIMARY_KEYS, base, inputs=str(filter_),
                                 written=written)
        said[step] = ",".join(written)
        return paths

    run("first", F.col("c_mktsegment") == "AUTOMOBILE")
    run("stale", driver())
    write_files(t["customer"].limit(3), f"{base}/orders", "csv")
    remove_path(spark, f"{base}/_levels/lineitem")
    run("broken", driver())
    paths = run("good", driver())
    last = spark.read.option("header", True).csv(paths["lineitem"])
    return last.agg(*[F.lit(v).alias(k) for k, v in said.items()],
                    F.count_distinct("`LINEITEM.L_ORDERKEY`", "`LINEITEM.L_LINENUMBER`")
                    .alias("keys"))
