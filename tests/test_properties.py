"""Operators against brute force on small generated fixtures."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from veilset.catalog import ColumnMeta, FilterSpec
from veilset.functions.predicates import condition
from veilset.operators import load, subset

rows_st = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3), st.integers(0, 99)),
                   min_size=0, max_size=40)
keys_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 3)),
                   min_size=0, max_size=10)


@settings(max_examples=20, deadline=None)
@given(rows_st, keys_st)
def test_semi_join_matches_brute_force(spark, rows, keys):
    df = spark.createDataFrame(rows, "a int, b int, v int")
    kd = spark.createDataFrame(keys, "ka int, kb int")
    pairs = [("a", "ka"), ("b", "kb")]
    got_t = sorted(tuple(r) for r in subset.semi_join(df, kd, pairs).collect())
    got_p = sorted(tuple(r) for r in subset.semi_join(df, kd, pairs, match="per_column").collect())
    kt = {(a, b) for a, b in keys if a is not None}
    ka = {a for a, _ in keys if a is not None}
    kb = {b for _, b in keys}
    assert got_t == sorted(r for r in rows if (r[0], r[1]) in kt)
    assert got_p == sorted(r for r in rows if r[0] in ka and r[1] in kb)


ts_st = st.lists(st.datetimes(min_value=dt.datetime(2024, 1, 1), max_value=dt.datetime(2024, 1, 6)),
                 min_size=1, max_size=30)


@settings(max_examples=15, deadline=None)
@given(ts_st, st.sampled_from(["=", "!=", ">", "<", ">=", "<="]),
       st.dates(min_value=dt.date(2024, 1, 1), max_value=dt.date(2024, 1, 6)))
def test_day_comparison_matches_brute_force(spark, stamps, op, day):
    df = spark.createDataFrame([(s,) for s in stamps],
                               T.StructType([T.StructField("ts", T.TimestampNTZType())]))
    meta = ColumnMeta("ts", "DATE")
    got = df.where(condition(FilterSpec("ts", op, (day.isoformat(),)), meta,
                             T.TimestampNTZType())).count()
    cmp = {"=": lambda d: d == day, "!=": lambda d: d != day, ">": lambda d: d > day,
           "<": lambda d: d < day, ">=": lambda d: d >= day, "<=": lambda d: d <= day}[op]
    assert got == sum(1 for s in stamps if cmp(s.date()))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9), st.integers(0, 9)),
                min_size=1, max_size=40))
def test_survivors_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, prio int, v int")
    got = sorted(tuple(r) for r in load.survivors(df, ["k"], ["prio"]).collect())
    best = {}
    for k, p, v in rows:
        if k not in best or (p, v) > best[k]:
            best[k] = (p, v)
    assert got == sorted((k, p, v) for k, (p, v) in best.items())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 99)), min_size=0, max_size=20,
                unique_by=lambda r: r[0]),
       st.lists(st.tuples(st.integers(0, 14), st.integers(0, 99)), min_size=0, max_size=20,
                unique_by=lambda r: r[0]))
def test_upsert_matches_brute_force(spark, stored, incoming):
    s = spark.createDataFrame(stored, "k int, v int")
    i = spark.createDataFrame(incoming, "k int, v int")
    got = sorted(tuple(r) for r in load.upsert(s, i, ["k"]).collect())
    want = dict(stored)
    want.update(dict(incoming))
    assert got == sorted(want.items())
