"""Multiset comparison against plain counting."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veilset.operators import reconcile

SCHEMA = "k long, a string, b string, x double, m map<string,int>"


def random_rows(seed, n):
    r = random.Random(seed)
    pick = [None, "", "a", "b", "ab"]
    return [(r.choice([None, *range(12)]), r.choice(pick), r.choice(pick),
             r.choice([None, 0.0, 1.5, float("nan")]),
             r.choice([None, {}, {"p": 1, "q": 2}])) for _ in range(n)]


def canon(row):
    return tuple("nan" if isinstance(v, float) and v != v else
                 tuple(sorted(v.items())) if isinstance(v, dict) else v for v in row)


def expected(a, b):
    ca, cb = Counter(map(canon, a)), Counter(map(canon, b))
    out = []
    for k in {r[0] for r in (*ca, *cb)}:
        rows = {r for r in (*ca, *cb) if r[0] == k}
        missing = sum(max(ca[r] - cb[r], 0) for r in rows)
        extra = sum(max(cb[r] - ca[r], 0) for r in rows)
        unknown = sum(cb[r] for r in rows if not ca[r])
        if missing or extra:
            status = "lost" if not extra else "changed" if missing else \
                "added" if unknown else "doubled"
            out.append((k, status, sum(ca[r] for r in rows), sum(cb[r] for r in rows)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("buckets", [1, 5, 4096])
def test_differences_equal_plain_counts(spark, buckets):
    for seed in range(3):
        a = random_rows(seed, 60)
        b = a[5:] + random_rows(seed + 50, 6) + a[7:9]
        random.Random(seed).shuffle(b)
        got = reconcile.reconcile(spark.createDataFrame(a, SCHEMA),
                                  spark.createDataFrame(b, SCHEMA).repartition(3), ["k"],
                                  buckets=buckets)
        assert sorted(map(tuple, got.collect()), key=repr) == expected(a, b)


def test_equal_tables_differ_nowhere(spark):
    a = spark.createDataFrame(random_rows(9, 200), SCHEMA)
    assert reconcile.fingerprint(a) == reconcile.fingerprint(a.repartition(5))
    assert reconcile.differing_buckets(a, a.repartition(4), ["k"], a.columns) == []
    assert reconcile.reconcile(a, a.orderBy(F.rand(3)), ["k"]).count() == 0
    empty = a.limit(0)
    assert reconcile.fingerprint(empty) == reconcile.Fingerprint(0, 0, 0)
    assert reconcile.reconcile(empty, empty, ["k"]).count() == 0
    assert reconcile.reconcile(empty.drop("m"), empty.drop("m")).count() == 0
    with pytest.raises(ValueError, match="maps"):
        reconcile.reconcile(a, a)


def test_a_null_that_moves_and_a_doubled_row_change_the_fingerprint(spark):
    one = spark.createDataFrame([(None, "a"), ("b", "c")], "x string, y string")
    two = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    assert reconcile.fingerprint(one) != reconcile.fingerprint(two)
    assert reconcile.fingerprint(one.unionAll(one)) != reconcile.fingerprint(one)


def test_types_must_agree(spark):
    with pytest.raises(ValueError, match="column id"):
        reconcile.reconcile(spark.range(3), spark.range(3).selectExpr("cast(id AS int) AS id"))
