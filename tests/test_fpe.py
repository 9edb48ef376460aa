"""Format-preserving numbers and dense numbers against plain Python."""
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from veilset.functions import fpe, identity
from veilset.operators import dense


def plain(x, size, secret, tweak):
    a, b = fpe.halves(size)

    def once(x):
        left, right = divmod(x, b)
        for i in range(fpe.ROUNDS):
            half, m = (right, a) if i % 2 == 0 else (left, b)
            mac = hmac.new(secret.encode(), f"{tweak}:{i}:{half}".encode(), hashlib.sha256)
            f = int(mac.hexdigest()[:15], 16) % m
            if i % 2 == 0:
                left = (left + f) % a
            else:
                right = (right + f) % b
        return left * b + right

    x = once(x)
    while x >= size:
        x = once(x)
    return x


@pytest.mark.parametrize("size", [2, 10, 97, 1001, 10 ** 9, 10 ** 18])
def test_a_permutation_that_can_be_undone(spark, size):
    n = min(size, 1500)
    df = spark.range(n).select("id", fpe.encrypt_number(F.col("id"), size, "key", "t").alias("c"))
    df = df.select("id", "c", fpe.decrypt_number(F.col("c"), size, "key", "t").alias("back"))
    rows = df.collect()
    assert [r["back"] for r in rows] == [r["id"] for r in rows] == list(range(n))
    cipher = [r["c"] for r in rows]
    assert len(set(cipher)) == n and 0 <= min(cipher) and max(cipher) < size
    assert cipher[:200] == [plain(x, size, "key", "t") for x in range(min(n, 200))]


def test_no_linear_relation_and_keys_matter(spark):
    size = 10 ** 9
    df = spark.range(2000)
    a, b, c = ([r[0] for r in df.select(fpe.encrypt_number(F.col("id"), size, k, t)).collect()]
               for k, t in (("k1", "t"), ("k2", "t"), ("k1", "u")))
    steps = {(y - x) % size for x, y in zip(a, a[1:], strict=False)}
    assert len(steps) > 1990               # a multiply-and-add permutation has one step
    second = {(z - 2 * y + x) % size for x, y, z in zip(a, a[1:], a[2:], strict=False)}
    assert len(second) > 1990
    assert sum(x == y for x, y in zip(a, b, strict=True)) < 3
    assert sum(x == y for x, y in zip(a, c, strict=True)) < 3


def test_nulls_stay_and_numbers_outside_are_errors(spark):
    df = spark.createDataFrame([(None,), (5,)], "x long")
    assert df.select(fpe.encrypt_number(F.col("x"), 10, "k")).first()[0] is None
    with pytest.raises(Exception, match="not a number below 5"):
        df.select(fpe.encrypt_number(F.col("x"), 5, "k")).collect()
    for size in (0, 1, 10 ** 18 + 1):
        with pytest.raises(ValueError):
            fpe.halves(size)


def test_the_seed_is_required():
    with pytest.raises(TypeError):
        identity.IdentityGenerator()
    with pytest.raises(ValueError):
        identity.IdentityGenerator("")


def test_text_that_looks_like_a_number_is_another_key(spark):
    df = spark.createDataFrame([("7",), ("007",), (" 7",)], "k string")
    got = [r[0] for r in df.select(identity.unique_digits(F.col("k"), "t", 9, "s")).collect()]
    assert len(set(got)) == 3


@pytest.mark.parametrize("parts", [1, 5])
def test_dense_numbers(spark, parts):
    words = [f"k{i * 7919 % 1000:04d}" for i in range(700)]
    df = spark.createDataFrame([(w,) for w in words] + [(None,), ("k0001  ",)], "k string")
    got = dict(map(tuple, dense.dense_numbers(df.repartition(parts), "k").collect()))
    keys = sorted(set(words) | {"k0001"})
    assert got == {k: i for i, k in enumerate(keys)}
    some = dense.dense_numbers(df.where("k < 'k0300'"), "k")
    grown = dict(map(tuple, dense.dense_numbers(df, "k", known=some).collect()))
    first = [k for k in keys if k < "k0300"]
    rest = [k for k in keys if k >= "k0300"]
    assert grown == {k: i for i, k in enumerate(first + rest)}
    assert dense.dense_numbers(df.limit(0), "k").collect() == []
