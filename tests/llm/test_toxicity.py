"""Toxicity: learning is checked by held-out accuracy, scoring by hand."""
import math
import zlib

import numpy as np
import pytest

from veilset.llm import toxicity as T

from .helpers import MESSY, empty, messy

SF = "/root/testdata/sf0.1"


def crc(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def weights(tables):
    return T.train(*tables)


def test_held_out_accuracy_and_sparsity(tables, weights):
    docs, labels = tables
    got = T.score(docs, weights).join(labels, "doc_id").collect()
    assert all(r["held_out"] == crc(r["doc_id"]) for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got)
    test = [r for r in got if r["held_out"]]
    right = np.mean([r["predicted"] == r["toxic"] for r in test])
    pos = np.array([r["score"] for r in test if r["toxic"] == 1])
    neg = np.array([r["score"] for r in test if r["toxic"] == 0])
    assert right > 0.97 and (pos[:, None] > neg[None]).mean() > 0.97
    assert (neg >= 0.5).mean() < 0.01
    assert 0 < np.count_nonzero(weights) < 5000


def test_held_out_labels_are_not_read(tables, spark, weights):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) "
                                "AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert np.allclose(T.train(docs, flipped), weights)


def test_score_is_the_sum_over_distinct_buckets():
    p = T.Params()
    rnd = np.random.default_rng(1)
    w = np.where(rnd.random((1 << p.bits) + 1) < .5, rnd.normal(size=(1 << p.bits) + 1), 0)
    for text in ("", "one", "Stupid stupid words, again and again: STUPID words"):
        assert math.isclose(T.margin(text, w), w[T.features(text)].sum() + w[-1])


def test_features_fold_case_and_share_stems():
    a, b = set(T.features("Achlichkeit")), set(T.features("achlichung"))
    assert a & b and a != b and set(T.features("ACHLICHKEIT")) == a
    few = T.Params(words_cached=4)      # the cache starts anew; buckets don't change
    text = "a b c d e f g h i j a b c"
    assert (T.features(text, few) == T.features(text)).all()


def test_weights_are_exactly_zero_below_the_l1_threshold():
    learner = T.Learner(T.Params(l1=100.0))
    w = learner.fit([(np.array([1, 2]), 1), (np.array([2, 3]), 0)])
    assert not w[:-1].any()


def test_messy_rows_and_odd_labels(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (5, 1, 0), (None, 1, 1), (6, 1, None), (7, 0, 5), (999, 1, 1),
         (8, 1, 1), (-9, 1, 0)], "doc_id long, quality int, toxic int")
    docs = messy(spark)
    got = T.score(docs, T.train(docs, labels)).collect()
    assert len(got) == len(MESSY) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"]: r["held_out"] for r in got} == {
        m[0]: m[0] is not None and crc(m[0]) for m in MESSY}


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert T.score(empty(spark), T.train(empty(spark), labels)).collect() == []
    got = T.score(messy(spark), T.train(messy(spark), labels)).collect()
    assert {r["score"] for r in got} == {0.5}


def test_several_learners_share_the_rows(tables):
    docs, labels = tables
    w = T.train(docs, labels, T.Params(learner_rows=1000))
    got = [r for r in T.score(docs, w).join(labels, "doc_id").collect() if r["held_out"]]
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) > 0.95
