"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and
skip-grams.

A text's features are the buckets of its words, of the words' stems (their
first few letters, so that one evidence serves all endings of a word), of
neighbouring word pairs and of word pairs with one word skipped (case folded,
each bucket once).  Training
follows the regularised leader per coordinate: a coordinate's learning rate
falls with the gradients it has seen, and its weight stays exactly zero until
its evidence exceeds the L1 threshold, so the model is a short list of buckets
and weights.

Training: labelled rows are thinned by a hash of their id to about
``max_rows`` (documented bound; fewer rows are all used) and dealt by hash to
learners of about ``learner_rows`` rows.  Every learner runs ``epochs`` passes
over its rows' features; the model is the mean of the learners' weights.  Only
features, not texts, reach a learner, and the model has at most ``2**bits + 1``
weights (in fact a few hundred), which bounds what is sent to the executors.

Scoring is one pass over the texts with no shuffle.

Defined cases: a NULL or empty text has no features and gets the score of the
intercept; texts are read whole, however long; rows with NULL or other labels
than 0 and 1 are not learnt from; an id labelled both 0 and 1 counts as
toxic, and of several texts under one id the smallest is learnt from; repeated
rows are scored each; without any label every score is 0.5 of
an untrained model; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_code, text_bytes

_WORD = re.compile(r"[^\W_]+")
# odd 64-bit multipliers that mix the hashes of a pair (fixed values)
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SKIP_FIRST, _SKIP_SECOND = np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)


@dataclass(frozen=True)
class Params:
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.5
    epochs: int = 4
    max_rows: int = 16_384
    learner_rows: int = 8_192
    stems: tuple[int, ...] = (4, 5, 6, 7)
    words_cached: int = 400_000


class Hasher(dict):
    """Word to the row of its hashes (its own, then its stems'); forgets all
    words when ``limit`` are known."""

    def __init__(self, limit: int, stems: tuple[int, ...]) -> None:
        super().__init__()
        self.stems = stems
        self.hashes = np.zeros((limit, 1 + len(stems)), np.uint64)

    def __missing__(self, word: str) -> int:
        at = len(self)
        own = xxhash.xxh64_intdigest(word)
        self.hashes[at] = [own, *(xxhash.xxh64_intdigest(word[:n], n) if len(word) > n else own
                                  for n in self.stems)]
        self[word] = at
        return at

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) + len(words) > len(self.hashes):
            self.clear()
        return self.hashes[np.fromiter(map(self.__getitem__, words), np.int64, len(words))]


_HASHERS: dict[tuple, Hasher] = {}


def _hasher(p: Params) -> Hasher:
    key = (p.words_cached, p.stems)
    if key not in _HASHERS:
        _HASHERS[key] = Hasher(*key)
    return _HASHERS[key]


def buckets(text: str, p: Params = Params()) -> np.ndarray:
    """Buckets of a text, as often as they occur."""
    hasher = _hasher(p)
    words = _WORD.findall(text.lower())
    step = p.words_cached // 2
    rows = np.concatenate([hasher.of(words[at:at + step])
                           for at in range(0, len(words), step)] or [hasher.hashes[:0]])
    h = rows[:, 0]
    shift = np.uint64(64 - p.bits)
    with np.errstate(over="ignore"):
        pairs = h[:-1] * _FIRST + h[1:] * _SECOND
        skips = h[:-2] * _SKIP_FIRST + h[2:] * _SKIP_SECOND
    return (np.concatenate([rows.reshape(-1), pairs, skips]) >> shift).astype(np.int32)


def features(text: str, p: Params = Params()) -> np.ndarray:
    """Sorted distinct buckets of a text."""
    return np.unique(buckets(text, p))


def margin(text: str, weights: np.ndarray, p: Params = Params()) -> float:
    """Intercept and weights of the text's distinct buckets, summed."""
    found = buckets(text, p)
    found = np.unique(found[weights[found] != 0])     # few: most weights are zero
    return float(weights[found].sum() + weights[-1])


class Learner:
    """FTRL-proximal with one more coordinate, not penalised, as intercept."""

    def __init__(self, p: Params) -> None:
        self.p = p
        self.z = np.zeros((1 << p.bits) + 1)
        self.n = np.zeros((1 << p.bits) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        p, z = self.p, self.z[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, p.l1)
        step = (p.beta + np.sqrt(self.n[at])) / p.alpha + p.l2
        return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / step, 0.0)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.p.alpha * w
        self.n[at] = n + g * g

    def fit(self, rows: list[tuple[np.ndarray, int]]) -> np.ndarray:
        for _ in range(self.p.epochs):
            for at, label in rows:
                self.learn(at, label)
        return self.weights(np.arange(len(self.z)))


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


_FEATURES = pa.list_(pa.int32())


def _features_udf(p: Params):
    ship_code()

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [features((v.as_py() or b"").decode(), p) for v in batch]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([*found, np.zeros(0, np.int32)])
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))

    return run.asNondeterministic()


def _fit_group(p: Params):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["turn", "doc_id", "toxic"], kind="stable")
        learner = Learner(p)
        w = learner.fit([(np.asarray(f, np.int64), int(y))
                         for f, y in zip(rows["found"], rows["toxic"], strict=True)])
        at = np.flatnonzero(w)
        return pd.DataFrame({"bucket": at.astype(np.int32), "weight": w[at]})

    return run


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> np.ndarray:
    """Weights (the intercept last) learnt from the labelled rows of ``docs``
    that are not held out."""
    ship_code(docs.sparkSession)
    usable = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = usable.where(~held_out(F.col("doc_id")))
    total = usable.count()
    if not total:
        return np.zeros((1 << p.bits) + 1)
    share = min(1.0, p.max_rows / total)
    learners = max(1, round(min(total, p.max_rows) / p.learner_rows))
    key = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(1 << 30))
    some = usable.where(key < int(share * (1 << 30)))
    # about ``max_rows`` ids whatever the input, so they may be broadcast: no
    # text moves but those that are learnt from
    texts = docs.select("doc_id", text_bytes("text").alias("text")).join(
        F.broadcast(some), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = texts.select(
        "doc_id", "toxic", _features_udf(p)(F.col("text")).alias("found"),
        F.pmod(F.xxhash64("doc_id", F.lit("turn")), F.lit(1 << 30)).alias("turn"))
    weights = rows.withColumn("learner", F.col("turn") % learners).groupBy("learner").applyInPandas(
        _fit_group(p), "bucket int, weight double")
    found = weights.groupBy("bucket").agg((F.sum("weight") / learners).alias("weight")).collect()
    out = np.zeros((1 << p.bits) + 1)
    for r in found:      # at most 2**bits + 1 rows
        out[r["bucket"]] = r["weight"]
    return out


def _score_udf(model, p: Params):
    ship_code()

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at, weight = model.value
        w = np.zeros((1 << p.bits) + 1)
        w[at] = weight
        for batch in batches:
            sums = [margin((v.as_py() or b"").decode(), w, p) for v in batch]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(sums), -700, 700))), pa.float64())

    return run.asNondeterministic()


def score(docs: DataFrame, weights: np.ndarray, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per row of ``docs``."""
    at = np.flatnonzero(weights)
    model = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), weights[at]))
    out = docs.select("doc_id", _score_udf(model, p)(text_bytes("text")).alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
