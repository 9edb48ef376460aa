"""Exact top-k inner-product search, a block at a time.

Vectors are dealt into groups by ranges of their id and cut into blocks of
consecutive ids.  A block's forward index is its vectors (packed in the
smallest integer type that holds them) with the largest and the smallest value
of every dimension.  From these a query gets an upper bound of its score in
the block: a positive query term takes the block's maximum, a negative one its
minimum, and the sum over the terms bounds every inner product in the block.

Each query visits the blocks of a group in the order of its bounds, best
first, scores the block's vectors, and stops when the next bound is below its
k-th best score; a bound that equals it is still visited, as a tie goes to the
smaller id.  Queries travel to the groups in chunks, never the corpus to the
queries; each (chunk, group) pair is one row of a join, bounded in size, and
the best k of the groups are merged by a window per query.

Defined cases: a vector that is NULL, or holds a NULL, a NaN, an infinity or a
number that becomes one when it is scaled, or has a NULL id, takes no part; a missing dimension counts as zero; repeated
rows are candidates each; a query id that has several vectors uses the
smallest of them; a query never meets rows of its own id; scores beyond 64
bits are ranked exactly and returned as the nearest long; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_code, staged

_EXACT = float(1 << 53)       # integers below this are exact as double
_LONG = (-(1 << 63), (1 << 63) - 1)
_SHIFT = 10 ** 700            # over any product of two double vectors


@dataclass(frozen=True)
class Params:
    k: int = 20
    scale: float = 64.0
    block: int = 256          # vectors in a block
    group: int = 8192         # vectors in a group (one row of the index)
    chunk: int = 256          # queries in a chunk


# ---- packing ----------------------------------------------------------------

def _quantized(vectors: list, scale: float) -> np.ndarray:
    """Rows of floor(scale * x), padded with zeros."""
    dim = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return np.floor(out * scale)


def _packed(values: np.ndarray) -> tuple[str, bytes]:
    top = np.abs(values).max(initial=0.0)
    kind = "<i1" if top < 128 else "<i2" if top < 1 << 15 else "<f8"
    return kind, values.astype(kind).tobytes()


def _unpacked(kind: str, data: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(n, dim).astype(np.float64)


_ROWS = pa.schema([("grp", pa.int32()), ("n", pa.int32()), ("dim", pa.int32()),
                   ("kind", pa.string()), ("ids", pa.binary()), ("data", pa.binary())])
_ROWS_DDL = "grp int, n int, dim int, kind string, ids binary, data binary"


def _gather(size: int, scale: float):
    """Vectors of a partition, in their order, to packed rows of ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids: list[int] = []
        vectors: list = []

        def close() -> pa.RecordBatch:
            values = _quantized(vectors[:size], scale)
            kind, data = _packed(values)
            row = [part, len(values), values.shape[1], kind,
                   np.array(ids[:size], "<i8").tobytes(), data]
            del ids[:size], vectors[:size]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip(row, _ROWS, strict=True)], schema=_ROWS)

        for batch in batches:
            ids += batch.column(0).to_pylist()
            vectors += batch.column(1).to_pylist()
            while len(ids) >= size:
                yield close()
        if ids:
            yield close()

    return run


# ---- search -----------------------------------------------------------------

class Best:
    """The k best (score, id) of each of a number of queries."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.owner = np.zeros(0, np.int64)
        self.score: np.ndarray = np.zeros(0)
        self.ids = np.zeros(0, np.int64)
        self.kth = np.full(queries, -np.inf)

    def add(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(owner):
            return
        touched = np.zeros(len(self.kth), bool)
        touched[owner] = True
        again = touched[self.owner]
        o = np.concatenate([self.owner[again], owner])
        s = np.concatenate([self.score[again], score])
        d = np.concatenate([self.ids[again], ids])
        order = np.lexsort((d, -s, o))
        o, s, d = o[order], s[order], d[order]
        first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
        rank = np.arange(len(o)) - np.repeat(first, np.diff(np.r_[first, len(o)]))
        full = rank == self.k - 1
        self.kth[o[full]] = s[full]
        top = rank < self.k
        self.owner = np.concatenate([self.owner[~again], o[top]])
        self.score = np.concatenate([self.score[~again], s[top]])
        self.ids = np.concatenate([self.ids[~again], d[top]])


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
           k: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query positions, scores and ids of the best k, and the blocks scored."""
    dim = min(queries.shape[1], vectors.shape[1])
    queries, vectors = queries[:, :dim], vectors[:, :dim]
    reach = dim * np.abs(queries).max(initial=0.0) * np.abs(vectors).max(initial=0.0)
    if reach >= _EXACT:        # beyond doubles: Python integers
        as_int = np.vectorize(int, otypes=[object])
        queries, vectors = as_int(queries), as_int(vectors)
    cuts = range(0, len(ids), block)
    high = np.array([vectors[a:a + block].max(axis=0) for a in cuts]).reshape(len(cuts), dim)
    low = np.array([vectors[a:a + block].min(axis=0) for a in cuts]).reshape(len(cuts), dim)
    above = np.where(queries > 0, queries, 0)
    bounds = above @ high.T + (queries - above) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    best = Best(len(query_ids), k)
    if reach >= _EXACT:
        best.kth = best.kth.astype(object)
        best.score = best.score.astype(object)
    live = np.arange(len(query_ids))
    scored = 0
    for turn in range(len(cuts)):
        bound = bounds[live, order[live, turn]]
        live = live[bound >= best.kth[live]]
        if not len(live):
            break
        own = order[live, turn]
        for b in np.unique(own):
            who = live[own == b]
            at = int(b) * block
            there = ids[at:at + block]
            score = queries[who] @ vectors[at:at + block].T
            scored += len(who)
            hit = (score >= best.kth[who][:, None]) & (there[None, :] != query_ids[who][:, None])
            q, d = np.nonzero(hit)
            best.add(who[q], score[q, d], there[d])
    return best.owner, best.score, best.ids, scored


_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
                   ("exact", pa.string())])


def _search_rows(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                qids = np.frombuffer(r["q_ids"], "<i8")
                ids = np.frombuffer(r["ids"], "<i8")
                owner, score, near, _ = search(
                    qids, _unpacked(r["q_kind"], r["q_data"], r["q_dim"], r["q_n"]),
                    ids, _unpacked(r["kind"], r["data"], r["dim"], r["n"]), p.k, p.block)
                whole = [int(s) for s in score]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[owner], pa.int64()), pa.array(near, pa.int64()),
                     pa.array([min(max(s, _LONG[0]), _LONG[1]) for s in whole], pa.int64()),
                     # scores that a long cannot hold: digits that sort as the numbers do
                     pa.array([None if _LONG[0] <= s <= _LONG[1] else str(s + _SHIFT)
                               for s in whole], pa.string())], schema=_HITS)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, p: Params = Params()) -> DataFrame:
    """query_id, rank, vec_id, score: the best ``p.k`` rows of ``vectors``
    for every distinct ``vec_id`` of ``queries`` (both: vec_id, embedding)."""
    spark = vectors.sparkSession
    ship_code(spark)
    valid = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (
            F.abs(x.cast("double") * p.scale) < float("inf")))
    clean = vectors.select("vec_id", "embedding").where(valid)
    n = clean.count()
    groups = max(1, -(-n // p.group))
    index = staged(
        clean.repartitionByRange(groups, "vec_id").sortWithinPartitions("vec_id", "embedding")
        .mapInArrow(_gather(p.group, p.scale), _ROWS_DDL), "topk-index")
    asked = (queries.select("vec_id", "embedding").where(valid)
             .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    chunks = (asked.repartitionByRange("vec_id").sortWithinPartitions("vec_id")
              .mapInArrow(_gather(p.chunk, p.scale), _ROWS_DDL))
    last = index.agg(F.max("grp")).first()[0]
    sent = chunks.select(*[F.col(c).alias(f"q_{c}") for c in ("n", "dim", "kind", "ids", "data")],
                         F.explode(F.sequence(F.lit(0), F.lit(last or 0))).alias("grp"))
    pairs = index.join(sent, "grp")
    hits = pairs.select("q_n", "q_dim", "q_kind", "q_ids", "q_data", "n", "dim", "kind", "ids",
                        "data").mapInArrow(_search_rows(p),
                                           "query_id long, vec_id long, score long, exact string")
    order = Window.partitionBy("query_id").orderBy(
        F.col("score").desc(), F.col("exact").desc(), "vec_id")
    ranked = hits.select("*", F.row_number().over(order).alias("rank")).where(
        F.col("rank") <= p.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
