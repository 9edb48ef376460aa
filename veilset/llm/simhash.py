"""SimHash near-duplicates, linked through BK-trees.

A text's fingerprint holds, for each of 64 bits, whether more than half of its
word shingles' hashes have that bit set.  Texts whose fingerprints differ in at
most ``radius`` bits are linked; a group is a connected component of links.

Finding the links at scale:

* equal fingerprints are merged first (``groupBy`` with map-side combine), so
  exact copies, however many, are one fingerprint;
* the 64 bits are cut into ``blocks`` ranges.  Two fingerprints within
  ``radius`` bits agree in at least ``blocks - radius`` whole ranges, so for
  every choice of that many ranges fingerprints are dealt into *shards* by
  those bits.  No link is missed and a shard is small: with 5 blocks its key
  has 25 bits or more;
* a shard of more than ``tree_size`` fingerprints is cut into slices, and each
  pair of slices is a task group of its own, so no group is ever larger than
  two slices;
* in a group the first slice becomes a BK-tree (children keyed by the Hamming
  distance to their parent) and the fingerprints of the second are looked up
  in it, following only the edges within the radius.  The links found are
  joined up inside the group, and only one edge per fingerprint leaves it;
* the edges go through distributed connected components.

The trees travel with the shuffle instead of a broadcast: a broadcast of all
shard trees would grow with the corpus, a shard reaches just the task that
needs it.

Defined cases: a text without words has fingerprint zero and links like any
other; NULL text is the empty text; rows with a NULL ``doc_id`` are kept and
count for links, a group's id is its smallest non-NULL ``doc_id``; repeated
rows stay; an empty table gives an empty result; extra columns are ignored by
:func:`cluster` and carried by :func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_code, staged, text_bytes, unpack_row, whole_row
from .components import components


@dataclass(frozen=True)
class Params:
    shingle: int = 3
    radius: int = 3
    blocks: int = 5
    tree_size: int = 2048
    seed: int = 42


_CHUNK = 1 << 15     # shingles whose bits are counted at a time


def fingerprint(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of a text (UTF-8 bytes)."""
    words = data.lower().split()     # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) <= shingle:
        grams: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        n = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, grams, repeat(seed))
    for at in range(0, n, _CHUNK):
        part = np.fromiter(hashes, np.uint64, min(_CHUNK, n - at))
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * counts > n, bitorder="little").view("<u8")[0]
    return int(value)


def _fingerprints(p: Params):
    ship_code()

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint(v.as_py() or b"", p.shingle, p.seed) for v in batch]
            yield pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())

    return run.asNondeterministic()


class BKTree:
    """Distinct fingerprints; a child hangs on the edge of its distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        if not self.values:
            self.values.append(value)
            self.edges.append({})
            return
        node = 0
        while True:
            d = (self.values[node] ^ value).bit_count()
            if d == 0:
                return
            child = self.edges[node].get(d)
            if child is None:
                self.edges[node][d] = len(self.values)
                self.values.append(value)
                self.edges.append({})
                return
            node = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Values at most ``radius`` bits away from ``value``."""
        todo = [0] if self.values else []
        values, edges = self.values, self.edges
        while todo:
            node = todo.pop()
            d = (values[node] ^ value).bit_count()
            if d <= radius:
                yield values[node]
            below = edges[node]
            if below:
                low, high = d - radius, d + radius
                todo.extend([c for e, c in below.items() if low <= e <= high])


def linked(first: list[int], second: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """One ``(fingerprint, group's smallest)`` per fingerprint that links to
    another: within ``first`` (``second`` None) or between the two lists."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    tree = BKTree()
    if second is not None:
        for v in first:
            tree.add(v)
    for v in first if second is None else second:
        for near in tree.within(v, radius):
            a, b = find(v), find(near)
            if a != b:
                root[max(a, b)] = min(a, b)
        if second is None:
            tree.add(v)
    return [(x, r) for x in list(root) if (r := find(x)) != x]


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _link_groups(radius: int):
    """Batches sorted by (combo, shard, low, high) to edges, group by group."""

    def close(own: dict) -> list[tuple[int, int]]:
        key = own["key"]
        same = key[2] == key[3]
        return linked(own["first"], None if same else own["second"], radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict = {"key": None}
        out: list[tuple[int, int]] = []
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for combo, shard, low, high, is_first, fp in zip(*cols, strict=True):
                key = (combo, shard, low, high)
                if key != own["key"]:
                    if own["key"] is not None:
                        out += close(own)
                    own = {"key": key, "first": [], "second": []}
                own["first" if is_first else "second"].append(fp & 0xFFFFFFFFFFFFFFFF)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_signed(x[i]) for x in out], pa.int64()) for i in (0, 1)],
                    schema=_EDGE)
                out = []
        if own["key"] is not None and (out := close(own)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([_signed(x[i]) for x in out], pa.int64()) for i in (0, 1)],
                schema=_EDGE)

    return run


def _masks(p: Params) -> list[int]:
    """Bit masks of every choice of ``blocks - radius`` ranges, as signed."""
    if p.blocks <= p.radius:
        raise ValueError("blocks must be more than radius")
    cuts = [64 * i // p.blocks for i in range(p.blocks + 1)]
    ranges = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [_signed(sum(c)) for c in combinations(ranges, p.blocks - p.radius)]


def links(fps: DataFrame, p: Params = Params()) -> DataFrame:
    """Edges ``(a, b)`` that connect the distinct fingerprints (column ``fp``)
    of each group; not every pair, but enough to connect all that link."""
    ship_code(fps.sparkSession)
    masks = _masks(p)
    dealt = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("combo"), F.col("fp").bitwiseAND(F.lit(m)).alias("shard"))
        for i, m in enumerate(masks)])).alias("k")).select("fp", "k.combo", "k.shard")
    full = dealt.groupBy("combo", "shard").agg(F.count("*").alias("n")).where("n > 1").select(
        "combo", "shard", F.ceil(F.col("n") / p.tree_size).cast("int").alias("slices"))
    own: Column = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    groups = (
        dealt.join(full, ["combo", "shard"])
        .select("combo", "shard", "fp", own.alias("slice"),
                F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other"))
        .select("combo", "shard", F.least("slice", "other").alias("low"),
                F.greatest("slice", "other").alias("high"),
                (F.col("slice") <= F.col("other")).alias("is_first"), "fp"))
    keys = ["combo", "shard", "low", "high"]
    return (groups.repartition(*keys).sortWithinPartitions(*keys, "fp")
            .mapInArrow(_link_groups(p.radius), "a long, b long"))


def _placed(docs: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """doc_id, h (of the text), fp per row; fp, root, component_id per fingerprint."""
    text = text_bytes("text")
    fps = staged(docs.select("doc_id", F.xxhash64(text).alias("h"),
                             _fingerprints(p)(text).alias("fp")), "simhash-fp")
    distinct = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    labels = components(links(distinct, p), "simhash-cc")
    placed = distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps, placed.join(ids, "root").select("fp", "root", "component_id")


def cluster(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: a row per row."""
    fps, of_fp = _placed(docs, p)
    return fps.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The document with the smallest id of each group, with all its columns.

    A group is told by its fingerprints, so two texts under one ``doc_id`` that are
    not near each other are two documents: both stay if each is its group's first
    (by id, then by a hash of the text).  A row repeated under one ``doc_id`` with
    the same text stays once; rows without an id cannot be told apart from each
    other and all stay."""
    fps, of_fp = _placed(docs, p)
    first = fps.where("doc_id IS NOT NULL").join(of_fp, "fp").groupBy("root").agg(
        F.min(F.struct("doc_id", "h")).alias("x")).select("x.doc_id", "x.h").distinct()
    packed = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text_bytes("text")).alias("own"),
                         whole_row(docs))
    kept = packed.join(first, (F.col("id") == F.col("doc_id")) & (F.col("own") == F.col("h")),
                       "left_semi").dropDuplicates(["id", "own"])
    return unpack_row(kept.drop("own").unionAll(packed.where("id IS NULL").drop("own")))
