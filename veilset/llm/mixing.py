"""Mixing sources to target weights: temperature mixing.

A source's weight is its share of all tokens to the power of an exponent,
normalised.  At exponent 1 a source weighs what it holds, below it small
sources gain.  The exponent is found by bisection, so that the weights' entropy
reaches a target, or so that no source is repeated more often than a limit
allows.  Evaluating an exponent is an aggregate over the source table; a
bisection round tries ``points`` exponents in one job.

The weights are realised with a token budget.  Unless one is given, it is the
least that shows every document at least once, so mixing drops nothing; a
source with more weight than tokens is repeated.  A source's share of the
budget is filled in epochs: whole passes over all its documents, then part of
one more.  Documents are dealt into blocks by a keyed hash, each epoch takes
the blocks in a keyed order of its own, and the last epoch stops inside the
block that meets the budget (at the document that reaches it).

Scale: sizes are counted in the scan.  Order and running sums are over blocks,
and over the documents of the one block per source where the budget ends, so a
source that holds a third of all rows is no hot group; rows meet the plan in a
join on (source, block).  The plan's tables are staged, so Spark broadcasts
them only if they are small.

Tokens are words (runs without white space).  Defined cases: a NULL source is a source;
a document without words costs nothing and is shown once per epoch of its
block; a source without words is shown once; repeated rows count each; NULL
ids and texts are values like any other; an empty table gives no rows; extra
columns are ignored by :func:`mix` and carried by :func:`realise`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, staged, unpack_row, whole_row


@dataclass(frozen=True)
class Params:
    max_repeats: float | None = 1.5        # times a source may be shown, or
    entropy: float | None = None           # target entropy of the weights, in bits
    budget: int | None = None              # tokens; None: the least that drops nothing
    block_rows: int = 512                  # documents in a block, about
    seed: int = 11
    points: int = 31                       # exponents tried in a bisection round
    tolerance: float = 1e-7


def n_words(text: Column) -> Column:
    """Words of a text."""
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), SPACE, -1)
    # only the first and the last part can be empty
    return (F.size(parts) - (F.element_at(parts, 1) == "").cast("int")
            - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("long")


def source_sizes(sized: DataFrame) -> DataFrame:
    """source, docs, tokens."""
    return sized.groupBy("source").agg(F.count("*").alias("docs"),
                                       F.sum("tokens").alias("tokens"))


def _measures(shares: DataFrame, exponents: list[float]) -> list[dict]:
    """Of each exponent: the weights' entropy, and the most that a source is
    repeated under the least budget that shows everything."""
    x, e = F.col("share"), F.col("e")
    # the exponents are data, so every round runs the same compiled plan
    tried = shares.select("share", F.explode(F.lit([float(v) for v in exponents])).alias("e"))
    rows = tried.groupBy("e").agg(
        F.sum(F.pow(x, e)).alias("z"), F.sum(F.pow(x, e) * F.log2(x)).alias("l"),
        F.max(F.pow(x, 1 - e)).alias("a"), F.max(F.pow(x, e - 1)).alias("b")).collect()
    return [{"exponent": r["e"], "z": r["z"],
             "entropy": math.log2(r["z"]) - r["e"] * r["l"] / r["z"],
             # the least budget, as a multiple of all tokens
             "budget": r["z"] * r["a"], "repeats": r["a"] * r["b"]}
            for r in sorted(rows)]


def solve(shares: DataFrame, p: Params = Params()) -> dict:
    """The measures of the exponent in [0, 1] that meets the target: the
    smallest under the repetition limit, or the one of the target entropy.
    Both measures fall as the exponent grows."""
    if (p.max_repeats is None) == (p.entropy is None):
        raise ValueError("give either max_repeats or entropy")
    if p.max_repeats is not None:
        fits = lambda m: m["repeats"] <= p.max_repeats      # noqa: E731
    else:
        fits = lambda m: m["entropy"] <= p.entropy          # noqa: E731
    low, high = _measures(shares, [0.0, 1.0])
    if fits(low):
        return low
    # fits(high) at exponent 1, or the target lies beyond the range
    while high["exponent"] - low["exponent"] > p.tolerance:
        step = (high["exponent"] - low["exponent"]) / (p.points + 1)
        tried = _measures(shares, [low["exponent"] + step * (i + 1) for i in range(p.points)])
        for m in tried:
            if fits(m):
                high = m
                break
            low = m
    return high


def _keyed(p: Params, *cols: Column | str) -> Column:
    return F.xxhash64(F.lit(p.seed), *cols)


def _block(p: Params) -> Column:
    return F.pmod(_keyed(p, F.lit("block"), "doc_id", "h"), F.col("blocks"))


def plan(sized: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per source its number of blocks and its weight; per (source, block,
    epoch) the block's place; the documents past the budget in the last block.
    ``sized``: doc_id, h, source, tokens."""
    sizes = staged(source_sizes(sized), "mix-sizes")
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    worded = sizes.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(total)))
    if total:
        found = solve(worded, p)
        budget = F.lit(float(p.budget) if p.budget is not None else found["budget"] * total)
        weight = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(found["exponent"])) \
            / F.lit(found["z"])
    else:
        budget, weight = F.lit(0.0), F.lit(0.0)
    passes = F.when(F.col("tokens") > 0, budget * weight / F.col("tokens")).otherwise(1.0)
    sources = staged(sizes.select(
        "source", "docs", "tokens", F.when(F.col("tokens") > 0, weight).otherwise(0.0)
        .alias("weight"),
        F.ceil(F.col("docs") / p.block_rows).alias("blocks"),
        F.floor(passes + 1e-9).cast("int").alias("whole"),
        F.greatest((passes - F.floor(passes + 1e-9)) * F.col("tokens"), F.lit(0.0))
        .alias("rest")), "mix-sources")
    blocks = staged(_with_source(sized, sources).groupBy("source", _block(p).alias("block")).agg(
        F.sum("tokens").alias("tokens")), "mix-blocks")
    known = sources.select(F.col("source").alias("s"), "whole", "rest")
    each = blocks.join(known, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "block", "tokens", "whole", "rest",
        F.explode(F.sequence(F.lit(0), F.col("whole"))).alias("epoch"))
    order = Window.partitionBy("source", "epoch").orderBy(
        _keyed(p, F.lit("order"), "source", "epoch", "block"), "block")
    placed = (each.withColumn("place", F.row_number().over(order))
              .withColumn("before", F.sum("tokens").over(
                  order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")))
    taken = staged(placed.where("epoch < whole OR before < rest").select(
        "source", "block", "epoch", "place",
        F.when((F.col("epoch") == F.col("whole")) & (F.col("before") + F.col("tokens")
                                                     > F.col("rest")),
               F.col("rest") - F.col("before")).alias("room")), "mix-plan")
    ends = taken.where("room IS NOT NULL").select(
        F.col("source").alias("s"), F.col("block").alias("b"), "epoch", "room")
    inside = _with_source(sized, sources).withColumn("block", _block(p)).join(
        ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    row = Window.partitionBy("source").orderBy(
        _keyed(p, F.lit("row"), "epoch", "doc_id", "h"), "doc_id", "h")
    upto = F.sum("tokens").over(row.rowsBetween(Window.unboundedPreceding, 0))
    # of rows repeated under one id and text the whole group stays or goes
    cut = staged(inside.withColumn("upto", upto - F.col("tokens")).groupBy(
        "source", "epoch", "doc_id", "h", "room").agg(F.min("upto").alias("upto")).where(
        "upto >= room").select("source", "epoch", "doc_id", "h"), "mix-cut")
    return sources, taken, cut


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    known = sources.select(F.col("source").alias("of_source"), "blocks")
    return rows.join(known, F.col("source").eqNullSafe(F.col("of_source")))


def _taken(rows: DataFrame, sources: DataFrame, taken: DataFrame, cut: DataFrame,
           p: Params) -> DataFrame:
    """Rows as often as the plan takes them, with epoch, block and place."""
    own = _with_source(rows, sources).withColumn("own_block", _block(p)).drop("of_source",
                                                                             "blocks")
    t = taken.withColumnRenamed("source", "of_source")
    out = own.join(t, F.col("source").eqNullSafe(F.col("of_source"))
                   & (F.col("own_block") == F.col("block"))).drop("of_source", "own_block")
    c = cut.select(F.col("source").alias("cs"), F.col("epoch").alias("ce"),
                   F.col("doc_id").alias("cd"), F.col("h").alias("ch"))
    return out.join(c, F.col("source").eqNullSafe(F.col("cs")) & (F.col("epoch") == F.col("ce"))
                    & F.col("doc_id").eqNullSafe(F.col("cd")) & (F.col("h") == F.col("ch")),
                    "left_anti")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", _hash().alias("h"), n_words(F.col("text"))
                       .alias("tokens"))


def _hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def mix(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block, place (of the block in its
    epoch's order): a row for each time that a row of ``docs`` is shown."""
    sized = staged(_sized(docs), "mix-sized")
    sources, taken, cut = plan(sized, p)
    return _taken(sized, sources, taken, cut, p).select(
        "doc_id", "source", F.col("tokens").alias("n_tokens"), "epoch", "block", "place")


def realise(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture shows it."""
    sources, taken, cut = plan(staged(_sized(docs), "mix-sized"), p)
    rows = docs.select("doc_id", "source", _hash().alias("h"), whole_row(docs))
    return unpack_row(_taken(rows, sources, taken, cut, p))
