"""Mixing: the exponent, the budget, and which rows are shown how often."""
import math
import re
from collections import Counter, defaultdict

import pytest

from veilset.llm import mixing as M

from .helpers import MESSY, SF2, empty, messy, read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return len(WORD.findall(text or ""))


def check(rows, got, p=M.Params()):
    """``rows``: (doc_id, source, text); ``got``: rows of mix()."""
    have = Counter((d, s, tokens(t)) for d, s, t in rows)
    size = defaultdict(int)
    for d, s, t in rows:
        size[s] += tokens(t)
    total = sum(size.values())
    shown = defaultdict(int)
    for r in got:
        shown[r["source"]] += r["n_tokens"]
    low = min((v for v in size.values() if v), default=0)
    big = max(size.values(), default=0)
    # smallest exponent under the repetition limit, from its closed form
    e = max(0.0, 1 - math.log(p.max_repeats) / math.log(big / low)) if low != big else 0.0
    z = sum((v / total) ** e for v in size.values() if v) if total else 0
    budget = max(((v / total) / ((v / total) ** e / z) for v in size.values() if v),
                 default=0) * total
    per = Counter((r["doc_id"], r["source"], r["n_tokens"], r["epoch"]) for r in got)
    longest = max((tokens(t) for _, _, t in rows), default=0)
    groups = Counter((d, s, t) for d, s, t in rows)
    for s, v in size.items():
        if v:
            want = budget * (v / total) ** e / z
            most = max((n * tokens(t) for (d, s2, t), n in groups.items() if s2 == s), default=0)
            assert want - 1e-3 * want - 1 <= shown[s] <= want + most + 1 + 1e-3 * want, (s, e)
            assert shown[s] <= p.max_repeats * v * (1 + 1e-6) + most
        # every row once per whole epoch, at most once in the last
        whole = max((r["epoch"] for r in got if r["source"] == s), default=0)
        for (d, s2, n), k in have.items():
            if s2 == s:
                for epoch in range(whole):
                    assert per[d, s, n, epoch] == k
    for k, n in have.items():
        assert per[(*k, 0)] == n                 # nothing is dropped
    assert all(n <= have[k[:3]] for k, n in per.items())
    del longest


def test_whole_table(spark):
    got = M.mix(spark.read.parquet(f"{SF2}/documents.parquet"), M.Params(block_rows=8)).collect()
    check([(d["doc_id"], d["source"], d["text"]) for d in read(SF2, "documents")], got)


def skewed(n=900):
    """One source holds two thirds of all rows, others few."""
    return [(i, f"s{0 if i % 3 else i % 21}", "word " * (1 + i % 7)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


@pytest.mark.parametrize("p", [M.Params(block_rows=10), M.Params(max_repeats=3.7, block_rows=4),
                               M.Params(max_repeats=1.0), M.Params(max_repeats=1000.0)])
def test_skewed_sources(spark, p):
    rows = skewed()
    check(rows, M.mix(frame(spark, rows), p).collect(), p)


def test_target_entropy(spark):
    rows = skewed()
    shares = M.source_sizes(M._sized(frame(spark, rows)))
    total = shares.agg({"tokens": "sum"}).first()[0]
    shares = shares.selectExpr("source", f"tokens / {total}D AS share")
    for bits in (1.8, 2.2, 2.7):
        found = M.solve(shares, M.Params(max_repeats=None, entropy=bits))
        w = [r["share"] ** found["exponent"] for r in shares.collect()]
        h = -sum(x / sum(w) * math.log2(x / sum(w)) for x in w)
        assert abs(h - bits) < 1e-6
    with pytest.raises(ValueError):
        M.solve(shares, M.Params(entropy=1.0))


def test_epochs_permute_blocks_differently(spark):
    rows = [(i, "a" if i % 4 else "b", "w " * 3) for i in range(800)]
    got = M.mix(frame(spark, rows), M.Params(max_repeats=4.0, block_rows=10)).collect()
    order = defaultdict(dict)
    for r in got:
        if r["source"] == "b":
            order[r["epoch"]][r["block"]] = r["place"]
    assert len(order) > 1 and order[0] != order[1]
    assert sorted(order[0].values()) == list(range(1, len(order[0]) + 1))


def test_given_budget_below_the_corpus_is_met(spark):
    rows = skewed()
    got = M.mix(frame(spark, rows), M.Params(budget=1200, block_rows=10)).collect()
    assert 1200 <= sum(r["n_tokens"] for r in got) <= 1200 + 7 * 8


def test_result_is_repeatable_and_realise_agrees(spark):
    docs = messy(spark)
    p = M.Params(max_repeats=2.5, block_rows=2)
    one = Counter(map(tuple, M.mix(docs, p).collect()))
    assert one == Counter(map(tuple, M.mix(docs, p).collect()))
    check([(m[0], m[3], m[1]) for m in MESSY], M.mix(docs, p).collect(), p)
    out = M.realise(docs, p)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["source"], tokens(r["text"])) for r in out.collect()) == \
        Counter({k: sum(n for j, n in one.items() if j[:3] == k) for k in {j[:3] for j in one}})


def test_empty_table_and_no_words(spark):
    assert M.mix(empty(spark)).collect() == []
    assert M.realise(empty(spark)).columns == empty(spark).columns
    rows = [(1, "a", None), (2, None, ""), (2, None, "")]
    assert sorted((r["doc_id"], r["epoch"]) for r in M.mix(frame(spark, rows)).collect()) == [
        (1, 0), (2, 0), (2, 0)]


def test_words(spark):
    texts = ["", " ", "a", " a b ", "\n\ta\x0bb\x0cc\rd", "a b c", "x" * 9000, None]
    got = frame(spark, [(i, "s", t) for i, t in enumerate(texts)]).select(
        "doc_id", M.n_words(M.F.col("text")).alias("n")).collect()
    assert [r["n"] for r in sorted(got)] == [tokens(t) for t in texts]
