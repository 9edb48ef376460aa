"""The pipeline, stage by stage, against the brute-force versions."""
import re
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from veilset.llm import pieces

from . import test_mixing as of_mixing
from . import test_pii as of_pii
from . import test_quality as of_quality
from . import test_simhash as of_simhash
from .helpers import MESSY, SF1, empty, messy

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output on the small table."""
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.staged(stage(spark, docs, SF1), f"test-{name}")
        out.append((docs.collect(), made.collect(), made.columns))
        docs = made
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "pii", "mixing",
                                                      "pieces"]
    for _, _, columns in stages[:4]:
        assert columns == COLUMNS
    assert stages[4][2] == ["doc_id", "ids", "n_tokens"]


def test_quality(stages):
    given, made, _ = stages[0]
    want = [r for r in given if not of_quality.brute(r["text"])[5]
            and of_quality.brute_kept(r["text"])]
    assert sorted(made) == sorted(want)


def test_simhash(stages):
    given, made, _ = stages[1]
    groups = of_simhash.brute_groups([of_simhash.brute_print(r["text"]) for r in given],
                                       [r["doc_id"] for r in given])
    assert sorted(made) == sorted(r for r, g in zip(given, groups, strict=True)
                                  if r["doc_id"] == g)


def test_pii(stages):
    given, made, _ = stages[2]
    got = {r["doc_id"]: r for r in made}
    assert len(made) == len(given)
    for r in given:
        new = got[r["doc_id"]]
        assert new["n_chars"] == len(new["text"])
        assert (new["lang"], new["source"]) == (r["lang"], r["source"])
        found = of_pii.base(r["text"])
        assert not of_pii.base(new["text"])
        if not found:
            assert new["text"] == r["text"]
        else:
            first = min(a for _, a, _, _ in found)
            assert new["text"][:max(0, first - 200)] == r["text"][:max(0, first - 200)]
            assert len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE)\]", new["text"])) >= 1


def test_mixing(stages):
    given, made, _ = stages[3]
    have = Counter(map(tuple, given))
    shown = Counter(map(tuple, made))
    assert set(have) == set(shown)                        # nothing dropped, nothing new
    size, now = Counter(), Counter()
    for r in given:
        size[r["source"]] += of_mixing.tokens(r["text"])
    for r in made:
        now[r["source"]] += of_mixing.tokens(r["text"])
    for s, n in size.items():
        longest = max(of_mixing.tokens(r["text"]) for r in given if r["source"] == s)
        assert n <= now[s] <= 1.5 * n + longest


def test_pieces(stages):
    given, made, _ = stages[4]
    model = pieces.Model(public_tokenizers.path("piece_bpe_32k.model"))
    back = Counter((r["doc_id"], model.decode(r["ids"]).decode()) for r in made)
    assert back == Counter((r["doc_id"], r["text"]) for r in given)
    assert all(r["n_tokens"] == len(r["ids"]) for r in made)


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF1).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter(
        (r["doc_id"], tuple(r["ids"])) for r in stages[4][1])


def test_messy_rows_and_empty_table_pass_every_stage(spark):
    for docs, some in ((messy(spark, [*MESSY, *MESSY]), True), (empty(spark), False)):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = corpus_pipeline.staged(stage(spark, docs, SF1), f"odd-{name}")
            if name != "pieces":
                assert docs.columns == columns
        assert bool(docs.count()) == some
