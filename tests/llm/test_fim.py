"""Fill-in-middle against plain Python, and the rank index against its offsets."""
import hashlib
import random
import re

import numpy as np
import pytest

from veilset.llm import fim

from .helpers import MESSY, SF1, empty, messy, read, rows

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text, p=fim.Params()):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = sha(p.salt + ("" if doc_id is None else str(doc_id)))
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= p.plain_from:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    if h[3] % 100 < p.spm_below:
        form, out = "spm", f"<S>{suf}<P>{pre}<M>{mid}"
    else:
        form, out = "psm", f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, form, len(pre), len(mid), sha(out), sha(text)


MARKED = [(i, t, None, None) for i, t in enumerate(
    ["a <P> b", "<S>", "x<M>", "< P> <p> <", "<P", ">M><S <<", "<<<>>>", "a" * 5000, "é" * 700,
     "日本語 mixed with words " * 300, "abc" + "\n" * 2000 + "word " * 900], 100)]


@pytest.mark.parametrize("spm", [0, 20, 100])
def test_examples_equal_plain_python(spark, spm):
    p = fim.Params(spm_below=spm)
    given = [(i, t, lang, src) for i, t, lang, src in MESSY + MARKED]
    got = rows(fim.digests(messy(spark, given), p))
    assert got == sorted((expected(i, t, p) for i, t, *_ in given), key=repr)
    assert rows(fim.digests(empty(spark))) == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    want = [expected(r["doc_id"], r["text"]) for r in read(SF1, "documents")]
    assert rows(fim.digests(docs)) == sorted(want, key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_every_rank_is_found(spark):
    random.seed(5)
    texts = ["", "a", "été", " ".join("x" * random.randrange(1, 40) for _ in range(5000)),
             "z" * 9000 + " " * 9000 + "ab " * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = (docs.select("id", fim.rank_index(docs.text).alias("i"))
           .selectExpr("id", "i", "explode(sequence(0L, i.n)) AS r")
           .select("id", "r", fim.offset_at(fim.F.col("i"), fim.F.col("r")).alias("at")).collect())
    want = []
    for i, t in enumerate(texts):
        ends = np.cumsum([0, *map(len, UNIT.findall(t))]).tolist()
        want += [(i, r, at) for r, at in enumerate(ends)]
    assert sorted(tuple(g) for g in got) == want


@pytest.mark.parametrize("error", [1, 7, 120])
def test_segments_are_error_bounded_and_longer_with_more_room(error):
    random.seed(error)
    y = np.cumsum([0, *(random.choice([1, random.randrange(1, 9)]) for _ in range(4000))])
    segments, residuals = fim.fit(y, error)
    assert np.abs(residuals.astype(int)).max() <= error + 1
    if error > 1:
        assert len(segments) < len(fim.fit(y, error // 2)[0])


def test_errors_beyond_a_byte_are_refused(spark):
    with pytest.raises(ValueError):
        fim.rank_index(fim.F.lit("x"), fim.Params(error=127))
