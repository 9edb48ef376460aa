"""Quality rules against counts made word by word."""
import re
from collections import Counter

import pytest
import zstandard

from veilset.llm import quality

from .helpers import MESSY, SF2, empty, messy, read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    wins = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {i + j for i in range(len(words) - 4) if wins[tuple(words[i:i + 5])] > 1
           for j in range(5)}
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup,
            len(hit), failed)


def brute_kept(text):
    b = quality.Bands()
    data, z = (text or "").encode(), zstandard.ZstdCompressor(level=b.level, write_checksum=False)
    ratio = len(data) / len(z.compress(data)) if data else 0
    low, high = next((lo, hi) for n, lo, hi in reversed(b.whole) if len(data) >= n)
    cut = [data[i:i + b.chunk_bytes] for i in range(0, len(data), b.chunk_bytes)]
    if len(cut) > 1 and len(cut[-1]) < b.chunk_bytes // 2:
        cut[-2:] = [cut[-2] + cut[-1]]
    bad = [not b.chunk_low <= len(c) / len(z.compress(c)) <= b.chunk_high
           for c in cut] if len(cut) > 1 else []
    return bool(data) and low <= ratio <= high and sum(bad) <= b.max_bad_chunks * len(cut)


def check(got, texts):
    assert len(got) == len(texts)
    for r, t in zip(got, texts, strict=True):
        want = brute(t)
        assert tuple(r[1:7]) == want, t
        assert r["kept"] == (not want[5] and brute_kept(t))


def test_base_counts_and_verdict_on_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    got = {r["doc_id"]: r for r in quality.score(docs).collect()}
    source = read(SF2, "documents")
    check([got[d["doc_id"]] for d in source], [d["text"] for d in source])


def test_messy_rows(spark):
    key = lambda x: repr(x)
    got = sorted(quality.score(messy(spark)).collect(), key=lambda r: key((r[0], r[1], r[2])))
    want = sorted(MESSY, key=lambda m: key((m[0], *brute(m[1])[:2])))
    check(got, [m[1] for m in want])


def test_empty_table(spark):
    assert quality.score(empty(spark)).count() == 0
    assert quality.keep(empty(spark)).columns == empty(spark).columns


def test_keep_returns_whole_rows(spark):
    docs = messy(spark)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted((m[0] for m in MESSY if not brute(m[1])[5] and brute_kept(m[1])),
                         key=repr)
    assert ids.count(1) == 2        # repeated rows stay


@pytest.mark.parametrize("text, kept", [
    ("".join(f"{i * 2654435761 % 2**32:08x}{i * 40503 % 65521:04x} "
             for i in range(2000)), True),            # hex: four bits in eight
    (" ".join(f"line {i % 4} of the same old song" for i in range(300)), False),
])
def test_bands(text, kept):
    got = quality.in_band(text.encode(), quality.Bands(), zstandard.ZstdCompressor(level=3))
    assert got[0] == kept


def test_noise_is_rejected():
    import base64
    import hashlib
    raw = b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(400))
    blob = base64.b64encode(raw)
    text = b" ".join(blob[i:i + 60] for i in range(0, len(blob), 60))
    assert not quality.in_band(text, quality.Bands(), zstandard.ZstdCompressor(level=3))[0]
