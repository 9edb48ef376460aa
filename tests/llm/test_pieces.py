"""Piece encoding: the library without dropout, lossless and keyed with it."""
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from veilset.llm import pieces as P

from .helpers import MESSY, SF1, empty, messy, read

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a  b ", "\n x\ty été  ", "日本 語", "   lead", "\x00\x01", "é", "<s> </s>",
       "<0x0A>", "a" * 500, " " * 300, "x y" * 200, "😀 👩‍👩‍👧"]


@pytest.fixture(scope="module")
def plain():
    return P.Model(PATH, P.Params(dropout=0.0))


@pytest.fixture(scope="module")
def model():
    return P.Model(PATH)


def test_without_dropout_it_is_the_library(plain):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for t in [d["text"] for d in read(SF1, "documents")] + ODD:
        assert plain.encode(t).tolist() == sp.encode(t), t[:80]
        assert plain.decode(sp.encode(t)).decode() == sp.decode(sp.encode(t))


def brute(model, unit, variant):
    """The agenda by scanning all pairs for the best at every step."""
    import xxhash
    key = xxhash.xxh64_intdigest(unit, model.p.seed * model.p.variants + variant)
    cuts = list(range(len(unit) + 1))
    skipped = set()
    while True:
        best = None
        for a, b, c in zip(cuts, cuts[1:], cuts[2:], strict=False):
            r = model.rank.get(unit[a:c])
            if r and (a, b, c) not in skipped and (best is None or (r[0], a) < best[:2]):
                best = (r[0], a, b, c)
        if best is None:
            break
        _, a, b, c = best
        x = (key ^ (a * 1_000_003 + b * 8191 + c) * P._GOLD) * P._MIX & P._MASK
        if (x ^ x >> 29) * P._MIX >> 31 & 0xFFFFFFFF < model.threshold:
            skipped.add((a, b, c))
        else:
            cuts.remove(b)
    out = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        r = model.rank.get(unit[a:b])
        out += [r[1]] if r else [model.byte_id[x] for x in unit[a:b].encode()]
    return out


def test_dropout_follows_the_agenda(model):
    words = {" " + w for d in read(SF1, "documents")[:40] for w in d["text"].split()}
    for w in sorted(words)[:1500]:
        for v in range(2):
            assert model.merged(w, v) == brute(model, w, v), w


def test_units_change_nothing(model):
    for w in (" it's...", " x1.25%", " Ünïcode-Wörter,", " (a)b[c]"):
        for v in range(4):
            cut = [i for u in model._cut(w) for i in model.merged(u, v)]
            assert b"".join(model.bytes_of[i] for i in cut) == w.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(), st.integers(0, 9))
def test_any_text_decodes_to_itself(text, key):
    m = P._model(PATH, P.Params(dropout=0.3))
    assert m.decode(m.encode(text, str(key)).tolist()).decode() == text


def test_lossless_on_the_space_mark_and_long_texts(model):
    for t in [*ODD, "▁ lit▁eral", "ab  " * 700_000, "long" * 400_000]:
        assert model.decode(model.encode(t, "k").tolist()).decode() == t


def test_segmentations_vary_and_are_keyed(model):
    text = "internationalization of the unbelievable reconsiderations " * 40
    one, two = model.encode(text, "1"), model.encode(text, "2")
    assert len(one) != len(two) or (one != two).any()
    again = P.Model(PATH).encode(text, "1")
    assert (one == again).all()
    per_word = {tuple(model.merged(" internationalization", v)) for v in range(4)}
    assert len(per_word) > 1
    small = P.Model(PATH, P.Params(remembered=8))        # forgetting changes nothing
    assert (small.encode(text, "1") == one).all()
    assert len(one) > len(P.Model(PATH, P.Params(dropout=0.0)).encode(text))


def test_round_trip_of_rows(spark, model):
    got = sorted(map(tuple, P.round_trip(messy(spark), PATH).collect()), key=repr)
    want = []
    for d, t, *_ in MESSY:
        ids = model.encode(t or "", str(d))
        data = (t or "").encode()
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), len(t or ""),
                     zlib.crc32(data), True))
    assert got == sorted(want, key=repr)


def test_encode_and_decode_are_inverse_on_a_table(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    back = P.decode(P.encode(docs, PATH), PATH)
    assert sorted(map(tuple, back.collect())) == sorted(
        (d["doc_id"], d["text"]) for d in read(SF1, "documents"))


def test_empty_table(spark):
    assert P.round_trip(empty(spark), PATH).collect() == []
    assert P.decode(P.encode(empty(spark), PATH), PATH).collect() == []


def test_every_occurrence_draws_its_own(model):
    """Far more than a few segmentations, as the agenda makes them, at the right rate."""
    word, n = "internationalization", 4000
    base = P.xxhash.xxh64_intdigest("k", model.p.seed)
    which = P._occurrences(n, base).tolist()
    want = [model.merged(" " + word, v) for v in which]
    assert model.encode(" ".join([word] * n), "k").tolist() == [i for x in want for i in x]
    assert len({tuple(x) for x in want}) > 20
    pair = next(u for u in (" a", " t", " th") if len(model._agenda(u, 0, ())[1]) == 1)
    plain = model._agenda(pair, 0, ())[0]
    varied = sum(model.merged(pair, v) != plain for v in which)
    assert 0.07 * n < varied < 0.13 * n


def test_showings_differ(spark):
    text = "internationalization of the unbelievable reconsiderations " * 5
    docs = messy(spark, [(1, text, "en", "a")] * 3 + [(2, text, "en", "a")])
    got = P.encode(P.showings(docs), PATH).collect()
    assert len({tuple(r["ids"]) for r in got}) == 4
    assert sorted(r["doc_id"] for r in got) == [1, 1, 1, 2]


def test_hashes_of_short_units_are_the_library_s():
    for size in range(1, 32):
        data = [bytes((7 * i + size * j) % 256 for j in range(size)) for i in range(20)]
        lanes = np.frombuffer(b"".join(d.ljust(32, b"\0") for d in data), "<u8").reshape(-1, 4)
        seeds = np.arange(20, dtype=np.uint64) * np.uint64(P._GOLD)
        want = [P.xxhash.xxh64_intdigest(d, int(x)) for d, x in zip(data, seeds, strict=True)]
        assert P.short_xxh64(lanes, size, seeds).tolist() == want


def test_words_are_cut_together_as_each_alone(model):
    words = [" plain", "  two  spaces", " été", " 中文x", " a\U0001f600b", " \x00q▁r",
             " ", " 12,345.67", " ..--..", " a"]
    joins = {piece[i:i + 2] for piece in model.rank for i in range(len(piece) - 1)}
    want = []
    for w in words:
        units = [w[0]]
        for x, y in zip(w, w[1:]):
            if x + y in joins:
                units[-1] += y
            else:
                units.append(y)
        want.append(units)
    got, n = model._cut_many(words)
    assert got == [u for units in want for u in units] and n.tolist() == list(map(len, want))
    assert [model._cut(w) for w in words] == want


def test_batches_are_taken_in_slices(monkeypatch):
    monkeypatch.setattr(P, "_PIECE", 100)
    texts = [None, b"", b"x" * 500, b"y" * 60, b"z" * 60, b"", b"w" * 10, None]
    some = [tuple(c.to_pylist() for c in part) for part in P._slices(
        pa.array(range(8)), pa.array(texts, pa.binary()))]
    assert [i for ids, _ in some for i in ids] == list(range(8))
    assert [t for _, part in some for t in part] == texts
    assert [len(ids) for ids, _ in some] == [3, 2, 3]
    assert not list(P._slices(pa.array([], pa.int64()), pa.array([], pa.binary())))
