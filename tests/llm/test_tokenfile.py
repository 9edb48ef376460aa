"""Token files: block round trips, and whole tables against the tokenizer."""
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from veilset.llm import tokenfile as tf

from .helpers import MESSY, SF1, empty, messy, read

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(0, 40), st.just(7)),
                max_size=900), st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, np.uint32)
    start, area = tf.encode_blocks(ids, percentile)
    assert (tf.decode_blocks(start, area, len(ids)) == ids).all()


def test_outliers_are_exceptions_and_width_is_the_percentile():
    ids = np.arange(256, dtype=np.uint32) % 16 + 1000
    ids[5] = 4_000_000_000
    start, area = tf.encode_blocks(ids, 0.9)
    assert area[0] == 1000 and area[1] & 255 == 4 and area[1] >> 8 == 1
    assert int(start[-1]) == 2 + 8 * 4 + 2


def test_file_round_trip():
    ids = np.arange(1000, dtype=np.uint32) * 37 % 49408
    data = tf.write_file([3, None, 9], [400, 0, 600], ids, 5, 2, 0.9)
    doc_ids, lengths, back, part, seq = tf.read_file(data)
    assert (doc_ids, lengths.tolist(), part, seq) == ([3, None, 9], [400, 0, 600], 5, 2)
    assert (back == ids).all()
    with pytest.raises(ValueError):
        tf.read_file(b"XXXX" + data[4:])


def brute(docs):
    tok = Tokenizer.from_file(PATH)
    out, at = [], 0
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, (x[1] or "").encode())):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    got = tf.round_trip(docs, PATH).collect()
    assert sorted(map(tuple, got), key=repr) == brute(
        [(d["doc_id"], d["text"]) for d in read(SF1, "documents")])


@pytest.mark.parametrize("per_file", [1, 50, 4_000_000])
def test_messy_rows_and_small_files(spark, per_file):
    got = tf.round_trip(messy(spark), PATH,
                        tf.Params(ids_per_file=per_file, words_cached=40)).collect()
    assert sorted(map(tuple, got), key=repr) == brute([(m[0], m[1]) for m in MESSY])


def test_empty_table(spark):
    assert tf.round_trip(empty(spark), PATH).collect() == []
