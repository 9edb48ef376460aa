"""Quality rules: compression bands.

A text is judged by how well zstandard compresses it.  Natural language sits
in a narrow band of compression ratios that moves with the length of the text
(a short text pays the frame overhead, a long one gains from its history).
Ratios above the band mean repetition, ratios below it mean noise (keys,
encoded blobs, random characters).  Two tests, each with the limits of its
length class:

* the whole document, by its length in bytes;
* fixed chunks of ``chunk_bytes``: the text fails if more than
  ``max_bad_chunks`` of its chunks lie outside the chunk band, so that one
  repeated or encoded passage inside a long text does not reject it, but a
  text that consists of such passages does go.

Defined cases: a NULL or empty text has no words and fails the base rules
(fewer than ten words); a text of any length is read whole; repeated rows are
judged one by one; an empty table gives an empty table; extra columns are
ignored by :func:`score` and carried by :func:`keep`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_udf, text_bytes, unpack_row, whole_row

SYMBOLS = "#*$%&|<>"

# Limits (fixed values): length of the text in bytes from, lowest and highest
# ratio of raw to compressed size.
WHOLE_BANDS = (
    (0, 0.45, 2.0),
    (128, 0.90, 2.3),
    (256, 1.10, 2.8),
    (512, 1.20, 3.3),
    (1024, 1.30, 3.8),
    (2048, 1.38, 4.2),
    (4096, 1.42, 4.6),
    (8192, 1.45, 5.0),
)


@dataclass(frozen=True)
class Bands:
    """Parameters of the compression test."""

    whole: tuple = WHOLE_BANDS
    chunk_bytes: int = 2048
    chunk_low: float = 1.25
    chunk_high: float = 4.2
    max_bad_chunks: float = 0.25
    level: int = 3


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Word positions covered by a ``width``-word window that occurs twice or
    more.  Windows are ranked by doubling (pairs of ranks to new ranks), which
    is exact and holds a few integers per word, whatever the words."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    first = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    rank, span = first, 1
    while span < width:
        step = min(span, width - span)
        # two windows of the present span, overlapping if need be, make the next
        m = len(words) - (span + step) + 1
        pair = rank[:m] * (int(rank.max()) + 1) + rank[step:step + m]
        rank = np.unique(pair, return_inverse=True)[1].reshape(-1)
        span += step
    again = np.bincount(rank)[rank] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(again), 1)
    np.add.at(edge, np.flatnonzero(again) + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in them, symbols, repeated lines, repeated words."""
    words = data.split()
    # code points: bytes that do not continue a character
    chars = len("".join(w.decode("utf-8", "replace") for w in words)) if not data.isascii() \
        else sum(map(len, words))
    symbols = sum(data.count(s.encode()) for s in SYMBOLS)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def _outside(size: int, packed: int, low: float, high: float) -> bool:
    return not low * packed <= size <= high * packed


def in_band(data: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[bool, float, float]:
    """Verdict, ratio of the whole text, share of chunks outside their band."""
    if not data:
        return False, 0.0, 0.0
    packed = len(packer.compress(data))
    _, low, high = [b for b in bands.whole if b[0] <= len(data)][-1]
    step = bands.chunk_bytes
    # a tail of under half a chunk is joined to the chunk before it
    ends = [*range(step, len(data) - step // 2 + 1, step), len(data)]
    bad = 0
    if len(ends) > 1:
        for a, b in zip([0, *ends], ends, strict=False):
            bad += _outside(b - a, len(packer.compress(data[a:b])), bands.chunk_low,
                            bands.chunk_high)
    share = bad / len(ends)
    ok = not _outside(len(data), packed, low, high) and share <= bands.max_bad_chunks
    return ok, len(data) / packed, share


_SCHEMA = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()),
                     ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                     ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                     ("kept", pa.bool_()), ("ratio", pa.float64()),
                     ("bad_chunk_share", pa.float64())])
_DDL = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, ratio double, bad_chunk_share double")


def judge(bands: Bands = Bands()):
    """UDF: text bytes to the struct of counts and verdicts."""

    def one(data: bytes) -> tuple:
        packer = zstandard.ZstdCompressor(level=bands.level, write_checksum=False)
        counts = base_counts(data)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        ok, ratio, share = in_band(data, bands, packer)
        return (*counts, failed, ok and not failed, ratio, share)

    return bytes_udf(one, f"struct<{_DDL.replace(' ', ':').replace(',:', ',')}>", _SCHEMA)


def score(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """doc_id, the counts, ``base_failed``, ``kept``, ``ratio`` and
    ``bad_chunk_share``: one row per row of ``docs``."""
    out = docs.select(F.col("doc_id"), judge(bands)(text_bytes("text")).alias("q"))
    return out.select("doc_id", "q.*")


def keep(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    out = docs.select(whole_row(docs), judge(bands)(text_bytes("text")).alias("q"))
    return unpack_row(out.where("q.kept"))
