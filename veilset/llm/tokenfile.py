"""Token-ID files: patched frame-of-reference blocks.

Documents are tokenized, their ids (plus an end id) laid one after another in
ascending ``doc_id`` order and written to binary files.  A file holds, all
little-endian:

* header: magic ``PFR1``, block size, number of documents, ids and blocks, the
  partition and the sequence number that order the files;
* document table: ids, a flag for a NULL id, ids per document;
* block index: where each block starts, in 32-bit words of the block area;
* blocks: the block's minimum is subtracted; the differences are packed at the
  width that holds the chosen percentile of them; those that need more bits
  are stored whole in an exception list (position, difference) behind the
  packed words.  Packing is lane-wise: 8 lanes of 32 values.

Files are written by Spark's text writer (one row per file, a line feed ends
it), so they go to any file system Spark knows, and its committer leaves no
half-written file when an executor is lost.  They are read by Spark's
``binaryFile`` source.

Defined cases: NULL text is the empty text (just the end id); a text longer
than ``ids_per_file`` makes a file of its own; equal ``doc_id`` rows stay, in
the order of their texts; NULL ids come first; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage_path
from .common import ship_code, staged, text_bytes
from .memo import Memo

MAGIC = b"PFR1"
BLOCK = 256          # ids in a block: 8 lanes of 32
_LANES = 8
_HEAD = struct.Struct("<4sIQQQII")


@dataclass(frozen=True)
class Params:
    percentile: float = 0.9          # share of a block that its width must hold
    ids_per_file: int = 4_000_000    # a file is closed at this many ids
    end_id: int = 1
    words_cached: int = 500_000      # words of a generation that a worker remembers


# ---- blocks -----------------------------------------------------------------

def _bit_length(values: np.ndarray) -> np.ndarray:
    """Bits needed by each unsigned 32-bit value."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def _low_bits(width: int) -> np.uint32:
    return np.uint32((1 << width) - 1)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(m, 256) values under 2**width to (m, 8 * width) words."""
    rows = values.reshape(-1, 32, _LANES)
    out = np.zeros((len(rows), width, _LANES), np.uint32)
    for r in range(32 if width else 0):
        word, shift = divmod(r * width, 32)
        out[:, word] |= rows[:, r] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= rows[:, r] >> np.uint32(32 - shift)
    return out.reshape(len(rows), -1)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """Inverse of :func:`pack`."""
    lanes = words.reshape(-1, width, _LANES)
    out = np.zeros((len(words), 32, _LANES), np.uint32)
    for r in range(32 if width else 0):
        word, shift = divmod(r * width, 32)
        part = lanes[:, word] >> np.uint32(shift)
        if shift + width > 32:
            part = part | (lanes[:, word + 1] << np.uint32(32 - shift))
        out[:, r] = part & _low_bits(width)
    return out.reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray, percentile: float) -> tuple[np.ndarray, np.ndarray]:
    """Block starts (one more than blocks) and the words of all blocks."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        return np.zeros(1, np.uint64), np.zeros(0, np.uint32)
    full = np.empty(n_blocks * BLOCK, np.uint32)
    full[:len(ids)] = ids
    full[len(ids):] = ids[-1]
    full = full.reshape(n_blocks, BLOCK)
    low = full.min(axis=1)
    full -= low[:, None]
    at = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    width = _bit_length(np.partition(full, at, axis=1)[:, at])
    # a difference that its block's width cannot hold is an exception
    over = (full >> 1) >> np.maximum(width - 1, 0).astype(np.uint32)[:, None] != 0
    zero = width == 0
    over[zero] = full[zero] != 0
    n_over = over.sum(axis=1)
    size = 2 + _LANES * width + 2 * n_over
    start = np.zeros(n_blocks + 1, np.int64)
    np.cumsum(size, out=start[1:])
    area = np.zeros(int(start[-1]), np.uint32)
    area[start[:-1]] = low
    area[start[:-1] + 1] = (width | (n_over << 8)).astype(np.uint32)
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        if w:
            words = pack(full[of] & _low_bits(int(w)) if w < 32 else full[of], int(w))
            area[(start[of] + 2)[:, None] + np.arange(_LANES * w)] = words
    block, pos = np.nonzero(over)
    if len(block):
        nth = np.arange(len(block)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        to = start[block] + 2 + _LANES * width[block] + 2 * nth
        area[to] = pos
        area[to + 1] = full[block, pos]
    return start.astype(np.uint64), area


def decode_blocks(start: np.ndarray, area: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids that :func:`encode_blocks` got."""
    begin = start[:-1].astype(np.int64)
    out = np.empty((len(begin), BLOCK), np.uint32)
    low, meta = area[begin], area[begin + 1].astype(np.int64)
    width, n_over = meta & 255, meta >> 8
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        out[of] = unpack(area[(begin[of] + 2)[:, None] + np.arange(_LANES * w)], int(w)) \
            if w else 0
    if n_over.any():
        block = np.repeat(np.arange(len(begin)), n_over)
        nth = np.arange(len(block)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        at = begin[block] + 2 + _LANES * width[block] + 2 * nth
        out[block, area[at]] = area[at + 1]
    out += low[:, None]
    return out.reshape(-1)[:n_ids]


# ---- files ------------------------------------------------------------------

def write_file(doc_ids: list, lengths: list[int], ids: np.ndarray, part: int, seq: int,
               percentile: float) -> bytes:
    """The bytes of one file."""
    start, area = encode_blocks(ids, percentile)
    head = _HEAD.pack(MAGIC, BLOCK, len(doc_ids), len(ids), len(start) - 1, part, seq)
    return b"".join([
        head,
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "<u1").tobytes(),
        np.array(lengths, "<u8").tobytes(),
        start.astype("<u8").tobytes(), area.astype("<u4").tobytes()])


def read_file(data: bytes) -> tuple[list, np.ndarray, np.ndarray, int, int]:
    """doc ids, ids per document, all ids, and the two numbers ordering files."""
    magic, size, n_docs, n_ids, n_blocks, part, seq = _HEAD.unpack_from(data)
    if magic != MAGIC or size != BLOCK:
        raise ValueError("not a token file of this format")
    at = _HEAD.size

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, n, at)
        at += found.nbytes
        return found

    doc_ids, no_id, lengths = take("<i8", n_docs), take("<u1", n_docs), take("<u8", n_docs)
    start = take("<u8", n_blocks + 1)
    ids = decode_blocks(start, take("<u4", int(start[-1])), n_ids)
    return ([None if x else d for d, x in zip(doc_ids.tolist(), no_id.tolist(), strict=True)],
            lengths.astype(np.int64), ids, part, seq)


# ---- tokenizing -------------------------------------------------------------

# ASCII marks that end a word as a token group of their own.
_MARKS = b".,;:!?|#$%&*()\"-+=/"
_UNITS_AT_ONCE = 4096
_PIECE = 1 << 20          # bytes of text whose words are held at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")



def _folded(text: bytes) -> bytes:
    """A-Z folded, as the tokenizer does anyway; not where a special token
    might be meant, as its case counts."""
    return text if b"<|" in text else text.lower()


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Ids of texts from the ids of their words.

    The tokenizer drops white space and merges nothing across it, so a text's
    ids are its words' ids one after another.  A word of letters and closing
    marks falls into these two; A-Z are folded by the tokenizer anyway.  What
    is not remembered is encoded in one call for many words, whose tokens are
    told apart by their places in the joined text."""

    def __init__(self, path: str, limit: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.words = Memo(limit)
        self.units = Memo(limit)

    def _encode(self, units: list[bytes]) -> dict[bytes, bytes]:
        found: dict[bytes, bytes] = {}
        plain = [u for u in units if u.isalpha()]        # bytes: a-z, A-Z only
        for u in plain:
            # letters alone are one token group and their own byte characters:
            # straight to the merges
            found[u] = _packed_ids([t.id for t in self.merge(u.lower().decode())])
        units = [u for u in units if u not in found]
        for at in range(0, len(units), _UNITS_AT_ONCE):
            some = units[at:at + _UNITS_AT_ONCE]
            texts = [u.decode() for u in some]
            starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
            got = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(got.ids, "<u4")
            begin = np.array([o[0] for o in got.offsets], np.int64)
            cut = (4 * np.searchsorted(begin, starts)).tolist()
            raw = ids.tobytes()
            found.update((u, raw[i:j]) for u, i, j in zip(some, cut, cut[1:], strict=False))
        return found

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        found, rest = self.words.recall(words)
        split = []
        for w in rest:
            core = w.rstrip(_MARKS)
            if core and len(core) < len(w) and core.decode().isalpha():
                split.append((w, core, w[len(core):]))
            else:
                split.append((w, w, b""))
        units, unknown = self.units.recall({u for _, *us in split for u in us if u})
        fresh = self._encode(unknown)
        self.units.add(fresh)
        units |= fresh
        units[b""] = b""
        found.update((w, units[a] + units[b]) for w, a, b in split)
        self.words.add(found)
        return found

    def of(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian ids of each text."""
        lists = [_folded(t).split() for t in texts]
        out: list = []
        gaps = []
        missing: set[bytes] = set()
        for i, ws in enumerate(lists):
            ps = list(map(self.words.young.get, ws))
            try:
                out.append(b"".join(ps))
            except TypeError:            # holds a None
                out.append(None)
                gaps.append((i, ws, ps))
                missing.update([w for w, p in zip(ws, ps, strict=True) if p is None])
        found = self._learn(missing) if missing else {}
        for i, ws, ps in gaps:
            out[i] = b"".join([found[w] if p is None else p for w, p in zip(ws, ps, strict=True)])
        return out

    def of_long(self, text: bytes) -> bytes:
        """The same for one text, a piece at a time."""
        out, at = [], 0
        while at < len(text):
            m = _SPACE.search(text, at + _PIECE)
            stop = m.start() if m else len(text)
            out += self.of([text[at:stop]])
            at = stop
        return b"".join(out)


_KNOWN: dict[tuple[str, int], WordIds] = {}    # per Python worker


def _word_ids(path: str, limit: int) -> WordIds:
    if (path, limit) not in _KNOWN:
        _KNOWN[path, limit] = WordIds(path, limit)
    return _KNOWN[path, limit]


def _encoded(known: WordIds, batch: pa.RecordBatch) -> Iterator[tuple]:
    """(doc_id, ids) of a batch's rows, some at a time."""
    held: list[tuple] = []
    size = 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        data = text.as_py()
        if len(data) > _PIECE:
            yield from zip([d for d, _ in held], known.of([t for _, t in held]), strict=True)
            yield doc_id, known.of_long(data)
            held, size = [], 0
            continue
        held.append((doc_id, data))
        size += len(data)
        if size > _PIECE:
            yield from zip([d for d, _ in held], known.of([t for _, t in held]), strict=True)
            held, size = [], 0
    yield from zip([d for d, _ in held], known.of([t for _, t in held]), strict=True)


def _write_partition(path: str, p: Params):
    end = np.array([p.end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _word_ids(path, p.words_cached)
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        texts: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, texts, held, seq
            data = write_file(doc_ids, [len(t) // 4 for t in texts],
                              np.frombuffer(b"".join(texts), "<u4"), part, seq, p.percentile)
            doc_ids, texts, held, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

        for batch in batches:
            for doc_id, ids in _encoded(known, batch):
                doc_ids.append(doc_id)
                texts.append(ids + end)
                held += len(texts[-1]) // 4
                if held >= p.ids_per_file:
                    yield close()
        if doc_ids:
            yield close()

    return run


def write(docs: DataFrame, tokenizer_path: str, out_path: str, p: Params = Params()) -> None:
    """Tokenize ``docs`` and write the files below ``out_path``."""
    spark = docs.sparkSession
    ship_code(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select("doc_id", text_bytes("text").alias("text"))
               .repartitionByRange(n, F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    files = ordered.mapInArrow(_write_partition(tokenizer_path, p), "data binary")
    (files.select(F.col("data").cast("string")).write.option("maxRecordsPerFile", 1)
     .option("compression", "none").text(out_path))


_DOC = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("nth", pa.int64()),
                  ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("in_file", pa.int64()),
                  ("ids_crc32", pa.int64())])


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0):
            doc_ids, lengths, ids, part, seq = read_file(data.as_py())
            raw = memoryview(ids.astype("<u4")).cast("B")
            stop = np.cumsum(lengths)
            crc = [zlib.crc32(raw[4 * (b - n):4 * b])
                   for b, n in zip(stop.tolist(), lengths.tolist(), strict=True)]
            n = len(doc_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part), pa.int64()), pa.array(np.full(n, seq), pa.int64()),
                 pa.array(np.arange(n), pa.int64()), pa.array(doc_ids, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(stop - lengths, pa.int64()),
                 pa.array(crc, pa.int64())], schema=_DOC)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    ship_code(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    docs = staged(files.select("content").mapInArrow(
        _read_documents, "part long, seq long, nth long, doc_id long, n_tokens long, "
                         "in_file long, ids_crc32 long"), "token-docs")
    # ids before each file: a running sum over one row per file
    totals = docs.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", "seq", (F.sum("n").over(
        Window.orderBy("part", "seq")) - F.col("n")).alias("before"))
    return docs.join(before, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_path: str, p: Params = Params()) -> DataFrame:
    """Write the files of ``docs`` to the shared folder and read them back."""
    path = stage_path(docs.sparkSession, "token-files")
    write(docs, tokenizer_path, path, p)
    return read(docs.sparkSession, path)
