"""Alignment of two tokenizers' tokens over the same bytes.

A is a byte-level BPE of the tokenizers library, B a piece model of the
sentencepiece library; A reads a space and the text, B the text, before which
it puts a space itself.  Where tokens end is taken from the libraries' spans:

* coarse cuts: A's character offsets and B's proto spans (the library's
  ``immutable_proto``, which its installed release calls ``proto``); an end
  counts where the next token does not start inside it;
* refined cuts: tokens that share a character (parts of a multibyte character,
  byte-fallback pieces) have no span of their own; between two coarse cuts
  their ends follow from the lengths of their decoded bytes.

Ends that both have cut a text into groups; an end's two tokens are a link.

Both tokenizers split a text before a run of spaces (A's word pattern takes one
leading space, no piece of B has a space behind another character, which is
looked up when a model is loaded), so a text is the sequence of its units, a
run of spaces and what follows, and what a worker has learned of a unit (its
groups and links) it remembers, in a memory of bounded size.

On Spark: one pass over the texts writes per document the numbers of its own
and its links as (number of the id pair within the batch, times), and per batch
its distinct id pairs with their times, already added up.  Counts are sums over
these; the highest count per B id is one row per id of a vocabulary, so it is
broadcast; each batch gets its own pairs' counts back.  No id pair is a hot key:
it has one row per batch, however often it occurs.

Defined cases: a NULL or empty text, and one whose joined bytes under A or B
differ from a space and the text (one that holds U+2581), has no tokens: zeros
and '' for the digest; texts of any length are read whole, a stretch at a time;
a NULL id is carried like any other; repeated rows count and come back as often
as they occur; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code, staged, text_bytes

_STRETCH = 1 << 20        # characters of a text handled at a time
_LEARN = 1 << 12          # characters of unknown units encoded in one call
_UNIT = 64                # characters of a remembered unit, on average, at most
# a cut: before a run of spaces behind other than white space, and before the one
# space between other white space and other than white space
_CUT = re.compile(r"(?<=\S)(?= )|(?<=[^\S ])(?= \S)")
_ODD = re.compile(r"\s \s|  ")


@dataclass(frozen=True)
class Params:
    batch_chars: int = 16_000_000     # characters of text that share a batch
    remembered: int = 400_000         # units that a worker remembers


def _byte_values() -> dict[str, int]:
    """Byte-level BPE: the character that stands for each byte (fixed rule: the
    printable ones for themselves, the others from U+0100 on in order)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class _Numbers:
    """A growing array."""

    def __init__(self, kind: type) -> None:
        self.n, self.room = 0, np.zeros(1024, kind)

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.room):
            self.room = np.concatenate([self.room[:self.n], np.zeros(
                self.n + len(values) + 1024, self.room.dtype)])
        self.room[self.n:self.n + len(values)] = values
        self.n += len(values)

    def all(self) -> np.ndarray:
        return self.room[:self.n]


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... (n of them) of every pair, in a row."""
    stop = np.cumsum(n)
    return np.repeat(first - stop + n, n) + np.arange(int(stop[-1]) if len(stop) else 0)


class Aligner:
    """Both tokenizers and what is known of units."""

    def __init__(self, a_path: str, b_path: str, p: Params) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer, processors
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.post_processor = processors.ByteLevel(trim_offsets=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        values = _byte_values()
        n_a = self.a.get_vocab_size()
        special = self.a.get_added_tokens_decoder()
        self.a_bytes = [b"" if i in special else
                        bytes(values[c] for c in self.a.id_to_token(i)) for i in range(n_a)]
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if re.search("[^▁]▁", piece):
                raise ValueError(f"piece {i} has a space behind another character")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace("▁", " ").encode())
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        # decimal ids with what follows them: a group reads a1,a2|b1;
        self.text = [f"{i}{end}" for end in ",|" for i in range(len(self.a_bytes))]
        self.b_from = len(self.text)
        self.text += [f"{i}{end}" for end in (",", ";", ";\n")
                      for i in range(len(self.b_bytes))]
        self.remembered = p.remembered
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}          # of a unit, -1 if its bytes differ
        self.chars = 0
        # by number: groups, numbers of tokens (B's in the upper half), links
        self.groups: list[str] = []
        self.tokens, self.first, self.n = (_Numbers(np.int64) for _ in range(3))
        self.links = _Numbers(np.uint64)

    # ---- ends of tokens ----

    @staticmethod
    def _refined(coarse: np.ndarray, sure: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Byte ends: the coarse ones where sure, between them by decoded lengths."""
        exact = np.cumsum(lengths)
        last = np.maximum.accumulate(np.where(sure, np.arange(len(sure)), -1))
        base = np.where(last >= 0, coarse[last] - exact[last], 0)
        return exact + base

    def _a_ends(self, text: str, data: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        found = self.a.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        if b"".join(map(self.a_bytes.__getitem__, found.ids)) != data:
            return None
        spans = np.fromiter(chain.from_iterable(found.offsets), np.int64,
                            2 * len(ids)).reshape(-1, 2)
        if len(data) == len(text):
            byte_at = np.arange(len(text) + 1)
        else:
            raw = np.frombuffer(data, np.uint8)
            byte_at = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))
        sure = np.append(spans[1:, 0] >= spans[:-1, 1], True)
        return ids, self._refined(byte_at[spans[:, 1]], sure, self.a_len[ids])

    def _b_ends(self, text: str, data: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        ids = [p.id for p in pieces]
        if b"".join(map(self.b_bytes.__getitem__, ids)) != data:
            return None
        ends = np.array([p.end for p in pieces], np.int64) + 1     # the space before
        # byte pieces but the last of a character end where they start
        sure = np.diff(ends, prepend=0) > 0
        if len(ids):
            sure[0] = sure[0] and len(self.b_bytes[ids[0]]) == ends[0]
        ids = np.array(ids, np.int64)
        return ids, self._refined(ends, sure, self.b_len[ids])

    def _aligned(self, units: list[str]) -> tuple | None:
        """Groups (a text per unit), numbers of tokens (B's in the upper half), links
        and their number per unit; None if bytes differ.  The units follow each
        other in one text."""
        text = "".join(units)
        data = text.encode()
        a, b = self._a_ends(text, data), self._b_ends(text, data)
        if a is None or b is None:
            return None
        (a_ids, a_ends), (b_ids, b_ends) = a, b
        ends, at_a, at_b = np.intersect1d(a_ends, b_ends, assume_unique=True,
                                          return_indices=True)
        links = ((b_ids[at_b] << 32) | a_ids[at_a]).astype(np.uint64)
        stops = np.cumsum(np.fromiter(map(len, units) if len(data) == len(text) else
                                      (len(u.encode()) for u in units), np.int64, len(units)))
        cut_a = np.searchsorted(a_ends, stops, "right")
        cut_b = np.searchsorted(b_ends, stops, "right")
        cut = np.searchsorted(ends, stops, "right")
        if not (np.array_equal(a_ends[cut_a - 1], stops)
                and np.array_equal(b_ends[cut_b - 1], stops)):
            raise ValueError("a token crosses two units")
        # tokens in the order of groups, A's before B's, each with what follows it
        last_a, last_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        last_a[at_a], last_b[at_b], last_b[cut_b - 1] = 1, 1, 2
        shown = np.concatenate([a_ids + last_a * len(self.a_bytes),
                                self.b_from + b_ids + last_b * len(self.b_bytes)])
        group = np.concatenate([2 * np.searchsorted(ends, a_ends),
                                2 * np.searchsorted(ends, b_ends) + 1])
        order = np.argsort(group, kind="stable")
        groups = "".join(map(self.text.__getitem__, shown[order].tolist())).split("\n")[:-1]
        return (groups, np.diff(cut_a, prepend=0) | np.diff(cut_b, prepend=0) << 32,
                links, np.diff(cut, prepend=0))

    # ---- units ----

    def _keep(self, units: list[str], found: tuple | None, skip: int = 0) -> None:
        """Remember what ``_aligned`` found of the units behind the first ``skip``."""
        if found is None:
            self.number.update((u, -1) for u in units)
            return
        groups, tokens, links, n = found
        at = len(self.groups)
        self.number.update(zip(units, range(at, at + len(units)), strict=True))
        before = int(n[:skip].sum())
        self.first.add(self.links.n + np.cumsum(n[skip:]) - n[skip:])
        self.links.add(links[before:])
        self.n.add(n[skip:])
        self.tokens.add(tokens[skip:])
        self.groups += groups[skip:]

    def _alone(self, unit: str) -> None:
        self._keep([unit], self._aligned([" a", unit]), 1)

    def _learn(self, units: set[str]) -> None:
        some: list[str] = []
        size = 0

        def encode() -> None:
            nonlocal some, size
            if some:
                # the first one stands in for a text's start
                found = self._aligned([" a", *some])
                if found is None:
                    for u in some:
                        self._alone(u)
                else:
                    self._keep(some, found, 1)
            some, size = [], 0

        for u in units:
            self.chars += len(u)
            # white space at an end could join the next unit's
            if u[-1].isspace() or "▁" in u:
                self._alone(u)
                continue
            some.append(u)
            size += len(u)
            if size > _LEARN:
                encode()
        encode()

    @staticmethod
    def units_of(text: str) -> list[str]:
        """The units of a text that starts with a space."""
        if not _ODD.search(text):
            return [" " + w for w in text[1:].split(" ")]
        return [u for u in _CUT.split(text) if u]

    @staticmethod
    def stretches(text: str) -> Iterator[str]:
        """A space and the text, in stretches that end at a cut."""
        text, at = " " + text, 0
        while at < len(text):
            m = _CUT.search(text, at + _STRETCH)
            stop = m.start() if m else len(text)
            yield text[at:stop]
            at = stop

    def _found(self, lists: list[list[str]]) -> list[tuple | None]:
        """Per list of units: groups, links, numbers of tokens; None if bytes differ."""
        if len(self.number) > self.remembered or self.chars > _UNIT * self.remembered:
            self._forget()
        units = list(chain.from_iterable(lists))
        numbers = list(map(self.number.get, units))
        missing = {u for u, k in zip(units, numbers, strict=True) if k is None}
        if missing:
            self._learn(missing)
            numbers = list(map(self.number.__getitem__, units))
        at = np.array(numbers, np.int64)
        ends = np.cumsum([0, *map(len, lists)])
        good = np.minimum.reduceat(at, ends[:-1]) >= 0
        if not good.all():
            at = np.maximum(at, 0)
        if not self.groups:
            return [None] * len(lists)
        tokens = np.add.reduceat(self.tokens.all()[at], ends[:-1]).tolist()
        n = self.n.all()[at]
        links = self.links.all()[_ranges(self.first.all()[at], n)]
        cut = np.concatenate([[0], np.cumsum(n)])[ends].tolist()
        ends = ends.tolist()
        return [("".join(map(self.groups.__getitem__, numbers[ends[i]:ends[i + 1]])),
                 links[cut[i]:cut[i + 1]], tokens[i]) if good[i] else None
                for i in range(len(lists))]

    def of(self, texts: list[str]) -> list[list[tuple] | None]:
        """Per text, per stretch: groups, links, numbers of tokens.  The texts, none
        of them empty, are one stretch each."""
        found = self._found([self.units_of(" " + t) for t in texts]) if texts else []
        return [f and [f] for f in found]

    def of_long(self, text: str) -> list[tuple] | None:
        out = []
        for some in self.stretches(text):
            found, = self._found([self.units_of(some)])
            if found is None:
                return None
            out.append(found)
        return out


_KNOWN: dict[tuple, Aligner] = {}     # per Python worker


def _aligner(a_path: str, b_path: str, p: Params) -> Aligner:
    key = (a_path, b_path, p)
    if key not in _KNOWN:
        _KNOWN[key] = Aligner(a_path, b_path, p)
    return _KNOWN[key]


# ---- documents ------------------------------------------------------------------

_ROW = pa.schema([
    ("batch", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
    ("links", pa.binary()),           # of a document: number of pair and times, in turn
    ("pair", pa.int32()), ("b", pa.int32()), ("a", pa.int32()), ("times", pa.int64())])
_ROW_DDL = ("batch long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
            "links binary, pair int, b int, a int, times long")


class _Batch:
    """Documents of a batch, and the id pairs of their links."""

    def __init__(self) -> None:
        self.docs: list[tuple] = []
        self.keys: list[np.ndarray] = []      # per document: distinct pairs, times
        self.times: list[np.ndarray] = []

    def add(self, doc_id, parts: list | None) -> None:
        digest, n_a, n_b, raw = hashlib.sha256(), 0, 0, []
        for groups, links, tokens in parts or ():
            digest.update(f";{groups[:-1]}".encode() if raw else groups[:-1].encode())
            raw.append(links)
            n_a, n_b = n_a + (tokens & 0xFFFFFFFF), n_b + (tokens >> 32)
        n_groups = sum(map(len, raw))
        pairs, times = np.unique(np.concatenate([*raw, np.zeros(0, np.uint64)]),
                                 return_counts=True)
        self.docs.append((doc_id, n_a, n_b, n_groups, digest.hexdigest() if raw else ""))
        self.keys.append(pairs)
        self.times.append(times)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        sizes = list(map(len, self.keys))
        flat = np.concatenate(self.times)
        pairs, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        both = np.column_stack([at.astype("<u4"), flat.astype("<u4")])
        ends = np.cumsum([0, *sizes]).tolist()
        links = [both[i:j].tobytes() for i, j in zip(ends, ends[1:], strict=False)]
        ids, n_a, n_b, n_groups, digest = zip(*self.docs, strict=True)
        n = len(self.docs)
        yield self._filled(n, batch=[number] * n, doc_id=ids, n_a=n_a, n_b=n_b,
                           n_groups=n_groups, groups_sha256=digest, links=links)
        total = np.bincount(at, weights=flat, minlength=len(pairs)).astype(np.int64)
        n = len(pairs)
        yield self._filled(n, batch=np.full(n, number), pair=np.arange(n, dtype=np.int32),
                           b=(pairs >> np.uint64(32)).astype(np.int32),
                           a=(pairs & np.uint64(0xFFFFFFFF)).astype(np.int32), times=total)

    @staticmethod
    def _filled(n: int, **cols) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type)
             for f in _ROW], schema=_ROW)


def _encode_partition(a_path: str, b_path: str, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _aligner(a_path, b_path, p)
        gc.disable()             # what is remembered holds no cycles, and is large
        try:
            yield from encoded(known, batches)
        finally:
            gc.enable()

    def encoded(known: Aligner, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        now, size = _Batch(), 0
        held: list[tuple] = []
        chars = 0

        def deal() -> None:
            nonlocal held, chars
            for (doc_id, _), parts in zip(held, known.of([t for _, t in held]), strict=True):
                now.add(doc_id, parts)
            held, chars = [], 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py().decode("utf-8", "replace")
                if not text:
                    now.add(doc_id, None)
                elif len(text) > _STRETCH:
                    now.add(doc_id, known.of_long(text))
                else:
                    held.append((doc_id, text))
                    chars += len(text)
                size += len(text) + 1
                if chars > _STRETCH or size > p.batch_chars:
                    deal()
                if size > p.batch_chars:
                    yield from now.rows(number)
                    now, size, number = _Batch(), 0, number + 1
        deal()
        if now.docs:
            yield from now.rows(number)

    return run


_OUT_DDL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
            "count_sum long, groups_sha256 string")
_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
    ("groups_sha256", pa.string())])


def _counted(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one batch, their links counted by the batch's pairs."""
    at = pairs["pair"].to_numpy()
    count = np.zeros(len(at) + 1, np.int64)
    best = np.zeros(len(at) + 1, np.int64)
    count[at], best[at] = pairs["count"].to_numpy(), pairs["best"].to_numpy()
    cols: list[list] = [[], [], []]
    for links in docs["links"]:
        both = np.frombuffer(links.as_py(), "<u4").reshape(-1, 2).astype(np.int64)
        which, times = both[:, 0], both[:, 1]
        for col, x in zip(cols, (times.sum(), (best[which] * times).sum(),
                                 (count[which] * times).sum()), strict=True):
            col.append(int(x))
    return pa.Table.from_arrays(
        [*(docs[c].combine_chunks() for c in ("doc_id", "n_a", "n_b", "n_groups")),
         *(pa.array(c, pa.int64()) for c in cols), docs["groups_sha256"].combine_chunks()],
        schema=_OUT)


def link_counts(rows: DataFrame) -> DataFrame:
    """b, a, count, best (1 where the count is its B id's highest): every id pair
    linked anywhere, from the batches' sums."""
    counts = rows.where("pair IS NOT NULL").groupBy("b", "a").agg(F.sum("times").alias("count"))
    # at most a row per id of B's vocabulary: broadcast
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(F.broadcast(highest), "b").select(
        "b", "a", "count", (F.col("count") == F.col("highest")).cast("int").alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, p: Params = Params()) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: a row
    per row of ``docs``."""
    ship_code(docs.sparkSession)
    given = docs.select("doc_id", text_bytes("text").alias("text"))
    rows = staged(given.mapInArrow(_encode_partition(a_path, b_path, p), _ROW_DDL), "alignment")
    pairs = rows.where("pair IS NOT NULL").select(F.col("batch").alias("of"), "pair", "b", "a")
    pairs = pairs.join(link_counts(rows), ["b", "a"]).select("of", "pair", "count", "best")
    found = rows.where("pair IS NULL").select(
        "batch", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links")
    return found.groupBy("batch").cogroup(pairs.groupBy("of")).applyInArrow(
        _counted, _OUT_DDL)
