"""SentencePiece encoding and decoding with seeded merge-dropout.

A BPE piece model segments a text by an agenda: adjacent symbols whose union
is a piece are candidates, the best piece is merged first, and merging makes
new candidates.  With dropout every candidate that comes up is skipped with a
given probability, so the same word falls into different pieces here and
there, all made by the model's own merges.  Which candidate is skipped is a
keyed hash of (seed, occurrence, characters, place), never a random draw: a task
that runs again gives the same ids.  Each occurrence has a key of its own, a
64-bit hash of (seed, document, showing, position), so no two share their skips.

Exactness: no piece holds white space behind another character, so a text is
cut before each run of spaces without changing any merge; likewise between two
characters that no piece holds side by side.  A worker remembers, in a memory of
bounded size, only what does not depend on keys: a unit's symbols, its ids without
skips and the candidates that come up on the way to them.  Keys are tried on those
for all occurrences at once; an occurrence that skips one of them goes through the
agenda itself, many of one length together: a row of a matrix each, one merge a
round, candidates kept by their cost unless the key skips them.  Without dropout
the ids equal the sentencepiece library's, but for the character U+2581, which the
library cannot tell from a space; here it is written in byte pieces, so every text
decodes to itself.

Defined cases: NULL and empty text have no ids and decode to the empty text;
texts of any length are read whole; a NULL ``doc_id`` is a key like any other;
rows repeated under one id get equal ids, unless :func:`showings` has numbered
them; an empty table gives no rows; extra columns are ignored, one that is called
``showing`` too.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_code, text_bytes

_MASK = (1 << 64) - 1
_GOLD, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93      # odd constants (fixed values)
_SPACES = re.compile(" +[^ ]*")
_PIECE = 1 << 20          # characters of text handled at a time
_LONG = 32                # units of more characters are segmented each by itself
_ROWS = 8192              # units whose agendas run together
_NONE = 1 << 30           # the rank of a candidate that never comes up
SHOWING = "__showing"     # column of a row's number among equal ones


@dataclass(frozen=True)
class Params:
    dropout: float = 0.1
    seed: int = 7
    variants: int = 4             # a power of two; keeps the keys of seeds apart
    remembered: int = 700_000     # words and units that a worker remembers


class _Numbers:
    """A growing array."""

    def __init__(self, kind: type) -> None:
        self.n, self.room = 0, np.zeros(1024, kind)

    def add(self, values) -> None:
        if self.n + len(values) > len(self.room):
            self.room = np.concatenate([self.room, np.zeros(
                len(self.room) + len(values), self.room.dtype)])
        self.room[self.n:self.n + len(values)] = values
        self.n += len(values)

    def all(self) -> np.ndarray:
        return self.room[:self.n]


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... (n of them) of every pair, in a row."""
    stop = np.cumsum(n)
    return np.repeat(first - stop + n, n) + np.arange(int(stop[-1]) if len(stop) else 0)


def _codes(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


# XXH64's primes (fixed values)
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
    0x27D4EB2F165667C5))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def short_xxh64(lanes: np.ndarray, size: int, seeds: np.ndarray) -> np.ndarray:
    """XXH64 of strings of ``size`` bytes (under 32), a row of 8-byte lanes each,
    padded with zeros, under a seed each."""
    h = seeds + _P5 + np.uint64(size)
    for i in range(size // 8):
        h = _turned(h ^ _turned(lanes[:, i] * _P2, 31) * _P1, 27) * _P1 + _P4
    rest = lanes[:, size // 8] if size % 8 else None
    left = size % 8
    if left >= 4:
        h = _turned(h ^ (rest & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
        rest, left = rest >> np.uint64(32), left - 4
    for i in range(left):
        h = _turned(h ^ (rest >> np.uint64(8 * i) & np.uint64(255)) * _P5, 11) * _P1
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    return h ^ h >> np.uint64(32)


class _Symbols:
    """Pieces and characters as numbers, and what two neighbours merge into.

    A piece has its id; a character that is no piece has a number behind them,
    and stands for its bytes' ids."""

    _BITS = 20

    def __init__(self, rank: dict[str, tuple[float, int]], n_pieces: int,
                 byte_id: list[int]) -> None:
        self.n_pieces, self.byte_id = n_pieces, byte_id
        self.char = {x: r[1] for x, r in rank.items() if len(x) == 1}
        self.of_code = np.full(0x110000, -1, np.int32)       # the same by code point
        self.bytes_at, self.bytes_n, self.bytes_ids = _Numbers(np.int64), _Numbers(np.int64), \
            _Numbers(np.uint32)
        for piece in rank:
            for c in piece:
                self._number(c)
        for c, i in self.char.items():
            self.of_code[ord(c)] = i
        symbols = {**{x: r[1] for x, r in rank.items()}, **self.char}
        costs = sorted({r[0] for r in rank.values()})
        order = {c: i for i, c in enumerate(costs)}
        self.rank = np.full(n_pieces, _NONE, np.int32)
        pairs: dict[int, int] = {}
        for piece, (cost, i) in rank.items():
            self.rank[i] = order[cost]
            for k in range(1, len(piece)):
                a, b = symbols.get(piece[:k]), symbols.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a << 21 | b] = i
        # open addressing: a key's place, or the next free one behind it
        self.keys = np.full((1 << self._BITS) + 64, -1, np.int64)
        self.made = np.full(len(self.keys), -1, np.int32)
        for key, i in pairs.items():
            at = (key * _GOLD & _MASK) >> 64 - self._BITS
            while self.keys[at] != -1:
                at += 1
            self.keys[at], self.made[at] = key, i

    def _number(self, c: str) -> int:
        found = self.char.get(c)
        if found is None:
            found = self.char[c] = self.n_pieces + self.bytes_at.n
            ids = [self.byte_id[b] for b in c.encode("utf-8", "surrogatepass")]
            self.bytes_at.add([self.bytes_ids.n])
            self.bytes_n.add([len(ids)])
            self.bytes_ids.add(ids)
            self.of_code[ord(c)] = found
        return found

    def of(self, text: str) -> np.ndarray:
        """The symbols of a text's characters."""
        codes = _codes(text)
        found = self.of_code[codes]
        if len(found) and found.min() < 0:
            for c in np.unique(codes[found < 0]).tolist():
                self._number(chr(c))
            found = self.of_code[codes]
        return found

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two neighbours make, -1 if none."""
        key = a.astype(np.int64) << 21 | b
        at = ((key.astype(np.uint64) * np.uint64(_GOLD)) >> np.uint64(64 - self._BITS)
              ).astype(np.int64)
        there = self.keys[at]
        out = np.where(there == key, self.made[at], -1)
        left = np.nonzero((there != key) & (there != -1))
        while len(left[0]):
            at[left] += 1
            there = self.keys[at[left]]
            out[left] = np.where(there == key[left], self.made[at[left]], -1)
            more = (there != key[left]) & (there != -1)
            left = tuple(x[more] for x in left)
        return out

    def ids(self, symbols: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of symbols (``n`` of each), and how many of each run."""
        if not len(symbols) or symbols.max() < self.n_pieces:
            return symbols.astype(np.uint32), n
        other = symbols >= self.n_pieces
        which = symbols[other] - self.n_pieces
        size = np.ones(len(symbols), np.int64)
        size[other] = self.bytes_n.all()[which]
        at = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.uint32)
        out[at[~other]] = symbols[~other]
        out[_ranges(at[other], size[other])] = self.bytes_ids.all()[
            _ranges(self.bytes_at.all()[which], size[other])]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
        return out, np.diff(ends)


def _skipped(keys: np.ndarray, code: np.ndarray, threshold: int) -> np.ndarray:
    """Which candidates the keys skip."""
    x = (keys ^ code) * np.uint64(_MIX)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_MIX)
    return (x >> np.uint64(31)) & np.uint64(0xFFFFFFFF) < np.uint64(threshold)


def _code(i: np.ndarray, j: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The candidate that joins [i, j) and [j, k), as the keyed hash takes it."""
    return (i * 1_000_003 + j * 8191 + k).astype(np.uint64) * np.uint64(_GOLD)


def _agendas(symbols: _Symbols, rows: np.ndarray, keys: np.ndarray | None,
             threshold: int) -> tuple[list, list]:
    """The agendas of units of one length, a row of symbols each, run together.

    In a round every row merges its cheapest candidate (the leftmost of equals),
    so all rows still running have as many symbols; a row without a candidate is
    done.  Returns (row numbers, their symbols) per round, and without keys (row
    numbers, codes of the candidates merged) per round."""
    at = np.arange(len(rows))
    width = rows.shape[1]
    pos = np.broadcast_to(np.arange(width + 1, dtype=np.int32), (len(rows), width + 1))

    def candidates(a, b, i, j, k, which) -> tuple[np.ndarray, np.ndarray]:
        made = symbols.merge(a, b)
        rank = np.where(made >= 0, symbols.rank[made], _NONE)
        if keys is not None:
            key = keys[which] if a.ndim == 1 else keys[which][:, None]
            rank[_skipped(key, _code(i, j, k), threshold)] = _NONE
        return made, rank

    done, merged = [], []
    made, rank = candidates(rows[:, :-1], rows[:, 1:], pos[:, :-2], pos[:, 1:-1], pos[:, 2:], at)
    while len(at):
        if width == 1:
            done.append((at, rows))
            break
        here = np.arange(len(at))
        best = rank.argmin(axis=1)
        going = rank[here, best] < _NONE
        if not going.all():
            done.append((at[~going], rows[~going]))
            at, rows, pos, made, rank, best = (
                x[going] for x in (at, rows, pos, made, rank, best))
            if not len(at):
                break
            here = np.arange(len(at))
        new = made[here, best]
        if keys is None:
            merged.append((at, _code(pos[here, best], pos[here, best + 1], pos[here, best + 2])))
        # the symbol right of the merged one goes, and the candidate between them
        col, c = np.arange(width), best[:, None]
        rows = np.take_along_axis(rows, col[:-1] + (col[:-1] > c), 1)
        rows[here, best] = new
        pos = np.take_along_axis(pos, col + (col > c), 1)
        width -= 1
        if width == 1:
            continue
        col = col[:width - 1]
        made = np.take_along_axis(made, col + (col >= c), 1)
        rank = np.take_along_axis(rank, col + (col >= c), 1)
        for shift in (-1, 0):              # the candidates left and right of it
            some = np.flatnonzero((best > 0) if shift else (best < width - 1))
            if len(some):
                x = best[some] + shift
                made[some, x], rank[some, x] = candidates(
                    rows[some, x], rows[some, x + 1], pos[some, x], pos[some, x + 1],
                    pos[some, x + 2], at[some])
    return done, merged


def _in_rows(n: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]], kind: type,
             ) -> np.ndarray:
    """The parts' values row after row (``n`` of each row)."""
    out = np.empty(int(n.sum()), kind)
    first = np.cumsum(n) - n
    for at, values in parts:
        out[first[at][:, None] + np.arange(values.shape[1])] = values
    return out


def _occurrences(n: int, base: int) -> np.ndarray:
    """Keys of the units of a text, by their position."""
    x = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLD)) ^ np.uint64(base)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX)
    return x ^ (x >> np.uint64(29))


class Model:
    """The pieces of a model file, and their segmentation."""

    def __init__(self, path: str, p: Params = Params()) -> None:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if p.variants & (p.variants - 1) or p.variants < 1:
            raise ValueError("variants must be a power of two")
        self.p = p
        self.rank: dict[str, tuple[float, int]] = {}      # piece to (cost, id)
        self.bytes_of: list[bytes] = []
        self.byte_id = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes_of.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                piece = piece.replace("\u2581", " ")
                self.rank[piece] = (-sp.get_score(i), i)
                self.bytes_of.append(piece.encode())
        # pairs of characters that a piece holds side by side, as numbers; -1 is none
        self.beside = np.array([-1, *sorted({ord(x) << 21 | ord(y) for piece in self.rank
                                             for x, y in zip(piece, piece[1:])})], np.int64)
        self.symbols = _Symbols(self.rank, len(self.bytes_of), self.byte_id)
        self.threshold = int(p.dropout * (1 << 32))
        self._forget()

    # ---- one unit ----

    def _key(self, unit: str, variant: int) -> int:
        return xxhash.xxh64_intdigest(unit, self.p.seed * self.p.variants + variant & _MASK)

    def merged(self, unit: str, variant: int) -> list[int]:
        """Ids of a unit by the agenda, skipping what the keyed hash says."""
        return self._agenda(unit, variant, None)[0]

    def _agenda(self, unit: str, variant: int,
                skips: tuple[int, ...] | None) -> tuple[list[int], list[int]]:
        """Ids of a unit, and the places of the candidates that come up.  Skipped
        are those with numbers in ``skips``, or what the keyed hash says."""
        n = len(unit)
        rank = self.rank
        threshold = self.threshold if skips is None else 0
        seen: list[int] = []
        end = list(range(1, n + 1))        # where the symbol that starts here ends
        before = list(range(-1, n))        # where the symbol before starts
        agenda = [(r[0], i, i + 1, i + 2) for i in range(n - 1)
                  if (r := rank.get(unit[i:i + 2])) is not None]
        heapify(agenda)
        key = self._key(unit, variant) if threshold else 0
        while agenda:
            _, i, j, k = heappop(agenda)
            if end[i] != j or end[j] != k:
                continue                   # a symbol of it has been merged since
            if threshold:
                x = (key ^ (i * 1_000_003 + j * 8191 + k) * _GOLD) * _MIX & _MASK
                if (x ^ x >> 29) * _MIX >> 31 & 0xFFFFFFFF < threshold:
                    continue
            elif skips is not None:
                seen.append((i * 1_000_003 + j * 8191 + k) * _GOLD & _MASK)
                if len(seen) - 1 in skips:
                    continue
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
                if (r := rank.get(unit[i:end[k]])) is not None:
                    heappush(agenda, (r[0], i, k, end[k]))
            h = before[i]
            if h >= 0 and (r := rank.get(unit[h:k])) is not None:
                heappush(agenda, (r[0], h, i, k))
        ids: list[int] = []
        i = 0
        while i < n:
            r = rank.get(unit[i:end[i]])
            if r is not None:
                ids.append(r[1])
            else:
                ids += [self.byte_id[b] for b in unit[i:end[i]].encode()]
            i = end[i]
        return ids, seen

    def _cut(self, word: str) -> list[str]:
        """The word's units: parts that no piece connects."""
        return self._cut_many([word])[0]

    def _cut_many(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The units of several words (not empty), in a row, and how many of each."""
        text = "".join(words)
        codes = _codes(text)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        pairs = codes[:-1] << 21 | codes[1:]
        at = np.minimum(np.searchsorted(self.beside, pairs), len(self.beside) - 1)
        cut = np.empty(len(codes), bool)
        cut[1:] = self.beside[at] != pairs
        cut[0] = True
        cut[ends[:-1]] = True
        starts = np.flatnonzero(cut)
        n = np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))
        first = starts.tolist()
        return [text[i:j] for i, j in zip(first, [*first[1:], len(text)], strict=True)], n

    # ---- texts ----

    def _forget(self) -> None:
        self.word: dict[str, int] = {}                   # number of a word
        # by word: its units' numbers
        self.at_units, self.n_units = _Numbers(np.int64), _Numbers(np.int64)
        self.all_units = _Numbers(np.int64)
        self.number: dict[str, int] = {}                 # of a unit
        self.unit: list[str] = []
        # by number: symbols, ids without skips, codes of the candidates merged
        self.at_symbols, self.n_symbols = _Numbers(np.int64), _Numbers(np.int64)
        self.at_ids, self.n_ids = _Numbers(np.int64), _Numbers(np.int64)
        self.at_codes, self.n_codes = _Numbers(np.int64), _Numbers(np.int64)
        self.all_symbols, self.all_ids = _Numbers(np.int32), _Numbers(np.uint32)
        self.all_codes = _Numbers(np.uint64)
        # UTF-8 of units of under 32 bytes in lanes; 0 bytes stands for longer ones
        self.size, self.lanes = _Numbers(np.int64), _Numbers(np.uint64)

    def _segmented(self, at: np.ndarray, n: np.ndarray, keys: np.ndarray | None
                   ) -> tuple[np.ndarray, ...]:
        """Symbols of units (where their own start, how many), by the agenda: how many
        are left of each, all in a row, how many candidates were merged, their codes."""
        left, n_codes = np.ones(len(n), np.int64), np.zeros(len(n), np.int64)
        rows, codes = [], []
        for size in np.unique(n).tolist():
            of = np.flatnonzero(n == size)
            for i in range(0, len(of), _ROWS):
                some = of[i:i + _ROWS]
                start = self.all_symbols.all()[at[some][:, None] + np.arange(size)]
                done, merged = _agendas(self.symbols, start, None if keys is None else keys[some],
                                        self.threshold)
                for which, values in done:
                    left[some[which]] = values.shape[1]
                    rows.append((some[which], values))
                for turn, (which, code) in enumerate(merged):
                    n_codes[some[which]] = turn + 1
                    codes.append((some[which], turn, code))
        flat = _in_rows(left, rows, np.int32)
        out = np.empty(int(n_codes.sum()), np.uint64)
        first = np.cumsum(n_codes) - n_codes
        for which, turn, code in codes:
            out[first[which] + turn] = code
        return left, flat, n_codes, out

    def _keys(self, now: np.ndarray, which: np.ndarray) -> np.ndarray:
        """:meth:`_key` of many occurrences (units by number)."""
        seeds = which + np.uint64(self.p.seed * self.p.variants & _MASK)
        sizes = self.size.all()[now]
        lanes = self.lanes.all().reshape(-1, 4)
        out = np.empty(len(now), np.uint64)
        for size in np.unique(sizes).tolist():
            of = np.flatnonzero(sizes == size)
            out[of] = short_xxh64(lanes[now[of]], size, seeds[of]) if size else np.fromiter(
                map(xxhash.xxh64_intdigest, map(self.unit.__getitem__, now[of].tolist()),
                    seeds[of].tolist()), np.uint64, len(of))
        return out

    def _learn(self, units: list[str]) -> None:
        """Remember units; long ones (segmented each occurrence anew) by name only."""
        first = len(self.unit)
        self.number.update(zip(units, range(first, first + len(units)), strict=True))
        self.unit += units
        short = [u if len(u) <= _LONG else "" for u in units]
        symbols = self.symbols.of("".join(short))
        n = np.fromiter(map(len, short), np.int64, len(short))
        at = self.all_symbols.n + np.cumsum(n) - n
        self.all_symbols.add(symbols)
        raw = [b if len(b) < 32 else b"" for b in (u.encode("utf-8", "surrogatepass")
                                                   for u in units)]
        self.size.add(list(map(len, raw)))
        self.lanes.add(np.frombuffer(b"".join([b.ljust(32, b"\0") for b in raw]), "<u8"))
        some = np.flatnonzero(n > 0)
        left, flat, merged, codes = self._segmented(at[some], n[some], None)
        flat, left = self.symbols.ids(flat, left)
        for store, of, values, count in (
                (self.all_ids, (self.at_ids, self.n_ids), flat, left),
                (self.all_codes, (self.at_codes, self.n_codes), codes, merged)):
            every = np.zeros(len(n), np.int64)
            every[some] = count
            of[0].add(store.n + np.cumsum(every) - every)
            of[1].add(every)
            store.add(values)
        self.at_symbols.add(at)
        self.n_symbols.add(n)

    def _learn_words(self, words: list[str]) -> None:
        units, n = self._cut_many([" " + w for w in words])
        self._learn(list(set(units).difference(self.number)))
        self.word.update(zip(words, range(len(self.word), len(self.word) + len(words)),
                             strict=True))
        self.at_units.add(self.all_units.n + np.cumsum(n) - n)
        self.n_units.add(n)
        self.all_units.add(np.fromiter(map(self.number.__getitem__, units), np.int64, len(units)))

    def _units_of(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The units' numbers of several word lists, in a row, and how many of each
        list; new words are learnt together."""
        new = set().union(*lists).difference(self.word)
        if new:
            self._learn_words(list(new))
        at = np.fromiter(map(self.word.__getitem__, chain.from_iterable(lists)), np.int64)
        n = self.n_units.all()[at]
        units = self.all_units.all()[_ranges(self.at_units.all()[at], n)]
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *map(len, lists)])]
        return units, np.diff(ends)

    def _ids(self, lists: list[tuple[list[str], int]]) -> list[np.ndarray]:
        """Ids of several word lists, each with its key."""
        if len(self.number) + len(self.word) > self.p.remembered:
            self._forget()
        now, of_list = self._units_of([words for words, _ in lists])
        if not len(now):
            return [np.zeros(0, "<u4") for _ in lists]
        which = np.concatenate([_occurrences(k, base) for k, (_, base) in zip(
            of_list.tolist(), lists, strict=True)])
        n = self.n_ids.all()[now].copy()
        long_ = np.flatnonzero(self.n_symbols.all()[now] == 0)
        special: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []   # places, sizes, ids
        if self.threshold:
            open_ = np.flatnonzero(self.n_codes.all()[now] > 0)
            keys = self._keys(now[open_], which[open_])
            if len(open_):
                coming = self.n_codes.all()[now[open_]]
                codes = self.all_codes.all()[_ranges(self.at_codes.all()[now[open_]], coming)]
                skip = _skipped(np.repeat(keys, coming), codes, self.threshold)
                hit = np.logical_or.reduceat(skip, np.cumsum(coming) - coming)
                open_, keys = open_[hit], keys[hit]
            if len(open_):
                left, flat, _, _ = self._segmented(
                    self.at_symbols.all()[now[open_]], self.n_symbols.all()[now[open_]], keys)
                flat, left = self.symbols.ids(flat, left)
                special.append((open_, left, flat))
        if len(long_):
            made = [self.merged(self.unit[int(now[i])], int(which[i])) for i in long_.tolist()]
            special.append((long_, np.array(list(map(len, made)), np.int64),
                            np.array([x for ids in made for x in ids], np.uint32)))
        plain = np.ones(len(now), bool)
        for places, sizes, _ in special:
            n[places] = sizes
            plain[places] = False
        at = np.cumsum(n) - n
        out = np.empty(int(n.sum()), "<u4")
        if plain.all():
            out[:] = self.all_ids.all()[_ranges(self.at_ids.all()[now], n)]
        else:
            out[_ranges(at[plain], n[plain])] = self.all_ids.all()[
                _ranges(self.at_ids.all()[now[plain]], n[plain])]
            for places, sizes, ids in special:
                out[_ranges(at[places], sizes)] = ids
        ends = np.concatenate([at, [len(out)]])[np.concatenate([[0], np.cumsum(of_list)])]
        return [out[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _pieces_of(self, text: str, key: str) -> Iterator[tuple[list[str], int]]:
        """The text's words and the key, a stretch of it at a time."""
        at = 0
        while at < len(text):
            # cut where a run of spaces starts; its first space opens a word
            stop = text.find(" ", at + _PIECE)
            while stop > 0 and text[stop - 1] == " ":
                stop = text.find(" ", stop + 1)
            stop = len(text) if stop < 0 else stop
            some = text[at:stop]
            if "  " in some or some[0] == " ":
                some = some if at else " " + some
                words = [w[1:] for w in _SPACES.findall(some)]
            else:
                words = some.split(" ")
            yield words, xxhash.xxh64_intdigest(f"{key}@{at}" if at else key, self.p.seed)
            at = stop

    def encode(self, text: str, key: str = "") -> np.ndarray:
        """Ids of a text; ``key`` (say, the document's id) picks the skips."""
        return np.concatenate([np.zeros(0, "<u4"), *(
            ids for p in self._pieces_of(text, key) for ids in self._ids([p]))])

    def encode_many(self, texts: list[str], keys: list[str]) -> list[np.ndarray]:
        """The same for several texts; short ones are dealt with together."""
        out: list = [None] * len(texts)
        held: list[tuple[int, tuple]] = []
        size = 0
        for i, (text, key) in enumerate(zip(texts, keys, strict=True)):
            if not text or len(text) > _PIECE:
                out[i] = self.encode(text, key)
            else:
                held.append((i, next(self._pieces_of(text, key))))
                size += len(text)
            if held and (size > _PIECE or i == len(texts) - 1):
                for (j, _), ids in zip(held, self._ids([p for _, p in held]), strict=True):
                    out[j] = ids
                held, size = [], 0
        return out

    def decode(self, ids) -> bytes:
        """The text's UTF-8 bytes (without the space put before it)."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return raw[1:]


def _slices(*columns: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """A batch in slices of about ``_PIECE`` bytes of the last column's texts: what is
    made of a slice is given back before the next one is read."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(columns[-1]), 0).to_numpy(zero_copy_only=False),
                     dtype=np.int64)
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        stop = min(int(np.searchsorted(ends, before + _PIECE)) + 1, len(ends))
        yield tuple(c.slice(at, stop - at) for c in columns)
        at = stop


_MODELS: dict[tuple, Model] = {}       # per Python worker


def _model(path: str, p: Params) -> Model:
    if (path, p) not in _MODELS:
        _MODELS[path, p] = Model(path, p)
    return _MODELS[path, p]


@contextmanager
def _no_collector() -> Iterator[None]:
    """What a model remembers holds no cycles, and is large to walk through."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def _key(doc_id: int | None, showing: int = 0) -> str:
    return f"{doc_id}#{showing}" if showing else str(doc_id)


def showings(docs: DataFrame) -> DataFrame:
    """doc_id, text and a number (``SHOWING``) of rows repeated under one id and text."""
    same = Window.partitionBy("doc_id", "h").orderBy("h")
    text = F.col("text").cast("string")
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h")).select(
        "doc_id", "text", (F.row_number().over(same) - 1).alias(SHOWING))


def encode(docs: DataFrame, model_path: str, p: Params = Params()) -> DataFrame:
    """doc_id, ids (array of int): a row per row of ``docs``.  Rows of one id differ
    in their skips by the number that :func:`showings` has given them, if it has."""
    ship_code(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = _model(model_path, p)
        for doc_ids, shown, texts in chain.from_iterable(_slices(*b) for b in batches):
            with _no_collector():
                found = model.encode_many(
                    [(t.as_py() or b"").decode() for t in texts],
                    [_key(d.as_py(), n.as_py()) for d, n in zip(doc_ids, shown, strict=True)])
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate([*found, np.zeros(0, "<u4")]).view(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    showing = F.col(SHOWING) if SHOWING in docs.columns else F.lit(0)
    return docs.select("doc_id", run.asNondeterministic()(
        F.col("doc_id"), showing.cast("int"), text_bytes("text")).alias("ids"))


def decode(tokens: DataFrame, model_path: str, p: Params = Params()) -> DataFrame:
    """doc_id, text: a row per row of ``tokens`` (doc_id, ids)."""
    ship_code(tokens.sparkSession)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _model(model_path, p)
        for batch in batches:
            yield pa.array([model.decode(v.as_py() or ()).decode() for v in batch], pa.string())

    return tokens.select("doc_id", run.asNondeterministic()(F.col("ids")).alias("text"))


_TRIP = pa.struct([("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("n_chars", pa.int64()),
                   ("text_crc32", pa.int64()), ("lossless", pa.bool_())])


def round_trip(docs: DataFrame, model_path: str, p: Params = Params()) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers), n_chars and text_crc32 of the text decoded from the ids, and
    whether that is the text: a row per row of ``docs``."""
    ship_code(docs.sparkSession)

    @F.arrow_udf("struct<n_tokens:long,ids_crc32:long,n_chars:long,text_crc32:long,"
                 "lossless:boolean>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = _model(model_path, p)
        for doc_ids, texts in chain.from_iterable(_slices(*b) for b in batches):
            cols: list[list] = [[] for _ in _TRIP]
            given = [t.as_py() or b"" for t in texts]
            with _no_collector():
                every = model.encode_many([t.decode() for t in given],
                                          [_key(d.as_py()) for d in doc_ids])
            for data, ids in zip(given, every, strict=True):
                back = model.decode(ids.tolist())
                row = (len(ids), zlib.crc32(ids), len(back.decode()), zlib.crc32(back),
                       back == data)
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, _TRIP, strict=True)],
                fields=list(_TRIP))

    out = docs.select("doc_id", run.asNondeterministic()(
        F.col("doc_id"), text_bytes("text")).alias("t"))
    return out.select("doc_id", "t.*")
