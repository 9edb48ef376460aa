"""Fill-in-middle examples, cut through a learned rank index.

A text is a row of units (a run of ASCII letters, or one other character); a
cut is a rank: so many units from the start.  Where a rank lies in the text is
answered by an index of all boundaries, learned per text:

* segments: from a boundary on, a straight line (rank to code points) that
  misses no boundary by more than ``Params.error``; a segment runs as far as
  one slope fits (the shrinking cone of slopes), then the next one starts;
* residuals: per boundary what the line is off, one signed byte each.

A cut is predicted by its segment's line and put right by its residual, so it
is exact.  The index is built where the text is read (an Arrow function); cuts,
examples and their way back are built-in functions.  A text's rows never meet
another's: no shuffle, and a lost executor costs the tasks it ran.

Defined cases: NULL text is the empty text (0 units, form ``plain``, the text
itself is the output); a NULL id is hashed as no digits; texts of any length
are cut whole, their index takes one byte a unit; repeated rows give repeated
rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_code, text_bytes

PRE, SUF, MID = "<P>", "<S>", "<M>"
_WINDOW = 256             # boundaries tried at a time, doubled while they fit


@dataclass(frozen=True)
class Params:
    salt: str = "1:"      # put before the id that is hashed
    plain_from: int = 90  # of 100: from here on a text stays as it is
    spm_below: int = 20   # of 100: below this the suffix comes first
    error: int = 120      # what a line may be off; a residual is one byte


# ---- the index ----------------------------------------------------------------

def boundaries(text: str) -> np.ndarray:
    """Offsets (code points) of all unit boundaries, 0 and the length included."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = ((code | 0x20) - np.uint32(97)) < 26
    inside = np.zeros(len(code) + 1, bool)
    inside[1:-1] = letter[1:] & letter[:-1]
    return np.flatnonzero(~inside)


def fit(offsets: np.ndarray, error: int) -> tuple[list[tuple[int, int, float]], np.ndarray]:
    """Segments (first rank, its offset, slope) and the residuals of all ranks."""
    n, at = len(offsets), 0
    segments = []
    lines = np.empty(n, np.int64)
    while at < n:
        low, high, stop, window = -np.inf, np.inf, at + 1, _WINDOW
        while stop < n:
            some = np.arange(stop, min(stop + window, n))
            run, rise = some - at, offsets[some] - offsets[at]
            lows = np.maximum.accumulate(np.maximum((rise - error) / run, low))
            highs = np.minimum.accumulate(np.minimum((rise + error) / run, high))
            over = np.flatnonzero(lows > highs)
            fits = int(over[0]) if len(over) else len(some)
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
            stop += fits
            if fits < len(some):
                break
            window *= 2
        slope = float((low + high) / 2) if stop > at + 1 else 0.0
        segments.append((at, int(offsets[at]), slope))
        lines[at:stop] = offsets[at] + np.floor(slope * np.arange(stop - at)).astype(np.int64)
        at = stop
    return segments, (offsets - lines).astype(np.int8)


_SEGMENT = pa.struct([("rank", pa.int64()), ("offset", pa.int64()), ("slope", pa.float64())])
_INDEX = pa.struct([("n", pa.int64()), ("segments", pa.list_(_SEGMENT)),
                    ("residuals", pa.list_(pa.int8()))])
_INDEX_DDL = ("struct<n:long,segments:array<struct<rank:long,offset:long,slope:double>>,"
              "residuals:array<tinyint>>")


def rank_index(text: Column, p: Params = Params()) -> Column:
    """The index of a text: n units, segments, residuals."""
    if not 1 <= p.error <= 126:
        raise ValueError("error must leave room in a signed byte (1 to 126)")
    ship_code()

    @F.arrow_udf(_INDEX_DDL)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ns, seg_ends, res_ends = [], [0], [0]
            rows: list[tuple] = []
            rest: list[np.ndarray] = []
            for v in batch:
                segments, residuals = fit(
                    boundaries((v.as_py() or b"").decode("utf-8", "replace")), p.error)
                ns.append(len(residuals) - 1)
                rows += segments
                rest.append(residuals)
                seg_ends.append(len(rows))
                res_ends.append(res_ends[-1] + len(residuals))
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            flat = pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, _SEGMENT, strict=True)],
                fields=list(_SEGMENT))
            yield pa.StructArray.from_arrays([
                pa.array(ns, pa.int64()),
                pa.ListArray.from_arrays(pa.array(seg_ends, pa.int32()), flat),
                pa.ListArray.from_arrays(
                    pa.array(res_ends, pa.int32()),
                    pa.array(np.concatenate([*rest, np.zeros(0, np.int8)])))],
                fields=list(_INDEX))

    return run.asNondeterministic()(text_bytes(text))


def offset_at(index: Column, rank: Column) -> Column:
    """Code points before the boundary of that rank: its line, put right."""
    segment = F.array_max(F.filter(index["segments"], lambda s: s["rank"] <= rank))
    line = segment["offset"] + F.floor(segment["slope"] * (rank - segment["rank"]))
    return line + F.get(index["residuals"], rank.cast("int"))


# ---- examples -------------------------------------------------------------------

def _part(text: Column, start: Column | int, stop: Column | None = None) -> Column:
    """Code points from ``start`` up to ``stop`` (from 0, the end if None)."""
    start = F.lit(start) if isinstance(start, int) else start
    length = F.char_length(text) if stop is None else stop - start
    return F.substring(text, (start + 1).cast("int"), length.cast("int"))


def examples(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, text, n, form, prefix_chars, middle_chars, output: a row per row."""
    digest = F.sha2(F.concat(F.lit(p.salt), F.coalesce(F.col("doc_id").cast("string"),
                                                       F.lit(""))), 256)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"),
                       rank_index(F.col("text"), p).alias("index"), digest.alias("digest"))

    def drawn(nth: int) -> Column:
        return F.conv(F.substring("digest", 8 * nth + 1, 8), 16, 10).cast("long")

    units = F.col("index")["n"] + 1
    text = F.col("text")
    plain = (text == "") | (drawn(2) % 100 >= p.plain_from)
    for mark in (PRE, SUF, MID):
        plain = plain | F.contains(text, F.lit(mark))
    rows = rows.select(
        "doc_id", "text", "index", F.col("index")["n"].alias("n"),
        F.when(plain, "plain").when(drawn(3) % 100 < p.spm_below, "spm")
         .otherwise("psm").alias("form"),
        F.least(drawn(0) % units, drawn(1) % units).alias("first"),
        F.greatest(drawn(0) % units, drawn(1) % units).alias("second"))
    rows = rows.select("doc_id", "text", "n", "form",
                       offset_at(F.col("index"), F.col("first")).alias("a"),
                       offset_at(F.col("index"), F.col("second")).alias("b"))
    a, b = F.col("a"), F.col("b")
    pre, mid, suf = _part(text, 0, a), _part(text, a, b), _part(text, b)
    cut = F.col("form") != "plain"
    return rows.select(
        "doc_id", "text", "n", "form",
        F.when(cut, a).alias("prefix_chars"), F.when(cut, b - a).alias("middle_chars"),
        F.when(F.col("form") == "psm", F.concat(F.lit(PRE), pre, F.lit(SUF), suf, F.lit(MID), mid))
         .when(F.col("form") == "spm", F.concat(F.lit(SUF), suf, F.lit(PRE), pre, F.lit(MID), mid))
         .otherwise(text).alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text again, from an example and its form alone: a cut text holds no
    marker, and no end of one is the start of another, so the first is the one."""
    p, s, m = (F.instr(output, mark) - 1 for mark in (PRE, SUF, MID))
    psm = F.concat(_part(output, 3, s), _part(output, m + 3), _part(output, s + 3, m))
    spm = F.concat(_part(output, p + 3, m), _part(output, m + 3), _part(output, 3, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The examples with SHA-256 of the output and of the text made from it."""
    def sha(col: Column) -> Column:
        return F.sha2(col.cast("binary"), 256)

    back = restored(F.col("output"), F.col("form"))
    return examples(docs, p).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha(F.col("output")).alias("output_sha256"), sha(back).alias("restored_sha256"))
