"""WARC archives written from and read into a table of record chunks.

A payload travels as rows (record, chunk number, bytes): small ones as a single
row, oversized ones as many, none longer than ``Params.chunk_bytes``.  In the
archive a chunk is a WARC 1.1 record (an oversized payload is a ``response`` and
its ``continuation`` segments), each in a gzip member of its own, with the SHA-256
of the payload so far.  Writer and reader hold a chunk and a digest state at a
time, never a whole record; an archive file holds about ``archive_bytes``, and a
record may run over several files.

Which records are revisits is decided on (page_id, digest) rows: per payload of
at least ``least_bytes`` bytes the smallest page_id is the response.  Payloads held
by the most pages (``hot`` of them, so a bounded list) meet their pages by
broadcast, all others by a shuffle in which none has a large share.  Chunk rows and
decisions are then dealt out together by (page_id, digest) and read in order: one
shuffle of the payloads, no join of them.

Files are written by Spark's text writer (one row per file; its row end is a NUL,
zero padding to gzip readers), so they go to any file system Spark knows and a
lost executor leaves no half-written file; Spark's ``binaryFile`` source reads
them.  They carry that writer's ``.txt`` ending.

Defined cases: NULL html is the empty payload; a NULL page_id is larger than any
other, a revisit of a payload that only such rows hold has a NULL ``refers_to``;
rows repeated under one page_id with an equal payload are one response, the others
revisits of that page_id; records of under ``least_bytes`` bytes are all responses;
payloads of any length are written whole; a NULL url has no ``WARC-Target-URI``;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_path
from .common import ship_code, staged, text_bytes

_END = b"\r\n\r\n"
_WINDOW = 1 << 14                  # bytes of an archive given to gzip at a time
_HELD = 1 << 22                    # bytes of chunk rows handed on at a time
_PRINTABLE = "".join(map(chr, range(33, 127)))


@dataclass(frozen=True)
class Params:
    chunk_bytes: int = 1 << 18             # longest piece of a payload in a row
    archive_bytes: int = 16 << 20          # an archive file is closed at this size
    least_bytes: int = 100                 # shorter payloads are never revisits
    hot: int = 1000                        # payloads whose pages are found by broadcast
    level: int = 1                         # of gzip
    date: str = "1970-01-01T00:00:00Z"     # WARC-Date: the table has no time of capture


# ---- decisions --------------------------------------------------------------------

def _records(pages: DataFrame) -> DataFrame:
    body = text_bytes("html")
    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), body.alias("body"),
                        F.unhex(F.sha2(body, 256)).alias("digest"))


def referrals(records: DataFrame, p: Params = Params()) -> DataFrame:
    """page_id, digest, refers_to: every record but the first of its payload."""
    held = staged(records.where(F.length("body") >= p.least_bytes)
                  .groupBy("digest", "page_id").agg(F.lit(1).alias("one")), "warc-digests")
    held = held.select("digest", "page_id")
    firsts = held.groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hot = firsts.orderBy(F.desc("n"), "digest").limit(p.hot).select(
        "digest", F.col("refers_to").alias("hot"))
    met = held.join(F.broadcast(hot), "digest", "left")
    found = (met.where("hot IS NOT NULL").select("page_id", "digest", F.col("hot").alias("refers_to"))
             .unionByName(met.where("hot IS NULL").join(firsts, "digest")
                          .select("page_id", "digest", "refers_to")))
    return found.where(~F.col("page_id").eqNullSafe(F.col("refers_to")))


# ---- writing ----------------------------------------------------------------------

_GIVEN = ("page_id", "digest", "decided", "refers_to", "url", "n_bytes", "chunk", "data")


def _chunk_rows(records: DataFrame, p: Params) -> DataFrame:
    """A record's payload in rows of at most ``chunk_bytes`` bytes, in order."""
    n = F.length("body")
    rows = records.select(
        "page_id", "digest", "url", "body", n.cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("nth"),
        F.greatest(F.ceil(n / p.chunk_bytes), F.lit(1)).cast("int").alias("chunks"))
    rows = rows.select("page_id", "digest", "url", "body", "n_bytes", "nth",
                       F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    return rows.select("page_id", "digest", "url", "n_bytes", "nth", "chunk", F.substring(
        "body", F.col("chunk") * p.chunk_bytes + 1, F.lit(p.chunk_bytes)).alias("data"))


def record_id(page_id: int | None, digest: str, nth: int) -> str:
    """The URN of a record: its page, its payload, its number among equal rows."""
    return f"urn:x-page:{'none' if page_id is None else page_id}:{digest}:{nth}"


def _page_of(urn: str) -> int | None:
    page = urn.split(":")[2]
    return None if page == "none" else int(page)


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """A WARC record as a gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers)
    head += f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(head.encode("ascii") + block + _END) + z.flush()


class _Writer:
    """Records of one task, from chunk rows in order."""

    def __init__(self, p: Params) -> None:
        self.p = p
        self.key: tuple | None = None       # page_id, digest
        self.refers: tuple = ()             # the response's page_id, once decided
        self.nth = -1                       # of the record among those of one key
        self.sofar = hashlib.sha256()
        self.done = 0

    def add(self, page_id, digest, decided, refers_to, url, n_bytes, chunk, data) -> bytes:
        p = self.p
        if self.key != (page_id, digest):
            self.key, self.refers, self.nth = (page_id, digest), (), -1
        if decided:
            self.refers = (refers_to,)
            return b""
        if chunk == 0:
            self.nth += 1
            self.sofar, self.done = hashlib.sha256(), 0
        again = n_bytes >= p.least_bytes and (bool(self.refers) or self.nth > 0)
        urn = record_id(page_id, digest.hex(), self.nth)
        headers = [("WARC-Date", p.date)]
        if url is not None:
            headers.append(("WARC-Target-URI", quote(url, safe=_PRINTABLE)))
        if again:
            if chunk:
                return b""
            first = self.refers[0] if self.refers else page_id
            return _member([
                ("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{urn}>"), *headers,
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/"
                                 "identical-payload-digest"),
                ("WARC-Refers-To", f"<{record_id(first, digest.hex(), 0)}>"),
                ("WARC-Payload-Digest", f"sha256:{digest.hex()}"),
                ("X-Payload-Length", str(n_bytes))], b"", p.level)
        self.sofar.update(data)
        self.done += len(data)
        last = self.done == n_bytes
        if last and self.sofar.digest() != digest:
            raise ValueError(f"chunks of {urn} do not make up its payload")
        http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                b"Content-Length: %d\r\n\r\n" % n_bytes)
        sofar = ("X-Payload-Digest-So-Far", f"sha256:{self.sofar.hexdigest()}")
        if chunk == 0:
            kind = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{urn}>"), *headers,
                    ("Content-Type", "application/http;msgtype=response"),
                    ("WARC-Payload-Digest", f"sha256:{digest.hex()}"),
                    ("X-Payload-Length", str(n_bytes)), sofar]
            if not last:
                kind.append(("WARC-Segment-Number", "1"))
            return _member(kind, http + data, p.level)
        kind = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{urn}:{chunk}>"), *headers,
                ("WARC-Segment-Origin-ID", f"<{urn}>"),
                ("WARC-Segment-Number", str(chunk + 1)), sofar]
        if last:
            kind.append(("WARC-Segment-Total-Length", str(len(http) + n_bytes)))
        return _member(kind, data, p.level)


def _write_partition(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, held, size = _Writer(p), [], 0
        for batch in batches:
            cols = [batch.column(c) for c in _GIVEN]
            for i in range(batch.num_rows):
                member = writer.add(*(c[i].as_py() for c in cols))
                held.append(member)
                size += len(member)
                if size >= p.archive_bytes:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b"".join(held)], pa.binary())], ["data"])
                    held, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays(
                [pa.array([b"".join(held)], pa.binary())], ["data"])

    return run


def write(pages: DataFrame, path: str, p: Params = Params()) -> None:
    """Archive ``pages`` (page_id, url, html) below ``path``."""
    ship_code(pages.sparkSession)
    records = _records(pages)
    chunks = _chunk_rows(records, p).withColumns({
        "decided": F.lit(False), "refers_to": F.lit(None).cast("long")})
    decided = referrals(records, p).select(
        "page_id", "digest", F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("long").alias("n_bytes"), F.lit(-1).cast("long").alias("nth"),
        F.lit(0).alias("chunk"), F.lit(None).cast("binary").alias("data"),
        F.lit(True).alias("decided"), "refers_to")
    rows = (chunks.unionByName(decided).repartition("page_id", "digest")
            .sortWithinPartitions("page_id", "digest", "nth", "chunk"))
    files = rows.select(*_GIVEN).mapInArrow(_write_partition(p), "data binary")
    (files.select(F.col("data").cast("string")).write.option("maxRecordsPerFile", 1)
     .option("compression", "none").option("lineSep", "\0").text(path))


# ---- reading ----------------------------------------------------------------------

def members(data) -> Iterator[bytes]:
    """The gzip members of an archive, one at a time."""
    data, at = memoryview(data), 0
    while at < len(data) and data[at]:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            some = data[at:at + _WINDOW]
            if not len(some):
                raise ValueError("archive ends within a record")
            parts.append(z.decompress(some))
            at += len(some)
        at -= len(z.unused_data)
        yield b"".join(parts)


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a WARC record."""
    stop = record.index(_END)
    first, *lines = record[:stop].decode("ascii").split("\r\n")
    headers = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
    block = record[stop + 4:-4]
    if first != "WARC/1.1" or int(headers["content-length"]) != len(block):
        raise ValueError("not a WARC record of this version, or of another length")
    return headers, block


_CHUNK = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("chunk", pa.int32()), ("whole", pa.bool_()), ("sofar", pa.string()), ("data", pa.binary())])
_CHUNK_DDL = ("record_id string, record_type string, page_id long, refers_to long, "
              "payload_bytes long, payload_digest string, chunk int, whole boolean, "
              "sofar string, data binary")


def _chunk(headers: dict[str, str], block: bytes, keep: bool) -> tuple:
    """The chunk row of a WARC record.  What came in one piece is digested here, its
    bytes go along only if asked for."""
    urn = headers["warc-record-id"][1:-1]
    kind = headers["warc-type"]
    n = int(headers.get("x-payload-length", -1))
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    sofar = headers.get("x-payload-digest-so-far", "").removeprefix("sha256:")
    if kind == "revisit":
        return (urn, kind, _page_of(urn), _page_of(headers["warc-refers-to"][1:-1]), n, digest,
                0, True, digest, None)
    if kind == "continuation":
        return (headers["warc-segment-origin-id"][1:-1], None, None, None, None, None,
                int(headers["warc-segment-number"]) - 1, False, sofar, block)
    payload = block[block.index(_END) + 4:]
    whole = "warc-segment-number" not in headers
    if whole:
        found = hashlib.sha256(payload).hexdigest()
        if len(payload) != n or found != digest:
            raise ValueError(f"payload of {urn} is not what its record says")
    return (urn, kind, _page_of(urn), None, n, digest, 0, whole, sofar,
            None if whole and not keep else payload)


def read_chunks(spark: SparkSession, path: str, keep: bool = True) -> DataFrame:
    """The archives below ``path`` as chunk rows; with ``keep`` off only oversized
    records carry their bytes."""
    ship_code(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                size = 0
                for record in members(content.as_buffer()):
                    row = _chunk(*parsed(record), keep)
                    rows.append(row)
                    size += 300 + len(row[-1] or b"")
                    if size > _HELD:
                        yield _batch(rows, _CHUNK)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, _CHUNK)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return files.select("content").mapInArrow(run, _CHUNK_DDL)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


_OUT = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                  ("payload_digest", pa.string()), ("record_type", pa.string()),
                  ("refers_to", pa.int64())])
_OUT_DDL = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
            "refers_to long")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from chunk rows in order: the digest grows chunk by chunk."""
    urn, head, sofar, got, chunk = None, None, hashlib.sha256(), 0, 0
    for batch in batches:
        out: list[tuple] = []
        cols = [batch.column(f.name) for f in _CHUNK]
        for i in range(batch.num_rows):
            (now, kind, page_id, refers_to, n, digest, at, whole, said,
             data) = (c[i].as_py() for c in cols)
            if urn is not None and (now, at) != (urn, chunk):
                raise ValueError(f"chunk {chunk} of {urn} is missing")
            if whole:
                out.append((page_id, n, said, kind, refers_to))
                continue
            if urn is None:
                if at:
                    raise ValueError(f"chunk 0 of {now} is missing")
                urn, head, sofar, got, chunk = now, (page_id, n, digest, kind), \
                    hashlib.sha256(), 0, 0
            sofar.update(data)
            got, chunk = got + len(data), chunk + 1
            if sofar.hexdigest() != said:
                raise ValueError(f"chunk {at} of {now} is not what its record says")
            if got >= head[1]:
                if got > head[1] or sofar.hexdigest() != head[2]:
                    raise ValueError(f"payload of {now} is not what its record says")
                out.append((head[0], got, sofar.hexdigest(), head[3], None))
                urn = None
        if out:
            yield _batch(out, _OUT)
    if urn is not None:
        raise ValueError(f"chunk {chunk} of {urn} is missing")


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record."""
    rows = read_chunks(spark, path, keep=False)
    # a record's chunks meet in order; records in one piece pass as they are
    return rows.repartition("record_id").sortWithinPartitions(
        "record_id", "chunk").mapInArrow(_finish, _OUT_DDL)


def round_trip(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """Archive ``pages`` in the shared folder and read the archives back."""
    path = stage_path(pages.sparkSession, "warc")
    write(pages, path, p)
    return read(pages.sparkSession, path)
