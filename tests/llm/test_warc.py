"""WARC archives: decisions and round trip against plain Python, the format itself."""
import gzip
import hashlib
import random

import pytest
from pyspark.sql import types as T

from veilset.llm import warc
from veilset.session import stage_path

from .helpers import SF1, read, rows

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    # extra columns, named like the operator's own
    T.StructField("digest", T.StringType()), T.StructField("data", T.StringType()),
    T.StructField("chunk", T.LongType()), T.StructField("decided", T.BooleanType())])

random.seed(3)
BIG = "".join(random.choices("abcdefgh<>/ \n\r\x00é日", k=90_000))
TRICK = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n" * 9

MESSY = [
    (1, "http://a/1", "x" * 100), (2, "http://a/2", "x" * 100), (3, "http://a/3", "x" * 99),
    (4, None, "x" * 99), (5, "http://a/é b\r\nX: y", None), (6, "", ""), (7, "http://a/7", ""),
    (9, "u", BIG), (8, "u", BIG), (8, "u", BIG), (10, "u", BIG + "!"), (11, "u", TRICK),
    (12, "u", TRICK), (None, "u", "x" * 100), (None, "u", "only without an id " * 9),
    (None, "v", "only without an id " * 9), (20, "u", "same row " * 30),
    (20, "u", "same row " * 30), (20, "u", "same row " * 30), (-5, "u", "y" * 200),
    (2**62, "u", "y" * 200), (21, "u", "é" * 50), (22, "u", "é" * 50), (23, "u", "é" * 49),
    (24, "u", "日" * 70_000)]


def expected(pages):
    of: dict = {}
    for page_id, html in pages:
        of.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for data, ids in of.items():
        ids.sort(key=lambda x: (x is None, x or 0))
        digest = hashlib.sha256(data).hexdigest()
        for i, page_id in enumerate(ids):
            again = i > 0 and len(data) >= 100
            out.append((page_id, len(data), digest, "revisit" if again else "response",
                        ids[0] if again else None))
    return sorted(out, key=repr)


def messy(spark):
    return spark.createDataFrame([(*r, "d", "x", 3, False) for r in MESSY], PAGES)


@pytest.mark.parametrize("p", [
    warc.Params(), warc.Params(chunk_bytes=1000, archive_bytes=5000),
    warc.Params(chunk_bytes=7, archive_bytes=1, hot=1)])
def test_messy_round_trip(spark, p):
    pages = messy(spark).where("length(html) < 1000 OR html IS NULL") if p.chunk_bytes < 10 \
        else messy(spark)
    given = [(i, h) for i, _, h in MESSY if p.chunk_bytes >= 10 or len(h or "") < 1000]
    assert rows(warc.round_trip(pages.repartition(3), p)) == expected(given)


def test_empty_table(spark):
    assert rows(warc.round_trip(spark.createDataFrame([], PAGES))) == []


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF1}/pages.parquet")
    given = [(r["page_id"], r["html"]) for r in read(SF1, "pages")]
    assert rows(warc.round_trip(pages, warc.Params(chunk_bytes=2048))) == expected(given)


def test_archives_are_gzip_and_bounded(spark):
    path = stage_path(spark, "warc-test")
    p = warc.Params(chunk_bytes=1000, archive_bytes=20_000)
    warc.write(messy(spark).coalesce(1), path, p)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).collect()
    records = []
    for f in files:
        assert f.length < 22_000
        plain = gzip.decompress(bytes(f.content))         # NUL padding is allowed
        assert plain == b"".join(warc.members(bytes(f.content)))
        records += [warc.parsed(r) for r in warc.members(bytes(f.content))]
    assert max(len(block) for _, block in records) < 1200
    assert len({h["warc-record-id"] for h, _ in records}) == len(records)
    kinds = [h["warc-type"] for h, _ in records]
    assert kinds.count("response") + kinds.count("revisit") == len(MESSY)
    assert kinds.count("continuation") > 100
    parts: dict = {}
    for h, block in records:
        if h["warc-type"] == "continuation":
            parts.setdefault(h["warc-segment-origin-id"], {})[int(h["warc-segment-number"])] = block
        elif "warc-segment-number" in h:
            parts.setdefault(h["warc-record-id"], {})[1] = block
    made = {b"".join(v for _, v in sorted(p.items())).split(b"\r\n\r\n", 1)[1].decode()
            for p in parts.values()}
    assert made == {h for _, _, h in MESSY if h and len(h.encode()) > 1000}


def test_chunk_rows_carry_the_payload_and_its_digest_so_far(spark):
    path = stage_path(spark, "warc-test")
    warc.write(messy(spark), path, warc.Params(chunk_bytes=1000))
    chunks = warc.read_chunks(spark, path).where("page_id = 24 OR record_id LIKE '%:24:%'") \
        .orderBy("chunk").collect()
    state = hashlib.sha256()
    for i, c in enumerate(chunks):
        state.update(bytes(c.data))
        assert (c.chunk, c.sofar) == (i, state.hexdigest()) and len(c.data) <= 1000
    assert state.hexdigest() == hashlib.sha256(("日" * 70_000).encode()).hexdigest()


def test_a_lost_or_changed_chunk_is_an_error(spark):
    path = stage_path(spark, "warc-test")
    warc.write(messy(spark), path, warc.Params(chunk_bytes=50_000))
    rows_ = [tuple(r) for r in warc.read_chunks(spark, path, keep=False)
             .where("NOT whole").orderBy("record_id", "chunk").collect()]

    def finish(some):
        return list(warc._finish(iter([warc._batch(some, warc._CHUNK)])))

    assert finish(rows_)[0].num_rows == 3
    for broken in (rows_[1:], rows_[:1] + rows_[2:], rows_[:-1],
                   [(*rows_[0][:-1], b"z" + bytes(rows_[0][-1])[1:]), *rows_[1:]]):
        with pytest.raises(ValueError):
            finish(broken)
