"""Fixtures shared by the tests of the training-data operators."""
import pyarrow.parquet as pq
from pyspark.sql import types as T

SF1 = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # extra columns, named like the operators' own
    T.StructField("row", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("fp", T.LongType()),
    T.StructField("id", T.LongType()), T.StructField("q", T.StringType())])

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))

MESSY = [
    (1, "Plain words here, one two three four five six seven eight nine ten eleven.", "en", "a"),
    (1, "Plain words here, one two three four five six seven eight nine ten eleven.", "en", "a"),
    (2, None, None, None), (3, "", "en", "a"), (4, " \n\t \n", "en", None),
    (None, "a text without an id, mail me at x.y@example.com or +1 (555) 010-2030", None, "b"),
    (None, None, None, None), (5, LONG, "en", "a"), (6, "no\nno\nno\nyes\nno", "fr", "b"),
    (7, "été   nbsp   wide 日本語 <|endoftext|> \U0001f600 é \x1c it's", "x", "b"),
    (8, "4111 1111 1111 1111 and 10.0.0.256 and 10.0.0.1 a@b.c_d@e.f", "en", "a"),
    (-9, "the same same same same same same same same same same same same", "en", "a"),
    (2**62, "x" * 3000, "en", "a"),
]


def messy(spark, rows=MESSY):
    full = [(i, t, lang, src, None if t is None else len(t), "r", "k", "s", 7, 8, "q")
            for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def read(sf, name, columns=None):
    return pq.read_table(f"{sf}/{name}.parquet", columns=columns).to_pylist()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
