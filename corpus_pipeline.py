"""Corpus pipeline: documents to token sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.

1. quality: documents that the compression bands reject go;
2. simhash: one document of each near-duplicate group stays;
3. pii: personal data, and the terms that give it away, are masked in the text;
4. mixing: documents of small sources are repeated to their target weights,
   none is dropped;
5. pieces: texts become token ids, by seeded merge-dropout.

Extra columns are carried to the fourth stage; NULL or empty texts go in the
first one (they have no words); empty tables pass every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilset.llm import mixing, pieces, pii, quality, simhash
from veilset.llm.common import staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group."""
    return simhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return pii.sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture shows them."""
    return mixing.realise(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens: the sequences to train on, another for each showing."""
    tokens = pieces.encode(pieces.showings(docs), public_tokenizers.path("piece_bpe_32k.model"))
    return tokens.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

# Compression, 64-bit hashes and keyed merges are beyond SQL; the stages are
# tested against brute force (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is staged."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
