"""Corpus pipeline: toxic documents go, one of each group of near duplicates stays, repeated passages
are cut, sources are mixed to their target weights, and the result is encoded.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of
``docs``.  Column names that begin with ``_jaccard_``, ``_suffix_`` or ``_mix_`` are
reserved.  Every stage works on all rows that the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemeter.llm import bpe, jaccard, mixing, suffix, toxicity
from lakemeter.llm.queries import RANKS, importable
from lakemeter.llm.texts import table
from lakemeter.session import materialize


#: partitions that a shard of the mix is dealt over
SHARD_SALTS = 8
#: rows that Spark sends to a Python worker at a time
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Whole documents are wide rows: fewer of them in a batch keep both ends of the pipe small, and the reader's
    buffers of texts too."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by the model of the labelled rows."""
    importable(spark)
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return docs.filter(toxicity.scored(model)(F.coalesce("text", F.lit(""))) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of documents with a shingle similarity of 0.8 or more."""
    importable(spark)
    small_batches(spark)
    return jaccard.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that start earlier in the corpus."""
    importable(spark)
    small_batches(spark)
    return suffix.cut_texts(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, laid out by output shard.

    A shard is dealt over ``SHARD_SALTS`` partitions, so it may hold any share of the rows; a file holds such parts of
    shards, each in its shuffled order."""
    rows = mixing.mix(docs).withColumn("_mix_salt", F.pmod(F.xxhash64("_mix_position", "doc_id"), F.lit(SHARD_SALTS)))
    return rows.repartition("_mix_shard", "_mix_salt").sortWithinPartitions("_mix_shard", "_mix_salt", "_mix_position").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with digests of the ids and of the bytes they decode to."""
    importable(spark)
    small_batches(spark)
    return bpe.digests(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded=True), keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# The fitted classifier and the merges of a rank file are beyond SQL; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
