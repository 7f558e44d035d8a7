"""Registered queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemeter.llm import ann, bpe, debruijn, dialogue, exact_topk, jaccard, licenses, lm, mixing, spelling, suffix, toxicity, word_bpe
from lakemeter.llm.sql import SQL  # noqa: F401  (read by the registry)
from lakemeter.llm.texts import crc_mod, table

ROOT = str(Path(__file__).resolve().parents[2])
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_ENDS = public_tokenizers.path("word_bpe_49k.json")


def importable(spark: SparkSession) -> None:
    """Python workers find this library where the driver does, unless the session says otherwise."""
    if ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def _ready(query: Callable) -> Callable:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)
    return run


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, decoded=True))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.report(suffix.remove_repeats(docs))


def op4_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return debruijn.report(debruijn.remove_repeats(docs))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    scored = toxicity.score(docs, model, score_col="score")
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(mixing.plan_mix(table(spark, sf_dir, "documents")))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lm.score(docs, crc_mod("doc_id", 7) == 2, RANKS)
    return out.select("doc_id", (crc_mod("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(word_bpe.encode(table(spark, sf_dir, "documents"), WORD_ENDS, decoded=True))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.report(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: _ready(q) for q in (
    op1_bpe, op2_exact_topk, op3_suffix_dedup, op4_debruijn_dedup, op5_ann,
    op6_toxicity, op7_mixing, op8_license_scan, op9_jaccard_join, op10_lm_scoring,
    op11_word_bpe, op12_spelling_variants, op13_conversation_repair,
)}
