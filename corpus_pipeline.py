"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, packing.

Every stage takes the columns of ``documents`` and works on what the stage before it kept. The last one returns the packed
pieces; the others return documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import exact_dedup, mixing, packing, quality
from tokenloom.llm import near_copies as near
from tokenloom.llm.common import Scratch, chosen_rows, table
from tokenloom.llm.queries import END_OF_PACKED, MOST_REPEATS, POLICY, SCHEDULES, WEIGHTS, word_tokenizer_file

NEAR_WORDS, NEAR_SIMILARITY = 5, 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the policy rejects."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), "text")
    return quality.apply_policy(quality.ledger(rows), POLICY).where("kept").select("doc.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the one of the smallest id."""
    found = exact_dedup.exact_groups(docs, Scratch(spark, "pipeline-exact")).where("kept")
    # rows that repeat the doc_id that stays: the longest, then the least hash
    best = found.groupBy("text_sha256").agg(F.min(F.struct(-F.col("chars"), "text_hash", "doc_id")).alias("best"))
    return chosen_rows(docs, best.select("best.doc_id", "best.text_hash"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    found = near.similar_groups(docs, Scratch(spark, "pipeline-near"), NEAR_WORDS, NEAR_SIMILARITY)
    # a null doc_id stays only where all are null
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("best"))
    return chosen_rows(docs, best.select("best.doc_id", "best.text_hash"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a row for each pass of a document, whole."""
    plan = mixing.plan_mix(docs, WEIGHTS, MOST_REPEATS, SCHEDULES, Scratch(spark, "pipeline-mix"))
    return mixing.mixed_documents(docs, plan)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, which follow the training order of the mix."""
    ordered = mixing.in_training_order(docs, SCHEDULES, Scratch(spark, "pipeline-order"))
    return packing.pieces(packing.pack(ordered, word_tokenizer_file(), END_OF_PACKED)).drop("n_ids")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near-dedup", near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints, token ids and packing are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
