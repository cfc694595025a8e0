"""From raw documents to packed training sequences, in five stages.

Every stage but the last returns the columns of documents. Stages that fit a model learn from
all labelled rows they are given; missing labels reject nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import bin_packing, decontamination, language_id, quality_ranking, superminhash
from inkmill.llm.hashing import small
from inkmill.llm.settings import CAPACITY, END_ID, PACK_TOKENIZER, PIPELINE_WORDS
from inkmill.staging import spread, stage

# Posterior of the likeliest language after three average words: texts that mix languages stay
# below, while a short text in one language does not.
LANGUAGE_EVIDENCE = 3
MIN_LANGUAGE_SCORE = 0.8

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    docs = spread(docs.select(COLUMNS))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_ranking.fit(docs, labels.select("doc_id", "quality"))
    return docs.where(quality_ranking.quality_score(docs, model) >= 0.5)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one language: with letters, and with a score of 0.8 for the likeliest one."""
    docs = spread(docs.select(COLUMNS))
    model = language_id.fit(docs)
    found = language_id.identify(docs, model, evidence=LANGUAGE_EVIDENCE)
    return docs.where(found["score"] >= MIN_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest id."""
    docs = spread(docs.select(COLUMNS))
    found = superminhash.near_duplicates(docs, PIPELINE_WORDS)
    found = stage(found.select("doc_id", "kept"), "kept")
    dropped = stage(found.where("NOT kept").select("doc_id").distinct(), "dropped")
    dropped = small(dropped, superminhash.BROADCAST_IDS)
    kept = docs.join(dropped, "doc_id", "left_anti").select(COLUMNS)
    named = found.where("kept AND doc_id IS NOT NULL")
    if named.count() > named.distinct().count():  # repeated rows: one row stays
        unnamed = kept.where("doc_id IS NULL")
        kept = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(unnamed)
    return kept


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontamination.decontaminate(docs.select(COLUMNS), benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in training sequences."""
    docs = spread(docs.select(COLUMNS))
    pieces = bin_packing.token_pieces(docs, PACK_TOKENIZER, END_ID, CAPACITY)
    return bin_packing.pack(pieces, CAPACITY)


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

# Learned models, signatures and bin plans are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
