"""One query per training-data operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from inkmill.llm import (
    bin_packing,
    bitsliced_topk,
    chat_rotation,
    decontamination,
    language_id,
    quality_ranking,
    spelling_variants,
    superminhash,
    token_count,
    toxicity,
    url_filter,
    warc,
    whitening,
)
from inkmill.llm.hashing import fold
from inkmill.llm.settings import CAPACITY, COMPONENTS, END_ID, PACK_TOKENIZER, PIECE_MODEL, RULES, WORDS
from inkmill.llm.worker import small_batches
from inkmill.staging import spread, staging_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


def texts(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return spread(table(spark, sf, "documents", "doc_id", "text"))


def topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding")
    return bitsliced_topk.search(vectors, k=5, every=50)


def urls(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages", "page_id", "url")
    return url_filter.judge_urls(pages, RULES).drop("url")


def language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    docs = texts(spark, sf)
    found = docs.select("doc_id", held_out.alias("held_out"), language_id.identify(docs, model).alias("p"))
    return found.select("doc_id", "held_out", "p.*")


def chat(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"]))
    rotated = chat_rotation.rotate(turns)
    return rotated.drop("messages").withColumn("spans", F.array_join(spans, ","))


def quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf)
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    labels = table(spark, sf, "labels", "doc_id", "quality").where(~held_out)
    model = quality_ranking.fit(docs, labels)
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), quality_ranking.quality_score(docs, model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = docs.select(
        "doc_id", n_bytes.alias("n_bytes"), token_count.count_tokens(F.col("text"), PIECE_MODEL).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > CAPACITY)


def contamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    return decontamination.contamination(docs, table(spark, sf, "benchmark", "item_id", "text"))


def archives(spark: SparkSession, sf: str) -> DataFrame:
    folder = staging_path(spark, "warc")
    warc.write_warc(spread(table(spark, sf, "pages", "page_id", "url", "html")), folder)
    return warc.read_warc(spark, folder)


def packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = bin_packing.token_pieces(texts(spark, sf), PACK_TOKENIZER, END_ID, CAPACITY)
    return bin_packing.pack(pieces, CAPACITY)


def near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return superminhash.near_duplicates(texts(spark, sf), WORDS)


def whitened(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings", "vec_id", "embedding"), COMPONENTS)


def spellings(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants.variants(texts(spark, sf))


def toxic(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    labels = table(spark, sf, "labels", "doc_id", "toxic").where(~held_out)
    model = toxicity.fit(docs, labels)
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), toxicity.toxicity_score(docs, model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def queries() -> dict[str, Query]:
    return {
        "op1_bitsliced_topk": topk,
        "op2_url_filter": urls,
        "op3_language_id": language,
        "op4_chat_rotation": chat,
        "op5_quality_ranking": quality,
        "op6_token_count": tokens,
        "op7_decontamination": contamination,
        "op8_warc": archives,
        "op9_bin_packing": packing,
        "op10_superminhash": near_duplicates,
        "op11_feast_whitening": whitened,
        "op12_spelling_variants": spellings,
        "op13_toxicity": toxic,
        "pipeline": corpus_pipeline.run,
    }
