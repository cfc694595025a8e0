"""Tokenizer artefacts: Parquet tables, and the usual JSON and text files.

All of them are bounded by the vocabulary size.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions.pretokens import SPECIAL_TOKENS, byte_chars
from inkmill.operators.bpe import BpeModel
from inkmill.sources import files


def display(token: bytes) -> str:
    """A token as written in vocabulary files: one printable character per byte."""
    return "".join(byte_chars()[b] for b in token)


def token_strings(model: BpeModel) -> list[str]:
    return SPECIAL_TOKENS + [display(t) for t in model.tokens[len(SPECIAL_TOKENS) :]]


def vocab_table(spark: SparkSession, model: BpeModel) -> DataFrame:
    rows = [(i, s, t) for i, (s, t) in enumerate(zip(token_strings(model), model.tokens))]
    return spark.createDataFrame(rows, "id int, token string, bytes binary")


def merges_table(spark: SparkSession, model: BpeModel) -> DataFrame:
    rows = [
        (rank, a, b, new, n)
        for rank, ((a, b, new), n) in enumerate(zip(model.merges, model.counts))
    ]
    return spark.createDataFrame(
        rows, "rank int, left_id int, right_id int, new_id int, pair_count long"
    )


def save_tables(spark: SparkSession, model: BpeModel, folder: str) -> None:
    vocab_table(spark, model).coalesce(1).write.parquet(f"{folder}/vocab")
    merges_table(spark, model).coalesce(1).write.parquet(f"{folder}/merges")


def load_tables(spark: SparkSession, folder: str) -> BpeModel:
    vocab = spark.read.parquet(f"{folder}/vocab")
    merges = spark.read.parquet(f"{folder}/merges")
    listed = merges.orderBy("rank").collect()
    return BpeModel(
        merges=[(r["left_id"], r["right_id"], r["new_id"]) for r in listed],
        counts=[r["pair_count"] for r in listed],
        tokens=[bytes(r["bytes"]) for r in vocab.orderBy("id").collect()],
    )


def tokenizer_report(
    size: DataFrame, model: BpeModel, min_frequency: int, source: str
) -> DataFrame:
    """One row of facts about a learned tokenizer; ``size`` is the corpus size."""
    return size.select(
        F.lit("BPE").alias("type"),
        F.lit(model.vocab_size).alias("vocab_size"),
        F.lit(min_frequency).alias("min_frequency"),
        F.array(*[F.lit(s) for s in SPECIAL_TOKENS]).alias("special_tokens"),
        F.lit(source).alias("input"),
        "documents",
        "characters",
    )


def save_files(model: BpeModel, folder: str, report: dict | None = None) -> None:
    """``vocab.json``, ``merges.txt``, ``tokenizer.json`` and ``tokenizer_config.json``."""
    folder = folder.rstrip("/")
    names = token_strings(model)
    vocab = {name: i for i, name in enumerate(names)}
    pairs = [[names[a], names[b]] for a, b, _ in model.merges]

    def put(name: str, content: str) -> None:
        files.write_bytes(f"{folder}/{name}", content.encode())

    put("vocab.json", json.dumps(vocab, ensure_ascii=False))
    lines = ["#version: 0.2", *(" ".join(pair) for pair in pairs)]
    put("merges.txt", "\n".join(lines) + "\n")
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    added = [
        dict(
            id=i, content=s, single_word=False, lstrip=False, rstrip=False,
            normalized=False, special=True,
        )
        for i, s in enumerate(SPECIAL_TOKENS)
    ]
    bpe = dict(
        type="BPE", dropout=None, unk_token=SPECIAL_TOKENS[1], continuing_subword_prefix=None,
        end_of_word_suffix=None, fuse_unk=False, byte_fallback=False, ignore_merges=False,
        vocab=vocab, merges=pairs,
    )
    whole = dict(
        version="1.0", truncation=None, padding=None, added_tokens=added,
        normalizer={"type": "Sequence", "normalizers": [{"type": "NFC"}]},
        pre_tokenizer=byte_level, post_processor=None,
        decoder={**byte_level, "add_prefix_space": True}, model=bpe,
    )
    put("tokenizer.json", json.dumps(whole, ensure_ascii=False))
    if report is not None:
        put("tokenizer_config.json", json.dumps(report, ensure_ascii=False, indent=2))


def load_files(folder: str) -> BpeModel:
    """A model from ``vocab.json`` and ``merges.txt``."""
    folder = folder.rstrip("/")
    vocab = json.loads(files.read_bytes(f"{folder}/vocab.json"))
    byte_of = {c: b for b, c in enumerate(byte_chars())}
    tokens = [
        s.encode() if s in SPECIAL_TOKENS else bytes(byte_of[c] for c in s)
        for s in sorted(vocab, key=vocab.get)
    ]
    merges = []
    for line in files.read_bytes(f"{folder}/merges.txt").decode().splitlines():
        if line and not line.startswith("#version"):
            left, right = line.split(" ")
            merges.append((vocab[left], vocab[right], vocab[left + right]))
    return BpeModel(merges=merges, counts=[0] * len(merges), tokens=tokens)
