"""From kept documents to a tokenizer, an encoded dataset and its evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.operators.bpe import BpeModel, learn_bpe, word_counts
from inkmill.operators.codec import encode
from inkmill.operators.evaluation import evaluation_report, score_pairs, stream_pairs, window_pairs
from inkmill.operators.tokens import (
    append_eos,
    dataset_meta,
    encoded_totals,
    eos_id,
    random_starts,
    random_starts_by_split,
    token_windows,
    with_offsets,
)
from inkmill.sources import files, tokenbin, tokenizer_files
from inkmill.sources.corpus import corpus_size, limit_docs
from inkmill.staging import stage

# Windows of an evaluation: batches x windows of a batch, for the loss and for the accuracy.
DRAWS = {"loss": 200 * 32, "accuracy": 50 * 32}


@dataclass
class TokenDataset:
    """Encoded documents (ordinal, split, ids, n_tokens, start_offset), meta row, totals per split."""

    tokens: DataFrame
    meta: DataFrame
    model: BpeModel
    stats: DataFrame


def train_tokenizer(
    docs: DataFrame,
    vocab_size: int = 16_000,
    min_frequency: int = 2,
    limit: int | None = None,
    folder: str | None = None,
    source: str = "",
) -> BpeModel:
    """Tokenizer of the documents (ordinal, text) with a text, or of the first ``limit`` of them.

    With ``folder`` its files and a report (``source`` names the input) are published there, all
    or none; a folder that exists is an error, found before anything is learned.
    """
    if folder is not None and files.exists(folder):
        raise FileExistsError(folder)
    docs = docs.where(F.col("text") != "") if limit is None else limit_docs(docs, limit)
    model = learn_bpe(word_counts(docs), vocab_size, min_frequency)
    if folder is not None:
        report = tokenizer_files.tokenizer_report(corpus_size(docs), model, min_frequency, source)
        facts = report.first().asDict()
        files.publish(folder, lambda path: tokenizer_files.save_files(model, path, facts))
    return model


def encode_corpus(
    docs: DataFrame,
    model: BpeModel,
    block_size: int = 256,
    with_eos: bool = True,
    paths: dict[str, str] | None = None,
) -> TokenDataset:
    """Encode documents (ordinal, split, text) once and place them in their split's stream.

    Documents without text (null or empty) are only counted, as seen.

    The ids are shuffled once, into blocks of adjacent documents, and written with their
    offsets; sinks, windows and evaluation read that table.
    """
    eos = eos_id(model) if with_eos else None
    coded = encode(docs.select("ordinal", "split", "text"), model).select(
        "ordinal", "split", append_eos(F.col("ids"), eos).alias("ids"), F.length("text").alias("chars")
    )
    coded = stage(coded.withColumn("n_tokens", F.size("ids")), "tokens")
    tokens = coded.where("chars > 0").drop("chars")
    meta = dataset_meta(tokens, model.vocab_size, block_size, eos, paths or {})
    stats = encoded_totals(coded, ["split"])
    return TokenDataset(stage(with_offsets(tokens, keys=["split"]), "stream"), meta, model, stats)


def write_token_bins(
    dataset: TokenDataset, folder: str, shard_tokens: int = tokenbin.SHARD_TOKENS
) -> None:
    """``train``, ``val`` (streams in shards of ``shard_tokens``) and ``meta`` below ``folder``."""
    folder = folder.rstrip("/")
    meta = dataset.meta.first()
    for split in ("train", "val"):
        part = dataset.tokens.where(F.col("split") == split)
        n_tokens = meta[f"{split}_tokens"]
        tokenbin.write_stream(part, f"{folder}/{split}", meta["dtype"], n_tokens, shard_tokens)
    dataset.meta.coalesce(1).write.json(f"{folder}/meta", ignoreNullFields=False)


def evaluate_tokens(
    train: DataFrame,
    held_out: DataFrame,
    vocab_size: int,
    block_size: int,
    n_windows: int,
    seed: int = 0,
    add_k: float = 1.0,
) -> DataFrame:
    """Loss, perplexity and accuracy of a bigram model of ``train`` on random windows."""
    n_tokens = held_out.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    starts = random_starts(train.sparkSession, n_windows, n_tokens, block_size, seed)
    windows = token_windows(held_out, starts, block_size, n_windows)
    counts = stage(stream_pairs(train), "pairs")
    return evaluation_report(score_pairs(window_pairs(windows), counts, vocab_size, add_k), vocab_size)


def evaluate_splits(
    tokens: DataFrame,
    vocab_size: int,
    block_size: int,
    draws: dict[str, int] | None = None,
    seed: int = 0,
    add_k: float = 1.0,
) -> DataFrame:
    """The report of ``evaluate_tokens`` for each split and draw, with a bigram model of ``train``.

    ``tokens`` holds the streams of both splits (split, start_offset, n_tokens, ids). All windows
    are cut, scored and summed in one job, keyed by split and draw.
    """
    draws, keys = draws or DRAWS, ["split", "draw"]
    totals = tokens.groupBy("split").agg(F.sum("n_tokens").alias("n_tokens"))
    starts = random_starts_by_split(totals, draws, block_size, seed)
    windows = token_windows(tokens, starts, block_size, 2 * sum(draws.values()), keys=["split"])
    counts = stage(stream_pairs(tokens.where("split = 'train'")), "pairs")
    scored = score_pairs(window_pairs(windows, keys), counts, vocab_size, add_k, keys)
    return evaluation_report(scored, vocab_size, keys=keys)
