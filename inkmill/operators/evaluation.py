"""Scoring a token table: bigram model, cross-entropy, perplexity, accuracy, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stream_pairs(tokens: DataFrame) -> DataFrame:
    """Counts of adjacent tokens (prev, next) in the stream, document borders included.

    ``tokens`` has ``start_offset`` and ``ids``. Pairs inside a document come from its own
    array; at a border the last token meets the first of the document that starts where
    this one ends.
    """
    tokens = tokens.where(F.size("ids") > 0)
    size = F.size("ids")
    # The next token is looked up by its place, so no array of pairs is made.
    inner = tokens.select("ids", F.posexplode("ids").alias("i", "prev")).where(F.col("i") < size - 1)
    inner = inner.select("prev", F.get("ids", F.col("i") + 1).alias("next"))
    ends = tokens.select(
        (F.col("start_offset") + size).alias("border"), F.get("ids", size - 1).alias("prev")
    )
    begins = tokens.select(F.col("start_offset").alias("border"), F.get("ids", F.lit(0)).alias("next"))
    border = ends.join(begins, "border").select("prev", "next")
    pairs = inner.unionByName(border)
    return pairs.groupBy("prev", "next").agg(F.count("*").alias("n"))


def window_pairs(windows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts of (context token, target) over windows ``x``, ``y``, per key."""
    keys = keys or []
    pairs = windows.select(*keys, F.explode(F.arrays_zip("x", "y")).alias("p"))
    pairs = pairs.select(*keys, F.col("p.x").alias("prev"), F.col("p.y").alias("next"))
    return pairs.groupBy(*keys, "prev", "next").agg(F.count("*").alias("n"))


def score_pairs(
    targets: DataFrame,
    train: DataFrame,
    vocab_size: int,
    add_k: float = 1.0,
    keys: list[str] | None = None,
) -> DataFrame:
    """Score distinct (prev, next) targets with a smoothed bigram model.

    ``targets`` (per key) and ``train`` hold each pair once with its count ``n``, so neither join side
    has a repeated key and a very frequent token makes no skewed task. Returns the keys, prev, next,
    n, logprob and the predicted token (most frequent follower, smaller id on ties; for an
    unseen context the most frequent token).
    """
    follower = F.max(F.struct(F.col("n"), (-F.col("next")).alias("minus_next")))
    contexts = train.groupBy("prev").agg(
        F.sum("n").alias("context_n"), (-follower["minus_next"]).alias("predicted")
    )
    unigram = train.groupBy("next").agg(F.sum("n").alias("n"))
    best = unigram.orderBy(F.desc("n"), "next").limit(1).first()
    fallback = F.lit(None if best is None else best["next"]).cast("int")
    seen = train.select("prev", "next", F.col("n").alias("pair_n"))
    joined = targets.join(seen, ["prev", "next"], "left").join(contexts, "prev", "left")
    pair_n = F.coalesce("pair_n", F.lit(0))
    context_n = F.coalesce("context_n", F.lit(0))
    probability = (pair_n + F.lit(float(add_k))) / (context_n + F.lit(float(add_k * vocab_size)))
    return joined.select(
        *(keys or []),
        "prev",
        "next",
        "n",
        F.log(probability).alias("logprob"),
        F.coalesce("predicted", fallback).alias("predicted"),
    )


def evaluation_report(
    scored: DataFrame, vocab_size: int, target: str = "next", keys: list[str] | None = None
) -> DataFrame:
    """Loss, perplexity, gain over uniform and top-1 accuracy (percent), per key.

    ``scored`` has the target, ``logprob``, ``predicted`` and optionally a weight ``n``.
    """
    n = F.col("n") if "n" in scored.columns else F.lit(1)
    hit = F.when(F.col("predicted") == F.col(target), n).otherwise(0)
    sums = scored.groupBy(*(keys or [])).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("tokens"),
        (F.sum(-F.col("logprob") * n) / F.sum(n)).alias("loss"),
        F.coalesce(F.sum(hit), F.lit(0)).alias("correct"),
    )
    perplexity = F.exp("loss")
    return sums.select(
        *(keys or []),
        "tokens",
        "loss",
        perplexity.alias("perplexity"),
        (F.lit(float(vocab_size)) / perplexity).alias("gain_over_uniform"),
        F.when(F.col("tokens") > 0, F.lit(100.0) * F.col("correct") / F.col("tokens"))
        .otherwise(0.0)
        .alias("accuracy"),
    )


def top_k_distribution(
    logits: DataFrame, temperature: float = 1.0, top_k: int | None = None
) -> DataFrame:
    """Next-token probabilities per ``context`` after temperature and top-k.

    Ties with the k-th largest logit stay in. A context has at most one row per vocabulary
    entry, which bounds the window.
    """
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    scaled = logits.withColumn("scaled", F.col("logit") / F.lit(float(temperature)))
    if top_k is not None:
        ranked = Window.partitionBy("context").orderBy(F.desc("scaled"))
        scaled = scaled.withColumn("_rank", F.rank().over(ranked))
        scaled = scaled.where(F.col("_rank") <= top_k).drop("_rank")
    whole = Window.partitionBy("context")
    weight = F.exp(F.col("scaled") - F.max("scaled").over(whole))
    return (
        scaled.withColumn("_weight", weight)
        .withColumn("probability", F.col("_weight") / F.sum("_weight").over(whole))
        .drop("_weight", "scaled")
    )
