"""Toxicity scores from subword embeddings and a linear softmax.

A word is a run of letters and digits of the lower-cased text. Its vector is the mean of the
embeddings of its character n-grams (3 to 5, with marks at both ends) and of the whole word. A
text's vector is the mean of its words' vectors, each weighted by the square root of its count,
and of ``BLANK_WORDS`` zero vectors, so that no few unseen or repeated words decide a text. A
linear softmax over it gives the two classes. Embeddings and softmax are trained jointly, by
Adam on the class-weighted cross entropy, with weight decay. N-grams share ``BUCKETS`` hashed rows, so a misspelling never seen before gets most of
the vector of the word it comes from.

The loss is that of a bounded sample of labelled rows (``FIT_ROWS`` per class, by a hash of
doc_id); tasks turn the sampled texts into at most ``BUCKETS`` shares each, so no text comes to
the driver. Scoring reads whole texts and sees neither labels, language, source nor id.

Defined cases: a null text or one without a word has the zero vector, hence the score of the
bias alone, which is held at that of the class weights, below 0.5. Several labels of one doc_id
count as their majority, ties as toxic; labels other than 0 and 1 and null ids are left out. If
the sample lacks a class every score is 0 (no toxic row) or 1 (only toxic rows); without any label
it is 0. Repeated rows get equal scores. Of an input's columns only those named are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.hashing import sampled
from inkmill.llm.worker import small_batches, worker_state

FIT_ROWS = 2_500
BUCKETS = 1 << 16
DIM = 8
GRAMS = (3, 4, 5)
EPOCHS = 8  # more for a small sample, up to STEPS batches
STEPS = 500
BATCH = 128
RATE = 0.03
DECAY = 0.1
BLANK_WORDS = 100
# Means over a whole text are small; a fixed factor brings them to the scale of the weights.
SCALE = 32.0
_REMEMBERED = 400_000
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word number and bucket of every subword of ``words``, whole words included."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.uint64)
    ends = np.cumsum(sizes)
    word_at = np.repeat(np.arange(len(words)), sizes)
    left = ends[word_at] - np.arange(len(codes))  # characters from here to the end of the word
    owners = [np.arange(len(words))]
    hashes = [np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.uint64, len(words))]
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        rolling = rolling[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in GRAMS:
            inside = np.flatnonzero(left[: len(rolling)] >= n)
            owners.append(word_at[inside])
            hashes.append(rolling[inside] + np.uint64(n))
    mixed = np.concatenate(hashes) * np.uint64(0x9E3779B97F4A7C15)
    return np.concatenate(owners), (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS


def shares(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares, which add up to less than 1."""
    counts = Counter(words_of(text))
    if not counts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    owner, bucket = subwords(list(counts))
    each = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)))
    each /= each.sum() + BLANK_WORDS
    total = np.bincount(bucket, (each / np.bincount(owner))[owner], BUCKETS)
    used = np.flatnonzero(total)
    return used.astype(np.int32), total[used].astype(np.float32)


@dataclass
class ToxicityModel:
    """``embeddings`` [BUCKETS, DIM], ``weights`` [DIM, 2] and ``bias`` [2]."""

    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def margins(self) -> tuple[np.ndarray, float]:
        """Logit difference of the classes per bucket, and of the biases.

        Means and the softmax's input are linear, so a text's margin is the mean of its words'
        margins, and a word's that of its subwords'.
        """
        apart = self.weights[:, 1] - self.weights[:, 0]
        return SCALE * (self.embeddings @ apart).astype(np.float64), float(self.bias[1] - self.bias[0])


def constant(score: float) -> ToxicityModel:
    margin = 200.0 * score - 100.0
    flat = np.zeros((BUCKETS, DIM), np.float32)
    return ToxicityModel(flat, np.zeros((DIM, 2)), np.array([0.0, margin]))


def train(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, share_toxic: float) -> ToxicityModel:
    """Model of sampled texts (buckets and scaled shares), weighted to the labels' true share."""
    toxic = np.asarray(toxic, bool)
    if toxic.all() or not toxic.any():
        return constant(1.0 if len(toxic) and toxic.all() else 0.0)
    each = np.where(toxic, share_toxic / toxic.sum(), (1 - share_toxic) / (~toxic).sum()) * len(rows)
    sizes = np.array([len(b) for b, _ in rows])
    rng = np.random.default_rng(29)
    params = [
        (rng.standard_normal((BUCKETS, DIM)) * 0.05).astype(np.float32),
        (rng.standard_normal((DIM, 2)) * 0.5).astype(np.float32),
    ]
    # The bias stays at the log share of the classes: a text that says nothing gets their odds.
    bias = np.log([1 - share_toxic, share_toxic])
    means = [np.zeros_like(p) for p in params]
    squares = [np.zeros_like(p) for p in params]
    step, epochs = 0, max(EPOCHS, -(-STEPS * BATCH // len(rows)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            picked = order[at : at + BATCH]
            step += 1
            bucket = np.concatenate([rows[i][0] for i in picked])
            weight = np.concatenate([rows[i][1] for i in picked]).astype(np.float32)
            owner = np.repeat(np.arange(len(picked)), sizes[picked])
            embeddings, softmax = params
            found = embeddings[bucket] * weight[:, None]
            vector = np.stack([np.bincount(owner, found[:, k], len(picked)) for k in range(DIM)], 1)
            logit = vector @ softmax + bias
            logit -= logit.max(1, keepdims=True)
            chance = np.exp(logit) / np.exp(logit).sum(1, keepdims=True)
            missed = chance - np.stack([~toxic[picked], toxic[picked]], 1)
            missed *= (each[picked] / len(picked))[:, None]
            back = (missed @ softmax.T).astype(np.float32)
            down = back[owner] * weight[:, None]
            slope = np.stack([np.bincount(bucket, down[:, k], BUCKETS) for k in range(DIM)], 1)
            slopes = [slope.astype(np.float32), (vector.T @ missed).astype(np.float32)]
            for param, mean, square, slope in zip(params, means, squares, slopes):
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope * slope - square)
                fair = np.sqrt(square / (1 - 0.99**step)) + 1e-4
                param -= (rate / (1 - 0.9**step)) * mean / fair
            embeddings *= 1 - rate * DECAY
    return ToxicityModel(params[0], params[1].astype(np.float64), bias)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Model from ``labels`` (doc_id, toxic) and the texts of the sampled ids in ``docs``."""
    small_batches(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id")
    known = known.agg((F.avg("toxic") >= 0.5).alias("is_toxic"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    sizes = {r["is_toxic"]: r["n"] for r in known.groupBy("is_toxic").agg(F.count("*").alias("n")).collect()}
    classes = [
        sampled(known.where(F.col("is_toxic") == c), sizes.get(c, 0), fit_rows, "doc_id") for c in (True, False)
    ]
    chosen = classes[0].unionByName(classes[1])  # about 2 * fit_rows ids
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            pairs = [shares(t) for t in part["text"]]
            packed = {  # four bytes a bucket; shares scaled, so that half floats hold them
                "bucket": [b.astype(np.uint16).tobytes() for b, _ in pairs],
                "share": [(s * SCALE).astype(np.float16).tobytes() for _, s in pairs],
            }
            yield pd.DataFrame({"doc_id": part["doc_id"], "is_toxic": part["is_toxic"], **packed})

    schema = "doc_id long, is_toxic boolean, bucket binary, share binary"
    rows = found.mapInPandas(measure, schema).groupBy("doc_id", "is_toxic")
    # Rows that repeat an id: the texts' smallest bytes, so that the choice is always the same.
    rows = rows.agg(F.min(F.struct("bucket", "share")).alias("x")).select("doc_id", "is_toxic", "x.*")
    rows = sorted(rows.collect(), key=lambda r: r["doc_id"])
    pairs = [(np.frombuffer(r["bucket"], np.uint16), np.frombuffer(r["share"], np.float16)) for r in rows]
    total = sum(sizes.values())
    return train(pairs, np.array([r["is_toxic"] for r in rows], bool), sizes.get(True, 0) / max(total, 1))


class Scorer:
    """Scores texts; remembers the margins of words it has met."""

    def __init__(self, margins: np.ndarray, bias: float) -> None:
        self.margins, self.bias = margins, bias
        self.known: dict[str, float] = {}

    def learn(self, words: Iterable[str]) -> None:
        words = sorted(words)
        if not words:
            return
        owner, bucket = subwords(words)
        mean = np.bincount(owner, self.margins[bucket], len(words)) / np.bincount(owner)
        self.known.update(zip(words, mean.tolist()))

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        margins = []
        for text in texts:
            words = Counter(words_of(text))
            if len(self.known) > _REMEMBERED:
                self.known.clear()
            self.learn(w for w in words if w not in self.known)
            found = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
            weight = np.sqrt(np.fromiter(words.values(), np.float64, len(words)))
            margins.append(self.bias + float(found @ weight) / (weight.sum() + BLANK_WORDS))
        return 1 / (1 + np.exp(-np.clip(np.array(margins, float), -40, 40)))


def toxicity_score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> Column:
    """Score from 0 to 1 of the texts of ``docs``; 0.5 and more are toxic."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.margins())
    name = f"toxicity-{zlib.crc32(model.embeddings.tobytes())}-{model.bias[1]}"

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        state = worker_state(name)
        if "scorer" not in state:
            state["scorer"] = Scorer(*shared.value)
        for texts in parts:
            yield pd.Series(state["scorer"].score(texts), dtype=float)

    return score(F.col(text))
