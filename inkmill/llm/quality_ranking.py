"""Quality scores by Bradley-Terry ranking of preference pairs.

Each text becomes a vector of layout and repetition features, binned at quantiles. Pairs of a
text labelled good and one labelled bad are preferences; the logistic loss on the difference of
their feature vectors gives one weight per bin. A text's utility is the sum of its weights. The
threshold is the quantile of the labelled texts' utilities at the share of bad labels; the
score is a logistic curve through 0.5 there, with the slope that fits the labels best.

Fitting takes a bounded sample of labelled rows (``FIT_ROWS`` per class, by a hash of doc_id)
and ``PAIRS`` pairs among them. Scoring reads whole texts; neither language, source nor id.

Defined cases: null and empty texts have all features 0 and get a score like any other. Several
labels of one doc_id count as their majority, ties as good; labels other than 0 and 1 are left
out. If the sample lacks a class, every score is 0.5. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.hashing import sampled
from inkmill.llm.worker import small_batches, worker_state

FIT_ROWS = 10_000
PAIRS = 200_000
BINS = 12
_STEPS = 300

# Classes of UTF-8 bytes.
_LOWER, _UPPER, _DIGIT, _BLANK, _NEWLINE, _SENTENCE, _SYMBOL, _HIGH = range(8)
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[9, 11, 12, 13, 32]] = _BLANK
_CLASS[10] = _NEWLINE
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = _SENTENCE
_CLASS[128:] = _HIGH
_BLOCK = 1 << 20


def features(text: str | None) -> list[float]:
    """Feature vector of a whole text."""
    raw = (text or "").encode("utf-8", "replace")
    counts = np.zeros(8)
    for part in range(0, len(raw), _BLOCK):
        block = np.frombuffer(raw[part : part + _BLOCK], np.uint8)
        counts += np.bincount(_CLASS[block], minlength=8)
    words = raw.split()
    lines = raw.split(b"\n")
    n, n_words, n_lines = max(len(raw), 1), max(len(words), 1), max(len(lines), 1)
    distinct = set(words)
    pairs = set(zip(words, words[1:]))
    letters = max(counts[_LOWER] + counts[_UPPER] + counts[_HIGH], 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    shouted = sum(map(bytes.isupper, words))
    plain = sum(map(bytes.isalpha, words))
    return [
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        *(counts / n),
        counts[_UPPER] / letters,
        counts[_SYMBOL] / n_words,
        counts[_SENTENCE] / n_words,
        counts[_DIGIT] / n_words,
        len(distinct) / n_words,
        len(distinct) / n_words**0.75,
        sum(map(eq, words, words[1:])) / n_words,
        len(pairs) / n_words,
        1 - len(set(lines)) / n_lines,
        float(np.log1p(n_lines)),
        n_words / n_lines,
        float(lengths.mean()) if len(words) else 0.0,
        float(lengths.std()) if len(words) else 0.0,
        float(lengths.max()) if len(words) else 0.0,
        float((lengths == 1).sum()) / n_words,
        shouted / n_words,
        plain / n_words,
        text.count(". ") / n_words if text else 0.0,
    ]


def feature_matrix(texts) -> np.ndarray:
    rows = [features(t) for t in texts]
    return np.array(rows, np.float64).reshape(len(rows), -1)


@dataclass
class QualityModel:
    edges: np.ndarray  # [feature, BINS - 1]
    weights: np.ndarray  # [feature, BINS]
    cut: float
    slope: float

    def utility(self, matrix: np.ndarray) -> np.ndarray:
        bins = binned(matrix, self.edges)
        return self.weights[np.arange(matrix.shape[1]), bins].sum(axis=1)

    def score(self, matrix: np.ndarray) -> np.ndarray:
        return logistic(self.slope * (self.utility(matrix) - self.cut))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def binned(matrix: np.ndarray, edges: np.ndarray) -> np.ndarray:
    columns = [np.searchsorted(e, c, side="left") for e, c in zip(edges, matrix.T)]
    return np.stack(columns, axis=1) if len(columns) else np.zeros(matrix.shape, int)


def rank_fit(good: np.ndarray, bad: np.ndarray, share_bad: float, pairs: int = PAIRS) -> QualityModel:
    """Weights from pairs of rows of the two feature matrices."""
    both = np.concatenate([good, bad])
    n_features = both.shape[1]
    edges = np.quantile(both, np.arange(1, BINS) / BINS, axis=0).T
    if not len(good) or not len(bad):
        return QualityModel(edges, np.zeros((n_features, BINS)), 0.0, 1.0)
    bins = binned(both, edges) + np.arange(n_features) * BINS
    one_hot = np.zeros((len(both), n_features * BINS), np.float32)
    np.put_along_axis(one_hot, bins, 1.0, axis=1)
    rng = np.random.default_rng(17)
    better = rng.integers(0, len(good), pairs)
    worse = len(good) + rng.integers(0, len(bad), pairs)
    weights = np.zeros(one_hot.shape[1])
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, _STEPS + 1):  # Adam on the mean loss
        utility = one_hot @ weights.astype(np.float32)
        missed = logistic(utility[worse] - utility[better])
        pull = np.bincount(worse, missed, len(both)) - np.bincount(better, missed, len(both))
        slope = (pull.astype(np.float32) @ one_hot) / pairs + 1e-4 * weights
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        weights -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    model = QualityModel(edges, weights.reshape(n_features, BINS), 0.0, 1.0)
    utility = model.utility(both)
    is_good = np.arange(len(both)) < len(good)
    weight = np.where(is_good, (1 - share_bad) / len(good), share_bad / len(bad))
    order = np.argsort(utility, kind="stable")
    reached = np.cumsum(weight[order])
    at = int(np.searchsorted(reached, share_bad))
    upper = utility[order[min(at + 1, len(order) - 1)]]
    model.cut = float((utility[order[min(at, len(order) - 1)]] + upper) / 2)
    slopes = np.geomspace(0.05, 20, 40)
    centred = utility - model.cut
    loss = [-(weight * np.log(logistic(s * np.where(is_good, centred, -centred)))).sum() for s in slopes]
    model.slope = float(slopes[int(np.argmin(loss))])
    return model


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Model from ``labels`` (doc_id, quality) and the texts of the sampled ids in ``docs``."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
    known = known.agg((F.avg("quality") >= 0.5).alias("good"))
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    sizes = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count("*").alias("n")).collect()}
    classes = {}
    for good in (True, False):
        n = sizes.get(good, 0)
        chosen = sampled(known.where(F.col("good") == good), n, fit_rows, "doc_id")
        classes[good] = chosen
    chosen = classes[True].unionByName(classes[False])  # about 2 * fit_rows ids at most
    found = texts.join(F.broadcast(chosen), "doc_id")

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_state("quality")  # frees what an operator before has kept
        for part in parts:
            rows = [features(t) for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "good": part["good"], "x": rows})

    rows = found.mapInPandas(measure, "doc_id long, good boolean, x array<double>")
    rows = rows.dropDuplicates(["doc_id"]).select("good", "x").toPandas()
    matrix = {g: np.array(list(rows["x"][rows["good"] == g]), float) for g in (True, False)}
    width = len(features(""))
    good, bad = (matrix[g].reshape(-1, width) for g in (True, False))
    if not len(good) and not len(bad):
        good = np.zeros((1, width))
    total = max(1, sizes.get(True, 0) + sizes.get(False, 0))
    return rank_fit(good, bad, sizes.get(False, 0) / total)


def quality_score(docs: DataFrame, model: QualityModel, text: str = "text") -> Column:
    """Score from 0 to 1 of the texts of ``docs``; 0.5 and more are good."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_state("quality")  # frees what an operator before has kept
        model = QualityModel(**shared.value)
        for texts in parts:
            yield pd.Series(model.score(feature_matrix(texts)) if len(texts) else [], dtype=float)

    return score(F.col(text))
