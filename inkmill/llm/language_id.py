"""Language identification: known words first, shorter and shorter character n-grams after.

A word of the model scores by its log frequency in each language. Any other word is cut into
character n-grams of the longest order of which the model knows at least one; it scores by
their mean log frequency. A document's language has the highest sum over its words and prior.

The model is fitted on a bounded sample of labelled rows (``FIT_ROWS``, chosen by a hash of
doc_id) and holds all their words and n-grams, as sorted 64-bit hashes beside a table of log
frequencies, so it is small and is read without being unpacked. Whole texts are scored.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text
if no labelled row has a letter. The score is the chosen language's posterior after at most
``EVIDENCE`` (or as asked) average words, so it does not saturate with length. Ties between languages go to
the first by name. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.hashing import sampled
from inkmill.llm.worker import small_batches, worker_state
from inkmill.staging import stage

FIT_ROWS = 10_000
ORDERS = (5, 4, 3, 2, 1)
EVIDENCE = 20
UNKNOWN = "und"
_CACHE = 250_000
_SMOOTHING = 0.5
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(chunk: str) -> list[str]:
    """Lower-case runs of letters; runs of mere numerals such as fractions are left out."""
    found = _LETTERS.findall(chunk.lower())
    return [w for w in found if any(map(str.isalpha, w))]


def grams_of(word: str, order: int) -> list[str]:
    """N-grams of the word between end marks; the unigrams leave out the marks."""
    marked = word if order == 1 else f"<{word}>"
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


class Spans:
    """64-bit hashes of words and of their character n-grams.

    Words stand one after another, each between end marks. Prefix sums of the characters times
    rising powers give the hash of any stretch as a difference, brought back to power zero.
    """

    def __init__(self, words: list[str]) -> None:
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        joined = "".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(joined, np.uint32).astype(np.uint64) + np.uint64(1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _powers(_BASE, len(codes))[:-1])])
        self.back = _powers(_INVERSE, len(codes))
        self.starts = np.cumsum(self.sizes + 2) - self.sizes - 1  # behind the first mark

    def hashes(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        value = (self.sums[at + length] - self.sums[at]) * self.back[at]
        value ^= value >> np.uint64(29)
        return value * np.uint64(0x9E3779B97F4A7C15)

    def words(self) -> np.ndarray:
        return self.hashes(self.starts, self.sizes)

    def grams(self, order: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``which`` and hash of each n-gram of those words; unigrams leave out the marks."""
        extra = 0 if order == 1 else 2
        number = np.maximum(self.sizes[which] + extra - order + 1, 0)
        owner = np.repeat(np.arange(len(which)), number)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        return owner, self.hashes((self.starts[which] - extra // 2)[owner] + nth, order)


@dataclass
class LanguageModel:
    """``keys`` and ``tables`` per order (0: whole words): sorted hashes and their log
    frequencies in each language."""

    languages: list[str]
    prior: np.ndarray
    keys: dict[int, np.ndarray]
    tables: dict[int, np.ndarray]

    def _rows(self, order: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Table rows of the hashes, and whether the model knows them."""
        keys = self.keys[order]
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return at, keys[at] == hashes

    @property
    def grams(self) -> KnownGrams:
        return KnownGrams(self)

    def rows_of(self, word: str) -> list[tuple[int, int]]:
        """Order and table row of the entries whose mean is the word's score; [] if it has none."""
        spans = Spans([word])
        at, known = self._rows(0, spans.words())
        if known.any():
            return [(0, int(at[0]))]
        for order in ORDERS:
            _, hashes = spans.grams(order, np.zeros(1, np.int64))
            rows, found = self._rows(order, hashes)
            if found.any():
                return [(order, int(i)) for i in rows[found]]
        return []

    def score_words(self, words: list[str]) -> np.ndarray:
        """Score of each word per language: its log frequency, else that of its n-grams."""
        spans = Spans(words)
        out = np.zeros((len(words), len(self.languages)))
        at, known = self._rows(0, spans.words())
        out[known] = self.tables[0][at[known]]
        left = np.flatnonzero(~known)
        for order in ORDERS:
            if not len(left):
                break
            owner, hashes = spans.grams(order, left)
            at, known = self._rows(order, hashes)
            owner, at = owner[known], at[known]
            hits = np.bincount(owner, minlength=len(left))
            values, found = self.tables[order][at], hits > 0
            for lang in range(len(self.languages)):
                total = np.bincount(owner, values[:, lang], len(left))
                out[left[found], lang] = total[found] / hits[found]
            left = left[~found]
        return out


class KnownGrams:
    """The n-grams of a model; it keeps their hashes only, so one can ask for an n-gram but not list them."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model

    def __contains__(self, gram: str) -> bool:
        if len(gram) not in self.model.keys or not gram:
            return False
        return bool(self.model._rows(len(gram), Spans([gram]).words())[1].any())


class ChunkScores:
    """Summed word scores, and the number of words, of the chunks between spaces seen so far."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.width = len(model.languages) + 1
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((0, self.width))

    def add(self, chunks: list[str]) -> None:
        found = [words_of(chunk) for chunk in chunks]
        n_words = np.fromiter(map(len, found), np.int64, len(found))
        owner = np.repeat(np.arange(len(chunks)), n_words)
        scores = self.model.score_words([w for words in found for w in words])
        fresh = np.zeros((len(chunks), self.width))
        for lang in range(self.width - 1):
            fresh[:, lang] = np.bincount(owner, scores[:, lang], len(chunks))
        fresh[:, -1] = n_words
        first = len(self.table)
        self.place.update((chunk, first + i) for i, chunk in enumerate(chunks))
        self.table = np.concatenate([self.table, fresh])

    def total(self, chunks: list[str]) -> np.ndarray:
        """Sums over the chunks of one text, in blocks that bound what a long one needs."""
        out = np.zeros(self.width)
        for part in range(0, len(chunks), _CACHE):
            block = chunks[part : part + _CACHE]
            if len(self.place) > _CACHE:
                self.clear()
            new = list({c for c in block if c not in self.place})
            if new:
                self.add(new)
            out += self.table[[self.place[c] for c in block]].sum(axis=0)
        return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_state("language fit")  # frees what an operator before has kept
    counts: Counter[tuple[str, str]] = Counter()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([k[0] for k in counts], pa.string()),
                "word": pa.array([k[1] for k in counts], pa.string()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )
        counts.clear()
        return batch

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            for word, n in Counter(words_of(text)).items():
                counts[lang, word] += n
            if len(counts) > _CACHE:
                yield flush()
    yield flush()


def _key_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (order 0) and n-grams by their hashes, of rows lang, word, n."""
    for batch in batches:
        langs, lang_at = np.unique(np.array(batch["lang"].to_pylist(), object), return_inverse=True)
        spans = Spans(batch["word"].to_pylist())
        n, every = batch["n"].to_numpy(), np.arange(batch.num_rows)
        for order in (0, *ORDERS):
            owner, hashes = (every, spans.words()) if order == 0 else spans.grams(order, every)
            for i, lang in enumerate(langs):
                own = lang_at[owner] == i
                keys, place = np.unique(hashes[own], return_inverse=True)
                counts = np.zeros(len(keys), np.int64)
                np.add.at(counts, place, n[owner[own]])
                columns = [pa.array([lang] * len(keys), pa.string()), pa.array(np.full(len(keys), order, np.int32))]
                columns += [pa.array(keys.view(np.int64)), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "order", "key", "n"])


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> LanguageModel:
    """Model of the rows of ``labelled`` (doc_id, text, lang) with neither text nor lang null."""
    small_batches(labelled.sparkSession)
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    rows = sampled(rows, rows.count(), fit_rows, "doc_id")
    counted = rows.select("lang", "text").mapInArrow(_word_counts, "lang string, word string, n long")
    words = stage(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang-words")
    keys = words.mapInArrow(_key_counts, "lang string, order int, key long, n long")
    keys = keys.groupBy("lang", "order", "key").agg(F.sum("n").alias("n"))
    found = keys.select("lang", "order", "key", "n").toArrow()  # what a bounded sample holds
    docs = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(set(found["lang"].unique().to_pylist()))
    if not languages:
        return LanguageModel([], np.zeros(0), {}, {})
    place = pc.index_in(found["lang"], pa.array(languages)).to_numpy()
    order, key, n = (found[c].to_numpy() for c in ("order", "key", "n"))
    model_keys, tables = {}, {}
    for o in (0, *ORDERS):
        own = order == o
        known, at = np.unique(key[own].view(np.uint64), return_inverse=True)
        counts = np.zeros((len(known), len(languages)))
        counts[at, place[own]] = n[own]
        base = counts.sum(axis=0) + _SMOOTHING * max(1, len(known))
        model_keys[o], tables[o] = known, np.log((counts + _SMOOTHING) / base).astype(np.float32)
    share = np.array([docs[lang] for lang in languages], float)
    return LanguageModel(languages, np.log(share / share.sum()), model_keys, tables)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", evidence: int = EVIDENCE) -> Column:
    """Struct of lang_pred and score for the texts of ``docs``.

    ``evidence``: number of average words the score rests on. The fewer, the lower the score of
    a text whose words speak for several languages.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    token = uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache = worker_state("language")
        if cache.get("token") != token:
            cache.clear()
            cache |= {"token": token, "scores": ChunkScores(LanguageModel(**shared.value))}
        scores_of = cache["scores"]
        model = scores_of.model
        for texts in parts:
            names, scores = [], []
            texts = texts.tolist()
            for part in range(0, len(texts), 64):
                block = [t.split() if t and model.languages else [] for t in texts[part : part + 64]]
                if sum(map(len, block)) <= _CACHE:  # new chunks of many texts at once
                    if len(scores_of.place) > _CACHE:
                        scores_of.clear()
                    known = scores_of.place
                    if new := list({c for chunks in block for c in chunks if c not in known}):
                        scores_of.add(new)
                for chunks in block:
                    total = scores_of.total(chunks) if chunks else np.zeros(1)
                    n = total[-1]
                    if not n:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    likely = total[:-1] + model.prior
                    best = int(np.argmax(likely))
                    mild = total[:-1] * (min(n, evidence) / n) + model.prior
                    weights = np.exp(mild - mild.max())
                    names.append(model.languages[best])
                    scores.append(float(weights[best] / weights.sum()))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predict(F.col(text))
