"""Toxicity: the shortcut sums against plain averages, defined cases, unseen misspellings."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkmill.llm import toxicity as tx

INSULTS = ["blockhead", "nincompoop", "scoundrel", "dunderhead"]


def misspelt(word, rng):
    at = rng.randrange(1, len(word) - 1)
    return word[:at] + rng.choice("aeiou") + word[at:]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    stems = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(80)]
    made = []
    for i in range(400):
        words = rng.choices(stems, k=rng.randint(15, 120))
        if i % 4 == 0:
            for _ in range(1 + len(words) // 15):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        made.append((i, " ".join(words), int(i % 4 == 0)))
    return made


@pytest.fixture(scope="module")
def model(spark, rows):
    docs = spark.createDataFrame([(i, t, 9, "s") for i, t, _ in rows], "doc_id long, text string, toxic int, score string")
    labels = [(i, x) for i, _, x in rows if i % 5] + [(None, 1), (9999, 1), (3, None), (4, 7), (1, 0)]
    return tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))


def plain_score(model, text):
    """Word by word and n-gram by n-gram, through both logits."""
    counts = {}
    for w in tx.words_of(text):
        counts[w] = counts.get(w, 0) + 1
    vector, total = np.zeros(tx.DIM), 0.0
    for word, n in counts.items():
        _, bucket = tx.subwords([word])
        marked = f"<{word}>"
        assert len(bucket) == 1 + sum(max(0, len(marked) - n + 1) for n in tx.GRAMS)
        vector += n**0.5 * model.embeddings[bucket].astype(float).mean(axis=0)
        total += n**0.5
    logits = tx.SCALE * vector / (total + tx.BLANK_WORDS) @ model.weights + model.bias
    return np.exp(logits[1]) / np.exp(logits).sum()


def scores(make_docs, model, texts):
    docs = make_docs(list(enumerate(texts)))
    found = docs.select("doc_id", tx.toxicity_score(docs, model).alias("score")).collect()
    return [r["score"] for r in sorted(found, key=lambda r: r["doc_id"])]


def test_scores_and_held_out_rows(make_docs, model, rows):
    held = [r for r in rows if r[0] % 5 == 0]
    got = scores(make_docs, model, [t for _, t, _ in held])
    assert np.mean([(s >= 0.5) == bool(x) for s, (_, _, x) in zip(got, held)]) >= 0.97
    for score, (_, text, _) in zip(got, held):
        assert abs(score - plain_score(model, text)) < 1e-6


def test_unseen_misspellings(make_docs, model, rows):
    rng = random.Random(9)
    seen = {w for _, t, _ in rows for w in tx.words_of(t)}
    changed = [misspelt(w, rng) for w in INSULTS * 10]
    assert not seen & set(changed)
    clean = next(t for _, t, x in rows if not x)
    base, *rest = scores(make_docs, model, [clean, *(clean + f" {w} {w.upper()}!" * 3 for w in changed)])
    assert base < 0.5 and np.mean([s > base for s in rest]) == 1.0


def test_defined_cases(make_docs, model):
    texts = [None, "", " .,; ", "a", "blockhead " * 60_000, "x" * 200_000, "same text", "same text"]
    got = scores(make_docs, model, texts)
    assert got[0] == got[1] == got[2] < 0.5
    assert got[4] >= 0.5 and all(0 <= s <= 1 for s in got) and got[6] == got[7]
    assert scores(make_docs, model, []) == []


def test_missing_classes(spark, make_docs):
    docs = make_docs([(1, "one text"), (2, "another text")])
    for labels, score in (([], 0), ([(1, 0)], 0), ([(1, 1), (2, 1)], 1), ([(None, 1)], 0)):
        model = tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = [r[0] for r in docs.select(tx.toxicity_score(docs, model)).collect()]
        assert [round(s) for s in got] == [score, score]


def test_repeated_ids_and_votes(spark, make_docs):
    docs = make_docs([(1, "b"), (1, "a"), (2, "c"), (3, "d")])
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (3, 0), (3, 1)], "doc_id long, toxic int")
    found = []
    original, tx.train = tx.train, lambda rows, toxic, share: found.append((toxic.tolist(), share)) or tx.constant(0.0)
    try:
        tx.fit(docs, labels)
    finally:
        tx.train = original
    assert found == [([True, False, False], 1 / 3)]
