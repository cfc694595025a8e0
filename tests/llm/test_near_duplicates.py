import random

import numpy as np
import pyarrow as pa
import pytest

from inkmill.llm import superminhash as op
from inkmill.llm.components import components
from inkmill.llm.worker import worker_state


def word_set(text, words=4):
    parts = (text or "").encode().lower().split()
    if not parts:
        return frozenset()
    n = min(words, len(parts))
    return frozenset(tuple(parts[i : i + n]) for i in range(len(parts) - n + 1))


def brute(rows):
    """doc_id -> (set size, component) by comparing all pairs."""
    ids = [i for i, _ in rows]
    sets = {i: word_set(t) for i, t in rows}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= 80 * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def found(docs):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op.near_duplicates(docs, 4).collect()}


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_against_all_pairs(make_docs):
    rng = random.Random(5)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 300))]
        for _ in range(rng.randrange(1, 12)):
            rows.append((len(rows), edited(base, rng.choice([0, 0, 1, 2, 4, 8, 16]), rng)))
    shared = " ".join(f"s{i}" for i in range(60))  # a passage in many otherwise different texts
    for i in range(60):
        rows.append((len(rows), shared + " " + " ".join(f"u{i}x{j}" for j in range(80))))
    rng.shuffle(rows)
    assert found(make_docs(rows)) == brute(rows)


def test_small_sets_lose_no_link(make_docs):
    rng = random.Random(8)
    fresh = iter(f"n{i}" for i in range(10**6))
    rows = []

    def add(words):
        rows.append((len(rows), " ".join(words)))

    for _ in range(2000):  # 4 of 5 shingles shared: just similar enough
        words = [next(fresh) for _ in range(8)]
        add(words)
        add(rng.choice([words[1:], words[:-1]]))
    for n in range(4, 21):  # one more or one less word at either end, a word replaced there
        for _ in range(60):
            words = [next(fresh) for _ in range(n + 3)]
            add(words)
            add(words[rng.randrange(2) : n + 3 - rng.randrange(3)])
            add([*words[:-1], next(fresh)])
    stem = [next(fresh) for _ in range(7)]
    for _ in range(300):  # one key of very many sets, of which none are similar but to the stem
        add([*stem, next(fresh)])
    add(stem)
    rng.shuffle(rows)
    assert found(make_docs(rows)) == brute_by_word(rows)


def brute_by_word(rows):
    """Like ``brute``, comparing only texts that share a shingle."""
    sets = {i: word_set(t) for i, t in rows}
    holders = {}
    for i, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, own in sets.items():
        for y in {y for shingle in own for y in holders[shingle] if y > x}:
            if 100 * len(own & sets[y]) >= 80 * len(own | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("size", [10, 15, 20, 40])
def test_bands_rarely_miss_at_the_threshold(size):
    rng = np.random.default_rng(size)
    n = 3000
    x = rng.integers(0, 2**63, (n, size + size // 4)).astype(np.uint64)  # similarity 0.8
    both, odd = x[:, :size], size // 8
    a, b = np.concatenate([both, x[:, size : size + odd]], axis=1), np.concatenate([both, x[:, size + odd :]], axis=1)
    left, right = op.band_keys(op.signatures(list(a))), op.band_keys(op.signatures(list(b)))
    lost = int((~(left == right).any(axis=1)).sum())
    assert lost <= 3  # 4e-5 of 3,000 are 0.12


def test_chain_and_large_group(make_docs):
    rng = random.Random(6)
    words = [f"c{i}" for i in range(200)]
    rows = []
    for step in range(30):  # each text is close to the next, the ends are far apart
        rows.append((step, " ".join(words)))
        for k in range(4):
            words[(step * 4 + k) % 200] = f"d{step}x{k}"
    base = [f"g{i}" for i in range(150)]
    for i in range(150):
        rows.append((1000 + i, edited(base, rng.randrange(0, 6), rng)))
    assert found(make_docs(rows)) == brute(rows)


def test_defined_cases(make_docs):
    rows = [
        (5, None),
        (3, ""),
        (4, " \n\t"),
        (9, "Word"),
        (2, "word"),
        (7, "a b c"),
        (6, "A  B\nC"),
        (8, "a b c d"),
        (11, "é x"),
        (12, "É x"),  # only A-Z is folded
        (20, "long " * 40_000 + "end"),
        (21, "LONG " * 30_000 + "end"),
    ]
    got = found(make_docs(rows))
    assert got == brute(rows)
    assert found(make_docs([])) == {}


def test_repeated_rows_and_null_ids(make_docs):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (4, "a b c d e f")]
    got = op.near_duplicates(make_docs(rows), 4).collect()
    assert len(got) == 5
    assert sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in got) == [
        (-1, None, True),
        (-1, None, True),
        (1, 1, True),
        (1, 1, True),
        (4, 1, False),
    ]


@pytest.mark.parametrize("similarity", [0.5, 0.8])
def test_signature_estimates_similarity(similarity):
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(200):
        union, both = 200, int(200 * similarity)
        x = rng.integers(0, 2**63, union).astype(np.uint64)
        cut = both + (union - both) // 2
        a, b = op.signatures([x[:cut], np.concatenate([x[:both], x[cut:]])])
        errors.append((a == b).mean() - similarity)
    plain = (similarity * (1 - similarity) / op.PLACES) ** 0.5
    assert abs(np.mean(errors)) < 0.005
    assert np.std(errors) < plain  # less than independent permutations give


def test_blocks_do_not_change_results(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(n)) for n in (3, 50, 900, 4000)]
    texts += ["x" * 3000 + " y " + "z" * 70]
    sets = op.shingle_sets_of(texts, 4)
    signed = op.signatures(sets)
    monkeypatch.setattr(op, "_BYTES", 500)
    monkeypatch.setattr(op, "_BLOCK", 256)
    again = op.shingle_sets_of(texts, 4)
    assert all((a == b).all() for a, b in zip(sets, again))
    assert (op.signatures(again) == signed).all()
    assert [len(s) for s in sets] == [len(word_set(t)) for t in texts]


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 300)]  # a path
    links += [(1000, 1001 + i) for i in range(200)]  # a star
    links += [(5000 - i, 5000) for i in range(1, 100)]  # a star around its largest node
    links += [(rng.randrange(9000, 9100), rng.randrange(9000, 9100)) for _ in range(80)]
    links += [(7, 7)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {i: find(i) for i in root}


@pytest.mark.parametrize("step", [op.sketch, op.shingle_sets])
def test_tasks_free_what_other_operators_keep(spark, step):
    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, kind):
            return run

    kept = worker_state("language")
    kept["model"] = np.zeros(10)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "text": ["a b c d e f"]})
    assert [part.num_rows for part in step(Docs(), 5)(iter([batch]))] == [1]
    assert worker_state("language") == {}
