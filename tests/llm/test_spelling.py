"""Spelling variants against all pairs in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from inkmill.llm import spelling_variants as sv

SCHEMA = "doc_id long, text string, word string, n long, form string, length long"


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows):
    words = brute_words(rows)
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def noisy_rows(seed, letters="abcdeé", stems=30, docs=60):
    rng = random.Random(seed)
    names = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(stems)]
    weight = [1 + 400 // (i + 1) for i in range(stems)]
    rows = []
    for doc_id in range(docs):
        words = []
        for name in rng.choices(names, weight, k=200):
            while rng.random() < 0.3:
                at = rng.randrange(len(name))
                change = rng.choice([0, 1, 2])
                name = name[:at] + rng.choice(letters) * (change > 0) + name[at + (change < 2) :]
            words.append(name if rng.random() < 0.9 else name.upper())
        rows.append((doc_id, " ".join(words)))
    return rows


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "clash", 1, None, 2) for i, t in rows], SCHEMA).repartition(3)

    return make


def result(docs):
    got = sv.variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return [tuple(r) for r in got.collect()]


@pytest.mark.parametrize("cell, leaf", [(8_192, 24), (40, 3)])
def test_variants_against_brute_force(table, monkeypatch, cell, leaf):
    """Also with many small cells, so that coarse trees and routing decide."""
    monkeypatch.setattr(sv, "CELL", cell)
    monkeypatch.setattr(sv, "LEAF", leaf)
    rows = noisy_rows(1) + [(None, "wordless Wordless WORDLESS wordless wordless"), (70, None), (71, ""), (72, "12 .. x")]
    rows += [(5, rows[5][1])]  # a repeated row
    rows += [(80, ("é" * 300 + " ") * 6 + ("é" * 299 + " ") * 40 + ("x×÷ÿ" * 9 + " ") * 7)]
    rows += [(81, "abedcab " * 900 + "abedcac " * 120 + "abedccc " * 20)]  # forms of forms
    want = brute_force(rows)
    assert sum(w[1] is not None for w in want) > 30 and any(w[1] and w[2] != w[1] for w in want)
    got = result(table(rows))
    assert len(got) == len(want) and set(got) == want


def test_same_letters_in_other_orders(table):
    """A leaf that no letter count can split: anagrams."""
    rng = random.Random(2)
    names = set()
    while len(names) < 1_500:
        names.add("".join(rng.sample("aabbccdé", 8)))
    names = sorted(names)
    rows = [(i, " ".join([n] * 5 + [n[:-1] + "z"] * 30)) for i, n in enumerate(names)]
    got = result(table(rows))
    assert len(got) == len({g[0] for g in got}) and set(got) == brute_force(rows)


def test_every_edit_is_within_reach_of_its_cell():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(800)]
    counts = sv.letter_counts(sv.letter_codes(words))
    tree = sv.CellTree.build(counts[:200], 37)
    assert tree.cells > 20
    own = tree.own(counts)
    for change, spare in (("replace", 1), ("delete", 0)):
        asked = []
        for w in words:
            at = rng.randrange(8)
            asked.append(w[:at] + (rng.choice("ijk") if change == "replace" else "") + w[at + 1 :])
        rows, cells = tree.reached(sv.letter_counts(sv.letter_codes(asked)), spare)
        assert {(i, c) for i, c in enumerate(own.tolist())} <= set(zip(rows.tolist(), cells.tolist()))
        assert len(rows) == len(set(zip(rows.tolist(), cells.tolist()))) < 0.8 * len(words) * tree.cells


def test_empty(table):
    assert result(table([])) == []
    assert result(table([(1, None), (2, "short of five")])) == []
