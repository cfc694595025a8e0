import hashlib
import re

import pytest
from pyspark.sql import functions as F

from inkmill.llm import decontamination as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(lowered)


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(size, len(w))
        for i in range(len(w) - n + 1):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


def numbered(prefix, n):
    return [f"{prefix}{i}" for i in range(n)]


ITEMS = [
    (1, " ".join(numbered("w", 25))),
    (2, "Short item here!"),
    (3, " ".join(numbered("w", 12))),  # shares windows with item 1
    (10, " ".join(numbered("q", 10))),
    (4, None),
    (5, "... !!"),
    (None, " ".join(numbered("n", 12))),
    (2, "Short item here!"),
]
DOCS = [
    (1, "Before it. " + ", ".join(numbered("W", 25)) + ". And after"),
    (2, " ".join(numbered("w", 9))),  # one word short of a window
    (3, "x SHORT, item; here y short item"),
    (4, " ".join(numbered("n", 12))),
    (5, None),
    (6, ""),
    (7, "?! " + " ".join(numbered("q", 10)) + " " + " ".join(numbered("q", 10))),
    (8, "pad " * 30_000 + " ".join(numbered("w", 11)) + " pad" * 30_000),
    (9, "é É short item here ünd"),
    (1, "another text with one id"),
    (3, "x SHORT, item; here y short item"),
    (None, "no id but short item here"),
]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_brute_force(make_docs, benchmark):
    assert rows(op.contamination(make_docs(DOCS), benchmark)) == brute(DOCS, ITEMS)


def test_shuffled_windows_give_the_same(make_docs, benchmark):
    _, near = op.find_hits(make_docs(DOCS), benchmark)
    _, far = op.find_hits(make_docs(DOCS), benchmark, broadcast_windows=3)
    order = [F.col("doc_id"), F.col("text_hash"), F.sort_array("hits").alias("hits")]
    assert rows(near.select(order)) == rows(far.select(order))


def test_empty_tables(spark, make_docs, benchmark):
    assert op.contamination(make_docs([]), benchmark).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(op.contamination(make_docs(DOCS), none)) == brute(DOCS, [])
    assert op.decontaminate(make_docs(DOCS), none).count() == len(DOCS)


def test_removes_documents(make_docs, benchmark):
    docs = make_docs(DOCS).withColumn("hits", F.lit(1)).withColumn("text_hash", F.lit("mine"))
    kept = op.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    clean = [d for d in DOCS if not any(r[5] for r in brute([d], ITEMS))]
    assert rows(kept.select("doc_id", "text")) == sorted(clean, key=repr)


def test_removes_spans(make_docs, benchmark):
    kept = op.decontaminate(make_docs(DOCS), benchmark, remove="spans")
    texts = {(r["doc_id"], r["text"]) for r in kept.collect()}
    assert kept.count() == len(DOCS)
    assert (1, "Before it. And after") in texts
    assert (1, "another text with one id") in texts
    assert (3, "x y short item") in texts
    assert (7, "?! ") in texts
    assert (5, None) in texts
    with pytest.raises(ValueError):
        op.decontaminate(make_docs(DOCS), benchmark, remove="words")


def test_main_path_runs_no_python(make_docs, benchmark):
    plan = op.contamination(make_docs(DOCS), benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_many_candidates_take_the_shuffle(make_docs, benchmark, monkeypatch):
    few = rows(op.decontaminate(make_docs(DOCS), benchmark))
    monkeypatch.setattr(op, "BROADCAST_MARKS", 0)
    monkeypatch.setattr(op, "BROADCAST_IDS", 0)
    assert rows(op.decontaminate(make_docs(DOCS), benchmark)) == few
