"""Language identification, quality ranking and token counts."""

import math
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from inkmill.llm import language_id, quality_ranking, token_count
from inkmill.llm.worker import worker_state
from pyspark.sql import functions as F

WORDS = {
    "en": "the of and house water with that river green stone".split(),
    "fr": "le des et maison eau avec que rivière vert pierre".split(),
}


def prose(lang, n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def language_docs():
    rows = [(i, prose("en" if i % 2 else "fr", 30, i), "en" if i % 2 else "fr") for i in range(60)]
    return rows + [(100, None, "en"), (101, "", "fr"), (102, "the house", None)]


def test_language(make_docs, language_docs):
    model = language_id.fit(make_docs(language_docs))
    assert model.languages == ["en", "fr"]
    asked = [
        (1, "The WATER, with stone!"),
        (2, "avec pierre"),
        (3, "houses watery stones"),  # words not seen: n-grams
        (4, "maisons pierres rivières"),
        (5, None),
        (6, ""),
        (7, "12 + 34 = ½ ..."),
        (8, "stone " * 50_000),
        (1, "The WATER, with stone!"),
    ]
    docs = make_docs(asked)
    got = docs.select("doc_id", language_id.identify(docs, model).alias("p")).select("doc_id", "p.*")
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(asked)
    expected = {1: "en", 2: "fr", 3: "en", 4: "fr", 5: "und", 6: "und", 7: "und", 8: "en"}
    assert {i: r["lang_pred"] for i, r in by_id.items()} == expected
    assert all(0 <= r["score"] <= 1 for r in by_id.values())
    assert by_id[5]["score"] == by_id[7]["score"] == 0


def plain_language(rows, texts):
    """Back-off scoring with dictionaries, straight from the labelled rows."""

    def words_of(text):
        found = re.findall(r"[^\W\d_]+", text.lower())
        return [w for w in found if any(c.isalpha() for c in w)]

    def grams(word, order):
        marked = word if order == 1 else f"<{word}>"
        return [marked[i : i + order] for i in range(len(marked) - order + 1)]

    counts, docs = {}, {}
    for text, lang in rows:
        docs[lang] = docs.get(lang, 0) + 1
        for w in words_of(text):
            for key in [(0, w)] + [(o, g) for o in range(1, 6) for g in grams(w, o)]:
                by_lang = counts.setdefault(key, {})
                by_lang[lang] = by_lang.get(lang, 0) + 1
    names = sorted({lang for by_lang in counts.values() for lang in by_lang})
    base = {}
    for order in range(6):
        own = [by_lang for (o, _), by_lang in counts.items() if o == order]
        for lang in names:
            base[order, lang] = sum(b.get(lang, 0) for b in own) + 0.5 * max(1, len(own))

    def log_of(key, lang):
        return float(np.float32(math.log((counts[key].get(lang, 0) + 0.5) / base[key[0], lang])))

    prior = {lang: math.log(docs[lang] / sum(docs[x] for x in names)) for lang in names}
    out = []
    for text in texts:
        words, total = words_of(text or ""), dict.fromkeys(names, 0.0)
        for w in words:
            keys = [(0, w)] if (0, w) in counts else []
            for order in (5, 4, 3, 2, 1):
                keys = keys or [(order, g) for g in grams(w, order) if (order, g) in counts]
            for lang in names:
                total[lang] += sum(log_of(k, lang) for k in keys) / max(1, len(keys))
        if not words or not names:
            out.append(("und", 0.0))
            continue
        best = max(names, key=lambda lang: total[lang] + prior[lang])
        mild = {x: total[x] * min(len(words), 20) / len(words) + prior[x] for x in names}
        top = max(mild.values())
        weights = {x: math.exp(v - top) for x, v in mild.items()}
        out.append((best, weights[best] / sum(weights.values())))
    return out


def test_language_against_brute_force(make_docs):
    rng = random.Random(12)
    rows = []
    for i in range(90):
        lang = ("en", "fr", "xx")[i % 3]
        words = [w[: rng.randint(1, 9)] + rng.choice(["", "ß", "é", "o"]) for w in rng.choices(WORDS.get(lang, ["zab", "ΣΑΣ", "ǅ", "日本"]), k=12)]
        rows.append((i, " ".join(words), lang))
    texts = [" ".join(rng.choices([*WORDS["en"], *WORDS["fr"], "watrr", "pierrot", "qqq", "ΣΑ", "½", "x", "日"], k=n)) for n in (1, 2, 5, 40, 300)]
    texts += ["don't STOP-it é_é", "ŉ 日本語 z" * 50, "", None, "12", "y" * 5_000]
    model = language_id.fit(make_docs(rows))
    docs = make_docs(list(enumerate(texts)))
    got = docs.select("doc_id", language_id.identify(docs, model).alias("p")).select("doc_id", "p.*").collect()
    want = plain_language([r[1:] for r in rows], texts)
    for r in got:
        lang, score = want[r["doc_id"]]
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-9, (texts[r["doc_id"]], r, want[r["doc_id"]])


def test_language_without_labels(make_docs):
    model = language_id.fit(make_docs([(1, "abc", None), (2, None, "en")]))
    docs = make_docs([(1, "abc def", "en")])
    assert docs.select(language_id.identify(docs, model)["lang_pred"]).first()[0] == "und"
    empty = make_docs([])
    assert empty.select(language_id.identify(empty, model)).count() == 0


def test_backoff_prefers_longer_grams(make_docs, language_docs):
    model = language_id.fit(make_docs(language_docs))
    long_ = [g for g in language_id.grams_of("waterx", 5) if g in model.grams]
    assert len(model.rows_of("waterx")) == len(long_) > 0
    assert len(model.rows_of("water")) == 1
    assert model.rows_of("щщщ") == []


def test_fit_frees_what_other_operators_keep():
    worker_state("chunks")["encoder"] = np.zeros(10)
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "fr"], "text": ["Water water", "eau"]})
    [counts] = language_id._word_counts(iter([batch]))
    rows = {(r["lang"], r["word"], r["n"]) for r in counts.to_pylist()}
    assert rows == {("en", "water", 2), ("fr", "eau", 1)}
    assert worker_state("chunks") == {}


def noisy(i):
    return f"buy{i} $$$ ### buy buy buy %%% " * 5


@pytest.fixture(scope="module")
def quality_rows():
    rows = [(i, prose("en", 20 + i % 7, i) + ".", "en") for i in range(80)]
    return rows + [(1000 + i, noisy(i), "en") for i in range(40)]


def test_quality(spark, make_docs, quality_rows):
    docs = make_docs(quality_rows)
    labels = [(i, int(i < 1000), 0) for i, *_ in quality_rows if i % 3]
    labels += [(5, None, 0), (None, 1, 0), (77777, 1, 0), (1, 1, 0), (4, 7, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality_ranking.fit(docs, labels)
    asked = quality_rows + [(1, None), (2, ""), (3, "word " * 100_000)]
    frame = make_docs(asked)
    got = frame.select("doc_id", quality_ranking.quality_score(frame, model).alias("s")).collect()
    assert len(got) == len(asked) and all(0 <= r["s"] <= 1 for r in got)
    held_out = [r for r in got[: len(quality_rows)] if r["doc_id"] % 3 == 0]
    right = [(r["s"] >= 0.5) == (r["doc_id"] < 1000) for r in held_out]
    assert np.mean(right) > 0.95


def test_quality_with_one_class_or_nothing(spark, make_docs, quality_rows):
    docs = make_docs(quality_rows[:10])
    for rows in ([], [(i, 1) for i in range(10)]):
        model = quality_ranking.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        scores = docs.select(quality_ranking.quality_score(docs, model)).collect()
        assert {r[0] for r in scores} == {0.5}


def test_threshold_is_the_quantile_of_bad_labels():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (900, 3)), rng.normal(-1, 1, (300, 3))
    model = quality_ranking.rank_fit(good, bad, 0.25, pairs=20_000)
    both = np.concatenate([good, bad])
    assert abs((model.score(both) < 0.5).mean() - 0.25) < 0.02


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return token_count.PieceModel(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_counts_equal_the_library(pieces):
    model, library = pieces
    rng = random.Random(1)
    signs = "aaabcdehinot  \n\t▁éñ漢字😀<>/s0123456789.,%\x00́ "
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["ab" * 4000, "the" * 3000, " ", "   ", "<s> </s> <unk>"]
    for text in texts:
        words = token_count.pretokens(text)
        want = len(library.encode(text))
        assert sum(model.count_many(words)) == want, text
        assert sum(map(model.count_long, words)) == want, text


def test_counts_of_rows(make_docs, pieces):
    texts = [None, "", "Hello  world", "x " * 30_000, "Hello  world", "z" * 5_000]
    docs = make_docs(list(enumerate(texts)))
    got = docs.select("doc_id", token_count.count_tokens(F.col("text"), PIECES).alias("n"))
    want = {i: len(pieces[1].encode(t or "")) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["n"] for r in got.collect()} == want
    assert make_docs([]).select(token_count.count_tokens(F.col("text"), PIECES)).count() == 0
