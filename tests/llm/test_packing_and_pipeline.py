import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from inkmill.llm import bin_packing as op
from inkmill.llm.settings import PACK_TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PACK_TOKENIZER)


def library_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_chunks_have_the_ids_of_the_text(tokenizer):
    encoder = op.ChunkEncoder(PACK_TOKENIZER)
    rng = random.Random(1)
    signs = list("aAÉéñÑßİσΣçb  \n\t\x1c\x85\xa0 'sStTrReEvV漢ﬁ12,.!?<>|/̈́")
    signs += ["<|endoftext|>", "'s", "'LL", "don't"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library_ids(tokenizer, text), text


def test_remembered_chunks_are_bounded_and_keep_the_frequent_ones(tokenizer, monkeypatch):
    monkeypatch.setattr(op, "_CHUNKS", 60)
    monkeypatch.setattr(op, "_PARTS", 40)
    encoder = op.ChunkEncoder(PACK_TOKENIZER)
    rng = random.Random(2)
    for i in range(300):
        rare = ["".join(rng.choices("abcé,!", k=6)) for _ in range(rng.randint(0, 12))]
        texts = [" ".join(["The", *rare, "house."]), "", "the\x1chouse"]
        got = encoder.encode_all(texts)
        assert [ids.tolist() for ids in got] == [library_ids(tokenizer, t) for t in texts], texts
        assert len(encoder.places) <= 60 + 14 and len(encoder.parts) <= 40 + 28
        assert encoder.places.keys() >= {"The", "house."} and encoder.places["The"] == 0
    assert len(encoder.places) == encoder.known


TEXTS = [
    "Hello, world! " * 3,
    None,
    "",
    "word " * 9000,
    "a b c " * 700,
    "Hello, world! " * 3,
    "x" * 20_000,
    *["some short text number %d" % i for i in range(60)],
]


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pieces_and_places(make_docs, tokenizer, capacity):
    rows = list(enumerate(TEXTS)) + [(0, TEXTS[0])]
    got = op.pack(op.token_pieces(make_docs(rows), PACK_TOKENIZER, 1, capacity), capacity).collect()
    want = Counter()
    for doc_id, text in rows:
        ids = np.array(library_ids(tokenizer, text) + [1], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want[doc_id, piece, at, len(own), zlib.crc32(own.tobytes())] += 1
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= capacity
    counts = Counter(r["length"] for r in got)
    assert len(sequences) <= op.lower_bound(counts, capacity) + 1


def test_no_documents(make_docs):
    pieces = op.token_pieces(make_docs([]), PACK_TOKENIZER, 1, 4096)
    assert op.pack(pieces, 4096).count() == 0


def least_bins(lengths, capacity):
    """Smallest number of bins, by trying everything."""
    best = len(lengths)

    def search(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= capacity and bins[b] not in bins[:b]:
                bins[b] += lengths[i]
                search(i + 1, bins)
                bins[b] -= lengths[i]
        search(i + 1, [*bins, lengths[i]])

    search(0, [])
    return best


def test_plans_are_best_on_small_cases():
    rng = random.Random(4)
    over = 0
    for _ in range(150):
        capacity = rng.choice([10, 20, 100])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 10))), reverse=True)
        plan = op.plan_bins(dict(Counter(lengths)), capacity)
        assert Counter(x for f, n in plan for x in f * n) == Counter(lengths)
        assert all(sum(f) <= capacity for f, _ in plan)
        best = least_bins(lengths, capacity)
        assert op.lower_bound(Counter(lengths), capacity) <= best
        over += sum(n for _, n in plan) - best
    assert over <= 2


def test_many_pieces_reach_the_bound():
    rng = random.Random(5)
    counts = Counter(min(4096, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(50_000))
    plan = op.plan_bins(dict(counts), 4096)
    assert sum(n for _, n in plan) == op.lower_bound(counts, 4096)


# --- pipeline ------------------------------------------------------------------------------

WORDS = "river stone green house water light above under walk sing north table".split()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(8)

    def prose(n):
        return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)) + "."

    folder = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, prose(80)) for i in range(120)]
    docs += [(200 + i, "$$$ buy ### now %%% " * 30 + str(i)) for i in range(60)]
    item = prose(30)
    docs += [(300, prose(50) + " " + item + " " + prose(50)), (301, "4 7 11 13 " * 20)]
    docs += [(400 + i, docs[i][1]) for i in range(10)] + [(500, docs[5][1] + " tail")]
    docs += [(600, None), (601, "")]
    rows = [(i, t, "en" if i < 190 else None, "src", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    labels = [(i, int(i < 200), 0) for i, _ in docs if i < 260 and i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = {}
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, tables).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == corpus_pipeline.COLUMNS
    clean = set(range(120))
    for ids in kept.values():
        assert clean <= ids
    assert not kept["quality classifier"] & set(range(200, 260))
    assert not kept["language ID"] & {600, 601}
    assert not kept["near-duplicate removal"] & {*range(400, 410), 500}
    assert 300 in kept["near-duplicate removal"]
    assert 300 not in kept["benchmark decontamination"]
    assert kept["best-fit packing"] == kept["benchmark decontamination"]
    final = corpus_pipeline.run(spark, tables)
    assert {r["doc_id"] for r in final.collect()} == kept["best-fit packing"]


def test_language_stage_rejects_mixtures(spark, make_docs):
    rng = random.Random(9)
    french = "maison pierre rivière lumière chemin soleil montagne verte chanson fleur arbre".split()
    rows = [(i, " ".join(rng.choices(WORDS, k=30)), "en") for i in range(40)]
    rows += [(100 + i, " ".join(rng.choices(french, k=30)), "fr") for i in range(40)]
    mixed = [" ".join(x for pair in zip(rng.choices(WORDS, k=15), rng.choices(french, k=15)) for x in pair) for _ in range(9)]
    rows += [(200 + i, text, None) for i, text in enumerate(mixed)] + [(300, "12 34 ...", "en")]
    rows += [(301, "stone river", None), (302, "pierre verte", None)]
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, make_docs(rows), "").collect()}
    assert kept >= {*range(40), *range(100, 140), 301, 302}
    assert 300 not in kept and len(kept & set(range(200, 209))) <= 3


def test_repeated_rows_leave_one(spark, make_docs):
    docs = make_docs([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "z")])
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, None]


def test_empty_documents(spark, make_docs, tables):
    docs = make_docs([])
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, tables)
        assert docs.count() == 0
