import json
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, trainers

from checks import queries
from inkmill.functions.pretokens import SPECIAL_TOKENS, byte_chars, pretokens, symbol_char, symbol_id
from inkmill.operators import bpe, codec, evaluation, tokens
from inkmill.operators.bpe import BpeModel, learn_bpe, word_counts
from inkmill.operators.codec import decode, encode, merge_word, round_trip
from inkmill.plans.token_dataset import (
    encode_corpus,
    evaluate_splits,
    evaluate_tokens,
    train_tokenizer,
    write_token_bins,
)
from inkmill.sources import files, tokenbin, tokenizer_files

WORDS = "le la théâtre vérité monsieur l'ami it's aaaa abab baba 1234 !? 日本語".split()


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    return [" ".join(rng.choices(WORDS, k=rng.randint(1, 40))) + rng.choice(["", "\n", "  x"]) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(corpus(), 1)), "ordinal long, text string").cache()


@pytest.fixture(scope="module")
def model(docs):
    return learn_bpe(word_counts(docs), 330, merges_per_stage=20)


def library(texts, vocab_size):
    tk = Tokenizer(models.BPE(unk_token="[UNK]"))
    tk.normalizer = normalizers.Sequence([normalizers.NFC()])
    tk.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    trainer = trainers.BpeTrainer(
        vocab_size=vocab_size, min_frequency=2, special_tokens=SPECIAL_TOKENS, show_progress=False,
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet(),
    )
    tk.train_from_iterator(texts, trainer=trainer)
    return tk


ODD = [
    "", " ", "a[EOS] b  [PAD]  c", " [EOS]", "[EOS][EOS]", "été x\x1cy  　　z\x85w",
    "#" * 3000 + "'s  \n\n x", "日本語 \U0001f600 ²³ it's", "x" * 5000, "a\x00b", "[UNK", "'S 're",
]


def test_byte_alphabet_is_the_library_one():
    assert set(byte_chars()) == set(pre_tokenizers.ByteLevel.alphabet())


def test_symbol_chars_are_ordered_and_invertible():
    ids = [0, 259, 1000, 54_000, 55_039, 55_040, 70_000, 1_000_000]
    chars = [symbol_char(i) for i in ids]
    assert [symbol_id(ch) for ch in chars] == ids
    assert [ch.encode() for ch in chars] == sorted(ch.encode() for ch in chars)


def test_pretokens_equal_library(spark):
    texts = [t for t in ODD + corpus() if t]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", pretokens(F.col("t")).alias("w")).orderBy("i").collect()
    split = pre_tokenizers.ByteLevel(add_prefix_space=False)
    for text, r in zip(texts, rows):
        want = [text[a:b] for _, (a, b) in split.pre_tokenize_str(text)]
        assert r["w"] == want and "".join(r["w"]) == text


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_equal_library(spark, seed):
    texts = corpus(80, seed)
    df = spark.createDataFrame(list(enumerate(texts, 1)), "ordinal long, text string")
    got = learn_bpe(word_counts(df), 400, merges_per_stage=25)
    names = tokenizer_files.token_strings(got)
    tk = library(texts, 400)
    assert tk.get_vocab() == {name: i for i, name in enumerate(names)}
    assert got.vocab_size >= 260


def test_batches_are_exact_for_ties_and_overlaps(spark):
    words = [("abab", 5), ("baba", 5), ("aaaa", 5), ("abcabc", 5), ("bcbc", 5), ("caca", 5), ("aab", 5)]
    rng = random.Random(3)
    words += [("".join(rng.choices("abc", k=rng.randint(2, 9))), rng.randint(1, 6)) for _ in range(60)]
    texts = [w for word, n in words for w in [word] * n]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "ordinal long, text string")
    got = learn_bpe(word_counts(df), 320, merges_per_stage=7)
    assert tokenizer_files.token_strings(got) == sorted(
        library(texts, 320).get_vocab(), key=library(texts, 320).get_vocab().get
    )


@pytest.mark.parametrize("held, share, seed", [(12, 1.0, 2), (40, 0.05, 3)])
def test_indexed_rounds_equal_library(spark, monkeypatch, held, share, seed):
    """With few held pairs, and an index built anew after few touched words; repeated tokens too."""
    monkeypatch.setattr(bpe, "HELD_PAIRS", held)
    monkeypatch.setattr(bpe, "TOUCHED_SHARE", share)
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcé", k=rng.randint(3, 12))) for _ in range(120)]
    texts = [" ".join(rng.choices(stems, range(120, 0, -1), k=40)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts, 1)), "ordinal long, text string")
    counts = word_counts(df).cache()
    got = learn_bpe(counts, 400, merges_per_stage=25, rare_share=1e9)
    tk = library(texts, 400)
    assert tk.get_vocab() == {name: i for i, name in enumerate(tokenizer_files.token_strings(got))}
    rewritten = [n for _, n in got.rounds if n is not None]
    assert len(rewritten) > 5 and min(rewritten) < counts.count() / 4
    assert sum(n for n, _ in got.rounds) == len(got.merges)


def test_stops_when_pairs_get_rare(spark):
    df = spark.createDataFrame([(1, "ab ab cd")], "ordinal long, text string")
    got = learn_bpe(word_counts(df), 1000)
    assert [got.tokens[i] for _, _, i in got.merges] == [b"ab"]
    assert learn_bpe(word_counts(df), 260).merges == []


def test_saved_forms(spark, model, folder):
    tokenizer_files.save_tables(spark, model, f"{folder}/t")
    assert tokenizer_files.load_tables(spark, f"{folder}/t") == model
    tokenizer_files.save_files(model, f"{folder}/f", {"type": "BPE"})
    again = tokenizer_files.load_files(f"{folder}/f")
    assert (again.merges, again.tokens) == (model.merges, model.tokens)


def test_trained_files_all_or_none(spark, docs, folder, monkeypatch):
    rows = [(0, None), (1, ""), *((i, t) for i, t in enumerate(corpus(), 2))]
    some = spark.createDataFrame(rows, docs.schema)
    model = train_tokenizer(some, 280, limit=25, folder=f"{folder}/t", source="here")
    tk = Tokenizer.from_file(f"{folder}/t/tokenizer.json")
    assert tk.get_vocab() == library(corpus()[:25], 280).get_vocab() and tk.get_vocab_size() == model.vocab_size
    names = ["merges.txt", "tokenizer.json", "tokenizer_config.json", "vocab.json"]
    assert os.listdir(folder) == ["t"] and sorted(os.listdir(f"{folder}/t")) == names
    with open(f"{folder}/t/tokenizer_config.json") as file:
        report = json.load(file)
    assert (report["documents"], report["characters"]) == (25, sum(map(len, corpus()[:25])))
    with pytest.raises(FileExistsError):
        train_tokenizer(some, 280, folder=f"{folder}/t")
    written = []

    def failing(path, content):
        written.append(path)
        if len(written) == 3:
            raise OSError("disk full")
        real(path, content)

    real = files.write_bytes
    monkeypatch.setattr(files, "write_bytes", failing)
    with pytest.raises(OSError):
        train_tokenizer(some, 262, limit=3, folder=f"{folder}/u")
    assert len(written) == 3 and os.listdir(folder) == ["t"]


def test_codec_equals_library(spark, docs, model, folder):
    tokenizer_files.save_files(model, folder)
    tk = Tokenizer.from_file(f"{folder}/tokenizer.json")
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, None)], docs.schema)
    coded = encode(docs.unionByName(odd), model)
    rows = coded.select("ordinal", "text", "ids", decode(F.col("ids"), model).alias("back")).collect()
    for r in rows:
        if r["text"] is None:
            assert r["ids"] is None
            continue
        ids = tk.encode(r["text"]).ids
        assert r["ids"] == ids
        assert r["back"] == tk.decode(ids)
    cut = [ids[:n] for n in (1, 2, 3) for ids in [tk.encode("日\U0001f600é").ids]] + [[3, 70, 99999]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cut)], "i int, ids array<int>")
    got = [r[0] for r in df.orderBy("i").select(decode(F.col("ids"), model)).collect()]
    assert got == [tk.decode(c) for c in cut]


def test_round_trip(spark, docs, model):
    assert round_trip(docs, model).first().asDict() == {"documents": 60, "mismatches": 0}
    special = spark.createDataFrame([(1, "a[EOS]b")], "ordinal long, text string")
    assert round_trip(special, model).first()["mismatches"] == 1


def test_merge_word_takes_lowest_rank_first():
    merges = {(1, 1): (0, 2), (2, 1): (1, 3), (2, 2): (2, 4)}
    assert merge_word([1] * 5, merges) == [2, 3]
    assert merge_word([1] * 4, merges) == [4]
    assert merge_word([1] * 3, merges) == [3]
    assert merge_word([], merges) == []


def test_short_words_merge_like_long_ones(monkeypatch):
    """With and without a heap, also where a merge gives a symbol that exists already."""
    rng = random.Random(5)
    for _ in range(2000):
        merges, symbols = {}, 4
        for rank in range(rng.randint(0, 12)):
            pair = (rng.randrange(symbols), rng.randrange(symbols))
            again = rng.random() < 0.2
            if pair not in merges:
                merges[pair] = (rank, rng.randrange(symbols) if again else symbols)
                symbols += not again
        word = [rng.randrange(4) for _ in range(rng.randint(0, 33))]
        short = merge_word([*word], merges)
        monkeypatch.setattr(codec, "SHORT_WORD", 0)
        assert merge_word([*word], merges) == short
        monkeypatch.undo()


def placed(spark, sizes, seed=4):
    rng = random.Random(seed)
    rows = [(i + 1, [rng.randint(0, 9) for _ in range(n)]) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "ordinal long, ids array<int>").withColumn("n_tokens", F.size("ids"))
    return tokens.with_offsets(df, block_rows=3), [t for _, ids in rows for t in ids]


SIZES = [5, 0, 700, 1, 0, 0, 300, 3, 1000, 2]


def test_offsets_and_bin_round_trip(spark, folder):
    tokenbin.register(spark)
    df, stream = placed(spark, SIZES)
    for r in df.collect():
        assert r["start_offset"] == sum(SIZES[: r["ordinal"] - 1])
    for dtype in ("uint16", "uint32", "int64"):
        path = f"{folder}/{dtype}"
        part = df.select("start_offset", "ids")
        part.write.format("tokenbin").option("dtype", dtype).mode("append").save(path)
        back = spark.read.format("tokenbin").load(path).orderBy("start_offset").collect()
        assert [t for r in back for t in r["ids"]] == stream


def test_second_append_raises_and_overwrite_replaces(spark, folder):
    import os

    tokenbin.register(spark)
    path = f"{folder}/stream"

    def write(ids, mode):
        df = spark.createDataFrame([(0, ids)], "start_offset long, ids array<int>")
        df.write.format("tokenbin").option("dtype", "uint16").mode(mode).save(path)

    def read():
        return [t for r in spark.read.format("tokenbin").load(path).collect() for t in r["ids"]]

    write([1, 2, 3], "append")
    with pytest.raises(Exception, match="already holds"):
        write([4], "append")
    assert read() == [1, 2, 3]
    write([5, 6], "overwrite")
    assert read() == [5, 6]
    assert sum(n.endswith(".bin") for n in os.listdir(path)) == 1


def shards(path):
    with open(f"{path}/{tokenbin.MANIFEST}") as file:
        listed = json.load(file)["shards"]
    assert {s["file"] for s in listed} == {n for n in os.listdir(path) if n.endswith(".bin")}
    return [(s["offset"], s["tokens"]) for s in listed]


@pytest.mark.parametrize("size", [1, 97, 1000, 2011, 5000])
def test_shards_of_equal_size(spark, folder, size):
    df, stream = placed(spark, SIZES if size > 1 else [3, 0, 40, 1])
    tokenbin.write_stream(df.repartition(3), f"{folder}/s", "uint16", len(stream), size)
    want = [(at, min(size, len(stream) - at)) for at in range(0, len(stream), size)]
    assert shards(f"{folder}/s") == want
    read = spark.read.format("tokenbin")
    for low, high in ((0, 10**9), (0, 1), (30, 41), (900, 1100)):
        part = read.option("from", low).option("until", high).load(f"{folder}/s").orderBy("start_offset")
        rows = part.collect()
        assert [t for r in rows for t in r["ids"]] == stream[low:high]
        assert not rows or rows[0]["start_offset"] == low


def most_tasks(spark, group, run):
    """What ``run`` returns, and the tasks of its largest stage."""
    spark.sparkContext.setJobGroup(group, "")
    result = run()
    spark.sparkContext.setJobGroup("", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return result, max(info.numTasks for info in map(tracker.getStageInfo, stages) if info is not None)


def test_small_shards_share_tasks(spark, folder, monkeypatch):
    """A stream of many small shards is written by as many tasks as its tokens need."""
    monkeypatch.setattr(tokenbin, "TASK_TOKENS", 1005, raising=False)
    df, stream = placed(spark, SIZES)
    _, tasks = most_tasks(spark, "small-shards", lambda: tokenbin.write_stream(
        df.repartition(3), f"{folder}/s", "uint16", len(stream), 10
    ))
    assert tasks <= 4
    assert shards(f"{folder}/s") == [(at, min(10, len(stream) - at)) for at in range(0, len(stream), 10)]
    rows = spark.read.format("tokenbin").load(f"{folder}/s").orderBy("start_offset").collect()
    assert [t for r in rows for t in r["ids"]] == stream


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("given"))
    rows = [(i, text, "fr", "web") for i, text in enumerate(corpus(200, seed=8))]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    table.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return queries.dataset(spark, folder)


@pytest.mark.parametrize(
    "from_files, from_table",
    [("token_bin_windows", "token_windows"), ("token_bin_evaluation", "evaluation_report")],
)
def test_queries_on_many_small_shards(spark, given, monkeypatch, from_files, from_table):
    """Hundreds of shards give the rows of the token table, without a task for each shard."""
    monkeypatch.setattr(queries, "dataset", lambda spark, sf: given)
    monkeypatch.setattr(queries, "SHARD", 20)
    found = queries.queries()
    rows, tasks = most_tasks(spark, from_files, lambda: found[from_files](spark, "").collect())
    listed = found["token_bin_shards"](spark, "").count()
    assert sorted(rows) == sorted(found[from_table](spark, "").collect())
    assert listed > 300 and tasks <= 16


def test_empty_stream(spark, folder):
    df, _ = placed(spark, [0, 0])
    tokenbin.write_stream(df, f"{folder}/s", "uint16", 0, 10)
    assert shards(f"{folder}/s") == [] and spark.read.format("tokenbin").load(f"{folder}/s").count() == 0


def test_failed_write_leaves_no_files(spark, folder):
    """Every task has opened shards when the last document turns out not to fit."""
    rows = [(i * 10, [1] * 10 if i < 40 else [70_000] * 10) for i in range(41)]
    df = spark.createDataFrame(rows, "start_offset long, ids array<int>")
    with pytest.raises(Exception, match="does not fit"):
        tokenbin.write_stream(df, f"{folder}/s", "uint16", 410, 50)
    assert os.listdir(f"{folder}/s") == []


def test_commit_sweeps_files_of_failed_attempts(folder):
    import pyarrow as pa

    writer = tokenbin.TokenBinWriter({"path": folder, "dtype": "uint16", "shard_tokens": "4"})
    ids = pa.array([[1, 2, 3], [4, 5, 6]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array([0, 3]), ids], names=["start_offset", "ids"])
    writer.write(iter([batch]))  # an attempt whose message got lost
    writer.commit([writer.write(iter([batch]))])
    assert shards(folder) == [(0, 4), (4, 2)]


@pytest.mark.parametrize("dtype", ["uint16", "uint32"])
def test_windows_from_files(spark, folder, dtype):
    df, stream = placed(spark, SIZES)
    tokenbin.write_stream(df, f"{folder}/s", dtype, len(stream), 150)
    block = 100
    starts = tokens.random_starts(spark, 300, len(stream), block, seed=3)
    rows = tokenbin.read_windows(starts, f"{folder}/s", block).collect()
    assert sorted(r["window_id"] for r in rows) == list(range(300))
    for r in rows:
        assert r["x"] == stream[r["start"] : r["start"] + block]
        assert r["y"] == stream[r["start"] + 1 : r["start"] + block + 1]
    plan = tokenbin.read_windows(starts, f"{folder}/s", block)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "BatchScan" not in plan
    late = spark.createDataFrame([(0, len(stream) - block)], "window_id long, start long")
    with pytest.raises(Exception, match="no 101 tokens"):
        tokenbin.read_windows(late, f"{folder}/s", block).collect()
    assert tokenbin.read_windows(late.limit(0), f"{folder}/s", block).count() == 0
    with pytest.raises(FileNotFoundError):
        tokenbin.read_windows(late, f"{folder}/other", block)


def test_bytes_read_grow_with_windows(folder, monkeypatch):
    """The stream grows a hundredfold, the bytes read stay."""
    read = []

    class Counting:
        def __init__(self, source):
            self.source = source

        def open_input_file(self, path):
            opened = self.source.open_input_file(path)

            class File:
                seek, close = opened.seek, opened.close

                def read(self, n):
                    read.append(n)
                    return opened.read(n)

            return File()

    real = files.resolve
    monkeypatch.setattr(files, "resolve", lambda path: (Counting(real(path)[0]), real(path)[1]))
    for size in (1_000, 100_000):
        np.arange(size, dtype="<u4").tofile(f"{folder}/a.bin")
        starts = np.linspace(0, size - 11, 50).astype(np.int64)
        got = tokenbin.window_ids(starts, 11, folder, np.dtype("<u4"), [("a.bin", 0, size)])
        assert (got == starts[:, None] + np.arange(11)).all()
        assert sum(read) == 50 * 11 * 4
        read.clear()


def test_paths_get_the_default_scheme(spark):
    assert files.qualified(spark, "/a/b c") == "file:/a/b c"
    assert files.qualified(spark, "s3a://bucket/k") == "s3a://bucket/k"


@pytest.mark.parametrize(
    "path, kind, inner",
    [
        ("/a/b", "local", "/a/b"),
        ("file:/a/b", "local", "/a/b"),
        ("file:///a/b", "local", "/a/b"),
        ("dbfs:/a/b", "local", "/dbfs/a/b"),
        ("s3a://bucket/k", "s3", "bucket/k"),
    ],
)
def test_paths(path, kind, inner):
    from inkmill.sources import files

    try:
        system, found = files.resolve(path)
    except OSError:  # a remote store that cannot be asked for its region here
        assert kind != "local"
        return
    assert (system.type_name, found) == (kind, inner)


def test_unknown_kind_of_store():
    from inkmill.sources import files

    with pytest.raises(Exception, match="Unrecognized"):
        files.resolve("gopher://host/x")


def test_bare_bin_file_and_errors(spark, folder):
    import numpy as np

    tokenbin.register(spark)
    ids = np.arange(100_000) % 60_000
    ids.astype("<u2").tofile(f"{folder}/x.bin")
    back = spark.read.format("tokenbin").option("dtype", "uint16").load(f"{folder}/x.bin")
    assert [t for r in back.orderBy("start_offset").collect() for t in r["ids"]] == ids.tolist()
    with pytest.raises(Exception, match="unsupported token dtype"):
        spark.read.format("tokenbin").option("dtype", "float32").load(f"{folder}/x.bin").collect()
    big = spark.createDataFrame([(0, [70_000])], "start_offset long, ids array<int>")
    with pytest.raises(Exception, match="does not fit"):
        big.write.format("tokenbin").option("dtype", "uint16").mode("append").save(f"{folder}/y")


@pytest.mark.parametrize("size, dtype", [(260, "uint16"), (65535, "uint16"), (65536, "uint32")])
def test_dtype(spark, size, dtype):
    got = spark.range(1).select(tokens.token_dtype(F.lit(size))).first()[0]
    assert got == dtype


def test_dtype_error(spark):
    with pytest.raises(Exception, match="too large"):
        spark.range(1).select(tokens.token_dtype(F.lit(2**32))).collect()


@pytest.mark.parametrize("n_windows", [200, None])
def test_windows(spark, n_windows):
    df, stream = placed(spark, SIZES)
    block = 100
    starts = tokens.random_starts(spark, 200, len(stream), block, seed=3)
    rows = tokens.token_windows(df, starts, block, n_windows).collect()
    assert len(rows) == 200
    for r in rows:
        assert 0 <= r["start"] < len(stream) - block - 1
        assert r["x"] == stream[r["start"] : r["start"] + block]
        assert r["y"] == stream[r["start"] + 1 : r["start"] + block + 1]


def test_window_limits(spark):
    with pytest.raises(ValueError):
        tokens.random_starts(spark, 5, 101, 100)
    assert {r["start"] for r in tokens.random_starts(spark, 9, 102, 100).collect()} == {0}


def test_encoded_dataset(spark, docs, model, folder):
    split = docs.withColumn("split", F.when(F.col("ordinal") % 5 == 0, "val").otherwise("train"))
    data = encode_corpus(split, model, block_size=16)
    rows = data.tokens.orderBy("ordinal").collect()
    assert all(r["ids"][-1] == 3 and r["n_tokens"] == len(r["ids"]) for r in rows)
    meta = data.meta.first()
    assert (meta["train_docs"], meta["val_docs"], meta["dtype"], meta["eos_id"]) == (48, 12, "uint16", 3)
    write_token_bins(data, folder)
    for s in ("train", "val"):
        back = spark.read.format("tokenbin").load(f"{folder}/{s}").orderBy("start_offset").collect()
        stream = [t for r in rows if r["split"] == s for t in r["ids"]]
        assert [t for r in back for t in r["ids"]] == stream
        assert meta[f"{s}_tokens"] == len(stream)
        pairs = evaluation.stream_pairs(data.tokens.where(F.col("split") == s)).collect()
        assert {(r["prev"], r["next"]): r["n"] for r in pairs} == Counter(zip(stream, stream[1:]))
    write_token_bins(data, f"{folder}/small", 100)
    for s in ("train", "val"):
        assert len(shards(f"{folder}/small/{s}")) == -(-meta[f"{s}_tokens"] // 100)
    plain = encode_corpus(split, model, with_eos=False)
    assert plain.meta.first()["eos_id"] is None
    part = {s: data.tokens.where(F.col("split") == s) for s in ("train", "val")}
    report = evaluate_tokens(part["train"], part["val"], model.vocab_size, 16, 40).first()
    assert report["tokens"] == 40 * 16
    assert report["gain_over_uniform"] == pytest.approx(model.vocab_size / report["perplexity"])
    assert report["gain_over_uniform"] > 1 and 0 < report["accuracy"] <= 100


def test_statistics_by_split(spark, model):
    rows = [(1, "train", "ab"), (2, "train", None), (3, "val", ""), (4, "train", ""), (5, "val", "[EOS]"), (1, "val", "x")]
    df = spark.createDataFrame(rows, "ordinal long, split string, text string")
    data = encode_corpus(df, model)
    got = {r["split"]: r.asDict() for r in data.stats.collect()}
    sizes = {s: [r["n_tokens"] for r in data.tokens.collect() if r["split"] == s] for s in got}
    for s, seen, written, chars in (("train", 3, 1, 2), ("val", 3, 2, 6)):
        assert (got[s]["docs_seen"], got[s]["docs_written"], got[s]["characters"]) == (seen, written, chars)
        assert got[s]["tokens"] == sum(sizes[s]) and len(sizes[s]) == written and got[s]["empty_docs"] == 0


def test_evaluation_by_split_and_draw(spark):
    """One job gives what each split and draw gives alone."""
    rng = random.Random(8)
    streams = {s: [rng.randint(0, 5) for _ in range(n)] for s, n in (("train", 900), ("val", 300))}
    rows = [
        (s, at, ids[at : at + 70]) for s, ids in streams.items() for at in range(0, len(ids), 70)
    ]
    df = spark.createDataFrame(rows, "split string, start_offset long, ids array<int>")
    df = df.withColumn("n_tokens", F.size("ids"))
    draws = {"loss": 60, "accuracy": 15, "none": 0}
    got = evaluate_splits(df, 10, 20, draws, seed=4).collect()
    assert {(r["split"], r["draw"]) for r in got} == {(s, d) for s in streams for d in ("loss", "accuracy")}
    totals = spark.createDataFrame([(s, len(ids)) for s, ids in streams.items()], "split string, n_tokens long")
    starts = tokens.random_starts_by_split(totals, draws, 20, seed=4).collect()
    counts = spark.createDataFrame(
        [(*p, n) for p, n in Counter(zip(streams["train"], streams["train"][1:])).items()],
        "prev int, next int, n long",
    )
    for r in got:
        at = [s["start"] for s in starts if (s["split"], s["draw"]) == (r["split"], r["draw"])]
        ids = streams[r["split"]]
        assert len(at) == draws[r["draw"]] and max(at) < len(ids) - 21
        pairs = Counter((ids[i], ids[i + 1]) for a in at for i in range(a, a + 20))
        targets = spark.createDataFrame([(*p, n) for p, n in pairs.items()], counts.schema)
        want = evaluation.evaluation_report(evaluation.score_pairs(targets, counts, 10), 10).first()
        assert r["tokens"] == want["tokens"] == len(at) * 20
        assert r["loss"] == pytest.approx(want["loss"]) and r["accuracy"] == pytest.approx(want["accuracy"])
    short = df.where("split = 'train' OR start_offset = 0").withColumn("ids", F.slice("ids", 1, 21))
    with pytest.raises(Exception, match="too few tokens in split val"):
        evaluate_splits(short.withColumn("n_tokens", F.size("ids")), 10, 20, draws).collect()


def test_scores_and_report(spark):
    import math

    train = spark.createDataFrame([(1, 2, 3), (1, 3, 3), (2, 1, 1)], "prev int, next int, n long")
    target = spark.createDataFrame([(1, 2, 2), (1, 4, 1), (9, 3, 1)], "prev int, next int, n long")
    rows = {(r["prev"], r["next"]): r for r in evaluation.score_pairs(target, train, 10, 0.5).collect()}
    assert rows[1, 2]["logprob"] == pytest.approx(math.log(3.5 / 11))
    assert rows[1, 4]["logprob"] == pytest.approx(math.log(0.5 / 11))
    assert rows[9, 3]["logprob"] == pytest.approx(math.log(0.5 / 5))
    # ties go to the smaller id; an unseen context predicts the most frequent token
    assert [rows[k]["predicted"] for k in ((1, 2), (1, 4), (9, 3))] == [2, 2, 2]
    scored = evaluation.score_pairs(target, train, 10, 0.5)
    report = evaluation.evaluation_report(scored, 10).first()
    assert report["tokens"] == 4 and report["accuracy"] == 50.0
    empty = evaluation.evaluation_report(scored.where("n < 0"), 10).first()
    assert empty["tokens"] == 0 and empty["accuracy"] == 0.0


def test_top_k_keeps_ties(spark):
    import math

    rows = [("a", 1, 3.0), ("a", 2, 2.0), ("a", 3, 2.0), ("a", 4, 1.0), ("b", 1, 0.0)]
    logits = spark.createDataFrame(rows, "context string, token int, logit double")
    got = {(r["context"], r["token"]): r["probability"] for r in evaluation.top_k_distribution(logits, 0.5, 2).collect()}
    weights = [math.exp(6), math.exp(4), math.exp(4)]
    assert set(got) == {("a", 1), ("a", 2), ("a", 3), ("b", 1)}
    assert got["a", 1] == pytest.approx(weights[0] / sum(weights)) and got["b", 1] == 1.0
    assert evaluation.top_k_distribution(logits, 1.0, 99).count() == 5
    assert evaluation.top_k_distribution(logits).count() == 5
    with pytest.raises(ValueError):
        evaluation.top_k_distribution(logits, 0.0)


def test_stats_and_limits(spark, model):
    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, None), (4, "[EOS]")], "ordinal long, text string")
    stats = tokens.encode_stats(df, model).first()
    assert (stats["docs_seen"], stats["docs_written"], stats["empty_docs"]) == (4, 2, 0)
    written = tokens.tokenize(df, model).agg(F.sum("n_tokens")).first()[0]
    assert (stats["characters"], stats["tokens"]) == (7, written)
    assert tokens.eos_id(BpeModel(tokens=[b"a"])) is None
    assert bpe.FIRST_BYTE_ID == 4


def test_encoding_sends_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        encode(spark.createDataFrame([("a",)], "text string"), BpeModel())
        assert int(spark.conf.get(key)) <= 500
    finally:
        spark.conf.set(key, before)
