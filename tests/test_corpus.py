import dataclasses
import hashlib
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from inkmill import ColumnMap, CorpusConfig
from inkmill.operators import ordering, selection
from inkmill.operators.ordering import running_total_by_range, with_running_total
from inkmill.plans import corpus_build
from inkmill.sources import corpus_files
from inkmill.plans.corpus_build import build_corpus
from inkmill.sources import corpus as src
from inkmill.sources.corpus_files import write_corpus

TEXT = "Le théâtre représente bien la vérité, numéro {}.\n"


def book(i):
    return "".join(TEXT.format("abcdefghij"[i % 10] * (j + 1)) for j in range(8))


def write_files(folder, texts, per_file=4):
    for n in range(0, len(texts), per_file):
        part = texts[n : n + per_file]
        table = pa.table(
            {
                "complete_text": pa.array(part, pa.string()),
                "file_id": [f"f{n + i}" for i in range(len(part))],
                "title": pa.array([None if i else "t" for i in range(len(part))], pa.string()),
                "date": ["1900"] * len(part),
                "author": ["a"] * len(part),
                "unused": [1] * len(part),
            }
        )
        pq.write_table(table, f"{folder}/part {n:03d}.parquet", row_group_size=2)


CFG = CorpusConfig(min_chars=100, min_score=0.0, target_chars=10**9, val_ratio=0.3)


@pytest.fixture
def texts():
    books = [book(i) for i in range(10)]
    return [books[0], None, books[1], "short", books[0], books[2], books[3], books[1], *books[4:], book(0)]


def test_ordinals_follow_file_names_and_rows(spark, folder, texts, monkeypatch):
    write_files(folder, texts)
    for limit in (100_000, 1):  # broadcast offsets, then the shuffled way
        monkeypatch.setattr(ordering, "MAX_SMALL_FILE_TABLE", limit)
        docs = src.read_corpus(spark, folder).orderBy("ordinal").collect()
        assert [d["ordinal"] for d in docs] == list(range(1, len(texts) + 1))
        assert [d["text"] for d in docs] == texts
        assert [d["file_id"] for d in docs] == [f"f{i}" for i in range(len(texts))]


def test_no_matching_file(spark, folder):
    with pytest.raises(FileNotFoundError):
        src.read_corpus(spark, folder, "nothing_*.parquet")


def test_a_table_of_several_files_is_read_whole(spark, folder, texts):
    os.mkdir(f"{folder}/docs.parquet")
    write_files(f"{folder}/docs.parquet", texts)
    pq.write_table(pa.table({"other": [1]}), f"{folder}/other.parquet")
    docs = src.read_corpus(spark, folder, "docs.parquet").orderBy("ordinal").collect()
    assert [(d["ordinal"], d["text"]) for d in docs] == list(enumerate(texts, 1))
    found = src.corpus_files(spark, folder, "docs.parquet")
    again = src.read_corpus_files(spark, found[1:]).orderBy("ordinal").collect()
    assert [d["text"] for d in again] == texts[4:]


def test_only_mapped_columns_are_read(spark, folder, texts):
    write_files(folder, texts)
    plan = src.read_corpus(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "unused" not in plan.split("Relation")[0]


def test_non_string_text_is_missing(spark, folder):
    pq.write_table(pa.table({"complete_text": [1, 2], "x": ["a", "b"]}), f"{folder}/a.parquet")
    cols = ColumnMap(file_id="x", title=None, author=None, date=None)
    docs = src.read_corpus(spark, folder, columns=cols)
    assert [r["text"] for r in docs.collect()] == [None, None]


def brute_build(texts, cfg):
    """Kept ordinals and seen count, document by document."""
    seen_texts, kept, total = set(), [], 0
    for i, text in enumerate(texts, 1):
        if text is None or len(text.strip()) < cfg.min_chars or text in seen_texts:
            continue
        seen_texts.add(text)
        kept.append(i)
        total += len(text.strip())
        if total >= cfg.target_chars:
            return kept, i
    return kept, len(texts)


@pytest.mark.parametrize("target", [10**9, 1500, 1, 0, -5])
def test_build(spark, folder, texts, target):
    write_files(folder, texts)
    cfg = CorpusConfig(min_chars=100, min_score=0.0, target_chars=target, val_ratio=0.3)
    result = build_corpus(src.read_corpus(spark, folder), cfg)
    kept, seen = brute_build(texts, cfg)
    corpus = result.corpus.orderBy("ordinal").collect()
    assert [r["ordinal"] for r in corpus] == kept
    for r in corpus:
        assert r["text"] == texts[r["ordinal"] - 1].strip() and r["chars"] == len(r["text"])
        i = r["ordinal"] - 1
        base = f"f{i}|{'t' if i % 4 == 0 else ''}|a|{r['ordinal']}"
        assert r["doc_id"] == hashlib.sha1(base.encode()).hexdigest()
        share = int(hashlib.md5(r["doc_id"].encode()).hexdigest()[:8], 16) / 0xFFFFFFFF
        assert r["split"] == ("val" if share < 0.3 else "train")
    s = result.summary.first()
    assert (s["total_docs_seen"], s["kept_docs"]) == (seen, len(kept))
    assert s["kept_docs"] + s["rejected_docs"] == s["total_docs_seen"]
    assert sum(s["reject_counts"].values()) == s["rejected_docs"]
    assert s["reject_counts"].get("exact_duplicate", 0) == s["duplicate_docs"]
    assert s["kept_chars"] == s["train_chars"] + s["val_chars"] == sum(r["chars"] for r in corpus)
    if target == 10**9:
        assert s["reject_counts"] == {"missing_text": 1, "too_short": 1, "exact_duplicate": 3}
        assert [r["reason"] for r in result.rejected_report.collect()] == ["too_short"]


@pytest.mark.parametrize("target, first", [(10**9, 1), (1500, 1), (4000, 2), (1, 1), (10**9, 50)])
def test_waves_equal_the_whole_build(spark, folder, target, first):
    texts = [book(i % 7) if i % 3 else book(100 + i) for i in range(30)] + [None, "short", ""]
    write_files(folder, texts, per_file=1)
    cfg = CorpusConfig(min_chars=100, min_score=0.0, target_chars=target, val_ratio=0.3)
    whole = build_corpus(src.read_corpus(spark, folder), cfg)
    waves = corpus_build.build_corpus_in_waves(spark, folder, cfg=cfg, first_files=first)
    for name in ("corpus", "kept_report", "rejected_report", "summary"):
        want, got = ([r.asDict(True) for r in getattr(b, name).collect()] for b in (whole, waves))
        assert sorted(map(repr, got)) == sorted(map(repr, want)), name
    assert waves.cut == whole.cut
    names = sorted(n for n in os.listdir(folder) if n.endswith(".parquet"))
    assert [f.rsplit("/", 1)[-1] for f in waves.files] == names[: len(waves.files)]
    if target < 10**9:
        assert whole.cut <= len(waves.files) < len(names)


def test_rejected_report_reads_no_cleaned_text(spark, folder, texts):
    write_files(folder, texts)
    report = build_corpus(src.read_corpus(spark, folder), CFG).rejected_report
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "sample" in plan and "cleaned" not in plan


def test_many_copies_take_the_join(spark, folder, texts, monkeypatch):
    write_files(folder, texts)
    result = build_corpus(src.read_corpus(spark, folder), CFG)
    few = sorted(r["ordinal"] for r in result.corpus.collect())
    monkeypatch.setattr(corpus_build, "MAX_BROADCAST_ORDINALS", 0)
    assert sorted(r["ordinal"] for r in result.corpus.collect()) == few


def test_one_text_as_most_of_the_corpus(spark, folder):
    texts = [book(0)] * 30 + [book(1)] + [book(0)] * 10
    write_files(folder, texts)
    result = build_corpus(src.read_corpus(spark, folder), CFG)
    assert sorted(r["ordinal"] for r in result.kept_identity.collect()) == [1, 31]
    assert result.summary.first()["duplicate_docs"] == 39
    scored = result.scored
    assert selection.exact_duplicates(scored).count() == 39


def test_written_corpus(spark, folder, texts):
    write_files(folder, texts)
    result = build_corpus(src.read_corpus(spark, folder), CFG)
    out = f"{folder}/out"
    write_corpus(result, out, write_rejected=True)

    def lines(path):
        names = sorted(n for n in os.listdir(path) if n.endswith(".json"))
        return [json.loads(x) for n in names for x in open(f"{path}/{n}", encoding="utf-8")]

    want = result.corpus.orderBy("ordinal").collect()
    for split in ("train", "val"):
        got = lines(f"{out}/corpus/split={split}")
        assert [g["text"] for g in got] == [w["text"] for w in want if w["split"] == split]
        assert all(
            list(g) == ["doc_id", "file_id", "title", "author", "date", "text", "chars", "quality_score"]
            for g in got
        )
    raw = "".join(open(f"{out}/corpus/split=train/{n}").read() for n in os.listdir(f"{out}/corpus/split=train") if n.endswith("json"))
    assert "théâtre" in raw  # not escaped
    report = lines(f"{out}/kept_report")
    assert [r["doc_id"] for r in report] == [w["doc_id"] for w in want]
    assert "title" in report[1] and report[1]["title"] is None  # nulls are written
    assert [r["reason"] for r in lines(f"{out}/rejected_report")] == ["too_short"]
    (summary,) = lines(f"{out}/summary")
    assert summary["kept_docs"] == len(want) and summary["settings"]["min_chars"] == 100
    docs = src.read_jsonl_texts(spark, f"{out}/corpus/split=train").orderBy("ordinal").collect()
    assert [d["text"] for d in docs] == [w["text"] for w in want if w["split"] == "train"]


@pytest.mark.parametrize("target", [10**9, 20_000])
def test_files_are_about_equally_large(spark, folder, monkeypatch, target):
    texts = [book(i % 50) + str(i) for i in range(200)] + ["too short"] * 200
    write_files(folder, texts)
    cfg = dataclasses.replace(CFG, target_chars=target)
    result = build_corpus(src.read_corpus(spark, folder), cfg)
    kept = result.summary.first()["kept_chars"]
    size = max(len(t) for t in texts) * 3
    monkeypatch.setattr(corpus_files, "CHARS_PER_FILE", size)
    sizes = result.kept_identity.select("ordinal", "chars")
    laid = corpus_files.in_scan_order(result.corpus, sizes, size)
    files = laid.groupBy(F.spark_partition_id().alias("file")).agg(
        F.sum("chars").alias("chars"), F.min("ordinal").alias("first"), F.max("ordinal").alias("last")
    )
    rows = files.orderBy("file").collect()
    assert sum(r["chars"] for r in rows) == kept
    assert all(r["chars"] <= 2 * size for r in rows)
    assert len(rows) >= kept / size / 2
    assert all(a["last"] < b["first"] for a, b in zip(rows, rows[1:]))


def test_limit_counts_texts_only(spark):
    rows = [(i + 1, t) for i, t in enumerate([None, "a", "", "b", None, "c", "d"])]
    docs = spark.createDataFrame(rows, "ordinal long, text string")
    for n, want in ((0, []), (1, ["a"]), (3, ["a", "b", "c"]), (9, ["a", "b", "c", "d"])):
        got = src.limit_docs(docs, n).orderBy("ordinal").collect()
        assert [r["text"] for r in got] == want


def test_jsonl_reader(spark, folder):
    path = f"{folder}/a.jsonl"
    rows = ['{"text": "one"}', "", "  　", '{"x": 1}', '{"text": 5}', '{"text": ""}', '{"text": null}',
            '{"text": ["a"]}', '{"text": "2\\né"}']
    open(path, "w", encoding="utf-8").write("\n".join(rows) + "\n")
    got = src.read_jsonl_texts(spark, path).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["text"]) for r in got] == [(1, "one"), (9, "2\né")]
    assert src.count_lines(spark, path).first()[0] == 7
    open(path, "a").write("{broken\n")
    with pytest.raises(Exception):
        src.read_jsonl_texts(spark, path).collect()


def test_jsonl_order_over_many_splits(spark, folder):
    for f in range(3):
        with open(f"{folder}/p{f}.json", "w") as out:
            out.writelines(json.dumps({"text": f"{f}-{i}-" + "x" * 50}) + "\n" for i in range(500))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = [(i + 1, f"{i // 500}-{i % 500}") for i in range(1500)]
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        docs = src.read_jsonl_texts(spark, folder)
        for size in ("5000", "3001", "1000000"):  # the last two after the lines were read
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            for found in (docs, src.read_jsonl_texts(spark, folder)):
                rows = found.orderBy("ordinal").collect()
                assert [(r["ordinal"], r["text"].rsplit("-", 1)[0]) for r in rows] == want
        first = [r["text"].rsplit("-", 1)[0] for r in src.limit_docs(docs, 501).orderBy("ordinal").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert first == [text for _, text in want[:501]]


def test_texts_of_splits(spark, folder):
    for name, lines in (("t", ['{"text": "a"}', "", '{"x": 1}', '{"text": "b"}']), ("v", ['{"text": ""}'])):
        with open(f"{folder}/{name}.jsonl", "w") as out:
            out.write("\n".join(lines) + "\n")
    found = src.read_split_texts(spark, {"train": f"{folder}/t.jsonl", "val": f"{folder}/v.jsonl"})
    rows = sorted((r["split"], r["ordinal"], r["text"]) for r in found.collect())
    assert rows == [("train", 1, "a"), ("train", 3, None), ("train", 4, "b"), ("val", 1, "")]


@pytest.mark.parametrize("block_rows", [1, 7, 1000])
def test_running_totals(spark, block_rows):
    values = [(i * 37) % 11 for i in range(60)]
    rows = [(i + 1, "ab"[i % 3 == 0], v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "ordinal long, k string, v long").repartition(5)
    got = with_running_total(df, "v", "s", block_rows=block_rows).orderBy("ordinal").collect()
    assert [r["s"] for r in got] == [sum(values[: i + 1]) for i in range(60)]
    before = with_running_total(df, "v", "s", keys=["k"], inclusive=False, block_rows=block_rows)
    for r in before.collect():
        assert r["s"] == sum(v for o, k, v in rows if k == r["k"] and o < r["ordinal"])
    ranged = running_total_by_range(df.drop("k"), ["ordinal"], "v", "s").orderBy("ordinal")
    assert [r["s"] for r in ranged.collect()] == [sum(values[: i + 1]) for i in range(60)]


def test_budget_cut_is_minimal(spark):
    values = [(i * 7919) % 50 for i in range(200)]
    df = spark.createDataFrame([(3 * i + 1, v) for i, v in enumerate(values)], "ordinal long, chars long")
    for target in (0, 1, 100, 1234, sum(values), sum(values) + 1):
        want, total = None, 0
        for i, v in enumerate(values):
            total += v
            if total >= target:
                want = 3 * i + 1
                break
        assert selection.budget_cut(df, target, block_rows=16) == want


def test_result_does_not_depend_on_partitions(spark, folder, texts):
    write_files(folder, texts)
    docs = src.read_corpus(spark, folder)
    ids = [
        sorted(r["doc_id"] for r in build_corpus(docs.repartition(n), CFG, False).kept.collect())
        for n in (1, 7)
    ]
    assert ids[0] == ids[1]


def test_no_text_is_shuffled_for_dedup(spark, folder, texts):
    write_files(folder, texts)
    scored = build_corpus(src.read_corpus(spark, folder), CFG).scored
    thin = selection.drop_exact_duplicates(scored.drop("cleaned"))
    plan = thin._jdf.queryExecution().executedPlan().toString()
    assert "cleaned" not in plan.split("ReadSchema")[0] and "Window" not in plan
