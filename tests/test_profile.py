import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from inkmill.operators import profile as p


def schema(**fields):
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def test_detection():
    s, i = T.StringType(), T.LongType()
    assert p.detect_text_column(schema(body=s, text=s)) == "text"
    assert p.detect_text_column(schema(a=i, note=s)) == "note"
    assert p.detect_text_column(schema(a=i, text=i)) == "text"
    assert p.detect_text_column(schema(a=s, b=s), "b") == "b"
    for bad, forced in ((schema(a=s, b=s), None), (schema(a=i), None), (schema(a=s), "x")):
        with pytest.raises(ValueError):
            p.detect_text_column(bad, forced)


def test_profile(spark, folder):
    long_text = "é" * 400
    pq.write_table(pa.table({"text": [None, " 　", long_text, "ab\n"]}), f"{folder}/a.parquet")
    pq.write_table(pa.table({"text": ["", None]}, schema=pa.schema([("text", pa.string())])), f"{folder}/b.parquet")
    pq.write_table(pa.table({"text": ["bc\U0001f600"]}), f"{folder}/c.parquet")
    rows = p.read_for_profile(spark, folder)
    got = {r["file"]: r for r in p.profile(rows).collect()}
    a = got["a.parquet"]
    assert (a["rows"], a["non_empty_docs"], a["chars"], a["bpe_estimate"], a["unique_chars"]) == (4, 2, 403, 100, 4)
    assert a["sample"] == long_text[:300]
    b = got["b.parquet"]
    assert (b["rows"], b["non_empty_docs"], b["chars"], b["unique_chars"], b["sample"]) == (2, 0, 0, 0, "")
    total = p.global_profile(rows).first()
    assert (total["files"], total["rows"], total["chars"], total["bpe_estimate"]) == (3, 7, 406, 101)
    assert total["unique_chars"] == len(set(long_text + "ab\nbc\U0001f600"))


def test_one_scan_and_exact_alphabet(spark, folder, monkeypatch):
    monkeypatch.setattr(p, "_STEP", 7)  # characters meet the ends of the steps
    texts = {
        "a": ["é\U0001f600x" * 50, "   ", "\U0010ffff\ufffd\n", "ab" * 20_000],
        "b": ["日本語" * 9 + "z", None, "\ud7ff\ue000q"],
    }
    for name, rows in texts.items():
        pq.write_table(pa.table({"text": rows}), f"{folder}/{name}.parquet")
    rows = p.read_for_profile(spark, folder)
    want = {f"{name}.parquet": set("".join(t for t in part if t and t.strip())) for name, part in texts.items()}
    got = {}
    for r in p.file_alphabet(rows).collect():
        got.setdefault(r["file"], []).append(r["character"])
    assert {f: sorted(c) for f, c in got.items()} == {f: sorted(c) for f, c in want.items()}
    files, total = p.profile(rows), p.global_profile(rows)
    assert {r["file"]: r["unique_chars"] for r in files.collect()} == {f: len(c) for f, c in want.items()}
    assert total.first()["unique_chars"] == len(set().union(*want.values()))
    assert total.first()["sample"] == texts["a"][0]
    for df in (files, total, p.file_alphabet(rows)):
        assert df._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1


def test_a_table_of_several_files_is_one_file(spark, folder):
    texts = {
        "a b+%2F.parquet": [["", None], ["xyz", "é"], ["first of the last"]],
        "c.parquet": [["日本"], ["abc", "ab"]],
    }
    for name, parts in texts.items():
        os.mkdir(f"{folder}/{name}")
        for i, part in enumerate(parts):
            pq.write_table(pa.table({"text": pa.array(part, pa.string())}), f"{folder}/{name}/part-{i}.parquet")
    pq.write_table(pa.table({"text": ["plain"]}), f"{folder}/d.parquet")
    rows = p.read_for_profile(spark, folder)
    got = {r["file"]: (r["rows"], r["chars"], r["unique_chars"], r["sample"]) for r in p.profile(rows).collect()}
    assert got == {"a b+%2F.parquet": (5, 21, 15, "xyz"), "c.parquet": (3, 7, 5, "日本"), "d.parquet": (1, 5, 5, "plain")}
    letters = {(r["file"], r["character"]) for r in p.file_alphabet(p.read_for_profile(spark, folder, "c.parquet")).collect()}
    assert letters == {("c.parquet", c) for c in "日本abc"}
    total = p.global_profile(rows).first()
    assert (total["files"], total["rows"], total["sample"]) == (3, 9, "xyz")


def test_bad_files_are_counted(spark, folder):
    pq.write_table(pa.table({"text": ["abc"]}), f"{folder}/a.parquet")
    pq.write_table(pa.table({"x": ["q"], "y": ["r"]}), f"{folder}/b.parquet")
    pq.write_table(pa.table({"body": ["de"]}), f"{folder}/c.parquet")
    open(f"{folder}/d.parquet", "wb").write(b"not parquet")
    pq.write_table(pa.table({"text": pa.array([], pa.string())}), f"{folder}/e.parquet")
    result = p.profile_folder(spark, folder)
    failed = {r["file"]: r["error"] for r in result.failed.collect()}
    assert sorted(failed) == ["b.parquet", "d.parquet"]
    assert "several string columns" in failed["b.parquet"]
    assert result.processed == 3
    files = {r["file"]: r for r in result.files.collect()}
    assert sorted(files) == ["a.parquet", "c.parquet", "e.parquet"]
    assert files["c.parquet"]["text_col"] == "body"
    assert (files["e.parquet"]["rows"], files["e.parquet"]["chars"]) == (0, 0)
    total = result.total.first()
    assert (total["files"], total["rows"], total["chars"], total["unique_chars"]) == (3, 2, 5, 5)


def test_only_empty_files(spark, folder):
    pq.write_table(pa.table({"text": pa.array([], pa.string())}), f"{folder}/a.parquet")
    total = p.profile_folder(spark, folder).total.first()
    assert (total["files"], total["rows"], total["chars"], total["bpe_estimate"]) == (1, 0, 0, 0)


def test_half_read_files_have_failed(spark, folder):
    words = [f"text number {i} " * 10 for i in range(4000)]
    pq.write_table(pa.table({"text": words}), f"{folder}/a.parquet", compression="none", use_dictionary=False, data_page_size=4096)
    pq.write_table(pa.table({"text": words}), f"{folder}/b.parquet", compression="none", use_dictionary=False, data_page_size=4096)
    raw = bytearray(open(f"{folder}/b.parquet", "rb").read())
    middle = len(raw) // 2
    raw[middle : middle + 20_000] = b"\xff" * 20_000
    open(f"{folder}/b.parquet", "wb").write(raw)
    result = p.profile_folder(spark, folder)
    assert [r["file"] for r in result.failed.collect()] == ["b.parquet"]
    assert result.processed == 1
    assert result.total.first()["rows"] == 4000
