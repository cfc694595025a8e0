"""Benchmark decontamination by a broadcast hash set of word n-grams; built-in functions only.

Words are runs of digits, letters and non-ASCII characters, A-Z in lower case. A benchmark item
has one window per ``size`` consecutive words; an item of fewer words, but not none, is one
window. The hashes of a document's windows are looked up in the set of the benchmark's window
hashes, which is broadcast up to ``BROADCAST_WINDOWS`` windows and joined by shuffle beyond.
Hits are verified on the words themselves, and only for documents that have any. Then hit
documents, or the spans of their hit words, can be removed.

Defined cases: a null or wordless text has no words and no hits. Benchmark rows without id or
words are left out; repeated items count once. Rows with one doc_id are told apart by their
text's hash; those that agree in both get the same result. An empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.hashing import small
from inkmill.staging import spread, stage

SIZE = 10
BROADCAST_WINDOWS = 2_000_000  # rows of one long each
BROADCAST_MARKS = 2_000_000  # candidates, of two integers each
BROADCAST_IDS = 1_000_000  # documents, of two longs each

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_WORD_AND_GAP = (
    r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
)


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    lowered = F.translate(text, _UPPER, _UPPER.lower())
    parts = F.split(lowered, _GAP + "+")
    return F.coalesce(F.filter(parts, lambda w: w != ""), F.array().cast("array<string>"))


def window_at(words_: str | Column, start: Column, size: int) -> Column:
    return F.array_join(F.slice(words_, start, F.lit(size)), " ")


def benchmark_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """item_id, n_words, window of the distinct windows of each item."""
    rows = benchmark.where("item_id IS NOT NULL").select("item_id", words(F.col("text")).alias("w"))
    n = F.least(F.size("w"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("w") - n + 1)
    rows = rows.where(F.size("w") > 0).select("item_id", "w", n.alias("n_words"), F.explode(starts).alias("at"))
    window = F.array_join(F.expr("slice(w, at, n_words)"), " ")
    return rows.select("item_id", "n_words", window.alias("window")).distinct()


def _hash(words_: Column | str, at: Column, size: int) -> Column:
    return F.xxhash64(F.slice(words_, at, F.lit(size)))


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SIZE,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> tuple[DataFrame, DataFrame]:
    """Two written tables.

    Per document row: doc_id, text_hash, n_words. Per document with hits: doc_id, text_hash,
    hits (array of word position from 1, length and window).
    """
    windows = stage(benchmark_windows(benchmark, size), "windows")
    known = stage(
        windows.select(F.xxhash64(F.split("window", " ")).alias("hash"), "n_words").distinct(),
        "window-hashes",
    )
    lengths = [r["n_words"] for r in known.select("n_words").distinct().collect()]  # 1 to size
    n_known = known.count()
    if n_known <= broadcast_windows:
        known = F.broadcast(known)
    thin = spread(docs.select("doc_id", "text"))
    rows = thin.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))

    def marks(length: int) -> Column:
        last = F.size("w") - length + 1
        starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts,
            lambda at: F.struct(at.alias("at"), F.lit(length).alias("n_words"), _hash("w", at, length).alias("hash")),
        )

    # One more mark per row carries its number of words past the look-up.
    total = F.array(
        F.struct(F.size("w").alias("at"), F.lit(0).alias("n_words"), F.lit(0).cast("long").alias("hash"))
    )
    marked = rows.select(
        "doc_id", "text_hash", F.explode(F.concat(total, *map(marks, lengths))).alias("m")
    ).select("doc_id", "text_hash", "m.*")
    found = known.withColumn("found", F.lit(True)) if lengths else None
    if found is not None:
        marked = marked.join(found, ["hash", "n_words"], "left").where("found OR n_words = 0")
    seen = stage(marked.select("doc_id", "text_hash", "at", "n_words"), "marks")
    sizes = seen.where("n_words = 0").select("doc_id", "text_hash", F.col("at").alias("n_words"))
    candidates = seen.where("n_words > 0").groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("at", "n_words")).alias("marks")
    )
    candidates = stage(candidates, "candidates")

    # Only documents with candidates are read again, for the words themselves.
    wanted = candidates.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_hash")
    n_marks = candidates.agg(F.sum(F.size("marks") + 2)).first()[0] or 0
    wanted = small(wanted, BROADCAST_MARKS, n_marks)
    again = thin.join(
        wanted, thin["doc_id"].eqNullSafe(wanted["_id"]) & (F.xxhash64("text") == wanted["_hash"])
    )
    again = again.dropDuplicates(["_id", "_hash"]).select("_id", "_hash", "marks", words(F.col("text")).alias("w"))
    spelled = again.select(
        F.col("_id").alias("doc_id"),
        F.col("_hash").alias("text_hash"),
        F.explode(
            F.transform(
                "marks",
                lambda m: F.struct(
                    m["at"].alias("at"),
                    m["n_words"].alias("n_words"),
                    F.array_join(F.slice("w", m["at"], m["n_words"]), " ").alias("window"),
                ),
            )
        ).alias("h"),
    ).select("doc_id", "text_hash", "h.*")
    texts = windows.select("window").distinct()
    if n_known <= broadcast_windows:
        texts = F.broadcast(texts)
    verified = spelled.join(texts, "window")
    hits = verified.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("at", "n_words", "window")).alias("hits")
    )
    return sizes, stage(hits, "hits")


def hit_positions(hits: str = "hits") -> Column:
    """Distinct positions of the words inside any hit."""
    spans = F.transform(hits, lambda h: F.sequence(h["at"], h["at"] + h["n_words"] - 1))
    return F.array_distinct(F.flatten(spans))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document row."""
    sizes, hits = find_hits(docs, benchmark, size)
    windows = benchmark_windows(benchmark, size).select("item_id", "window")
    each = hits.select("doc_id", "text_hash", F.explode("hits.window").alias("window")).distinct()
    items = each.join(windows, "window").select("doc_id", "text_hash", "item_id").distinct()
    items = items.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items")
    )
    counted = hits.select("doc_id", "text_hash", F.size(hit_positions()).alias("hit"))
    key = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    named = counted.join(items, key(counted, items), "left").select(
        counted["doc_id"], counted["text_hash"], "hit", "items"
    )
    named = stage(named, "contaminated")
    joined = sizes.join(named, key(sizes, named), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        sizes["doc_id"],
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or without the spans of their hit words.

    A removed span takes the separators after its words along. All columns are kept.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove documents or spans, not {remove!r}")
    _, hits = find_hits(docs, benchmark, size)
    # Names no column of docs has.
    names = {c: f"_{c}_{'x' * max(map(len, docs.columns))}" for c in ("doc_id", "text_hash", "hits")}
    found = hits.select([F.col(c).alias(n) for c, n in names.items()])
    same = docs["doc_id"].eqNullSafe(found[names["doc_id"]]) & (
        F.xxhash64(docs["text"]) == found[names["text_hash"]]
    )
    if remove == "documents":
        keys = found.select(names["doc_id"], names["text_hash"])
        return docs.join(small(keys, BROADCAST_IDS), same, "left_anti")
    joined = docs.join(found, same, "left")
    parts = F.regexp_extract_all(F.col("text"), F.lit(_WORD_AND_GAP), F.lit(0))
    lead = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    gone = hit_positions(names["hits"])
    kept = F.filter(parts, lambda _, i: ~F.array_contains(gone, i + 1))
    text = F.when(F.col(names["hits"]).isNull(), F.col("text")).otherwise(
        F.concat(lead, F.array_join(kept, ""))
    )
    return joined.withColumn("text", text).select(docs.columns)
