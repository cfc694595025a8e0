"""Encode text to token ids and back with a learned model."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions.cleaning import nfc
from inkmill.functions.pretokens import (
    FIRST_BYTE_ID,
    SPECIAL_TOKENS,
    bytes_by_id,
    pretokens_with_specials,
)
from inkmill.operators.bpe import BpeModel
from inkmill.staging import small_batches

# Distinct words whose ids a task remembers before it starts afresh.
WORD_CACHE = 500_000
# Words of at most so many bytes are merged over a plain list of their pairs.
SHORT_WORD = 32
NO_MERGE = (2**63, -1)


def _merge_short(ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    found = [merges.get(pair, NO_MERGE) for pair in zip(ids, ids[1:])]
    while found:
        best = min(found)
        if best is NO_MERGE:
            break
        i = found.index(best)
        del found[i]
        ids[i : i + 2] = [best[1]]
        if i:
            found[i - 1] = merges.get((ids[i - 1], ids[i]), NO_MERGE)
        if i < len(found):
            found[i] = merges.get((ids[i], ids[i + 1]), NO_MERGE)
    return ids


def merge_word(ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge the lowest-ranked adjacent pair, leftmost first, until none is left.

    ``merges`` maps a pair to (rank, new id). Candidates wait in a heap over a linked list,
    so a word of n bytes costs n log n, however long it is. Short words need no heap.
    """
    n = len(ids)
    if n <= SHORT_WORD:
        return _merge_short(ids, merges)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            found = merges.get((ids[i], ids[j]))
            if found is not None:
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, left, right, new_id = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue  # one of the two was merged away in the meantime
        ids[i], ids[j] = new_id, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [s for s in ids if s >= 0]


def _encoder(spark: SparkSession, model: BpeModel):
    """Arrow UDF array<string> -> array<int>; the model is broadcast, bounded by its size."""
    table = {(a, b): (rank, new) for rank, (a, b, new) in reversed(list(enumerate(model.merges)))}
    shared = spark.sparkContext.broadcast(table)
    byte_id = {b: FIRST_BYTE_ID + i for i, b in enumerate(bytes_by_id())}
    specials = {s: [i] for i, s in enumerate(SPECIAL_TOKENS)}

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges = shared.value
        cache: dict[str, list[int]] = dict(specials)
        for words in batches:
            distinct = words.flatten().dictionary_encode()
            if len(cache) > WORD_CACHE:
                cache = dict(specials)
            coded = []
            for word in distinct.dictionary.to_numpy(zero_copy_only=False).tolist():
                ids = cache.get(word)
                if ids is None:
                    ids = merge_word([byte_id[b] for b in word.encode()], merges)
                    cache[word] = ids
                coded.append(ids)
            # Words of the batch by index into the distinct ones, then ids laid end to end.
            table_ids = pa.array(coded, pa.list_(pa.int32()))
            flat = table_ids.take(distinct.indices)
            word_ends = np.concatenate(([0], np.cumsum(flat.value_lengths().to_numpy())))
            n_words = words.value_lengths().fill_null(0).to_numpy()
            ends = word_ends[np.concatenate(([0], np.cumsum(n_words)))]
            offsets = pa.array(ends.astype(np.int32), mask=_null_mask(words))
            yield pa.ListArray.from_arrays(offsets, flat.flatten())

    return encode_words


def _null_mask(words: pa.Array) -> np.ndarray | None:
    if words.null_count == 0:
        return None
    return np.append(words.is_null().to_numpy(zero_copy_only=False), False)


def encode(docs: DataFrame, model: BpeModel, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the token ids of ``text``; narrow, one Arrow batch at a time.

    Normalising and splitting into words happen in the JVM; Python looks up each distinct
    word of a batch once. A special token written out in the text becomes its id.
    """
    small_batches(docs.sparkSession)
    words = pretokens_with_specials(nfc(F.col(text)))
    return docs.withColumn(out, _encoder(docs.sparkSession, model)(words))


def _token_table(model: BpeModel) -> Column:
    """All tokens as Latin-1 strings (one char per byte) in one folded array literal."""
    visible = [b""] * len(SPECIAL_TOKENS) + model.tokens[len(SPECIAL_TOKENS) :]
    # The separator is outside Latin-1.
    return F.split(F.lit("─".join(t.decode("latin-1") for t in visible)), "─")


def decode(ids: Column, model: BpeModel) -> Column:
    """Text of token ids without special tokens; broken UTF-8 becomes U+FFFD.

    Built-in functions only. Unknown ids give nothing.
    """
    table = _token_table(model)
    parts = F.transform(ids, lambda i: F.coalesce(F.get(table, i), F.lit("")))
    raw = F.encode(F.array_join(parts, ""), "ISO-8859-1")
    return F.make_valid_utf8(raw.cast("string"))


def round_trip(docs: DataFrame, model: BpeModel) -> DataFrame:
    """One row: documents with a text, and how many do not come back as their NFC text."""
    coded = encode(docs.where(F.col("text").isNotNull()), model)
    same = decode(F.col("ids"), model) == nfc(F.col("text"))
    checked = coded.select(same.alias("same"))
    return checked.agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(F.when(F.col("same"), 0).otherwise(1)), F.lit(0)).alias("mismatches"),
    )
