"""Exact top-k inner products over a bit-sliced index.

Every vector component is quantised to ``floor(scale * x)``. Blocks of rows keep, for each
attribute, one bitmap per binary digit (slice). A query's scores of a whole block come from
adding attribute slices with bitmap arithmetic: the query's digits are recoded to -1, 0, 1,
each nonzero digit adds one attribute (or its complement) with a carry-save adder over all
slices at once. The best rows are then picked from the most significant score slice down;
rows tied at the boundary are resolved by the smallest id.

The work is every stated query against every row, in blocks of ``BLOCK_ROWS`` by
``BLOCK_QUERIES``; a task holds one block of each.

Defined cases: a vector that is null, or holds a null or non-finite component, takes no part;
neither does a row without id. A query is compared with vectors of its own length. An empty
vector scores 0. Rows with the query's own id are no candidates; an id that occurs on several
rows counts as several candidates, and as one query (its smallest vector). No valid rows: an
empty result. Scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.staging import stage

BLOCK_ROWS = 16_384
BLOCK_QUERIES = 128

_INDEX = "dim int, block long, ids binary, base binary, slices binary, n_slices int"
_HITS = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """Columns id, dim, q (long components) of the rows that take part."""

    def finite(x: Column) -> Column:
        wide = x.cast("double")
        return x.isNotNull() & ~F.isnan(wide) & (F.abs(wide) < float("inf"))

    vec = F.col(vec_col)
    usable = vectors.where(F.col(id_col).isNotNull() & vec.isNotNull() & F.forall(vec, finite))
    return usable.select(
        F.col(id_col).cast("long").alias("id"),
        F.size(vec_col).alias("dim"),
        F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("q"),
    )


def slice_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest value per attribute, and slices [attribute, digit, word] of what lies above it.

    Rows are bit positions: row r is bit r % 64 of word r // 64.
    """
    n, dim = values.shape
    base = values.min(axis=0) if n else np.zeros(dim, np.int64)
    above = (values - base).astype(np.uint64)
    digits = max(1, int(above.max()).bit_length()) if above.size else 1
    words = max(1, -(-n // 64))
    slices = np.zeros((dim, digits, words * 8), np.uint8)
    for d in range(digits):
        bits = ((above >> np.uint64(d)) & np.uint64(1)).astype(np.uint8).T
        packed = np.packbits(bits, axis=1, bitorder="little")
        slices[:, d, : packed.shape[1]] = packed
    return base, slices.view(np.uint64)


def signed_digits(value: int) -> list[int]:
    """Digits -1, 0, 1 of ``value`` from the lowest up, no two neighbours nonzero."""
    out = []
    while value:
        if value & 1:
            out.append(2 - (value & 3))
            value -= out[-1]
        else:
            out.append(0)
        value >>= 1
    return out


def score_slices(query: np.ndarray, padded: np.ndarray, inverse: np.ndarray, digits: int):
    """Slices of the block's scores, and the constant to add to them.

    ``padded`` holds the attribute slices with room for the sum of all attributes above them.
    """
    dim, height, words = padded.shape
    by_place: dict[int, list[tuple[int, int]]] = {}
    for a in range(dim):
        for place, digit in enumerate(signed_digits(int(query[a]))):
            if digit:
                by_place.setdefault(place, []).append((a, digit))
    total = np.zeros((0, words), np.uint64)
    constant = 0
    for place in range(max(by_place, default=-1), -1, -1):
        low = np.zeros((1, words), np.uint64)
        total = np.concatenate([low, total])  # twice the sum so far
        terms = by_place.get(place)
        if not terms:
            continue
        sums = np.zeros((height, words), np.uint64)
        carries = np.zeros((height, words), np.uint64)
        either = np.empty_like(sums)
        both = np.empty_like(sums)
        for a, digit in terms:
            term = padded[a] if digit > 0 else inverse[a]
            if digit < 0:
                constant -= ((1 << digits) - 1) << place
            np.bitwise_xor(sums, term, out=either)
            np.bitwise_and(sums, term, out=both)
            np.bitwise_xor(either, carries, out=sums)
            np.bitwise_and(either, carries, out=either)
            np.bitwise_or(either, both, out=either)
            carries[1:] = either[:-1]
            carries[0] = 0
        total = add_slices(total, add_slices(sums, carries))
    return total, constant


def add_slices(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two bit-sliced numbers, with one slice more than the longer."""
    height = max(len(a), len(b)) + 1
    out = np.zeros((height, a.shape[1]), np.uint64)
    carry = np.zeros(a.shape[1], np.uint64)
    for i in range(height):
        x = a[i] if i < len(a) else None
        y = b[i] if i < len(b) else None
        if x is None and y is None:
            out[i] = carry
            carry = np.zeros_like(carry)
        elif x is None or y is None:
            z = y if x is None else x
            out[i] = z ^ carry
            carry = z & carry
        else:
            half = x ^ y
            out[i] = half ^ carry
            carry = (x & y) | (half & carry)
    return out


def best_rows(slices: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest among the allowed rows; ties go to the lower position."""
    sure = np.zeros_like(allowed)
    open_ = allowed.copy()
    wanted = k
    for level in slices[::-1]:
        upper = open_ & level
        n = int(np.bitwise_count(upper).sum())
        if n > wanted:
            open_ = upper
        else:
            sure |= upper
            open_ &= ~level
            wanted -= n
            if not wanted:
                break
    rows = positions(sure)
    if wanted:
        rows = np.concatenate([rows, positions(open_)[:wanted]])
    return rows


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def read_rows(rows: np.ndarray, slices: np.ndarray, constant: int) -> list[int]:
    out = []
    for r in rows:
        word, bit = int(r) >> 6, np.uint64(int(r) & 63)
        column = (slices[:, word] >> bit) & np.uint64(1)
        out.append(constant + sum(1 << i for i, b in enumerate(column) if b))
    return out


def search_block(queries, query_ids, ids, base, slices, k) -> Iterator[tuple[int, int, int]]:
    """(query id, row id, score) of the k best rows of one block for each query."""
    dim, digits, words = slices.shape
    height = digits + max(1, int(dim).bit_length()) + 1
    padded = np.zeros((dim, height, words), np.uint64)
    padded[:, :digits] = slices
    inverse = padded.copy()
    inverse[:, :digits] = ~slices
    valid = np.zeros(words * 64, np.uint8)
    valid[: len(ids)] = 1
    everyone = np.packbits(valid, bitorder="little").view(np.uint64)
    for query_id, query in zip(query_ids, queries):
        allowed = everyone
        first, last = np.searchsorted(ids, [query_id, query_id + 1])
        if last > first:
            allowed = everyone.copy()
            for r in range(first, last):
                allowed[r >> 6] &= ~np.uint64(1 << (r & 63))
        total, constant = score_slices(query, padded, inverse, digits)
        constant += sum(int(q) * int(b) for q, b in zip(query, base))
        rows = best_rows(total, allowed, k)
        for r, score in zip(rows, read_rows(rows, total, constant)):
            yield int(query_id), int(ids[r]), score


def _matrices(batches: Iterator[pa.RecordBatch], size: int):
    """(dim, ids, values) of at most ``size`` rows each, rows of one vector length together."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    counts: dict[int, int] = {}
    for batch in batches:
        ids = batch["id"].to_numpy(zero_copy_only=False)
        dims = batch["dim"].to_numpy(zero_copy_only=False)
        flat = batch["q"].flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(dims)])
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            values = flat[starts[rows][:, None] + np.arange(dim)].astype(np.int64)
            for part in range(0, len(rows), size):
                cut = slice(part, part + size)
                held.setdefault(dim, []).append((ids[rows[cut]], values[cut]))
                counts[dim] = counts.get(dim, 0) + len(rows[cut])
                if counts[dim] >= size:
                    yield int(dim), *_joined(held.pop(dim))
                    counts[dim] = 0
    for dim, parts in held.items():
        yield int(dim), *_joined(parts)


def _joined(parts):
    ids = np.concatenate([p[0] for p in parts])
    values = np.concatenate([p[1] for p in parts])
    order = np.argsort(ids, kind="stable")
    return ids[order], values[order]


def build_index(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Written table of bit-sliced blocks of :func:`quantised` rows."""
    blocks = max(1, -(-rows.count() // block_rows))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A block's number is its task's, then that plus the number of tasks, and so on.
        number = TaskContext.get().partitionId()
        for dim, ids, values in _matrices(batches, block_rows):
            base, slices = slice_block(values)
            yield pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "block": pa.array([number], pa.int64()),
                    "ids": [ids.astype(np.int64).tobytes()],
                    "base": [base.astype(np.int64).tobytes()],
                    "slices": [slices.tobytes()],
                    "n_slices": pa.array([slices.shape[1]], pa.int32()),
                }
            )
            number += blocks

    return stage(rows.repartition(blocks, "id").mapInArrow(build, _INDEX), "bit-slices")


def top_k(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for each of ``queries`` (id, dim, q)."""
    one_each = queries.groupBy("id").agg(F.min("q").alias("q")).withColumn("dim", F.size("q"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, values in _matrices(batches, BLOCK_QUERIES):
            yield pa.RecordBatch.from_pydict(
                {
                    "q_dim": pa.array([dim], pa.int32()),
                    "q_ids": [ids.astype(np.int64).tobytes()],
                    "q_values": [values.tobytes()],
                }
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                asked = np.frombuffer(row["q_ids"], np.int64)
                dim = row["dim"]
                values = np.frombuffer(row["q_values"], np.int64).reshape(len(asked), dim)
                base = np.frombuffer(row["base"], np.int64)
                words = max(1, -(-len(ids) // 64))
                slices = np.frombuffer(row["slices"], np.uint64)
                slices = slices.reshape(dim, row["n_slices"], words)
                found = list(search_block(values, asked, ids, base, slices, k))
                yield pa.RecordBatch.from_pydict(
                    {
                        name: pa.array([f[i] for f in found], pa.int64())
                        for i, name in enumerate(("query_id", "vec_id", "score"))
                    }
                )

    one_each = stage(one_each, "queries")
    parts = max(1, -(-one_each.count() // BLOCK_QUERIES))
    packed = one_each.coalesce(parts).mapInArrow(
        pack, "q_dim int, q_ids binary, q_values binary"
    )
    packed = stage(packed, "query-blocks")
    last = index.agg(F.max("block")).first()[0]
    asked = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last or 0))))
    pairs = asked.join(index, (asked.block == index.block) & (asked.q_dim == index.dim))
    # Few heavy rows: give each pair of blocks its own turn on the cluster.
    pairs = pairs.withColumn("turn", F.xxhash64(asked.block, "q_ids")).drop("block")
    slots = index.sparkSession.sparkContext.defaultParallelism
    hits = pairs.repartition(4 * slots, "turn").mapInArrow(search, _HITS)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search(
    vectors: DataFrame,
    k: int,
    every: int,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: float = 256.0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Top k for the rows whose id is divisible by ``every``, against all rows."""
    rows = quantised(vectors, id_col, vec_col, scale)
    return top_k(build_index(rows, block_rows), rows.where(F.col("id") % every == 0), k)
