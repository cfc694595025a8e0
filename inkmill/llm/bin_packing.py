"""Best-fit packing of token sequences by bin completion.

Documents are encoded, closed with an end id and cut into pieces of at most ``capacity``
tokens. Only the number of pieces of each length (``capacity`` numbers at most) goes to the
driver, where bins are planned; pieces then find their place by their rank among the pieces of
their length, so the same plan serves any number of documents.

Planning is branch and bound over bins: the largest length left is completed by fillings in
order of waste, larger pieces first; a single piece that fills the rest exactly dominates all
other fillings. A filling is used as often as its lengths last. A dive ends when its waste
shows that it cannot beat the incumbent. The first incumbent is the best of best-fit decreasing
and of its variants that put one to ``SMALLEST`` of the smallest pieces beside the largest before
they fit others (lengths near a third of the capacity need that). Later dives take the second-best
filling at one step. The search stops at the lower bound or after ``DIVES`` dives, of ``NODES``
partial fillings for each completion, and keeps the best plan; it is a bounded search, not proof
of the least number of bins.

Defined cases: a null text counts as empty and becomes one piece that holds the end id alone.
An empty table gives an empty result. Repeated rows are packed as often as they occur. A
document longer than ``capacity`` is cut; its full pieces have sequences of their own.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.llm.worker import small_batches, worker_state
from inkmill.staging import stage

SMALLEST = 3  # incumbents put up to so many smallest pieces beside the largest
DIVES = 40
NODES = 3_000
SALTS = 128
_CHUNKS, _PARTS = 400_000, 300_000  # remembered
_TEXTS = 50  # encoded together
# ASCII and Latin letters with one lower-case letter each, then ASCII punctuation: such a chunk
# has the tokens of the lower-case word followed by those of the punctuation.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-/:-@\[-`{-~]*)")
_UNUSUAL_BLANK = re.compile("[\x1c-\x1f]")

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Places(dict):
    """Numbers of chunks; a chunk not seen before gets the next one and is noted as new."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.new.append(chunk)
        return number


def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    """``array`` or a copy twice as long, with room for ``more`` behind its ``used`` entries."""
    if used + more <= len(array):
        return array
    grown = np.zeros(2 * (used + more), array.dtype)
    grown[:used] = array[:used]
    return grown


class ChunkEncoder:
    """Ids of whole texts, encoding each distinct chunk between spaces once.

    The tokenizer drops white space before anything else looks across it, so a text has the
    ids of its chunks one after another. The ids of all chunks remembered lie in one array;
    texts gather theirs from it. Of more than ``_CHUNKS`` the most used third stays.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts: dict[str, bytes] = {}
        self.clear()

    def clear(self) -> None:
        self.places = _Places()
        self.known = 0
        self.ids = np.zeros(0, "<u4")
        self.ends = np.zeros(1, np.int64)  # of chunk i in ``ids``: ends[i] to ends[i + 1]
        self.uses = np.zeros(0, np.int32)  # of chunk i, by texts

    def _forget(self) -> None:
        """Keep the most used third of the chunks, numbered anew."""
        uses, names = self.uses[: self.known], list(self.places)
        kept = np.sort(np.argsort(-uses, kind="stable")[: _CHUNKS // 3])
        ids = self._gather(kept)
        sizes = self.ends[kept + 1] - self.ends[kept]
        self.clear()
        for i in kept.tolist():
            self.places[names[i]]
        self.places.new = []
        self.known, self.ids = len(kept), ids
        self.ends = np.concatenate([self.ends, np.cumsum(sizes)])
        self.uses = uses[kept] // 2  # so that chunks of earlier texts give way in the end

    def _gather(self, at: np.ndarray) -> np.ndarray:
        """Ids of the chunks with these numbers, one after another."""
        starts = self.ends[at]
        sizes = self.ends[at + 1] - starts
        first = np.cumsum(sizes) - sizes
        return self.ids[np.arange(sizes.sum()) + np.repeat(starts - first, sizes)]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _plain_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of one word each: encoded as one text and cut behind each word's end."""
        ids = np.array(self.tokenizer.encode(" ".join(parts), add_special_tokens=False).ids, "<u4")
        cuts = np.flatnonzero(self.closes[ids]) + 1
        if len(cuts) != len(parts) or len(cuts) and cuts[-1] != len(ids):
            return self._library(parts)
        raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def _learn(self) -> None:
        """Ids of the new chunks: of their plain parts, so that case and punctuation share them."""
        new, self.places.new = self.places.new, []
        if len(self.parts) > _PARTS:  # frequent parts are met early
            self.parts = dict(islice(self.parts.items(), _PARTS // 3))
        parts = self.parts
        split: list[tuple[str, ...]] = []
        plain, other = {}, {}
        for chunk in new:
            if chunk.isascii() and chunk.isalpha():
                own = (chunk.lower(),)
            elif (match := _PLAIN.fullmatch(chunk)) and "<|" not in chunk:
                own = (match[1].lower(), match[2]) if match[2] else (match[1].lower(),)
            else:
                split.append((chunk,))
                if chunk not in parts:
                    other[chunk] = None
                continue
            split.append(own)
            for part in own:
                if part not in parts:
                    plain[part] = None
        for unknown, encode in ((list(plain), self._plain_parts), (list(other), self._library)):
            for some in range(0, len(unknown), 200):
                parts.update(zip(unknown[some : some + 200], encode(unknown[some : some + 200])))
        found = [parts[own[0]] if len(own) == 1 else parts[own[0]] + parts[own[1]] for own in split]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ends = self.ends[self.known] + np.cumsum(sizes)
        ids = np.frombuffer(b"".join(found), "<u4")
        self.ids = _room(self.ids, self.ends[self.known], len(ids))
        self.ids[self.ends[self.known] : ends[-1]] = ids
        self.ends = _room(self.ends, self.known + 1, len(ends))
        self.ends[self.known + 1 : self.known + 1 + len(ends)] = ends
        self.known += len(ends)
        self.uses = _room(self.uses, self.known - len(ends), len(ends))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit numbers."""
        if len(self.places) > _CHUNKS:
            self._forget()
        chunks, whole = [], {}
        for i, text in enumerate(texts):
            if _UNUSUAL_BLANK.search(text):  # the library does not take these for white space
                whole[i] = np.frombuffer(self._library([text])[0], "<u4")
                text = ""
            chunks.append(np.fromiter(map(self.places.__getitem__, text.split()), np.int64))
        if self.places.new:
            self._learn()
        out = []
        for i, at in enumerate(chunks):
            self.uses[at] += 1
            out.append(whole[i] if i in whole else self._gather(at))
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return self.encode_all([text])[0].tobytes()


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's pieces."""

    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_state(f"chunks {tokenizer_path}")
        if not cache:
            cache["encoder"] = ChunkEncoder(tokenizer_path)
        encoder = cache["encoder"]
        end = np.array([end_id], "<u4")
        width = 4 * capacity
        for batch in batches:
            rows = []
            found: list[np.ndarray] = []
            for part in range(0, batch.num_rows, _TEXTS):
                found += encoder.encode_all([t or "" for t in batch["text"].slice(part, _TEXTS).to_pylist()])
            for doc_id, own_ids in zip(batch["doc_id"].to_pylist(), found):
                ids = np.concatenate([own_ids, end]).tobytes()
                for piece, at in enumerate(range(0, len(ids), width)):
                    own = ids[at : at + width]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            columns = zip(*rows) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names)
            )

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return thin.mapInArrow(cut, _PIECES)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that no packing can do without (volume, and Martello and Toth's second bound)."""
    volume = -(-sum(n * length for length, n in counts.items()) // capacity)
    lengths = np.array(sorted(counts), np.int64)
    if not len(lengths):
        return 0
    n = np.array([counts[int(x)] for x in lengths], np.int64)
    total, number = np.concatenate([[0], np.cumsum(n * lengths)]), np.concatenate([[0], np.cumsum(n)])
    half = np.searchsorted(lengths, capacity // 2, side="right")
    best = volume
    for small in range(half + 1):
        # Pieces above capacity - k need a bin each without company of pieces of k or more.
        k = int(lengths[small]) if small < half else capacity // 2 + 1
        large = max(int(np.searchsorted(lengths, capacity - k, side="right")), half)
        alone, middle = number[-1] - number[large], number[large] - number[half]
        free = middle * capacity - (total[large] - total[half])
        rest = total[half] - total[min(small, half)] - free
        best = max(best, int(alone + middle + max(0, -(-int(rest) // capacity))))
    return best


class _Stock:
    """Lengths left and how many of each."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.left = {k: v for k, v in counts.items() if v > 0}
        self.lengths = sorted(self.left)

    def take(self, filling: list[int], times: int) -> None:
        for length in filling:
            self.left[length] -= times
        for length in set(filling):
            if not self.left[length]:
                del self.left[length]
                self.lengths.remove(length)

    def times(self, filling: list[int]) -> int:
        return min(self.left[x] // filling.count(x) for x in set(filling))

    def best_fit(self, capacity: int, smallest: int = 0) -> list[int]:
        """The largest length, the ``smallest`` ones if they fit, then always the largest that fits."""
        filling, room = [], capacity
        if smallest:
            filling, room = [self.lengths[-1]], capacity - self.lengths[-1]
            for length in self.lengths:
                while (
                    len(filling) <= smallest
                    and length <= room
                    and filling.count(length) < self.left[length]
                ):
                    filling.append(length)
                    room -= length
                if len(filling) > smallest or length > room:
                    break
        while True:
            at = bisect_right(self.lengths, room) - 1
            while at >= 0 and filling.count(self.lengths[at]) >= self.left[self.lengths[at]]:
                at -= 1
            if at < 0:
                return filling
            filling.append(self.lengths[at])
            room -= self.lengths[at]

    def completions(self, capacity: int, most_waste: int) -> list[list[int]]:
        """Up to two fillings around the largest length, by waste; [] if all waste too much."""
        first = self.lengths[-1]
        room = capacity - first
        own = 1 if room == first else 0
        if self.left.get(room, 0) > own:
            return [[first, room]]
        found: list[tuple[int, list[int]]] = []
        nodes = 0

        def search(room: int, top: int, chosen: list[int]) -> bool:
            nonlocal nodes
            at = min(bisect_right(self.lengths, room), top + 1) - 1
            extended = False
            while at >= 0 and nodes < NODES:
                length = self.lengths[at]
                used = chosen.count(length) + (length == first)
                if used < self.left[length]:
                    nodes += 1
                    extended = True
                    chosen.append(length)
                    done = search(room - length, at, chosen)
                    chosen.pop()
                    if done:
                        return True
                    if found and length < room - found[-1][0] and self.lengths[0] > room - length:
                        break  # alone in the rest, smaller pieces only waste more
                at -= 1
            if not extended and room <= most_waste and (not found or room < found[0][0]):
                found.insert(0, (room, [first, *chosen]))
                del found[2:]
            return not extended and room == 0

        search(room, len(self.lengths) - 1, [])
        return [filling for _, filling in found]


def _dive(counts: dict[int, int], capacity: int, most_waste: int, turn: int):
    """Plan of one descent, or None once it wastes more than allowed."""
    stock, plan, waste, step = _Stock(counts), [], 0, 0
    while stock.lengths:
        fillings = stock.completions(capacity, most_waste - waste)
        if not fillings:
            return None
        filling = fillings[1] if step == turn and len(fillings) > 1 else fillings[0]
        lost = capacity - sum(filling)
        times = stock.times(filling)
        if lost:
            times = min(times, (most_waste - waste) // lost)
        if not times:
            return None
        waste += lost * times
        stock.take(filling, times)
        plan.append((filling, times))
        step += 1
    return plan


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Fillings (lengths in one bin) and how many bins have each."""
    volume = sum(n * length for length, n in counts.items())
    bound = lower_bound(counts, capacity)
    best, bins = [], 0
    for smallest in range(SMALLEST + 1):
        stock, plan = _Stock(counts), []
        while stock.lengths:
            filling = stock.best_fit(capacity, smallest)
            plan.append((filling, times := stock.times(filling)))
            stock.take(filling, times)
        used = sum(times for _, times in plan)
        if not best or used < bins:
            best, bins = plan, used
    for dive in range(DIVES):
        if bins <= bound:
            break
        plan = _dive(counts, capacity, (bins - 1) * capacity - volume, dive - 1)
        if plan:
            best, bins = plan, sum(times for _, times in plan)
    return best


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with sequence_id and offset. Needs columns doc_id, piece, start, length,
    ids_crc32; pieces that agree in all of them are interchangeable."""
    pieces = stage(pieces, "pieces")
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).alias("salt")
    salted = pieces.select("*", salt)
    # At most capacity * SALTS rows, and capacity of them for the driver.
    groups = stage(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    sizes = groups.groupBy("length").agg(F.sum("n").alias("n")).collect()
    counts = {r["length"]: r["n"] for r in sizes}
    if max(counts, default=0) > capacity:
        raise ValueError("a piece is longer than a sequence")
    keys, firsts, each, offsets = [], [], [], []
    used = dict.fromkeys(counts, 0)
    sequence = 0
    for filling, times in plan_bins(counts, capacity):
        offset = 0
        for length in sorted(set(filling), reverse=True):
            many = filling.count(length)
            keys.append((length << 44) + used[length])
            firsts.append(sequence)
            each.append(many)
            offsets.append(offset)
            used[length] += many * times
            offset += many * length
        sequence += times
    order = np.argsort(keys) if keys else []
    table = [np.array(c, np.int64)[order] for c in (keys, firsts, each, offsets)] if keys else []
    shared = pieces.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        starts, first, many, offset = shared.value
        key = (length.to_numpy() << 44) + rank.to_numpy()
        at = np.searchsorted(starts, key, side="right") - 1
        nth = key - starts[at]
        return pd.DataFrame(
            {
                "sequence_id": first[at] + nth // many[at],
                "offset": offset[at] + nth % many[at] * length.to_numpy(),
            }
        )

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order_in = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = salted.withColumn("nth", F.row_number().over(order_in) - 1)
    ranked = ranked.join(F.broadcast(bases), ["length", "salt"])
    placed = ranked.withColumn("place", place(F.col("length"), F.col("base") + F.col("nth")))
    return placed.select(*pieces.columns, "place.sequence_id", "place.offset")
