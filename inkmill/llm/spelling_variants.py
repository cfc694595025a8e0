"""Spelling variants: words one edit apart, found by K-d trees over letter counts.

An edit changes a word's letter counts by little: a replaced letter takes one from a count and
adds one to another (L1 distance two), an inserted letter adds one. So the words near a given
one lie in a small box around its count vector, in the tree of its own length or of the length
above. Per length, a coarse tree from a bounded sample of the vocabulary (``SAMPLE`` words a
cell) deals the words into cells; a word is stored in one cell and sent as a query to all whose
boxes it can reach. Each cell is one group: it builds a K-d tree with tight boxes over its words,
prunes boxes that have more than one letter too many or too few, and verifies letter order on
the words of the leaves that remain. Every word is in some cell, whatever the sample, so links
don't depend on it; only the cells' sizes do.

Words are counted per task before they are shuffled. Per length the number of cells is at most
``MAX_CELLS``, so the broadcast trees are bounded; beyond that cells grow with the vocabulary.

Defined cases: null and empty texts have no words; a null id counts as the empty text. An empty
table gives an empty result. Repeated rows count as often as they occur. Words may be of any
length. Other columns of the input are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.worker import small_batches
from inkmill.staging import stage

MIN_LENGTH = 6
MIN_COUNT = 5
FORM_FACTOR = 5
SLIP = 199
CELL = 8_192
MAX_CELLS = 4_096
SAMPLE = 32
LEAF = 24
PRUNE_LETTERS = 32  # letters looked at when boxes are pruned
LETTERS = 26 + 64
_BLOCK = 16_384
_HELD_WORDS = 300_000

# One byte a letter: a-z, and U+00C0 to U+00FF as in Latin-1; every other byte ends a word.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def slipped(words: list[bytes], doc_id: str) -> dict[bytes, int]:
    """Counts of a document's long enough words, after the letter deletions by hash."""
    found: Counter[bytes] = Counter()
    prefix = zlib.crc32(f"{doc_id}:".encode())
    for word, n in Counter(words).items():
        if len(word) < MIN_LENGTH:
            continue
        as_text = word if word.isascii() else word.decode("latin-1").encode()
        h = zlib.crc32(as_text, prefix)
        if h % SLIP == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < MIN_LENGTH:
                continue
        found[word] += n
    return found


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n of all words that are long and frequent enough."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            batch = pa.record_batch([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                raw = text.as_py()
                if raw:
                    words = raw.encode("latin-1", "replace").translate(_TO_WORDS).split(b" ")
                    held.update(slipped(words, doc_id.as_py() or ""))
                if len(held) >= _HELD_WORDS:
                    yield flush()
        yield flush()

    rows = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def letter_codes(words: list[str]) -> np.ndarray:
    """Letter numbers of words of one length, [word, place]."""
    raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
    return np.where(raw < 128, raw - np.uint8(97), raw - np.uint8(0xC0 - 26))


def letter_counts(codes: np.ndarray) -> np.ndarray:
    rows, width = codes.shape
    at = codes + (np.arange(rows) * LETTERS)[:, None]
    counts = np.bincount(at.ravel(), minlength=rows * LETTERS).reshape(rows, LETTERS)
    return counts.astype(np.int8 if width < 127 else np.int32)


def halving(counts: np.ndarray) -> tuple[int, int] | None:
    """Letter and count that cut the rows most evenly: rows with at most that count go left."""
    low, high = counts.min(0), counts.max(0)
    middle = np.minimum(np.median(counts, axis=0).astype(np.int64), high - 1)
    best, found = 0, None
    for bound in (middle, middle - 1):
        left = (counts <= bound).sum(0)
        even = np.where((low <= bound) & (bound < high), np.minimum(left, len(counts) - left), 0)
        letter = int(np.argmax(even))
        if even[letter] > best:
            best, found = even[letter], (letter, int(bound[letter]))
    return found


@dataclass
class CellTree:
    """Coarse tree of one length; a node is a cell number or (letter, bound, left, right)."""

    root: int | tuple
    cells: int

    @classmethod
    def build(cls, counts: np.ndarray, cells: int) -> CellTree:
        """Tree of up to about ``cells`` cells with equal shares of the sampled rows."""
        made = 0

        def grow(rows: np.ndarray, wanted: int) -> int | tuple:
            nonlocal made
            cut = halving(rows) if wanted > 1 and len(rows) > 1 else None
            if cut is None:
                made += 1
                return made - 1
            goes = rows[:, cut[0]] <= cut[1]
            share = max(1, min(wanted - 1, round(wanted * goes.mean())))
            return (*cut, grow(rows[goes], share), grow(rows[~goes], wanted - share))

        return cls(grow(counts, cells), made)

    def own(self, counts: np.ndarray) -> np.ndarray:
        """The cell that stores each row."""
        out = np.zeros(len(counts), np.int64)

        def walk(node: int | tuple, rows: np.ndarray) -> None:
            if isinstance(node, int):
                out[rows] = node
                return
            letter, bound, left, right = node
            goes = counts[rows, letter] <= bound
            walk(left, rows[goes])
            walk(right, rows[~goes])

        walk(self.root, np.arange(len(counts)))
        return out

    def reached(self, counts: np.ndarray, spare: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cells within reach: one letter missing and ``spare`` letters too many at most."""
        found: list[tuple[np.ndarray, int]] = []

        def walk(node: int | tuple, rows: np.ndarray, low: dict, high: dict) -> None:
            if not len(rows):
                return
            if isinstance(node, int):
                found.append((rows, node))
                return
            letter, bound, left, right = node
            for child, lows, highs in (
                (left, low, {**high, letter: min(bound, high.get(letter, bound))}),
                (right, {**low, letter: max(bound + 1, low.get(letter, 0))}, high),
            ):
                missing, extra = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
                for j, least in lows.items():
                    missing += np.maximum(least - counts[rows, j].astype(np.int64), 0)
                for j, most in highs.items():
                    extra += np.maximum(counts[rows, j].astype(np.int64) - most, 0)
                walk(child, rows[(missing <= 1) & (extra <= spare)], lows, highs)

        walk(self.root, np.arange(len(counts)), {}, {})
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return (
            np.concatenate([rows for rows, _ in found]),
            np.concatenate([np.full(len(rows), cell) for rows, cell in found]),
        )


class WordTree:
    """K-d tree with tight boxes over the words of a cell."""

    def __init__(self, words: list[str]) -> None:
        codes = letter_codes(words)
        counts = letter_counts(codes)
        spread = counts.astype(np.float32).var(axis=0)
        self.letters = np.sort(np.argsort(-spread, kind="stable")[:PRUNE_LETTERS])
        self.order = np.arange(len(words))
        self.nodes: list[tuple] = []  # low, high, children or None, begin, end
        self.counts = counts
        self._grow(0, len(words))
        self.codes = codes[self.order]
        del self.counts

    def _grow(self, begin: int, end: int) -> int:
        rows = self.order[begin:end]
        counts = self.counts[rows]
        box = counts[:, self.letters]
        number = len(self.nodes)
        self.nodes.append(())
        cut = halving(counts) if end - begin > LEAF else None
        children = None
        if cut is not None:
            goes = counts[:, cut[0]] <= cut[1]
            self.order[begin:end] = np.concatenate([rows[goes], rows[~goes]])
            middle = begin + int(goes.sum())
            children = (self._grow(begin, middle), self._grow(middle, end))
        self.nodes[number] = (box.min(0), box.max(0), children, begin, end)
        return number

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Positions of queries and of stored words exactly one edit apart.

        Queries have the stored words' length (a replaced letter) or one letter less.
        """
        codes = letter_codes(words)
        spare = int(codes.shape[1] == self.codes.shape[1])
        boxes = letter_counts(codes)[:, self.letters]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = [(0, np.arange(len(words)))]
        while waiting:
            number, rows = waiting.pop()
            low, high, children, begin, end = self.nodes[number]
            box = boxes[rows]
            missing = np.maximum(low - box, 0).sum(1)
            extra = np.maximum(box - high, 0).sum(1)
            rows = rows[(missing <= 1) & (extra <= spare)]
            if not len(rows):
                continue
            if children is not None:
                waiting.extend((child, rows) for child in children)
                continue
            compare = one_replaced if spare else one_inserted
            # A leaf of words with the same letters may be large: compare a part at a time.
            for part in range(begin, end, 1024):
                stored = self.codes[part : min(part + 1024, end)]
                for some in range(0, len(rows), 2048):
                    q, p = np.nonzero(compare(codes[rows[some : some + 2048]], stored))
                    if len(q):
                        found.append((rows[some + q], self.order[part + p]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([q for q, _ in found]), np.concatenate([p for _, p in found])


def one_replaced(queries: np.ndarray, stored: np.ndarray) -> np.ndarray:
    """Whether exactly one place differs, for each pair of words of one length."""
    wrong = np.zeros((len(queries), len(stored)), np.int32 if stored.shape[1] > 127 else np.int8)
    for k in range(stored.shape[1]):
        wrong += queries[:, k, None] != stored[None, :, k]
    return wrong == 1


def one_inserted(queries: np.ndarray, stored: np.ndarray) -> np.ndarray:
    """Whether the stored word is the query with one letter put in."""
    shape, width = (len(queries), len(stored)), queries.shape[1]
    same = np.zeros(shape, np.int32)  # equal letters at the start, then also at the end
    for places, shift in ((range(width), 0), (range(width - 1, -1, -1), 1)):
        run = np.ones(shape, bool)
        for k in places:
            run &= queries[:, k, None] == stored[None, :, k + shift]
            if not run.any():
                break
            same += run
    return same >= width


def cell_trees(words: DataFrame) -> dict[int, CellTree]:
    """A coarse tree for every length; ``words`` is a written table."""
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()
    cells = {r["length"]: min(MAX_CELLS, -(-r["n"] // CELL)) for r in sizes}
    crowded = {r["length"]: SAMPLE * cells[r["length"]] / r["n"] for r in sizes if cells[r["length"]] > 1}
    trees = {length: CellTree(0, 1) for length in cells}
    if crowded:
        share = F.element_at(F.create_map(*[F.lit(x) for pair in crowded.items() for x in pair]), F.length("word"))
        dice = F.pmod(F.xxhash64("word", F.lit("cells")), F.lit(1 << 30)) / float(1 << 30)
        sample: dict[int, list[str]] = {length: [] for length in crowded}
        for row in words.where(F.length("word").isin(list(crowded)) & (dice < share)).select("word").collect():
            sample[len(row["word"])].append(row["word"])
        for length, some in sample.items():
            if some:
                trees[length] = CellTree.build(letter_counts(letter_codes(sorted(some))), cells[length])
    return trees


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near and the best near word of ``words`` (word, n), in parts to be combined.

    A word has a row from each cell it met near words in.
    """
    spark = words.sparkSession
    trees = cell_trees(words)
    shared = spark.sparkContext.broadcast({length: (t.root, t.cells) for length, t in trees.items()})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = {length: CellTree(*t) for length, t in shared.value.items()}
        for batch in batches:
            texts, ns = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                counts = letter_counts(letter_codes([texts[i] for i in rows]))
                own = trees[int(length)].own(counts)
                sent = [(length, True, np.arange(len(rows)), own)]
                for reach, spare in ((length, 1), (length + 1, 0)):
                    if int(reach) in trees:
                        sent.append((reach, False, *trees[int(reach)].reached(counts, spare)))
                for reach, stored, picked, cell in sent:
                    at = rows[picked]
                    columns = [
                        pa.array(np.full(len(at), reach), pa.int64()),
                        pa.array(cell, pa.int64()),
                        pa.array(np.full(len(at), stored)),
                        batch.column(0).take(pa.array(at)),
                        pa.array(ns[at]),
                    ]
                    yield pa.record_batch(columns, ["length", "cell", "stored", "word", "n"])

    def match(group: pa.Table) -> pa.Table:
        stored = group.filter(group["stored"])
        asked = group.filter(pc.invert(group["stored"]))
        words, ns = stored["word"].to_pylist(), stored["n"].to_numpy()
        best = Best()
        tree = WordTree(words) if words else None
        ask_words, ask_ns = asked["word"].to_pylist(), asked["n"].to_numpy()
        ask_lengths = np.fromiter(map(len, ask_words), np.int64, len(ask_words))
        for length in np.unique(ask_lengths) if tree else []:
            rows = np.flatnonzero(ask_lengths == length)
            for part in range(0, len(rows), _BLOCK):
                some = rows[part : part + _BLOCK]
                q, p = tree.near([ask_words[i] for i in some])
                for i, j in zip(some[q].tolist(), p.tolist()):
                    best.meet(ask_words[i], words[j], int(ns[j]))
                    if length < len(words[j]):
                        best.meet(words[j], ask_words[i], int(ask_ns[i]))
        return best.table()

    routed = words.select("word", "n").mapInArrow(
        route, "length long, cell long, stored boolean, word string, n long"
    )
    # Tasks do more work than their bytes show, so their number is set here.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(sum(t.cells for t in trees.values()), 20_000))
    dealt = routed.repartition(tasks, "length", "cell").groupBy("length", "cell")
    return dealt.applyInArrow(match, "word string, n_near long, form string, form_n long")


class Best:
    """Number of near words met, and the most frequent one (ties: smallest) of every word."""

    def __init__(self) -> None:
        self.seen: dict[str, tuple[int, int, str]] = {}

    def meet(self, word: str, other: str, n: int) -> None:
        old = self.seen.get(word)
        if old is None:
            self.seen[word] = (1, n, other)
        elif n > old[1] or n == old[1] and other < old[2]:
            self.seen[word] = (old[0] + 1, n, other)
        else:
            self.seen[word] = (old[0] + 1, old[1], old[2])

    def table(self) -> pa.Table:
        values = list(self.seen.values())
        return pa.table(
            {
                "word": pa.array(list(self.seen), pa.string()),
                "n_near": pa.array([v[0] for v in values], pa.int64()),
                "form": pa.array([v[2] for v in values], pa.string()),
                "form_n": pa.array([v[1] for v in values], pa.int64()),
            }
        )


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text).

    A form is FORM_FACTOR times as frequent as the word, so chains of forms are short: their
    ends are found by doubling in a number of joins that the largest count bounds.
    """
    words = stage(word_counts(docs), "words")
    nothing = F.lit(None)
    both = words.select(
        "word", "n", F.lit(0).cast("long").alias("n_near"), nothing.cast("string").alias("form"), nothing.cast("long").alias("form_n")
    ).unionByName(near_words(words).withColumn("n", nothing.cast("long")))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form")))
    found = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    large = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    found = found.select(
        "word",
        F.when(large, F.col("best.form")).alias("form"),
        "n",
        "n_near",
        F.when(large, -F.col("best.less")).alias("form_n"),
    )
    found = stage(found, "forms")
    most = found.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(max(most, 2), FORM_FACTOR)))
    roots = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) + 1):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("top"))
        roots = stage(roots.join(further, "root", "left").select("word", F.coalesce("top", "root").alias("root")), "roots")
    rooted = found.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
