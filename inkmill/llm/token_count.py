"""Token counts of a sentencepiece BPE model by rank-synchronous array merging.

A text gets a leading space mark and one mark per space, as the model's normaliser does. It
falls into pre-tokens (marks, then what follows up to the next mark), which no piece of the
model crosses; a model with such a piece is refused. The distinct pre-tokens of a batch are
held as one ragged numpy array. Each round looks up the rank of every adjacent pair, finds each
sequence's lowest rank and merges its leftmost pair of that rank, for all sequences at once.
Sequences without a pair left drop out. A surviving symbol is one token, or, if it is no
piece, as many as it has UTF-8 bytes.

A pre-token of over ``LONG`` characters would need as many rounds, so it goes through a heap
of its pairs instead, with the same order of merges.

Defined cases: a null text counts as empty; an empty text has no tokens. Special strings in a
text are ordinary text, as in the library's default. Repeated rows get equal counts.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.llm.worker import worker_state

LONG = 256
_MARK = "▁"
_PRETOKEN = re.compile(f"{_MARK}*[^{_MARK}]+|{_MARK}+")
_CACHE = 300_000
_NONE = np.int64(1) << 40


class PieceModel:
    """Ranks of pairs of symbols. Symbols are the model's pieces and their single characters."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        scores = {model.id_to_piece(i): model.get_score(i) for i in range(len(model)) if not special(i)}
        if any(_MARK in p.lstrip(_MARK) for p in scores):
            raise ValueError("a piece of the model crosses a space")
        self.symbols: dict[str, int] = {}
        for piece in scores:
            self.symbols[piece] = len(self.symbols)
        self.n_pieces = len(self.symbols)
        for piece in scores:
            for char in piece:
                self.symbols.setdefault(char, len(self.symbols))
        # Equal scores share a rank, so that between them the leftmost pair wins.
        rank = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        width = len(self.symbols)
        keys, ranks, merged = [], [], []
        for piece, score in scores.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * width + right)
                    ranks.append(rank[score])
                    merged.append(self.symbols[piece])
        order = np.argsort(keys)
        self.width = width
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int64)[order]
        self.merged = np.array(merged, np.int64)[order]
        self.pairs = dict(zip(keys, zip(ranks, merged)))
        self.by_code = np.full(0x110000, -1, np.int64)
        for symbol, i in self.symbols.items():
            if len(symbol) == 1:
                self.by_code[ord(symbol)] = i

    def start(self, word: str) -> tuple[list[int], list[int]]:
        """Symbols of the characters (-1 if unknown) and what each counts if it survives."""
        ids = [self.symbols.get(c, -1) for c in word]
        sizes = [1 if 0 <= i < self.n_pieces else len(c.encode()) for i, c in zip(ids, word)]
        return ids, sizes

    def count_many(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.zeros(len(words), np.int64)
        short = []
        for i, word in enumerate(words):
            if len(word) > LONG:
                out[i] = self.count_long(word)
            else:
                short.append(i)
        if short:
            out[short] = self._count_ragged([words[i] for i in short])
        return out

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or none) and merged symbol of pairs of symbols."""
        key = np.where((left < 0) | (right < 0), -1, left * self.width + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE), self.merged[at]

    def _count_ragged(self, words: list[str]) -> np.ndarray:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        ids = self.by_code[codes]
        utf8 = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        sizes = np.where((ids >= 0) & (ids < self.n_pieces), 1, utf8)
        total = np.zeros(len(words), np.int64)
        # At each place, the rank and outcome of the pair that starts there.
        ranks, merged = np.full(len(ids), _NONE), np.zeros(len(ids), np.int64)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        ranks[inner], merged[inner] = self._ranked(ids[inner], ids[inner + 1])
        while len(ids):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            # Rank first, then place: the smallest is each sequence's leftmost best pair.
            value = ranks * len(ids) + np.arange(len(ids))
            best = np.minimum.reduceat(value, first)
            live = best < _NONE * len(ids)
            chosen = best[live] % len(ids)
            open_ = np.repeat(live, np.diff(np.append(first, len(ids))))
            total += np.bincount(owner[~open_], sizes[~open_], len(words)).astype(np.int64)
            ids[chosen] = merged[chosen]
            sizes[chosen] = 1
            keep = open_
            keep[chosen + 1] = False
            moved = np.cumsum(keep)[chosen] - 1
            ids, sizes, owner = ids[keep], sizes[keep], owner[keep]
            ranks, merged = ranks[keep], merged[keep]
            # Only pairs with a new symbol changed: that it starts, and the one before it.
            changed = np.concatenate([moved, moved[moved > 0] - 1])
            ranks[changed] = _NONE
            changed = changed[changed + 1 < len(ids)]
            changed = changed[owner[changed] == owner[changed + 1]]
            ranks[changed], merged[changed] = self._ranked(ids[changed], ids[changed + 1])
        return total

    def count_long(self, word: str) -> int:
        """The same merges one by one, with pairs waiting in a heap."""
        ids, sizes = self.start(word)
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if ids[left] >= 0 and ids[right] >= 0:
                found = self.pairs.get(ids[left] * self.width + ids[right])
                if found:
                    heapq.heappush(heap, (found[0], left, ids[left], ids[right], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = [False] * n
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or ids[i] != left or ids[j] != right:
                continue
            ids[i], sizes[i], gone[j] = new, 1, True
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return sum(s for s, g in zip(sizes, gone) if not g)


def pretokens(text: str) -> list[str]:
    if not text:
        return []
    marked = _MARK + text.replace(" ", _MARK)
    return _PRETOKEN.findall(marked)


def count_tokens(text: Column, model_path: str) -> Column:
    """Tokens of each whole text; the model file must be readable where tasks run."""

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = worker_state(f"pieces {model_path}")
        if not cache:
            cache |= {"model": PieceModel(model_path), "known": {}}
        model, known = cache["model"], cache["known"]
        for texts in parts:
            out = []
            rows = texts.tolist()
            for part in range(0, len(rows), 1024):
                if len(known) > _CACHE:
                    known.clear()
                split = [pretokens(t or "") for t in rows[part : part + 1024]]
                new = list({w for words in split for w in words if w not in known})
                known.update(zip(new, model.count_many(new).tolist()))
                out += [sum(map(known.__getitem__, words)) for words in split]
            yield pd.Series(out, dtype="int64")

    return count(text)
