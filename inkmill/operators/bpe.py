"""Byte-level BPE learning as an iterative DataFrame job."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from inkmill.functions.cleaning import nfc
from inkmill.functions.pretokens import (
    FIRST_BYTE_ID,
    SPECIAL_TOKENS,
    adjacent_pairs,
    bytes_by_id,
    pretokens,
    symbol_char,
    symbol_id,
    to_symbols,
)
from inkmill.staging import spread, stage, staging_path

# While learning, every symbol is one code point; there are no more of them than this.
MAX_VOCAB = 1_100_000
# Pairs that rounds with an index rank, share of words after which the index is built anew, and
# word ids that may be broadcast then.
HELD_PAIRS = 20_000
TOUCHED_SHARE = 0.125
BROADCAST_IDS = 2_000_000


@dataclass
class BpeModel:
    """Merges in rank order and the bytes of every token id; bounded by the vocabulary."""

    merges: list[tuple[int, int, int]] = field(default_factory=list)  # left, right, new id
    counts: list[int] = field(default_factory=list)  # pair count when merged
    tokens: list[bytes] = field(
        default_factory=lambda: [s.encode() for s in SPECIAL_TOKENS]
        + [bytes([b]) for b in bytes_by_id()]
    )
    # Of each learning round: merges made, words rewritten (None: all). Not part of the model.
    rounds: list[tuple[int, int | None]] = field(default_factory=list, compare=False, repr=False)

    @property
    def vocab_size(self) -> int:
        return len(self.tokens)


def word_counts(docs: DataFrame) -> DataFrame:
    """Frequency of every pre-token of ``text``; counted per task before the shuffle."""
    words = docs.select(F.explode(pretokens(nfc(F.col("text")))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("freq"))


def word_symbols(counts: DataFrame) -> DataFrame:
    return counts.select(to_symbols(F.col("word")).alias("symbols"), "freq")


def pair_counts(words: DataFrame, symbols: str = "symbols", freq: str = "freq") -> DataFrame:
    """Adjacent symbol pairs weighted by word frequency."""
    pairs = words.select(F.explode(adjacent_pairs(F.col(symbols))).alias("pair"), freq)
    return pairs.groupBy("pair").agg(F.sum(freq).alias("n"))


def _choose_batch(
    top: list, model: BpeModel, known: dict[bytes, int], vocab_size: int, min_frequency: int
) -> list[tuple[str, str]]:
    """Merges that can be made at once with the result of making them one by one.

    ``top`` is ranked by count, then by smaller ids. Merging (a, b) to m changes the counts of
    pairs that end in a or start with b; the batch ends at the first of that kind, so all of
    them rank behind every pair q of the batch. A new pair (z, m) is no more frequent than
    (z, a), hence than q. If it is as frequent as q, so is (z, a), which then sorts behind q;
    m has the largest id of all, so (z, m) sorts behind q too. The same holds for (m, w) and
    (b, w). So no new pair can come before a pair of the batch, nor can one beyond ``top``.
    """
    batch: list[tuple[str, int]] = []
    lefts: set[str] = set()
    rights: set[str] = set()
    for row in top:
        a, b = row["pair"]
        if b in lefts or a in rights:
            break
        batch.append((row["pair"], row["n"]))
        lefts.add(a)
        rights.add(b)
        if a == b:  # overlaps with itself, so anything behind may have changed
            break

    made: list[tuple[str, str]] = []
    for pair, count in batch:
        if model.vocab_size >= vocab_size or count < max(min_frequency, 1):
            break
        left, right = symbol_id(pair[0]), symbol_id(pair[1])
        token = model.tokens[left] + model.tokens[right]
        new_id = known.get(token)
        repeated = new_id is not None
        if repeated and made:
            break  # adds to pairs that exist already: merge it alone, in the next round
        if not repeated:
            new_id = model.vocab_size
            model.tokens.append(token)
            known[token] = new_id
        model.merges.append((left, right, new_id))
        model.counts.append(count)
        made.append((pair, symbol_char(new_id)))
        if repeated:
            break
    return made


def _apply(symbols: Column, merges: list[tuple[str, str]]) -> Column:
    for pair, merged in merges:
        symbols = F.replace(symbols, F.lit(pair), F.lit(merged))
    return symbols


def learn_bpe(
    counts: DataFrame,
    vocab_size: int,
    min_frequency: int = 2,
    merges_per_stage: int = 96,
    candidates: int = 400,
    rare_share: float = 0.05,
) -> BpeModel:
    """Learn merges from ``word_counts`` until the vocabulary is full or pairs get rare.

    Each round is one job: apply the merges made since the last written word table, bring
    the pair counts written with it up to date, and take the top pairs (``candidates`` rows)
    to the driver, which picks the next merges. After ``merges_per_stage`` merges both tables
    are written anew to the shared folder, so plans and lineage stay short and a lost
    executor costs one round.

    The first merges change most words, so these rounds go over all of them. Once the next
    ``merges_per_stage`` merges take up less than ``rare_share`` of all pair occurrences, the
    rest is learned with an index from pairs to words (``_learn_indexed``).
    """
    if vocab_size > MAX_VOCAB:
        raise ValueError(f"a vocabulary of more than {MAX_VOCAB} tokens has no code points left")
    model = BpeModel()
    known = {token: i for i, token in enumerate(model.tokens)}
    words, pairs = _stage_tables(word_symbols(counts))
    pending: list[tuple[str, str]] = []
    staged = len(model.merges)
    total = _total(pairs)
    rare = False
    while model.vocab_size < vocab_size and not rare:
        share = sum(model.counts[staged:]) / max(total, 1)
        current = _current_pairs(pairs, words, pending, share)
        top = current.orderBy(F.desc("n"), "pair").limit(candidates).collect()
        made = _choose_batch(top, model, known, vocab_size, min_frequency) if top else []
        if not made:
            break
        pending += made
        model.rounds.append((len(made), None))
        if len(pending) >= merges_per_stage:
            old = (words, pairs)
            merged = words.select(_apply(F.col("symbols"), pending).alias("symbols"), "freq")
            share = sum(model.counts[staged:]) / max(total, 1)
            words, pairs = _stage_tables(merged, _current_pairs(pairs, words, pending, share))
            pending, staged, total = [], len(model.merges), _total(pairs)
            for table in old:
                table.unpersist()
            rare = model.counts[-1] * merges_per_stage < rare_share * total
    if rare:
        _learn_indexed(words, pairs, model, known, vocab_size, min_frequency, candidates)
    words.unpersist()
    pairs.unpersist()
    return model


def _learn_indexed(
    words: DataFrame,
    pairs: DataFrame,
    model: BpeModel,
    known: dict[bytes, int],
    vocab_size: int,
    min_frequency: int,
    candidates: int,
) -> None:
    """Learn on with rounds that only touch words that hold a merged pair.

    An index of postings (pair, word) is written in buckets of pairs, so looking up a few pairs
    reads few files. The words found there join the *touched* words of earlier rounds, which are
    kept as they were when the index was built and as they are now; the difference of their
    pairs is what pair counts change by. A pair of a symbol made since then occurs in touched
    words only, so the index need not hold it. Top pairs come from the ``HELD_PAIRS`` most
    frequent ones of the index's time and those differences: a count of old symbols only falls,
    so a pair left out cannot rank above their least count, and when no other is left the index is
    built anew, as it is when a ``TOUCHED_SHARE`` of the words was touched. Only a merge that gives
    a token made before can raise counts of old symbols; from then on all pairs are held.
    """
    words = stage(words.withColumn("word_id", F.monotonically_increasing_id()), "bpe-words")
    while model.vocab_size < vocab_size:
        n_words, size = words.count(), model.vocab_size
        index, buckets = _write_index(words, n_words)
        least = pairs.select("n").orderBy(F.desc("n")).limit(HELD_PAIRS).agg(F.count("*"), F.min("n")).first()
        floor = least[1] if least[0] == HELD_PAIRS else 0
        held = stage(pairs.where(F.col("n") >= floor), "bpe-held")
        held = held.coalesce(held.sparkSession.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
        touched, n_touched, done = None, 0, False
        while model.vocab_size < vocab_size and n_touched <= TOUCHED_SHARE * n_words:
            current = held if touched is None else _with_changes(held, touched)
            top = current.orderBy(F.desc("n"), "pair").limit(candidates).collect()
            certain = [r for r in top if r["n"] >= floor]
            made = _choose_batch(certain, model, known, vocab_size, min_frequency) if certain else []
            if not made:
                done = bool(certain) or floor == 0
                break
            if floor and made[0][1] <= symbol_char(size - 1):
                held.unpersist()
                held, floor = pairs, 0
            touched, n_touched = _touch(touched, index, buckets, made, size)
            model.rounds.append((len(made), n_touched))
        held.unpersist()
        if done or model.vocab_size >= vocab_size:
            return
        if touched is not None:
            pairs = stage(_with_changes(pairs, touched), "bpe-pairs")
            changed = touched.select("word_id")
            if n_touched <= BROADCAST_IDS:
                changed = F.broadcast(changed)
            same = words.join(changed, "word_id", "left_anti")
            now = touched.select("symbols", "freq", "word_id").where(F.length("symbols") > 1)
            words = stage(same.unionByName(now), "bpe-words")


def _write_index(words: DataFrame, n_words: int) -> tuple[DataFrame, int]:
    """Postings with the word itself, in folders by a hash of the pair, and the folders' number."""
    buckets = min(4_096, max(8, n_words // 20_000))
    postings = words.select(
        F.explode(F.array_distinct(adjacent_pairs(F.col("symbols")))).alias("pair"), "word_id", "symbols", "freq"
    ).withColumn("bucket", (F.ascii("pair") * 31 + F.ascii(F.substring("pair", 2, 1))) % buckets)
    # A pair may be in very many words: its bucket is written by several tasks.
    spread_out = postings.repartition("bucket", F.pmod("word_id", F.lit(4)))
    path = staging_path(words.sparkSession, "bpe-index")
    spread_out.sortWithinPartitions("bucket", "pair").write.partitionBy("bucket").parquet(path)
    return words.sparkSession.read.schema(postings.schema).parquet(path), buckets


def _touch(
    touched: DataFrame | None, index: DataFrame, buckets: int, made: list[tuple[str, str]], size: int
) -> tuple[DataFrame, int]:
    """Touched words after the merges ``made``, and how many they are; a written table."""
    last = symbol_char(size - 1)
    old = [pair for pair, _ in made if max(pair) <= last]
    layers = []
    if touched is not None:
        layers.append(touched.withColumn("symbols", _apply(F.col("symbols"), made)))
    if old:
        homes = {(ord(a) * 31 + ord(b)) % buckets for a, b in old}
        found = index.where(F.col("bucket").isin(homes) & F.col("pair").isin(old))
        found = found.dropDuplicates(["word_id"])
        if touched is not None:
            found = found.join(touched.select("word_id"), "word_id", "left_anti")
        now = _apply(F.col("symbols"), made)
        layers.append(found.select("word_id", F.col("symbols").alias("before"), now.alias("symbols"), "freq"))
    rows = layers[0] if len(layers) == 1 else layers[0].unionByName(layers[1])
    count = Observation()
    written = stage(rows.observe(count, F.count("*").alias("n")), "bpe-touched")
    return written, count.get["n"]


def _with_changes(pairs: DataFrame, touched: DataFrame) -> DataFrame:
    """Pair counts with those of touched words as they were taken off, as they are added."""
    both = F.concat(_signed(F.col("before"), -1), _signed(F.col("symbols"), 1))
    return _plus(pairs, touched.select(F.explode(both).alias("p"), "freq"))


def _signed(symbols: Column, sign: int) -> Column:
    pair_of = adjacent_pairs(symbols)
    return F.transform(pair_of, lambda p: F.struct(p.alias("pair"), F.lit(sign).alias("sign")))


def _plus(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    delta = signed.select("p.pair", (F.col("p.sign") * F.col("freq")).alias("n"))
    return pairs.unionByName(delta).groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0")


def _stage_tables(
    words: DataFrame, pairs: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Write and cache the words that can still be merged and their pair counts."""
    level = StorageLevel.MEMORY_AND_DISK
    words = spread(stage(words.where(F.length("symbols") > 1), "bpe-words")).persist(level)
    pairs = stage(pair_counts(words) if pairs is None else pairs, "bpe-pairs").persist(level)
    return words, pairs


def _total(pairs: DataFrame) -> int:
    return pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _current_pairs(
    pairs: DataFrame, words: DataFrame, merges: list[tuple[str, str]], share: float
) -> DataFrame:
    """Pair counts after ``merges``, which took up ``share`` of all pair occurrences.

    Frequent merges change most words, so all are counted again. Rare ones, which are by far
    the most in a large vocabulary, only change few: then the old pairs of changed words are
    taken off and their new ones added.
    """
    if not merges:
        return pairs
    if share > 0.02:
        merged = words.select(_apply(F.col("symbols"), merges).alias("symbols"), "freq")
        return pair_counts(merged)

    changed = words.withColumn("merged", _apply(F.col("symbols"), merges)).where(
        F.col("merged") != F.col("symbols")
    )
    both = F.concat(_signed(F.col("symbols"), -1), _signed(F.col("merged"), 1))
    return _plus(pairs, changed.select(F.explode(both).alias("p"), "freq"))


__all__ = ["BpeModel", "FIRST_BYTE_ID", "learn_bpe", "pair_counts", "word_counts", "word_symbols"]
