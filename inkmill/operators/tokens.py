"""The token stream: end marks, offsets, statistics, training windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions.pretokens import SPECIAL_TOKENS
from inkmill.operators.bpe import BpeModel
from inkmill.operators.codec import encode
from inkmill.operators.ordering import with_running_total

# Window starts (16 bytes each) that may be broadcast to the token scan.
MAX_BROADCAST_WINDOWS = 1_000_000


def token_dtype(vocab_size: Column) -> Column:
    """Smallest unsigned type that holds every id; an error beyond 32 bits."""
    return (
        F.when(vocab_size <= 65535, "uint16")
        .when(vocab_size <= 4294967295, "uint32")
        .otherwise(F.raise_error(F.lit("vocabulary too large for uint32")).cast("string"))
    )


def eos_id(model: BpeModel) -> int | None:
    """Id of the end mark, or None for a vocabulary without one."""
    mark = SPECIAL_TOKENS[-1].encode()
    return model.tokens.index(mark) if mark in model.tokens else None


def append_eos(ids: Column, eos: int | None) -> Column:
    """End mark after each document that has tokens."""
    if eos is None:
        return ids
    return F.when(F.size(ids) > 0, F.concat(ids, F.array(F.lit(eos)))).otherwise(ids)


def tokenize(docs: DataFrame, model: BpeModel, with_eos: bool = True) -> DataFrame:
    """``ids`` and ``n_tokens`` of every document with text (other columns are kept)."""
    coded = encode(docs.where(F.col("text") != ""), model)
    ids = append_eos(F.col("ids"), eos_id(model) if with_eos else None)
    return coded.withColumn("ids", ids).withColumn("n_tokens", F.size("ids"))


def encode_stats(docs: DataFrame, model: BpeModel, with_eos: bool = True) -> DataFrame:
    """One row: documents seen, those with text, of these without tokens, characters, tokens."""
    ids = append_eos(F.col("ids"), eos_id(model) if with_eos else None)
    coded = encode(docs.select("text"), model)
    return encoded_totals(coded.select(F.length("text").alias("chars"), F.size(ids).alias("n_tokens")))


def encoded_totals(coded: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The columns of ``encode_stats`` per key, from ``chars`` (null: no text) and ``n_tokens``."""
    valid = F.col("chars") > 0

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(valid, value)), F.lit(0))

    return coded.groupBy(*(keys or [])).agg(
        F.count("*").alias("docs_seen"),
        total(F.lit(1)).alias("docs_written"),
        total((F.col("n_tokens") == 0).cast("int")).alias("empty_docs"),
        total(F.col("chars")).alias("characters"),
        total(F.col("n_tokens")).alias("tokens"),
    )


def with_offsets(
    tokens: DataFrame, keys: list[str] | None = None, block_rows: int | None = None
) -> DataFrame:
    """Add ``start_offset``: where each document begins in the stream of its key.

    A block of documents meets in one task with its ids, so blocks are kept small; they only
    grow where there would be more than a million of them (then documents are short).
    """
    if block_rows is None:
        last = tokens.agg(F.max("ordinal")).first()[0] or 0
        block_rows = max(1000, -(-last // 1_000_000))
    return with_running_total(
        tokens, "n_tokens", "start_offset", keys=keys, inclusive=False, block_rows=block_rows
    )


def random_starts(
    spark: SparkSession, n_windows: int, n_tokens: int, block_size: int, seed: int = 0
) -> DataFrame:
    """``n_windows`` window starts, uniform in [0, n_tokens - block_size - 1), repeatable.

    They come from the MD5 of seed and window number, so they do not depend on partitions and
    other engines can draw them too.
    """
    if n_tokens <= block_size + 1:
        raise ValueError(f"{n_tokens} tokens are too few for windows of {block_size}")
    place = _drawn(F.lit(str(seed)), F.col("id")) % (n_tokens - block_size - 1)
    return spark.range(n_windows).select(F.col("id").alias("window_id"), place.alias("start"))


def _drawn(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def random_starts_by_split(
    totals: DataFrame, draws: dict[str, int], block_size: int, seed: int = 0
) -> DataFrame:
    """Window starts like ``random_starts`` for every split and draw: split, draw, window_id, start.

    ``totals`` has one row per split with its ``n_tokens``; ``draws`` names the draws with their
    numbers of windows. A split with too few tokens is an error.
    """
    named = [F.struct(F.lit(d).alias("draw"), F.lit(n).alias("n")) for d, n in draws.items() if n > 0]
    drawn = totals.select("split", "n_tokens", F.explode(F.array(*named)).alias("d"))
    drawn = drawn.select(
        "split", "n_tokens", "d.draw", F.explode(F.sequence(F.lit(0), F.col("d.n") - 1)).alias("id")
    )
    room = F.col("n_tokens") - (block_size + 1)
    room = F.when(room > 0, room).otherwise(
        F.raise_error(F.concat(F.lit("too few tokens in split "), F.col("split"))).cast("long")
    )
    place = _drawn(F.lit(str(seed)), F.col("split"), F.col("draw"), F.col("id")) % room
    return drawn.select("split", "draw", F.col("id").cast("long").alias("window_id"), place.alias("start"))


def token_windows(
    tokens: DataFrame,
    starts: DataFrame,
    block_size: int,
    n_windows: int | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """Windows ``x`` and next-token targets ``y`` (shifted by one) at given starts.

    ``tokens`` has ``start_offset`` and ``ids``, and with ``keys`` one stream per key; the columns
    of ``starts`` are kept. Both sides are cut at multiples of the
    bucket width and meet in an equi-join, so no range join is needed; a window then gathers
    its few slices. With ``n_windows`` (an upper bound of the rows of ``starts``) within the
    broadcast limit the token side is not shuffled at all.
    """
    width = max(block_size + 1, 256)
    first = F.floor(F.col("start") / width)
    last = F.floor((F.col("start") + block_size) / width)
    keys, names = keys or [], starts.columns
    wanted = starts.select(*names, F.explode(F.sequence(first, last)).alias("bucket"))
    if n_windows is not None and n_windows <= MAX_BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)

    begin, size = F.col("start_offset"), F.size("ids")

    def piece(bucket: Column) -> Column:
        low = F.greatest(begin, bucket * width)
        high = F.least(begin + size, (bucket + 1) * width)
        part = F.slice("ids", (low - begin + 1).cast("int"), (high - low).cast("int"))
        return F.struct(bucket.alias("bucket"), low.alias("at"), part.alias("part"))

    # Sliced before the explode, which would otherwise copy the whole document per bucket.
    buckets = F.sequence(F.floor(begin / width), F.floor((begin + size - 1) / width))
    pieces = tokens.where(size > 0).select(*keys, F.explode(F.transform(buckets, piece)).alias("p"))
    pieces = pieces.select(*keys, "p.*")
    # Cut to the window before the shuffle, so that a window gathers block_size + 1 ids.
    low = F.greatest("at", "start")
    high = F.least(F.col("at") + F.size("part"), F.col("start") + block_size + 1)
    met = pieces.join(wanted, [*keys, "bucket"]).where(high > low).select(
        *names,
        low.alias("at"),
        F.slice("part", (low - F.col("at") + 1).cast("int"), (high - low).cast("int")).alias("part"),
    )
    stream = F.flatten(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda p: p["part"])
    )
    return (
        met.groupBy(*names)
        .agg(stream.alias("stream"))
        .select(
            *names,
            F.slice("stream", 1, block_size).alias("x"),
            F.slice("stream", 2, block_size).alias("y"),
        )
    )


def dataset_meta(
    tokens: DataFrame, vocab_size: int, block_size: int, eos: int | None, paths: dict[str, str]
) -> DataFrame:
    """One row that describes the encoded splits (``split`` is train or val)."""

    def of(split: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("split") == split, value)), F.lit(0))

    totals = tokens.agg(
        of("train", F.col("n_tokens")).alias("train_tokens"),
        of("val", F.col("n_tokens")).alias("val_tokens"),
        of("train", F.lit(1)).alias("train_docs"),
        of("val", F.lit(1)).alias("val_docs"),
    )
    return totals.select(
        F.lit(vocab_size).alias("vocab_size"),
        token_dtype(F.lit(vocab_size)).alias("dtype"),
        F.lit(block_size).alias("block_size"),
        F.lit(eos is not None).alias("append_eos"),
        F.lit(eos).cast("int").alias("eos_id"),
        *[F.lit(paths.get(k)).alias(k) for k in ("tokenizer_path", "train_jsonl", "val_jsonl")],
        *["train_tokens", "val_tokens", "train_docs", "val_docs"],
    )
