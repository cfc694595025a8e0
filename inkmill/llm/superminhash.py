"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

Words are runs of characters other than ASCII white space, A-Z in lower case. A document's set
holds its distinct ``words``-word shingles (the whole sequence, if it has fewer words). Every
shingle draws a random permutation of the signature's places and gives the i-th place of it the
value i + r, r in [0, 1); each place keeps its smallest value. The permutations are affine
modulo a prime: any two places are independent in them, which is all that the estimate's mean
and variance depend on. The values are drawn round by round for all shingles of a few documents
at once, and a document stops after round i once no place holds more than i + 1, since later
rounds only bring larger values. ``BANDS`` bands of ``ROWS``
places give the bucket keys: two sets with similarity 0.8 would miss each other in all of them
with a probability of 4e-5, were places independent beyond pairs. For very small sets they are not:
of 6,000 pairs of sets that share 4 of 5 shingles 5 were lost.

Documents with equal sets are one class from the start. Candidates are confirmed on full sets:
first each member of a bucket with the bucket's smallest member, one pair per class, then all
such pairs, then, where a bucket still holds several components, its strangers (members
outside its largest component) with all its members, block by block. Pairs inside one component
are never tried, as they cannot change a group. Components come from :mod:`components`.

Defined cases: a null or blank text has an empty set and is linked with nothing. Rows with equal
doc_id are one document for linking: it has the links of each of its texts. A row without doc_id takes no
part: its component is null and it is kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.components import components
from inkmill.llm.hashing import small
from inkmill.llm.worker import small_batches, worker_state
from inkmill.staging import stage

ROWS = 8
BANDS = 56
PLACES = ROWS * BANDS
_PRIME = 449  # places that shingles draw; the prime next to PLACES, which drops the last one
BROADCAST_IDS = 2_000_000  # one long each; more are joined by shuffle
SHARE = 80  # link at SHARE hundredths and more
EXACT = 14  # shingles of a small set, of which a similar set lacks at most two
_BLOCK = 16_384  # shingles that draw values together
_BYTES = 1 << 19  # text hashed together
_SHINGLES = 1 << 16  # of the members, and of the strangers, that meet in a block
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)


_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWERED = np.arange(256, dtype=np.int64)
_LOWERED[ord("A") : ord("Z") + 1] += 32
_NEAR = 32  # bytes of a word that have their hash in a table


def mixed(x: np.ndarray) -> np.ndarray:
    """Bit mixer for arrays of unsigned 64-bit numbers (the published splitmix64 steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# An odd factor for the fractions of each round.
_FACTORS = mixed(np.arange(_PRIME, dtype=np.uint64) + _FACTOR) | np.uint64(1)
# Places in the order in which bands take them.
_ORDER = np.argsort(mixed(np.arange(PLACES, dtype=np.uint64) + _FACTOR))
# Hash of a byte at its place in a word; a word's hash is the sum over its bytes.
_TABLE = mixed(np.arange(_NEAR * 256, dtype=np.uint64) + _GOLDEN)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word of some UTF-8 text, A-Z as a-z."""
    data = np.frombuffer(raw, np.uint8)
    solid = ~_SPACES[data]
    starts = np.flatnonzero(solid & np.r_[True, ~solid[:-1]])
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    at = np.flatnonzero(solid)
    first = np.searchsorted(at, starts)
    place = at - np.repeat(starts, np.diff(np.append(first, len(at))))
    code = place * 256 + _LOWERED[data[at]]
    far = place >= _NEAR
    code[far] %= _NEAR * 256
    values = _TABLE[code]
    if far.any():
        code = place[far] * 256 + _LOWERED[data[at[far]]]
        values[far] = mixed(code.astype(np.uint64) + _GOLDEN)
    return starts, mixed(np.add.reduceat(values, first))


def shingle_sets_of(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    out = []
    group: list[bytes] = []
    size = 0
    for text in texts:
        raw = (text or "").encode("utf-8", "replace")
        if group and size + len(raw) > _BYTES:
            out += _group_sets(group, words)
            group, size = [], 0
        if len(raw) > _BYTES:
            out.append(_distinct(np.concatenate(list(_long_codes(raw))), words))
        else:
            group.append(raw)
            size += len(raw)
    return out + _group_sets(group, words)


def _long_codes(raw: bytes) -> Iterator[np.ndarray]:
    """Word hashes of a very long text, from blocks cut after a space."""
    at = 0
    while at < len(raw):
        end = at + _BYTES
        while end < len(raw) and not _SPACES[raw[end]]:
            end += 1
        yield word_hashes(raw[at:end])[1]
        at = end


def _group_sets(group: list[bytes], words: int) -> list[np.ndarray]:
    if not group:
        return []
    starts, codes = word_hashes(b"\n".join(group))
    ends = np.cumsum([len(raw) + 1 for raw in group])
    cuts = np.r_[0, np.searchsorted(starts, ends)]
    return [_distinct(codes[cuts[i] : cuts[i + 1]], words) for i in range(len(group))]


def _distinct(codes: np.ndarray, words: int) -> np.ndarray:
    if not len(codes):
        return np.zeros(0, np.uint64)
    width = min(words, len(codes))
    sums = np.full(len(codes) - width + 1, np.uint64(width))
    for i in range(width):
        sums = sums * _FACTOR + codes[i : len(codes) - width + 1 + i]
        sums ^= sums >> _32
    return np.unique(mixed(sums))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash signature of each non-empty set, as round * 2**32 + fraction."""
    out = np.full((len(sets), _PRIME), np.iinfo(np.int64).max, np.int64)
    group: list[int] = []
    size = 0

    def draw_group() -> None:
        values = np.concatenate([sets[i] for i in group])
        owner = np.repeat(np.arange(len(group)), [len(sets[i]) for i in group])
        best = out[group]
        _draw(values, owner, best)
        out[group] = best

    # Sets of like size are done after about as many rounds.
    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        own = sets[i]
        if len(own) > _BLOCK:  # the first blocks of a long set leave the others little to do
            for part in range(0, len(own), _BLOCK):
                block = own[part : part + _BLOCK]
                _draw(block, np.zeros(len(block), np.int64), out[i : i + 1])
            continue
        if group and size + len(own) > _BLOCK:
            draw_group()
            group, size = [], 0
        group.append(i)
        size += len(own)
    if group:
        draw_group()
    return out[:, :PLACES]


def _draw(values: np.ndarray, owner: np.ndarray, best: np.ndarray) -> None:
    """Lower ``best`` (set by place) by the values that the shingles draw."""
    flat = best.reshape(-1)
    drawn = mixed(values ^ _GOLDEN)
    place = ((drawn & _LOW) % np.uint64(_PRIME)).astype(np.int64)
    step = ((drawn >> _32) % np.uint64(_PRIME - 1)).astype(np.int64) + 1
    row = owner * _PRIME
    for turn in range(_PRIME):
        fraction = ((values * _FACTORS[turn]) >> _32).astype(np.int64)
        np.minimum.at(flat, row + place, fraction + (turn << 32))
        if turn < 4 or turn % 8 == 0:  # more rounds than needed change nothing
            live = best.max(axis=1) > (turn + 1) << 32
            if not live.any():
                return
            keep = live[owner]
            if 5 * np.count_nonzero(keep) < 4 * len(keep):
                values, owner, row = values[keep], owner[keep], row[keep]
                place, step = place[keep], step[keep]
        place = place + step
        place[place >= _PRIME] -= _PRIME


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    parts = signature[:, _ORDER].astype(np.uint64).reshape(len(signature), -1, ROWS)
    keys = np.broadcast_to(mixed(np.arange(parts.shape[1], dtype=np.uint64) + _GOLDEN), parts.shape[:2]).copy()
    for i in range(ROWS):
        keys = mixed((keys * _FACTOR) ^ parts[:, :, i])
    return keys.view(np.int64)


def subset_keys(own: np.ndarray) -> np.ndarray | None:
    """Keys of a small set and of what is left without one or two of its shingles, in that order.

    Only as many are removed as a similar set may lack; None for larger sets.
    """
    n = len(own)
    if n > EXACT:
        return None
    lacking = n * (100 - SHARE) // 100
    hashes = mixed(own ^ _FACTOR)
    whole = hashes.sum(dtype=np.uint64)
    left = [np.array([whole])]
    if lacking > 0:
        left.append(whole - hashes)
    if lacking > 1:
        i, j = np.triu_indices(n, 1)
        left.append(whole - hashes[i] - hashes[j])
    size = np.repeat(np.uint64(n) - np.arange(len(left), dtype=np.uint64), [len(part) for part in left])
    return mixed(np.concatenate(left) ^ mixed(size)).view(np.int64)


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits, null if empty), bands, subsets of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("shingles")  # frees what an operator before has kept
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                rows = batch.slice(part, 512)
                sets = shingle_sets_of(rows["text"].to_pylist(), words)
                filled = [i for i, s in enumerate(sets) if len(s)]
                keys: list[str | None] = [None] * len(sets)
                bands: list[np.ndarray | None] = [None] * len(sets)
                subsets: list[np.ndarray | None] = [None] * len(sets)
                found = band_keys(signatures([sets[i] for i in filled])) if filled else ()
                for i, own in zip(filled, found):
                    keys[i] = xxhash.xxh3_128_hexdigest(sets[i].tobytes())
                    bands[i] = own
                    subsets[i] = subset_keys(sets[i])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": rows["doc_id"],
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "set_key": pa.array(keys, pa.string()),
                        "bands": pa.array(bands, pa.list_(pa.int64())),
                        "subsets": pa.array(subsets, pa.list_(pa.int64())),
                    }
                )

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "doc_id long, n_shingles long, set_key string, bands array<long>, subsets array<long>"
    return thin.mapInArrow(run, kind)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and shingles (sorted array of longs) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("shingles")  # frees what an operator before has kept
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                rows = batch.slice(part, 512)
                sets = shingle_sets_of(rows["text"].to_pylist(), words)
                sets = [own.view(np.int64) for own in sets]
                yield pa.RecordBatch.from_pydict(
                    {"node": rows["doc_id"], "shingles": pa.array(sets, pa.list_(pa.int64()))}
                )

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return thin.mapInArrow(run, "node long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - shared
    return both.where(shared * 100 >= union * SHARE).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    rows = stage(sketch(docs, words), "sketches")
    usable = rows.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    classes = stage(classes, "classes")
    same = usable.select("doc_id", "set_key").join(classes, "set_key")
    same = same.where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    heads = usable.join(classes, "set_key").where("doc_id = node")
    heads = heads.select("node", "n_shingles", "bands", "subsets")
    members = heads.select("node", "n_shingles", F.explode("bands").alias("key"))
    # Keys of a single class are most of them; they go before anything else moves.
    shared = members.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    shared = shared.where("first <> last").select("key", "first")
    buckets = stage(members.join(shared, "key"), "buckets")

    stars = buckets.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    stars = stage(stars.distinct(), "stars")
    exact = stage(small_set_pairs(heads), "small-set-pairs")
    wanted = buckets.select("node").union(exact.select("a")).union(exact.select("b"))
    wanted = small(stage(wanted.distinct(), "wanted"), BROADCAST_IDS)
    sets = shingle_sets(docs.join(wanted, docs["doc_id"] == wanted["node"], "left_semi"), words)
    sets = stage(sets, "sets")
    links = stage(same.distinct(), "links")

    nearest = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    tried = stage(nearest.union(exact).distinct(), "tried")
    links = links.union(stage(confirmed(tried, sets), "links"))
    roots = components(links)

    rest = apart(stars.join(tried, ["a", "b"], "left_anti"), roots)
    again = stage(rest, "tried")
    links = links.union(stage(confirmed(again, sets), "links"))
    roots = components(links)

    late = stage(stranger_links(buckets, roots, sets), "links")
    if not late.isEmpty():
        roots = components(links.union(late))

    placed = rows.select("doc_id", "n_shingles").join(
        roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left"
    )
    component = F.coalesce("root", "doc_id")
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def small_set_pairs(heads: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect all similar classes of small sets.

    In every subset's group the set that lacks the fewest shingles is paired with the others that
    are similar to it; equal numbers of shingles are broken by node.
    """
    lacks = F.when(F.col("pos") == 0, 0).when(F.col("pos") <= F.col("n_shingles"), 1).otherwise(2)
    keys = heads.where("subsets IS NOT NULL").select("node", "n_shingles", F.posexplode("subsets").alias("pos", "key"))
    keys = keys.select("key", "node", "n_shingles", lacks.alias("lacks"))
    # As one number, the least of a group is found in a hash aggregate.
    nearest = F.min("lacks").alias("least")
    groups = keys.groupBy("key").agg(nearest, F.min("node").alias("low"), F.max("node").alias("high"))
    keys = keys.join(groups.where("low <> high").select("key", "least"), "key")
    left = F.col("n_shingles") - F.col("lacks")
    similar = (left + F.col("lacks") + F.col("least")) * SHARE <= left * 100
    keys = keys.where(similar).select("key", "node", "lacks", "least")
    chosen = keys.where("lacks = least").groupBy("key").agg(F.min("node").alias("head"))
    pairs = keys.join(chosen, "key").where("node <> head")
    return pairs.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct()


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends are not in one component yet."""
    ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    placed = pairs.join(ra, "a", "left").join(rb, "b", "left")
    return placed.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def stranger_links(buckets: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links (a, b) of each bucket's strangers with members of other components.

    Strangers and members meet in blocks of about ``_SHINGLES`` shingles of either, and only
    links leave a block, so a bucket with many strangers makes work but no pairs.
    """
    placed = buckets.join(roots, "node", "left")
    placed = placed.select("key", "node", "n_shingles", F.coalesce("root", "node").alias("root"))
    groups = placed.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    keys = groups.groupBy("key").agg(
        F.count("*").alias("groups"), F.sum("size").alias("size"), F.max(F.struct("n", "root", "size")).alias("main")
    )
    blocks = lambda size: F.ceil(size / _SHINGLES).cast("int")
    keys = keys.where("groups > 1").select(
        "key",
        F.col("main.root").alias("main"),
        blocks(F.col("size")).alias("m_blocks"),
        blocks(F.col("size") - F.col("main.size")).alias("s_blocks"),
    )
    mixed_ = stage(placed.join(keys, "key"), "mixed-buckets")
    part = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = mixed_.select(
        "key", "node", "root", F.lit(False).alias("odd"), part("m_blocks", 1).alias("m"), every("s_blocks").alias("s")
    )
    odd = mixed_.where("root <> main").select(
        "key", "node", "root", F.lit(True).alias("odd"), every("m_blocks").alias("m"), part("s_blocks", 2).alias("s")
    )
    filled = members.unionByName(odd).join(sets, "node")
    links = filled.groupBy("key", "m", "s").applyInArrow(_compare_block, "a long, b long")
    return links.distinct()


def _compare_block(table: pa.Table) -> pa.Table:
    """Links between the strangers (odd) and the members of one block."""
    odd = table["odd"].to_numpy()
    nodes, roots = table["node"].to_numpy(), table["root"].to_numpy()
    sets = table["shingles"].combine_chunks()
    bounds, flat = sets.offsets.to_numpy(), sets.values.to_numpy()
    members = np.flatnonzero(~odd)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(members)), sizes[members])
    values = np.concatenate([flat[bounds[i] : bounds[i + 1]] for i in members] or [flat[:0]])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    found: set[tuple[int, int]] = set()
    for x in np.flatnonzero(odd):
        own = flat[bounds[x] : bounds[x + 1]]
        first = np.searchsorted(values, own, side="left")
        n = np.searchsorted(values, own, side="right") - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        shared = np.bincount(owner[at], minlength=len(members))
        near = 100 * shared >= SHARE * (sizes[x] + sizes[members] - shared)
        for y in members[near & (roots[members] != roots[x])]:
            found.add((int(min(nodes[x], nodes[y])), int(max(nodes[x], nodes[y]))))
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
