"""MinHash banding over pieces of text: signatures, colliding pairs, verification, classes.

A piece is known by the hash of its text, so copies are one piece however many rows
hold them. A first round is cheap. A bucket of two pieces is one pair. In a larger one
two pieces are chosen, and every piece is compared with them: the most central one, which
meets the most others over all its buckets, as the original does in a group of changed
copies, and the one with the least hash. Both come out the same in most buckets that a
group of copies shares, so few pairs are met twice. Verified pairs are joined into
components.

A second round settles what that left open. Where pieces of a bucket that were not
chosen lie in two components or more, all of them are compared with each other: they
are dealt into blocks, each two blocks meet in one group, and a group counts the common
shingles of all its pairs by a matrix product. So every pair that shares a bucket is
either verified, or joined by a chain already; only banding itself can miss one.

Buckets, pieces and pairs grow with the corpus, so they are joined by shuffles, whose hot
keys Spark splits; counts and minima are merged in each task first. Only bitmaps of at
most ``MOST_SLOTS`` bits are broadcast: they let the rows of large buckets, and the texts
of pieces in pairs, be picked before those are shuffled. A full bitmap picks too many,
never too few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import Scratch
from lamella.llm.components import components

#: Multiplier of the rolling hash and seed of the permutations.
_STEP, _SEED = np.uint64(0x9E3779B97F4A7C15), 20_011
#: Tokens hashed at once, few enough for a core's cache.
_BLOCK = 1 << 16
#: Bits for the number of a pair among those verified at once, and characters in them; one pair may hold more.
_PAIR_BITS, _PAIR_CHARS = 8, 1 << 18
#: Pieces, and bytes of text, in a block of an open bucket; two blocks are compared in memory.
BLOCK_PIECES, BLOCK_BYTES = 256, 1 << 19
#: Shingles in one matrix product.
_COLUMNS = 4096
#: Bits in a broadcast bitmap for each row it stands for, and at least and at most.
SLOTS_A_ROW, LEAST_SLOTS, MOST_SLOTS = 16, 1 << 18, 1 << 28

#: Tokens of texts in a row, and the number of each text's tokens.
Tokens = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
#: Which of some keys a bitmap picks.
Picks = Callable[[np.ndarray], np.ndarray]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` tokens (unsigned 64-bit); at least one token more is given."""
    n = len(tokens) - width + 1
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = h * _STEP + tokens[k : k + n]
        return _mix(h)


def _shingles(tokens: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of texts that each have ``width`` tokens at least, and how many each text has."""
    ends = np.cumsum(lengths)
    valid = np.ones(len(tokens) - width + 1, bool)
    for k in range(1, width):  # runs that reach into the next text
        valid[ends[:-1] - k] = False
    return shingle_hashes(tokens, width)[valid], lengths - width + 1


def buckets(tokens: np.ndarray, lengths: np.ndarray, width: int, bands: int, rows: int) -> np.ndarray:
    """(pieces, bands) bucket numbers; ``tokens`` of all pieces in a row, each longer than ``width``."""
    rnd = np.random.default_rng(_SEED)
    masks = rnd.integers(0, 1 << 32, bands * rows, np.uint32)
    factors = rnd.integers(0, 1 << 31, bands * rows, np.uint32) * np.uint32(2) + np.uint32(1)
    hashes, counts = _shingles(tokens, lengths, width)
    hashes = (hashes >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    out = np.empty((len(lengths), bands), np.uint64)
    scratch = np.empty_like(hashes)
    with np.errstate(over="ignore"):
        for band in range(bands):
            key = np.full(len(lengths), band + 1, np.uint64)
            for j in range(band * rows, (band + 1) * rows):
                np.bitwise_xor(hashes, masks[j], out=scratch)
                np.multiply(scratch, factors[j], out=scratch)
                key = _mix(key * _STEP + np.minimum.reduceat(scratch, starts))
            out[:, band] = key
    return out


def bucket_rows(uids: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, width: int, bands: int, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(uids, buckets) arrays, a row for each band, of the pieces with more than ``width`` tokens.

    A shorter piece is one shingle and similar only to its equals, which share its uid.
    Of pieces with equal uid the first counts; hashes are made for some pieces at a time.
    """
    _, first = np.unique(uids, return_index=True)
    wanted = np.zeros(len(uids), bool)
    wanted[first] = True
    wanted &= lengths > width
    tokens, uids, lengths = tokens[np.repeat(wanted, lengths)], uids[wanted], lengths[wanted]
    ends = np.cumsum(lengths)
    at = 0
    while at < len(uids):
        begin = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, begin + _BLOCK, "right")))
        keys = buckets(tokens[begin : ends[stop - 1]], lengths[at:stop], width, bands, rows)
        yield np.repeat(uids[at:stop], bands), keys.view(np.int64).ravel()
        at = stop


def _bitmap(keys: DataFrame, column: str) -> Picks:
    """A test, sent to all tasks, that holds for all values of a long column and for few others."""
    spark, rows = keys.sparkSession, keys.count()
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (SLOTS_A_ROW * rows).bit_length()))
    slot = F.col(column).bitwiseAND(F.lit(slots - 1)) + 1
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.select(F.bitmap_bucket_number(slot).alias("part"), F.bitmap_bit_position(slot).alias("bit")).repartition(tasks, "part")
    bits = np.zeros(slots // 8, np.uint8)
    for r in dealt.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():  # MOST_SLOTS bits in all
        at = (r.part - 1) * len(r.bits)
        bits[at : at + len(r.bits)] = np.frombuffer(r.bits, np.uint8)[: len(bits) - at]
    sent = spark.sparkContext.broadcast(bits)

    def picks(values: np.ndarray) -> np.ndarray:
        place = values & np.int64(slots - 1)
        return (sent.value[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)

    return picks


def _picked(keys: DataFrame, picks: Picks) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(picks(batch.column("bucket").to_numpy())))

    return keys.mapInArrow(run, keys.schema)


def _placed(hashes: np.ndarray, counts: np.ndarray, places: np.ndarray, bits: int) -> np.ndarray:
    """Hashes with the place of their piece in the low ``bits``; the top bits of a hash go."""
    return hashes << np.uint64(bits) | np.repeat(places.astype(np.uint64), counts)


def _different(cells: np.ndarray) -> np.ndarray:
    """The values of ``cells``, sorted, each once; sorts in place."""
    cells.sort()
    new = np.ones(len(cells), bool)
    np.not_equal(cells[1:], cells[:-1], out=new[1:])
    return cells[new]


def overlaps(own: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles that each piece of ``own`` shares with the piece of ``other`` at ``of``, and those of both.

    Pieces are (shingle hashes, counts), 2^8 pairs at most; a shingle is known by 56 bits of its hash.
    """
    n = len(of)
    sizes = lambda cells, n: np.bincount((_different(cells) & np.uint64((1 << _PAIR_BITS) - 1)).astype(np.intp), minlength=n)
    counts = other[1][of]
    at = np.arange(counts.sum()) + np.repeat((np.cumsum(other[1]) - other[1])[of] - (np.cumsum(counts) - counts), counts)
    mine = _placed(*own, np.arange(n), _PAIR_BITS)
    both = sizes(np.concatenate((mine, _placed(other[0][at], counts, np.arange(n), _PAIR_BITS))), n)
    known = sizes(_placed(*other, np.arange(len(other[1])), _PAIR_BITS), len(other[1]))
    return sizes(mine, n) + known[of] - both, both


def _verified(pairs: DataFrame, texts: DataFrame, scratch: Scratch, tokens_of: Tokens, width: int, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` (rep, uid) whose texts have a Jaccard similarity of ``threshold`` or more.

    The second join sorts by the chosen piece, whose shingles are so made once for many of its pairs.
    """
    both = pairs.join(texts.select("uid", F.col("text").alias("own")), "uid").join(texts.select(F.col("uid").alias("rep"), F.col("text").alias("other")), "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps = batch.column("rep").to_numpy()
            lengths = np.cumsum(pc.add(pc.utf8_length(batch.column("own")), pc.utf8_length(batch.column("other"))).to_numpy(zero_copy_only=False), dtype=np.int64)
            at, hit = 0, np.zeros(batch.num_rows, bool)
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(lengths, (lengths[at - 1] if at else 0) + _PAIR_CHARS, "right")))
                stop = min(stop, at + (1 << _PAIR_BITS))
                starts = np.flatnonzero(np.diff(reps[at:stop], prepend=~reps[at]))
                own, other = (_shingles(*tokens_of(t.to_pylist()), width) for t in (batch.column("own").slice(at, stop - at), batch.column("other").take(pa.array(at + starts))))
                of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, stop - at)))
                common, union = overlaps(own, other, of)
                hit[at:stop] = common >= threshold * union
                at = stop
            mask = pa.array(hit)
            yield pa.RecordBatch.from_arrays([batch.column("rep").filter(mask), batch.column("uid").filter(mask)], ["a", "b"])

    return scratch.keep(both.select("rep", "uid", "own", "other").mapInArrow(run, "a long, b long"), "verified")


def similar_pairs(hashes: np.ndarray, counts: np.ndarray, roots: np.ndarray, sides: np.ndarray | None, threshold: float) -> list[tuple[int, int]]:
    """Pairs of places, of different roots, at a similarity of ``threshold`` or more.

    ``hashes`` are the shingles of one piece after the other, ``counts`` how many each has.
    With ``sides`` only pairs of different sides count. A pair that the pairs before it
    join already is left out.
    """
    n = len(counts)
    bits = n.bit_length()
    cells = _different(_placed(hashes.astype(np.uint64), counts, np.arange(n), bits))  # a shingle counts once in a piece
    places, cells = (cells & np.uint64((1 << bits) - 1)).astype(np.int64), cells >> np.uint64(bits)
    columns = np.zeros(len(cells), np.int64)
    np.cumsum(cells[1:] != cells[:-1], out=columns[1:])
    sizes = np.bincount(places, minlength=n)
    # No pair lies inside the largest component, so only the other pieces, and their shingles, are counted.
    _, component, members = np.unique(roots, return_inverse=True, return_counts=True)
    others = component != members.argmax()
    rows = np.flatnonzero(others)
    met = (np.bincount(columns) > 1) & (np.bincount(columns, others[places]) > 0)
    held = met[columns]
    columns, places = (np.cumsum(met) - 1)[columns[held]], places[held]
    common = np.zeros((len(rows), n), np.float32)
    for first in range(0, int(met.sum()), _COLUMNS):
        lo, hi = np.searchsorted(columns, (first, first + _COLUMNS))
        block = np.zeros((n, min(_COLUMNS, int(met.sum()) - first)), np.float32)
        block[places[lo:hi], columns[lo:hi] - first] = 1
        common += block[rows] @ block.T
    hit = common >= threshold * (sizes[rows, None] + sizes[None, :] - common.astype(np.float64))
    hit &= roots[rows, None] != roots[None, :]
    if sides is not None:
        hit &= sides[rows, None] != sides[None, :]
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while x in top:
            x = top[x]
        return x

    out = []
    at, to = np.nonzero(hit)
    for i, j in zip(rows[at].tolist(), to.tolist(), strict=True):
        x, y = find(int(roots[i])), find(int(roots[j]))
        if x != y:
            top[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def _open_links(met: DataFrame, chosen: DataFrame, roots: DataFrame, texts: DataFrame, scratch: Scratch, tokens_of: Tokens, width: int, threshold: float) -> DataFrame:
    """(a, b) that join components, from all pairs of a bucket's pieces that were not chosen."""
    free = met.join(chosen, "bucket").where("uid <> central and uid <> least").select("bucket", "uid").distinct()
    free = scratch.keep(free.join(roots, F.col("uid") == F.col("node"), "left").select("bucket", "uid", F.coalesce("root", "uid").alias("root")), "free")
    mixed = free.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("bucket")
    left = scratch.keep(free.join(mixed, "bucket").join(texts, "uid").select("bucket", "uid", "root", "text"), "open")
    scratch.drop(free)
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_PIECES), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("int").alias("parts")
    dealt = left.join(left.groupBy("bucket").agg(parts), "bucket")
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("bucket", "uid"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("bucket", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "uid", "root", "side", "text")
    # A number of its own: by size alone these few bytes would go to one task.
    tasks = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(tasks, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        at = None

        def links() -> pa.RecordBatch:
            found: list[tuple[int, int]] = []
            uids = [g[0] for g in group]
            if len(group) > 1:
                sides = np.array([g[2] for g in group]) if at[1] != at[2] else None
                hashes, counts = _shingles(*tokens_of([g[3] for g in group]), width)
                found = similar_pairs(hashes, counts, np.array([g[1] for g in group], np.int64), sides, threshold)
            return pa.RecordBatch.from_arrays([pa.array([uids[k] for k, _ in found], pa.int64()), pa.array([uids[k] for _, k in found], pa.int64())], ["a", "b"])

        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("bucket", "i", "j")], strict=True)
            for key, *row in zip(keys, *[batch.column(c).to_pylist() for c in ("uid", "root", "side", "text")], strict=True):
                if key != at:
                    if group:
                        yield links()
                    group, at = [], key
                group.append(tuple(row))
        if group:
            yield links()

    joins = scratch.keep(dealt.mapInArrow(run, "a long, b long"), "joins")
    scratch.drop(left)
    return joins


def classes(
    scratch: Scratch,
    keys: DataFrame,
    pieces: Callable[[Picks], DataFrame],
    tokens_of: Tokens,
    width: int,
    threshold: float,
) -> DataFrame:
    """(node, root) of the pieces that are similar to another, root the smallest of the class.

    ``keys`` is a written table (bucket, uid); ``pieces`` gives (uid, text) of the pieces that
    a test picks, so that only texts of pieces in pairs are fetched. Its own tables are
    dropped again.
    """
    sizes = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("lo"), F.max("uid").alias("hi")).where("lo < hi")
    sizes = scratch.keep(sizes, "sizes")
    large = sizes.where("n > 2").select("bucket", "n")
    met = scratch.keep(_picked(keys, _bitmap(large, "bucket")).join(large, "bucket"), "met")
    # The hash in the low bits settles ties.
    rank = (F.sum("n") * (1 << 20) + F.first(F.pmod(F.xxhash64("uid"), F.lit(1 << 20)))).alias("rank")
    ranked = met.join(met.groupBy("uid").agg(rank), "uid")
    chosen = scratch.keep(ranked.groupBy("bucket").agg(F.max_by("uid", "rank").alias("central"), F.min_by("uid", F.xxhash64("uid")).alias("least")), "chosen")
    members = met.join(chosen, "bucket").select("uid", F.explode(F.array("central", "least")).alias("rep"))
    pairs = sizes.where("n = 2").select(F.col("hi").alias("uid"), F.col("lo").alias("rep")).union(members.where("uid <> rep"))
    pairs = pairs.groupBy(F.least("uid", "rep").alias("a"), F.greatest("uid", "rep").alias("b")).agg(F.max("rep").alias("rep"))
    pairs = scratch.keep(pairs.select("rep", F.when(F.col("rep") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("uid")), "pairs")
    scratch.drop(sizes)
    needed = scratch.keep(pairs.select("uid").union(pairs.select("rep")).distinct(), "needed")
    texts = scratch.keep(pieces(_bitmap(needed, "uid")).join(needed, "uid", "left_semi").groupBy("uid").agg(F.first("text").alias("text")), "texts")
    links = _verified(pairs, texts, scratch, tokens_of, width, threshold)
    scratch.drop(pairs, needed)
    roots = components(scratch, links)
    joins = _open_links(met, chosen, roots, texts, scratch, tokens_of, width, threshold)
    scratch.drop(met, chosen, texts, links)
    if joins.isEmpty():
        return roots
    # The stars that stand already, and the pairs that join them.
    return components(scratch, roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(joins))
