"""Importance resampling towards a target distribution, over hashed word n-grams.

Words are runs of 0-9, a-z (after folding A-Z) and any non-ASCII byte; a text's features are all runs of one to
``order`` words, joined by one blank, repeats counted. A feature's bucket is the CRC-32 of its bytes modulo ``buckets``.
Bucket counts over all documents and over the target texts give each bucket a gain; a document's weight is the sum of
its features' gains, and the rows with the highest weight plus Gumbel noise are drawn.

CRC-32 is linear, so a feature's value is the XOR of what each of its bytes adds, which depends on the byte and its
distance from the end only, and of a constant for the length. Both come from tables, and the bytes of all features that
end at the same word are looked up together and reduced with ``bitwise_xor.reduceat``. Features longer than the table
are cut into blocks that are folded one after another.

NULL and empty texts have no words, no features and weight 0, and are never drawn. A row with fewer than ``least``
words is not drawn either. Equal scores go to the smaller id, NULL first; of rows equal in score and id each has a rank
of its own. Texts are read whole, in pieces of bounded size where they are longer than a block. An empty table gives an
empty result, an empty target makes all gains follow from the documents alone. Only id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from chargelake.llm.blocks import text_blocks
from chargelake.operators.ordering import running_total
from chargelake.staging import staged

BUCKETS = 10_000
ORDER = 3
LEAST_WORDS = 20
TABLE = 256  # distances from the end that the table holds; also the length of a folded block
BLOCK_BYTES = 1 << 20
ONES = np.uint32(0xFFFFFFFF)


@cache
def position_table() -> np.ndarray:
    """What a byte adds to the register, by its distance from the end: TABLE rows of 256 bytes, as one run."""
    rows = np.empty((TABLE, 256), np.uint32)
    # For one byte the constant of its length falls out, and what is left is the byte's own share.
    rows[0] = [zlib.crc32(bytes([byte])) ^ zlib.crc32(b"\0") for byte in range(256)]
    for distance in range(1, TABLE):
        rows[distance] = (rows[distance - 1] >> np.uint32(8)) ^ rows[0][rows[distance - 1] & np.uint32(255)]
    return rows.ravel()


@cache
def length_constants() -> np.ndarray:
    """CRC-32 of as many zero bytes, by length from 0 to TABLE."""
    return np.array([zlib.crc32(bytes(length)) for length in range(TABLE + 1)], np.uint32)


def moved_by_block(register: np.ndarray) -> np.ndarray:
    """A register after a block of zero bytes: its four bytes count like data at the block's start."""
    table = position_table()
    moved = np.zeros_like(register)
    for i in range(4):
        moved ^= table[(TABLE - 1 - i) * 256 + ((register >> np.uint32(8 * i)) & np.uint32(255))]
    return moved


def folded_crc(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of non-empty spans of any length; in steps of a bounded number of bytes.

    A span is cut into blocks from its end, so that only its first block may be shorter than the table.
    """
    out = np.empty(len(starts), np.uint32)
    lengths = ends - starts
    blocks = -(-lengths // TABLE)
    per_step = BLOCK_BYTES // TABLE
    first = 0
    while first < len(starts):
        last = first + max(1, int(np.searchsorted(np.cumsum(blocks[first:]), per_step, side="right")))
        heads, finish, count = starts[first:last], ends[first:last], blocks[first:last]
        # The first block of each span, then the others in rounds; long lone spans take many rounds of one block each.
        head_ends = finish - (count - 1) * TABLE
        register = _spans_share(data, heads, head_ends) ^ length_constants()[head_ends - heads] ^ ONES
        done, most = 1, int(count.max())
        while done < most:
            rounds = min(most - done, per_step)
            going = np.flatnonzero(count > done)
            todo = np.minimum(count[going] - done, rounds)
            begin = np.repeat(head_ends[going] + (done - 1) * TABLE, todo)
            begin += (np.arange(len(begin)) - np.repeat(np.cumsum(todo) - todo, todo)) * TABLE
            shares = _spans_share(data, begin, begin + TABLE)
            at = np.cumsum(todo) - todo
            for i in range(int(todo.max())):
                live = todo > i
                rows = going[live]
                register[rows] = moved_by_block(register[rows]) ^ shares[at[live] + i]
            done += rounds
        out[first:last] = register ^ ONES
        first = last
    return out


def _spans_share(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of what the bytes of each span add, for non-empty spans within the table."""
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) + np.repeat(starts - at, lengths)
    distance = np.repeat(ends - 1, lengths) - place
    return np.bitwise_xor.reduceat(position_table()[distance * 256 + data[place]], at)


@cache
def folded_bytes() -> np.ndarray:
    """Each byte in lower case, or 0 where it separates words."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[:0x30] = 0
    table[0x3A : ord("A")] = 0
    table[0x5B:0x61] = 0
    table[0x7B:0x80] = 0
    return table


def joined_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths, rows): all words, one blank after each, and where each begins and belongs."""
    low = folded_bytes()[data]
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = low != 0
    edges = np.zeros(len(low) + 1, bool)
    edges[offsets] = True
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2] | edges[1:-1]
    starts = np.flatnonzero(first)
    last = inside[:-1] & (~inside[1:] | edges[1:])
    lengths = np.flatnonzero(last) + 1 - starts
    rows = np.searchsorted(offsets, starts, side="right") - 1
    kept = low[inside[:-1]]
    number = np.arange(len(starts))
    joined = np.full(len(kept) + len(starts), 32, np.uint8)
    joined[np.arange(len(kept)) + np.repeat(number, lengths)] = kept
    return joined, np.cumsum(lengths + 1) - (lengths + 1), lengths, rows


def feature_buckets(
    joined: np.ndarray, starts: np.ndarray, lengths: np.ndarray, rows: np.ndarray, order: int, buckets: int,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the last word, bucket) of all features of 1, 2, ... ``order`` words."""
    if not len(starts):
        return
    table, constants = position_table(), length_constants()
    sizes = lengths + 1
    own = np.repeat(starts + lengths - 1, sizes) - np.arange(len(joined))  # distance from the word's end; -1 for the blank
    tail = lengths.copy()  # bytes from a feature's first word to its end
    crc = np.zeros(len(starts), np.uint32)  # of the feature that begins at each word
    whole = np.ones(len(starts), bool)
    for size in range(1, min(order, len(starts)) + 1):
        if size == 1:
            distance = np.maximum(own, 0)
        else:
            whole[len(starts) - size + 1 :] = False
            whole[: len(starts) - size + 1] &= rows[: len(starts) - size + 1] == rows[size - 1 :]
            gap = np.zeros(len(starts), np.int64)
            gap[: len(starts) - size + 1] = starts[size - 1 :] + lengths[size - 1 :] - starts[: len(starts) - size + 1] - lengths[: len(starts) - size + 1]
            tail = lengths + gap
            distance = own + np.repeat(gap, sizes)
        shares = table[np.minimum(np.maximum(distance, 0), TABLE - 1) * 256 + joined]
        if size == 1:
            shares[starts + lengths] = 0  # the blank after a word is no part of it
        share = np.bitwise_xor.reduceat(shares, starts)
        # What follows the first word is the feature of one word less that begins at the next word.
        rest = np.append(crc[1:], np.uint32(0)) if size > 1 else crc
        linear = share ^ rest
        crc = linear
        at = np.flatnonzero(whole)
        value = linear[at] ^ constants[np.minimum(tail[at], TABLE)]
        long = np.flatnonzero(tail[at] > TABLE)
        if len(long):
            value[long] = folded_crc(joined, starts[at[long]], starts[at[long]] + tail[at[long]])
        yield at, (value % np.uint32(buckets)).astype(np.int64)


def pieces(data: np.ndarray, offsets: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Joined words of a block, or of one long text in pieces of whole words that share ``order`` - 1 words.

    The last value is how many words at the start belong to the piece before.
    """
    if len(data) <= 2 * BLOCK_BYTES:
        yield *joined_words(data, offsets), 0
        return
    separators = folded_bytes()[data] == 0
    begin, carried = 0, np.zeros(0, np.uint8)
    while begin < len(data):
        end = begin + BLOCK_BYTES
        if end < len(data):
            further = np.argmax(separators[end:]) if separators[end:].any() else len(data) - end
            end += int(further)
        piece = np.concatenate([carried, data[begin:end]])
        joined, starts, lengths, rows = joined_words(piece, np.array([0, len(piece)]))
        shared = len(joined_words(carried, np.array([0, len(carried)]))[1])
        yield joined, starts, lengths, rows, shared
        keep = starts[max(len(starts) - order + 1, 0)] if len(starts) and order > 1 else len(joined)
        carried = joined[keep:].copy()
        begin = end


def features_of(data: np.ndarray, offsets: np.ndarray, order: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of new words, rows of features, buckets of features), piece by piece."""
    for joined, starts, lengths, rows, shared in pieces(data, offsets, order):
        own, found = [], []
        for size, (at, bucket) in enumerate(feature_buckets(joined, starts, lengths, rows, order, buckets), 1):
            new = at + size > shared  # a feature counts where its last word is new
            own.append(rows[at[new]])
            found.append(bucket[new])
        none = np.zeros(0, np.int64)
        yield rows[shared:], np.concatenate(own) if own else none, np.concatenate(found) if found else none


def bucket_counts(texts: DataFrame, text_col: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """How many features all rows have in each bucket; each task sends at most one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, offsets in text_blocks(batch.column(0), BLOCK_BYTES):
                for _, _, found in features_of(data, offsets, order, buckets):
                    sums += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["bucket", "n"])

    rows = texts.select(F.col(text_col).cast("string"))
    found = rows.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def gains(all_counts: np.ndarray, target_counts: np.ndarray) -> np.ndarray:
    """A thousandth of a nat as the unit, rounded down: how much likelier a bucket is in the target."""
    buckets = len(all_counts)
    target = (target_counts + 1).astype(float) * float(all_counts.sum() + buckets)
    source = (all_counts + 1).astype(float) * float(target_counts.sum() + buckets)
    return np.floor(1000 * np.log(target / source)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, data, offsets in text_blocks(batch.column(1), BLOCK_BYTES):
                count = len(offsets) - 1
                for worded, rows, found in features_of(data, offsets, order, len(shared.value)):
                    words[first : first + count] += np.bincount(worded, minlength=count)
                    features[first : first + count] += np.bincount(rows, minlength=count)
                    sums = np.bincount(rows, shared.value[found], minlength=count)  # whole numbers, exact to 2^53
                    weights[first : first + count] += sums.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words, features, weights))], names=[id_col, "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    longs = [T.StructField(name, T.LongType()) for name in ("n_words", "n_features", "weight")]
    return rows.mapInArrow(run, T.StructType([rows.schema[0], *longs]))


def gumbel(id_col: str, seed: int) -> Column:
    """Noise from a hash of seed and id, in the gains' unit; equal in every run."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
    target_col: str = "text", least: int = LEAST_WORDS, order: int = ORDER, buckets: int = BUCKETS,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row; ``rank`` is NULL for rows that are not drawn.

    ``percent`` of the rows with ``least`` words are drawn. Ranks are running totals over slices sorted by score, so no
    task holds all of them.
    """
    gain = gains(bucket_counts(docs, text_col, order, buckets), bucket_counts(target, target_col, order, buckets))
    score = F.col("weight") + gumbel(id_col, seed)
    scored = staged(weigh(docs, gain, id_col, text_col, order).withColumn("score", score), "scored")
    enough = F.col("n_words") >= least
    drawn = scored.filter(enough).count() * percent // 100
    best = scored.filter(enough).select(
        "*", (-F.col("score")).alias("_order"), F.monotonically_increasing_id().alias("_row"), F.lit(1).cast("bigint").alias("_one"))
    placed = running_total(best, [], ["_order", id_col, "_row"], "_one", "_place")
    rank = F.when(F.col("_place") <= drawn, F.col("_place"))
    ranked = placed.select(*scored.columns, rank.alias("rank"))
    return ranked.unionByName(scored.filter(~enough).withColumn("rank", F.lit(None).cast("bigint")))
