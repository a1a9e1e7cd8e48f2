"""Context-tree scores over true bytes, with a model that is a stored table and grows with the corpus.

A key is the ``depth`` bytes before a byte, the nearest first, and the byte itself. Keys go to trees by a hash of their
three nearest bytes, so a tree has whole contexts of three bytes. Training texts give cells (key, count), in one sorted
list per block of text and tree, which are merged and stored. Contexts of at most two bytes are summed over all trees;
only they are broadcast, at most 65,536 of them whatever the corpus. The texts to score are stored in blocks as well; the
distinct keys of each block meet the cells of their tree, which is weighed from the deepest context up, and what comes
back to the block is one log probability per key. So neither a key nor a probability is sent once per occurrence, and
lists are delta-coded and compressed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log, pi

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from chargelake.llm import ctw
from chargelake.llm.blocks import text_blocks
from chargelake.staging import staged

SHALLOW = 2
BLOCK_BYTES = 8 << 20
PIECE_BYTES = 1 << 20
TREE_BYTES = 8 << 20  # text for each tree, at least
_TURN = np.uint64(0x9E3779B97F4A7C15)
_GAMMA = ctw.log_gamma(np.arange(1 << 16) / 2 + 0.5)


def keys_of(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of each byte and end mark of a block, and how many keys each text has. END lies before a text.

    The bytes of a key are written in place, lowest first: the byte itself, then the one furthest back.
    """
    marked = np.insert(data, offsets[1:], ctw.END)
    lengths = np.diff(offsets) + 1
    starts = np.cumsum(lengths) - lengths
    keys, early = np.zeros(len(marked), "<i8"), np.zeros(0, np.int64)
    parts = keys.view(np.uint8).reshape(-1, 8)
    parts[:, 0] = marked
    for back in range(1, depth + 1):
        parts[back:, depth - back + 1] = marked[:-back]
        early = np.concatenate([early, starts + back - 1])
        early = early[early < len(marked)]
        parts[early, depth - back + 1] = ctw.END
    return keys.astype(np.int64, copy=False), lengths


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and how often each occurs; ``keys`` is sorted in place."""
    keys.sort()
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[at], np.diff(np.append(at, len(keys)))


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all first bytes first; ``unpacked`` reverses it."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return packed(np.diff(keys, prepend=0))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.int64))


def by_tree(keys: np.ndarray, depth: int, trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, trees, bounds): places of sorted keys tree by tree, the trees met, and where each begins and ends."""
    nearest = (keys >> (8 * (depth - SHALLOW))).astype(np.uint64)
    tree = ((nearest * _TURN >> np.uint64(40)) % np.uint64(trees)).astype(np.int64)
    order = np.argsort(tree, kind="stable")
    tree = tree[order]
    first = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))[: len(tree)]
    return order, tree[first], np.append(first, len(tree))


def _rows(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in columns.values()], names=list(columns))


def cell_lists(texts: DataFrame, depth: int, trees: int) -> DataFrame:
    """(tree, keys, n): each block's keys and how often it has them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_blocks(batch.column(0), BLOCK_BYTES):
                keys, n = distinct(keys_of(data, offsets, depth)[0])
                order, met, bounds = by_tree(keys, depth, trees)
                parts = [order[i:j] for i, j in zip(bounds, bounds[1:])]
                yield _rows({
                    "tree": (met, pa.int64()), "keys": ([packed_keys(keys[part]) for part in parts], pa.binary()),
                    "n": ([packed(n[part].astype(np.uint32)) for part in parts], pa.binary())})

    return texts.mapInArrow(count, "tree bigint, keys binary, n binary")


def log_gamma_half(twice: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function at ``twice`` / 2 + 1/2, for whole numbers."""
    small = twice < len(_GAMMA)
    found = _GAMMA[np.where(small, twice, 0).astype(np.int64)]
    if not small.all():
        found[~small] = ctw.log_gamma(twice[~small] / 2 + 0.5)
    return found


def estimate(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of the decisions of contexts, and of a further one being 1, both by Krichevsky-Trofimov."""
    whole = log_gamma_half(2 * zeros) + log_gamma_half(2 * ones) - log_gamma_half(2 * (zeros + ones) + 1) - log(pi)
    return whole, (ones + 0.5) / (zeros + ones + 1)


def mix(zeros: np.ndarray, ones: np.ndarray, of_children: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts with children: weighted log probability, the estimate of a 1, and the weight of that estimate."""
    whole, one = estimate(zeros, ones)
    weighted = np.logaddexp(whole, of_children) - log(2)
    return weighted, one, np.exp(whole - log(2) - weighted)


def weigh(keys: np.ndarray, n: np.ndarray, depth: int, sums_only: bool = False) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """Of sorted cells: the chance of a 1 at each of their eight decisions, mixed from the depth below ``SHALLOW`` down.

    And, per level of decisions, (context of ``SHALLOW`` bytes << 8 | decision, zeros, ones, log probability below).
    """
    chances, sums = np.empty((8, len(keys)), np.float32), []
    for level in range(8):
        byte = keys & 255
        places = (keys >> 8 << 8) | (1 << level) | (byte >> (8 - level))
        bit = (byte >> (7 - level)) & 1
        first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        places = places[first]
        ones = np.bincount(row, n * bit, len(first))
        zeros = np.bincount(row, n, len(first)) - ones
        weighted, one = estimate(zeros, ones)
        chance, above = one, np.arange(len(first))
        for at in range(depth - 1, SHALLOW - 1, -1):
            places, parent = np.unique(places >> 16 << 8 | places & 255, return_inverse=True)
            zeros, ones, below = (np.bincount(parent, part, len(places)) for part in (zeros, ones, weighted))
            if at == SHALLOW:
                sums.append((places, zeros, ones, below))
                break
            weighted, one, share = mix(zeros, ones, below)
            if not sums_only:
                above = parent[above]
                chance = share[above] * one[above] + (1 - share[above]) * chance
        if not sums_only:
            chances[level] = chance[row]
    return chances, sums


def shallow(sums: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, one, share) for contexts of ``SHALLOW`` bytes, then one byte less, and so on; places are sorted."""
    order = np.argsort(sums["place"].to_numpy())
    places, zeros, ones, below = (sums[name].to_numpy()[order] for name in ("place", "zeros", "ones", "below"))
    levels = []
    for at in range(SHALLOW, -1, -1):
        weighted, one, share = mix(zeros, ones, below)
        levels.append((places, one, share))
        if at:
            places, parent = np.unique(places >> 16 << 8 | places & 255, return_inverse=True)
            zeros, ones, below = (np.bincount(parent, part, len(places)) for part in (zeros, ones, weighted))
    return levels


def finished(keys: np.ndarray, chances: np.ndarray, levels: list[tuple[np.ndarray, ...]], depth: int) -> np.ndarray:
    """log10 probability of each key's byte: the chances from below mixed with those of the shallow contexts.

    A context that training lacks has an estimate of a half, and the weight of a half.
    """
    byte, logs = keys & 255, np.zeros(len(keys))
    for level in range(8):
        node, chance = (1 << level) | (byte >> (8 - level)), chances[level].astype(np.float64)
        for at, (places, one, share) in zip(range(SHALLOW, -1, -1), levels, strict=True):
            place = keys >> (8 * (depth - at + 1)) << 8 | node
            if len(places):
                found = np.minimum(np.searchsorted(places, place), len(places) - 1)
                known = places[found] == place
                own, weight = np.where(known, one[found], 0.5), np.where(known, share[found], 0.5)
            else:
                own = weight = 0.5
            chance = weight * own + (1 - weight) * chance
        logs += np.log10(np.where((byte >> (7 - level)) & 1, chance, 1 - chance))
    return logs


def rounded(logs: np.ndarray) -> np.ndarray:
    """To 20 significant bits, an error below 5e-7 of each, so that the last byte compresses."""
    bits = logs.astype(np.float32).view(np.uint32)
    return ((bits + np.uint32(8)) & np.uint32(0xFFFFFFF0)).view(np.float32)


def merged(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of several lists (keys, n) and the sum of n of each."""
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, place = np.unique(np.concatenate([keys for keys, _ in lists]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in lists]), len(keys)).astype(np.int64)


def learned(lists: DataFrame, depth: int) -> DataFrame:
    """(tree, keys, n, tops), stored: the cells of each tree, and what it adds to the shallow contexts."""

    def tree(group: pd.DataFrame) -> pd.DataFrame:
        keys, n = merged([(unpacked_keys(keys), unpacked(n, np.uint32)) for keys, n in zip(group["keys"], group["n"])])
        _, sums = weigh(keys, n, depth, sums_only=True)
        tops = np.concatenate([np.stack([part.astype(np.float64) for part in level], axis=1) for level in sums])
        return pd.DataFrame({"tree": [group["tree"].iloc[0]], "keys": [packed_keys(keys)], "n": [packed(n)], "tops": [tops.tobytes()]})

    return staged(lists.groupBy("tree").applyInPandas(tree, "tree bigint, keys binary, n binary, tops binary"), "cells")


def tops_of(cells: DataFrame) -> list[tuple[np.ndarray, ...]]:
    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                tops = np.frombuffer(value).reshape(-1, 4)
                yield _rows({"place": (tops[:, 0].astype(np.int64), pa.int64())} | {
                    name: (tops[:, i], pa.float64()) for i, name in enumerate(("zeros", "ones", "below"), 1)})

    tops = cells.select("tops").mapInArrow(opened, "place bigint, zeros double, ones double, below double")
    return shallow(tops.groupBy("place").agg(*(F.sum(name).alias(name) for name in ("zeros", "ones", "below"))).toArrow())


def text_blocks_of(rows: DataFrame) -> DataFrame:
    """(block, named, sizes, data), stored: row keys, lengths and bytes of a run of texts, under a number of its own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 31
        for batch in batches:
            named = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
            for first, data, offsets in text_blocks(batch.column(2), BLOCK_BYTES):
                own = named[first : first + len(offsets) - 1].tobytes()
                yield _rows({
                    "block": ([block], pa.int64()), "named": ([own], pa.binary()), "sizes": ([packed(np.diff(offsets))], pa.binary()),
                    "data": ([zstandard.ZstdCompressor(level=6).compress(data.tobytes())], pa.binary())})
                block += 1

    return staged(rows.select("a", "b", "text").mapInArrow(cut, "block bigint, named binary, sizes binary, data binary"), "blocks")


def _opened(sizes: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum(unpacked(sizes, np.int64))])
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), offsets


def asked_lists(blocks: DataFrame, depth: int, trees: int) -> DataFrame:
    """(tree, block, keys): the distinct keys of each block."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, data in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                keys, _ = distinct(keys_of(*_opened(sizes, data), depth)[0])
                order, met, bounds = by_tree(keys, depth, trees)
                parts = [packed_keys(keys[order[i:j]]) for i, j in zip(bounds, bounds[1:])]
                yield _rows({"tree": (met, pa.int64()), "block": ([block] * len(met), pa.int64()), "keys": (parts, pa.binary())})

    return blocks.select("block", "sizes", "data").mapInArrow(ask, "tree bigint, block bigint, keys binary")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows with the same first value, which must stand together."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def answers(cells: DataFrame, asked: DataFrame, depth: int, parts: int) -> DataFrame:
    """(block, tree, logs): of each list of asked keys, the log10 probabilities, in its order."""
    levels = cells.sparkSession.sparkContext.broadcast(tops_of(cells))
    model = cells.select("tree", F.lit(-1).cast("bigint").alias("block"), "keys", "n")
    met = model.unionByName(asked.withColumn("n", F.lit(None).cast("binary")))
    met = met.repartition(parts, "tree").sortWithinPartitions("tree", "block").select("tree", "block", "keys", "n")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            lists = [(block, unpacked_keys(keys)) for _, block, keys, n in rows if block >= 0]
            counted = [(unpacked_keys(keys), unpacked(n, np.int64)) for _, block, keys, n in rows if block < 0]
            keys, n = merged(counted + [(keys, np.zeros(len(keys), np.int64)) for _, keys in lists])
            logs = rounded(finished(keys, weigh(keys, n, depth)[0], levels.value, depth))
            for block, own in lists:
                yield _rows({
                    "block": ([block], pa.int64()), "tree": ([rows[0][0]], pa.int64()),
                    "logs": ([packed(logs[np.searchsorted(keys, own)])], pa.binary())})

    return met.mapInArrow(answer, "block bigint, tree bigint, logs binary")


def runs_of(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets from 0) of runs of texts with at most ``limit`` bytes, or of one longer text."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def text_sums(keys: np.ndarray, logs: np.ndarray, data: np.ndarray, offsets: np.ndarray, depth: int) -> np.ndarray:
    """The sum of the logs of each text's keys, all of which are among ``keys``."""
    own, lengths = keys_of(data, offsets, depth)
    order = np.argsort(own)
    in_text = np.empty(len(own), np.float32)
    in_text[order] = logs[np.searchsorted(keys, own[order])]
    return np.add.reduceat(in_text, np.cumsum(lengths) - lengths, dtype=np.float64)


def tree_scores(rows: DataFrame, training: DataFrame, depth: int) -> DataFrame:
    """(a, b, score) for each row key (a, b) of ``rows`` (a, b, text), learned from a table with one text column."""
    blocks = text_blocks_of(rows)
    bytes_of = F.sum(F.octet_length("text"))
    size = (rows.agg(bytes_of).first()[0] or 0) + (training.agg(bytes_of).first()[0] or 0)
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    trees = max(least, size // TREE_BYTES + 1)
    cells = learned(cell_lists(training, depth, trees), depth)
    found = answers(cells, asked_lists(blocks, depth, trees), depth, trees)
    none = F.lit(None).cast("binary")
    whole = blocks.select("block", F.lit(-1).cast("bigint").alias("tree"), none.alias("logs"), "named", "sizes", "data")
    met = whole.unionByName(found.withColumns({name: none for name in ("named", "sizes", "data")}))
    # About a block each, however many there are.
    met = met.repartition(max(least, size // BLOCK_BYTES + 1), F.xxhash64("block")).sortWithinPartitions("block", "tree").select("block", "logs", "named", "sizes", "data")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, named, sizes, data), *parts in _groups(batches):
            text, offsets = _opened(sizes, data)
            keys, _ = distinct(keys_of(text, offsets, depth)[0])
            logs = np.empty(len(keys), np.float32)
            logs[by_tree(keys, depth, trees)[0]] = np.concatenate([unpacked(part[1], np.float32) for part in parts])
            sums = np.concatenate([text_sums(keys, logs, *piece, depth) for piece in runs_of(text, offsets, PIECE_BYTES)])
            own = np.frombuffer(named, np.int64).reshape(-1, 2)
            yield _rows({"a": (own[:, 0], pa.int64()), "b": (own[:, 1], pa.int64()), "score": (sums, pa.float64())})

    return met.mapInArrow(total, "a bigint, b bigint, score double").groupBy("a", "b").agg(F.first("score").alias("score"))
