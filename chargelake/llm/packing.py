"""Best-fit packing of documents into sequences of several permitted lengths.

Each task packs the documents of its own partition, in chunks of bounded size. What a chunk leaves in bins that are not
nearly full is packed once more across partitions: only the pieces of these bins are sent, to as many tasks as they fill
chunks, and packed together there. Full bins stay where they are, so little is shuffled. A single chunk is final.

Pieces are placed longest first into the open bin with the least room that holds them. If there is none, the bin size is
opened that costs least per place it can still be filled with, counting the pieces yet to come. At the end every bin
shrinks to the least permitted size that holds its contents.

A document takes its length plus one place for its end mark; a longer one than the greatest size is cut into pieces.
NULL and empty texts take the end mark alone. Every row is placed, repeated ones each for itself; ties keep the order
of the rows. Only the id and text (or length) columns are read, so other columns may have any name.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from chargelake.staging import staged

SIZES = (2048, 4096, 8192, 16384, 32768)
SEQUENCE_COST = 64
CHUNK_PLACES = 1 << 25
CHUNK_ROWS = 200_000
SLICE_ROWS = 1000
NEARLY_FULL = 0.98
COLUMNS = ("id", "piece", "start", "length", "bin_id", "capacity", "position")


def linear_cost(size: int) -> float:
    """Places of a sequence, and what each sequence costs besides."""
    return size + SEQUENCE_COST


def cut(lengths: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, piece, start, length) of all pieces of rows with these lengths."""
    pieces = -(-lengths // largest)
    row = np.repeat(np.arange(len(lengths)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = piece * largest
    return row, piece, start, np.minimum(lengths[row] - start, largest)


def best_fit(
    lengths: np.ndarray, sizes: Sequence[int] = SIZES, cost: Callable[[int], float] = linear_cost,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, position) of each piece, and the size of each bin. No piece may be longer than the greatest size."""
    sizes = sorted(sizes)
    order = np.argsort(-lengths, kind="stable")
    falling = lengths[order]
    to_come = np.concatenate([np.cumsum(falling[::-1])[::-1], [0]])
    negative = -falling
    bins, positions = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: list[int] = []
    opened: list[int] = []
    room: list[tuple[int, int]] = []
    for at, piece in enumerate(order.tolist()):
        length = int(falling[at])
        fit = bisect_left(room, (length, -1))
        if fit < len(room):
            left, own = room.pop(fit)
        else:
            def per_place(size: int, at: int = at, length: int = length) -> float:
                free = size - length
                later = max(at + 1, int(np.searchsorted(negative, -free, side="left")))
                return cost(size) / (length + min(free, int(to_come[later])))

            left = min((s for s in sizes if s >= length), key=per_place)
            own = len(used)
            used.append(0)
            opened.append(left)
        bins[piece], positions[piece] = own, used[own]
        used[own] += length
        if left > length:
            insort(room, (left - length, own))
    return bins, positions, np.array([sizes[bisect_left(sizes, n)] for n in used], np.int64)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a partition in tables that hold a bounded number of rows and, but for one slice, of places."""
    held, places = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            held.append(part)
            places += int(part.column("length").to_numpy().sum())
            if places >= CHUNK_PLACES or SLICE_ROWS * len(held) >= CHUNK_ROWS:
                yield pa.Table.from_batches(held)
                held, places = [], 0
    if held:
        yield pa.Table.from_batches(held)


def pack_chunk(
    ids: pa.Array, piece: np.ndarray, start: np.ndarray, lengths: np.ndarray, first_bin: int, sizes: Sequence[int], cost: Callable[[int], float],
) -> pa.RecordBatch:
    """The pieces of one chunk in bins numbered from ``first_bin``, which also names the chunk."""
    bins, positions, capacities = best_fit(lengths, sizes, cost)
    used = np.bincount(bins, lengths, len(capacities)).astype(np.int64)
    columns = (piece, start, lengths, bins + first_bin, capacities[bins], positions, used[bins], np.full(len(bins), first_bin))
    return pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], names=[*COLUMNS, "used", "chunk"])


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None,
    sizes: Sequence[int] = SIZES, cost: Callable[[int], float] = linear_cost,
) -> DataFrame:
    """Where each piece of each row lies: (id, piece, start, length, bin_id, capacity, position).

    Lengths are code points of the text unless ``length`` gives them, such as a column of token counts.
    """
    own = F.length(F.col(text_col)) if length is None else length
    rows = docs.select(F.col(id_col).alias("id"), (F.coalesce(own, F.lit(0)).cast("bigint") + 1).alias("length"))
    numbers = ", ".join(f"{name} bigint" for name in (*COLUMNS[1:], "used", "chunk"))
    schema = f"id {rows.schema[0].dataType.simpleString()}, {numbers}"

    def cut_and_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_bin = TaskContext.get().partitionId() << 33
        for chunk in chunks(batches):
            row, piece, start, lengths = cut(chunk.column("length").to_numpy(), max(sizes))
            ids = chunk.column("id").take(pa.array(row)).combine_chunks()
            yield (done := pack_chunk(ids, piece, start, lengths, next_bin, sizes, cost))
            next_bin = int(done.column("bin_id").to_numpy().max()) + 1

    first = staged(rows.mapInArrow(cut_and_place, schema), "packed")
    loose = F.col("used") < NEARLY_FULL * F.col("capacity")
    found = first.agg(
        F.count_distinct(F.when(loose, F.col("chunk"))).alias("chunks"), F.max("bin_id").alias("last"),
        F.sum(F.when(loose, F.col("length"))).alias("places"), F.count_if(loose).alias("rows")).first()
    names = [F.col("id").alias(id_col), *COLUMNS[1:]]
    if found["chunks"] < 2:
        return first.select(*names)
    tasks = max(-(-found["places"] // CHUNK_PLACES), -(-found["rows"] // CHUNK_ROWS))
    base = (found["last"] >> 33) + 1

    def place_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_bin = (TaskContext.get().partitionId() + base) << 33
        for chunk in chunks(batches):
            pieces = (chunk.column(name).to_numpy() for name in ("piece", "start", "length"))
            yield (done := pack_chunk(chunk.column("id").combine_chunks(), *pieces, next_bin, sizes, cost))
            next_bin = int(done.column("bin_id").to_numpy().max()) + 1

    sent = first.filter(loose).select("id", "piece", "start", "length", "bin_id").repartition(tasks, F.xxhash64("bin_id"))
    again = staged(sent.sortWithinPartitions("bin_id", "id", "piece").mapInArrow(place_again, schema), "packed_again")
    return first.filter(~loose).unionAll(again).select(*names)


def sequences(docs: DataFrame, placed: DataFrame, id_col: str = "doc_id", text_col: str = "text", end: str = "\x03") -> DataFrame:
    """(bin_id, capacity, ids, text): the contents of each bin, each document closed by ``end``. Ids must be unique.

    A bin is bounded by the greatest permitted length, and with it what one group gathers.
    """
    texts = docs.select(F.col(id_col), F.concat(F.coalesce(F.col(text_col), F.lit("")), F.lit(end)).alias("whole"))
    part = F.substring(F.col("whole"), (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    parts = placed.join(texts, id_col).select("bin_id", "capacity", F.struct("position", F.col(id_col).alias("id"), part.alias("part")).alias("p"))
    bins = parts.groupBy("bin_id", "capacity").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return bins.select("bin_id", "capacity", F.col("p.id").alias("ids"), F.array_join("p.part", "").alias("text"))
