"""Approximate nearest neighbours by cross-polytope hashing.

In each table, a unit vector is turned by two fast pseudo-rotations (random signs and a Hadamard transform, three times
each) and assigned to the nearest signed axis of the first and to that of the first few axes of the second. A query
probes the buckets whose axes lie nearest to it in every table. Candidates are compared exactly, in double precision.

Equal vectors are indexed once, with their least ids, so copies of one vector don't fill a bucket. Buckets are cut into
packets of bounded size that meet the packets of the probing queries; each meeting returns a few best per query. A query
with fewer results than asked for is compared with all vectors, in the same packets.

Vectors that are NULL or zero, or hold a NULL, NaN or infinity, and rows with a NULL id take no part. Repeated rows count
once. Vectors of different lengths are never compared. Ties go to the smaller id. Only the id and vector columns are
read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chargelake.llm.common import row_key
from chargelake.staging import fits_broadcast, staged

INDEX_PACKET = 256
QUERY_PACKET = 64


@dataclass(frozen=True)
class Hashing:
    """More ``axes`` in the second part make buckets smaller; more probes and tables raise recall."""

    tables: int = 10
    axes: int = 4
    probes: int = 64
    seed: int = 20240611


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of each row; the width is a power of two."""
    width, step = rows.shape[1], 1
    while step < width:
        pairs = rows.reshape(len(rows), -1, 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), width)
        step *= 2
    return rows / np.sqrt(width)


@cache
def _signs(hashing: Hashing, width: int) -> np.ndarray:
    random = np.random.default_rng((hashing.seed, width))
    return random.choice([-1.0, 1.0], (hashing.tables, 2, 3, width))


def _sides(rotated: np.ndarray) -> np.ndarray:
    """Nearness to each axis, positive and negative side."""
    return np.stack([rotated, -rotated], axis=2).reshape(len(rotated), -1)


def bucket_scores(vectors: np.ndarray, hashing: Hashing, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearness to the signed axes of both parts."""
    width = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    padded = np.zeros((len(vectors), width))
    padded[:, : vectors.shape[1]] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    parts = []
    for signs in _signs(hashing, width)[table]:
        turned = padded
        for sign in signs:
            turned = hadamard(turned * sign)
        parts.append(turned)
    return _sides(parts[0]), _sides(parts[1][:, : min(hashing.axes, width)])


def node_of(dims: int, table: int, bucket: np.ndarray) -> np.ndarray:
    return ((np.int64(dims) << 40) + (np.int64(table) << 32) + bucket).astype(np.int64)


def index_nodes(vectors: np.ndarray, hashing: Hashing) -> np.ndarray:
    """The bucket of each vector in each table."""
    nodes = []
    for table in range(hashing.tables):
        first, second = bucket_scores(vectors, hashing, table)
        nodes.append(node_of(vectors.shape[1], table, first.argmax(axis=1) * second.shape[1] + second.argmax(axis=1)))
    return np.stack(nodes, axis=1)


def probe_nodes(vectors: np.ndarray, hashing: Hashing) -> np.ndarray:
    """The nearest buckets of each query in each table: those that lose least against the best axes."""
    nodes = []
    for table in range(hashing.tables):
        first, second = bucket_scores(vectors, hashing, table)
        lost = (first.max(axis=1, keepdims=True) - first)[:, :, None] ** 2 + ((second.max(axis=1, keepdims=True) - second) ** 2)[:, None, :]
        lost = lost.reshape(len(vectors), -1)
        probes = min(hashing.probes, lost.shape[1])
        nearest = np.argpartition(lost, probes - 1, axis=1)[:, :probes]
        nodes.append(node_of(vectors.shape[1], table, nearest))
    return np.concatenate(nodes, axis=1)


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def with_nodes(rows: DataFrame, hashing: Hashing, probing: bool) -> DataFrame:
    """One row per bucket of each row of (name..., vector)."""
    hashed = probe_nodes if probing else index_nodes
    names = rows.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(x) for x in batch.column("vector")])
            for length in np.unique(lengths):
                own = batch.filter(pa.array(lengths == length))
                nodes = hashed(matrix(own.column("vector")), hashing)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(nodes.tolist(), pa.list_(pa.int64()))], names=[*names, "nodes"])

    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema)
    return rows.mapInArrow(add, f"{kinds}, nodes array<bigint>").select(*names, F.explode("nodes").alias("node"))


def packets(rows: DataFrame, name: str, size: int, key: str) -> DataFrame:
    """(node, name): the rows of each node in lists of about ``size``."""
    counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows"))
    counts = staged(counts, "buckets")
    cut = rows.join(F.broadcast(counts) if fits_broadcast(counts) else counts, "node")
    cut = cut.withColumn("slot", F.pmod(F.xxhash64(key), F.ceil(F.col("rows") / size)))
    return cut.groupBy("node", "slot").agg(F.collect_list(F.struct(key, "vector")).alias(name)).drop("slot")


def best_candidates(entries: DataFrame, probes: DataFrame, keep: int) -> DataFrame:
    """(key, ids, score): the ``keep`` best candidates of each query and task, by cosine."""
    met = packets(probes, "queries", QUERY_PACKET, "key").join(packets(entries, "candidates", INDEX_PACKET, "ids"), "node")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                yield combined([meet(*row) for row in zip(*batch.slice(at, 200).columns, strict=True)])

    def meet(queries: pa.ListScalar, candidates: pa.ListScalar) -> tuple:
        left, right = queries.values, candidates.values
        a, b = matrix(left.field("vector")), matrix(right.field("vector"))
        scores = np.einsum("id,jd->ij", a, b)
        scores /= np.sqrt(np.einsum("id,id->i", a, a))[:, None] * np.sqrt(np.einsum("jd,jd->j", b, b))[None, :]
        least = right.field("ids").flatten().to_numpy()[np.concatenate([[0], np.cumsum([len(x) for x in right.field("ids")])[:-1]])]
        n = min(keep, len(right))
        top = np.lexsort((np.broadcast_to(least, scores.shape), -scores), axis=1)[:, :n]
        rows, top = np.repeat(np.arange(len(left)), n), top.ravel()
        vector = np.array([hash(row.tobytes()) for row in b])[top]  # tells candidates of one batch apart
        return left.field("key").take(pa.array(rows)), right.field("ids").take(pa.array(top)), scores[rows, top], least[top], vector

    def combined(parts: list[tuple]) -> pa.RecordBatch:
        keys, ids = pa.concat_arrays([p[0] for p in parts]), pa.concat_arrays([p[1] for p in parts])
        scores, least, vector = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
        code = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        order = np.lexsort((vector, code))
        fresh = np.concatenate([[True], (code[order][1:] != code[order][:-1]) | (vector[order][1:] != vector[order][:-1])])[: len(order)]
        order = order[fresh]
        order = order[np.lexsort((least[order], -scores[order], code[order]))]
        first = np.flatnonzero(np.concatenate([[True], code[order][1:] != code[order][:-1]])[: len(order)])
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        at = pa.array(order[place < keep])
        return pa.RecordBatch.from_arrays([keys.take(at), ids.take(at), pa.array(scores).take(at)], names=["key", "ids", "score"])

    found = met.select("queries", "candidates").mapInArrow(best, "key string, ids array<bigint>, score double")
    return found.groupBy("key", "ids").agg(F.max("score").alias("score"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def first_rows(rows: DataFrame, by: str, order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("rank") <= n)


def nearest(
    vectors: DataFrame, queries: Column, count: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", hashing: Hashing = Hashing(),
) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row for which ``queries`` holds, the nearest found among all others."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    keyed = row_key(F.col("vector"))
    rows = rows.withColumn("key", F.concat_ws("-", F.hex(keyed["a"]), F.hex(keyed["b"])))
    unique = staged(rows.groupBy("key", "vector", "id").agg(F.max("asks").alias("asks")), "vectors")

    # One more than asked for, as a query is not its own neighbour.
    least = first_rows(unique.select("key", "id"), "key", [F.col("id")], count + 1)
    least = least.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    shapes = unique.groupBy("key").agg(F.first("vector").alias("vector"), F.max("asks").alias("asks"))
    classes = staged(shapes.join(least, "key"), "classes")
    asked = unique.filter("asks").select("id", "key")

    def ranked(found: DataFrame) -> DataFrame:
        apart = found.select("key", F.explode("ids").alias("vec_id"), "score").groupBy("key", "vec_id").agg(F.max("score").alias("score"))
        top = first_rows(apart, "key", [F.desc("score"), F.col("vec_id")], count + 1).drop("rank")
        mine = asked.join(top, "key").filter("id <> vec_id").withColumn("query", F.concat_ws("-", "key", "id"))
        return staged(first_rows(mine, "query", [F.desc("score"), F.col("vec_id")], count), "ranked")

    entries = with_nodes(classes.select("ids", "vector"), hashing, probing=False)
    probes = with_nodes(classes.filter("asks").select("key", "vector"), hashing, probing=True)
    found = ranked(best_candidates(entries, probes, count + 1))
    full = found.filter(F.col("rank") == count).select("query")
    short = asked.withColumn("query", F.concat_ws("-", "key", "id")).join(full, "query", "left_anti")
    if not short.isEmpty():
        short = staged(short, "short")
        everything = classes.select("ids", "vector", F.size("vector").cast("bigint").alias("node"))
        again = classes.join(short.select("key").distinct(), "key", "left_semi").select("key", "vector", F.size("vector").cast("bigint").alias("node"))
        exact = ranked(best_candidates(everything, again, count + 1)).join(short.select("query"), "query", "left_semi")
        found = found.join(short.select("query"), "query", "left_anti").unionByName(exact)
    return found.select(F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
