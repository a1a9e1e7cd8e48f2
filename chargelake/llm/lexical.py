"""Ranked lexical search without random access (NRA) over impact-sorted lists.

Terms are runs of 0-9, A-Z, a-z and any non-ASCII byte, with A-Z folded. The index is a table of segments: each holds
the lists of some megabytes of documents, one list per term, sorted by how much the term can add to a document's
score. A task goes through its segments and, for each query, reads the lists of its terms from the top in steps. A
document's lower bound is what was read of it; its upper bound adds the last value read of each list in which it has
not been met. Reading goes on until each document that could still reach the k-th best lower bound, ties included, has
equal bounds, so members, order and scores are final. The k-th best score found so far in the task's segments is the
threshold that later ones start with. The best of all tasks are merged.

A term's weight depends on its document frequency, which is summed over the segments when a query asks for it, so the
index serves any queries. Queries are taken in blocks of bounded size, which are broadcast.

NULL and empty texts, and those without a term, are no documents and match nothing; a query without terms has no
results. Rows with equal text and id count as documents of their own, and each row of the queries is a query of its own.
Equal scores go to the smaller id, NULL last. Long texts are counted in pieces. An empty table has no results. Only id and
text columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F, types as T

from chargelake.llm.blocks import text_blocks
from chargelake.staging import LONG_ROWS, staged

SEGMENT_BYTES = 4 << 20  # text of one segment, or one longer text
PIECE_BYTES = 1 << 20
QUERY_BYTES = 4 << 20  # text of one block of queries
BATCH_BYTES = 16 << 20  # what a task hands to Python at once; a row of the index has some megabytes
FIRST_READ = 32  # list entries read before the bounds are looked at first; doubled each time

# Fixed values of the ranking, in whole numbers: length share in percent, scale, and the two factors of the saturation.
LENGTH_SHARE = 75
SCALE = 1_000_000_000
TF_FACTOR, LENGTH_FACTOR = 1000, 8

_FOLD = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80 else 0x20
    for byte in range(256)
)


def small_batches(spark: SparkSession) -> None:
    """Have a session hand at most ``BATCH_BYTES``, or one longer row, to Python at once; a lesser limit stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


@dataclass(frozen=True)
class Index:
    """Segments of (ids, terms, sizes, docs, parts), the number of documents and of their terms with repeats."""

    segments: DataFrame
    documents: int
    terms: int


def term_counts(text: bytes) -> Counter[bytes]:
    folded, counts, begin = text.translate(_FOLD), Counter(), 0
    while begin < len(folded):
        end = folded.find(b" ", begin + PIECE_BYTES) if len(folded) - begin > PIECE_BYTES else -1
        end = len(folded) if end < 0 else end
        counts.update(folded[begin:end].split())
        begin = end
    return counts


def totals(texts: DataFrame) -> tuple[int, int]:
    """Number of texts with a term, and of all terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for batch in batches:
            for _, data, offsets in text_blocks(batch.column(0), PIECE_BYTES):
                inside = np.frombuffer(_FOLD, np.uint8)[data] != 0x20
                starts = inside.copy()
                starts[1:] &= ~inside[:-1]
                heads = offsets[:-1][offsets[:-1] < len(data)]
                starts[heads] = inside[heads]
                before = np.concatenate([[0], np.cumsum(starts)])[offsets]
                documents += int((np.diff(before) > 0).sum())
                terms += int(before[-1])
        yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([terms])], names=["documents", "terms"])

    summed = texts.mapInArrow(count, "documents bigint, terms bigint").agg(F.sum("documents"), F.sum("terms")).first()
    return summed[0] or 0, summed[1] or 0


def length_penalty(length: int, documents: int, terms: int) -> int:
    return 100 - LENGTH_SHARE + LENGTH_SHARE * length * documents // terms


def _segment(ids: list, data: np.ndarray, offsets: np.ndarray, documents: int, terms: int) -> tuple | None:
    """One segment's columns: ids in order; terms and the sizes of their lists; place of the document and value by list."""
    ordered = sorted(range(len(ids)), key=lambda row: (ids[row] is None, ids[row] if ids[row] is not None else 0))
    number: dict[bytes, int] = {}
    kept, penalties, sizes, listed, counted = [], [], [], [], []
    for row in ordered:
        counts = term_counts(data[offsets[row] : offsets[row + 1]].tobytes())
        if not counts:
            continue
        kept.append(ids[row])
        penalties.append(length_penalty(counts.total(), documents, terms))
        sizes.append(len(counts))
        listed.append(np.fromiter((number.setdefault(term, len(number)) for term in counts), np.int32, len(counts)))
        counted.append(np.fromiter(counts.values(), np.int64, len(counts)))
    if not kept:
        return None
    term, often = np.concatenate(listed), np.concatenate(counted)
    doc = np.repeat(np.arange(len(kept), dtype=np.int32), sizes)
    part = SCALE * often // (TF_FACTOR * often + LENGTH_FACTOR * np.array(penalties, np.int64)[doc])
    order = np.lexsort((doc, -part, term))
    lengths = np.bincount(term, minlength=len(number)).astype(np.int32)
    names = [name.decode("utf-8", "replace") for name in number]
    return kept, names, lengths, doc[order].tobytes(), part[order].astype(np.int32).tobytes()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> Index:
    """Index all documents, each whole; written once and read by every search."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    documents, terms = totals(rows.select("text"))
    id_type = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("terms", T.ArrayType(T.StringType())),
        T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("docs", T.BinaryType()), T.StructField("parts", T.BinaryType()),
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = pa.list_(batch.schema.field(0).type)
            for first, data, offsets in text_blocks(batch.column(1), segment_bytes):
                ids = batch.column(0).slice(first, len(offsets) - 1).to_pylist()
                made = _segment(ids, data, offsets, documents, terms)
                if made is not None:
                    types = (kind, pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(made, types, strict=True)], names=schema.names)

    return Index(staged(rows.mapInArrow(build, schema), "postings", **LONG_ROWS), documents, terms)


def document_frequencies(index: Index, terms: Sequence[str]) -> dict[str, int]:
    """How many documents hold each of the terms; terms that none holds are left out."""
    spark = index.segments.sparkSession
    asked = spark.createDataFrame([(term,) for term in terms], "term string")
    listed = index.segments.select(F.explode(F.arrays_zip("terms", "sizes")).alias("list")).select("list.terms", "list.sizes")
    found = listed.join(F.broadcast(asked), F.col("terms") == F.col("term")).groupBy("term").agg(F.sum("sizes").alias("n"))
    return {row["term"]: row["n"] for row in found.collect()}  # at most the block's terms


def term_weight(frequency: int, documents: int) -> int:
    return int(np.floor(1000 * np.log((2 * documents + 2) / (2 * frequency + 1))))


def read_until_resolved(
    starts: np.ndarray, sizes: np.ndarray, weights: np.ndarray, docs: np.ndarray, parts: np.ndarray, count: int, k: int, least: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of one segment that belong to the k best and reach ``least``, all resolved.

    The query's lists begin at ``starts`` of ``docs`` and ``parts`` and have ``sizes`` entries. Each list is read in its
    order and each entry once; the bounds of a document come from these reads alone.
    """
    lower = np.zeros(count, np.int64)
    met_docs, met_list = np.zeros(0, np.int64), np.zeros(0, np.int64)
    read, step = 0, FIRST_READ
    while True:
        upto = np.minimum(sizes, read + step)
        fresh = np.maximum(upto - read, 0)
        of_list = np.repeat(np.arange(len(sizes)), fresh)
        place = np.arange(len(of_list)) - np.repeat(np.cumsum(fresh) - fresh, fresh) + (starts + read)[of_list]
        new_docs = docs[place]
        np.add.at(lower, new_docs, parts[place] * weights[of_list])
        met_docs, met_list = np.concatenate([met_docs, new_docs]), np.concatenate([met_list, of_list])
        read, step = read + step, step * 2
        last = np.where(read < sizes, parts[starts + np.minimum(read, sizes) - 1] * weights, 0)
        missing = last.sum() - np.bincount(met_docs, last[met_list], count).astype(np.int64)
        bar = max(least, 1)
        if count >= k:
            bar = max(bar, int(np.partition(lower, count - k)[count - k]))
        could = lower + missing >= bar
        if not missing[could].any():
            found = np.flatnonzero(could)
            best = found[np.lexsort((found, -lower[found]))][:k]
            return best, lower[best]


def _best(held: list[tuple], new: list[tuple], k: int) -> list[tuple]:
    return sorted(held + new, key=lambda pair: (-pair[0], pair[1] is None, pair[1] if pair[1] is not None else 0))[:k]


def _search_block(index: Index, texts: Sequence[str | None], k: int) -> DataFrame:
    """(query, id, score): the k best of each task for each of the texts, by place."""
    asked = [term_counts((text or "").encode()) for text in texts]
    vocabulary = sorted({term.decode() for counts in asked for term in counts})
    frequency = document_frequencies(index, vocabulary)
    known = [term for term in vocabulary if term in frequency]
    number = {term.encode(): place for place, term in enumerate(known)}
    weight = np.array([term_weight(frequency[term], index.documents) for term in known], np.int64)
    queries = []
    for counts in asked:
        places = np.array([number[term] for term in counts if term in number], np.int64)
        times = np.array([times for term, times in counts.items() if term in number], np.int64)
        worth = weight[places] * times if len(places) else times
        queries.append((places[worth > 0], worth[worth > 0]))
    shared = index.segments.sparkSession.sparkContext.broadcast((known, queries))
    id_type = index.segments.schema["ids"].dataType.elementType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, queries = shared.value
        known = pa.array(known, pa.string())
        best: dict[int, list[tuple]] = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type.value_type
            for row in range(batch.num_rows):
                ids, terms, sizes = (batch.column(i)[row].values for i in range(3))
                docs, parts = (np.frombuffer(batch.column(i)[row].as_py(), np.int32).astype(np.int64) for i in (3, 4))
                sizes = sizes.to_numpy().astype(np.int64)
                starts = np.cumsum(sizes) - sizes
                at = pc.fill_null(pc.index_in(known, value_set=terms), -1).to_numpy()
                for query, (places, worth) in enumerate(queries):
                    lists = at[places]
                    here = lists >= 0
                    lists, worths = lists[here], worth[here]
                    held = best.get(query, [])
                    least = held[-1][0] if len(held) == k else 1
                    if not len(lists) or (parts[starts[lists]] * worths).sum() < least:
                        continue
                    found, scores = read_until_resolved(starts[lists], sizes[lists], worths, docs, parts, len(ids), k, least)
                    if len(found):
                        new = [(score, ids[place].as_py()) for place, score in zip(found.tolist(), scores.tolist())]
                        best[query] = _best(held, new, k)
        if best:
            rows = [(query, doc, score) for query, pairs in best.items() for score, doc in pairs]
            numbers, found, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(found, kind), pa.array(scores, pa.int64())], names=["query", "id", "score"])

    schema = T.StructType([
        T.StructField("query", T.IntegerType()), T.StructField("id", id_type), T.StructField("score", T.LongType())])
    return index.segments.mapInArrow(search, schema)


def _blocks(queries: DataFrame, limit: int) -> Iterator[list[Row]]:
    block, size = [], 0
    for row in queries.toLocalIterator():
        length = len((row["text"] or "").encode()) + 64
        if block and size + length > limit:
            yield block
            block, size = [], 0
        block.append(row)
        size += length
    if block:
        yield block


def search(
    index: Index, queries: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(id of the query, rank, doc_id, score): the k best documents of each query with a score above 0."""
    spark = index.segments.sparkSession
    asked = queries.select(F.col(id_col).alias("asked"), F.col(text_col).cast("string").alias("text"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("asked", asked.schema["asked"].dataType)])
    results = []
    for block in _blocks(asked, query_bytes):
        ranked = _search_block(index, [row["text"] for row in block], k).withColumn("rank", F.row_number().over(order))
        names = spark.createDataFrame([(place, row["asked"]) for place, row in enumerate(block)], schema)
        named = ranked.filter(F.col("rank") <= k).join(F.broadcast(names), "query")
        results.append(named.select(F.col("asked").alias(id_col), "rank", F.col("id").alias("doc_id"), "score"))
    if not results:
        id_type = index.segments.schema["ids"].dataType.elementType
        return asked.limit(0).select(
            F.col("asked").alias(id_col), F.lit(0).alias("rank"), F.lit(None).cast(id_type).alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    if len(results) > 1:
        results = [staged(result, "found") for result in results]
    whole = results[0]
    for result in results[1:]:
        whole = whole.unionAll(result)
    return whole
