"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every other character counts as a blank. The n-grams of a text are hashed into a fixed number
of buckets; per language, their counts with add-one smoothing give log probabilities. The matrix (buckets x languages)
is broadcast, and batches of texts are scored as sparse count matrices in numpy.

A NULL text, and one without letters, is ``und`` with score 0, and so is every text when there was nothing to learn
from. Ties go to the language that comes first in order. Rows stay as many as they are; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from chargelake.llm.blocks import text_blocks

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
MODEL_BYTES = 128 << 20
BLOCK_BYTES = 1 << 20  # a block's n-grams take about a hundred times as much while they are counted
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    prior: np.ndarray
    log_probability: np.ndarray  # buckets x languages


@cache
def _folded() -> np.ndarray:
    """Each code point's lower-case letter, or a blank."""
    lower = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            lower[code] = ord(char.lower()[0])
    return lower


def ngram_counts(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) triplets of a block's n-grams, and whether each row has a letter."""
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    codes = _folded()[codes]
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(starts))
    lettered = np.bincount(rows, codes != 32, len(offsets) - 1) > 0
    keys = []
    for order in ORDERS:
        if len(codes) < order:
            continue
        hashed = np.full(len(codes) - order + 1, order, np.uint32)
        for place in range(order):
            hashed = (hashed ^ codes[place : len(codes) - order + 1 + place]) * np.uint32(0x9E3779B1)
            hashed ^= hashed >> np.uint32(15)
        whole = rows[: len(hashed)] == rows[order - 1 :]
        keys.append(rows[: len(hashed)][whole] * buckets + hashed[whole] % np.uint32(buckets))
    pairs = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    return pairs[at] // buckets, pairs[at] % buckets, np.diff(np.append(at, len(pairs))), lettered


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS) -> Model:
    """A model of all rows with a label. Its size depends on buckets and languages only, and is checked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            for first, data, offsets in text_blocks(batch.column(0), BLOCK_BYTES):
                row, bucket, n, lettered = ngram_counts(data, offsets, buckets)
                own = names[first : first + len(lettered)]
                for name in set(own):
                    mine = own == name
                    sums = held.setdefault(name, np.zeros(buckets + 1, np.int64))
                    chosen = mine[row]
                    sums[:-1] += np.bincount(bucket[chosen], n[chosen], buckets).astype(np.int64)
                    sums[-1] += int(mine.sum())
        for name, sums in held.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(sums[at])], names=["lang", "bucket", "n"])

    known = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = known.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = sorted(row["lang"] for row in known.select("lang").distinct().limit(MODEL_BYTES // (4 * buckets) + 1).collect())
    if len(languages) * buckets * 4 > MODEL_BYTES:
        raise ValueError(f"more than {MODEL_BYTES // (4 * buckets)} languages do not fit the broadcast model")
    found = counts.toArrow()  # at most buckets x languages rows
    place = {name: i for i, name in enumerate(languages)}
    matrix = np.zeros((buckets + 1, len(languages)))
    column = np.array([place[name] for name in found.column("lang").to_pylist()], np.int64)
    matrix[found.column("bucket").to_numpy(), column] = found.column("n").to_numpy()
    grams, documents = matrix[:-1], matrix[-1]
    smoothed = np.log(grams + 1) - np.log(grams.sum(axis=0) + buckets)
    return Model(languages, np.log(np.maximum(documents, 1) / max(documents.sum(), 1)), smoothed.astype(np.float32))


def score_texts(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and its posterior probability for each text."""
    named, scores = [], []
    for _, data, offsets in text_blocks(texts, BLOCK_BYTES):
        row, bucket, n, lettered = ngram_counts(data, offsets, len(model.log_probability))
        if not model.languages:
            named += [UNKNOWN] * len(lettered)
            scores.append(np.zeros(len(lettered)))
            continue
        logs = np.stack([
            np.bincount(row, n * model.log_probability[bucket, i], len(lettered)) + model.prior[i]
            for i in range(len(model.languages))
        ], axis=1)
        best = logs.argmax(axis=1)
        odds = np.exp(logs - logs.max(axis=1, keepdims=True))
        named += [model.languages[i] if found else UNKNOWN for i, found in zip(best, lettered, strict=True)]
        scores.append(np.where(lettered, 1 / odds.sum(axis=1), 0.0))
    return named, np.concatenate(scores) if scores else np.zeros(0)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, scores = score_texts(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(named, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "lang_pred", "score"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    schema = T.StructType([rows.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(predict, schema)


def with_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose text has a known language, with all columns as they are.

    Where nothing could be learned, a letter in the text is enough.
    """
    if not model.languages:
        return docs.filter(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, _ = score_texts(batch.column(place).cast(pa.string()), shared.value)
            yield batch.filter(pa.array([name != UNKNOWN for name in named], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
