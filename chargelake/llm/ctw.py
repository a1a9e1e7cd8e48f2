"""Language-model scores by context-tree weighting over bytes.

Every byte is split into eight binary decisions. For each of the 255 places in that tree of decisions, a context tree
over the three bytes before mixes Krichevsky-Trofimov estimates of all depths, weighted by how well each depth predicts
the whole training corpus. Bytes before the byte to code are told apart in 64 classes (letters without case, digits,
white space, marks, and the lead and continuation bytes of UTF-8), so there are at most 2^18 contexts at the greatest
depth and the model has a bound whatever the corpus: one row of 256 log probabilities per context seen, 256 MB if all
are. Counting, weighting and scoring run in tasks; only the finished rows pass through the driver, to be broadcast.

A text ends with a mark, the byte 0xFF that UTF-8 never holds, so texts of all lengths have a proper probability. NULL
and empty texts are the end mark alone. Without training texts every decision has probability 1/2. Rows stay as many as
they are, and repeated rows get equal results. Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log, log10, pi

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from chargelake.llm.blocks import buffer_of, text_blocks
from chargelake.llm.common import row_key
from chargelake.staging import staged

END = 0xFF
DEPTH = 3
HOT_TOKENS = 1 << 17
HOT_BYTES = 64
HELD_TOKENS = 200_000


def byte_classes() -> np.ndarray:
    """The class of each byte as context, below 64. Class 0 is what lies before a text."""
    classes = np.full(256, 32, np.int64)  # other marks
    for byte in range(256):
        char = chr(byte)
        if byte < 0x80 and char.isalpha():
            classes[byte] = 1 + ord(char.lower()) - ord("a")
        elif byte < 0x80 and char.isdigit():
            classes[byte] = 27
        elif 0x80 <= byte < 0xC0:
            classes[byte] = 33 + byte % 16
        elif 0xC0 <= byte < 0xFF:
            classes[byte] = 49 + (byte - 0xC0) // 4 if byte < 0xE0 else 57 + (byte - 0xE0) // 4 if byte < 0xF0 else 61
    classes[:32], classes[ord(" ")], classes[ord(".")], classes[ord(",")] = 29, 28, 30, 31
    classes[END] = 0
    return classes


_CLASSES = byte_classes()


def coded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block's keys (context << 8 | byte), one per byte and end mark, and where each text's keys begin."""
    padded = np.insert(data, np.repeat(offsets[1:], DEPTH), END)
    padded = np.concatenate([np.full(DEPTH, END, np.uint8), padded])
    before = _CLASSES[padded]
    keys = (before[2:-1] << 20) + (before[1:-2] << 14) + (before[:-3] << 8) + padded[3:]
    starts = offsets[:-1] + np.arange(len(offsets) - 1) * DEPTH
    coded_too = np.ones(len(keys), bool)  # the first end mark of each text is coded, the others are padding
    for extra in range(1, DEPTH):
        coded_too[offsets[1:] + np.arange(len(offsets) - 1) * DEPTH + extra] = False
    return keys[coded_too], starts - np.arange(len(offsets) - 1) * (DEPTH - 1)


def context_counts(texts: DataFrame) -> DataFrame:
    """(key, n) over all rows of a table with one text column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_blocks(batch.column(0)):
                keys = np.sort(coded(data, offsets)[0].astype(np.int32))
                at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(np.diff(np.append(at, len(keys))))], names=["key", "n"])

    return texts.mapInArrow(count, "key int, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x > 0, by Stirling's series above 8."""
    shift = np.zeros_like(x)
    x = x.copy()
    while (low := x < 8).any():
        shift[low] += np.log(x[low])
        x[low] += 1
    inverse = 1 / x
    series = inverse * (1 / 12 - inverse**2 * (1 / 360 - inverse**2 * (1 / 1260 - inverse**2 / 1680)))
    return (x - 0.5) * np.log(x) - x + 0.5 * log(2 * pi) + series - shift


def decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at each of the 255 decisions (heap order, place 0 unused), from byte counts per row."""
    zeros, ones = np.zeros((len(counts), 256)), np.zeros((len(counts), 256))
    below = counts
    for level in range(7, -1, -1):
        pairs = below.reshape(len(counts), -1, 2)
        zeros[:, 1 << level : 2 << level], ones[:, 1 << level : 2 << level] = pairs[:, :, 0], pairs[:, :, 1]
        below = pairs.sum(axis=2)
    return zeros, ones


def estimate(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of all decisions of a context, and of a further one being 1, both by Krichevsky-Trofimov."""
    zeros, ones = decisions(counts)
    whole = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - log(pi)
    return whole, (ones + 0.5) / (zeros + ones + 1)


def mix(counts: np.ndarray, of_children: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts with children: weighted log probability, the estimate of a 1, and the weight of that estimate."""
    whole, one = estimate(counts)
    weighted = np.logaddexp(whole, of_children) - log(2)
    return weighted, one, np.exp(whole - log(2) - weighted)


def sum_by(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    sums = np.zeros((n, values.shape[1]))
    np.add.at(sums, rows, values)
    return sums


def subtree(last: int, keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All contexts that end in one class: (codes, chance of 1 per decision mixed from depth 1 down, byte counts, log probability).

    Codes number contexts by depth: 1 + class for depth 1 and others not seen below it, then depth 2, then depth 3.
    """
    deep, at = np.unique(keys >> 8, return_inverse=True)
    counts = np.zeros((len(deep), 256))
    np.add.at(counts, (at, keys & 255), n)
    whole3, one3 = estimate(counts)
    middle, parent = np.unique(deep >> 6, return_inverse=True)
    counts2 = sum_by(parent, counts, len(middle))
    weighted2, one2, share2 = mix(counts2, sum_by(parent, whole3, len(middle)))
    counts1 = counts2.sum(axis=0, keepdims=True)
    weighted1, one1, share1 = mix(counts1, weighted2.sum(axis=0, keepdims=True))

    def upward(one_below: np.ndarray) -> np.ndarray:
        return share1 * one1 + (1 - share1) * one_below

    seen = share2[parent] * one2[parent] + (1 - share2[parent]) * one3
    unseen3 = share2 * one2 + (1 - share2) * 0.5
    chances = np.concatenate([upward(np.full((1, 256), 0.5)), upward(unseen3), upward(seen)])
    codes = np.concatenate([[1 + last], 65 + middle, 65 + 4096 + deep])
    return codes, chances, counts1[0], weighted1[0]


def byte_log10(chances: np.ndarray) -> np.ndarray:
    """log10 probability of each byte, from the chance of a 1 at each decision on its way."""
    logs = np.zeros((len(chances), 256))
    symbols = np.arange(256)
    for level in range(8):
        one = chances[:, (1 << level) | (symbols >> (8 - level))]
        logs += np.log10(np.where((symbols >> (7 - level)) & 1, one, 1 - one))
    return logs


@dataclass(frozen=True)
class Model:
    """Which row of log10 probabilities each context uses."""

    row_of: np.ndarray
    logs: np.ndarray

    def score(self, keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.logs[self.row_of[keys >> 8], keys & 255].astype(np.float64), starts) if len(starts) else np.zeros(0)


def learn(texts: DataFrame) -> Model:
    """The model of all rows of a table with one text column."""
    cells = staged(context_counts(texts), "contexts")

    def weigh(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["key"].to_numpy()
        codes, chances, counts, weighted = subtree(int(keys[0]) >> 20, keys, group["n"].to_numpy())
        rows = {"code": codes.astype(np.int32), "values": [row.astype(np.float64).tobytes() for row in chances]}
        total = np.concatenate([counts, weighted]).tobytes()  # what the root needs to know of this class
        return pd.concat([pd.DataFrame(rows), pd.DataFrame({"code": [-1], "values": [total]})])

    # A class has at most 2^12 contexts of 256 bytes each, and there are at most 64 classes.
    grouped = cells.withColumn("last", F.shiftright("key", 20)).groupBy("last").applyInPandas(weigh, "code int, values binary")
    weighed = staged(grouped, "weighed")
    totals = [np.frombuffer(row["values"]) for row in weighed.filter("code = -1").select("values").collect()]
    counts = sum((t[:256] for t in totals), np.zeros(256))
    of_classes = sum((t[256:] for t in totals), np.zeros(256))
    _, one, share = mix(counts[None, :], of_classes[None, :])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                chances = np.frombuffer(b"".join(part.column("values").to_pylist())).reshape(-1, 256)
                logs = byte_log10(share * one + (1 - share) * chances).astype(np.float32)
                yield pa.RecordBatch.from_arrays([part.column("code"), pa.array([row.tobytes() for row in logs], pa.binary())], names=["code", "logs"])

    found = weighed.filter("code >= 0").mapInArrow(finish, "code int, logs binary").toArrow()
    codes = found.column("code").to_numpy()
    order = np.argsort(codes)
    logs = np.empty((len(codes) + 1, 256), np.float32)
    logs[0] = byte_log10(share * one + (1 - share) * 0.5)[0]
    data, _ = buffer_of(found.column("logs").combine_chunks()) if len(codes) else (np.zeros(0, np.uint8), None)
    logs[1:] = data.view(np.float32).reshape(-1, 256)[order]
    row_of = np.zeros(1 << 18, np.int32)
    for row, code in enumerate(codes[order].tolist(), 1):  # deeper contexts come later and replace their parents' row
        if code < 65:
            row_of[(code - 1) << 12 : code << 12] = row
        elif code < 65 + 4096:
            row_of[(code - 65) << 6 : (code - 64) << 6] = row
        else:
            row_of[code - 65 - 4096] = row
    return Model(row_of, logs)


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n): words of the texts, split at ASCII white space after folding A-Z."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update((text.as_py() or "").encode("utf-8", "replace").lower().split())
                if len(held) > HELD_TOKENS:
                    yield rows(held)
                    held.clear()
        yield rows(held)

    def rows(held: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], names=["token", "n"])

    return texts.mapInArrow(count, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def frequent(words: DataFrame) -> DataFrame:
    """The most frequent words of bounded length: at most ``HOT_TOKENS``, by a least count read off a histogram."""
    short = words.filter(F.octet_length("token") <= HOT_BYTES).withColumn("size", F.floor(F.log2("n") * 8))
    held, least = 0, None
    for row in sorted(short.groupBy("size").count().collect(), reverse=True):  # at most 8 * 63 rows
        held += row["count"]
        if held > HOT_TOKENS:
            break
        least = row["size"]
    return short.filter(F.col("size") >= F.lit(least))


def score(
    docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_text_col: str = "text",
    depth: int | None = None,
) -> DataFrame:
    """(id, n_bytes, score, n_tokens, n_known, train_tokens, base_score) of every row of ``docs``.

    ``score`` is the context-tree model's log10 probability of the text with its end mark, ``base_score`` that of a
    smoothed unigram model of words. The most frequent words, a bounded table, are broadcast; the counts of all other
    words are looked up in a join, once per text and word. With ``depth``, contexts are that many true bytes, kept in a
    stored table (``deep_context``); without it the bounded model is broadcast.
    """
    from chargelake.llm.deep_context import tree_scores

    texts = training.select(F.coalesce(F.col(train_text_col).cast("string"), F.lit("")).alias("text"))
    model = None if depth else docs.sparkSession.sparkContext.broadcast(learn(texts))
    words = staged(token_counts(texts), "words")
    ends = texts.count()
    seen = words.agg(F.count(F.lit(1)).alias("kinds"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    total, kinds = seen["n"] + ends, seen["kinds"] + (ends > 0)
    below = log10(total + 0.5 * (kinds + 1))
    of_end = log10(ends + 0.5) - below
    hot = docs.sparkSession.sparkContext.broadcast(
        {row["token"].encode(): log10(row["n"] + 0.5) - below for row in frequent(words).toLocalIterator()})

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tree = hot.value, model and model.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            scores = [tree.score(*coded(data, offsets)) for _, data, offsets in text_blocks(batch.column(1))] if tree else [np.zeros(batch.num_rows)]
            sizes, tokens, found, base, rare, times = [], [], [], [], [], []
            for text in batch.column(1):
                data = (text.as_py() or "").encode("utf-8", "replace")
                own = Counter(data.lower().split())
                sizes.append(len(data)), tokens.append(own.total() + 1)
                part, count, others, repeats = of_end, int(ends > 0), [], []
                for word, n in own.items():
                    value = known.get(word)
                    if value is None:
                        others.append(word), repeats.append(n)
                    else:
                        part, count = part + n * value, count + n
                found.append(count), base.append(part), rare.append(others), times.append(repeats)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + batch.num_rows)), batch.column(0), batch.column(2), batch.column(3), pa.array(sizes, pa.int64()),
                 pa.array(np.concatenate(scores)), pa.array(tokens, pa.int64()), pa.array(found, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(rare, pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))],
                names=["row", "id", "a", "b", "n_bytes", "score", "n_tokens", "n_known", "base", "rare", "times"])
            row += batch.num_rows

    key = row_key(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), key["a"].alias("a"), key["b"].alias("b"))
    kind = rows.schema["id"].dataType.simpleString()
    measured = staged(rows.mapInArrow(
        measure, f"row bigint, id {kind}, a bigint, b bigint, n_bytes bigint, score double, n_tokens bigint, n_known bigint, base double, "
        "rare array<string>, times array<bigint>"), "measured")
    pairs = measured.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("token"), F.col("w.times").alias("times"))
    counted = pairs.join(words, "token", "left")
    sums = counted.groupBy("row").agg(
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 0.5) - below)).alias("rest"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"))
    joined = measured.drop("rare", "times").join(sums, "row", "left")
    if depth:
        joined = joined.drop("score").join(tree_scores(rows.drop("id"), texts, depth), ["a", "b"])
    return joined.select(
        F.col("id").alias(id_col), "n_bytes", "score", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"))
