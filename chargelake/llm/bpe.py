"""Byte-pair encoding of texts and its reverse, with the vocabulary file of a byte-level tokenizer.

A text is cut at special tokens, then into words by the file's word pattern. The bytes of a short word lie in one
contiguous array of parts with the rank of each adjacent pair beside it: the least rank is looked up by a scan, its
boundary deleted and the two neighbouring ranks refreshed, until no pair can merge. Long words keep the pairs in a heap
instead, with the same order of merges (least rank, then leftmost). Words met before are taken from a bounded memory.

NULL and empty texts have no tokens and decode to the empty text. Texts are read whole, however long; one word's parts
are in memory at a time. Repeated rows get equal results, one each; an empty table gives an empty one. Only id and text
column are read, so other columns may have any name, and an id may be NULL. Ids that the vocabulary lacks decode to
nothing; bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Fixed value: the word pattern of byte-level tokenizers of this kind.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_RANK = 1 << 62
SHORT_WORD = 128  # bytes; a longer word is merged through a heap
KEPT_WORDS = 1 << 18  # words whose ids a task remembers, each of at most SHORT_WORD bytes
FILE_BYTES = 64 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the file: itself where printable, else 256 and up in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


class Words(dict):
    """Packed ids of words, worked out when first asked for."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> bytes:
        data = word.encode("utf-8", "replace")
        packed = np.array(self.tokenizer.merged(data), "<u4").tobytes()
        if len(data) <= SHORT_WORD:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = packed
        return packed


class Tokenizer:
    """A vocabulary with its merges. Only plain byte-level files are taken; others raise an error."""

    def __init__(self, source: bytes) -> None:
        found = json.loads(source)
        model, before = found["model"], found.get("pre_tokenizer") or {}
        added = found.get("added_tokens") or []
        plain = (
            model.get("type", "BPE") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and found.get("normalizer") is None
            and not any(model.get(name) for name in (
                "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not any(token.get(name) for token in added for name in ("lstrip", "rstrip", "single_word"))
        )
        if not plain:
            raise ValueError("not a plain byte-level BPE vocabulary")
        letters = byte_letters()
        vocabulary: dict[str, int] = model["vocab"]
        self.first = [0] * 256
        for letter, byte in letters.items():
            self.first[byte] = vocabulary[letter]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocabulary[left], vocabulary[right]] = rank, vocabulary[left + right]
        self.specials = {token["content"]: token["id"] for token in added}
        contents = {number: token for token, number in vocabulary.items()} | {number: token for token, number in self.specials.items()}
        self.bytes_of = [b""] * (max(contents) + 1)
        for number, token in contents.items():
            known = all(letter in letters for letter in token)
            self.bytes_of[number] = bytes(letters[letter] for letter in token) if known else token.encode()
        self.split = regex.compile(WORDS).findall
        ordered = sorted(self.specials, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")").split if ordered else None
        self.words = Words(self)

    def merged(self, data: bytes) -> list[int]:
        """Ids of one word."""
        return self._merge_short(data) if len(data) <= SHORT_WORD else self._merge_long(data)

    def _merge_short(self, data: bytes) -> list[int]:
        merges, none = self.merges, (NO_RANK, 0)
        parts = [self.first[byte] for byte in data]
        ranks = [merges.get(pair, none)[0] for pair in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < NO_RANK:
            at = ranks.index(least)
            parts[at] = merges[parts[at], parts[at + 1]][1]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = merges.get((parts[at - 1], parts[at]), none)[0]
            if at < len(ranks):
                ranks[at] = merges.get((parts[at], parts[at + 1]), none)[0]
        return parts

    def _merge_long(self, data: bytes) -> list[int]:
        merges, none, count = self.merges, (NO_RANK, 0), len(data)
        parts = [self.first[byte] for byte in data]
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        heap = [rank * count + at for at, pair in enumerate(zip(parts, parts[1:])) if (rank := merges.get(pair, none)[0]) < NO_RANK]
        heapify(heap)
        while heap:
            rank, at = divmod(heappop(heap), count)
            right = after[at]
            if parts[at] < 0 or right >= count:
                continue
            current, new = merges.get((parts[at], parts[right]), none)
            if current != rank:
                continue
            parts[at], parts[right] = new, -1
            after[at] = right = after[right]
            if right < count:
                before[right] = at
                if (rank := merges.get((new, parts[right]), none)[0]) < NO_RANK:
                    heappush(heap, rank * count + at)
            left = before[at]
            if left >= 0 and (rank := merges.get((parts[left], new), none)[0]) < NO_RANK:
                heappush(heap, rank * count + left)
        return [part for part in parts if part >= 0]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.cut is None or not any(special in text for special in self.specials):
            return b"".join(map(self.words.__getitem__, self.split(text)))
        pieces = []
        for piece in self.cut(text):
            special = self.specials.get(piece)
            if special is None:
                pieces.extend(map(self.words.__getitem__, self.split(piece)))
            else:
                pieces.append(special.to_bytes(4, "little"))
        return b"".join(pieces)

    def decode(self, packed: bytes) -> str:
        table = self.bytes_of
        known = [table[number] for number in np.frombuffer(packed, "<u4").tolist() if number < len(table)]
        return b"".join(known).decode("utf-8", "replace")


@cache
def _tokenizer(source: bytes) -> Tokenizer:
    return Tokenizer(source)


def _shared(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file, which only the driver needs to reach."""
    size = Path(path).stat().st_size
    if size > FILE_BYTES:
        raise ValueError(f"a vocabulary of {size} bytes is not broadcast")
    source = Path(path).read_bytes()
    _tokenizer(source)  # an unsuited file stops here, not in a task
    return spark.sparkContext.broadcast(source)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids) of every row; ``ids`` are packed, little-endian, four bytes each."""
    source = _shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(source.value)
        for batch in batches:
            packed = [tokenizer.encode(text.as_py()) if text.is_valid else b"" for text in batch.column(1)]
            counts = pa.array([len(ids) // 4 for ids in packed], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array(packed, pa.binary())], names=[id_col, "n_tokens", "ids"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    schema = T.StructType([rows.schema[0], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns, and the text that the packed ids stand for; NULL ids give the empty text."""
    source = _shared(tokens.sparkSession, path)
    place = tokens.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(source.value)
        for batch in batches:
            texts = [tokenizer.decode(ids.as_py() or b"") for ids in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name])

    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField(name, T.StringType())]))
