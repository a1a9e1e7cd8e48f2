"""Position-table CRC and importance resampling against plain computations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from compare import difference, oracle_connection

from chargelake.llm import resampling
from chargelake.llm.blocks import text_blocks
from chargelake.llm.oracles import ORACLES
from chargelake.llm.queries import op12_importance_resampling

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def plain_buckets(text):
    words = WORD.findall((text or "").encode().translate(FOLD))
    runs = [b" ".join(words[i : i + size]) for size in (1, 2, 3) for i in range(len(words) - size + 1)]
    return len(words), sorted(zlib.crc32(run) % 10_000 for run in runs)


def table_buckets(texts, block=resampling.BLOCK_BYTES):
    out = [[0, []] for _ in texts]
    for first, data, offsets in text_blocks(pa.array(texts, pa.string()), block):
        for words, rows, buckets in resampling.features_of(data, offsets, 3, 10_000):
            for row in words:
                out[first + row][0] += 1
            for row, bucket in zip(rows.tolist(), buckets.tolist()):
                out[first + row][1].append(bucket)
    return [(words, sorted(buckets)) for words, buckets in out]


def drawn_texts(count):
    draw = random.Random(0)

    def bit():
        return draw.choice([
            "A", "b", "é", " ", "  ", ".", "zz", "9", "中文", "x" * draw.randint(1, 300), "\0", "{",
            "Q" * draw.choice([1, 2, 255, 256, 257, 511, 512, 513, 1025])])

    return ["".join(bit() for _ in range(draw.randint(0, 40))) for _ in range(count)]


def test_buckets_equal_zlib():
    texts = drawn_texts(400) + [None, "", "a", "a b", "..."]
    assert table_buckets(texts) == [plain_buckets(text) for text in texts]


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK_BYTES", 3000)
    texts = drawn_texts(50) + [" ".join(f"w{i % 77}" for i in range(5000)), "q" * 50_000 + " a " + "z" * 7000, "a" * 5999 + " b"]
    assert table_buckets(texts, 3000) == [plain_buckets(text) for text in texts]


def test_long_spans_fold_in_steps(monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK_BYTES", 1024)
    data = np.frombuffer(random.Random(3).randbytes(20_000), np.uint8)
    starts, ends = np.array([0, 5, 300, 0]), np.array([257, 4105, 301, 20_000])
    found = resampling.folded_crc(data, starts, ends)
    assert found.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


def plain_resample(rows, targets, percent):
    every, wanted = Counter(), Counter()
    found = [(doc, *plain_buckets(text)) for doc, text in rows]
    for _, _, buckets in found:
        every.update(buckets)
    for text in targets:
        wanted.update(plain_buckets(text)[1])
    total, aim = sum(every.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (total + 10_000) / ((every[b] + 1) * (aim + 10_000)))) for b in every}
    scored = []
    for doc, words, buckets in found:
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        scored.append((doc, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    fit = sorted((row for row in scored if row[4] >= 20), key=lambda row: (-row[3], row[0] is not None, row[0] or 0))
    ranks = [(*row[:4], place if place <= len(fit) * percent // 100 else None) for place, row in enumerate(fit, 1)]
    return sorted(map(str, ranks + [(*row[:4], None) for row in scored if row[4] < 20]))


def test_query_matches_sql(spark):
    found = op12_importance_resampling(spark, SF_DIR)
    assert difference(oracle_connection(SF_DIR), found, ORACLES["op12_importance_resampling"]) is None


def test_odd_rows_ties_and_copies(spark, documents, odd_rows):
    rows = odd_rows + [(i // 3, " ".join(f"t{j % (i % 4 + 2)}" for j in range(25))) for i in range(60)]
    targets = ["t0 t1 t0", None, ""]
    target = spark.createDataFrame([(i, text, "clash") for i, text in enumerate(targets)], "item_id int, text string, score string")
    found = resampling.resample(documents(rows, score="clash", rank=1, bucket=2), target, percent=50)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    got = sorted(str((r.doc_id, r.n_features, r.weight, r.score, r.rank)) for r in found.collect())
    assert got == plain_resample(rows, targets, 50)


def test_empty_tables(spark, documents, odd_rows):
    nothing = documents([])
    assert resampling.resample(nothing, nothing).collect() == []
    assert resampling.resample(nothing, documents(odd_rows)).collect() == []
    found = resampling.resample(documents(odd_rows), nothing, percent=100)
    assert sorted(str((r.doc_id, r.n_features, r.weight, r.score, r.rank)) for r in found.collect()) == plain_resample(odd_rows, [], 100)
