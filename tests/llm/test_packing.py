import random

import numpy as np
from pyspark.sql import functions as F

from chargelake.llm import packing
from chargelake.llm.queries import op10_best_fit_packing


def check(rows, placed, sizes):
    """Every place of every row lies in exactly one bin; bins hold no gaps and no longer fit a smaller size."""
    bins = {}
    for r in placed:
        bins.setdefault(r.bin_id, []).append(r)
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.position):
            assert r.position == at
            at += r.length
        assert pieces[0].capacity == min(s for s in sizes if s >= at)
    got = sorted(((r.doc_id, r.start, r.length) for r in placed), key=str)
    want = []
    for doc, text in rows:
        n = len(text or "") + 1
        want += [(doc, s, min(max(sizes), n - s)) for s in range(0, n, max(sizes))]
    assert got == sorted(want, key=str)


def test_everything_is_placed(documents, odd_rows):
    random.seed(1)
    rows = [*odd_rows, *((100 + i, "é" * random.randrange(0, 5000)) for i in range(500))]
    docs = documents(rows, length=1, piece=2, bin_id=3)
    sizes = (256, 1024, 2048)
    check(rows, packing.pack(docs, sizes=sizes).collect(), sizes)
    assert packing.pack(docs.limit(0)).count() == 0


def test_own_lengths_and_sequences(documents):
    docs = documents([(1, "abc"), (2, "d" * 30), (3, None)])
    assert sorted(r.length for r in packing.pack(docs, length=F.col("doc_id")).collect()) == [2, 3, 4]
    placed = packing.pack(docs, sizes=(16, 32))
    whole = packing.sequences(docs, placed, end="|").collect()
    assert sum(len(r.text) for r in whole) == 4 + 31 + 1
    assert sorted("".join(r.text for r in whole).replace("|", "")) == sorted("abc" + "d" * 30)


def test_best_fit_prefers_the_fullest_bin():
    bins, positions, capacities = packing.best_fit(np.array([60, 50, 40, 30, 20]), (100,))
    assert bins.tolist() == [0, 1, 0, 1, 1] and positions.tolist() == [0, 0, 60, 50, 80] and capacities.tolist() == [100, 100]


def test_sizes_are_chosen_jointly():
    few = packing.best_fit(np.array([90]), (100, 1000))[2]
    many = packing.best_fit(np.full(1000, 10), (100, 1000))[2]
    assert few.tolist() == [100] and set(many.tolist()) == {1000}
    dear = packing.best_fit(np.full(1000, 10), (100, 1000), cost=lambda s: s * s)[2]
    assert set(dear.tolist()) == {100}
    assert packing.best_fit(np.array([990, 15]), (100, 1000))[2].tolist() == [1000, 100]


def plain_best_fit(lengths, sizes, cost):
    """The same rule by looking at every open bin for every piece."""
    order = sorted(range(len(lengths)), key=lambda at: (-lengths[at], at))
    bins, placed = [], {}
    for turn, piece in enumerate(order):
        length = lengths[piece]
        fitting = [(size - used, number) for number, (size, used) in enumerate(bins) if size - used >= length]
        if fitting:
            number = min(fitting)[1]
        else:
            def per_place(size):
                free = size - length
                to_come = sum(lengths[other] for other in order[turn + 1 :] if lengths[other] <= free)
                return cost(size) / (length + min(free, to_come))

            bins.append((min((size for size in sizes if size >= length), key=per_place), 0))
            number = len(bins) - 1
        size, used = bins[number]
        placed[piece] = (number, used)
        bins[number] = (size, used + length)
    return [placed[at] for at in range(len(lengths))], [min(size for size in sizes if size >= used) for _, used in bins]


def test_equals_plain_best_fit():
    draw = random.Random(4)
    for trial in range(60):
        sizes = sorted(draw.sample(range(20, 200), draw.randint(1, 4)))
        lengths = [draw.choice([draw.randint(1, max(sizes)), 7, 7, max(sizes)]) for _ in range(draw.randint(0, 80))]
        cost = draw.choice([packing.linear_cost, lambda size: size * size, lambda size: 1.0])
        bins, positions, capacities = packing.best_fit(np.array(lengths, np.int64), sizes, cost)
        placed, sized = plain_best_fit(lengths, sizes, cost)
        assert list(zip(bins.tolist(), positions.tolist())) == placed and capacities.tolist() == sized


def test_query_equals_plain_best_fit(spark):
    """The smallest table is one partition and one chunk, so the whole result can be worked out."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    pieces = [(row.doc_id, at, min(max(packing.SIZES), len(row.text or "") + 1 - at)) for row in docs for at in range(0, len(row.text or "") + 1, max(packing.SIZES))]
    placed, capacities = plain_best_fit([length for _, _, length in pieces], packing.SIZES, packing.linear_cost)
    wanted = {(doc, start, length, capacities[own], position) for (doc, start, length), (own, position) in zip(pieces, placed)}
    found = op10_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.start, r.length, r.capacity, r.position) for r in found} == wanted and len(found) == len(wanted)


def test_under_filled_bins_are_packed_again_across_partitions(documents, monkeypatch):
    random.seed(8)
    rows = [(i, "x" * random.choice([700, random.randrange(0, 3000), 5000])) for i in range(600)]
    docs, sizes = documents(rows, used=1, chunk=2), (1024, 4096)
    few, many = (packing.pack(docs.repartition(n, "doc_id"), sizes=sizes).collect() for n in (1, 64))
    check(rows, few, sizes)
    check(rows, many, sizes)

    def places(found):
        return sum({r.bin_id: r.capacity for r in found}.values())

    assert places(many) < 1.02 * places(few)
    monkeypatch.setattr(packing, "NEARLY_FULL", 0.0)
    once = packing.pack(docs.repartition(64, "doc_id"), sizes=sizes).collect()
    check(rows, once, sizes)
    assert places(once) > places(many)


def test_equal_texts_fill_as_many_bins_in_any_split(documents):
    docs = documents([(i, "x" * 499) for i in range(800)])
    bins = [packing.pack(docs.repartition(n, "doc_id"), sizes=(1024, 16384)).select("bin_id").distinct().count() for n in (1, 50)]
    assert bins[0] == bins[1] == 25


def test_chunks_of_one_partition_and_odd_ids(documents, odd_rows, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 7)
    monkeypatch.setattr(packing, "CHUNK_ROWS", 21)
    rows = [*odd_rows, *((None if i % 9 == 0 else i, "z" * (i * 53 % 300)) for i in range(200))]
    check(rows, packing.pack(documents(rows), sizes=(64, 256)).collect(), (64, 256))
