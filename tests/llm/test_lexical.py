"""Impact-sorted search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import difference, oracle_connection
from pyspark.sql import functions as F

from chargelake.llm import lexical
from chargelake.llm.oracles import ORACLES
from chargelake.llm.queries import op11_impact_search
from chargelake.staging import LONG_ROWS, staged

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
QUERIES = "item_id string, text string, rank int"


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), term) for term in TERM.findall(text or "")]


def plain_search(rows, queries, k):
    docs = [(doc, Counter(terms_of(text))) for doc, text in rows if terms_of(text)]
    total = sum(counts.total() for _, counts in docs)
    frequency = Counter(term for _, counts in docs for term in counts)
    out = []
    for item, text in queries:
        scores = []
        for doc, counts in docs:
            m = 25 + 75 * counts.total() * len(docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * frequency[term] + 1))) * (10**9 * counts[term] // (1000 * counts[term] + 8 * m))
                for term in terms_of(text) if term in counts)
            if score > 0:
                scores.append((-score, doc is None, doc if doc is not None else 0, doc))
        out += [(item, rank, found[3], -found[0]) for rank, found in enumerate(sorted(scores)[:k], 1)]
    return sorted(map(str, out))


def results(found):
    return sorted(str((row.item_id, row.rank, row.doc_id, row.score)) for row in found.collect())


@pytest.fixture(scope="module")
def corpus(documents, odd_rows):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    odds = [1 / (i + 1) for i in range(60)]
    rows = [(i, " ".join(draw.choices(words, odds, k=draw.randint(0, 50)))) for i in range(600)]
    rows += [(2000 + i, "W1, w2! the same text w7 w30 ünïcödé") for i in range(300)]
    rows += [(2100, "W1, w2! the same text w7 w30 ünïcödé"), (None, "w30 w7")] + odd_rows
    return rows


def test_query_matches_sql(spark):
    found = op11_impact_search(spark, SF_DIR)
    assert difference(oracle_connection(SF_DIR), found, ORACLES["op11_impact_search"]) is None


@pytest.mark.parametrize("segment_bytes", [300, 20_000, lexical.SEGMENT_BYTES])
def test_many_segments_hot_copies_and_odd_queries(spark, documents, corpus, segment_bytes):
    queries = [
        ("a", "w1 W1 w30 same ünïcödé"), ("b", "w59 w58 w0"), ("c", "w7"), ("d", ""), ("e", None), ("f", "nowhere to be found w"), (None, "w12 w13"),
        ("a", "w1 W1 w30 same ünïcödé"), ("g", " ".join(f"w{i} word{i}" for i in range(60)))]
    index = lexical.build_index(documents(corpus, terms="clash", score=1).repartition(3), segment_bytes=segment_bytes)
    asked = spark.createDataFrame([(*query, 7) for query in queries], QUERIES)
    for k in (1, 10, 400):
        expected = plain_search(corpus, queries, k)
        assert results(lexical.search(index, asked, k)) == expected
    assert results(lexical.search(index, asked, 400, query_bytes=80)) == expected


def test_reading_stops_early():
    """One list decides: of a hundred thousand entries only the first steps are read."""
    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            out = super().__getitem__(key)
            if isinstance(key, np.ndarray):
                Counted.read += np.size(out)
            return out

    size = 100_000
    docs = np.concatenate([np.arange(size), np.arange(size)]).view(Counted)
    parts = np.concatenate([np.arange(size, 0, -1) * 1000, np.full(size, 1)])
    starts, sizes, weights = np.array([0, size]), np.array([size, size]), np.array([5, 1])
    found, scores = lexical.read_until_resolved(starts, sizes, weights, docs, parts, size, 10, 1)
    assert found.tolist() == list(range(10)) and scores.tolist() == [(size - i) * 5000 + 1 for i in range(10)]
    assert Counted.read < size / 10


def test_bounds_resolve_ties_at_the_last_place():
    docs = np.array([3, 2, 1, 0, 4, 0, 1, 2, 3])
    parts = np.array([9, 5, 5, 5, 5, 4, 4, 4, 4])
    found, scores = lexical.read_until_resolved(np.array([0, 5]), np.array([5, 4]), np.array([1, 1]), docs, parts, 5, 2, 1)
    assert list(zip(found.tolist(), scores.tolist())) == [(3, 13), (0, 9)]


def test_long_text_is_counted_in_pieces(monkeypatch):
    text = " ".join(f"W{i % 900}é" for i in range(20_000)).encode()
    whole = lexical.term_counts(text)
    monkeypatch.setattr(lexical, "PIECE_BYTES", 50)
    assert lexical.term_counts(text) == whole and whole.total() == 20_000


def test_empty_tables(spark, documents, odd_rows):
    empty = documents([])
    none = spark.createDataFrame([], QUERIES)
    some = spark.createDataFrame([("a", "word1 the words", 1)], QUERIES)
    assert lexical.search(lexical.build_index(empty), some).collect() == []
    assert lexical.search(lexical.build_index(documents([(1, None), (2, "..")])), some).collect() == []
    assert lexical.search(lexical.build_index(documents(odd_rows)), none).collect() == []


def test_only_candidates_are_shuffled(spark, documents, corpus):
    index = lexical.build_index(documents(corpus))
    plan = lexical.search(index, spark.createDataFrame([("a", "w1", 1)], QUERIES))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.index("Exchange hashpartitioning(query")  # below it, before the exchange


def test_long_rows_are_stored_and_handed_on_one_by_one(spark):
    """A row of the index holds megabytes: neither the writer nor a task's batch may gather a hundred of them."""
    rows = spark.range(12, numPartitions=1).select(F.concat(F.col("id"), F.repeat(F.lit("x"), 3 << 20)).alias("text"))
    stored = staged(rows, "long", "uncompressed", **LONG_ROWS)
    (path,) = stored.inputFiles()
    meta = pq.ParquetFile(path.removeprefix("file:")).metadata
    assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 7

    def sizes(batches):
        yield from (pa.RecordBatch.from_pydict({"rows": [batch.num_rows]}) for batch in batches)

    limit, before = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    op11_impact_search(spark, SF_DIR)
    try:
        assert int(spark.conf.get(limit)) == lexical.BATCH_BYTES
        held = [row.rows for row in stored.mapInArrow(sizes, "rows bigint").collect()]
        assert sum(held) == 12 and max(held) <= 7
        spark.conf.set(limit, "1000")
        lexical.small_batches(spark)
        assert spark.conf.get(limit) == "1000"
    finally:
        spark.conf.set(limit, before)


def test_the_index_is_stored_as_long_rows(documents, monkeypatch):
    seen, stage = [], lexical.staged
    monkeypatch.setattr(lexical, "staged", lambda df, label, **options: seen.append((label, options)) or stage(df, label, **options))
    lexical.build_index(documents([(1, "one two"), (2, "two three")]))
    assert seen == [("postings", LONG_ROWS)]
