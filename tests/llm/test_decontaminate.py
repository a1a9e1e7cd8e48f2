"""Decontamination against word-by-word search."""

import random
import re

import pytest
from chargelake.llm import decontaminate
from chargelake.staging import staged

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_force(docs, items):
    windows = []
    for item, text in items:
        w = words(text)
        size = min(len(w), 10)
        windows += [(item, w[i : i + size]) for i in range(len(w) - size + 1) if w]
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    found |= {str(item)} - {"None"}
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [True, False])
def test_matches_brute_force(spark, documents, odd_rows, monkeypatch, small):
    monkeypatch.setattr(decontaminate, "fits_broadcast", lambda windows: small)
    random.seed(3)
    vocabulary = ["one", "Two", "thrée", "4our", "five", "SIX"]
    sentence = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(1, sentence(25)), (2, "short, Item here!"), (3, None), (4, ""), (2, "short, Item here!"), (None, "nameless item"), (9, sentence(10))]
    docs = [(100, items[0][1] + " " + sentence(5)), (101, "x SHORT item; here y"), (102, sentence(400)), (103, "a nameless ITEM"), (104, items[-1][1])]
    docs += [(105, " ".join(items[0][1].split()[5:18])), (105, " ".join(items[0][1].split()[5:18])), *odd_rows]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contamination(documents(docs, key="k", words="w", places=1, items="i"), table).collect()
    got = sorted(((r.doc_id, r.n_words, len(r.places), tuple(r["items"])) for r in found), key=str)
    assert got == brute_force(docs, items)
    kept = decontaminate.without_contaminated(documents(docs), table)
    assert kept.count() == sum(hit == 0 for _, _, hit, _ in brute_force(docs, items))


def test_shuffled_windows_leave_their_text_behind(spark, documents, monkeypatch):
    """What is dealt by a window's hash has the window's words, and no column with all words of its text."""
    monkeypatch.setattr(decontaminate, "fits_broadcast", lambda windows: False)
    plans = []
    monkeypatch.setattr(decontaminate, "staged", lambda df, label: (plans.append((label, df)), staged(df, label))[1])
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id bigint, text string")
    decontaminate.contamination(documents([(1, "zero one two three four five six seven eight nine ten")]), items).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = dict(plans)["hits"].select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [columns for columns in re.findall(r"Exchange hashpartitioning\(.*hash#.*\n.*Project \[(.*)\]", plan) if "key#" in columns]
    assert len(dealt) == 1 and "words#" not in dealt[0], plan


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = documents([(1, "some words"), (2, None)])
    assert [len(r.places) for r in decontaminate.contamination(docs, none).collect()] == [0, 0]
    assert decontaminate.without_contaminated(docs, none).count() == 2
    assert decontaminate.contamination(docs.limit(0), none).count() == 0


def test_passages_are_removed(spark, documents):
    items = spark.createDataFrame([(1, "leaked secret passage")], "item_id bigint, text string")
    got = decontaminate.without_passages(documents([(1, "Before, the Leaked SECRET passage! After"), (2, "Clean  text.")]), items)
    assert {r.doc_id: r.text for r in got.collect()} == {1: "Before the After", 2: "Clean  text."}
