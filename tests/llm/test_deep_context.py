"""Context trees over true bytes against a slow, sequential computation."""

import random
from math import lgamma, log, log10, pi

import numpy as np
import pytest

from chargelake.llm import ctw, deep_context


class SlowTree:
    def __init__(self, texts, depth):
        self.counts, self.depth, self.known = {}, depth, {}
        for text in texts:
            for context, symbol in self.steps(text):
                for d in range(depth + 1):
                    for level in range(8):
                        place = (context[:d], (1 << level) | (symbol >> (8 - level)))
                        self.counts.setdefault(place, [0, 0])[(symbol >> (7 - level)) & 1] += 1
        self.children = {}
        for context, node in self.counts:
            if context:
                self.children.setdefault((context[:-1], node), []).append(context)

    def steps(self, text):
        data = (text or "").encode() + b"\xff"
        for i, symbol in enumerate(data):
            yield tuple(data[i - k] if i >= k else 255 for k in range(1, self.depth + 1)), symbol

    def estimate(self, place):
        a, b = self.counts.get(place, (0, 0))
        return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(pi), (b + 0.5) / (a + b + 1)

    def weighted(self, place):
        if place not in self.known:
            value = self.estimate(place)[0]
            if len(place[0]) < self.depth:
                below = sum(self.weighted((child, place[1])) for child in self.children.get(place, []))
                value = float(np.logaddexp(value, below)) - log(2)
            self.known[place] = value
        return self.known[place]

    def one(self, context, node, depth=0):
        place = (context[:depth], node)
        whole, chance = self.estimate(place)
        if depth == self.depth:
            return chance
        share = np.exp(whole - log(2) - self.weighted(place))
        return share * chance + (1 - share) * self.one(context, node, depth + 1)

    def score(self, text):
        total = 0
        for context, symbol in self.steps(text):
            for level in range(8):
                chance = self.one(context, (1 << level) | (symbol >> (8 - level)))
                total += log10(chance if (symbol >> (7 - level)) & 1 else 1 - chance)
        return total


@pytest.mark.parametrize("depth", [3, 6])
def test_matches_slow_tree(documents, depth):
    rows = [(1, "abracadabra abracadabra"), (2, "Abba é!"), (3, ""), (4, None), (5, "dab 12 dab 34"), (5, "dab 12 dab 34")]
    asked = [*rows, (6, "unseen: xyz ñ"), (7, "a")]
    found = ctw.score(documents(asked, score=1, row=2, a=3), documents(rows), depth=depth).collect()
    tree = SlowTree([text for _, text in rows], depth)
    assert len(found) == len(asked)
    for row in found:
        assert row.score == pytest.approx(tree.score(dict(asked)[row.doc_id]), rel=1e-5)


def test_what_lies_further_back_than_three_bytes_counts(documents):
    """Letter case and the sixth byte back decide the next byte; the bounded model can tell neither apart."""
    rng = random.Random(3)
    training = documents([(i, "".join(rng.choice(["A----x", "a----y"]) for _ in range(40))) for i in range(20)])
    right, wrong = "A----xa----y" * 5, "A----ya----x" * 5
    found = {r.doc_id: r.score for r in ctw.score(documents([(1, right), (2, wrong)]), training, depth=6).collect()}
    assert found[1] > found[2] + 10


def test_nothing_to_learn_from(documents):
    (row,) = ctw.score(documents([(1, "ab")]), documents([]), depth=6).collect()
    assert row.score == pytest.approx(3 * 8 * log10(0.5))
    assert ctw.score(documents([]), documents([(1, "ab")]), depth=6).count() == 0
    assert ctw.score(documents([]), documents([]), depth=6).count() == 0


def test_odd_rows_and_several_blocks(documents, odd_rows, monkeypatch):
    """A text longer than a block, NULLs, repeats; the same scores whatever the blocks."""
    rng = random.Random(8)
    long_text = " ".join(rng.choice(["abra", "cadabra", "é", "12"]) for _ in range(1_900_000))
    assert len(long_text.encode()) > deep_context.BLOCK_BYTES
    rows = [*odd_rows, (90, long_text), (91, "abra cadabra"), (91, "abra cadabra"), (92, "")]
    docs = documents(rows, block=1, tree="x", logs=2, keys=3)
    found = ctw.score(docs, docs.filter("doc_id IS NULL OR doc_id < 91"), depth=6).collect()
    assert len(found) == len(rows)
    scores = {}
    for row in found:
        assert scores.setdefault((row.doc_id, row.n_bytes), row.score) == row.score < 0
    assert scores[91, 12] > 12 * log10(0.1) and scores[92, 0] == scores[2, 0]
    alone = ctw.score(docs.filter("doc_id IN (5, 8, 91, 92)"), docs.filter("doc_id IS NULL OR doc_id < 91").repartition(5), depth=6)
    for row in alone.collect():
        assert row.score == pytest.approx(scores[row.doc_id, row.n_bytes], rel=1e-5)


def test_numbers_are_packed_and_unpacked():
    for values in (np.arange(0), np.array([3, 3, 900, 1 << 55]), np.array([1.5, -2.25], np.float32), np.array([7], np.uint32)):
        assert deep_context.unpacked(deep_context.packed(values), values.dtype.type).tolist() == values.tolist()
    keys = np.array([5, 9, 9, 1 << 54])
    assert deep_context.unpacked_keys(deep_context.packed_keys(keys)).tolist() == keys.tolist()
