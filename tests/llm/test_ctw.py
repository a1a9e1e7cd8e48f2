"""Context-tree weighting against a slow, sequential computation."""

import random
from math import lgamma, log, log10, pi

import numpy as np
import pytest

from chargelake.llm import ctw


class SlowTree:
    """The model by its definition: dictionaries of counts, recursion over depths."""

    def __init__(self, texts):
        self.counts = {}
        for text in texts:
            for context, symbol in self.steps(text):
                for depth in range(ctw.DEPTH + 1):
                    for level in range(8):
                        place = (context[:depth], (1 << level) | (symbol >> (8 - level)))
                        self.counts.setdefault(place, [0, 0])[(symbol >> (7 - level)) & 1] += 1

    def steps(self, text):
        data = (text or "").encode() + b"\xff"
        for i, symbol in enumerate(data):
            before = [data[i - k] if i >= k else 255 for k in (1, 2, 3)]
            yield tuple(int(ctw.byte_classes()[b]) for b in before), symbol

    def estimate(self, place):
        a, b = self.counts.get(place, (0, 0))
        return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(pi), (b + 0.5) / (a + b + 1)

    def weighted(self, context, node):
        whole, _ = self.estimate((context, node))
        if len(context) == ctw.DEPTH:
            return whole
        below = sum(self.weighted((*context, c), node) for c in range(64) if ((*context, c), node) in self.counts)
        return float(np.logaddexp(whole, below)) - log(2)

    def one(self, context, node, depth=0):
        own = context[:depth]
        whole, chance = self.estimate((own, node))
        if depth == ctw.DEPTH:
            return chance
        share = np.exp(whole - log(2) - self.weighted(own, node))
        return share * chance + (1 - share) * self.one(context, node, depth + 1)

    def score(self, text):
        total = 0
        for context, symbol in self.steps(text):
            for level in range(8):
                chance = self.one(context, (1 << level) | (symbol >> (8 - level)))
                total += log10(chance if (symbol >> (7 - level)) & 1 else 1 - chance)
        return total


def test_matches_slow_tree(spark, documents):
    rows = [(1, "abracadabra"), (2, "Abba é!"), (3, ""), (4, None), (5, "dab 12 dab 34")]
    asked = [*rows, (6, "unseen: xyz ñ"), (7, "a")]
    found = ctw.score(documents(asked, score=1, row=2), documents(rows)).collect()
    tree = SlowTree([text for _, text in rows])
    for row in found:
        assert row.score == pytest.approx(tree.score(dict(asked)[row.doc_id]), rel=1e-5)


def test_probabilities_sum_to_one(documents):
    random.seed(4)
    model = ctw.learn(documents([(i, "".join(random.choices("abc é", k=30))) for i in range(20)]).select("text"))
    assert np.allclose((10 ** model.logs.astype(float)).sum(axis=1), 1, atol=1e-4)


def test_base_scores(documents, odd_rows):
    training = [(1, "The the cat"), (2, None), (3, "a cat " * 3)]
    docs = [*odd_rows, (50, "the DOG the cat"), (51, "a")]
    counts = {"the": 2, "cat": 4, "a": 3, None: 3}
    n, v = 12, 4
    found = ctw.score(documents(docs, base=1, rare=2), documents(training)).collect()
    assert len(found) == len(docs)
    for row in found:
        for text in {t for d, t in docs if d == row.doc_id}:
            words = [w.decode() for w in (text or "").encode().lower().split()] + [None]
            base = sum(log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in words)
            if row.n_tokens == len(words) and abs(base - row.base_score) < 1e-6:
                break
        else:
            pytest.fail(str(row))
        assert row.train_tokens == n


def test_rare_words_are_looked_up(documents, monkeypatch):
    training = documents([(1, "common common common rare"), (2, "common " + "x" * 100)])
    plain = {r.doc_id: (r.base_score, r.n_known) for r in ctw.score(training, training).collect()}
    monkeypatch.setattr(ctw, "HOT_TOKENS", 1)
    looked_up = {r.doc_id: (r.base_score, r.n_known) for r in ctw.score(training, training).collect()}
    assert looked_up == {key: (pytest.approx(base), known) for key, (base, known) in plain.items()}
    assert {known for _, known in plain.values()} == {5, 3}


def test_nothing_to_learn_from(documents):
    (row,) = ctw.score(documents([(1, "ab")]), documents([])).collect()
    assert row.score == pytest.approx(3 * 8 * log10(0.5))
    assert (row.base_score, row.train_tokens, row.n_known) == (0, 0, 0)
    assert ctw.score(documents([]), documents([(1, "ab")])).count() == 0
