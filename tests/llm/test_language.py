"""Language ID against a plain computation, and on held-out texts."""

from math import exp, log

import pyarrow as pa
import pytest

from chargelake.llm import language
from chargelake.llm.common import table


def test_matches_plain_computation(documents):
    rows = [(1, "Abc abd", "en"), (2, "xyz xxz", "fr"), (3, "abz", None), (4, "zzz ab", "fr")]
    model = language.learn(documents(rows))
    grams = {}

    def counts(text):
        out = {}
        data = pa.array([text])
        for _, buf, offsets in language.text_blocks(data):
            _, bucket, n, _ = language.ngram_counts(buf, offsets, language.BUCKETS)
            out = dict(zip(bucket.tolist(), n.tolist()))
        return out

    for _, text, lang in rows:
        if lang:
            for bucket, n in counts(text).items():
                grams.setdefault(lang, {}).setdefault(bucket, 0)
                grams[lang][bucket] += n
    assert sum(counts("Abc abd").values()) == 7 + 6 + 5
    prior = {"en": log(1 / 3), "fr": log(2 / 3)}
    text = "abd xyz"
    logs = {
        lang: prior[lang] + sum(
            n * log((own.get(b, 0) + 1) / (sum(own.values()) + language.BUCKETS)) for b, n in counts(text).items())
        for lang, own in grams.items()}
    best = max(logs, key=logs.get)
    (got,), (score,) = language.score_texts(pa.array([text]), model)
    assert got == best
    assert score == pytest.approx(1 / sum(exp(v - logs[best]) for v in logs.values()), rel=1e-4)


def test_odd_rows(documents, odd_rows):
    docs = documents(odd_rows, lang_pred="x", score=1, id="y")
    model = language.learn(documents([(1, "the words of a text", "en"), (2, "les mots du texte", "fr"), (3, None, "de"), (4, "x", None)]))
    assert model.languages == ["en", "fr"]
    found = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(docs, model).collect()]
    assert len(found) == len(odd_rows)
    assert {d for d, lang, _ in found if lang == "und"} == {1, 2, 3, 7, None}
    assert all(0 <= s <= 1 for *_, s in found)
    kept = language.with_language(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["5", "6", "6", "8", "None"]


def test_nothing_to_learn_from(documents):
    model = language.learn(documents([(1, "text", None)]))
    assert [r.lang_pred for r in language.identify(documents([(1, "text")]), model).collect()] == ["und"]
    assert language.with_language(documents([(1, "text"), (2, "12")]), model).count() == 1
    assert language.identify(documents([]), model).count() == 0


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    held_out = language.fold("doc_id", 4) == 2
    model = language.learn(docs.filter(~held_out))
    rows = language.identify(docs.filter(held_out), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
