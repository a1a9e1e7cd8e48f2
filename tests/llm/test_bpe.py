"""Byte-pair encoding against the tokenizers library, merges against one another, odd rows."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from chargelake.llm import bpe
from chargelake.llm.queries import op13_byte_pairs

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as file:
        return bpe.Tokenizer(file.read())


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_query_equals_library(spark, library):
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = op13_byte_pairs(spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_mixed_texts_equal_library(own, library):
    bits = ["'s", "'ll", " ", "\n", "\t", "a", "é", "12", "<|endoftext|>", "<|endof", "text|>", "中", " ", "　", "\x1c", "\x85", "!", " the", "\r\n", "\0", "🙂"]
    draw = random.Random(1)
    for _ in range(1500):
        text = "".join(draw.choices(bits, k=draw.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own.encode(text)) == ids
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_every_letter_of_the_basic_plane_is_cut_alike(own, library):
    letters = [chr(code) for code in range(1, 0x10000) if not 0xD800 <= code < 0xE000]
    for first in range(0, len(letters), 97):
        text = " ".join(f"a{letter} {letter}  {letter}1" for letter in letters[first : first + 97])
        assert ids_of(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_short_and_long_words_merge_alike(own, library):
    draw = random.Random(2)
    for length in (1, 2, 3, 60, 128):
        for _ in range(50):
            word = "".join(draw.choices("aeiorstn", k=length)).encode()
            assert own._merge_short(word) == own._merge_long(word)
    for word in ("a" * 9001, "".join(draw.choices("abcdefgh0123", k=20_000))):
        assert ids_of(own.encode(word)) == library.encode(word, add_special_tokens=False).ids


def test_remembered_words_stay_bounded(own, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    own.words.clear()
    for number in range(50):
        own.encode(f" word{number}")
        assert len(own.words) <= 5


def test_odd_rows(spark, documents, odd_rows, library):
    rows = documents(odd_rows, ids="clash", n_tokens=9, decoded="clash")
    found = bpe.decode(bpe.encode(rows, PATH), PATH).collect()
    assert len(found) == len(odd_rows)
    expected = sorted((str(i), text or "") for i, text in odd_rows)
    assert sorted((str(row.doc_id), row.decoded) for row in found) == expected
    for row in found:
        assert ids_of(row.ids) == library.encode(row.decoded, add_special_tokens=False).ids and row.n_tokens == len(row.ids) // 4
    assert bpe.encode(documents([]), PATH).collect() == []
    none = spark.createDataFrame([(1, None), (2, bytearray(b"\xff\xff\xff\x7f"))], "n int, ids binary")
    assert [row.decoded for row in bpe.decode(none, PATH).orderBy("n").collect()] == ["", ""]


def test_unsuited_vocabularies_are_refused(spark, documents, tmp_path):
    with open(PATH) as file:
        found = json.load(file)
    found["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "v.json").write_text(json.dumps(found))
    with pytest.raises(ValueError, match="byte-level"):
        bpe.encode(documents([(1, "a")]), str(tmp_path / "v.json"))


def test_nothing_is_shuffled(spark, documents):
    plan = bpe.decode(bpe.encode(documents([(1, "a")]), PATH), PATH).select(F.sha2("ids", 256))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
