"""Exact round trips through seekable bundles."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chargelake.llm import warc

SCHEMA = "page_id bigint, url string, html string"


def pages():
    random.seed(2)
    big = "é" * 700
    rows = [(1, "http://a/ü x\r\nX: y", big), (2, None, big), (7, "http://b", big), (7, "http://b", big), (3, "u", "small"), (4, "u", "small"),
            (5, "u", None), (6, "u", ""), (None, "u", "z" * 1000), (8, "u", "z" * 1000), (9, "u", "w" * 1000), (10, None, "\r\n\r\nWARC/1.1\r\n")]
    return rows + [(100 + i, f"http://c/{i}", "".join(random.choices("abc<p>\n", k=20_000))) for i in range(60)]


def expected(rows):
    best = {}
    for i, _, html in rows:
        key = html or ""
        best[key] = max(best.get(key, -1), -1 if i is None else i)
    out = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 1000 and (-1 if i is None else i) != best[html]
        out[(i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", best[html] if again else None)] += 1
    return out


def test_round_trip(spark, monkeypatch):
    df = spark.createDataFrame(pages(), SCHEMA).withColumns({"key": F.lit(1), "digest": F.lit(2), "refers_to": F.lit(3), "id": F.lit(4)})
    bundles = warc.archive(df)
    read = warc.read_bundles(bundles, payloads=True).collect()
    number = lambda text: None if text is None else int(text)
    assert Counter((number(r.record_id), r.payload_bytes, r.digest, r.record_type, number(r.refers_to)) for r in read) == expected(pages())
    assert all(hashlib.sha1(r.payload).hexdigest() == r.digest for r in read if r.record_type == "response")
    wanted = spark.createDataFrame([("105",), ("1",), ("absent",)], "record_id string")
    fetched = {r.record_id: (r.record_type, bytes(r.payload)) for r in warc.fetch(bundles, wanted).collect()}
    assert fetched == {"105": ("response", dict((i, h) for i, _, h in pages())[105].encode()), "1": ("revisit", b"")}


def test_bundles_have_many_frames_and_a_footer():
    writer = warc.BundleWriter()
    for i in range(200):
        writer.add(str(i), warc.record_bytes(str(i), None, random.randbytes(4000), "00" * 20, None, "2020-01-01T00:00:00Z"))
    bundle, index = writer.finish()
    places = warc.frame_places(bundle)
    assert len(places) > 2 and places[-1][0] + places[-1][1] == len(bundle) - 8 - 8 * len(places) - 9
    frame = warc.read_frame(bundle, places[index[150]["frame"]])
    assert warc.parse_record(frame, index[150]["offset"])[0]["record_id"] == "150"
    with pytest.raises(ValueError, match="seek table"):
        warc.frame_places(bundle[:-1])


def test_empty(spark):
    assert warc.read_bundles(warc.archive(spark.createDataFrame([], SCHEMA))).count() == 0
