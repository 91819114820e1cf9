"""Word hashes, and the archive against a plain reading of its contract."""

import base64
import hashlib
import random

import numpy as np
import pytest
from cases import WORD, frame, words
from pyspark.sql import functions as F

from riskflow.llm import warc
from riskflow.llm.words import SLICE_BYTES, slices, word_count, word_hashes


def test_word_hashes_tell_words_apart():
    texts = ["a b  a\tb", "", None, "ab a\x0bB ñ n", "x" * 3000 + " x", "\n"]
    run = [(t or "").encode() for t in texts]
    hashes, begins = word_hashes(run)
    found = [w for t in texts for w in words(t)]
    assert np.diff(begins).tolist() == [len(words(t)) for t in texts]
    assert len(set(hashes.tolist())) == len(set(found)) and len(hashes) == len(found)
    by_word = {}
    for w, h in zip(found, hashes.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    lower, _ = word_hashes([b"B \xc3\x91"], lower=True)
    plain, _ = word_hashes(["b Ñ".encode()])
    assert lower.tolist() == plain.tolist()


def test_slices_hold_every_text_once():
    rnd = random.Random(1)
    texts = [b"y" * rnd.choice([0, 10, SLICE_BYTES // 3, 2 * SLICE_BYTES]) for _ in range(30)] + [None]
    got = [t for first, run in slices(texts) for t in run]
    assert got == [t or b"" for t in texts]
    assert [first for first, _ in slices(texts)][0] == 0 and not list(slices([]))


def test_word_count(spark):
    df = frame(spark).select("text", word_count("text").alias("n"))
    assert all(r.n == len(WORD.findall(r.text or "")) for r in df.collect())


PAGES = [
    (3, "http://a/x", "<p>same</p>"),
    (1, "http://a/y", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (4, "http://a/z", None),
    (5, "http://a/ü", ""),
    (6, "http://a/long", "é" * 200_000),
    (7, "http://a/r", "twice"),
    (7, "http://a/r", "twice"),
    (7, "http://a/s", "twice"),
    (8, "http://a/r", "twice"),
    (None, "http://n/1", "no key"),
    (None, "http://n/2", "<p>same</p>"),
    (9, "http://a/t", "alone"),
]


@pytest.fixture(scope="module")
def archive(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    df = df.withColumns({"digest": F.lit("x"), "key": F.lit("y"), "payload": F.lit(1)})
    return warc.write_archive(df, warc.scratch_archive(spark), "page_id", "url", "html")


def test_archive_follows_the_contract(archive):
    got = warc.records(archive).collect()
    assert len(got) == len(PAGES)
    by_payload = {}
    for key, _, html in PAGES:
        by_payload.setdefault((html or "").encode(), []).append(key)
    assert archive.payloads.count() == len(by_payload)
    for payload, keys in by_payload.items():
        own = [r for r in got if bytes(r.payload) == payload]
        assert sorted(str(r.key) for r in own) == sorted(map(str, keys))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert {(r.payload_digest, r.payload_bytes) for r in own} == {(digest, len(payload))}
        first = min((k for k in keys if k is not None), default=None)
        responses = [r for r in own if r.record_type == "response"]
        assert [r.key for r in responses] == [first] and responses[0].refers_to is None
        assert all(r.refers_to == first for r in own if r.record_type == "revisit")


def test_original_records_parse_as_warc(archive):
    for r in warc.original_bytes(archive).collect():
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert len(body) == int(fields["Content-Length"]) + 4 and body.endswith(b"\r\n\r\n")
        if fields["WARC-Type"] == "response":
            digest = base64.b32encode(hashlib.sha1(body[:-4]).digest()).decode()
            assert fields["WARC-Payload-Digest"] == f"sha1:{digest}"


def test_line_ends_in_a_uri_are_no_header_lines(spark):
    forged = "http://x/\r\nWARC-Payload-Digest: sha1:AAAA\r\nWARC-Refers-To: <urn:x-record:77>"
    urls = [forged, "http://x/a\nb", "\r", "%0D\n%250A", "http://x/%0D%0A", "http://x/100%", "x\n\r\n\r\ny", "é\u2028\u0085z"]
    pages = [(i, u, "same" if i % 3 else f"own {i}") for i, u in enumerate(urls)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    archive = warc.write_archive(df, warc.scratch_archive(spark), "page_id", "url", "html")
    got = {r.key: r for r in warc.records(archive).collect()}
    assert {k: r.uri for k, r in got.items()} == dict(enumerate(urls))
    for i, _, html in pages:
        assert bytes(got[i].payload) == html.encode()
        assert got[i].refers_to == (1 if html == "same" and i != 1 else None)
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert got[i].payload_digest == digest
    for r in warc.original_bytes(archive).collect():
        names = [x.split(b":")[0] for x in bytes(r.record).partition(b"\r\n\r\n")[0].split(b"\r\n")]
        assert len(names) == len(set(names))


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    got = warc.write_archive(df, warc.scratch_archive(spark), "page_id", "url", "html", min_bytes=6)
    kinds = {(r.key, r.record_type) for r in warc.records(got, with_payload=False).collect()}
    assert {(4, "response"), (5, "response"), (7, "response"), (8, "response")} <= kinds
    assert (3, "revisit") in kinds


def test_damaged_payloads_and_empty_tables(spark, archive, tmp_path):
    bad = archive.payloads.withColumn("payload", F.concat("payload", F.lit(b"!")))
    with pytest.raises(Exception, match="doesn't match its digest"):
        warc.records(warc.Archive("", archive.headers, bad)).collect()
    lost = warc.Archive("", archive.headers, archive.payloads.filter("length(payload) > 0"))
    with pytest.raises(Exception, match="no payload"):
        warc.records(lost).collect()
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.records(warc.write_archive(none, str(tmp_path / "w"), "page_id", "url", "html")).count() == 0
