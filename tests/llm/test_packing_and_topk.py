"""Pieces against the tokenizer, bins against their constraints, top-k against all scores."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskflow.llm import packing, topk

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_packed_documents(spark):
    docs = frame(spark)
    got = packing.packed_documents(docs, PATH, 4096).collect()
    want = []
    for r in docs.collect():
        ids = plain_ids(r.text)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            own = np.array(ids[start : start + 4096], "<u4")
            want.append((r.doc_id, piece, start, len(own), zlib.crc32(own.tobytes())))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(want, key=key)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        ends = [o + n for o, n in places]
        assert [o for o, _ in places] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(by_sequence) <= math.ceil(sum(r.length for r in got) / 4096) + 1


@pytest.mark.parametrize("text", [
    "á ́b ΣΑΣ don't I'LL", "x y z　w\x1c\x1dv", "İ ß 'S can'T̈ e ̈", "\x85a\x0bb", "  ",
])
def test_ids_of_words_are_ids_of_the_text(text):
    got = packing.WordIds(PATH).ids([text.encode()])[0]
    assert np.frombuffer(got, "<u4").tolist() == plain_ids(text)[:-1]


def test_cache_is_bounded_and_stays_right(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    known = packing.WordIds(PATH)
    for text in ("one two three", "four five six seven", "one two eight nine ten eleven twelve", "one"):
        assert np.frombuffer(known.ids([text.encode()])[0], "<u4").tolist() == plain_ids(text)[:-1]
    assert len(known) <= 7


def test_a_word_is_encoded_once_whatever_its_case_and_signs():
    known = packing.WordIds(PATH)
    text = "Word word, WORD. (word) word7word <|word don'T-don't \u00c9t\u00e9 \u00e9t\u00c9! l'\u00e9t\u00e9 \u00d7\u00e9t\u00e9"
    assert known.ids([text.encode()])[0].tolist() == plain_ids(text)[:-1]
    cut = {b"word", b",", b".", b"(", b")", b"7", b"don", b"'t", b"-", b"\xc3\xa9t\xc3\xa9", b"!", b"l", b"'"}
    assert set(known) == cut | {b"<|word", "\u00d7\u00e9t\u00e9".encode()}


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(rule):
    rnd = np.random.default_rng(3)
    lengths = rnd.integers(1, 4000, 3000)
    capacity = (4096.0, 6.0, 9e6)
    lengths = lengths[lengths.astype(float) ** 2 <= capacity[2]]
    bins, offsets = packing.best_fit(lengths, capacity, rule=rule)
    for b in range(bins.max() + 1):
        own = lengths[bins == b]
        assert len(own) and own.sum() <= 4096 and len(own) <= 6 and (own.astype(float) ** 2).sum() <= 9e6
        order = np.argsort(offsets[bins == b])
        assert offsets[bins == b][order].tolist() == [0, *np.cumsum(own[order])[:-1].tolist()]
    free, _ = packing.best_fit(lengths, (4096.0, 4096.0, 4096.0**2), rule=rule)
    assert free.max() + 1 <= math.ceil(lengths.sum() / 4096) * 1.02


def test_capacities_through_spark_and_empty(spark):
    rows = [(i, 0, 0, n, 0) for i, n in enumerate([4096, 3000, 10, 10, 10, 1])]
    df = spark.createDataFrame(rows, "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    got = packing.pack(df, 4096, max_documents=2, max_attention=5e6).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.sequence_id, []).append(r.length)
    assert sorted(map(sorted, groups.values())) == [[1, 10], [10, 10], [3000], [4096]]
    assert packing.packed_documents(frame(spark, []), PATH).count() == 0


def brute(vectors, is_query, k):
    known = [
        (i, [math.floor(256 * float(x)) for x in v]) for i, v in vectors
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, a in known:
        if i is None or not is_query(i):
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), j is None, j or 0, j) for j, b in known if j != i]
        out += [(i, n + 1, j, -s) for n, (s, _, _, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(4096, 512), (16, 3)])
def test_top_k(spark, blocks):
    rnd = random.Random(2)
    vectors = [(i, [np.float32(rnd.choice([0, rnd.uniform(-1, 1)])).item() for _ in range(8)]) for i in range(120)]
    vectors += [(200 + i, [0.5] * 8) for i in range(30)]  # many ties
    vectors += [
        (300, None), (350, [None] * 8), (400, [float("nan")] * 8), (450, [float("inf"), 1.0]), (500, []),
        (550, [1.0] * 3), (551, [1.0] * 12), (552, [0.0] * 8), (None, [0.9] * 8), (7, [0.7] * 8), (7, [0.7] * 8),
    ]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    df = df.withColumns({c: F.lit(1) for c in ("id", "weights", "q_block", "c_block", "score", "rank")})
    got = topk.top_k(
        df, F.col("vec_id") % 50 == 0, 5, candidates_per_block=blocks[0], queries_per_block=blocks[1]
    )
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    floats = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    assert sorted(map(tuple, got.collect())) == brute(floats, lambda i: i % 50 == 0, 5)


def test_top_k_of_few_or_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(few, F.col("vec_id") == 0, 5).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(few.limit(0), F.col("vec_id") == 0, 5).count() == 0
