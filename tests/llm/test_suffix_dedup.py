"""Repeated strings of bytes against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from cases import documents, frame, prose
from pyspark.sql import functions as F

from riskflow.llm import suffix_dedup as s


def covered(texts, length):
    """Per text: which bytes lie in a string of `length` bytes that starts elsewhere as well."""
    places = defaultdict(list)
    for d, text in enumerate(texts):
        for i in range(len(text) - length + 1):
            places[text[i : i + length]].append((d, i))
    gone = [bytearray(len(t)) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                gone[d][i : i + length] = b"\1" * length
    return gone


def expected(texts, length):
    for text, gone in zip(texts, covered(texts, length), strict=True):
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        yield len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def got(df):
    out = df.select("doc_id", "n_bytes", "n_removed", F.size("removed"), F.sha2("kept", 256))
    return sorted(map(tuple, out.collect()), key=repr)


def wanted(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    return sorted(((i, *e) for (i, _), e in zip(rows, expected(texts, length), strict=True)), key=repr)


@pytest.mark.parametrize("hot", [4096, 3])
def test_awkward_documents(spark, monkeypatch, hot):
    monkeypatch.setattr(s, "HOT_PLACES", hot)
    monkeypatch.setattr(s, "BUCKET_BYTES", 1 << 14)
    rows = documents(n=50)
    rows = [(*r[:1], r[1][:20_000] if r[1] else r[1], *r[2:]) for r in rows]
    want = wanted([r[:2] for r in rows], 200)
    assert got(s.remove_repeats(frame(spark, rows).repartition(3), 200)) == want
    assert sum(r[2] > 0 for r in want) > 10 and sum(r[2] == 0 for r in want) > 10


@pytest.mark.parametrize("hot", [4096, 2])
def test_overlaps_runs_and_chains(spark, monkeypatch, hot):
    """Runs of one letter, periods, passages of every length around the limit, whole copies."""
    monkeypatch.setattr(s, "HOT_PLACES", hot)
    rnd = random.Random(3)
    passage = prose(rnd, "es", 60)
    texts = ["a" * 200, "b" * 201, "cd" * 150, "xyz" * 66 + "xy", "q" * 199, "q" * 199]
    for n in (100, 198, 199, 200, 201, 260, 340):
        part = passage.encode()[:n].decode(errors="ignore")
        texts += [f"{rnd.random()}{part}{rnd.random()}", f"{rnd.random()} {part}"]
    own = prose(rnd, "de", 80)
    texts += [own, own, own[3:] + "!", own[:250] + own[100:], "é" * 130 + own[:99]]
    rows = [(i if i % 4 else None, t, *(None,) * 15) for i, t in enumerate(texts)]
    assert got(s.remove_repeats(frame(spark, rows), 200)) == wanted([r[:2] for r in rows], 200)


def test_blocks_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 700)
    rnd = random.Random(9)
    long = prose(rnd, "en", 900)
    rows = [(1, long + prose(rnd, "de", 40) + long[500:1900], *(None,) * 15), (2, long[2500:3300], *(None,) * 15)]
    assert got(s.remove_repeats(frame(spark, rows), 64)) == wanted([r[:2] for r in rows], 64)


def test_nothing(spark):
    assert s.remove_repeats(frame(spark, [])).collect() == []
    rows = [(1, None, *(None,) * 15), (2, "", *(None,) * 15)]
    assert got(s.remove_repeats(frame(spark, rows))) == wanted([r[:2] for r in rows], 200)


def plain_repeats(data, starts, length):
    """Groups (length, starts) of common prefixes whose members differ to their left."""
    groups = set()
    for n in range(length, max((e - b for b, e in starts), default=0) + 1):
        same = defaultdict(list)
        for b, e in starts:
            if b + n <= e:
                same[data[b : b + n]].append((b, e))
        for members in same.values():
            right = {data[b + n : b + n + 1] if b + n < e else ("end", b) for b, e in members}
            left = {data[b - 1 : b] if b else ("begin", b) for b, e in members}
            if len(members) > 1 and len(right) > 1 and len(left) > 1:
                groups.add((n, tuple(sorted(b for b, _ in members))))
    return groups


def test_groups_are_the_maximal_repeats():
    """One segment whose suffixes all have a known left byte: groups against their definition."""
    rnd = random.Random(2)
    for _ in range(30):
        text = "".join(rnd.choices("ab", k=rnd.choice([30, 60]))) * rnd.choice([1, 2]) + "".join(rnd.choices("ab", k=30))
        data = text.encode()
        n = len(data)
        place = np.arange(n - 16 + 1)
        left = np.where(place > 0, np.frombuffer(data, np.uint8)[place - 1], -1).astype(np.int64)
        order, value, first, last = s._maximal_repeats(
            np.frombuffer(data + b"\xff" * 20, np.uint8), place, n - place, left, 16
        )
        groups = {
            (int(v), tuple(sorted(int(x) for x in place[order[a : b + 1]])))
            for v, a, b in zip(value, first, last, strict=True)
        }
        assert groups == plain_repeats(data, [(b, n) for b in place.tolist()], 16)


def test_all_occurrences_are_listed(spark):
    rnd = random.Random(6)
    passage = prose(rnd, "en", 70)[:230]
    rows = [(i, f"{i * 7919} {passage} {i * 104729}", *(None,) * 15) for i in range(9)]
    found = s.repeat_groups(frame(spark, rows), 200).collect()
    texts = {r[0]: r[1].encode() for r in rows}
    groups = defaultdict(set)
    for r in found:
        groups[r.repeat].add((r.doc_id, r.start, texts[r.doc_id][r.start : r.after]))
    assert groups and all(len({t for *_, t in g}) == 1 and len(t) >= 200 for g in groups.values() for *_, t in g)
    assert any({d for d, *_ in g} == set(range(9)) for g in groups.values())
