"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import documents, frame, prose

from riskflow.llm import lexical_search as s

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ITEMS = "item_id bigint, text string, score string, rank string, id string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(rows, items, k=50):
    """(item, rank, document, score) by the definition."""
    docs = [(i, Counter(terms(t))) for i, t in rows if terms(t)]
    n_docs, words = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in docs:
            n = sum(c.values())
            m = 100 - 50 + (50 * n * n_docs) // words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def questions(rows, rnd, n=12):
    out = []
    for i in range(n):
        words = (rnd.choice([r[1] for r in rows if r[1]])).split()
        a = rnd.randrange(max(1, len(words) - 8))
        out.append((i, " ".join(words[a : a + 8]) + rnd.choice(["", "!", " THE der"])))
    return out


@pytest.mark.parametrize("k", [3, 50])
def test_awkward_documents(spark, monkeypatch, k):
    monkeypatch.setattr(s, "BLOCK_DOCS", 16)
    monkeypatch.setattr(s, "PAIRS", 20)
    rows = documents()
    items = questions(rows, random.Random(1)) + [(100, None), (101, ""), (102, " !? "), (103, "zzz unknown"), (None, "der und"), (0, "word 12345"), (0, "word 12345")]
    want = ranked([r[:2] for r in rows], [*items[:-1]], k)
    asked = spark.createDataFrame([(*i, "x", "x", "x") for i in items], ITEMS)
    got = found(s.search(frame(spark, rows).repartition(3), asked, k))
    assert got == want
    assert len({r[0] for r in got}) >= 12 and any(r[2] is None for r in got) == any(r[2] is None for r in want)


def test_items_in_parts_and_an_index_of_ones_own(spark, monkeypatch):
    rows = documents(n=30)
    items = questions(rows, random.Random(2), 9)
    asked = spark.createDataFrame([(*i, "x", "x", "x") for i in items], ITEMS)
    docs = frame(spark, rows)
    index = s.build_index(docs)
    monkeypatch.setattr(s, "QUERY_TERMS", 20)
    assert found(s.search(docs, asked, 4, index=index)) == ranked([r[:2] for r in rows], items, 4)


def test_nothing(spark):
    asked = spark.createDataFrame([(1, "a b", "x", "x", "x")], ITEMS)
    assert found(s.search(frame(spark, []), asked)) == []
    assert found(s.search(frame(spark), asked.limit(0))) == []
    assert s.search(frame(spark), asked.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_hold_and_exclude(spark):
    """Bounds are never below the scores, and leave most documents out."""
    rnd = random.Random(5)
    vocabulary = [prose(rnd, "en", 1).strip(".,\n") + str(i) for i in range(400)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([30, 80, 400])) + ["rare"] * (i % 97 == 3) * rnd.randint(1, 20)), *(None,) * 15) for i in range(700)]
    items = [(i, " ".join([*rnd.sample(vocabulary, 3), "rare"])) for i in range(6)]
    docs = frame(spark, rows)
    index = s.build_index(docs).cache()
    total = index.selectExpr("sum(docs)", "sum(words)").first()
    asked = spark.createDataFrame([(*i, "x", "x", "x") for i in items], ITEMS)
    terms_ = s.query_terms(asked, index, total[0], "item_id", "text").collect()
    q = s._Queries(terms_, *total)
    true = {(i, d): score for i, _, d, score in ranked([r[:2] for r in rows], items, 700)}
    bounds = {}
    for r in index.select(*s._BLOCK).collect():
        block = {k: np.array(v) if isinstance(v, list) else v for k, v in r.asDict().items()}
        bound = s._bounds(q, 0, len(q.items), block)
        for i, item in enumerate(q.items):
            for d, b in zip(block["ids"], bound[i], strict=True):
                bounds[item["id"], int(d)] = int(b)
    assert all(bounds[key] >= score for key, score in true.items())
    exact = sum(bounds[key] <= 1.25 * score for key, score in true.items())
    assert exact > 0.8 * len(true)
    assert sum(b > 0 for b in bounds.values()) < 1.6 * len(true) + 100
    assert found(s.search(docs, asked, 5, index=index)) == ranked([r[:2] for r in rows], items, 5)
