"""Near duplicates and repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import CLASHING, SCHEMA, documents, frame, prose, words
from pyspark.sql import functions as F

from riskflow.llm import near_dedup, substring_dedup

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < width else [tuple(w[i : i + width]) for i in range(len(w) - width + 1)])


def linked(rows, width, percent=80):
    """Smallest id reachable, per id, from all pairs."""
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}, sets


def pages(rows):
    return [(i, t, "en", "a", 1, 1, *CLASHING) for i, t in rows]


@pytest.mark.parametrize("width", [2, 5])
def test_components_of_awkward_documents(spark, width):
    rows = [(r[0], r[1]) for r in documents(n=40)]
    got = near_dedup.near_duplicates(frame(spark, documents(n=40)), width=width).collect()
    want, sets = linked(rows, width)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert sum(not r.kept for r in got) >= 6


def test_a_large_group_near_the_threshold(spark, monkeypatch):
    """Copies of one text with edits: some link to each other, some only through others."""
    rnd = random.Random(8)
    base = words(prose(rnd, "en", 120))
    rows = []
    for i in range(70):
        text = list(base)
        for _ in range(rnd.choice([0, 2, 4, 6, 8])):
            text[rnd.randrange(len(text))] = f"w{rnd.randrange(10**6)}"
        rows.append((500 - i if i % 2 else i, " ".join(text)))
    rows += [(1000 + i, prose(rnd, "de", 40)) for i in range(10)]
    rows += [(2000 + i, rows[3][1].upper()) for i in range(30)]
    monkeypatch.setattr(near_dedup, "SIGNATURE_BLOCK", 20)
    monkeypatch.setattr(near_dedup, "SET_BLOCK", 15)
    monkeypatch.setattr(near_dedup, "SHINGLE_STEP", 50)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(pages(rows), SCHEMA), width=2).collect()}
    want, _ = linked(rows, 2)
    assert got == want
    assert len(set(want.values())) > 11  # the group isn't one component


def linked_rows(rows, width, percent=80):
    """Component per row, where rows of one id are linked whatever their texts."""
    sets = [shingles(t, width) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for n in range(len(rows)):
        for m in range(n):
            both = len(sets[n] & sets[m])
            alike = both and 100 * both >= percent * (len(sets[n]) + len(sets[m]) - both)
            if sets[n] and sets[m] and (alike or rows[n][0] == rows[m][0]):
                x, y = root(n), root(m)
                label[max(x, y)] = min(x, y)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[root(n)] = min(i, least.get(root(n), i))
    return sorted((i, len(sets[n]), least[root(n)]) for n, (i, _) in enumerate(rows))


@pytest.mark.parametrize("order", [1, -1])
def test_ids_with_several_texts(spark, order):
    """All sets of an id are one node: their copies and near copies are linked through it."""
    rnd = random.Random(12)
    a, b, c, d = (prose(rnd, "en", 80) for _ in range(4))
    near = lambda t: t + " tail"
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b)), (7, c), (5, c), (5, d), (9, near(d)), (9, ""), (20, prose(rnd, "de", 50))]
    got = near_dedup.near_duplicates(spark.createDataFrame(pages(rows[::order]), SCHEMA), width=2).collect()
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)
    want = linked_rows(rows, 2)
    assert found == [x if x[1] else (x[0], 0, x[0]) for x in want]
    assert {x[0]: x[2] for x in found if x[1]} == {1: 1, 2: 1, 3: 1, 5: 5, 7: 5, 9: 5, 20: 20}


def test_estimates_follow_similarity(spark):
    rnd = random.Random(4)
    words_ = [f"w{i}" for i in range(3000)]
    texts = []
    for share in (0.0, 0.3, 0.6, 0.8, 0.9, 1.0):
        common, n = int(400 * share), 400 - int(400 * share)
        base = rnd.sample(words_, common + 2 * n)
        texts.append((" ".join(base[: common + n]), " ".join(base[:common] + base[common + n :]), common / (common + 2 * n)))
    rows = [(2 * i + j, t) for i, pair in enumerate(texts) for j, t in enumerate(pair[:2])]
    df = spark.createDataFrame(rows, "id bigint, text string")
    signed = near_dedup.signatures(df, 1).withColumnRenamed("node", "id")
    a = signed.filter("id % 2 = 0").select((F.col("id") / 2).alias("k"), F.col("packed").alias("pa"))
    b = signed.filter("id % 2 = 1").select(((F.col("id") - 1) / 2).alias("k"), F.col("packed").alias("pb"))
    got = {int(r.k): r.e for r in a.join(b, "k").select("k", near_dedup.estimated_similarity("pa", "pb").alias("e")).collect()}
    for i, (_, _, similarity) in enumerate(texts):
        assert abs(got[i] - similarity) < near_dedup.MARGIN * 1.3


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, x) for x in range(101, 130)] + [(129, 5), (5, 5), (7, 6)]
    got = dict(map(tuple, near_dedup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {x: 10 for x in range(10, 41)} | {x: 5 for x in [5, *range(100, 130)]} | {6: 6, 7: 6}


def test_no_documents_or_no_pairs(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0
    alone = near_dedup.near_duplicates(spark.createDataFrame(pages([(1, "a b c d e f"), (2, "")]), SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in alone) == [(1, 2, 1, True), (2, 0, 2, True)]
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(frame(spark, []), percent=70)


# --- repeated passages -----------------------------------------------------------------
def without_repeats(rows, window):
    first = {}
    for i, text in rows:
        if i is not None:
            w = words(text)
            for k in range(len(w) - window + 1):
                x = tuple(w[k : k + window])
                first[x] = min(first.get(x, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def check(spark, rows, window):
    cut = substring_dedup.remove_repeats(spark.createDataFrame(pages(rows), SCHEMA), window)
    got = cut.select("doc_id", "n_words", "n_removed", substring_dedup.kept_digest()).collect()
    assert Counter(map(tuple, got)) == Counter(without_repeats(rows, window))
    return got


def test_cover_meets_every_difference():
    d, v = substring_dedup.COVER, substring_dedup.PERIOD
    for a in range(v):
        for b in range(v):
            assert any((a + k) % v in d and (b + k) % v in d for k in range(v))


@pytest.mark.parametrize("window", [32, 50])
def test_passages_of_awkward_documents(spark, window):
    rows = [(r[0], r[1]) for r in documents(seed=6)]
    got = check(spark, rows, window)
    assert sum(r[2] > 0 for r in got) > 5


def test_passages_at_every_offset_and_length(spark):
    """Matches of 49 to 52 words, at shifting places, at the ends, and overlapping."""
    rnd = random.Random(3)
    fresh = lambda n: [f"u{rnd.randrange(10**9)}" for _ in range(n)]
    rows, passage = [], fresh(120)
    for i in range(40):
        a = rnd.randrange(60)
        part = passage[a : a + rnd.choice([49, 50, 51, 52, 60])]
        rows.append((rnd.randrange(10**6), "\t ".join(fresh(rnd.randrange(70)) + part + fresh(rnd.choice([0, 0, 31])))))
    rows += [(10**7 + i, " ".join(["la"] * n)) for i, n in enumerate([49, 50, 51, 200])]
    rows += [(10**8 + i, " ".join(passage)) for i in range(25)]  # a hot passage
    check(spark, rows, 50)


def test_kept_text_and_passed_columns(spark):
    rows = [(1, "x " + " ".join(f"p{i}" for i in range(50))), (2, "a\n" + "\n ".join(f"p{i}" for i in range(50)) + "  b"), (3, None)]
    cut = substring_dedup.remove_repeats(spark.createDataFrame(pages(rows), SCHEMA).drop("n_words", "kept_text"))
    got = {r.doc_id: r for r in cut.collect()}
    assert (got[1].kept_text, got[2].kept_text, got[3].kept_text) == (rows[0][1], "a\nb", None)
    assert got[2].score == "x" and got[2].group == "x"
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(frame(spark, []), window=31)


def test_shingles_of_short_texts():
    values, begins = near_dedup.shingle_sets([b"", b"a", b"a b", b"A  b", b"a b a b a", b" "], 2)
    assert np.diff(begins).tolist() == [0, 1, 1, 1, 2, 0]
    assert values[begins[2]] == values[begins[3]] != values[begins[1]]


def test_empty_texts_of_an_id_do_not_hide_its_set(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, ""), (1, None), (1, text), (1, " \n"), (2, text + " more"), (2, ""), (3, "other words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_dedup.near_duplicates(docs).collect()
    assert {(r.doc_id, r.component_id) for r in found if r.n_shingles} == {(1, 1), (2, 1), (3, 3)}
