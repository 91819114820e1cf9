"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from cases import documents, frame

from riskflow.llm import spelling

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def counted(rows, slip=31, least=7, often=2):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= often}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def grouped(n, ratio=10):
    out = {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = [form, w, n[w], len(near), n[form] if form else None]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def found(df):
    got = df.collect()
    assert len(got) == len({r.word for r in got})
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def test_awkward_documents(spark):
    rows = documents()
    n = counted([r[:2] for r in rows])
    words = spelling.word_counts(frame(spark), slip_every=31)
    assert {r.word: r.n for r in words.collect()} == n
    assert found(spelling.variant_groups(words)) == grouped(n)


def test_slips_and_letters(spark):
    text = "ÀBCDEFGH Straße-schöne x×yz÷abcd Ābcdefgh " + " ".join(f"Mississippi{'abcdefgh'[i % 8]}" for i in range(200))
    rows = [(i, text, None, None, None, None, *("x",) * 11) for i in range(30)]
    n = counted([r[:2] for r in rows])
    assert any(len(w) == 11 for w in n) and "àbcdefgh" not in n and "Àbcdefgh".translate(LOWER) in n
    words = spelling.word_counts(frame(spark, rows), slip_every=31)
    assert {r.word: r.n for r in words.collect()} == n
    assert found(spelling.variant_groups(words)) == grouped(n)


@pytest.mark.parametrize("symbols", [1, 2, 8])
def test_every_edit_of_random_words(spark, symbols):
    """Chains of forms, ties, doubled letters, letters outside the basic plane, a long word."""
    rnd = random.Random(symbols)
    n = {}
    for _ in range(40):
        w = "".join(rnd.choices("aabé\U0001f600", k=rnd.randint(1, 9)))
        for level in (20_000, 1_500, 100, 100, 9, 1):
            n[w] = level
            i, c = rnd.randrange(len(w) + 1), rnd.choice("abéz")
            w = rnd.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :] or "a"])
    n["ab" * 3000] = 50
    n["ab" * 2999 + "a"] = 5
    n["ab" * 1500 + "c" + "ab" * 1500] = 4
    words = spark.createDataFrame(list(n.items()), "word string, n bigint").repartition(3)
    want = grouped(n)
    assert found(spelling.variant_groups(words, symbols=symbols)) == want
    assert max(len({want[w][1], w, want[w][0]}) for w in want) == 3


def test_hot_words_and_nothing(spark):
    words = spelling.word_counts(frame(spark, []))
    assert found(spelling.variant_groups(words)) == {}
    rows = [(i, "hotwords " * 50 + "hotword", *(None,) * 15) for i in range(200)]
    n = counted([r[:2] for r in rows], slip=None)
    assert found(spelling.variant_groups(spelling.word_counts(frame(spark, rows)))) == grouped(n)
    assert grouped(n)["hotword"][0] == "hotwords"
