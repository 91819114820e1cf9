"""Targets against step-by-step resharing, takes against the queues they describe."""

import random
from collections import Counter, defaultdict

import pytest
from cases import frame, words
from pyspark.sql import functions as F

from riskflow.llm import mixing


def reshared(sizes: dict, weights=(5, 2, 1), share=1.5, repeats=2) -> dict:
    """Share out, stop those above their limit, share their excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    limit = {s: repeats * sizes[s] for s in names}
    fixed, budget = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        left = budget - sum(fixed.values())
        total = sum(weight[s] for s in free)
        now = {s: left * weight[s] / total for s in free}
        above = [s for s in free if now[s] > limit[s]]
        if not above:
            return fixed | now
        fixed |= {s: limit[s] for s in above}
        if len(fixed) == len(names):
            return fixed


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rnd = random.Random(seed)
    names = rnd.sample(["a", "B", "ä", "z", "", "aa", "🙂", "￿", "1", "10"], rnd.randint(2, 10)) + [None]
    sizes = {n: rnd.choice([0, 1, 50, 1000, 100_000]) for n in names}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(df, (5, 2, 1), 1.5, 2).collect()}
    want = reshared(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0)
    assert got == pytest.approx(want, abs=1e-4)


def test_takes_of_awkward_documents(spark):
    docs = frame(spark)
    queue, mix = mixing.schedule(docs, rows_per_bucket=7)
    taken = mixing.taken_per_document(queue, mix).collect()
    rows = docs.select("doc_id", "text", "source").collect()
    assert Counter((r.id, r.size, r.source) for r in taken) == Counter(
        (r.doc_id, len(words(r.text)), r.source) for r in rows
    )
    sizes, sums = defaultdict(int), defaultdict(int)
    for r in taken:
        sizes[r.source] += r.size
        sums[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = reshared(sizes)
    for r in taken:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-4)
    for s in sizes:
        assert abs(sums[s] - want[s]) < 1
    again = mixing.taken_per_document(*mixing.schedule(docs.repartition(3))).collect()
    assert Counter(map(tuple, (r[1:] for r in again))) == Counter(map(tuple, (r[1:] for r in taken)))

    # Shares are near the targets at every moment: finish times never run backwards, and
    # positions have no gaps.
    order = sorted(mix.collect(), key=lambda r: r.position)
    assert [r.position for r in order] == [sum(x.taken for x in order[:i]) for i in range(len(order))]
    assert all(a.finish <= b.finish for a, b in zip(order, order[1:]))


def test_mixed_documents_are_whole_but_for_the_last(spark):
    docs = frame(spark)
    queue, mix = mixing.schedule(docs)
    want = mixing.taken_per_document(queue, mix).filter("taken > 0").collect()
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    originals = {r.text for r in docs.collect()}
    cut = [r for r in rows if r.text not in originals]
    assert len(cut) <= len({r.source for r in docs.collect()})
    assert all(any(o and o.startswith(r.text) for o in originals) for r in cut)
    total = Counter()
    for r in rows:
        total[r.doc_id] += len(words(r.text))
    expected = Counter()
    for r in want:
        expected[r.id] += r.taken
    assert total == expected


def test_first_words_and_empty(spark):
    df = spark.createDataFrame([("  a\tb \n c",), ("x y z",)], "t string")
    got = [r[0] for r in df.select(mixing.first_words(F.col("t"), F.lit(2))).collect()]
    assert got == ["  a\tb \n ", "x y "]
    none = frame(spark, [])
    queue, mix = mixing.schedule(none)
    assert queue.count() == 0 and mix.count() == 0 and mixing.mixed_documents(none).count() == 0
