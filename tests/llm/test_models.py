"""Language identification, quality rules, the quality model and LM scores."""

import math
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from cases import CLASHING, SCHEMA, documents, frame, prose, words
from pyspark.sql import functions as F

from riskflow.llm import language_id, lm_score, quality_model, quality_rules, queries


# --- language identification -----------------------------------------------------------------
def test_automaton_accepts_just_the_substrings():
    rnd = np.random.default_rng(1)
    text = rnd.integers(0, 3, 50).astype(np.uint8)
    table = language_id.suffix_automaton(text, 4)
    for _ in range(2000):
        part = rnd.integers(0, 4, rnd.integers(1, 9)).astype(np.uint8)
        state = 0
        for c in part:
            state = table[state, c] if state >= 0 else -1
        assert (state >= 0) == (bytes(part) in bytes(text))


def test_phrases_are_those_of_a_greedy_parse(monkeypatch):
    monkeypatch.setattr(language_id, "TOGETHER", 3)
    rnd = np.random.default_rng(2)
    texts = [rnd.integers(1, 4, 80).astype(np.uint8) for _ in range(2)]
    tables = [language_id.stepping(language_id.suffix_automaton(t, 5)) for t in texts]
    model = language_id.Model(["a", "b"], tables, [80, 80], np.zeros(1), 5)
    parts = [rnd.integers(0, 5, n).astype(np.uint8) for n in (0, 1, 5, 40, 511, 512, 513, 1500)]
    got = language_id.phrases(model, parts)
    for part, row in zip(parts, got, strict=True):
        for text, n in zip(texts, row, strict=True):
            want = 0
            for at in range(0, len(part), language_id.STRETCH):
                stretch, i = bytes(part[at : at + language_id.STRETCH]), 0
                while i < len(stretch):
                    j = i + 1
                    while j < len(stretch) and stretch[i : j + 1] in bytes(text):
                        j += 1
                    i, want = j, want + 1
            assert n == want


def test_held_out_accuracy_and_awkward_documents(spark):
    docs = frame(spark, documents(n=150))
    got = language_id.identify(docs)
    assert got.columns == [c for c in docs.columns if c not in ("held_out", "lang_pred", "score")] + ["held_out", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de", "es")
    judged = [r for r in rows if r.held_out and r.doc_id < 1000]
    assert len(judged) > 15 and np.mean([r.lang == r.lang_pred for r in judged]) > 0.95


def test_every_letter_of_the_learned_texts_counts(spark):
    """Two languages of 220 letters, unlike only in words of those that are rare among all."""
    rnd = random.Random(3)
    common = [chr(0x4E00 + i) for i in range(100)]
    own = {g: ["".join(chr(at + 4 * i + k) for k in range(4)) for i in range(30)] for g, at in (("x", 0x5E00), ("y", 0x6E00))}
    rows = []
    for i in range(120):
        lang = rnd.choice("xy")
        parts = rnd.choices(common, k=150) + rnd.choices(own[lang], k=12)
        rnd.shuffle(parts)
        rows.append((i, "".join(parts), lang))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    judged = [r for r in language_id.identify(docs).collect() if r.held_out]
    assert len(judged) > 10 and all(r.lang_pred == r.lang and r.score > 0.05 for r in judged)


def test_letters_learned_of_each_language(spark):
    rows = [(i, prose(random.Random(i), "en", 9_000), f"l{i % 5}") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert language_id.fit(docs, "text", "lang", F.col("doc_id")).lengths == [60_000] * 5


def test_unseen_letters_are_no_separators(spark):
    docs = spark.createDataFrame([(1, "ab", "x"), (2, "жж", None), (3, "!!", None)], "doc_id bigint, text string, lang string")
    order = F.col("doc_id")
    model = language_id.fit(docs, "text", "lang", order)
    parts = [model.symbols[language_id.folded(language_id.code_points(t))] for t in ("жж", "a!b", "ab")]
    assert language_id.phrases(model, parts).ravel().tolist() == [2, 3, 1]


def test_labels_of_held_out_documents_are_not_read(spark):
    docs = frame(spark, documents(n=60))
    other = docs.withColumn("lang", F.when(language_id.split_of("doc_id"), "xx").otherwise(F.col("lang")))
    pick = lambda df: sorted((str(r.doc_id), r.lang_pred, r.score) for r in language_id.identify(df).collect())
    assert pick(docs) == pick(other.withColumn("source", F.lit("q")))


def test_language_without_documents_or_labels(spark):
    assert language_id.identify(frame(spark, [])).count() == 0
    unlabelled = frame(spark, documents(n=8)).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}
    one = spark.createDataFrame([(1, "abc def", "en"), (2, "xyz", None)], "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in language_id.identify(one).collect()} == {"en"}


# --- quality rules --------------------------------------------------------------------------
def plain_counts(text):
    text = text or ""
    w = words(text)
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if words(line):
            repeated_lines += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), repeated_lines, len(covered)


def test_counts_of_awkward_documents(spark):
    docs = frame(spark)
    got = quality_rules.judge(docs, min_rows=10).collect()
    want = Counter()
    for r in docs.collect():
        n, *rest = plain_counts(r.text)
        want[(r.doc_id, n, *rest, n < 20 or 100 * rest[3] > 30 * n)] += 1
    assert Counter(tuple(r[:7]) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)
    assert all(r.kept for r in got if r.d2 is None and not r.base_failed)


def test_outliers_go_and_clean_documents_stay(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(900):
        lang = rnd.choice(["en", "de", "es"])
        text = prose(rnd, lang, rnd.randint(30, 400))
        bad = i % 12 == 0  # in the hot source up to one in twelve
        if bad:
            text = " ".join(w + rnd.choice(["###", "&&&", "$$$"]) for w in words(text))
        rows.append((i, text, lang, "hot" if i % 3 == 0 else f"s{i % 4}", 1, 1, *CLASHING))
    got = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, SCHEMA), min_rows=50).collect()}
    assert all(got[i] == (i % 12 != 0) for i in range(900))


def test_outliers_of_graded_strength(spark):
    """Signs in place of letters, in a source whose other texts have none."""
    rnd = random.Random(11)
    rows = [(i, prose(rnd, "en", rnd.randint(100, 400)), "en", "a", 1, 1, *CLASHING) for i in range(300)]
    base = prose(rnd, "en", 400)
    letters = [i for i, c in enumerate(base) if c.isalpha()]
    for percent in (0, 3, 5, 8, 30):
        text = list(base)
        for i in rnd.sample(letters, len(letters) * percent // 100):
            text[i] = "#"
        rows.append((1000 + percent, "".join(text), "en", "a", 1, 1, *CLASHING))
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    d2 = [got[1000 + p].d2 for p in (0, 3, 5, 8, 30)]
    assert d2 == sorted(d2) and d2[0] < d2[1]
    assert [got[1000 + p].kept for p in (0, 3, 5, 8, 30)] == [True, True, True, True, False]


def test_distances_are_those_of_the_estimate(spark):
    rnd = np.random.default_rng(5)
    x = rnd.multivariate_normal([5, 1, 0, 0.2], np.diag([1, 0.3, 0.2, 0.01]) + 0.05, 4000)
    x[:600] += 25
    rows = spark.createDataFrame([("g", *map(float, v)) for v in x], "`group` string, x1 double, x2 double, x3 double, x4 double")
    floors = (1e-3,) * 4
    estimates = quality_rules.robust_estimates(rows, floors=floors)
    e = estimates.collect()[0]
    centre = np.array([e[f"m{i}"] for i in range(4)])
    lower = np.array([[e[f"l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
    assert np.abs(centre - x[600:].mean(axis=0)).max() < 0.1  # the outliers don't pull it
    scatter = lower @ lower.T
    assert np.allclose(scatter, np.cov(x[600:].T), atol=0.25)
    got = np.array([r.d2 for r in quality_rules._distance(rows.join(estimates, "group")).select("d2", "x1", "x2").collect()])
    want = np.array([(v - centre) @ np.linalg.solve(scatter, v - centre) for v in x])
    assert np.allclose(np.sort(got), np.sort(want), rtol=1e-6)


def test_determinants_are_the_smallest_of_all_subsets(spark):
    rnd = np.random.default_rng(3)
    groups, rows, floor = {}, [], 0.1
    for n in (10, 15):
        h = 6 * n // 10
        x = rnd.normal(0, 1, (n, 4))
        x[h:] = 20 + 3 * rnd.normal(0, 1, (n - h, 4))  # four tenths, all on one side
        groups[f"g{n}"] = min(
            np.linalg.slogdet(quality_rules.CONSISTENCY * np.cov(x[list(s)].T, bias=True) + floor**2 * np.eye(4))[1]
            for s in combinations(range(n), h)
        )
        rows += [(f"g{n}", *map(float, v)) for v in x]
    table = spark.createDataFrame(rows, "`group` string, x1 double, x2 double, x3 double, x4 double")
    got = {r["group"]: r.log_det for r in quality_rules.robust_estimates(table, floors=(floor,) * 4).collect()}
    assert got == pytest.approx(groups, abs=1e-6)


@pytest.mark.parametrize("sizes", [{"en": 150, "de": 40}, {"en": 30, "de": 25}])
def test_small_groups_are_judged_by_all_documents(spark, sizes):
    rnd = random.Random(2)
    rows = []
    for lang, n in sizes.items():
        for i in range(n):
            text = prose(rnd, lang, rnd.randint(60, 300))
            if i % 20 == 0:
                text = " ".join(w + "###" for w in words(text))
            rows.append((len(rows) + 1000 * (i % 20 == 0), text, lang, "s", 1, 1, *CLASHING))
    got = quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == sum(sizes.values()) and all(r.d2 is not None for r in got)
    assert all(r.kept == (r.doc_id < 1000) for r in got)


def test_rules_without_documents(spark):
    assert quality_rules.judge(frame(spark, [])).count() == 0


# --- the quality model --------------------------------------------------------------------------
def labelled(seed=1, n=600):
    """Junk is rare but in site s9, where it is the rule."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        site = "s9" if i % 10 == 9 else f"s{i % 3}"
        junk = rnd.random() < (0.9 if site == "s9" else 0.05)
        text = prose(rnd, rnd.choice(["en", "de"]), rnd.randint(20, 150))
        if junk:
            text = " ".join(w + rnd.choice(["###", "%%%", "!!", "&&&"]) for w in words(text))
        rows.append((i, text, rnd.choice(["en", "de"]), site, 1, 1, *CLASHING))
        labels.append((i, int(not junk)))
    return rows, labels



def levels():
    return {"source": F.col("source"), "lang": F.col("lang")}


def test_quality_of_documents_without_labels(spark):
    rows, labels = labelled()
    docs = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality_model.judge(docs, known, levels()).collect()}
    assert len(got) == len(rows)
    right = [got[i].kept == bool(q) for i, q in labels if i % 3 == 0]
    assert np.mean(right) > 0.97
    assert all(0 < r.score < 1 for r in got.values())
    assert np.mean([got[i].site_prior for i, *_ in rows if i % 10 == 9]) < 0.4
    assert np.mean([got[i].site_prior for i, *_ in rows if i % 10 != 9]) > 0.85


def test_sparse_sites_shrink_towards_the_prior(spark):
    rows, labels = labelled()
    rows = rows + [(5000, rows[0][1], "en", "lonely", 1, 1, *CLASHING)]
    known = spark.createDataFrame([*labels, (5000, 0)], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality_model.judge(spark.createDataFrame(rows, SCHEMA), known, levels()).collect()}
    overall = np.mean([q for _, q in labels])
    assert abs(got[5000].site_prior - overall) < 0.1


def test_model_of_awkward_documents(spark):
    docs = frame(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (1001, 0), (1005, 0), (None, 0), (7, None)], "doc_id bigint, quality int")
    got = quality_model.judge(docs, labels, levels())
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in docs.collect())
    assert all(0 < r.score < 1 for r in got.collect())
    neutral = quality_model.judge(docs, labels.limit(0), levels()).collect()
    assert all(abs(r.evidence - 0.5) < 1e-9 for r in neutral)
    assert quality_model.judge(frame(spark, []), labels, levels()).count() == 0


def test_url_levels(spark):
    df = spark.createDataFrame([("http://A.example/x/y?z",), ("no url",), (None,)], "url string")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in quality_model.url_levels("url").items()]).collect()]
    assert got[0] == ("a.example", "x") and got[2] == (None, None)


# --- LM scores -------------------------------------------------------------------------------------
def plain_scores(texts, order, min_count=2, backoff=0.4):
    counts = [Counter() for _ in range(order)]
    for t in texts:
        w = words(t)
        for n in range(order):
            counts[n].update(tuple(w[i : i + n + 1]) for i in range(len(w) - n))
    total = sum(counts[0].values())
    out = []
    for t in texts:
        w, score = words(t), 0.0
        for i in range(len(w)):
            penalty = 0.0
            for n in range(min(i, order - 1), -1, -1):
                gram = tuple(w[i - n : i + 1])
                if n == 0:
                    score += penalty + math.log(counts[0][gram] / total)
                elif counts[n][gram] >= min_count:
                    score += penalty + math.log(counts[n][gram] / counts[n - 1][gram[:-1]])
                    break
                else:
                    penalty += math.log(backoff)
        out.append(score if w else None)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, order, monkeypatch):
    docs = frame(spark)
    texts = [r.text for r in docs.collect()]
    got = lm_score.score_documents(docs, order, chunk_bytes=20_000, bucket_bytes=4_000)
    # Texts tell rows apart, ids don't.
    want = Counter((r.doc_id, len(words(r.text)), None if s is None else round(s, 6)) for r, s in zip(docs.collect(), plain_scores(texts, order), strict=True))
    assert Counter((r.doc_id, r.n_words, None if r.log_score is None else round(r.log_score, 6)) for r in got.collect()) == want


def test_query_scores_longer_phrases(spark, tmp_path):
    texts = [r[1] for r in documents(n=40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.log_score for r in queries.op4_lm_score(spark, str(tmp_path)).collect()}
    for i, want in enumerate(plain_scores(texts, 3)):
        assert (got[i] is None) == (want is None) and (want is None or abs(got[i] - want) < 1e-6)
    pairs = plain_scores(texts, 2)
    assert any(p is not None and abs(got[i] - p) > 1e-3 for i, p in enumerate(pairs))


def test_scores_without_documents_or_words(spark):
    assert lm_score.score_documents(frame(spark, [])).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id bigint, text string")
    assert [r.log_score for r in lm_score.score_documents(blank).collect()] == [None, None]


def test_packed_counts_and_keys():
    counts = np.array([1, 254, 255, 256, 2**40, 0])
    assert lm_score._unpack_counts(lm_score._pack_counts(counts), 6).tolist() == counts.tolist()
    rng = np.random.default_rng(0)
    for n in (0, 1, 100, 3000, 90_000):  # codes of different widths
        keys = np.sort(rng.integers(0, 2**55, n).astype(np.uint64)) | np.uint64(7 << 56)
        keys = np.sort(np.concatenate([keys, keys[:3]]))  # equal keys stay apart
        back = lm_score._unpack_keys(lm_score._pack_keys(keys, 8), len(keys))
        expected = (keys << np.uint64(8)) >> np.uint64(64 - 8 * lm_score.HASH_BYTES)
        assert back.tolist() == expected.tolist()


def test_packed_keys_and_counts_are_short():
    rng = np.random.default_rng(1)
    for n in (600, 9_000, 40_000):
        keys = np.unique(rng.integers(0, 2**56, n).astype(np.uint64))
        least = 48 - np.log2(n) + 1.44  # bits of a set of 48-bit numbers
        assert 8 * len(lm_score._pack_keys(keys, 8)) / len(keys) < least + 0.6
    counts = rng.geometric(0.8, 9_000)
    assert len(lm_score._pack_counts(counts)) < 0.25 * len(counts)


def test_distinct_ngrams_range_by_range():
    rng = np.random.default_rng(2)
    grams = [rng.choice(rng.integers(0, 2**63, 50).astype(np.uint64) * np.uint64(2), n) for n in (200, 0, 90)]
    parts = list(lm_score._distinct(grams))
    values, counts = np.unique(np.concatenate(grams), return_counts=True)
    assert np.concatenate([v for v, _, _ in parts]).tolist() == values.tolist()
    assert np.concatenate([c for _, c, _ in parts]).tolist() == counts.tolist()
    for v, _, found in parts:
        for gram, (places, which) in zip(grams, found, strict=True):
            assert gram[places].tolist() == v[which].tolist()
