"""The pipeline, stage by stage, against plain versions on what the stage before kept."""

from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from cases import SCHEMA, documents, words
from test_dedup import linked, without_repeats
from test_mixing import reshared
from tokenizers import Tokenizer

from riskflow.llm import words as words_module
from riskflow.sources.tables import stored


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.createDataFrame(documents(seed=7), SCHEMA)
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), name)
        if name != "packing":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        out.append(docs.collect())
    return out


def test_language_stage_rejects_what_has_no_letter(stages):
    before, after = stages[0], stages[1]
    want = [r for r in before if any(c.isalpha() for c in r.text or "")]
    assert Counter((r.doc_id, r.text, r.lang) for r in after) == Counter((r.doc_id, r.text, r.lang) for r in want)


@pytest.mark.parametrize("label", [None, "und"])
def test_language_stage_keeps_letters_where_no_language_is_known(spark, label):
    docs = spark.createDataFrame([(*r[:2], label, *r[3:]) for r in documents(n=12)], SCHEMA)
    after = corpus_pipeline.known_language(spark, docs, "").collect()
    want = [r for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert want and Counter((r.doc_id, r.text) for r in after) == Counter((r.doc_id, r.text) for r in want)


def test_one_document_of_each_group_stays(stages):
    before, after = stages[1], stages[2]
    component, _ = linked([(r.doc_id, r.text) for r in before], 5)
    want = [r for r in before if r.doc_id is None or component[r.doc_id] == r.doc_id]
    assert Counter(map(tuple, after)) == Counter(map(tuple, want))
    assert len(after) < len(before)


def test_repeated_passages_are_cut(stages):
    before, after = stages[2], stages[3]
    cut = without_repeats([(r.doc_id, r.text) for r in before], 50)
    want = Counter((i, n - gone) for i, n, gone, _ in cut if gone == 0 or gone < n)
    assert Counter((r.doc_id, len(words(r.text))) for r in after) == want
    assert all(r.n_chars == len(r.text) for r in after if r.doc_id is not None and r.doc_id < 900 and r.doc_id != 5)


def test_sources_meet_their_targets(stages):
    before, after = stages[3], stages[4]
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += len(words(r.text))
    for r in after:
        taken[r.source] += len(words(r.text))
    for source, target in reshared(sizes).items():
        assert abs(taken[source] - target) < 1.5


def test_packed_tokens_are_those_of_the_mix(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in stages[4]:
        n = len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
        want.update((r.doc_id, p, min(4096, n - s)) for p, s in enumerate(range(0, n, 4096)))
    assert Counter((r.doc_id, r.piece, r.length) for r in stages[5]) == want
    per_sequence = Counter()
    for r in stages[5]:
        per_sequence[r.sequence_id] += r.length
    assert max(per_sequence.values()) <= 4096
    assert len(per_sequence) <= np.ceil(sum(per_sequence.values()) / 4096) + 1


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), name)
    assert docs.count() == 0


def test_language_stage_rejects_strings_and_unlearned_scripts(spark):
    docs = spark.createDataFrame(documents(seed=7), SCHEMA)
    strings = np.random.default_rng(3).choice(list("qxzjkvwy"), (40, 9))
    unlearned = ["и снова он шёл домой по улице " * 12, " ".join(map("".join, strings))]
    odd = [(5000 + i, text, None, "src0", len(text), *[None] * 12) for i, text in enumerate([*unlearned, "Hello", "Да"])]
    kept = corpus_pipeline.known_language(spark, docs.union(spark.createDataFrame(odd, SCHEMA)), "")
    assert sorted(r.doc_id for r in kept.collect() if (r.doc_id or 0) >= 5000) == [5002, 5003]


def test_stages_hand_texts_over_in_small_batches(spark):
    docs = spark.createDataFrame(documents(n=12), SCHEMA)
    before = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(corpus_pipeline.BATCH_SETTING, before)
            stage(spark, docs, "")
            assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == str(corpus_pipeline.BATCH_ROWS)
    finally:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, before)


def test_tasks_give_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(words_module, "give_back", lambda: calls.append("free"))

    def task(batches):
        for b in batches:
            calls.append(b)
            yield -b

    assert list(words_module.tidy(task)([1, 2])) == [-1, -2]
    assert calls == ["free", 1, 2, "free"]
