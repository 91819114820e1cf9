"""Removing passages that already stand in a document with a smaller id, exactly.

A passage counts from `window` words on. Hashing every window of the corpus is dear, so
shorter anchors are hashed first, only at positions that a difference cover selects: the
period is 31 and the cover {1, 5, 11, 24, 25, 27} meets every difference modulo 31. For
any two equal windows there is an offset below 31 at which both have an anchor, and as
anchors are window - 30 words long, these anchors lie inside and are equal. Hence only
windows around an anchor that several documents share are hashed in full (the extension
of the match); the smallest document of each full window decides.

Both passes send one row per distinct hash and batch of documents through a shuffle:
what a batch can settle by itself (two of its documents share the hash) it settles, so a
passage that stands in a third of all documents makes few rows. Spans to cut are listed
per document and joined to the texts.

Defined results: NULL text has no words; documents with a NULL id neither lose words nor
take them from others; rows that repeat an id are one document to each other; texts with
fewer words than a window stay whole; an empty table gives no rows; other columns are
passed through, but those with the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.llm.words import mix, running, slices, spans, tidy, utf8, word_hashes

PERIOD = 31
RESULTS = ("n_words", "n_removed", "kept_text")
COVER = (1, 5, 11, 24, 25, 27)

_IN_COVER = np.zeros(PERIOD, bool)
_IN_COVER[list(COVER)] = True


def _hashes(run: list[bytes], length: int, sampled: bool) -> tuple[np.ndarray, ...]:
    """Hash, document and first word (counted over the run) of windows of `length` words."""
    words, begins = word_hashes(run)
    sums = running(words)
    n = np.diff(begins)
    doc = np.repeat(np.arange(len(run)), n)
    place = np.arange(len(words)) - begins[doc]
    at = place + length <= n[doc]
    if sampled:
        at &= _IN_COVER[place % PERIOD]
    start = np.flatnonzero(at)
    return spans(sums, start, start + length), doc[start], start, begins


def _listed(hashes: np.ndarray, doc: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which hashes are in their document's list (NULL: an empty one)."""
    owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
    listed = np.asarray(lists.flatten()).view(np.uint64)
    pair = lambda h, d: mix(h ^ mix(d.astype(np.uint64)))
    return np.isin(pair(hashes, doc), pair(listed, owner))


def _batch_rows(hashes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """One row (key, hash, doc) for the smallest document of each hash, and one for every
    further document of it in this batch, under a key of its own as it is settled."""
    order = np.lexsort((ids, hashes))
    hashes, ids = hashes[order], ids[order]
    new_hash = np.ones(len(hashes), bool)
    new_hash[1:] = hashes[1:] != hashes[:-1]
    new = new_hash.copy()
    new[1:] |= ids[1:] != ids[:-1]
    hashes, ids, first = hashes[new], ids[new], new_hash[new]
    key = np.where(first, hashes, mix(hashes ^ mix(ids.astype(np.uint64))))
    shared = np.zeros(len(hashes), bool)  # with another document of the batch
    shared[:-1] |= ~first[1:]
    shared |= ~first
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(hashes.view(np.int64)), pa.array(ids), pa.array(shared), pa.array(~first)],
        ["key", "hash", "doc", "shared", "later"],
    )


_ROW = "key bigint, hash bigint, doc bigint, shared boolean, later boolean"


def _anchor_rows(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            found = [(np.empty(0, np.uint64), np.empty(0, np.int64))]
            for first, run in slices(utf8(batch.column(1))):
                hashes, doc, _, _ = _hashes(run, length, sampled=True)
                found.append((hashes, ids[first + doc]))
            yield _batch_rows(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return rows


def _window_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(2).is_valid())
            ids, anchors = np.asarray(batch.column(0)), batch.column(2)
            found = [(np.empty(0, np.uint64), np.empty(0, np.int64))]
            for first, run in slices(utf8(batch.column(1))):
                length = window - PERIOD + 1
                hashes, doc, start, begins = _hashes(run, length, sampled=True)
                known = anchors.slice(first, len(run))
                hit = _listed(hashes, doc, known)
                # Windows that begin at most PERIOD - 1 words before a shared anchor.
                near = np.zeros(begins[-1] + 1, np.int64)
                np.add.at(near, np.maximum(start[hit] - PERIOD + 1, begins[doc[hit]]), 1)
                np.add.at(near, start[hit] + 1, -1)
                near = np.cumsum(near) > 0
                hashes, doc, start, _ = _hashes(run, window, sampled=False)
                keep = near[start]
                found.append((hashes[keep], ids[first + doc[keep]]))
            yield _batch_rows(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return rows


def _settled(rows: DataFrame) -> DataFrame:
    """(doc, hash) rows with `least`, the smallest document that has the hash, and `most`.

    Rows that a batch has settled carry a key of their own: they pass by alone.
    """
    same = W.partitionBy("key")
    return rows.withColumns({"least": F.min("doc").over(same), "most": F.max("doc").over(same)})


def _cut(window: int):
    """Per text: number of words, number removed, and what is left of the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed = batch.column(2)
            given = batch.column(1).is_valid().to_pylist()
            n_words, n_removed, kept = [], [], []
            for first, run in slices(utf8(batch.column(1))):
                known = removed.slice(first, len(run))
                hashes, doc, start, begins = _hashes(run, window, sampled=False)
                hit = _listed(hashes, doc, known)
                covered = np.zeros(begins[-1] + 1, np.int64)
                np.add.at(covered, start[hit], 1)
                np.add.at(covered, start[hit] + window, -1)
                covered = np.cumsum(covered)[:-1] > 0
                for i, text in enumerate(run):
                    gone = covered[begins[i] : begins[i + 1]]
                    n_words.append(len(gone))
                    n_removed.append(int(gone.sum()))
                    if n_removed[-1]:
                        text = _without(text, gone)
                    kept.append(text if given[first + i] else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[3:], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
                [*batch.schema.names[3:], "n_words", "n_removed", "kept_text"],
            )

    return rows


def _without(text: bytes, gone: np.ndarray) -> bytes:
    """A text without some words; each goes with the white space after it."""
    from riskflow.llm.words import _SPACE

    data = np.frombuffer(text + b" ", np.uint8)
    start = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data])).astype(np.int8)) == -1)
    drop = np.zeros(len(text) + 1, np.int8)
    ends = np.append(start[1:], len(text))
    np.add.at(drop, start[gone], 1)
    np.add.at(drop, ends[gone], -1)
    return data[:-1][np.cumsum(drop)[:-1] == 0].tobytes()


def remove_repeats(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` (without its text) with n_words, n_removed and kept_text.

    A word goes if a window of `window` words that covers it also starts in a document
    with a smaller id. Windows are judged on the input. `window` is more than 31.
    """
    if window <= PERIOD:
        raise ValueError(f"window must be more than {PERIOD} words")
    others = [c for c in docs.columns if c not in (text_col, *RESULTS)]
    # Positions, not names: a column of any name may be passed through.
    passed = docs.select(
        F.col(id_col).cast("bigint").alias("__id"),
        F.col(text_col).alias("__text"),
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)]).alias("__rest"),
    )
    known = passed.filter(F.col("__id").isNotNull()).select("__id", "__text")

    anchors = _settled(known.mapInArrow(tidy(_anchor_rows(window - PERIOD + 1)), _ROW))
    shared = anchors.filter(F.col("shared") | (F.col("least") != F.col("most")))
    per_doc = shared.groupBy("doc").agg(F.collect_set("hash").alias("anchors"))

    # Both joins take the same columns of the same rows, so the texts are shuffled once.
    near = passed.join(per_doc, passed["__id"] == per_doc["doc"], "left")
    found = near.select("__id", "__text", "anchors", "__rest").mapInArrow(
        tidy(_window_rows(window)), _ROW
    )
    windows = _settled(found)
    late = windows.filter(F.col("later") | (F.col("least") < F.col("doc")))
    removed = late.groupBy("doc").agg(F.collect_set("hash").alias("removed"))

    joined = passed.join(removed, passed["__id"] == removed["doc"], "left")
    rest = passed.schema["__rest"].dataType.simpleString()
    cut = joined.select("__id", "__text", "removed", "__rest").mapInArrow(
        tidy(_cut(window)), f"__rest {rest}, n_words bigint, n_removed bigint, kept_text string"
    )
    return cut.select(
        *[F.col(f"__rest.c{i}").alias(c) for i, c in enumerate(others)],
        F.col("n_words").alias("n_words"),
        "n_removed",
        "kept_text",
    )


def kept_digest(kept_text: str = "kept_text"):
    """SHA-256 of the kept words, joined by one space."""
    words = F.regexp_replace(F.coalesce(F.col(kept_text), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.sha2(F.trim(words).cast("binary"), 256)
