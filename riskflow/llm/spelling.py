"""Spelling variants: words one edit apart, found through a reduced alphabet.

Every letter is hashed to one of a few symbols, so a word becomes a shorter code that
survives any edit as an edit of its own (or as none at all, if a replaced letter keeps its
symbol). The full one-edit neighbourhood of each reduced word (itself, every deletion,
replacement and insertion over the few symbols) is generated and joined to the reduced
vocabulary. Two words that are one edit apart always meet; others that meet are sorted out
on the original strings. Each neighbour is generated once: a deletion or an insertion in a
run of equal symbols only at the run's start.

Most neighbours are no reduced word at all. Before they are joined they are looked up in a
bitmap of all reduced words (a Bloom filter of at most `FILTER_BITS` bits, whatever the
vocabulary), which lets through each that is one and a few others.

Neighbours are 64-bit hashes made of prefix sums, so a word of L letters costs rows of 16
bytes in proportion to L, not L * L letters; a collision adds a candidate and loses none.

Defined results: NULL or empty texts and texts without a run of letters give no words; rows
that repeat an id are documents each; a NULL id counts as the empty id; an empty table
gives no words; other columns are ignored, whatever their names; ties of the most frequent
near word go to the smallest in code-point order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.words import mix, powers
from riskflow.sources.tables import stored

LETTERS = r"[A-Za-zÀ-ÿ]+"
#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: Letters of reduced words (and rows of neighbours times a few dozen) handled at a time.
SLICE_LETTERS = 1 << 15
#: Bits of the filter for each word, and at most (64 MB); two are set for each word.
BITS_PER_WORD = 32
FILTER_BITS = 1 << 29
#: Bits of a bitmap that Spark builds in one piece.
PIECE_BITS = 1 << 15


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 7,
    min_count: int = 2,
    slip_every: int | None = None,
) -> DataFrame:
    """(word, n): runs of letters of whole texts, A-Z lower-cased, with their occurrences.

    With `slip_every`, runs lose one letter where that number divides the CRC-32 of
    `<id>:<run>`, the letter at this hash modulo the run's length: a fixed share of
    misspellings that is the same on every run.
    """
    run = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0)))
    words = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("word"))
    words = words.filter(F.length("word") >= min_length).select(
        "id", F.translate("word", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("word")
    )
    if slip_every is not None:
        hashed = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = F.pmod("h", F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = words.withColumn("h", hashed).select(
            F.when(F.col("h") % slip_every == 0, cut).otherwise(F.col("word")).alias("word")
        )
        words = words.filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _symbols(letters: np.ndarray, symbols: int) -> np.ndarray:
    return mix(letters.astype(np.uint64)) % np.uint64(symbols) + np.uint64(1)


def _key(sums: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix(sums ^ mix(length.astype(np.uint64))).view(np.int64)


def _reduced(words: list[str], symbols: int):
    """Symbols of all words in a row, each word's start, and weighted prefix sums per word."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words))
    start = np.concatenate(([0], np.cumsum(length)))
    owner = np.repeat(np.arange(len(words)), length)
    place = np.arange(len(letters)) - start[owner]
    up, _ = powers(int(length.max(initial=0)) + 1)
    symbol = _symbols(letters, symbols)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(symbol * up[place], dtype=np.uint64)))
    return symbol, length, start, owner, place, sums


def _neighbours(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word's number, key) of the reduced words at most one edit from each reduced word."""
    symbol, length, start, owner, place, sums = _reduced(words, symbols)
    up, down = powers(int(length.max(initial=0)) + 1)
    total = sums[start[1:]] - sums[start[:-1]]
    numbers = np.arange(len(words))
    yield numbers, _key(total, length)

    before = sums[:-1] - sums[start[owner]]  # of the word's symbols before each place
    weight = up[place]
    first = np.ones(len(symbol), bool)  # of a run of equal symbols
    first[1:] = (symbol[1:] != symbol[:-1]) | (place[1:] == 0)
    i = np.flatnonzero(first)
    w = owner[i]
    rest = total[w] - before[i] - symbol[i] * weight[i]
    yield w, _key(before[i] + rest * down[1], length[w] - 1)
    for c in range(1, symbols + 1):
        c = np.uint64(c)
        i = np.flatnonzero(symbol != c)
        w = owner[i]
        yield w, _key(total[w] + (c - symbol[i]) * weight[i], length[w])
        # Before each place, but not behind the same symbol; and at the end.
        fresh = np.ones(len(symbol), bool)
        fresh[1:] = (symbol[:-1] != c) | (place[1:] == 0)
        i = np.flatnonzero(fresh)
        w = owner[i]
        inserted = before[i] + c * weight[i] + (total[w] - before[i]) * up[1]
        yield w, _key(inserted, length[w] + 1)
        w = numbers[(length == 0) | (symbol[np.maximum(start[1:] - 1, 0)] != c)]
        yield w, _key(total[w] + c * up[length[w]], length[w] + 1)


def _slices(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, run, size = 0, [], 0
    for i, word in enumerate(words):
        if run and size + len(word) > SLICE_LETTERS:
            yield first, run
            first, run, size = i, [], 0
        run.append(word)
        size += len(word)
    if run:
        yield first, run


def _known_words(reduced: DataFrame, words: int) -> np.ndarray:
    """The filter of the keys of all reduced words, as bytes: a power of two of bits."""
    bits = PIECE_BITS
    while bits < min(words * BITS_PER_WORD, FILTER_BITS):
        bits *= 2
    place = lambda shift: F.shiftrightunsigned("key", shift).bitwiseAND(F.lit(bits - 1))
    places = reduced.select(F.explode(F.array(place(0), place(32))).alias("at"))
    piece = F.floor(F.col("at") / PIECE_BITS).alias("piece")
    built = places.groupBy(piece).agg(F.bitmap_construct_agg(F.col("at") % PIECE_BITS).alias("bitmap"))
    known = np.zeros(bits // 8, np.uint8)
    for r in built.collect():  # at most FILTER_BITS / PIECE_BITS pieces
        low = r["piece"] * PIECE_BITS // 8
        known[low : low + PIECE_BITS // 8] = np.frombuffer(r["bitmap"], np.uint8)
    return known


def _is_known(known: np.ndarray, key: np.ndarray) -> np.ndarray:
    key, mask = key.view(np.uint64), np.uint64(8 * len(known) - 1)
    found = np.ones(len(key), bool)
    for shift in (0, 32):
        at = (key >> np.uint64(shift)) & mask
        found &= (known[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _neighbour_rows(symbols: int, known: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.asarray(batch.column(0))
            for first, run in _slices(batch.column(1).to_pylist()):
                for number, key in _neighbours(run, symbols):
                    hit = _is_known(known, key)
                    number, key = number[hit], key[hit]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(codes[first + number]), pa.array(key)], ["code", "key"]
                    )

    return rows


def _reduced_rows(symbols: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, run in _slices(batch.column(0).to_pylist()):
                _, length, start, _, _, sums = _reduced(run, symbols)
                key = _key(sums[start[1:]] - sums[start[:-1]], length)
                part = batch.slice(first, len(run))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), *part.columns], ["key", "near", "near_n"]
                )

    return rows


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n): all pairs of `words` (word, n) one edit apart, both ways.

    `words` is read several times, so it should be a stored table.
    """
    coded = words.select(F.xxhash64("word").alias("code"), "word", "n")
    reduced = words.select("word", "n").mapInArrow(
        _reduced_rows(symbols), "key bigint, near string, near_n bigint"
    )
    known = _known_words(reduced, words.count())
    neighbours = coded.select("code", "word").mapInArrow(
        _neighbour_rows(symbols, known), "code bigint, key bigint"
    )
    met = neighbours.join(reduced, "key").select("code", "near", "near_n")
    # Two words may share a code: the strings decide.
    return met.join(coded, "code").filter(F.levenshtein("word", "near", 1) == 1).select(
        "word", "n", "near", "near_n"
    )


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) by pointer doubling: each round follows twice as many forms at once."""
    reach = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        onward = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reach = reach.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")
        )
        reach = stored(reach, "spelling-roots")
    return reach


def variant_groups(words: DataFrame, ratio: int = 10, symbols: int = SYMBOLS) -> DataFrame:
    """`words` (word, n; words are distinct) with n_near, form, form_n and root.

    `form` is a word's most frequent near word, if that is at least `ratio` times as
    frequent as the word; `root` follows forms to the last. As each form is `ratio` times
    as frequent as its word, chains are no longer than the logarithm of the largest count.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = stored(words.select("word", F.col("n").cast("bigint").alias("n")), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    near = near_words(words, symbols).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best")
    )
    near = stored(
        near.select(
            "word",
            "n_near",
            F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best.near")).alias("form"),
            F.when(-F.col("best.n") >= ratio * F.col("n"), -F.col("best.n")).alias("form_n"),
        ),
        "spelling-near",
    )
    most = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(near.filter(F.col("form").isNotNull()), math.ceil(math.log(most, ratio)))
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            "form_n",
        )
    )
