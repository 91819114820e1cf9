"""Best-fit packing of documents into sequences under several capacities at once.

Documents become token ids, cut at the sequence length; only pieces of documents that
are longer than a sequence are cut. A sequence has capacities for tokens, documents and
attention cost (sum of squared piece lengths). Pieces are dealt evenly over tasks. Each
task takes its pieces from the longest to the shortest and puts each into the open
sequence that satisfies every constraint and fits best: by the weighted norm of what
would be left, or by the weighted dot product of the piece with what is left.

Defined results: NULL text is an empty document, which is one piece of the end token;
repeated rows and NULL ids are packed as rows of their own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.words import tidy
from riskflow.sources.tables import stored

PIECES_PER_TASK = 65_536
#: Distinct words whose ids a Python worker keeps.
CACHED_WORDS = 400_000
#: Texts whose words are looked up together, and new words encoded together.
TEXTS_AT_A_TIME = 256
WORDS_AT_A_TIME = 1024

#: What the tokenizer cuts between, by byte.
_GAP, _LETTER, _DIGIT, _SIGN = range(4)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[list(b" \t\n\v\f\r")] = _GAP
_KIND[list(string.ascii_letters.encode())] = _LETTER
_KIND[list(string.digits.encode())] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@cache
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _word_ids(path: str) -> WordIds:
    """One cache per Python worker, which later tasks find filled."""
    return WordIds(path)


def pre_tokens(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The tokenizer's own cuts: distinct pre-tokens, the number of each, where each text begins.

    The tokenizer lowers case, drops white space and cuts between letters, signs and single
    digits, but keeps endings like 's and 'll whole. That is done here on bytes, for ASCII and
    the letters \u00c0 to \u00ff; words with other characters, or with what may be a special
    token, are left whole and as they are.
    """
    data = np.frombuffer(b" ".join(texts) + b"  ", np.uint8)
    kind, low, odd = _KIND[data], _LOWER[data], data >= 0x80
    second = np.flatnonzero(data == 0xC3) + 1
    second = second[(data[second] != 0x97) & (data[second] != 0xB7)]  # two signs among the letters
    for place in (second - 1, second):
        kind[place], odd[place] = _LETTER, False
    low[second[data[second] <= 0x9E]] += 0x20
    before = np.concatenate((_KIND[[0x20]], kind[:-1]))
    inside = kind != _GAP
    first = inside & ((kind != before) | (kind == _DIGIT))
    quotes = np.flatnonzero((low == ord("'")) & (before != _SIGN))
    ending = low[quotes + 1].astype(np.uint16) << 8
    short = quotes[np.isin(ending >> 8, list(b"stmd"))]
    long = quotes[np.isin(ending + low[quotes + 2], [int.from_bytes(x) for x in (b"re", b"ve", b"ll")])]
    after = np.concatenate((short + 2, long + 3))
    first[np.concatenate((short, long)) + 1] = False
    first[after] |= kind[after] == _LETTER
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    if odd.any():
        opens = inside & (before == _GAP)
        word = np.cumsum(opens)
        whole = np.zeros(word[-1] + 1, bool)
        whole[word[odd]] = True
        whole = whole[word] & inside
        first, low = np.where(whole, opens, first), np.where(whole, data, low)
    starts = np.flatnonzero(first)
    ends = np.append((np.cumsum(inside) - 1)[starts], np.count_nonzero(inside))
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(low[inside])]
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.searchsorted(starts, begins)


class WordIds(dict):
    """Token ids of pre-tokens: numbers of pre-tokens, whose ids lie in one array.

    The tokenizer never joins across the cuts, so the ids of a text are those of its
    pre-tokens one after another. Each is found once per Python worker, until there are too
    many. New ones that are one pre-token each are encoded together, as just their last ids
    close a word.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = _tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.clear()
        #: Ids of all words, and where those of each word end.
        self.flat, self.ends = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def _encode(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _add(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        self.update(zip(words, range(len(self), len(self) + len(words)), strict=True))
        self.ends = np.concatenate((self.ends, len(self.flat) + ends))
        self.flat = np.concatenate((self.flat, ids))

    def learn(self, words: list[bytes]) -> None:
        single, odd = [], []
        for word in words:
            plain = word.isascii() and b"<|" not in word
            (single if plain or word.decode().isalpha() else odd).append(word)
        for at in range(0, len(single), WORDS_AT_A_TIME):
            some = single[at : at + WORDS_AT_A_TIME]
            ids = np.array(self._encode([b" ".join(some).decode()])[0].ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(some):
                self._add(some, ids, ends)
            else:  # not a word to the tokenizer after all
                odd += some
        if odd:
            codes = [np.array(c.ids, "<u4") for c in self._encode([w.decode() for w in odd])]
            self._add(odd, np.concatenate(codes), np.cumsum([len(c) for c in codes]))

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of every text; the words that are new are found together."""
        words, which, begins = pre_tokens(texts)
        fresh = [w for w in words if w not in self]
        if len(self) + len(fresh) > CACHED_WORDS:
            self.forget()
            fresh = words
        self.learn(fresh)
        number = np.fromiter(map(self.__getitem__, words), np.int64, len(words))[which]
        low, lengths = self.ends[number], self.ends[number + 1] - self.ends[number]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        flat = self.flat[np.arange(ends[-1]) + np.repeat(low - ends[:-1], lengths)]
        return np.split(flat, ends[begins[1:-1]])


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    max_tokens: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Token pieces: id, piece (from 0), start, length, ids_crc32; with `with_ids` the ids."""
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    end = np.array([end_id], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _word_ids(tokenizer_path)
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for at in range(0, batch.num_rows, TEXTS_AT_A_TIME):
                keys, texts = batch.slice(at, TEXTS_AT_A_TIME).columns
                some = [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]
                for key, ids in zip(keys.to_pylist(), known.ids(some), strict=True):
                    ids = np.append(ids, end)
                    for piece, low in enumerate(range(0, len(ids), max_tokens)):
                        own = ids[low : low + max_tokens]
                        row = [key, piece, low, len(own), zlib.crc32(own)]
                        if with_ids:
                            row.append(own.astype(np.int32))
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(x, t)
                    for x, t in zip(
                        out,
                        [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())],
                        strict=False,
                    )
                ],
                names,
            )

    schema = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        tidy(cut), schema + ", ids array<int>" * with_ids
    )


def best_fit(
    lengths: np.ndarray,
    capacity: tuple[float, float, float],
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece, longest pieces first.

    `capacity`: tokens, documents, attention cost. A piece goes to the bin that has
    room under all three and, in units of the capacities, leaves the smallest weighted
    norm of what remains (`norm`) or has the largest weighted dot product of piece and
    remainder (`dot`). With no such bin it opens one.
    """
    tokens, documents, attention = capacity
    scale = np.array(weights) / np.square([tokens, documents, attention])
    bins, offsets = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    shortest = int(lengths.min()) if len(lengths) else 0
    # What is left in the open bins, kept without gaps in the first n places.
    left = np.empty((3, len(lengths) + 1))
    names = np.empty(len(lengths) + 1, np.int64)
    n = opened = 0
    for i in order:
        size = float(lengths[i])
        cost = size * size
        fits = np.flatnonzero(
            (left[0, :n] >= size) & (left[1, :n] >= 1) & (left[2, :n] >= cost)
        )
        if len(fits):
            t, d, a = left[0, fits], left[1, fits], left[2, fits]
            if rule == "norm":
                score = scale[0] * (t - size) ** 2 + scale[1] * (d - 1) ** 2 + scale[2] * (a - cost) ** 2
                at = fits[score.argmin()]
            else:
                score = scale[0] * t * size + scale[1] * d + scale[2] * a * cost
                at = fits[score.argmax()]
        else:
            at, n = n, n + 1
            left[:, at] = tokens, documents, attention
            names[at] = opened
            opened += 1
        bins[i], offsets[i] = names[at], tokens - left[0, at]
        left[:, at] -= size, 1, cost
        if left[0, at] < shortest or left[1, at] < 1 or left[2, at] < shortest * shortest:
            n -= 1
            left[:, at], names[at] = left[:, n], names[n]
    return bins, offsets


def pack(
    pieces: DataFrame,
    max_tokens: int = 4096,
    max_documents: int | None = None,
    max_attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    rule: str = "norm",
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """`pieces` with sequence_id and offset. Unset capacities bind no sequence.

    `pieces` is read twice (to count it and to pack it), so it should be a stored table.
    Rows are dealt evenly and without regard to their content over as many tasks as
    `pieces_per_task` asks for; each leaves about one sequence partly filled.
    """
    capacity = (
        float(max_tokens),
        float(max_documents or max_tokens),
        float(max_attention or max_tokens**2),
    )
    tasks = max(1, -(-pieces.count() // pieces_per_task))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        lengths = np.asarray(table.column("length"))
        # A piece that can't even be alone under the capacities has a sequence to itself.
        alone = (lengths >= capacity[0]) | (lengths.astype(float) ** 2 > capacity[2])
        bins, offsets = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        some = np.flatnonzero(~alone)
        bins[some], offsets[some] = best_fit(lengths[some], capacity, weights, rule)
        first = int(bins[some].max()) + 1 if len(some) else 0
        bins[alone] = first + np.arange(alone.sum())
        task = TaskContext.get().partitionId()
        table = table.append_column("sequence_id", pa.array(bins + (task << 32), pa.int64()))
        table = table.append_column("offset", pa.array(offsets, pa.int64()))
        yield from table.to_batches(max_chunksize=10_000)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return pieces.repartition(tasks).mapInArrow(
        packed, f"{schema}, sequence_id bigint, offset bigint"
    )


def packed_documents(
    docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    cut = stored(pieces(docs, tokenizer_path, max_tokens, id_col=id_col, text_col=text_col), "pieces")
    return pack(cut, max_tokens, **options).withColumnRenamed("id", id_col)
