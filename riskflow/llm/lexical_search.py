"""Ranked lexical search: bit-sliced Bloom signatures bound the scores, texts decide them.

The index deals documents into blocks of similar size. A block is a bit matrix: a row (slice)
per signature bit, a column per document. A term sets a few bits of its document, and again
under its level for each of `LEVELS` that its occurrences reach. For a query, the slices of a
term's bits are and-ed: a bitmap of the documents that may hold the term, at each level, which
overstates both presence and occurrences but never understates them. Each term's weight times
the most that its level allows is summed over the bitmaps: an upper bound of the score.

The documents with the largest bounds are scored from their texts first; the k-th best of
these scores is a floor, and each document whose bound reaches it is scored from its text.
A document left out is provably worse than k others, so the ranking is exact (up to
collisions of 64-bit term hashes). Items are taken in blocks of about `QUERY_TERMS` terms,
which bounds what is sent to each task; every block of items meets every document.

Defined results: NULL or empty texts and texts without a term are no documents and no
queries; each row is a document of its own, with its own rank where ids repeat; equal scores
go by ascending id, NULL last; repeated rows of an item are one item, and rows that share an
item's id with another text are items of their own; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.words import mix, running, slices, spans
from riskflow.sources.tables import stored

#: Occurrences from which a term is also entered under a level.
LEVELS = (1, 2, 3, 5, 9, 17)
#: Bits of a signature per entry of the fullest document of its block, and bits set by each.
BITS_PER_ENTRY = 12
BITS_SET = 3
#: Documents of a block, and bits of its matrix at most (a huge document may be alone).
BLOCK_DOCS = 512
BLOCK_BITS = 1 << 23
#: Terms of the items that are searched for at a time, and of those bounded at a time.
QUERY_TERMS = 1 << 20
PAIRS = 1 << 11

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def term_hashes(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of a run of texts, and where each text's terms begin and end.

    A term is a run of characters other than ASCII signs and spaces, A-Z lower-cased.
    """
    data = np.frombuffer(b" ".join(run) + b" ", np.uint8)
    edge = np.diff(np.concatenate(([False], _TERM[data])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = running(_LOWER[data].astype(np.uint64) + np.uint64(1))
    lengths = np.fromiter(map(len, run), np.int64, len(run))
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))
    return spans(sums, start, end), np.searchsorted(start, begins)


def _counted(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) by document and term."""
    docs, terms = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for first, run in slices(texts):
        hashes, begins = term_hashes(run)
        docs.append(first + np.repeat(np.arange(len(run)), np.diff(begins)))
        terms.append(hashes)
    doc, term = np.concatenate(docs), np.concatenate(terms)
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    first = np.flatnonzero(new)
    return doc[first], term[first], np.diff(np.append(first, len(doc)))


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def _bits(terms: np.ndarray, level: int, bits: int) -> list[np.ndarray]:
    """The `BITS_SET` bits of each term at a level, in a signature of `bits` (a power of two)."""
    key = mix(terms + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1)))
    return [(key >> np.uint64(21 * i)) & np.uint64(bits - 1) for i in range(BITS_SET)]


# --- the index -----------------------------------------------------------------------
_INDEX = (
    "docs bigint, words bigint, ids array<bigint>, digests array<bigint>, sizes array<bigint>, "
    "most array<bigint>, bits bigint, slices binary, terms array<bigint>, holders array<bigint>"
)


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents; the first block of a batch counts its terms' documents."""
    schema = None
    for batch in batches:
        doc, term, tf = _counted(_texts(batch.column(2)))
        if not len(doc):
            continue
        rows = batch.num_rows
        sizes = np.bincount(doc, tf, rows).astype(np.int64)
        most = np.zeros(rows, np.int64)
        np.maximum.at(most, doc, tf)
        entries = np.zeros(rows, np.int64)
        for level in LEVELS:
            entries += np.bincount(doc[tf >= level], minlength=rows)
        terms, holders = np.unique(term, return_counts=True)
        begins = np.searchsorted(doc, np.arange(rows + 1))
        order = np.argsort(entries, kind="stable")
        order = order[entries[order] > 0]
        low = 0
        while low < len(order):
            high = min(low + BLOCK_DOCS, len(order))
            while True:  # fewer documents to a block where they need long signatures
                bits = 64
                while bits < BITS_PER_ENTRY * entries[order[high - 1]]:
                    bits *= 2
                if high - low <= 8 or bits * (high - low) <= BLOCK_BITS:
                    break
                high = low + max(8, (high - low) // 2)
            part = order[low:high]
            pick = np.concatenate([np.arange(begins[d], begins[d + 1]) for d in part])
            column = np.repeat(np.arange(len(part)), begins[part + 1] - begins[part])
            matrix = np.zeros((bits, -(-len(part) // 8) * 8), bool)
            for i, level in enumerate(LEVELS):
                held = tf[pick] >= level
                for bit in _bits(term[pick][held], i, bits):
                    matrix[bit.astype(np.int64), column[held]] = True
            take = pa.array(part)
            row = {
                "docs": [len(part)],
                "words": [int(sizes[part].sum())],
                "ids": [batch.column(0).take(take).to_pylist()],
                "digests": [batch.column(1).take(take).to_pylist()],
                "sizes": [sizes[part]],
                "most": [most[part]],
                "bits": [bits],
                "slices": [np.packbits(matrix, axis=1).tobytes()],
                "terms": [terms.view(np.int64) if low == 0 else []],
                "holders": [holders if low == 0 else []],
            }
            schema = schema or pa.schema(
                [(n, _ARROW.get(n, pa.list_(pa.int64()))) for n in row]
            )
            yield pa.RecordBatch.from_pydict(row, schema)
            low = high


_ARROW = {"docs": pa.int64(), "words": pa.int64(), "bits": pa.int64(), "slices": pa.binary()}


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(text_col).alias("digest"),
        F.col(text_col).alias("text"),
    )


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The signatures of all documents and the number of documents of each term, stored."""
    keyed = _keyed(docs.filter(F.col(text_col).isNotNull()), id_col, text_col)
    return stored(keyed.mapInArrow(_index_rows, _INDEX), "search-index")


# --- queries -------------------------------------------------------------------------
def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, term, _ = _counted(_texts(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(doc)), pa.array(term.view(np.int64))], ["item", "term"]
        )


def query_terms(
    items: DataFrame, index: DataFrame, docs: int, id_col: str, text_col: str
) -> DataFrame:
    """(item, term, weight), stored: the terms of each item that some of `docs` documents hold."""
    item = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest")).alias("item")
    rows = items.filter(F.col(text_col).isNotNull()).select(item, F.col(text_col).alias("text"))
    terms = rows.mapInArrow(_item_terms, f"item {rows.schema['item'].dataType.simpleString()}, term bigint")
    held = (
        index.filter(F.size("terms") > 0)
        .select(F.inline(F.arrays_zip("terms", "holders")))
        .groupBy(F.col("terms").alias("term"))
        .agg(F.sum("holders").alias("df"))
    )
    weight = F.floor(1000 * F.log(F.lit(2.0 * docs + 2) / (2 * F.col("df") + 1)))
    weighed = terms.distinct().join(held, "term")
    weighed = weighed.select("item", "term", weight.cast("bigint").alias("weight"))
    return stored(weighed.filter(F.col("weight") > 0), "search-terms")


class _Queries:
    """Terms of some items in a row: arrays by item, small enough to be sent to each task."""

    def __init__(self, rows: list, docs: int, words: int):
        self.items = sorted({r["item"] for r in rows}, key=repr)
        number = {item: i for i, item in enumerate(self.items)}
        item = np.array([number[r["item"]] for r in rows], np.int64)
        order = np.argsort(item, kind="stable")
        self.item = item[order]
        self.term = np.array([r["term"] for r in rows], np.int64).view(np.uint64)[order]
        self.weight = np.array([r["weight"] for r in rows], np.int64)[order]
        self.begins = np.searchsorted(self.item, np.arange(len(self.items) + 1))
        self.docs, self.words = docs, words

    def norms(self, sizes: np.ndarray) -> np.ndarray:
        """What makes a term count less in a longer document."""
        return 20 * (100 - 50 + (50 * sizes * self.docs) // self.words)


def _part_of_term(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + norm)


def _bounds(q: _Queries, low: int, high: int, block: dict) -> np.ndarray:
    """Upper bound of the score of each document of a block for the items low..high - 1."""
    n = len(block["sizes"])
    matrix = np.frombuffer(block["slices"], np.uint8).reshape(block["bits"], -1)
    pairs = slice(q.begins[low], q.begins[high])
    terms, weight, item = q.term[pairs], q.weight[pairs], q.item[pairs] - low
    norm = q.norms(block["sizes"])
    bounds = np.zeros((high - low, n), np.int64)
    held = None
    last = np.zeros(n, np.int64)
    for i in range(len(LEVELS)):
        slots = _bits(terms, i, block["bits"])
        here = matrix[slots[0].astype(np.int64)]
        for slot in slots[1:]:
            here = here & matrix[slot.astype(np.int64)]
        if held is not None:
            here &= held
        some = here.any(axis=1)
        terms, weight, item, held = terms[some], weight[some], item[some], here[some]
        if not len(terms):
            break
        # A term found at this level occurs less often than the next level says.
        ceiling = block["most"] if i + 1 == len(LEVELS) else np.minimum(LEVELS[i + 1] - 1, block["most"])
        part = _part_of_term(ceiling, norm)
        gain = np.unpackbits(held, axis=1, count=n) * weight[:, None]
        first = np.flatnonzero(np.diff(item, prepend=-1))
        bounds[item[first]] += np.add.reduceat(gain, first, axis=0) * (part - last)
        last = part
    return bounds


def _blocks(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        ids = batch.column("ids")[i].values
        yield {
            "ids": np.asarray(ids.fill_null(0)),
            "no_id": np.asarray(ids.is_null()),
            "digests": np.asarray(batch.column("digests")[i].values),
            "sizes": np.asarray(batch.column("sizes")[i].values),
            "most": np.asarray(batch.column("most")[i].values),
            "bits": batch.column("bits")[i].as_py(),
            "slices": batch.column("slices")[i].as_py(),
        }


def _item_ranges(q: _Queries) -> Iterator[tuple[int, int]]:
    """Ranges of items of about `PAIRS` terms."""
    low = 0
    while low < len(q.items):
        high = max(low + 1, int(np.searchsorted(q.begins, q.begins[low] + PAIRS, "right")) - 1)
        yield low, min(high, len(q.items))
        low = high


def _pairs_batch(item, ids, no_id, digests, bound) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(item, pa.int64()), pa.array(ids, pa.int64(), mask=no_id), pa.array(digests, pa.int64()), pa.array(bound, pa.int64())],
        ["item", "id", "digest", "bound"],
    )


_PAIRS = "item bigint, id bigint, digest bigint, bound bigint"
_BLOCK = ("ids", "digests", "sizes", "most", "bits", "slices")


def _promising(q: _Queries, k: int):
    """The k documents of a task with the largest bounds, per item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (len(q.items), k)
        best = {"bound": np.zeros(shape, np.int64), "ids": np.zeros(shape, np.int64)}
        best |= {"digests": np.zeros(shape, np.int64), "no_id": np.zeros(shape, bool)}
        for batch in batches:
            for block in _blocks(batch):
                for low, high in _item_ranges(q):
                    bound = _bounds(q, low, high, block)
                    hit = np.flatnonzero(bound.max(axis=1) > best["bound"][low:high].min(axis=1))
                    if not len(hit):
                        continue
                    new = bound[hit]
                    joined = np.concatenate((best["bound"][low + hit], new), axis=1)
                    top = np.argpartition(joined, joined.shape[1] - k, axis=1)[:, -k:]
                    best["bound"][low + hit] = np.take_along_axis(joined, top, axis=1)
                    for name in ("ids", "digests", "no_id"):
                        both = (best[name][low + hit], np.broadcast_to(block[name], new.shape))
                        joined = np.concatenate(both, axis=1)
                        best[name][low + hit] = np.take_along_axis(joined, top, axis=1)
        item, at = np.nonzero(best["bound"])
        yield _pairs_batch(item, *(best[x][item, at] for x in ("ids", "no_id", "digests", "bound")))

    return rows


def _not_excluded(q: _Queries, floors: np.ndarray):
    """Documents whose bound reaches the item's floor."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch):
                for low, high in _item_ranges(q):
                    bound = _bounds(q, low, high, block)
                    item, at = np.nonzero(bound >= np.maximum(floors[low:high], 1)[:, None])
                    if len(item):
                        yield _pairs_batch(low + item, block["ids"][at], block["no_id"][at], block["digests"][at], bound[item, at])

    return rows


def _scores(q: _Queries):
    """Exact scores of whole texts for the items listed with them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, term, tf = _counted(_texts(batch.column(1)))
            begins = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            found = [(np.empty(0, np.int64),) * 3]
            for d in range(batch.num_rows):
                own, counts = term[begins[d] : begins[d + 1]], tf[begins[d] : begins[d + 1]]
                items = np.sort(np.asarray(batch.column(2)[d].values))
                n = q.begins[items + 1] - q.begins[items]
                pair = np.repeat(q.begins[items] - np.cumsum(n) + n, n) + np.arange(n.sum())
                at = np.minimum(np.searchsorted(own, q.term[pair]), len(own) - 1)
                hits = np.where(own[at] == q.term[pair], counts[at], 0)
                part = q.weight[pair] * _part_of_term(hits, q.norms(np.array([counts.sum()])))
                score = np.add.reduceat(part, np.cumsum(n) - n)
                found.append((np.full(len(items), d), items, score))
            doc, item, score = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), batch.column(0).take(pa.array(doc)), pa.array(score)],
                ["item", "id", "score"],
            )

    return rows


def _scored(docs: DataFrame, pairs: DataFrame, q: _Queries, k: int) -> DataFrame:
    """The k best documents of each item among `pairs`, scored from their texts."""
    key = F.struct("id", "digest").alias("key")
    listed = pairs.select(key, "item").groupBy("key").agg(F.collect_set("item").alias("items"))
    # The list is stored: Spark sees its size and moves no texts if it is small.
    listed = stored(listed, "search-candidates")
    texts = docs.select("id", "text", key).join(listed, "key").select("id", "text", "items")
    scored = texts.mapInArrow(_scores(q), "item bigint, id bigint, score bigint")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = scored.filter(F.col("score") > 0).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    index: DataFrame | None = None,
) -> DataFrame:
    """The k best documents of each item: `item_col`, rank (from 1), `id_col`, score (above 0).

    `index` is that of `build_index` for these documents, by default a new one.
    """
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col) if index is None else index
    total = index.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    terms = query_terms(items, index, total["docs"] or 0, item_col, item_text_col)
    texts = _keyed(docs.filter(F.col(text_col).isNotNull()), id_col, text_col)
    parts = -(-terms.count() // QUERY_TERMS)
    name = items.schema[item_col].dataType.simpleString()
    result = spark.createDataFrame(
        [], f"`{item_col}` {name}, rank int, `{id_col}` bigint, score bigint"
    )
    for part in range(parts):
        rows = terms.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).collect()
        q = _Queries(rows, total["docs"], total["words"])
        if not q.items:  # no item's hash fell into this part
            continue
        blocks = index.select(*_BLOCK)
        first = blocks.mapInArrow(_promising(q, k), _PAIRS)
        best = W.partitionBy("item").orderBy(F.desc("bound"), "id", "digest")
        first = first.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k)
        floor = _scored(texts, first, q, k).groupBy("item").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
        floors = np.zeros(len(q.items), np.int64)
        for r in floor.filter(F.col("n") == k).collect():  # one row per item of this block
            floors[r["item"]] = r["floor"]
        able = blocks.mapInArrow(_not_excluded(q, floors), _PAIRS)
        names = spark.createDataFrame(
            [(i, item["id"]) for i, item in enumerate(q.items)],
            T.StructType([T.StructField("item", T.LongType()), items.schema[item_col]]),
        )
        ranked = _scored(texts, able, q, k).join(names, "item")
        found = ranked.select(item_col, "rank", F.col("id").alias(id_col), "score")
        result = result.unionByName(found)
    return result
