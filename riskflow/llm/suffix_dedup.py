"""Removing every byte of repeated strings, by maximal repeats of an enhanced suffix array.

A repeat is a string of `length` bytes (a window) that starts at two places or more, in one
document or in several; all its occurrences go, not just the later ones.

1. Each window is assigned to an anchor inside it: of its strings of a third of its length,
   that with the smallest hash, the last of equal ones. That depends on the window's bytes
   alone, so equal windows have equal anchors, and neighbouring windows mostly share one.
   An anchor that stands at one place only needs no more work.
2. The windows of an anchor's place are a short stretch of text, a segment. Segments go to
   the bucket of their anchor's hash, where equal windows of the whole corpus meet. A
   bucket sorts all its windows (prefix doubling), takes the common prefixes of neighbours,
   scans them with a stack for the intervals of the common-prefix tree, and keeps those
   whose members have different bytes to their left: maximal repeat groups with all their
   occurrences. A window with equal bytes to the left is part of a longer repeat. Equal
   segments stand in the array once, with the number of their copies.
3. Covered stretches are listed per document and joined to the texts.

Anchors with more than `HOT_PLACES` places (a passage of very many documents) would fill a
bucket. Their windows are compared by 64-bit hashes of all bytes instead: one row per
distinct window and batch goes through the shuffle, further ones are settled in the batch.
Both ways are exact (up to collisions of 64-bit hashes), and no place is left out. A segment
is shorter than two windows, so a longer repeat is reported as groups that overlap.

Defined results: a NULL text is an empty one; texts shorter than `length` stay whole; each
row is a document of its own, so rows that repeat a text are copies of each other, whatever
their ids; NULL ids are ids like others; an empty table gives no rows; columns other than
the id are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.llm.words import mix, running, slices, spans

#: Places of an anchor up to which its segments are compared in one bucket.
HOT_PLACES = 1024
#: Bytes of text per bucket of segments (which are at most some four times as many bytes).
BUCKET_BYTES = 1 << 19
#: Window starts handled at a time; a position in a block has to fit into `_PLACE_BITS`.
BLOCK = 1 << 20
_PLACE_BITS = np.uint64(22)
#: Occurrences of repeats laid out at a time.
EXPANDED = 1 << 20
#: Between segments; no byte of UTF-8.
_END = b"\xff"


# --- windows and their anchors -------------------------------------------------------
def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbouring keys."""
    done = 1
    while 2 * done <= width:
        keys = np.minimum(keys[:-done], keys[done:])
        done *= 2
    return keys if done == width else np.minimum(keys[: len(keys) - (width - done)], keys[width - done :])


def _anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window start: place and hash of the window's anchor. `data` holds all windows."""
    gram_length = length // 3
    width = length - gram_length + 1
    mask = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    places, hashes = [], []
    for low in range(0, len(data) - length + 1, BLOCK):
        block = data[low : low + BLOCK + length - 1]
        sums = running(block.astype(np.uint64) + np.uint64(1))
        start = np.arange(len(block) - gram_length + 1)
        gram = spans(sums, start, start + gram_length)
        # Of equal hashes the last place is the smallest key.
        keys = (gram & ~mask) | (mask - start.astype(np.uint64))
        place = (mask - (_least(keys, width) & mask)).astype(np.int64)
        places.append(place + low)
        hashes.append(gram[place])
    return np.concatenate(places), np.concatenate(hashes)


def _segments(run: list[bytes], length: int):
    """Stretches of window starts with one anchor: (document, first start, starts, hash),
    places counted over the joined texts, and the texts with their beginnings."""
    data = np.frombuffer(b"".join(run), np.uint8)
    size = np.fromiter(map(len, run), np.int64, len(run))
    begins = np.concatenate(([0], np.cumsum(size)))
    nothing = np.empty(0, np.int64)
    if len(data) < length:
        return nothing, nothing, nothing, np.empty(0, np.uint64), data, begins
    place, hashes = _anchors(data, length)
    doc = np.repeat(np.arange(len(run)), size)[: len(place)]
    whole = np.flatnonzero(np.arange(len(place)) + length <= begins[doc + 1])
    new = np.ones(len(whole), bool)
    new[1:] = (np.diff(whole) != 1) | (place[whole[1:]] != place[whole[:-1]]) | (doc[whole[1:]] != doc[whole[:-1]])
    first = np.flatnonzero(new)
    starts = np.diff(np.append(first, len(whole)))
    first = whole[first]
    return doc[first], first, starts, hashes[first], data, begins


def _concat(parts: list, dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def _anchor_rows(length: int):
    """Per batch and anchor: hash, number of places, and the documents that have it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, docs = [], []
            for first, run in slices(_texts(batch.column(1))):
                doc, _, _, found, _, _ = _segments(run, length)
                hashes.append(found)
                docs.append(first + doc)
            hashes, docs = _concat(hashes, np.uint64), _concat(docs, np.int64)
            order = np.lexsort((docs, hashes))
            hashes, docs = hashes[order], docs[order]
            new = np.ones(len(hashes), bool)
            new[1:] = hashes[1:] != hashes[:-1]
            own = new.copy()
            own[1:] |= docs[1:] != docs[:-1]
            first = np.flatnonzero(new)
            members = np.concatenate(([0], np.cumsum(own)))
            lists = np.append(members[first], members[-1]).astype(np.int32)
            holders = pa.ListArray.from_arrays(pa.array(lists), batch.column(0).take(pa.array(docs[own])))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[first].view(np.int64)),
                    pa.array(np.diff(np.append(first, len(hashes))).astype(np.int64)),
                    holders,
                ],
                ["hash", "places", "docs"],
            )

    return rows


def _listed(hashes: np.ndarray, doc: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which hashes are in their document's list (NULL: an empty one)."""
    owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
    listed = np.asarray(lists.flatten()).view(np.uint64)
    pair = lambda h, d: mix(h ^ mix(d.astype(np.uint64)))
    return np.isin(pair(hashes, doc), pair(listed, owner))


# --- what goes to the buckets --------------------------------------------------------
# A segment has bytes; a window of a hot anchor has none, and `hash` is that of its bytes; a
# stretch that a batch has settled has neither.
def _row_type(doc: str) -> str:
    return f"bucket bigint, hash bigint, doc {doc}, start bigint, starts int, bytes binary"


def _stretches(first: np.ndarray, after: np.ndarray, owner: np.ndarray):
    """Unions of stretches [first, after) of one owner, given in order of owner and first."""
    if not len(first):
        return first, after, owner
    # Owners far apart, so that the running maximum of ends never reaches into the next one.
    gap = int(after.max()) + 1
    number = np.cumsum(np.concatenate(([0], owner[1:] != owner[:-1])))
    reach = np.maximum.accumulate(after + number * gap)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] + number[1:] * gap > reach[:-1]
    new[1:] |= number[1:] != number[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(first)) - 1
    return first[at], reach[last] - number[last] * gap, owner[at]


def _bucket_rows(docs, owner, start, starts, hashes, spread, buckets, pieces=None) -> pa.RecordBatch:
    n = len(owner)
    return pa.RecordBatch.from_arrays(
        [
            pa.array((spread % np.uint64(buckets)).astype(np.int64)),
            pa.nulls(n, pa.int64()) if hashes is None else pa.array(hashes.view(np.int64)),
            docs.take(pa.array(owner)),
            pa.array(start.astype(np.int64)),
            pa.array(starts.astype(np.int32)),
            pa.nulls(n, pa.binary()) if pieces is None else pa.array(pieces, pa.binary()),
        ],
        ["bucket", "hash", "doc", "start", "starts", "bytes"],
    )


def _hot_rows(docs, hashes, owner, start, length: int, buckets: int):
    """The first of equal windows of a batch, and settled stretches for all of several."""
    order = np.lexsort((start, owner, hashes))
    hashes, owner, start = hashes[order], owner[order], start[order]
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    several = ~first
    several[:-1] |= ~first[1:]
    one = np.ones(int(first.sum()), np.int64)
    yield _bucket_rows(docs, owner[first], start[first], one, hashes[first], hashes[first], buckets)
    owner, start = owner[several], start[several]
    order = np.lexsort((start, owner))
    start, after, owner = _stretches(start[order], start[order] + length, owner[order])
    spread = mix(start.astype(np.uint64) ^ mix(owner.astype(np.uint64)))
    yield _bucket_rows(docs, owner, start, after - start, None, spread, buckets)


def _segment_rows(length: int, buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(2).is_valid())
            docs, anchors, hot = batch.column(0), batch.column(2), batch.column(3)
            windows = []  # of hot anchors: hash, document, start
            for number, run in slices(_texts(batch.column(1))):
                doc, first, starts, hashes, data, begins = _segments(run, length)
                known = _listed(hashes, doc, anchors.slice(number, len(run)))
                is_hot = known & _listed(hashes, doc, hot.slice(number, len(run)))
                pick = np.flatnonzero(known & ~is_hot)
                ends = first[pick] + starts[pick] + length - 1
                pieces = [data[a:b].tobytes() for a, b in zip(first[pick], ends, strict=True)]
                yield _bucket_rows(
                    docs, number + doc[pick], (first - begins[doc])[pick], starts[pick],
                    hashes[pick], hashes[pick], buckets, pieces,
                )
                pick = np.flatnonzero(is_hot)
                if len(pick):
                    n = starts[pick]
                    start = np.repeat(first[pick] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    sums = running(data.astype(np.uint64) + np.uint64(1))
                    owner = np.repeat(doc[pick], n)
                    windows.append((spans(sums, start, start + length), number + owner, start - begins[owner]))
            if windows:
                yield from _hot_rows(
                    docs, *(np.concatenate(x) for x in zip(*windows, strict=True)), length, buckets
                )

    return rows


# --- the enhanced suffix array of a bucket -------------------------------------------
def _ranked(keys: np.ndarray) -> np.ndarray:
    """Dense rank of each key."""
    order = np.argsort(keys)
    new = np.zeros(len(keys), np.int32)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    ranks = np.empty(len(keys), np.int32)
    ranks[order] = np.cumsum(new, dtype=np.int32)
    return ranks


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every place as one number that sorts as they do."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.zeros(len(data), np.uint64)
    for i in range(8):
        eights = (eights << np.uint64(8)) | padded[i : i + len(data)].astype(np.uint64)
    return eights


def _levels(eights: np.ndarray, most: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of the strings of 8, 24, ... bytes at every place; twice the last reaches `most`.

    A level makes strings three times as long, or twice if three ranks don't fit 64 bits.
    """
    n = len(eights)
    bits = max(1, n.bit_length())
    levels, size = [(8, _ranked(eights))], 8
    while 2 * size < most:
        times = 3 if 3 * bits <= 63 and 3 * size <= most else 2
        ranks = levels[-1][1].astype(np.int64)
        keys = ranks
        for i in range(1, times):
            later = np.concatenate((ranks[i * size :], np.zeros(min(i * size, n), np.int64)))
            keys = (keys << bits) | later
        levels.append((times * size, _ranked(keys)))
        size *= times
    return levels


def _agree(levels, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings of `length` bytes at the places a and b are equal."""
    size, ranks = [x for x in levels if x[0] <= length][-1]
    same = np.ones(len(a), bool)
    for at in [*range(0, length - size, size), length - size]:
        same &= ranks[a + at] == ranks[b + at]
    return same


def _common(levels, eights: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common prefix at the places a and b, at most `limit`."""
    common, last = np.zeros(len(a), np.int64), len(eights) - 1
    longer = 3 * levels[-1][0]
    for size, ranks in reversed(levels):
        for _ in range(longer // size - 1):
            x, y = np.minimum(a + common, last), np.minimum(b + common, last)
            common += np.where((common + size <= limit) & (ranks[x] == ranks[y]), size, 0)
        longer = size
    x, y = np.minimum(a + common, last), np.minimum(b + common, last)
    apart = eights[x] ^ eights[y]
    more = sum((apart >> np.uint64(64 - 8 * k) == 0).astype(np.int64) for k in range(1, 9))
    return np.minimum(common + more, limit)


def _intervals(lcp: list[int], differs: list[bool], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the maximal repeats among neighbours in a suffix array.

    `lcp[i]` and `differs[i]` are the common prefix of the suffixes i and i + 1, and whether
    the bytes to their left differ. The stack holds the open intervals of the common-prefix
    tree: their prefix length, first suffix, and whether some bytes to the left differ.
    """
    stack: list[list] = []
    for i in range(len(lcp) + 1):
        value = lcp[i] if i < len(lcp) else 0
        first, apart = i, i < len(lcp) and differs[i]
        inner = False
        while stack and stack[-1][0] > value:
            size, first, diverse = stack.pop()
            inner = inner or diverse
            if inner:
                yield size, first, i
        if stack and stack[-1][0] == value:
            stack[-1][2] = stack[-1][2] or inner or apart
        elif value >= least:
            stack.append([value, first, inner or apart])


def _maximal_repeats(data: np.ndarray, place, size, left, length: int):
    """Maximal repeats of at least `length` bytes among suffixes of segments.

    `place`: where a suffix starts in `data`; `size`: bytes from there to its segment's end;
    `left`: the byte before it, or a negative number of its own where it starts its segment.
    Returns the suffix array and, for each repeat, its length, first and last place in it.
    """
    most = int(size.max())
    eights = _eights(data)
    levels = _levels(eights, most)
    top, ranks = levels[-1]
    # Segments end with a byte that no text has: those that end early are sorted apart.
    order = np.lexsort((ranks[place + max(0, most - top)], ranks[place]))
    a, b = order[:-1], order[1:]
    linked = np.flatnonzero(_agree(levels, place[a], place[b], length))
    lcp = np.zeros(len(a), np.int64)
    x, y = a[linked], b[linked]
    lcp[linked] = _common(levels, eights, place[x], place[y], np.minimum(size[x], size[y]))
    differs = left[a] != left[b]
    edge = np.diff(np.concatenate(([False], lcp >= length, [False])).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # Stretches whose members all have the same byte to their left hold no maximal repeat.
    apart = np.concatenate(([0], np.cumsum(differs)))
    diverse = apart[last] > apart[first]
    first, last = first[diverse], last[diverse]
    pair = last == first + 1
    found = [np.stack((lcp[first[pair]], first[pair], last[pair]), axis=1)]
    for i, j in zip(first[~pair].tolist(), last[~pair].tolist(), strict=True):
        inner = _intervals(lcp[i:j].tolist(), differs[i:j].tolist(), length)
        found.append(np.array([(n, i + low, i + high) for n, low, high in inner], np.int64).reshape(-1, 3))
    return order, *np.concatenate(found).T


def _members(first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(repeat, place in the suffix array) of all occurrences, some repeats at a time."""
    if not len(first):
        return
    total = np.cumsum(last - first + 1)
    cuts = np.searchsorted(total, np.arange(0, int(total[-1]), EXPANDED))
    for low, high in zip(cuts, np.append(cuts[1:], len(first)), strict=True):
        n = last[low:high] - first[low:high] + 1
        repeat = np.repeat(np.arange(low, high), n)
        yield repeat, np.repeat(first[low:high] - np.cumsum(n) + n, n) + np.arange(n.sum())


def _in_bucket(segments: pa.Table, length: int):
    """Distinct segments as one text with an end after each, and their windows as suffixes.

    Returns the text, per suffix its segment, number in it, place, bytes to the segment's
    end and byte to its left; and the segment of each row.
    """
    numbers: dict[bytes, int] = {}
    rows = segments.column("bytes").to_pylist()
    of_row = np.array([numbers.setdefault(x, len(numbers)) for x in rows], np.int64)
    data = np.frombuffer(_END.join(numbers) + _END, np.uint8)
    lengths = np.fromiter(map(len, numbers), np.int64, len(numbers))
    ends = np.cumsum(lengths + 1) - 1
    starts = lengths - length + 1
    segment = np.repeat(np.arange(len(starts)), starts)
    nth = np.arange(len(segment)) - np.repeat(np.cumsum(starts) - starts, starts)
    place = (ends - lengths)[segment] + nth
    left = np.where(nth > 0, data[np.maximum(place - 1, 0)].astype(np.int64), -1 - np.arange(len(segment)))
    return data, segment, nth, place, ends[segment] - place, left, of_row


class _Copies:
    """The rows of each distinct segment."""

    def __init__(self, of_row: np.ndarray):
        self.rows = np.argsort(of_row, kind="stable")
        self.n = np.bincount(of_row)
        self.begins = np.cumsum(self.n) - self.n

    def of(self, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of `segment`, row) for every row of each of these segments."""
        n = self.n[segment]
        which = np.repeat(np.arange(len(segment)), n)
        return which, self.rows[np.repeat(self.begins[segment] - np.cumsum(n) + n, n) + np.arange(n.sum())]


def _bucket_results(length: int, groups: bool):
    """Covered stretches (doc, start, after) of a bucket, or with `groups` its repeats."""

    def results(bucket: pa.Table) -> pa.Table:
        plain = bucket.column("bytes").is_valid()
        segments, others = bucket.filter(plain), bucket.filter(pc.invert(plain))
        found = [(pa.array([], bucket.schema.field("doc").type), *(np.empty(0, np.int64),) * 3)]
        if segments.num_rows:
            data, segment, nth, place, size, left, of_row = _in_bucket(segments, length)
            copies = _Copies(of_row)
            doc = segments.column("doc").combine_chunks()
            at = np.asarray(segments.column("start"))
            order, value, first, last = _maximal_repeats(data, place, size, left, length)
            base = bucket.column("bucket")[0].as_py() << 32
            reach = np.zeros(len(segment), np.int64)
            for repeat, member in _members(first, last):
                suffix = order[member]
                np.maximum.at(reach, suffix, value[repeat])
                if groups:
                    which, row = copies.of(segment[suffix])
                    start = at[row] + nth[suffix][which]
                    found.append((doc.take(pa.array(row)), start, start + value[repeat][which], base + repeat[which]))
            # Copies of a segment are a repeat from its start, unless a group has shown them.
            whole = np.flatnonzero((nth == 0) & (copies.n[segment] > 1) & (reach < size))
            reach[whole] = size[whole]
            if groups:
                which, row = copies.of(segment[whole])
                start = at[row]
                found.append((doc.take(pa.array(row)), start, start + size[whole][which], base + len(value) + which))
            else:
                hit = np.flatnonzero(reach)
                start, after, owner = _stretches(nth[hit], nth[hit] + reach[hit], segment[hit])
                which, row = copies.of(owner)
                found.append((doc.take(pa.array(row)), at[row] + start[which], at[row] + after[which], row))
        windows = others.filter(others.column("hash").is_valid())
        if windows.num_rows:
            hashes = np.asarray(windows.column("hash"))
            _, same, count = np.unique(hashes, return_inverse=True, return_counts=True)
            hit = np.flatnonzero(count[same] > 1)
            start = np.asarray(windows.column("start"))[hit]
            doc = windows.column("doc").combine_chunks().take(pa.array(hit))
            found.append((doc, start, start + length, hashes[hit]))
        settled = others.filter(others.column("hash").is_null())
        if settled.num_rows and not groups:
            start = np.asarray(settled.column("start"))
            after = start + np.asarray(settled.column("starts"))
            found.append((settled.column("doc").combine_chunks(), start, after, start))
        docs, start, after, number = zip(*found, strict=True)
        columns = {
            "doc": pa.concat_arrays(docs),
            "start": pa.array(np.concatenate(start), pa.int64()),
            "after": pa.array(np.concatenate(after), pa.int64()),
        }
        if groups:
            columns["repeat"] = pa.array(np.concatenate(number), pa.int64())
        return pa.table(columns)

    return results


# --- whole texts ---------------------------------------------------------------------
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: its bytes, those removed, the removed stretches, and what is left."""
    for batch in batches:
        lists = batch.column(2)
        counts = np.asarray(lists.value_lengths().fill_null(0))
        flat = lists.flatten()
        start, after = np.asarray(flat.field("start")), np.asarray(flat.field("after"))
        owner = np.repeat(np.arange(len(lists)), counts)
        order = np.lexsort((start, owner))
        start, after, owner = _stretches(start[order], after[order], owner[order])
        n_removed = np.bincount(owner, after - start, len(lists)).astype(np.int64)
        bounds = np.searchsorted(owner, np.arange(len(lists) + 1))
        texts = [x or b"" for x in _texts(batch.column(1))]
        kept = []
        for i, text in enumerate(texts):
            low, high = bounds[i], bounds[i + 1]
            edges = [0, *np.stack((start[low:high], after[low:high]), axis=1).ravel().tolist(), len(text)]
            kept.append(b"".join(text[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)))
        stretches = pa.StructArray.from_arrays([pa.array(start), pa.array(after)], ["start", "after"])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).field("id"),
                pa.array([len(x) for x in texts], pa.int64()),
                pa.array(n_removed),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), stretches),
                pa.array(kept, pa.binary()),
            ],
            ["id", "n_bytes", "n_removed", "removed", "kept"],
        )


def _found(docs: DataFrame, length: int, id_col: str, text_col: str, groups: bool):
    """Texts under a key of their own, and what the buckets find of them."""
    if length < 16:
        raise ValueError("length must be at least 16 bytes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(
        F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest")).alias("doc"),
        text.alias("text"),
    )
    doc = texts.schema["doc"].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES
    anchors = texts.mapInArrow(_anchor_rows(length), f"hash bigint, places bigint, docs array<{doc}>")
    places = F.sum("places").over(W.partitionBy("hash"))
    shared = anchors.withColumn("places", places).filter(F.col("places") > 1)
    if groups:  # all occurrences are wanted, so no batch settles any for itself
        hot = F.lit(False)
    else:
        hot = F.col("places") > HOT_PLACES
    per_doc = (
        shared.select(F.explode("docs").alias("holder"), "hash", hot.alias("hot"))
        .groupBy("holder")
        .agg(
            F.collect_list("hash").alias("anchors"),
            F.collect_list(F.when(F.col("hot"), F.col("hash"))).alias("hot"),
        )
    )
    near = texts.join(per_doc, texts["doc"] == per_doc["holder"], "left")
    rows = near.select("doc", "text", "anchors", "hot").mapInArrow(
        _segment_rows(length, buckets), _row_type(doc)
    )
    result = f"doc {doc}, start bigint, after bigint" + (", repeat bigint" if groups else "")
    return texts, rows.groupBy("bucket").applyInArrow(_bucket_results(length, groups), result)


def remove_repeats(
    docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id with n_bytes, n_removed, `removed` (stretches start, after) and `kept` (binary).

    A byte goes if a string of `length` bytes that covers it also starts anywhere else.
    Strings are judged on the input. `length` is at least 16.
    """
    texts, covered = _found(docs, length, id_col, text_col, groups=False)
    per_doc = covered.groupBy(F.col("doc").alias("holder")).agg(
        F.collect_list(F.struct("start", "after")).alias("found")
    )
    # Both joins take the same columns of the same rows, so the texts are shuffled once.
    joined = texts.join(per_doc, texts["doc"] == per_doc["holder"], "left")
    id_type = texts.schema["doc"].dataType["id"].dataType.simpleString()
    cut = joined.select("doc", "text", "found").mapInArrow(
        _cut,
        f"id {id_type}, n_bytes bigint, n_removed bigint, "
        "removed array<struct<start:bigint,after:bigint>>, kept binary",
    )
    return cut.withColumnRenamed("id", id_col)


def repeat_groups(
    docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every occurrence of every maximal repeat: id, start, after and `repeat`, its group.

    Bytes count from the text's start. Repeats longer than a segment come as several groups
    that overlap. All places of an anchor meet in one bucket, however many, since a group
    holds them all; use `remove_repeats` where only the coverage is wanted.
    """
    _, found = _found(docs, length, id_col, text_col, groups=True)
    return found.select(F.col("doc.id").alias(id_col), "start", "after", "repeat")
