"""Stupid-backoff language model scores of every document.

The score of a word is the relative frequency of the longest n-gram that ends with it
and is in the tables; each backoff to a shorter one costs a constant factor. Tables hold
the n-grams of all documents; from two words on, only those that occur at least
`min_count` times, so a document doesn't vouch for its own rare phrases.

Documents are numbered into chunks. Each chunk explodes into its distinct n-grams, which
go to the buckets of their hashes: one row per chunk and bucket, holding sorted hashes.
A bucket is a partition of the count tables: it adds up the counts of all chunks and
answers every chunk with the counts of its n-grams. Those answers are joined to the
chunk's documents, and scores are summed per document. So every n-gram of a chunk is
moved once each way, in arrays rather than rows; an n-gram that stands in a third of the
text makes one entry per chunk.

Defined results: NULL and empty texts have no words and a NULL score; words are not
folded; repeated rows count and are scored each; NULL ids are scored; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.words import mix, slices, word_hashes

#: Words of the longest n-grams; a lower order is for callers that ask for it.
ORDER = 3
BACKOFF = 0.4
MIN_COUNT = 2
#: Bytes of text in a chunk, on average, and of n-gram hashes in a bucket.
CHUNK_BYTES = 16 << 20
BUCKET_BYTES = 16 << 20
#: A chunk's hashes are sorted range by range; these first bits of a hash name its range.
PART_BITS = 3
#: Bytes of a hash that are moved; the bucket's number stands for further bits.
HASH_BYTES = 6


def ngrams(run: list[bytes], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For every word of a run of texts the hashes of the 1..order-grams that end with it
    (0 where the text begins later), and where each text begins."""
    words, begins = word_hashes(run)
    place = np.arange(len(words)) - np.repeat(begins[:-1], np.diff(begins))
    out = [mix(words + np.uint64(1))]
    for n in range(2, order + 1):
        longer = np.zeros(len(words), np.uint64)
        if len(words) >= n:
            # The hash of the words before the last one, and the last one.
            longer[1:] = mix(out[-1][:-1] * np.uint64(0xD1342543DE82EF95) + words[1:] + np.uint64(n))
        longer[place < n - 1] = 0
        out.append(longer)
    return out, begins


def _distinct(grams: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Distinct hashes in order and their counts, for one range of hashes after another.

    Also, for each array of `grams`, its places in this part and which hash stands there.
    """
    tops = [(g >> np.uint64(64 - PART_BITS)).astype(np.uint8) for g in grams]
    for part in range(1 << PART_BITS):
        places = [np.flatnonzero(top == part) for top in tops]
        some = np.concatenate([g[p] for g, p in zip(grams, places, strict=True)])
        values, inverse, counts = np.unique(some, return_inverse=True, return_counts=True)
        ends = np.cumsum([len(p) for p in places])[:-1]
        yield values, counts, list(zip(places, np.split(inverse, ends), strict=True))


def _pack_counts(counts: np.ndarray) -> bytes:
    """One byte per count; those of 255 and more follow in full. Most are small: Huffman codes."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return zlib.compress(small.tobytes() + counts[small == 255].astype("<u8").tobytes(), 1)


def _unpack_counts(data: bytes, n: int) -> np.ndarray:
    data = zlib.decompress(data)
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", offset=n)
    return counts


def _low_bits(n: int) -> int:
    """How many of a key's bits to store in full, for the shortest code of n keys."""
    return min(range(8 * HASH_BYTES - 20, 8 * HASH_BYTES), key=lambda low: n * low + (1 << 8 * HASH_BYTES - low))


def _pack_keys(hashes: np.ndarray, bucket_bits: int) -> bytes:
    """The HASH_BYTES bytes below the bits that name the bucket, of hashes in order.

    Low bits are stored as they are: whole bytes, then the rest of them. As high parts never
    fall, they are a row of bits: the i-th key sets bit (high part + i) (the Elias-Fano code).
    """
    rest = (hashes << np.uint64(bucket_bits)) >> np.uint64(64 - 8 * HASH_BYTES)
    n, low = len(rest), _low_bits(len(rest))
    whole, more = divmod(low, 8)
    bits = np.zeros(n + (1 << 8 * HASH_BYTES - low), np.uint8)
    bits[(rest >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
    lows = np.ascontiguousarray(rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : whole + 1])
    odd = np.unpackbits(lows[:, whole :], axis=1, bitorder="little", count=more)
    return np.ascontiguousarray(lows[:, :whole]).tobytes() + np.packbits(odd).tobytes() + np.packbits(bits).tobytes()


def _unpack_keys(data: bytes, n: int) -> np.ndarray:
    low = _low_bits(n)
    whole, more = divmod(low, 8)
    at = n * whole
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :whole] = np.frombuffer(data, np.uint8, at).reshape(n, whole)
    if more:
        odd = np.unpackbits(np.frombuffer(data, np.uint8, -(-n * more // 8), at), count=n * more)
        wide[:, whole] = np.packbits(odd.reshape(n, more), axis=1, bitorder="little").ravel()
        at += -(-n * more // 8)
    bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=at))
    high = np.flatnonzero(bits) - np.arange(n)
    return wide.view("<u8").ravel() + (high.astype(np.uint64) << np.uint64(low))


def _chunk_ngrams(table: pa.Table, order: int):
    """Of a chunk's texts: hashes of all n-grams, begin of each text, rows in a fixed order."""
    texts = table.column("text").cast(pa.large_binary()).to_pylist()
    grams: list[list[np.ndarray]] = [[] for _ in range(order)]
    begins, total = [np.zeros(1, np.int64)], 0
    for _, run in slices(texts):
        found, starts = ngrams(run, order)
        for all_of, some in zip(grams, found, strict=True):
            all_of.append(some)
        begins.append(starts[1:] + total)
        total += int(starts[-1])
    return [np.concatenate([np.empty(0, np.uint64), *g]) for g in grams], np.concatenate(begins)


def score_documents(
    docs: DataFrame,
    order: int = ORDER,
    min_count: int = MIN_COUNT,
    backoff: float = BACKOFF,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """id, n_words, log_score (natural logarithm, summed over the words), score_per_word."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(
        F.sum(F.octet_length(text)).alias("bytes"),
        F.sum(F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))).alias("words"),
    ).first()
    total_bytes, total_words = int(size["bytes"] or 0), int(size["words"] or 0)
    n_chunks = max(1, -(-total_bytes // chunk_bytes))
    key_bytes = total_words * order * HASH_BYTES
    bucket_bits = max(3, int(max(1, key_bytes // bucket_bytes)).bit_length())

    # Row numbers deal documents evenly over chunks, whatever their ids. The shuffle
    # below is used twice: to explode the n-grams, and to score.
    numbered = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        text.alias("text"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_chunks)).alias("chunk"),
    )

    def explode(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        grams, _ = _chunk_ngrams(table, order)
        parts = [(values, counts) for values, counts, _ in _distinct(grams)]
        values, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        begins = np.searchsorted(values >> np.uint64(64 - bucket_bits), np.arange((1 << bucket_bits) + 1))
        used = np.flatnonzero(np.diff(begins))
        cuts = [(int(b), slice(begins[b], begins[b + 1])) for b in used]
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in cuts], pa.int32()),
                "chunk": pa.array([chunk] * len(cuts), pa.int64()),
                "n": pa.array([s.stop - s.start for _, s in cuts], pa.int32()),
                "keys": pa.array([_pack_keys(values[s], bucket_bits) for _, s in cuts], pa.binary()),
                "counts": pa.array([_pack_counts(counts[s]) for _, s in cuts], pa.binary()),
            }
        )

    exploded = numbered.groupBy("chunk").applyInArrow(
        explode, "bucket int, chunk bigint, n int, keys binary, counts binary"
    )

    def count(table: pa.Table) -> pa.Table:
        """The bucket's part of the count tables, joined back to the n-grams of each chunk."""
        sizes = table.column("n").to_pylist()
        keys = [_unpack_keys(k, n) for k, n in zip(table.column("keys").to_pylist(), sizes, strict=True)]
        counts = [
            _unpack_counts(c, len(k))
            for c, k in zip(table.column("counts").to_pylist(), keys, strict=True)
        ]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])[:-1]
        answers = [_pack_counts(totals[p]) for p in np.split(place, ends)]
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "bucket": table.column("bucket"),
                "n": table.column("n"),
                "answer": pa.array(answers, pa.binary()),
            }
        )

    counted = exploded.groupBy("bucket").applyInArrow(
        count, "chunk bigint, bucket int, n int, answer binary"
    )

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        grams, begins = _chunk_ngrams(table, order)
        rows = sorted(
            zip(*(answers.column(c).to_pylist() for c in ("bucket", "n", "answer")), strict=True)
        )
        known = np.concatenate([np.empty(0, np.int64), *[_unpack_counts(a, n) for _, n, a in rows]])
        n_words = len(grams[0])
        counts, first = np.zeros((order, n_words), np.int64), 0
        for values, _, found in _distinct(grams):
            for n, (places, which) in enumerate(found):
                counts[n][places] = known[first + which]
            first += len(values)
        for n in range(1, order):
            counts[n][(grams[n] == 0) | (counts[n] < min_count)] = 0
        logs = np.log(np.maximum(counts[0], 1) / max(1, total_words))
        for n in range(1, order):
            context = np.concatenate(([1], counts[n - 1][:-1]))
            if n > 1:
                context = np.maximum(context, 1)
            found = counts[n] > 0
            possible = grams[n] != 0  # at the start of a text there is nothing to back off from
            logs = np.where(
                found,
                np.log(np.maximum(counts[n], 1) / context),
                logs + np.where(possible, np.log(backoff), 0.0),
            )
        words = np.diff(begins)
        total = np.array([logs[a:b].sum() for a, b in zip(begins, begins[1:], strict=False)])
        empty = words == 0
        return pa.table(
            {
                "id": table.column("id"),
                "n_words": pa.array(words, pa.int64()),
                "log_score": pa.array(total.astype(float), pa.float64(), mask=empty),
                "score_per_word": pa.array(total / np.maximum(words, 1), pa.float64(), mask=empty),
            }
        )

    scored = (
        numbered.groupBy("chunk")
        .cogroup(counted.groupBy("chunk"))
        .applyInArrow(score, "id bigint, n_words bigint, log_score double, score_per_word double")
    )
    return scored.withColumnRenamed("id", id_col)
