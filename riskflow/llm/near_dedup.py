"""Near-duplicate documents by b-bit MinHash.

A document is the set of its shingles. Documents with equal sets are one class from the
start, found by a digest of the set, and only its smallest id goes on. Each set gets 160
minima. Their hashes in bands of five name buckets; documents of similarity 0.8 share
none of the 32 buckets with a probability of 3 in a million. Documents that share a
bucket get a signature: the two low bits of 512 further minima, packed into 16 words. Bit
counts of two signatures estimate the similarity, corrected for the quarter of the unequal
minima that agree by chance; pairs estimated more than four standard errors below the
threshold go. The rest are confirmed on the full shingle sets.

In a bucket not all pairs are formed. Each document is paired with one head of the
bucket, which differs from bucket to bucket. What that links becomes one class. Where a
bucket still holds several classes, the documents outside the class of its head are
compared with all its members, block by block inside tasks: signatures first, which
gives clusters of classes that may be linked, then full sets within a cluster. Tasks
return no pairs but the few links that connect classes, at most one per document. So no
link between documents that share a bucket is lost, and the rows made of a bucket are
proportional to its size.

Defined results: documents without words are linked with nothing; fewer words than a
shingle make one shingle of all of them; documents with a NULL id are linked with
nothing and kept; rows that repeat an id have one row each in the result and are linked to
each other, also if their texts differ (ids are below 2**62); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.llm.words import WORD, mix, slices, tidy, utf8, word_hashes
from riskflow.operators.skew import attach_per_key
from riskflow.sources.tables import stored

BANDS = 32
ROWS = 5
#: Minima of a signature, and the low bits kept of each.
LANES = 512
BITS = 2
#: How far below the threshold an estimate may lie: four standard errors.
MARGIN = 0.084
#: Documents on either side of a block that one task compares.
SIGNATURE_BLOCK, SET_BLOCK = 2048, 512
#: Shingles in one step of a comparison of sets.
SHINGLE_STEP = 8192

_random = np.random.default_rng(20)
_FACTOR = _random.integers(0, 1 << 31, BANDS * ROWS + LANES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERM = _random.integers(0, 1 << 32, BANDS * ROWS + LANES, dtype=np.uint32)
_PER_WORD = 64 // BITS
_EVEN = int("01" * _PER_WORD, 2)


def shingle_sets(run: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a run of texts, text after text, and where each begins."""
    words, begins = word_hashes(run, lower=True)
    n = np.diff(begins)
    counts = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    doc = np.repeat(np.arange(len(run)), counts)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begins[doc] + place
    short = n[doc] < width
    value = np.full(len(doc), 0x5851F42D4C957F2D, np.uint64)
    for i in range(width):
        inside = ~short | (i < n[doc])
        word = words[np.minimum(at + i, len(words) - 1)] if len(words) else words
        value = np.where(inside, mix(value * np.uint64(0xD1342543DE82EF95) + word), value)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return value, np.searchsorted(doc, np.arange(len(run) + 1))


def _minima(values: np.ndarray, begins: np.ndarray, which: slice) -> np.ndarray:
    """Some of the minima of each set; no set may be empty."""
    low = (values >> np.uint64(32)).astype(np.uint32)
    factors, terms = _FACTOR[which], _TERM[which]
    out = np.empty((len(factors), len(begins)), np.uint32)
    for k, (a, b) in enumerate(zip(factors, terms, strict=True)):
        out[k] = np.minimum.reduceat(low * a + b, begins)
    return out


def _buckets(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Bucket names of each set, one per band."""
    minima = _minima(values, begins, slice(0, BANDS * ROWS))
    rows = minima.reshape(BANDS, ROWS, -1).astype(np.uint64)
    bucket = np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * np.ones_like(rows[:, 0])
    for i in range(ROWS):
        bucket = mix(bucket * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return bucket.T


def _packed(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The low bits of each set's minima, in words of 64 bits."""
    minima = _minima(values, begins, slice(BANDS * ROWS, None))
    bits = ((minima ^ (minima >> np.uint32(16))) & np.uint32((1 << BITS) - 1)).astype(np.uint64)
    packed = np.zeros((len(bits) // _PER_WORD, bits.shape[1]), np.uint64)
    for lane in range(_PER_WORD):
        packed |= bits[lane::_PER_WORD] << np.uint64(lane * BITS)
    return packed.T


def _lists(values: np.ndarray, width: int) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, len(values) * width + 1, width), pa.int32()),
        pa.array(np.ascontiguousarray(values).view(np.int64).ravel()),
    )


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple]:
    """First row, number of rows, shingles, their begins, and which rows have any."""
    for first, run in slices(utf8(batch.column(1))):
        values, begins = shingle_sets(run, width)
        yield first, len(run), values, begins, np.flatnonzero(np.diff(begins))


def bucketed(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """id, text_hash, n_shingles, digest of the set and buckets of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, values, begins, used in _sets(batch, width):
                buckets = np.zeros((n, BANDS), np.uint64)
                if len(used):
                    buckets[used] = _buckets(values, begins[used])
                sets = (values[a:b].tobytes() for a, b in zip(begins, begins[1:], strict=False))
                digests = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        batch.column(2).slice(first, n),
                        pa.array(np.diff(begins), pa.int64()),
                        pa.array(digests, pa.binary()),
                        _lists(buckets, BANDS),
                    ],
                    ["id", "text_hash", "n_shingles", "digest", "buckets"],
                )

    return _texts(docs, id_col, text_col).mapInArrow(
        tidy(rows), "id bigint, text_hash bigint, n_shingles bigint, digest binary, buckets array<bigint>"
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("text_hash"),
    )


def signatures(texts: DataFrame, width: int) -> DataFrame:
    """node, its full shingle set and its packed signature, of rows (id, text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, values, begins, used in _sets(batch, width):
                packed = np.zeros((n, LANES // _PER_WORD), np.uint64)
                if len(used):
                    packed[used] = _packed(values, begins[used])
                sets = [values[a:b].tobytes() for a, b in zip(begins, begins[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(sets, pa.binary()),
                        _lists(packed, packed.shape[1]),
                    ],
                    ["node", "shingles", "packed"],
                )

    return texts.mapInArrow(tidy(rows), "node bigint, shingles binary, packed array<bigint>")


def estimated_similarity(a: str, b: str):
    """Similarity from two packed signatures: agreeing lanes, less those that agree by chance."""
    unequal = F.lit(0)
    for i in range(LANES // _PER_WORD):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        lanes = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_EVEN))
        unequal = unequal + F.bit_count(lanes)
    agree = 1 - unequal / float(LANES)
    chance = 1.0 / (1 << BITS)
    return (agree - chance) / (1 - chance)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b): the smallest node it can reach.

    Labels travel along edges, and each round also takes over the label of its label, so
    the number of rounds grows with the logarithm of the longest path.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    both = stored(both.distinct(), "links")
    nearest = both.groupBy("a").agg(F.min("b").alias("least"))
    labels = stored(nearest.select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "labels")
    while True:
        told = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("told"))
        step = labels.join(told, labels["node"] == told["a"]).select("node", F.col("label").alias("old"), F.least("label", "told").alias("near"))
        step = stored(step, "labels")
        jump = step.select(F.col("node").alias("via"), F.col("near").alias("far"))
        new = stored(
            step.join(jump, step["near"] == jump["via"], "left").select(
                "node", F.least("near", F.coalesce("far", "near")).alias("label"), "old"
            ),
            "labels",
        )
        if new.filter(F.col("label") != F.col("old")).isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


class _Classes:
    """Labels of the nodes linked so far. Nodes that aren't in the table label themselves."""

    def __init__(self):
        self.table: DataFrame | None = None

    def of(self, rows: DataFrame, node: str, label: str) -> DataFrame:
        """`rows` with the label of `node`."""
        if self.table is None:
            return rows.withColumn(label, F.col(node))
        known = self.table.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
        joined = rows.join(known, rows[node] == known["_node"], "left")
        return joined.withColumn(label, F.coalesce("_label", node)).drop("_node", "_label")

    def link(self, edges: DataFrame) -> None:
        """Merge the classes at the ends of `edges` (a, b)."""
        if self.table is not None:
            edges = self.of(self.of(edges, "a", "la"), "b", "lb")
            edges = edges.select(F.col("la").alias("a"), F.col("lb").alias("b"))
        merged = components(edges)
        if self.table is None:
            self.table = merged
            return
        new = merged.select(F.col("node").alias("_old"), F.col("label").alias("_new"))
        old = self.table
        moved = old.join(new, old["label"] == new["_old"], "left").select(
            "node", F.coalesce("_new", "label").alias("label")
        )
        joined = merged.join(old.select("node"), "node", "left_anti").select("node", "label")
        self.table = stored(moved.union(joined), "labels")


def _confirmed(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            good = []
            for x, y in zip(a, b, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = signed.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = signed.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.select("a", "b", "sa", "sb").mapInArrow(tidy(similar), "a bigint, b bigint")


class _Union:
    """Union of labels within a task; tells which links are new."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    def links(self, pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
        new = []
        for a, b in pairs:
            x, y = self.root(a), self.root(b)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                new.append((a, b))
        return new


def _connecting(similar, left: pa.Table, right: pa.Table) -> pa.Table:
    """Links between labels that `similar` finds, less those that connect nothing new.

    `similar` takes both tables and yields, per row of the right one, which rows of the
    left one are similar.
    """
    union, found = _Union(), []
    mine, others = np.asarray(left.column("label")), np.asarray(right.column("label"))
    if len(mine) and len(others):
        for label, hit in zip(others.tolist(), similar(left, right), strict=True):
            met = np.unique(mine[hit & (mine != label)])
            found += union.links((label, m) for m in met.tolist())
    return pa.table(
        {
            "a": pa.array([a for a, _ in found], pa.int64()),
            "b": pa.array([b for _, b in found], pa.int64()),
        }
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = np.asarray(column.combine_chunks().flatten()).view(np.uint64)
    return flat.reshape(len(column), -1)


def _alike(percent: int):
    """Signatures whose estimate is near the threshold or above."""
    least = percent / 100 - MARGIN
    chance = 1.0 / (1 << BITS)
    most = int((1 - (least * (1 - chance) + chance)) * LANES)

    def similar(left: pa.Table, right: pa.Table) -> Iterator[np.ndarray]:
        packed = _matrix(left.column("packed"))
        for one in _matrix(right.column("packed")):
            x = packed ^ one
            lanes = (x | (x >> np.uint64(1))) & np.uint64(_EVEN)
            yield np.bitwise_count(lanes).sum(axis=1, dtype=np.int64) <= most

    return similar


def _equal_enough(percent: int):
    """Full sets that meet the threshold: intersections as products of incidence matrices."""

    def similar(left: pa.Table, right: pa.Table) -> Iterator[np.ndarray]:
        sets = [
            [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
            for t in (left, right)
        ]
        both = np.zeros((len(sets[1]), len(sets[0])), np.float32)
        flat = [np.concatenate(x) for x in sets]
        owner = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in sets]
        common = np.intersect1d(flat[0], flat[1])
        places = [np.searchsorted(common, x) for x in flat]
        inside = [
            (p < len(common)) & (common[np.minimum(p, len(common) - 1)] == x) if len(common) else np.zeros(len(x), bool)
            for p, x in zip(places, flat, strict=True)
        ]
        for low in range(0, len(common), SHINGLE_STEP):
            parts = []
            for p, o, k, x in zip(places, owner, inside, sets, strict=True):
                now = k & (p >= low) & (p < low + SHINGLE_STEP)
                part = np.zeros((len(x), min(SHINGLE_STEP, len(common) - low)), np.float32)
                part[o[now], p[now] - low] = 1
                parts.append(part)
            both += parts[1] @ parts[0].T
        sizes = [np.array([len(y) for y in x]) for x in sets]
        for row, size in zip(both.astype(np.int64), sizes[1], strict=True):
            yield 100 * row >= percent * (sizes[0] + size - row)

    return similar


def _by_blocks(rows: DataFrame, key: str, block: int, value: str, similar) -> DataFrame:
    """Links (a, b) between labels of one `key`: outsiders against all rows of the key.

    `rows`: key, node, label, outside, and `value`, which `similar` compares. Both sides
    are cut into blocks, and each pair of blocks is one small group, however large the key.
    """
    sizes = rows.groupBy(key).agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"),
        F.ceil(F.count_if("outside") / block).cast("int").alias("outside_blocks"),
    )
    sized = rows.join(stored(sizes.filter("outside_blocks > 0"), "block-counts"), key)
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = sized.select(
        key, own("blocks").alias("i"), every("outside_blocks").alias("j"), "label", value
    )
    names = ["key", "i", "j", "label", value]
    right = sized.filter("outside").select(
        F.col(key).alias("key_b"),
        every("blocks").alias("i_b"),
        own("outside_blocks").alias("j_b"),
        F.col("label").alias("label_b"),
        F.col(value).alias("value_b"),
    )
    return (
        left.groupBy(key, "i", "j")
        .cogroup(right.groupBy("key_b", "i_b", "j_b"))
        .applyInArrow(
            lambda a, b: _connecting(similar, a.rename_columns(names), b.rename_columns(names)),
            "a bigint, b bigint",
        )
    )


def _link_the_rest(
    members: DataFrame, signed: DataFrame, classes: _Classes, percent: int
) -> None:
    """Link classes that share a bucket, beyond the links of its documents to its head.

    `members`: bucket, node and head of buckets of three or more.
    """
    labelled = classes.of(classes.of(members, "node", "label"), "head", "main")
    labelled = labelled.withColumn("outside", F.col("label") != F.col("main"))
    labelled = stored(labelled.select("bucket", "node", "label", "outside"), "labelled")
    mixed = labelled.filter("outside").select("bucket").distinct()
    rows = labelled.join(stored(mixed, "mixed"), "bucket", "left_semi")
    rows = stored(rows.join(signed.select("node", "packed"), "node"), "bucket-rows")
    maybe = stored(_by_blocks(rows, "bucket", SIGNATURE_BLOCK, "packed", _alike(percent)), "maybe")
    if maybe.isEmpty():
        return
    # Clusters of classes that may be linked, and their documents in those buckets.
    clusters = components(maybe).select(F.col("node").alias("label"), F.col("label").alias("cluster"))
    nodes = rows.select("node", "label").distinct().join(stored(clusters, "clusters"), "label")
    nodes = stored(nodes, "cluster-nodes")
    largest = nodes.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = largest.groupBy("cluster").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    rows = nodes.join(stored(largest, "largest"), "cluster").select(
        "cluster", "node", "label", (F.col("label") != F.col("main")).alias("outside")
    )
    rows = stored(rows.join(signed.select("node", "shingles"), "node"), "cluster-rows")
    links = _by_blocks(rows, "cluster", SET_BLOCK, "shingles", _equal_enough(percent))
    links = stored(links, "edges")
    if not links.isEmpty():
        classes.link(links)


def _nodes(sets: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """`sets` with a node each, and links (a, b) between nodes of one id, or None.

    The node of a set is its smallest id. If rows repeat an id with other texts, it may be
    the smallest of several sets: one of them has it as its node, others a number above
    2**62, which is never the smallest of a class as it is linked to the id's other sets.
    """
    several = docs.groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    several = stored(several.filter("low <> high").select("id"), "repeated-ids")
    if several.isEmpty():
        return sets.withColumn("node", F.col("least.id")), None
    pairs = stored(docs.join(several, "id").select("id", "digest").distinct(), "repeated-sets")
    theirs = sets.join(pairs.select("digest").distinct(), "digest").select(
        "digest", F.col("least.id").alias("least_id")
    )
    nth = F.row_number().over(W.partitionBy("least_id").orderBy("digest"))
    high = F.xxhash64("digest").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    other = theirs.withColumn("nth", nth).filter("nth > 1").select("digest", high.alias("high"))
    named = sets.join(stored(other, "other-nodes"), "digest", "left")
    named = named.withColumn("node", F.coalesce("high", "least.id")).drop("high")
    named = stored(named, "sets")
    nodes = pairs.join(named.select("digest", "node"), "digest")
    links = nodes.select(F.min("node").over(W.partitionBy("id")).alias("a"), F.col("node").alias("b"))
    return named, stored(links.filter("a <> b").distinct(), "links-of-ids")


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of `docs`: id, n_shingles, component_id (smallest id linked), kept.

    Two documents are linked if 100 * intersection >= percent * union of their shingle
    sets. Signatures are laid out for thresholds of 80 percent or more.
    """
    if percent < 80:
        raise ValueError("bands and signatures are laid out for 80 percent or more")
    known = stored(bucketed(docs, width, id_col, text_col), "shingled")
    some = known.filter((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    per_set = some.groupBy("digest").agg(
        F.min(F.struct("id", "text_hash")).alias("least"),
        F.first("buckets").alias("buckets"),
        F.count(F.lit(1)).alias("n"),
    )
    sets, of_one_id = _nodes(stored(per_set, "sets"), some)
    buckets = sets.select("node", F.explode("buckets").alias("bucket"))
    # The head of a bucket is the member whose id is nearest to the bucket's name, a
    # random number, by exclusive or.
    near = F.col("node").bitwiseXOR(F.col("bucket"))
    shared = buckets.groupBy("bucket").agg(
        F.min(near).alias("nearest"), F.count(F.lit(1)).alias("size")
    )
    shared = stored(
        shared.filter("size > 1").select(
            "bucket", "size", F.col("nearest").bitwiseXOR(F.col("bucket")).alias("head")
        ),
        "buckets",
    )
    # A scan on either side: Spark splits the rows of a very large bucket by itself.
    members = stored(buckets.join(shared, "bucket"), "members")
    classes = _Classes()
    if of_one_id is not None:
        classes.link(of_one_id)

    # Only documents that share a bucket are read again, once, for signature and set.
    wanted = members.select("node").distinct()
    texts = _texts(docs, id_col, text_col)
    if of_one_id is None:
        # All texts of an id that have a word have its set: a table of ids alone, which is
        # small enough to be broadcast for longer, finds them.
        wanted = stored(wanted.select(F.col("node").alias("id")), "wanted")
        texts = texts.filter(F.col("text").rlike(WORD)).join(wanted, "id").dropDuplicates(["id"])
        texts = texts.select(F.col("id").alias("node"), "text")
    else:
        of_set = sets.select(
            "node", F.col("least.id").alias("id"), F.col("least.text_hash").alias("text_hash")
        )
        wanted = stored(wanted.join(of_set, "node"), "wanted")
        texts = texts.join(wanted, ["id", "text_hash"])
        texts = texts.dropDuplicates(["id", "text_hash"]).select("node", "text")
    signed = stored(signatures(texts, width), "signatures")

    def promising(pairs: DataFrame) -> DataFrame:
        """Distinct pairs whose estimate is near the threshold or above."""
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        pairs = pairs.filter(F.col("a") != F.col("b")).distinct()
        left = signed.select(F.col("node").alias("a"), F.col("packed").alias("pa"))
        right = signed.select(F.col("node").alias("b"), F.col("packed").alias("pb"))
        joined = pairs.join(left, "a").join(right, "b")
        joined = joined.withColumn("estimate", estimated_similarity("pa", "pb"))
        return joined.filter(F.col("estimate") >= percent / 100 - MARGIN).select(
            "a", "b", "estimate"
        )

    def link(pairs: DataFrame) -> None:
        """Confirm pairs between classes, and merge the classes that they link."""
        between = classes.of(classes.of(pairs, "a", "la"), "b", "lb").filter("la != lb")
        edges = stored(_confirmed(between, signed, percent), "edges")
        if not edges.isEmpty():
            classes.link(edges)

    # For each document first the pair that is most similar; most other pairs then lie
    # within a class and need no confirmation.
    with_heads = members.select(F.col("node").alias("x"), F.col("head").alias("y"))
    best = W.partitionBy("b").orderBy(F.col("estimate").desc(), "a")
    pairs = stored(promising(with_heads).withColumn("n", F.row_number().over(best)), "pairs")
    link(pairs.filter("n = 1"))
    link(pairs.filter("n > 1"))

    _link_the_rest(members.filter("size > 2"), signed, classes, percent)

    per_digest = classes.of(sets.select("digest", "node", "n"), "node", "component")
    # The class of the smallest id of a set is the class of the set.
    of_set = stored(per_digest.select("digest", "component", "n"), "components")
    rows = known.select("id", "n_shingles", "digest")
    joined = attach_per_key(rows, of_set, ["digest"], ["id"], size="n")
    alone = (F.col("n_shingles") == 0) | F.col("id").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component"))
    return joined.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
