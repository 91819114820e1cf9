"""Exact top-k by inner product: exhaustive, term at a time.

Vectors are sparse rows of (term, integer weight): a component's number is its term.
Rows are dealt into blocks, and a block of candidates is inverted into postings per term.
For a block of queries a task keeps dense score arrays, and term by term scatters each
query's weight times the postings into them. Each task keeps the k best of its block per
query; these partial lists are merged per query. Every query meets every candidate, so
the result is exact.

Defined results: vectors that are NULL or hold NULL or non-finite components take no
part; missing components count as 0, so lengths may differ; rows that share a query's
id are its own rows and no candidates for it; other repeated rows are candidates each;
NULL ids are never queries and come last among ties; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CANDIDATES_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 512
#: Candidates scored at a time inside a task, so that the scores stay in the CPU's cache.
STRIP = 1024


def integer_weights(vector: str, scale: int) -> Column:
    """floor(scale * component) as bigint per component, or NULL if any isn't a finite number."""
    v = F.col(vector)
    finite = F.forall(
        v,
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.when(finite, F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint")))


def _postings(weights: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per term: the rows that have it, and their weights."""
    offsets = np.asarray(weights.offsets)
    values = np.asarray(weights.flatten())
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths)), lengths)
    term = np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], lengths)
    used = values != 0
    row, term, values = row[used], term[used], values[used]
    order = np.argsort(term, kind="stable")
    row, term, values = row[order], term[order], values[order]
    cuts = np.searchsorted(term, np.arange((int(term[-1]) + 1 if len(term) else 0) + 1))
    return [(row[a:b], values[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _scores(queries: list, postings: list, strip: tuple[int, int], n_queries: int) -> np.ndarray:
    """Dense scores of a strip of candidates: one row per query, accumulated term by term."""
    low, high = strip
    scores = np.zeros((n_queries, high - low), np.int64)
    for (q_rows, q_weights), (rows, weights) in zip(queries, postings, strict=False):
        a, b = np.searchsorted(rows, (low, high))
        if a == b or not len(q_rows):
            continue
        if b - a == high - low and len(q_rows) == n_queries:
            scores += q_weights[:, None] * weights[None, a:b]
        else:
            scores[np.ix_(q_rows, rows[a:b] - low)] += q_weights[:, None] * weights[None, a:b]
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, null: np.ndarray, own: np.ndarray, k: int):
    """The k best of each row by (score, smaller id), without the query's own rows."""
    for q in range(len(scores)):
        row = scores[q]
        able = np.flatnonzero((ids != own[q]) | null)
        if len(able) > k:
            values = row[able]
            least = np.partition(values, len(values) - k)[len(values) - k]
            able = able[values >= least]  # with all ties at the border
        order = np.lexsort((ids[able], null[able], -row[able]))[:k]
        yield able[order]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    candidates_per_block: int = CANDIDATES_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """The k candidates with the highest scores for each row for which `is_query` holds.

    Returns query_id, rank (from 1), vec_id, score. Blocks of queries are joined with all
    blocks of candidates; the lists to merge have k rows per query and candidate block.
    """
    rows = vectors.select(
        F.col(id_col).alias("id"),
        integer_weights(vector_col, scale).alias("weights"),
        is_query.alias("is_query"),
    )
    asked = F.col("is_query") & F.col("id").isNotNull()
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(asked).alias("q")).first()
    c_blocks = max(1, -(-sizes["n"] // candidates_per_block))
    q_blocks = max(1, -(-sizes["q"] // queries_per_block))
    rows = rows.filter(F.col("weights").isNotNull())
    row_number = F.monotonically_increasing_id()
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Each pair of blocks is one group: a stated set of queries in blocks against all rows.
    candidates = rows.select("id", "weights", (row_number % c_blocks).cast("int").alias("c_block"))
    candidates = candidates.withColumn("q_block", every(q_blocks))
    queries = rows.filter(asked).select(
        "id", "weights", (row_number % q_blocks).cast("int").alias("q_block")
    )
    queries = queries.withColumn("c_block", every(c_blocks))

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, own = left.column("id").combine_chunks(), np.asarray(right.column("id"))
        null, ids = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0))
        wanted = _postings(right.column("weights").combine_chunks())
        postings = _postings(left.column("weights").combine_chunks())
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))]
        for low in range(0, len(ids) if len(own) else 0, STRIP):
            high = min(low + STRIP, len(ids))
            scores = _scores(wanted, postings, (low, high), len(own))
            for q, pick in enumerate(_best(scores, ids[low:high], null[low:high], own, k)):
                found.append((np.full(len(pick), own[q]), pick + low, scores[q][pick]))
        query, pick, score = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table(
            {
                "query_id": pa.array(query, pa.int64()),
                "vec_id": pa.array(ids[pick], pa.int64(), mask=null[pick]),
                "score": pa.array(score, pa.int64()),
            }
        )

    lists = (
        candidates.groupBy("q_block", "c_block")
        .cogroup(queries.groupBy("q_block", "c_block"))
        .applyInArrow(scored, "query_id bigint, vec_id bigint, score bigint")
    )
    best = W.partitionBy("query_id").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last()
    )
    ranked = lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
