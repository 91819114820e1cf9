"""Attaching one-row-per-key results to rows when some keys are very hot.

A shuffle join sends every row of a key to one task, and Spark's adaptive skew
handling does not help here: it needs a plain shuffle on both sides, while these
joins have an aggregate over the key on one side. So keys with more than
`rows_per_task` rows are kept apart. Their few values are broadcast, and their rows
are salted, so that they spread evenly through the shuffle that joins the others.
N rows hold at most N / rows_per_task hot keys (250,000 for a million million
rows), which bounds what is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.sources.tables import stored

ROWS_PER_TASK = 4_000_000
SALTS = 1 << 20
#: Groups of keys whose rows are counted before those of single keys.
GROUPS = 1 << 12


def attach_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: Sequence[str],
    row_id: Sequence[str],
    size: str | None = None,
    null_safe: bool = False,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Left join `per_key` (unique on `key`) onto `rows`; every row is kept once.

    `row_id` names columns that differ among the rows of a key; they spread hot rows.
    `size` names the column of `per_key` that holds the number of rows of the key;
    it is dropped. Without it the rows are counted per key first (one narrow,
    map-side combined pass). With `null_safe` a NULL key matches a NULL key.
    """
    key = list(key)
    limit = ROWS_PER_TASK if rows_per_task is None else rows_per_task
    values = [c for c in per_key.columns if c not in key and c != size]
    if size is None:
        counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_size"))
        big = counted.filter(F.col("_size") > limit).drop("_size")
        hot = _join(per_key, F.broadcast(big), key, null_safe, "left_semi")
        cold = per_key
    else:
        # Both come from one aggregate with the same columns, so Spark computes it
        # once and reuses its shuffle.
        hot = per_key.filter(F.col(size) > limit)
        cold = per_key.filter(F.col(size) <= limit)
    hot = hot.select(
        *key, *[F.col(c).alias(f"_hot_{c}") for c in values], F.lit(True).alias("_hot")
    )
    cold = cold.select(
        # Always 0, yet no constant: a constant would be folded out of the join key.
        *key, *values, F.hash(*key).bitwiseAND(F.lit(0)).alias("_salt")
    )
    marked = _join(rows, F.broadcast(hot), key, null_safe)
    marked = marked.withColumn("_salt", _salt(key, row_id, null_safe))
    joined = _join(marked, cold, [*key, "_salt"], null_safe)
    chosen = [F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)) for c in values]
    return joined.select(
        *rows.columns, *[x.alias(c) for x, c in zip(chosen, values, strict=True)]
    )


def hot_keys(
    rows: DataFrame, key: str, rows_per_task: int | None = None
) -> tuple[DataFrame | None, int]:
    """The keys with more than `rows_per_task` rows, None if there are none, and the row count.

    Rows are counted per group of keys first, which shuffles next to nothing. Only if a group
    has that many are single keys counted. A NULL key is a key.
    """
    limit = ROWS_PER_TASK if rows_per_task is None else rows_per_task
    group = F.pmod(F.xxhash64(key), F.lit(GROUPS)).alias("_group")
    groups = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    largest, total = groups.agg(F.max("_size"), F.sum("_size")).first()
    if (largest or 0) <= limit:
        return None, total or 0
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    hot = stored(counted.filter(F.col("_size") > limit).select(key), "hot-keys")
    return (None if hot.isEmpty() else hot), total


def split_hot(rows: DataFrame, hot: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of other keys, and those of the keys in `hot` (as from `hot_keys`)."""
    flagged = hot.withColumn("_hot", F.lit(True))
    marked = _join(rows, F.broadcast(flagged), [key], null_safe=True)
    return (
        marked.filter(F.col("_hot").isNull()).select(*rows.columns),
        marked.filter("_hot").select(*rows.columns),
    )


def _salt(key: list[str], row_id: Sequence[str], null_safe: bool) -> Column:
    # The row's own columns plus the number of the task: the same on a retry, and exact
    # copies of a row that lie in different tasks still spread.
    spread = F.hash(*row_id).cast("bigint") + F.spark_partition_id()
    salt = F.when(F.col("_hot"), F.pmod(spread, F.lit(SALTS)).cast("int"))
    if not null_safe:  # rows without a key match nothing: spread them as well
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        salt = salt.when(no_key, F.pmod(spread, F.lit(SALTS)).cast("int"))
    return salt.otherwise(0)


def _join(
    left: DataFrame, right: DataFrame, key: list[str], null_safe: bool, how: str = "left"
) -> DataFrame:
    if not null_safe:
        return left.join(right, key, how)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in key})
    match = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in key]
    return left.join(renamed, reduce(lambda a, b: a & b, match), how).drop(
        *[f"_r_{k}" for k in key]
    )
