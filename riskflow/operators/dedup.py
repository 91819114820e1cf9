"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dedup_any(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keep one row per key, no matter which."""
    return df.dropDuplicates(list(key))


def dedup_latest(df: DataFrame, key: Sequence[str], latest: Sequence[str | Column]) -> DataFrame:
    """Keep the row that is greatest on `latest`, compared column by column.

    `row_number() = 1` lets Spark cut every key down to one row per map task
    before the shuffle, so copies of a hot key never travel. Rows that tie on
    `latest` are told apart by their other content, so a rerun keeps the same one, even
    if it gives all rows another load time.
    """
    order = [F.desc_nulls_last(c) if isinstance(c, str) else c for c in latest]
    compared = {c for c in latest if isinstance(c, str)}
    content = [c for c in df.columns if c not in compared] or list(key)
    w = W.partitionBy(*key).orderBy(*order, F.xxhash64(*content))
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
