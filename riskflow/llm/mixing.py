"""Mixing sources to target weights by weighted fair queueing, on DataFrame functions only.

Every document waits in the queue of its source, in shuffled order, and once more for
each repeat that is allowed. Its virtual finish time is the number of its source's words
up to and with it, divided by the source's target. The queues are merged by a global sort
on that time and cut at the total budget. All sources reach their targets at the same
virtual time, so each one's share is right at every moment of the mix, not only at its end.

Sizes are in words. A document that is being served when the budget ends is taken in
part: its first words. Orders come from MD5 of the id, so reruns agree.

Defined results: NULL or empty text is a document of no words, which is never taken; NULL
sources are one source, the last; a NULL id is shuffled as an id of its own; repeated rows
are queued one by one; an empty table gives an empty mix; clashing column names do no harm,
as inputs are renamed first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.llm.words import word_count
from riskflow.sources.tables import stored

#: Documents of a source that one task puts in order.
ROWS_PER_BUCKET = 100_000


def targets(
    sizes: DataFrame, weights: Sequence[float], budget_share: float, max_repeats: int
) -> DataFrame:
    """Target words per source: shares by weight, none above `max_repeats` times its size.

    `sizes` has one row per source: source, source_size. Sources in code point order,
    NULL last, take `weights` in turn. The excess of those at their limit is shared out
    again by weight: there is one level at which min(limit, weight * level) adds up to
    the budget. Sources in the order of limit / weight fill up one after another.
    """
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")
    )
    ranked = sizes.withColumns(
        {
            "weight": weight,
            "rank": rank,
            "limit": F.col("source_size").cast("double") * max_repeats,
            "budget": F.sum("source_size").over(everything) * F.lit(float(budget_share)),
        }
    )
    by_level = W.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    filled = ranked.withColumns(
        {
            # What is left for this source and the later ones, per unit of their weight.
            "level": (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            / F.sum("weight").over(by_level.rowsBetween(0, W.unboundedFollowing)),
        }
    )
    # The first source that stays below its limit has the level; later ones compute less,
    # as they take this one for full.
    open_level = F.max(
        F.when(F.col("level") * F.col("weight") < F.col("limit"), F.col("level"))
    ).over(everything)
    target = F.least(
        F.col("limit"), F.coalesce(F.col("weight") * open_level, F.col("limit"))
    )
    return filled.select(
        "source", "source_size", "rank", "weight", F.round(target, 6).alias("target")
    )


def prefix_sums(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Sum of `value` over all rows before each row in the global order of `order`.

    Rows are range-sorted over tasks; each task sums its own, and the sums of the tasks
    before it are added. Only one row per task passes through a single place.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    offsets = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = offsets.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = F.coalesce(F.sum(value).over(within), F.lit(0))
    # One row per range, as many as there are shuffle partitions: small by construction.
    joined = ranged.withColumn("_local", local).join(F.broadcast(offsets), "_part")
    return joined.withColumn(out, F.col("_local") + F.col("_offset")).drop(
        "_part", "_local", "_offset"
    )


def schedule(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    budget_share: float = 1.5,
    max_repeats: int = 2,
    seed: str = "mix",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[DataFrame, DataFrame]:
    """The queue of documents and the mix drawn from it.

    Queue: one row per document with `row` (unique), id, size, source, source_size,
    target. Mix: `row`, `repeat` (from 0), `finish` (virtual time), `position` (words of
    the mix before it) and `taken` (words), in the order of `position`.
    """
    order_key = F.conv(
        F.substring(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")), 1, 15),
        16,
        10,
    ).cast("bigint")
    sized = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(text_col).alias("size"),
            order_key.alias("shuffle"),
        ),
        "mix-sizes",
    )
    # Sources are far fewer than documents; each is one row from here on.
    sizes = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    # A code point order is the order of the UTF-8 bytes, which is that of Spark's strings.
    goals = targets(sizes, weights, budget_share, max_repeats)
    goals = stored(goals.join(sizes.select(F.col("source").alias("s"), "n_docs"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-targets")
    known = sized.join(
        goals.withColumnRenamed("source", "g_source"),
        F.col("source").eqNullSafe(F.col("g_source")),
    ).drop("g_source")

    # Shuffled order of each source, in buckets of the 60-bit shuffle key.
    buckets = F.ceil(F.col("n_docs") / rows_per_bucket)
    width = F.ceil(F.lit(float(1 << 60)) / buckets)
    known = known.withColumn("bucket", F.floor(F.col("shuffle") / width).cast("bigint"))
    per_bucket = known.groupBy("rank", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = W.partitionBy("rank").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    per_bucket = per_bucket.select(
        "rank", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset")
    )
    inside = W.partitionBy("rank", "bucket").orderBy("shuffle", F.col("id").asc_nulls_last(), "size")
    numbered = known.withColumns(
        {
            "row": F.row_number().over(inside),
            "local": F.coalesce(
                F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ),
        }
    )
    queue = stored(
        numbered.join(stored(per_bucket, "mix-buckets"), ["rank", "bucket"]).select(
            F.struct("rank", "bucket", "row").alias("row"),
            "id",
            "size",
            "source",
            "source_size",
            "target",
            (F.col("local") + F.col("offset")).alias("before"),
        ),
        "mix-queue",
    )

    waiting = queue.filter(F.col("size") > 0).withColumn(
        "repeat", F.explode(F.array(*[F.lit(i) for i in range(max_repeats)]))
    )
    start = F.col("repeat") * F.col("source_size") + F.col("before")
    waiting = waiting.withColumns(
        {
            "finish": (start + F.col("size")) / F.col("target"),
            # Served before the virtual time 1, at which the targets are reached.
            "served": F.least(
                F.col("size"),
                F.greatest(F.lit(0), F.floor(F.col("target")) - start),
            ).cast("bigint"),
        }
    ).filter(F.col("served") > 0)
    merged = prefix_sums(
        waiting.select("row", "repeat", "finish", "served"), ["finish", "row", "repeat"], "served", "position"
    )
    budget = F.floor(goals.agg(F.sum("source_size").alias("b")).select((F.col("b") * budget_share)).scalar())
    taken = F.least(F.col("served"), budget - F.col("position"))
    mix = merged.select("row", "repeat", "finish", "position", taken.cast("bigint").alias("taken"))
    return queue, mix.filter(F.col("taken") > 0)


def taken_per_document(queue: DataFrame, mix: DataFrame) -> DataFrame:
    """The queue with the words that the mix takes of each document, repeats counted."""
    taken = mix.groupBy("row").agg(F.sum("taken").alias("taken"))
    return queue.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def first_words(text: Column, n: Column) -> Column:
    """The first n words of a text with the white space between and after them."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    return F.array_join(F.slice(pieces, F.lit(1), (n + lead).cast("int")), "")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: rows of `docs`, repeated as often as taken, the last cut to its share.

    Rows with the same id count as one queue entry each, and are told apart by source,
    size and a number among equals.
    """
    queue, mix = schedule(docs, id_col, text_col, **options)
    source_col = options.get("source_col", "source")
    chosen = mix.join(queue.select("row", "id", "size", "source"), "row")
    numbers = W.partitionBy("id", "source", "size", "repeat").orderBy("row")
    # Keys without NULLs, under the same names on both sides: the texts are shuffled once,
    # for their number among equals and for the join.
    key = lambda i, source, size: {
        "__mix_id": F.coalesce(i.cast("bigint"), F.lit(-1)),
        "__mix_source": F.coalesce(source, F.lit("")),
        "__mix_null": F.coalesce(i.isNull().cast("int") * 2 + source.isNull().cast("int"), F.lit(0)),
        "__mix_size": size,
    }
    names = ["__mix_id", "__mix_source", "__mix_null", "__mix_size"]
    chosen = chosen.withColumn("__mix_number", F.row_number().over(numbers)).select(
        *[c.alias(n) for n, c in key(F.col("id"), F.col("source"), F.col("size")).items()],
        "__mix_number",
        F.col("taken").alias("__mix_taken"),
    )
    rows = docs.withColumns(key(F.col(id_col), F.col(source_col), word_count(text_col)))
    # Documents without words are never taken.
    rows = rows.filter(F.col("__mix_size") > 0).repartition(*names)
    own = W.partitionBy(*names).orderBy(text_col)
    rows = rows.withColumn("__mix_same", F.row_number().over(own))
    # As a difference, the number is no key of the join, whose keys are then the window's.
    matched = rows.join(chosen.repartition(*names), names).filter(
        F.col("__mix_same") - F.col("__mix_number") == 0
    )
    taken = F.col("__mix_taken")
    text = F.when(taken >= F.col("__mix_size"), F.col(text_col)).otherwise(
        first_words(F.col(text_col), taken)
    )
    return matched.withColumn(text_col, text).select(*docs.columns)
