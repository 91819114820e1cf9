"""True look-back values on every transaction: 30-day count, mean and maximum, 7-day declines.

Time is cut into slices as long as the longer window, so a window that ends in a slice covers
the end of the slice before and the beginning of its own. Rows of one instant are combined
first. Each instant is then shown twice: in its own slice at its own time, and in the next
slice at the time when it leaves the window. In a slice the window's value is that of the own
rows so far, together with that of the shown rows still to come: a running sum or maximum
forwards and one backwards. Nothing is subtracted, so sums of amounts lose no digits, and a
maximum costs no more than a sum. Work is linear in the instants, however busy a customer is,
and no task holds more than two slices of one customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.operators.skew import attach_per_key
from riskflow.operators.transactions import _micros

DAY = 86_400_000_000
#: What `rolling_values` adds per instant.
ROLLING = (
    "txn_count_30d_rolling",
    "avg_txn_amount_30d_rolling",
    "max_txn_amount_30d_rolling",
    "declined_txn_count_7d_rolling",
)


def rolling_values(
    txn: DataFrame,
    days: int = 30,
    decline_days: int = 7,
    customer: str = "customer_id",
    ts: str = "transaction_ts",
) -> DataFrame:
    """One row per (customer, instant) with `ROLLING` and `_rows`, the rows of the instant.

    Windows reach from `days` (or `decline_days`, which is at most `days`) before the
    instant up to and including it; both ends count. Rows without a time are left out.
    Amounts that are NULL count as transactions, but not in the mean or maximum.
    """
    if not 0 < decline_days <= days:
        raise ValueError("decline_days must be positive and at most days")
    width, decline_width = days * DAY, decline_days * DAY
    at, slice_ = F.col("_at"), F.col("_slice")
    instants = (
        txn.filter(F.col(ts).isNotNull())
        .groupBy(customer, ts)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count("amount").alias("_known"),
            F.sum("amount").alias("_sum"),
            F.max("amount").alias("_max"),
            F.count_if(F.col("status") == "declined").alias("_declined"),
        )
        .withColumn("_at", _micros(txn, ts))
        .withColumn("_slice", F.floor(at / width).cast("bigint"))
    )
    no_time = F.lit(None).cast(txn.schema[ts].dataType)
    none, zero = F.lit(None), F.lit(0).cast("bigint")

    def shown(
        time: Column, where: Column, own: bool = False, later: bool = False,
        declined: Column = zero, later_declined: Column = zero,
    ) -> Column:
        """A row of a slice: what counts from `time` on, and what counts until then."""
        parts = [time.alias("_time"), where.alias("_where"), (F.col(ts) if own else no_time).alias(ts)]
        for name, used in (("", own), ("_later", later)):
            parts += [
                (F.col("_rows") if used else zero).alias(f"_rows{name}"),
                (F.col("_known") if used else zero).alias(f"_known{name}"),
                (F.col("_sum") if used else none.cast("double")).alias(f"_sum{name}"),
                (F.col("_max") if used else none.cast("double")).alias(f"_max{name}"),
            ]
        return F.struct(*parts, declined.alias("_declined"), later_declined.alias("_declined_later"))

    out_of_reach = F.floor((at + decline_width + 1) / width) == slice_
    reaches_next = F.floor((at + decline_width) / width) > slice_
    rows = instants.select(
        customer,
        F.inline(
            F.filter(
                F.array(
                    shown(at, slice_, own=True, declined=F.col("_declined")),
                    shown(at + width, slice_ + 1, later=True),
                    # Declines leave their shorter window in their own slice or in the next.
                    F.when(
                        out_of_reach, shown(at + decline_width + 1, slice_, declined=-F.col("_declined"))
                    ),
                    F.when(
                        reaches_next,
                        shown(at + decline_width, slice_ + 1, later_declined=F.col("_declined")),
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        ),
    )
    in_slice = W.partitionBy(customer, "_where")
    so_far = in_slice.orderBy("_time").rangeBetween(W.unboundedPreceding, W.currentRow)
    to_come = in_slice.orderBy(F.desc("_time")).rangeBetween(W.unboundedPreceding, W.currentRow)
    both = lambda name: F.sum(name).over(so_far) + F.sum(f"{name}_later").over(to_come)
    total = F.coalesce(F.sum("_sum").over(so_far), F.lit(0.0)) + F.coalesce(
        F.sum("_sum_later").over(to_come), F.lit(0.0)
    )
    count, average, largest, declined = ROLLING
    return (
        rows.withColumns(
            {
                count: both("_rows"),
                "_n": both("_known"),
                "_total": total,
                largest: F.greatest(F.max("_max").over(so_far), F.max("_max_later").over(to_come)),
                declined: both("_declined"),
            }
        )
        .filter(F.col(ts).isNotNull())
        .withColumn(average, F.try_divide("_total", "_n"))
        .select(customer, ts, *ROLLING, "_rows")
    )


def with_rolling_values(
    txn: DataFrame,
    days: int = 30,
    decline_days: int = 7,
    customer: str = "customer_id",
    ts: str = "transaction_ts",
    row_id: str = "transaction_id",
) -> DataFrame:
    """`rolling_values` on each transaction; NULL where its time is unknown."""
    rolling = rolling_values(txn, days, decline_days, customer, ts)
    return attach_per_key(txn, rolling, [customer, ts], [row_id], size="_rows", null_safe=True)
