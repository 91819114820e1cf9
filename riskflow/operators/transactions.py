"""Signals on card transactions that need other rows or another table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions import signals
from riskflow.operators.skew import attach_per_key


def with_billing_country(txn: DataFrame, accounts: DataFrame) -> DataFrame:
    """Left join each transaction to its account's billing country.

    `accounts` has one row per account, as the silver table does: the country compared
    with is that of the row which is kept. Where both sides come straight from a scan,
    Spark broadcasts the accounts if they are small, and splits the rows of a very
    busy account if they are not. `txn` may also be the pairs of `account_pairs`.
    """
    return txn.join(accounts.select("account_id", "billing_country"), "account_id", "left")


def account_pairs(
    txn: DataFrame, customer: str = "customer_id", amount: str = "amount"
) -> DataFrame:
    """The pairs of account and customer among the rows, with their number of rows, `_rows`.

    Rows with and without an amount are counted apart, so that pairs and the statistics of
    `with_amount_zscore` read the same columns, and Spark shuffles a feed once for both.
    """
    rows = F.count(amount) + F.count_if(F.col(amount).isNull())
    return txn.groupBy("account_id", customer).agg(rows.alias("_rows"))


def with_time_parts(txn: DataFrame, ts: str = "transaction_ts") -> DataFrame:
    return txn.withColumns(
        {"hour_of_day": signals.hour_of_day(ts), "is_weekend": signals.is_weekend(ts)}
    )


def with_amount_zscore(
    txn: DataFrame,
    customer: str = "customer_id",
    amount: str = "amount",
    out: str = "amount_zscore",
    source: DataFrame | None = None,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Distance of each amount from its customer's mean, in sample deviations.

    0 where the deviation is zero or unknown (one row, constant amounts). Mean and
    deviation come from a map-side combined aggregate that is joined back, not
    from a window, which would hold all rows of a customer in one task. They are
    taken over `source`, by default the rows themselves.

    `pairs` are the `account_pairs` of the rows with more columns, such as the account's
    billing country, that the rows get as well: pairs are few and narrow, so they are joined
    to their customer's statistics first, and the rows are shuffled once for both.
    """
    stats = (txn if source is None else source).groupBy(customer).agg(
        F.avg(amount).alias("_mean"),
        F.stddev_samp(amount).alias("_deviation"),
        F.count(F.lit(1)).alias("_rows"),
    )
    if pairs is None:
        joined = attach_per_key(txn, stats, [customer], [amount], size="_rows", null_safe=True)
    else:
        stats = stats.withColumnRenamed("_rows", "_all_rows")
        known = attach_per_key(
            pairs, stats, [customer], ["account_id"], size="_all_rows", null_safe=True
        )
        joined = attach_per_key(
            txn, known, ["account_id", customer], [amount], size="_rows", null_safe=True
        )
    z = F.when(
        F.col("_deviation") > 0, (F.col(amount) - F.col("_mean")) / F.col("_deviation")
    ).otherwise(0.0)
    return joined.withColumn(out, z).drop("_mean", "_deviation")


def _micros(df: DataFrame, ts: str) -> Column:
    """Microseconds of an instant; of a zoneless timestamp, those of its own clock.

    A zoneless timestamp isn't turned into an instant, which would depend on the zone of
    the session and be ambiguous where clocks are set back.
    """
    if df.schema[ts].dataType == T.TimestampType():
        return F.unix_micros(ts)
    day = F.unix_date(F.col(ts).cast("date")).cast("bigint")
    minutes = (day * 24 + F.hour(ts)) * 60 + F.minute(ts)
    second = F.extract(F.lit("SECOND"), F.col(ts))
    return minutes * 60_000_000 + (second * 1_000_000).cast("bigint")


def _rolling(
    txn: DataFrame, windows: Mapping[str, int], customer: str, ts: str
) -> DataFrame:
    """One row per (customer, instant, window): `customer`, `ts`, `_window`, `_count`.

    Rows of one instant are counted together first, once for all windows. Time is cut into
    slices as long as the longest window, and an instant is also shown to the next slice,
    where it can still be in reach: two narrow rows are shuffled, whatever the number of
    windows. In a slice, an instant adds its rows and takes them away just after the window's
    length: the count is a running sum of starts less ends, linear in the instants of two
    slices, however busy the customer is.
    """
    micros = _micros(txn, ts)
    per_instant = (
        txn.filter(F.col(ts).isNotNull()).groupBy(customer, ts).agg(F.count(F.lit(1)).alias("_n"))
    )
    longest = F.lit(max(windows.values()) * 1_000_000)
    own = F.floor(micros / longest).cast("bigint")
    slices = per_instant.select(customer, ts, "_n", F.explode(F.array(own, own + 1)).alias("_slice"))
    # The instants of a customer's slice are one group; its changes are made where they lie.
    shown = slices.repartition(customer, "_slice").withColumn("_at", micros)
    sizes = F.array(
        *[
            F.struct(F.lit(name).alias("_window"), F.lit(s * 1_000_000).alias("_width"))
            for name, s in windows.items()
        ]
    )
    shown = shown.select(customer, ts, "_n", "_slice", "_at", F.inline(sizes))
    nothing = F.lit(None).cast(txn.schema[ts].dataType)
    change = lambda at, n, instant: F.struct(
        at.alias("_at"), n.alias("_change"), instant.alias(ts)
    )
    at, n = F.col("_at"), F.col("_n")
    start = F.when(F.floor(at / longest).cast("bigint") == F.col("_slice"), F.col(ts))
    end = at + F.col("_width") + 1
    changes = shown.select(
        customer, "_window", "_slice", F.inline(F.array(change(at, n, start), change(end, -n, nothing)))
    )
    # Up to and with the row's time, so changes of one time count together.
    w = W.partitionBy(customer, "_window", "_slice").orderBy("_at").rangeBetween(
        W.unboundedPreceding, W.currentRow
    )
    counted = changes.withColumn("_count", F.sum("_change").over(w))
    return counted.filter(F.col(ts).isNotNull()).select(customer, ts, "_window", "_count")


def rolling_count(
    txn: DataFrame,
    seconds: int,
    out: str,
    customer: str = "customer_id",
    ts: str = "transaction_ts",
) -> DataFrame:
    """Transactions of a customer in the `seconds` up to and including each instant.

    One row per (customer, instant): `customer`, `ts`, `out`.
    """
    rolling = _rolling(txn, {out: seconds}, customer, ts)
    return rolling.select(customer, ts, F.col("_count").alias(out))


def peak_rolling_counts(
    txn: DataFrame,
    windows: Mapping[str, int],
    customer: str = "customer_id",
    ts: str = "transaction_ts",
) -> DataFrame:
    """The busiest stretch of each customer per window: `windows` maps names to seconds."""
    rolling = _rolling(txn, windows, customer, ts)
    return rolling.groupBy(customer).agg(
        *[F.max(F.when(F.col("_window") == name, F.col("_count"))).alias(name) for name in windows]
    )


def peak_rolling_count(
    txn: DataFrame,
    seconds: int,
    out: str,
    customer: str = "customer_id",
    ts: str = "transaction_ts",
) -> DataFrame:
    """The busiest `seconds`-long stretch of each customer: its transaction count."""
    return peak_rolling_counts(txn, {out: seconds}, customer, ts)
