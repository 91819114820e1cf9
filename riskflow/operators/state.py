"""Per-customer state that merges: days and loads are added without reading older rows again.

Two kinds. *Moments* hold counts, means, centred squares and extremes of a set of rows; those
of two sets give those of both. *Daily values* say which countries and merchants a customer
used on a day, as exact bitmaps: values are numbered once, and a row holds 64 numbers as the
bits of one word, so a day of a customer is a few short rows. Bitmaps of several days merge
by `bit_or`, and a distinct count is the sum of `bit_count`; no row is multiplied.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.operators.skew import attach_per_key

# --- moments -------------------------------------------------------------------------
#: Counts that simply add up.
COUNTS = ("n", "n_amount", "n_declined", "n_first_hours", "n_late_night", "n_international", "n_online")


def moments(txn: DataFrame, customer: str = "customer_id") -> DataFrame:
    """The state of a set of transactions, one row per customer."""
    return txn.groupBy(customer).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("amount").alias("n_amount"),
        F.count_if(F.col("status") == "declined").alias("n_declined"),
        F.count_if(F.col("hour_of_day").between(0, 1)).alias("n_first_hours"),
        F.count_if(F.col("hour_of_day").between(0, 4)).alias("n_late_night"),
        F.count_if("is_international").alias("n_international"),
        F.count_if(F.col("channel") == "online").alias("n_online"),
        F.avg("amount").alias("mean_amount"),
        (F.var_pop("amount") * F.count("amount")).alias("squares"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.max("transaction_ts").alias("last_ts"),
    )


def merge_moments(*states: DataFrame, customer: str = "customer_id") -> DataFrame:
    """The state of all rows that several states describe; they must not share rows.

    Squares are centred on their own mean, so a state's part is its squares plus the
    distance of its mean from the common one: no large sums are subtracted.
    """
    rows = reduce(DataFrame.unionByName, states)
    # A few rows per customer, one for each state.
    of_customer = W.partitionBy(customer)
    weighed = F.sum(F.col("mean_amount") * F.col("n_amount")).over(of_customer)
    common = F.try_divide(weighed, F.sum("n_amount").over(of_customer))
    rows = rows.withColumn("_mean", common)
    apart = F.col("n_amount") * (F.col("mean_amount") - F.col("_mean")) ** 2
    return rows.groupBy(customer).agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        F.max("_mean").alias("mean_amount"),
        F.sum(F.col("squares") + apart).alias("squares"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
        F.max("last_ts").alias("last_ts"),
    )


def deviation() -> Column:
    """Sample deviation of the amounts of a state; NULL for fewer than two."""
    return F.when(F.col("n_amount") > 1, F.sqrt(F.col("squares") / (F.col("n_amount") - 1)))


def features_of_moments(state: DataFrame, customer: str = "customer_id") -> DataFrame:
    """The velocity, time-of-day and channel features that a state holds."""
    share = lambda c: F.try_divide(c, "n")
    return state.select(
        customer,
        F.col("n").alias("txn_count_30d"),
        F.col("mean_amount").alias("avg_txn_amount_30d"),
        F.col("max_amount").alias("max_txn_amount_30d"),
        F.col("n_declined").alias("declined_txn_count_7d"),
        F.col("n_first_hours").alias("txn_count_1h"),
        share("n_late_night").alias("late_night_txn_ratio"),
        share("n_international").alias("international_txn_ratio"),
        share("n_online").alias("online_txn_ratio"),
        deviation().alias("amount_deviation"),
    )


def with_zscore_of_state(
    txn: DataFrame, state: DataFrame, customer: str = "customer_id", out: str = "amount_zscore"
) -> DataFrame:
    """Z-scores of new rows against a stored state, which may or may not include them."""
    stats = state.select(
        customer, F.col("mean_amount").alias("_mean"), deviation().alias("_deviation")
    )
    joined = attach_per_key(txn, stats, [customer], ["transaction_id"], null_safe=True)
    z = (F.col("amount") - F.col("_mean")) / F.col("_deviation")
    scored = joined.withColumn(out, F.when(F.col("_deviation") > 0, z).otherwise(0.0))
    return scored.drop("_mean", "_deviation")


# --- daily values ----------------------------------------------------------------------
KINDS = {"country": "merchant_country", "merchant": "merchant_name"}
NUMBERS = "kind string, value string, number bigint"


def number_values(
    txn: DataFrame,
    known: DataFrame | None = None,
    kinds: Mapping[str, str] = KINDS,
    buckets: int = 64,
) -> DataFrame:
    """(kind, value, number): the values of `known` with their numbers, and new ones.

    Values are dealt into `buckets` by their hash and numbered inside their bucket, as many
    tasks at a time; a number is the position in the bucket times `buckets` plus the bucket,
    so numbers are unique and about dense. A later call goes on with the same `buckets`.
    """
    values = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value"))
            for kind, c in kinds.items()
        ]
    )
    new = txn.select(F.inline(values)).filter(F.col("value").isNotNull()).distinct()
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets)).alias("_bucket")
    in_bucket = W.partitionBy("kind", "_bucket").orderBy("value")
    place = F.row_number().over(in_bucket) - 1
    if known is None:
        placed = new.select("kind", "value", bucket).withColumn("_place", place)
    else:
        used = known.groupBy("kind", (F.col("number") % buckets).alias("_bucket")).agg(
            F.count(F.lit(1)).alias("_used")
        )
        fresh = new.join(known.select("kind", "value"), ["kind", "value"], "left_anti")
        placed = fresh.select("kind", "value", bucket).join(used, ["kind", "_bucket"], "left")
        placed = placed.withColumn("_place", place + F.coalesce("_used", F.lit(0)))
    number = F.col("_place").cast("bigint") * buckets + F.col("_bucket")
    numbered = placed.select("kind", "value", number.alias("number"))
    return numbered if known is None else known.unionByName(numbered)


def daily_values(
    txn: DataFrame,
    numbers: DataFrame,
    kinds: Mapping[str, str] = KINDS,
    customer: str = "customer_id",
    ts: str = "transaction_ts",
) -> DataFrame:
    """(customer, day, kind, word, bits, n): the values used per day, and the rows that did.

    Rows are counted per customer, day and value before values are numbered, so the join
    with `numbers` sees no transactions.
    """
    values = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value"))
            for kind, c in kinds.items()
        ]
    )
    used = (
        txn.filter(F.col(ts).isNotNull())
        .select(customer, F.to_date(ts).alias("day"), F.inline(values))
        .filter(F.col("value").isNotNull())
        .groupBy(customer, "day", "kind", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    place = (F.col("number") % 64).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return (
        used.join(numbers, ["kind", "value"])
        .groupBy(customer, "day", "kind", F.floor(F.col("number") / 64).alias("word"))
        .agg(F.bit_or(bit).alias("bits"), F.sum("n").alias("n"))
    )


def merge_daily_values(*parts: DataFrame, customer: str = "customer_id") -> DataFrame:
    """Daily values of several loads as one; a day may be spread over them."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(customer, "day", "kind", "word").agg(
        F.bit_or("bits").alias("bits"), F.sum("n").alias("n")
    )


def distinct_as_of(
    daily: DataFrame,
    as_of: Column,
    windows: Mapping[str, tuple[str, int]] | None = None,
    customer: str = "customer_id",
) -> DataFrame:
    """Distinct values per customer in the days up to and including the date `as_of`.

    `windows` maps names of results to a kind and a number of days; by default countries of
    30 days and merchants of 7. Customers without a row in the longest window are left out.
    """
    windows = windows or {
        "distinct_countries_30d_asof": ("country", 30),
        "distinct_merchants_7d_asof": ("merchant", 7),
    }
    age = F.date_diff(as_of.cast("date"), F.col("day"))
    longest = max(days for _, days in windows.values())
    recent = daily.filter(age.between(0, longest - 1))
    inside = lambda kind, days: (F.col("kind") == kind) & (age < days)
    words = recent.groupBy(customer, "kind", "word").agg(
        *[F.bit_or(F.when(inside(*x), F.col("bits"))).alias(name) for name, x in windows.items()]
    )
    count = lambda c: F.coalesce(F.sum(F.bit_count(c)), F.lit(0)).alias(c)
    return words.groupBy(customer).agg(*[count(c) for c in windows])
