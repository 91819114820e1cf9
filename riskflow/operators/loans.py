"""Signals on loan applications and repayments that need other rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.operators.skew import attach_per_key, hot_keys, split_hot
from riskflow.sources.tables import stored

#: Rows of a range of the order of all repayments.
RANGE_ROWS = 2_000_000


# --- applications ------------------------------------------------------------
# `source` is where an operator counts, by default the rows it adds to. Operators that
# follow each other all count on one early stage, which keeps the plan small.


def with_applications_per_customer(
    applications: DataFrame,
    out: str = "applications_last_30d",
    customer: str = "customer_id",
    source: DataFrame | None = None,
) -> DataFrame:
    """All applications of the customer, on each of their rows (all time)."""
    counts = (applications if source is None else source).groupBy(customer).agg(
        F.count("application_id").alias(out), F.count(F.lit(1)).alias("_rows")
    )
    return attach_per_key(
        applications, counts, [customer], ["application_id"], size="_rows", null_safe=True
    )


def with_shared_flag(
    applications: DataFrame,
    column: str,
    out: str,
    customer: str = "customer_id",
    source: DataFrame | None = None,
) -> DataFrame:
    """True where another customer uses the same value of `column`.

    More than one distinct customer is the same as a smallest customer that differs
    from the largest, which needs no distinct count. A NULL value is never shared.
    """
    per_value = (
        (applications if source is None else source)
        .filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(
            (F.min(customer) != F.max(customer)).alias("_shared"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    # Stored, so that Spark sees if there are few values, and moves no applications to join them.
    per_value = stored(per_value, "shared-values")
    joined = attach_per_key(applications, per_value, [column], ["application_id"], size="_rows")
    return joined.withColumn(out, F.coalesce("_shared", F.lit(False))).drop("_shared")


def agent_approval(applications: DataFrame, agent: str = "agent_id") -> DataFrame:
    """Per agent: `agent_approval_rate` and the number of rows, `_rows`."""
    approved = F.count_if(F.col("application_status") == "approved")
    return applications.groupBy(agent).agg(
        F.try_divide(approved, F.count("application_id")).alias("agent_approval_rate"),
        F.count(F.lit(1)).alias("_rows"),
    )


def with_agent_approval_rate(
    applications: DataFrame, agent: str = "agent_id", source: DataFrame | None = None
) -> DataFrame:
    """The approved share of the agent's applications; NULL without an agent."""
    per_agent = agent_approval(applications if source is None else source, agent).filter(F.col(agent).isNotNull())
    per_agent = stored(per_agent, "agents")  # few, as the values above
    return attach_per_key(applications, per_agent, [agent], ["application_id"], size="_rows")


def applications_in_window(
    applications: DataFrame,
    days: int = 30,
    customer: str = "customer_id",
    date: str = "application_date",
    branch: str = "branch_id",
) -> DataFrame:
    """Applications and distinct branches in the `days` before each date, inclusive.

    One row per (customer, date): `applications_30d_rolling`,
    `distinct_branches_30d_rolling`, `applications_on_date`. Rows are first summed to (customer, date), so a
    window never holds more than one row per calendar day. Distinct branches need no
    sets: a branch counts from a day it is used until `days` later or until its next
    use, whichever is first, so the count on a day is a running sum of starts less ends.
    """
    dated = applications.filter(F.col(date).isNotNull()).withColumn("_day", F.unix_date(date))
    per_branch = dated.groupBy(customer, branch, date, "_day").agg(F.count(F.lit(1)).alias("_n"))

    by_use = W.partitionBy(customer, branch).orderBy("_day")
    ends = F.least(F.lead("_day").over(by_use), F.col("_day") + days + 1)
    uses = per_branch.select(
        customer, "_day", "_n", F.col(branch).isNotNull().alias("_known"), ends.alias("_end")
    )
    # A start carries the day's applications; an end only takes the branch away.
    changes = uses.select(
        customer,
        F.inline(
            F.array(
                F.struct(
                    F.col("_day"), F.col("_n"), F.col("_known").cast("bigint").alias("_branches")
                ),
                F.struct(
                    F.col("_end").alias("_day"),
                    F.lit(0).cast("bigint").alias("_n"),
                    (-F.col("_known").cast("bigint")).alias("_branches"),
                ),
            )
        ),
    )
    per_day = changes.groupBy(customer, "_day").agg(
        F.sum("_n").alias("_n"), F.sum("_branches").alias("_branches")
    )
    by_day = W.partitionBy(customer).orderBy("_day")
    return (
        per_day.withColumn(
            "applications_30d_rolling", F.sum("_n").over(by_day.rangeBetween(-days, W.currentRow))
        )
        .withColumn(
            "distinct_branches_30d_rolling",
            F.sum("_branches").over(by_day.rowsBetween(W.unboundedPreceding, W.currentRow)),
        )
        .filter("_n > 0")
        .select(
            customer,
            F.date_from_unix_date(F.col("_day")).alias(date),
            "applications_30d_rolling",
            "distinct_branches_30d_rolling",
            F.col("_n").alias("applications_on_date"),
        )
    )


def with_applications_in_window(
    applications: DataFrame,
    days: int = 30,
    customer: str = "customer_id",
    date: str = "application_date",
    branch: str = "branch_id",
) -> DataFrame:
    """`applications_in_window` on each application; NULL where its date is unknown."""
    rolling = applications_in_window(applications, days, customer, date, branch)
    return attach_per_key(
        applications, rolling, [customer, date], ["application_id"],
        size="applications_on_date", null_safe=True,
    )


# --- repayments --------------------------------------------------------------
def with_cumulative_missed(
    repayments: DataFrame,
    out: str = "consecutive_missed_count",
    customer: str = "customer_id",
    due: str = "due_date",
    missed: str = "is_missed",
    repayment: str = "repayment_id",
    source: DataFrame | None = None,
    in_task: bool = False,
) -> DataFrame:
    """Missed payments of the customer up to and including each due date.

    Rows due on one day share the value and a NULL due date comes first. A customer's rows are
    one group, which is shuffled once and left spread by customer. For customers with too
    many rows for a task, and for rows counted in another `source`, the running sum goes over
    one row per (customer, due date) and is joined back.

    `in_task` says that no customer has too many rows for a task, in `source` neither. Then its
    misses are shuffled along with the rows, which also lie in the order of due date and
    repayment id, as `with_missed_streak` needs them.
    """
    if in_task:
        return _missed_so_far(repayments, out, customer, due, missed, repayment, source)
    if source is None:
        hot, _ = hot_keys(repayments, customer)
        rest = repayments
        if hot is not None:
            rest, busy = split_hot(repayments, hot, customer)
        by_day = W.partitionBy(customer).orderBy(due).rangeBetween(W.unboundedPreceding, W.currentRow)
        missed_so_far = F.sum(F.when(F.col(missed), 1).otherwise(0).cast("bigint")).over(by_day)
        counted = rest.withColumn(out, missed_so_far)
        if hot is None:
            return counted
        joined = with_cumulative_missed(busy, out, customer, due, missed, repayment, source=busy)
        return counted.unionByName(joined)
    per_day = source.groupBy(customer, due).agg(
        F.count_if(F.col(missed)).alias("_missed"), F.count(F.lit(1)).alias("_rows")
    )
    w = W.partitionBy(customer).orderBy(due).rowsBetween(W.unboundedPreceding, W.currentRow)
    running = per_day.select(customer, due, F.sum("_missed").over(w).alias(out), "_rows")
    return attach_per_key(
        repayments, running, [customer, due], [repayment], size="_rows", null_safe=True
    )


def _missed_so_far(
    repayments: DataFrame,
    out: str,
    customer: str,
    due: str,
    missed: str,
    repayment: str,
    source: DataFrame | None,
) -> DataFrame:
    """The misses of `source` up to each row's due date, where the rows of a customer lie.

    Only misses add to the count, so of `source` they alone are shuffled, with two columns.
    """
    rows = repayments.withColumn("_row", F.lit(True))
    misses = (repayments if source is None else source).filter(missed).select(customer, due)
    both = rows.unionByName(misses, allowMissingColumns=True).repartition(customer)
    lying = both.sortWithinPartitions(customer, F.col(due).asc_nulls_first(), repayment)
    by_day = W.partitionBy(customer).orderBy(due).rangeBetween(W.unboundedPreceding, W.currentRow)
    so_far = F.count_if(F.col("_row").isNull()).over(by_day)
    return lying.withColumn(out, so_far).filter("_row").drop("_row")


def missed_streak(
    repayments: DataFrame,
    out: str = "missed_streak",
    customer: str = "customer_id",
    due: str = "due_date",
    repayment: str = "repayment_id",
    missed: str = "is_missed",
    ranges: int | None = None,
) -> DataFrame:
    """Length of the run of missed payments that ends at each row (0 if paid).

    Returns `customer`, `due`, `repayment`, `missed` and `out`, see `with_missed_streak`.
    """
    narrow = repayments.select(customer, due, repayment, missed)
    return with_missed_streak(narrow, out, customer, due, repayment, missed, ranges)


def with_missed_streak(
    repayments: DataFrame,
    out: str = "missed_streak",
    customer: str = "customer_id",
    due: str = "due_date",
    repayment: str = "repayment_id",
    missed: str = "is_missed",
    ranges: int | None = None,
    in_task: bool = False,
) -> DataFrame:
    """Add the length of the run of missed payments that ends at each row (0 if paid).

    With `in_task` no customer has too many rows for a task: they are one group each, and are
    not shuffled if they are spread by customer. Otherwise runs follow the total order (due date, repayment id) of each customer. The whole
    order is cut into `ranges` parts of about equal size, which a customer with very many
    rows may span: by default as many as there are shuffle partitions, and more if a part
    would exceed `RANGE_ROWS`. They are stored, as they are read twice. Runs are measured inside a range, and one that is
    still open at its end is carried into the next by a window over one row per
    customer and range.
    """
    if in_task:
        return _streak_in_task(repayments, out, customer, due, repayment, missed)
    # A struct equals another if both hold NULL: rows without a customer stay together. It takes
    # the column's place, so that runs and what is carried read the same columns, and Spark
    # shuffles them once.
    rows = repayments.withColumn("_who", F.struct(customer)).drop(customer)
    order = [F.col(due).asc_nulls_first(), F.col(repayment)]
    parts = ranges or max(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        -(-repayments.count() // RANGE_ROWS),
    )
    ranged = rows.repartitionByRange(parts, "_who", *order)
    ranged = stored(ranged.withColumn("_chunk", F.spark_partition_id()), "repayment-ranges")
    streaks = _runs_by_chunk(ranged, order, missed)
    carry = F.when(F.col("_paid") == 0, F.col("_carry")).otherwise(0)
    streak = F.when(F.col(missed), F.col("_run") + carry).otherwise(0)
    restored = streaks.withColumn(customer, F.col("_who")[customer])
    return restored.select(*repayments.columns, streak.alias(out))


def _streak_in_task(
    rows: DataFrame, out: str, customer: str, due: str, repayment: str, missed: str
) -> DataFrame:
    """Misses so far less those up to the last payment; both sums follow one order."""
    in_order = W.partitionBy(customer).orderBy(F.col(due).asc_nulls_first(), repayment)
    so_far = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = rows.withColumn("_misses", F.count_if(F.col(missed)).over(so_far))
    settled = F.max(F.when(~F.col(missed), F.col("_misses"))).over(so_far)
    run = F.col("_misses") - F.coalesce("_settled", F.lit(0))
    streak = F.when(F.col(missed), run).otherwise(0)
    return counted.withColumn("_settled", settled).select(*rows.columns, streak.alias(out))


def _runs(rows: DataFrame, group: list[str], order: list[Column], missed: str) -> DataFrame:
    """Within each group: payments made so far, `_paid`, and the run of misses, `_run`."""
    so_far = (W.unboundedPreceding, W.currentRow)
    miss = F.col(missed).cast("bigint")
    in_group = W.partitionBy(*group).orderBy(*order).rowsBetween(*so_far)
    in_run = W.partitionBy(*group, "_paid").orderBy(*order).rowsBetween(*so_far)
    counted = rows.withColumn("_paid", F.sum(1 - miss).over(in_group))
    return counted.withColumn("_run", F.sum(miss).over(in_run))


def _runs_by_chunk(rows: DataFrame, order: list[Column], missed: str) -> DataFrame:
    """Runs within chunks, and `_carry`, the run that is open where a chunk begins."""
    group = ["_who", "_chunk"]
    local = _runs(rows, group, order, missed)
    chunks = local.groupBy(*group).agg(
        F.max("_paid").alias("_payments"), F.max(F.struct("_paid", "_run"))["_run"].alias("_open")
    )
    by_chunk = W.partitionBy("_who").orderBy("_chunk")
    so_far = (W.unboundedPreceding, W.currentRow)
    stretch = F.sum((F.col("_payments") > 0).cast("int")).over(by_chunk.rowsBetween(*so_far))
    in_stretch = W.partitionBy("_who", "_stretch").orderBy("_chunk").rowsBetween(*so_far)
    carried = (
        chunks.withColumn("_stretch", stretch)
        .withColumn("_open_all", F.sum("_open").over(in_stretch))
        .withColumn("_carry", F.coalesce(F.lag("_open_all").over(by_chunk), F.lit(0)))
        .select(*group, "_carry")
    )
    # A chunk is one of many ranges of about equal size, so this join needs no salt.
    return local.join(carried, group)


def longest_streak(
    repayments: DataFrame, out: str = "longest_missed_streak", customer: str = "customer_id", **kw
) -> DataFrame:
    """Longest run of missed payments of each customer."""
    return (
        missed_streak(repayments, "_streak", customer, **kw)
        .groupBy(customer)
        .agg(F.max("_streak").alias(out))
    )
