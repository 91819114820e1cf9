"""Bronze (all strings) to silver (typed, with row signals, one row per key).

Statistics (z-scores, counts, shared flags, running totals) are taken over all rows,
repeated ones included, but are attached to the rows that are kept, so repeated rows
are shuffled once. With `dedup_first` the statistics leave them out as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions import normalize as n
from riskflow.functions import signals
from riskflow.operators import loans, transactions
from riskflow.operators.dedup import dedup_latest
from riskflow.operators.skew import hot_keys, split_hot
from riskflow.sources.tables import stored


def _latest_first(df: DataFrame, *columns: str) -> list[str]:
    return [c for c in ("_ingested_at", *columns) if c in df.columns]


def silver_accounts(bronze: DataFrame) -> DataFrame:
    df = n.cast_columns(bronze, {"credit_limit": "double"})
    df = n.parse_dates(df, ["account_open_date"])
    df = n.labels_lower(df, ["card_type", "card_tier", "account_status"])
    df = n.codes_upper(df, ["billing_country"])
    return dedup_latest(df, ["account_id"], _latest_first(df))


def silver_transactions(
    bronze: DataFrame, accounts: DataFrame, dedup_first: bool = False
) -> DataFrame:
    """`accounts` is the silver table, one row per account."""
    df = bronze.withColumn(
        "transaction_ts", n.combine_date_time("transaction_date", "transaction_time")
    ).drop("transaction_date", "transaction_time")
    df = n.cast_columns(df, {"amount": "double", "is_fraud_label": "int"})
    df = n.codes_upper(df, ["merchant_country", "currency"])
    df = n.labels_lower(df, ["channel", "status"])
    unique = dedup_latest(df, ["transaction_id"], _latest_first(df, "transaction_ts"))
    counted = unique if dedup_first else df

    # The country goes to the pairs of account and customer, and with them to the rows.
    pairs = transactions.with_billing_country(transactions.account_pairs(df), accounts)
    out = transactions.with_amount_zscore(unique, source=counted, pairs=pairs)
    out = out.withColumn("is_international", signals.is_international())
    out = transactions.with_time_parts(out)
    columns = ["account_id", *[x for x in unique.columns if x != "account_id"]]
    return out.select(*columns, "is_international", "hour_of_day", "is_weekend", "amount_zscore")


def silver_applications(bronze: DataFrame, dedup_first: bool = False) -> DataFrame:
    df = n.parse_dates(bronze, ["application_date"])
    df = n.cast_columns(
        df,
        {
            "loan_amount_requested": "double",
            "loan_term_months": "int",
            "stated_income": "double",
            "stated_years_employed": "int",
            "num_dependants": "int",
            "is_fraud_label": "int",
        },
    )
    df = n.labels_lower(
        df, ["loan_type", "application_channel", "application_status", "stated_employment_status"]
    )
    unique = dedup_latest(df, ["application_id"], _latest_first(df, "application_date"))
    counted = unique if dedup_first else df

    out = unique.withColumns(
        {
            "loan_to_income_ratio": signals.loan_to_income(),
            "is_income_realistic": signals.income_realistic(),
        }
    )
    if "date_of_birth" in out.columns:
        out = n.parse_dates(out, ["date_of_birth"])
        out = out.withColumn("age", signals.age("date_of_birth", F.col("application_date")))
    out = loans.with_applications_per_customer(out, source=counted)
    out = loans.with_applications_in_window(out).drop("applications_on_date")
    out = loans.with_shared_flag(out, "id_number", "id_shared_flag", source=counted)
    out = loans.with_shared_flag(out, "address", "address_shared_flag", source=counted)
    return loans.with_agent_approval_rate(out, source=counted)


def silver_repayments(bronze: DataFrame, dedup_first: bool = False) -> DataFrame:
    df = n.parse_dates(bronze, ["due_date", "payment_date"])
    df = n.cast_columns(
        df,
        {
            "due_amount": "double",
            "paid_amount": "double",
            "days_past_due": "int",
            "outstanding_balance": "double",
        },
    )
    df = n.labels_lower(df, ["payment_status"])
    df = df.withColumns(signals.payment_flags())
    unique = dedup_latest(df, ["repayment_id"], _latest_first(df, "due_date"))
    counted = unique if dedup_first else df
    out = unique.withColumn("payment_shortfall", signals.payment_shortfall())
    hot, _ = hot_keys(df, "customer_id")
    if hot is None:
        return _with_runs(out, counted)
    (rest, busy), (counted_rest, counted_busy) = (
        split_hot(x, hot, "customer_id") for x in (out, counted)
    )
    # Stored, as it is read twice: to cut it into ranges, and to spread it over them.
    busy = stored(loans.with_cumulative_missed(busy, source=counted_busy), "busy-repayments")
    return _with_runs(rest, counted_rest).unionByName(loans.with_missed_streak(busy))


def _with_runs(repayments: DataFrame, counted: DataFrame) -> DataFrame:
    """Running misses and streaks of customers that fit into a task: rows are shuffled once."""
    out = loans.with_cumulative_missed(repayments, source=counted, in_task=True)
    return loans.with_missed_streak(out, in_task=True)
