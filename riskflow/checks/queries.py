"""One query per operator over the driver's tables, for the side-by-side check.

Thresholds are passed so that they split these tables; the operators' defaults
are the usual ones. Means and deviations are rounded, as two engines add floating
point numbers in different orders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow import config as c
from riskflow.checks import views as v
from riskflow.functions import normalize as n
from riskflow.functions import signals
from riskflow.functions.scoring import risk_tier
from riskflow.operators import features as f
from riskflow.operators import loans, quality, report, rolling, runlog, scores, state
from riskflow.operators import transactions as t
from riskflow.operators.alerts import fraud_alerts
from riskflow.operators.customer_risk import customer_risk, with_activity
from riskflow.operators.dedup import dedup_any, dedup_latest
from riskflow.plans import jobs, silver, sql
from riskflow.sources.export import write_csv
from riskflow.sources.raw import MALFORMED, read_raw, with_ingest_metadata
from riskflow.sources.tables import read_table, shared_folder, stored, write_table
from riskflow.streaming import velocity

Query = Callable[[SparkSession, str], DataFrame]

DEVICE_LIMIT = 33
AGENT_LIMIT = 0.42
MCC = "merchant_category_risk"
CARD_RULES = c.card_rules(18, 13, 0.96, 0.22, 0.334, MCC)
LOAN_RULES = c.loan_rules(100, 10, 13, 0.33)
TXN_DEDUP = ["transaction_ts", "part_id", "merchant_id", "quantity"]
REP_DEDUP = ["due_date", "part_id", "supplier_id", "days_past_due"]


def at(instant: str = v.AS_OF) -> Column:
    return F.lit(instant).cast("timestamp_ntz")


def approx(column: str, places: int = 5) -> Column:
    """Rounded off a grid that the means of cents cannot tie on; -0.0 becomes 0.0."""
    return (F.round(F.col(column) + 1.2e-6, places) + 0.0).alias(column)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[approx(x) if x in columns else x for x in df.columns])


# --- stages shared by several queries --------------------------------------------
def card_columns(txn: DataFrame) -> DataFrame:
    """What the card features read of the transactions."""
    return txn.drop("merchant_id", "part_id", "quantity")


def txn_flags(s: SparkSession, d: str, txn: DataFrame) -> DataFrame:
    df = t.with_billing_country(txn, v.acc(s, d))
    return t.with_time_parts(df.withColumn("is_international", signals.is_international()))


def txn_signals(s: SparkSession, d: str, txn: DataFrame) -> DataFrame:
    return t.with_amount_zscore(txn_flags(s, d, txn), source=txn)


def app_signals(s: SparkSession, d: str) -> DataFrame:
    app = v.app(s, d)
    df = app.withColumns(
        {
            "loan_to_income_ratio": signals.loan_to_income(),
            "is_income_realistic": signals.income_realistic(
                unemployed_limit=5000, new_job_limit=8000
            ),
        }
    )
    df = loans.with_applications_per_customer(df, source=app)
    df = loans.with_shared_flag(df, "id_number", "id_shared_flag", source=app)
    df = loans.with_shared_flag(df, "address", "address_shared_flag", source=app)
    return loans.with_agent_approval_rate(df, source=app)


def rep_signals(s: SparkSession, d: str) -> DataFrame:
    df = v.rep(s, d).withColumn("payment_shortfall", signals.payment_shortfall())
    return loans.with_cumulative_missed(df.withColumns(signals.payment_flags()))


def card_features(s: SparkSession, d: str, grain: str = "account") -> DataFrame:
    # Joined once and stored, as it is read several times. Distinct values are read before the
    # join to accounts: it may repeat rows, but adds no values.
    txn = stored(card_columns(v.txn(s, d)), "card-feed")
    df = f.card_features(txn_signals(s, d, txn), v.acc(s, d), DEVICE_LIMIT, grain, source=txn)
    return df.join(f.merchant_category_risk(txn), "customer_id", "left")


def card_scored(s: SparkSession, d: str) -> DataFrame:
    return f.with_score(
        card_features(s, d, "customer"), CARD_RULES, "card_fraud_score", "card_risk_tier", at()
    )


def loan_features(s: SparkSession, d: str) -> DataFrame:
    return f.loan_features(app_signals(s, d), rep_signals(s, d), AGENT_LIMIT)


def loan_scored(s: SparkSession, d: str) -> DataFrame:
    return f.with_score(
        loan_features(s, d), LOAN_RULES, "loan_fraud_score", "loan_risk_tier", at()
    )


def card_scores(s: SparkSession, d: str) -> DataFrame:
    return scores.card_scores(
        card_scored(s, d), CARD_RULES,
        velocity="txn_count_1h > 4",
        geo="distinct_countries_30d > 18 OR international_txn_ratio > 0.96",
        declined="declined_txn_count_7d > 13",
        as_of=at(),
    )


def loan_scores(s: SparkSession, d: str) -> DataFrame:
    return scores.loan_scores(
        loan_scored(s, d), LOAN_RULES,
        income="NOT income_realistic_flag OR loan_to_income_ratio > 100",
        stacking="applications_last_30d > 10",
        repayment="missed_payment_count >= 13 OR partial_payment_ratio > 0.33",
        as_of=at(),
    )


def gold(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Risk view and alerts over score tables that are computed once and stored."""
    card, loan = stored(card_scores(s, d), "card-scores"), stored(loan_scores(s, d), "loan-scores")
    return customer_risk(v.cust(s, d), card, loan, at()), fraud_alerts(card, loan, at())


def alerts(s: SparkSession, d: str) -> DataFrame:
    return fraud_alerts(card_scores(s, d), loan_scores(s, d), at())


def risk(s: SparkSession, d: str) -> DataFrame:
    return customer_risk(v.cust(s, d), card_scores(s, d), loan_scores(s, d), at())


def run_log(s: SparkSession, d: str) -> DataFrame:
    """Log rows made of the events table."""
    kind = F.col("event_type")
    return v.table(s, d, "events").select(
        F.when(F.col("user_id") % 2 == 0, "card").otherwise("loan").alias("pipeline"),
        F.when(kind == "error", "ERROR").when(kind == "click", "WARNING").otherwise("INFO").alias(
            "level"
        ),
        F.col("props").alias("message"),
        F.col("ts").alias("log_timestamp"),
    )


LOG_AS_OF = "2024-01-30 12:00:00"


# --- scans, casts, text -----------------------------------------------------------
def ingest_metadata(s, d):
    df = with_ingest_metadata(v.table(s, d, "customer"), as_of=at())
    return df.select("c_custkey", "_ingested_at", "_source_file")


def cast_columns(s, d):
    text = v.table(s, d, "part").select(
        "p_partkey",
        F.when(F.col("p_size") == 3, "NaN")
        .when(F.col("p_size") == 4, "-Infinity")
        .when(F.col("p_size") == 5, "inf")
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("price"),
        F.when(F.col("p_size") > 25, F.col("p_name"))
        .otherwise(F.col("p_size").cast("string"))
        .alias("size"),
    )
    return n.cast_columns(text, {"price": "double", "size": "int"})


def parse_dates(s, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = v.table(s, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 == 0, "soon").otherwise(day).alias("day"),
        F.when(F.col("o_orderkey") % 3 == 0, day)
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("at"),
    )
    df = n.parse_timestamps(n.parse_dates(text, ["day"]), ["at"])
    return df.withColumn("at", F.col("at").cast("timestamp_ntz"))


def combine_date_time(s, d):
    ts = n.combine_date_time("transaction_date", "transaction_time").cast("timestamp_ntz")
    b = v.bronze_txn(s, d).withColumn(
        "transaction_time",
        F.when(F.col("merchant_country").isNotNull(), F.col("transaction_time")),
    )
    return b.groupBy(ts.alias("transaction_ts")).agg(F.count(F.lit(1)).alias("n"))


def normalize_labels(s, d):
    df = n.codes_upper(v.bronze_txn(s, d), ["merchant_country", "currency"])
    df = n.labels_lower(df, ["channel", "status"])
    keys = ["merchant_country", "currency", "channel", "status"]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def mask_tail(s, d):
    return v.table(s, d, "customer").select("c_custkey", n.mask_tail("c_name").alias("masked"))


def drop_nulls(s, d):
    df = n.drop_nulls_in(v.app(s, d), ["id_number", "agent_id"])
    return df.select("application_id", "id_number", "agent_id")


def age(s, d):
    as_of = F.lit("2024-01-31").cast("date")
    return v.app(s, d).select(
        "application_id", signals.age("application_date", as_of).alias("age")
    )


# --- quality ------------------------------------------------------------------------
def null_profile(s, d):
    return quality.null_counts(v.bronze_rep(s, d))


def null_or_empty_profile(s, d):
    return quality.blank_counts(v.bronze_acc(s, d), ["account_id", "customer_id", "credit_limit"])


def duplicate_profile(s, d):
    return quality.duplicate_count(v.txn(s, d), "transaction_id")


def row_counts(s, d):
    names = ("customer", "orders", "lineitem", "events")
    return quality.row_counts({name: v.table(s, d, name) for name in names})


def profile_txn(s, d):
    return quality.profile(v.bronze_txn(s, d), c.CARD_TXN)


def profile_acc(s, d):
    return quality.profile(v.bronze_acc(s, d), c.CARD_ACC)


def profile_app(s, d):
    return quality.profile(v.bronze_app(s, d), c.LOAN_APP)


def profile_rep(s, d):
    return quality.profile(v.bronze_rep(s, d), c.LOAN_REP)


def breakdown_status(s, d):
    return quality.breakdown(v.txn(s, d), "status")


def breakdown_loan_type(s, d):
    return quality.breakdown(v.app(s, d), "loan_type")


def breakdowns_card(s, d):
    return quality.breakdowns(v.bronze_txn(s, d), c.CARD_TXN.breakdowns)


def breakdowns_accounts(s, d):
    return quality.breakdowns(v.bronze_acc(s, d), c.CARD_ACC.breakdowns)


def breakdowns_loan(s, d):
    return quality.breakdowns(v.bronze_app(s, d), c.LOAN_APP.breakdowns)


def breakdowns_repayments(s, d):
    return quality.breakdowns(v.bronze_rep(s, d), c.LOAN_REP.breakdowns)


def breakdowns_txn_signals(s, d):
    df = t.with_billing_country(v.txn(s, d), v.acc(s, d))
    df = t.with_time_parts(df.withColumn("is_international", signals.is_international()))
    return quality.breakdowns(df, ["is_international", "hour_of_day", "is_weekend"])


def breakdowns_loan_signals(s, d):
    return quality.breakdowns(
        app_signals(s, d), ["is_income_realistic", "id_shared_flag", "address_shared_flag"]
    )


def breakdowns_repayment_signals(s, d):
    df = v.rep(s, d).withColumns(signals.payment_flags())
    return quality.breakdowns(df, ["payment_status", "is_missed"])


def ratio_distribution(s, d):
    df = v.app(s, d).withColumn("loan_to_income_ratio", signals.loan_to_income())
    return rounded(
        quality.distribution(df, "loan_to_income_ratio"), "min_value", "max_value", "avg_value"
    )


def hour_top5(s, d):
    hours = v.txn(s, d).select(signals.hour_of_day().alias("hour_of_day"))
    return quality.breakdown(hours, "hour_of_day").limit(5)


# --- de-duplication -----------------------------------------------------------------
def dedup_latest_txn(s, d):
    df = dedup_latest(v.txn(s, d), ["transaction_id"], TXN_DEDUP)
    return df.select("transaction_id", "customer_id", "transaction_ts", "amount", "part_id")


def dedup_any_txn(s, d):
    """Which row survives is free, so only what all rows of a key share is shown."""
    return dedup_any(v.txn(s, d), ["transaction_id"]).select("transaction_id", "customer_id")


# --- card signals and features --------------------------------------------------------
def is_international(s, d):
    df = t.with_billing_country(v.txn(s, d), v.acc(s, d))
    return df.select(
        "transaction_id", "part_id", signals.is_international().alias("is_international")
    )


def time_parts(s, d):
    return t.with_time_parts(v.txn(s, d)).select(
        "transaction_id", "part_id", "hour_of_day", "is_weekend"
    )


def amount_zscore(s, d):
    df = t.with_amount_zscore(v.txn(s, d))
    return df.select("transaction_id", "part_id", "amount", approx("amount_zscore"))


def zscore_top10(s, d):
    df = dedup_latest(t.with_amount_zscore(v.txn(s, d)), ["transaction_id"], TXN_DEDUP)
    return rounded(quality.outliers(df), "amount_zscore")


def velocity_features(s, d):
    df = t.with_time_parts(v.txn(s, d)).groupBy("customer_id").agg(*f.velocity_aggregates())
    return rounded(df, "avg_txn_amount_30d")


def late_night_ratio(s, d):
    return (
        t.with_time_parts(v.txn(s, d)).groupBy("customer_id").agg(*f.late_night_aggregates())
    )


def geo_channel_features(s, d):
    df = t.with_billing_country(v.txn(s, d), v.acc(s, d))
    df = df.withColumn("is_international", signals.is_international())
    shares = df.groupBy("customer_id").agg(*f.channel_aggregates())
    counts = f.distinct_values(df).drop("unknown_device_flag")
    return shares.join(counts, "customer_id", "left").fillna(0)


def device_flag(s, d):
    return f.distinct_values(v.txn(s, d), DEVICE_LIMIT).select(
        "customer_id", "unknown_device_flag"
    )


def merchant_risk_ref(s, d):
    df = dedup_latest(t.with_amount_zscore(v.txn(s, d)), ["transaction_id"], TXN_DEDUP)
    return rounded(df.groupBy("customer_id").agg(*f.merchant_aggregates()), "merchant_risk_score")


def merchant_risk_mcc(s, d):
    return rounded(f.merchant_category_risk(v.txn(s, d)), MCC)


def rolling_10min(s, d):
    return t.rolling_count(v.evt(s, d), 600, "txn_count_10min_rolling")


def rolling_1h(s, d):
    return t.rolling_count(v.evt(s, d), 3600, "txn_count_1h_rolling")


def peak_velocity(s, d):
    windows = {"txn_count_10min_rolling": 600, "txn_count_1h_rolling": 3600}
    return t.peak_rolling_counts(v.evt(s, d), windows)


def rolling_velocity(s, d):
    base = v.acc(s, d).select("customer_id", "account_id")
    return f.with_rolling_velocity(base, v.txn(s, d))


def asof_features(s, d):
    return rounded(f.asof_features(v.txn(s, d), at(v.AS_OF_TXN)), "avg_txn_amount_30d_asof")


def asof_features_events(s, d):
    return rounded(f.asof_features(v.evt(s, d), at()), "avg_txn_amount_30d_asof")


def rolling_30d_rows(s, d):
    df = rolling.with_rolling_values(v.txn(s, d), row_id="part_id")
    # Copies of a transaction differ in these columns.
    df = df.select("transaction_id", "part_id", "merchant_id", *rolling.ROLLING)
    return rounded(df, "avg_txn_amount_30d_rolling")


def rolling_30d_events(s, d):
    df = rolling.rolling_values(v.evt(s, d), days=10, decline_days=1)
    return rounded(df, "avg_txn_amount_30d_rolling", "max_txn_amount_30d_rolling")


def halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two loads: rows up to a day, and later ones."""
    first = F.col("transaction_ts") < at("1998-06-01 00:00:00")
    return df.filter(first), df.filter(~first)


def moments_merged(s, d):
    """Features from the merged states of two loads."""
    df = t.with_billing_country(v.txn(s, d), v.acc(s, d))
    df = t.with_time_parts(df.withColumn("is_international", signals.is_international()))
    merged = state.merge_moments(*[state.moments(x) for x in halves(df)])
    out = state.features_of_moments(merged)
    return rounded(out, "avg_txn_amount_30d", "amount_deviation")


def zscore_from_state(s, d):
    """Z-scores of the second load against the state of both."""
    df = t.with_time_parts(v.txn(s, d)).withColumn("is_international", F.lit(False))
    first, second = halves(df)
    merged = state.merge_moments(state.moments(first), state.moments(second))
    scored = state.with_zscore_of_state(second, merged)
    return scored.select("transaction_id", "part_id", "amount", approx("amount_zscore"))


def distinct_asof_daily(s, d):
    """Distinct countries and merchants as of a date, from the daily values of two loads."""
    first, second = halves(v.txn(s, d))
    numbers = stored(state.number_values(first), "value-numbers")
    later = stored(state.number_values(second, numbers), "value-numbers")
    daily = state.merge_daily_values(
        state.daily_values(first, numbers), state.daily_values(second, later)
    )
    return state.distinct_as_of(daily, at(v.AS_OF_TXN))


def daily_value_counts(s, d):
    """The daily state, word by word, without the numbers that values happen to have."""
    df = v.evt(s, d)
    daily = state.daily_values(df, stored(state.number_values(df), "value-numbers"))
    return daily.groupBy("customer_id", "day", "kind").agg(
        F.sum(F.bit_count("bits")).alias("values"), F.sum("n").alias("n")
    )


def q_card_features(s, d):
    return rounded(card_features(s, d), "avg_txn_amount_30d", "merchant_risk_score", MCC)


def card_feature_table(s, d):
    """The table that the card job writes, before it is scored."""
    txn = card_columns(v.txn(s, d))
    # Stored, as it is read several times: all counts are of the rows joined to accounts.
    rows = stored(txn_flags(s, d, txn), "card-rows")
    df = f.card_feature_table(
        t.with_amount_zscore(rows, source=txn),
        v.acc(s, d), at(v.AS_OF_TXN), DEVICE_LIMIT, source=rows,
    )
    return rounded(
        df, "avg_txn_amount_30d", "merchant_risk_score", MCC, "avg_txn_amount_30d_asof"
    )


def customer_risk_masked(s, d):
    """What the gold job makes of customers with raw ids."""
    ids = (F.col("customer_id") * 1_000_003).cast("string")
    customers = jobs.masked(v.cust(s, d).withColumn("id_number", ids), True)
    view = customer_risk(customers, card_scores(s, d), loan_scores(s, d), at())
    return view.select("customer_id", "id_number", "overall_risk_tier")


def card_score(s, d):
    return card_scored(s, d).select(
        "customer_id", "account_id", "card_fraud_score", "card_risk_tier", "feature_updated_at"
    )


def risk_tier_breakdown(s, d):
    return quality.breakdown(card_scored(s, d), "card_risk_tier")


def risk_tiers(s, d):
    """Tiers of discount-based scores, which fall exactly on the bounds."""
    score = F.round(F.col("l_discount") * 10, 1)
    df = v.table(s, d, "lineitem").select(F.nullif(score, F.lit(0.3)).alias("score"))
    df = df.withColumn("tier", risk_tier(F.col("score")))
    return df.groupBy("score", "tier").agg(F.count(F.lit(1)).alias("n"))


def score_distribution(s, d):
    df = quality.distribution(card_scored(s, d), "card_fraud_score")
    return rounded(df, "avg_value")


def top10_risk(s, d):
    return quality.top(
        card_scored(s, d), "card_fraud_score", 10,
        [
            "customer_id", "card_fraud_score", "card_risk_tier", "distinct_countries_30d",
            "unknown_device_flag", "declined_txn_count_7d", "international_txn_ratio",
        ],
        ["customer_id"],
    )


# --- loan signals and features ----------------------------------------------------------
def loan_to_income(s, d):
    return v.app(s, d).select(
        "application_id", signals.loan_to_income().alias("loan_to_income_ratio")
    )


def income_realistic(s, d):
    flag = signals.income_realistic(unemployed_limit=5000, new_job_limit=8000)
    return v.app(s, d).select("application_id", flag.alias("is_income_realistic"))


def applications_per_customer(s, d):
    df = loans.with_applications_per_customer(v.app(s, d))
    return df.select("application_id", "customer_id", "applications_last_30d")


def applications_30d_branches(s, d):
    return loans.applications_in_window(v.app(s, d))


def applications_30d_rows(s, d):
    df = loans.with_applications_in_window(v.app(s, d))
    return df.select(
        "application_id", "applications_30d_rolling", "distinct_branches_30d_rolling"
    )


def shared_id_flag(s, d):
    df = loans.with_shared_flag(v.app(s, d), "id_number", "id_shared_flag")
    return df.select("application_id", "id_number", "id_shared_flag")


def shared_address_flag(s, d):
    df = loans.with_shared_flag(v.app(s, d), "address", "address_shared_flag")
    return df.select("application_id", "address_shared_flag")


def agent_approval_rate(s, d):
    df = loans.with_agent_approval_rate(v.app(s, d))
    return df.select("application_id", "agent_id", "agent_approval_rate")


def payment_flags(s, d):
    df = v.rep(s, d).withColumns(signals.payment_flags())
    return df.select("repayment_id", "part_id", "is_missed", "is_partial", "is_late")


def payment_shortfall(s, d):
    return v.rep(s, d).select(
        "repayment_id", "part_id", signals.payment_shortfall().alias("payment_shortfall")
    )


def cumulative_missed(s, d):
    return rep_signals(s, d).select(
        "repayment_id", "part_id", "customer_id", "due_date", "consecutive_missed_count"
    )


def _deduped_rep(s, d):
    df = v.rep(s, d).withColumns(signals.payment_flags())
    return dedup_latest(df, ["repayment_id"], REP_DEDUP)


def missed_streak(s, d):
    return loans.missed_streak(_deduped_rep(s, d))


def longest_streak(s, d):
    return loans.longest_streak(_deduped_rep(s, d))


def application_features(s, d):
    return f.application_features(app_signals(s, d), AGENT_LIMIT)


def repayment_features(s, d):
    df = f.repayment_features(rep_signals(s, d))
    return rounded(df, "avg_payment_ratio", "avg_days_past_due", "total_outstanding_balance")


def q_loan_features(s, d):
    return rounded(
        loan_features(s, d), "avg_payment_ratio", "avg_days_past_due", "total_outstanding_balance"
    )


def loan_score(s, d):
    return loan_scored(s, d).select(
        "customer_id", "application_id", "loan_fraud_score", "loan_risk_tier"
    )


# --- silver tables from raw text ----------------------------------------------------------
def silver_card_txn(s, d):
    df = silver.silver_transactions(v.bronze_txn(s, d), silver.silver_accounts(v.bronze_acc(s, d)))
    df = df.withColumn("transaction_ts", F.col("transaction_ts").cast("timestamp_ntz"))
    return rounded(df, "amount_zscore")


def silver_card_txn_dedup_first(s, d):
    accounts = silver.silver_accounts(v.bronze_acc(s, d))
    df = silver.silver_transactions(v.bronze_txn(s, d), accounts, dedup_first=True)
    return df.select("transaction_id", "customer_id", "amount", approx("amount_zscore"))


def silver_card_acc(s, d):
    return silver.silver_accounts(v.bronze_acc(s, d))


def silver_loan_app(s, d):
    return silver.silver_applications(v.bronze_app(s, d))


def silver_loan_rep(s, d):
    return rounded(silver.silver_repayments(v.bronze_rep(s, d)), "paid_amount", "outstanding_balance")


# --- gold ------------------------------------------------------------------------------------
def alerts_by_type(s, d):
    return quality.breakdown(alerts(s, d), "alert_type")


def alerts_by_tier(s, d):
    return quality.breakdown(alerts(s, d), "risk_tier")


def alerts_by_signal(s, d):
    return quality.breakdown(alerts(s, d), "top_signal")


def top10_alerts(s, d):
    return quality.top(
        alerts(s, d), "fraud_score", 10,
        ["customer_id", "alert_type", "fraud_score", "risk_tier", "top_signal"],
        ["customer_id", "alert_type"],
    )


def customer_risk_activity(s, d):
    view, raised = gold(s, d)
    return with_activity(view, raised, v.txn(s, d), v.app(s, d))


def kpi_summary(s, d):
    return report.kpi_summary(*gold(s, d))


def export_customer_risk(s, d):
    return report.export_view(risk(s, d), report.CUSTOMER_RISK)


def export_alerts(s, d):
    return report.export_view(alerts(s, d), report.FRAUD_ALERTS)


def export_card(s, d):
    return report.export_view(card_scores(s, d), report.CARD_SCORES)


def export_loan(s, d):
    return report.export_view(loan_scores(s, d), report.LOAN_SCORES)


# --- run log ---------------------------------------------------------------------------------
def run_log_recent(s, d):
    return runlog.recent(run_log(s, d), "loan", 3, at(LOG_AS_OF))


def run_log_summary(s, d):
    return runlog.summary(run_log(s, d), "card", 24, at(LOG_AS_OF))


def run_log_errors(s, d):
    return runlog.error_count(run_log(s, d), "card", 24, at(LOG_AS_OF))


def run_log_checks(s, d):
    return runlog.from_checks(quality.profile(v.bronze_acc(s, d), c.CARD_ACC), "card", at())


# --- SQL ----------------------------------------------------------------------------------------
def sql_customer_risk(s, d):
    """The risk view of `plans/sql.py`, by SQL alone."""
    sql.register_functions(s)
    sql.register_risk_view(v.cust(s, d), card_scores(s, d), loan_scores(s, d))
    return s.sql("SELECT * FROM customer_risk").drop("risk_updated_at")


def sql_card_score(s, d):
    sql.register_functions(s, CARD_RULES, LOAN_RULES, MCC)
    card_features(s, d, "customer").createOrReplaceTempView("scored_card_features")
    arguments = ", ".join([name for name, _ in sql.CARD_ARGUMENTS[:-1]] + [MCC])
    return s.sql(f"""
        SELECT customer_id, card_fraud_score({arguments}) AS card_fraud_score,
               card_top_signal({arguments}) AS top_fraud_signal,
               risk_tier(card_fraud_score({arguments})) AS card_risk_tier
        FROM scored_card_features""")


def sql_log_summary(s, d):
    sql.register_log(run_log(s, d))
    return s.sql(f"SELECT * FROM log_summary('card', 24, TIMESTAMP_NTZ '{LOG_AS_OF}')")


def sql_log_errors(s, d):
    sql.register_log(run_log(s, d))
    return s.sql(f"SELECT * FROM log_errors('card', 24, TIMESTAMP_NTZ '{LOG_AS_OF}')")


# --- streams ------------------------------------------------------------------------------------
def streaming_velocity(s, d):
    """Final hourly windows of the events as a stream of files, from the folder it writes."""
    folder = _scratch(s, "velocity")
    v.table(s, d, "events").write.parquet(f"{folder}/in")
    events = velocity.read_transactions(s, f"{folder}/in", v.SCHEMAS["events"])
    txn = events.select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("transaction_ts"),
        F.when(F.col("event_type") == "error", "declined").otherwise("approved").alias("status"),
    )
    counts = velocity.windowed_counts(txn)
    velocity.write_counts(counts, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return s.read.schema(counts.schema).parquet(f"{folder}/out")


# --- files and tables, written to the shared folder and read back ---------------------------------
def _scratch(s: SparkSession, name: str) -> str:
    return f"{shared_folder(s)}/{name}-{uuid.uuid4().hex}"


def csv_round_trip(s, d):
    """Quotes, commas, line breaks and outer spaces in fields survive."""
    text = F.concat(F.lit(' "'), "c_name", F.lit('", in\n'), "c_mktsegment", F.lit(" "))
    df = v.table(s, d, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        text.alias("note"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"),
    )
    folder = _scratch(s, "csv")
    write_csv(df, folder)
    return read_raw(s, folder, multiline=True)


def malformed_rows(s, d):
    """Rows with too few or too many fields, told from sound ones, in many files."""
    key = F.col("c_custkey")
    fields = (
        F.when(key % 10 == 3, F.array("c_name"))
        .when(key % 10 == 4, F.array("c_name", "c_mktsegment", F.lit("more")))
        .otherwise(F.array("c_name", "c_mktsegment"))
    )
    line = F.concat_ws(",", key.cast("string"), F.array_join(fields, ","))
    # Each file has a header: its first line.
    customers = v.table(s, d, "customer").select((key % 4).alias("file"), line.alias("value"), F.lit(1).alias("nth"))
    header = s.range(4).select(F.col("id").alias("file"), F.lit("customer_id,name,segment"), F.lit(0))
    folder = _scratch(s, "malformed")
    lines = customers.unionAll(header).repartition(4, "file").sortWithinPartitions("file", "nth")
    lines.select("value", "file").write.partitionBy("file").text(folder)
    raw = read_raw(s, f"{folder}/*/", malformed=MALFORMED)
    return raw.select(
        "customer_id", F.col(MALFORMED).isNotNull().alias("malformed"), F.col(MALFORMED).alias("line")
    )


def _accounts_csv(s, d, loads) -> str:
    """Raw account rows of some loads as CSV files."""
    raw = v.bronze_acc(s, d)
    folder = _scratch(s, "accounts")
    write_csv(raw.filter(F.col("_ingested_at").isin(loads)).drop("_ingested_at"), folder)
    return folder


def ingest_accounts(s, d):
    """Raw files through the ingest job into a bronze table, and the table read back."""
    store = jobs.Store(s, _scratch(s, "lake"))
    jobs.ingest(store, c.CARD_ACC, _accounts_csv(s, d, [1, 2]))
    return store.read(c.BRONZE_CARD_ACC).drop("_ingested_at")


def ingest_log(s, d):
    """What the ingest job says in the run log: rows, and those without a key."""
    store = jobs.Store(s, _scratch(s, "lake"))
    raw = v.bronze_acc(s, d).drop("_ingested_at")
    raw = raw.withColumn("account_id", F.nullif("account_id", F.lit("5")))
    folder = _scratch(s, "accounts")
    write_csv(raw, folder)
    jobs.ingest(store, c.CARD_ACC, folder)
    return store.read(c.RUN_LOG).select("pipeline", "level", "message")


def load_days(s, d):
    """Accounts of two days, the second loaded twice and the first again: the latest of each."""
    store = jobs.Store(s, _scratch(s, "lake"))
    days = {1: date(2024, 5, 1), 2: date(2024, 5, 2)}
    for load in (1, 2, 2, 1):
        jobs.load_day(store, c.CARD_ACC, _accounts_csv(s, d, [load]), days[load])
    columns = ["account_id", "credit_limit", "account_status", "billing_country", jobs.LOAD_DATE]
    return store.read(c.SILVER_CARD_ACC).select(*columns)


def table_append(s, d):
    """A table overwritten, then appended to, and read back."""
    name = _scratch(s, "table")
    accounts = v.acc(s, d)
    write_table(accounts, name)
    write_table(accounts.filter("account_id % 2 = 0"), name)
    write_table(accounts.filter("account_id % 3 = 0"), name, "append")
    return read_table(s, name)


def export_csv_file(s, d):
    """An export in one file, read back; rows are from as many files as there are."""
    folder = _scratch(s, "export")
    write_csv(v.acc(s, d).select("account_id", "account_status"), folder, single_file=True)
    raw = read_raw(s, folder).select("*", F.col("_metadata.file_path").alias("path"))
    return raw.groupBy("account_status").agg(
        F.count("account_id").alias("accounts"), F.count_distinct("path").alias("files")
    )


def export_kpis(s, d):
    """The KPI row as CSV, read back as text."""
    folder = _scratch(s, "kpi")
    write_csv(kpi_summary(s, d), folder, single_file=True)
    raw = read_raw(s, folder)
    return raw.select(*[F.col(x).cast("double").alias(x) for x in raw.columns])


def run_log_append(s, d):
    """Two runs' messages and check results appended to one log."""
    name = _scratch(s, "log")
    checks = quality.profile(v.bronze_acc(s, d), c.CARD_ACC)
    customers = v.table(s, d, "customer").count()
    for run in (1, 2):
        log = runlog.RunLog(f"run{run}")
        log.info(f"{customers} customers")
        log.append(s, name)
        write_table(runlog.from_checks(checks, f"run{run}"), name, "append")
    return read_table(s, name).select("pipeline", "level", "message")


QUERIES: dict[str, Query] = {
    "ingest_metadata": ingest_metadata,
    "cast_columns": cast_columns,
    "parse_dates": parse_dates,
    "combine_date_time": combine_date_time,
    "normalize_labels": normalize_labels,
    "mask_tail": mask_tail,
    "drop_nulls": drop_nulls,
    "age": age,
    "null_profile": null_profile,
    "null_or_empty_profile": null_or_empty_profile,
    "duplicate_profile": duplicate_profile,
    "row_counts": row_counts,
    "profile_txn": profile_txn,
    "profile_acc": profile_acc,
    "profile_app": profile_app,
    "profile_rep": profile_rep,
    "breakdown_status": breakdown_status,
    "breakdown_loan_type": breakdown_loan_type,
    "breakdowns_card": breakdowns_card,
    "breakdowns_accounts": breakdowns_accounts,
    "breakdowns_loan": breakdowns_loan,
    "breakdowns_repayments": breakdowns_repayments,
    "breakdowns_txn_signals": breakdowns_txn_signals,
    "breakdowns_loan_signals": breakdowns_loan_signals,
    "breakdowns_repayment_signals": breakdowns_repayment_signals,
    "ratio_distribution": ratio_distribution,
    "hour_top5": hour_top5,
    "dedup_latest": dedup_latest_txn,
    "dedup_any": dedup_any_txn,
    "is_international": is_international,
    "time_parts": time_parts,
    "amount_zscore": amount_zscore,
    "zscore_top10": zscore_top10,
    "velocity_features": velocity_features,
    "late_night_ratio": late_night_ratio,
    "geo_channel_features": geo_channel_features,
    "device_flag": device_flag,
    "merchant_risk_ref": merchant_risk_ref,
    "merchant_risk_mcc": merchant_risk_mcc,
    "rolling_10min": rolling_10min,
    "rolling_1h": rolling_1h,
    "peak_velocity": peak_velocity,
    "rolling_velocity": rolling_velocity,
    "rolling_30d_rows": rolling_30d_rows,
    "rolling_30d_events": rolling_30d_events,
    "moments_merged": moments_merged,
    "zscore_from_state": zscore_from_state,
    "distinct_asof_daily": distinct_asof_daily,
    "daily_value_counts": daily_value_counts,
    "asof_features": asof_features,
    "asof_features_events": asof_features_events,
    "card_features": q_card_features,
    "card_feature_table": card_feature_table,
    "customer_risk_masked": customer_risk_masked,
    "card_score": card_score,
    "risk_tiers": risk_tiers,
    "risk_tier_breakdown": risk_tier_breakdown,
    "score_distribution": score_distribution,
    "top10_risk": top10_risk,
    "loan_to_income": loan_to_income,
    "income_realistic": income_realistic,
    "applications_per_customer": applications_per_customer,
    "applications_30d_branches": applications_30d_branches,
    "applications_30d_rows": applications_30d_rows,
    "shared_id_flag": shared_id_flag,
    "shared_address_flag": shared_address_flag,
    "agent_approval_rate": agent_approval_rate,
    "payment_flags": payment_flags,
    "payment_shortfall": payment_shortfall,
    "cumulative_missed": cumulative_missed,
    "missed_streak": missed_streak,
    "longest_streak": longest_streak,
    "application_features": application_features,
    "repayment_features": repayment_features,
    "loan_features": q_loan_features,
    "loan_score": loan_score,
    "silver_card_txn": silver_card_txn,
    "silver_card_txn_dedup_first": silver_card_txn_dedup_first,
    "silver_card_acc": silver_card_acc,
    "silver_loan_app": silver_loan_app,
    "silver_loan_rep": silver_loan_rep,
    "card_scores": card_scores,
    "loan_scores": loan_scores,
    "fraud_alerts": alerts,
    "alerts_by_type": alerts_by_type,
    "alerts_by_tier": alerts_by_tier,
    "alerts_by_signal": alerts_by_signal,
    "top10_alerts": top10_alerts,
    "customer_risk": risk,
    "customer_risk_activity": customer_risk_activity,
    "kpi_summary": kpi_summary,
    "export_customer_risk": export_customer_risk,
    "export_alerts": export_alerts,
    "export_card": export_card,
    "export_loan": export_loan,
    "run_log_recent": run_log_recent,
    "run_log_summary": run_log_summary,
    "run_log_errors": run_log_errors,
    "run_log_checks": run_log_checks,
    "sql_customer_risk": sql_customer_risk,
    "sql_card_score": sql_card_score,
    "sql_log_summary": sql_log_summary,
    "sql_log_errors": sql_log_errors,
    "streaming_velocity": streaming_velocity,
    "csv_round_trip": csv_round_trip,
    "malformed_rows": malformed_rows,
    "ingest_accounts": ingest_accounts,
    "ingest_log": ingest_log,
    "load_days": load_days,
    "table_append": table_append,
    "export_csv_file": export_csv_file,
    "export_kpis": export_kpis,
    "run_log_append": run_log_append,
}
