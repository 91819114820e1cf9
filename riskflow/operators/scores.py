"""Gold score tables: one row per customer with score, tier, strongest signal, flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.config import Rule, card_rules, loan_rules
from riskflow.functions.scoring import top_signal


def _flag(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def card_scores(
    features: DataFrame,
    rules: Sequence[Rule] | None = None,
    velocity: str = "txn_count_1h > 3",
    geo: str = "distinct_countries_30d > 2 OR international_txn_ratio > 0.5",
    declined: str = "declined_txn_count_7d > 3",
    as_of: Column | None = None,
) -> DataFrame:
    """`features` at customer grain (`card_features(..., grain="customer")`)."""
    return features.select(
        "customer_id",
        "account_id",
        "card_fraud_score",
        "card_risk_tier",
        top_signal(card_rules() if rules is None else rules).alias("top_fraud_signal"),
        _flag(velocity).alias("velocity_flag"),
        _flag(geo).alias("geo_anomaly_flag"),
        F.col("unknown_device_flag").alias("device_anomaly_flag"),
        _flag(declined).alias("declined_txn_flag"),
        (F.current_timestamp() if as_of is None else as_of).alias("score_updated_at"),
    )


def loan_scores(
    features: DataFrame,
    rules: Sequence[Rule] | None = None,
    income: str = "NOT income_realistic_flag OR loan_to_income_ratio > 5",
    stacking: str = "applications_last_30d > 3",
    repayment: str = "missed_payment_count >= 3 OR partial_payment_ratio > 0.5",
    as_of: Column | None = None,
) -> DataFrame:
    return features.select(
        "customer_id",
        "application_id",
        "loan_fraud_score",
        "loan_risk_tier",
        top_signal(loan_rules() if rules is None else rules).alias("top_fraud_signal"),
        _flag(income).alias("income_fraud_flag"),
        F.col("id_shared_flag").alias("identity_fraud_flag"),
        _flag(stacking).alias("loan_stacking_flag"),
        F.col("agent_risk_flag").alias("agent_risk_flag"),
        _flag(repayment).alias("repayment_risk_flag"),
        (F.current_timestamp() if as_of is None else as_of).alias("score_updated_at"),
    )
