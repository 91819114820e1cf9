"""The unified customer risk view: one row per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.config import TIER_HIGH
from riskflow.functions.scoring import risk_tier


def customer_risk(
    customers: DataFrame, card: DataFrame, loan: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Customers left-joined to their card and loan scores.

    The overall score is the larger of the two, a missing one counting as 0. Flags
    of a missing side are NULL. All three inputs have to be unique per customer (the
    jobs see to it), so the two joins share one shuffle of each input.
    """
    card = card.select("customer_id", "card_fraud_score", "card_risk_tier")
    loan = loan.select("customer_id", "loan_fraud_score", "loan_risk_tier")
    in_card = F.col("card_risk_tier") == TIER_HIGH
    in_loan = F.col("loan_risk_tier") == TIER_HIGH
    overall = F.greatest(
        F.coalesce("card_fraud_score", F.lit(0.0)), F.coalesce("loan_fraud_score", F.lit(0.0))
    )
    return (
        customers.join(card, "customer_id", "left")
        .join(loan, "customer_id", "left")
        .withColumn("overall_risk_score", overall)
        .withColumns(
            {
                "overall_risk_tier": risk_tier(F.col("overall_risk_score")),
                "flagged_in_card": in_card,
                "flagged_in_loan": in_loan,
                "flagged_in_both": in_card & in_loan,
                "risk_updated_at": F.current_timestamp() if as_of is None else as_of,
            }
        )
    )


def with_activity(
    risk: DataFrame, alerts: DataFrame, transactions: DataFrame, applications: DataFrame
) -> DataFrame:
    """Add alert counts and the dates of the last alert, transaction and application."""
    per_alert = alerts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("alert_status") == "open").alias("open_alerts"),
        F.max("created_at").alias("last_alert_date"),
    )
    per_txn = transactions.groupBy("customer_id").agg(
        F.max("transaction_ts").alias("last_card_transaction")
    )
    per_app = applications.groupBy("customer_id").agg(
        F.max("application_date").alias("last_loan_application")
    )
    joined = risk
    for side in (per_alert, per_txn, per_app):
        joined = joined.join(side, "customer_id", "left")
    return joined.fillna(0, subset=["total_alerts", "open_alerts"])
