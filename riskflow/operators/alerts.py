"""Fraud alerts from the gold score tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.config import TIER_HIGH, TIER_MEDIUM


def fraud_alerts(
    card: DataFrame, loan: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Alerts of all four types; each score table is read once.

    A customer of medium or high tier raises an alert for the source, and a second
    one if the device flag (card) or the repayment flag (loan) is set. Alert ids
    depend only on type, customer, reference and run date, so a rerun repeats them.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    card_alerts = _alerts(
        card, "card", "account_id", "card_fraud_score", "card_risk_tier",
        ("card_transaction", F.col("top_fraud_signal"), F.lit(True)),
        ("card_takeover", F.lit("unknown_device"), F.col("device_anomaly_flag")),
        as_of,
    )
    loan_alerts = _alerts(
        loan, "loan", "application_id", "loan_fraud_score", "loan_risk_tier",
        ("loan_application", F.col("top_fraud_signal"), F.lit(True)),
        ("loan_repayment", F.lit("repayment_risk"), F.col("repayment_risk_flag")),
        as_of,
    )
    return card_alerts.unionByName(loan_alerts)


def _alerts(scores, source, reference, score, tier, general, specific, as_of) -> DataFrame:
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("alert_type"), signal.alias("top_signal"), on.alias("_on"))
            for kind, signal, on in (general, specific)
        ]
    )
    raised = scores.filter(F.col(tier).isin(TIER_MEDIUM, TIER_HIGH)).select(
        "customer_id",
        F.col(reference).cast("string").alias("reference_id"),
        F.col(score).alias("fraud_score"),
        F.col(tier).alias("risk_tier"),
        F.inline(kinds),
    )
    return raised.filter("_on").select(
        alert_id(as_of).alias("alert_id"),
        "customer_id",
        "alert_type",
        F.lit(source).alias("alert_source"),
        "reference_id",
        "fraud_score",
        "risk_tier",
        "top_signal",
        F.lit("open").alias("alert_status"),
        F.lit(None).cast("string").alias("assigned_to"),
        as_of.alias("created_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.lit(None).cast("string").alias("resolution_note"),
    )


def alert_id(as_of: Column) -> Column:
    """First 16 hex digits of a SHA-256 over what identifies the alert."""
    parts = F.concat_ws(
        "|", "alert_type", "customer_id", "reference_id", F.date_format(as_of, "yyyy-MM-dd")
    )
    return F.upper(F.substring(F.sha2(parts, 256), 1, 16))
