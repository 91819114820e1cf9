"""KPI row and export projections of the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.config import TIER_HIGH

# --- fixed values: columns of each export, in order ------------------------------
CUSTOMER_RISK = [
    "customer_id", "full_name", "country", "city", "age", "account_status",
    "employment_status", "stated_income", "card_fraud_score", "loan_fraud_score",
    "overall_risk_score", "overall_risk_tier", "card_risk_tier", "loan_risk_tier",
    "flagged_in_card", "flagged_in_loan", "flagged_in_both", "risk_updated_at",
]
FRAUD_ALERTS = [
    "alert_id", "customer_id", "alert_type", "alert_source", "reference_id", "fraud_score",
    "risk_tier", "top_signal", "alert_status", "created_at",
]
CARD_SCORES = [
    "customer_id", "card_fraud_score", "card_risk_tier", "top_fraud_signal", "velocity_flag",
    "geo_anomaly_flag", "device_anomaly_flag", "declined_txn_flag", "score_updated_at",
]
LOAN_SCORES = [
    "customer_id", "loan_fraud_score", "loan_risk_tier", "top_fraud_signal",
    "income_fraud_flag", "identity_fraud_flag", "loan_stacking_flag", "agent_risk_flag",
    "repayment_risk_flag", "score_updated_at",
]
SCORE_COLUMNS = {"card_fraud_score", "loan_fraud_score", "overall_risk_score", "fraud_score"}


def export_view(df: DataFrame, columns: list[str], places: int = 4) -> DataFrame:
    """The export columns of a gold table, scores rounded."""

    def shown(c: str) -> Column:
        return F.round(c, places).alias(c) if c in SCORE_COLUMNS else F.col(c)

    return df.select(*[shown(c) for c in columns])


def kpi_summary(risk: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row of dashboard numbers from one aggregate over each table."""
    customers = risk.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("overall_risk_tier") == TIER_HIGH).alias("high_risk_customers"),
        F.count_if(F.col("flagged_in_both")).alias("flagged_in_both"),
    )
    raised = alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("alert_status") == "open").alias("open_alerts"),
        F.count_if(F.col("alert_source") == "card").alias("card_alerts"),
        F.count_if(F.col("alert_source") == "loan").alias("loan_alerts"),
    )
    both = customers.unionByName(raised, allowMissingColumns=True)
    share = F.try_divide(F.col("high_risk_customers"), F.col("total_customers"))
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn(
        "high_risk_pct", F.round(share * 100, 2)
    )
