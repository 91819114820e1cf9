"""Names, thresholds and score rules shared by the operators.

Everything here is data: operators take these values as parameters, so a caller
can pass others without touching the code.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: table names, by layer -------------------------------------
BRONZE_CARD_TXN = "bronze_card.bronze_card_txn"
BRONZE_CARD_ACC = "bronze_card.bronze_card_acc"
SILVER_CARD_TXN = "silver_card.silver_card_txn"
SILVER_CARD_ACC = "silver_card.silver_card_acc"
SILVER_CARD_FEATURES = "silver_card.silver_card_features"
BRONZE_LOAN_APP = "bronze_loan.bronze_loan_app"
BRONZE_LOAN_REP = "bronze_loan.bronze_loan_rep"
SILVER_LOAN_APP = "silver_loan.silver_loan_app"
SILVER_LOAN_REP = "silver_loan.silver_loan_rep"
SILVER_LOAN_FEATURES = "silver_loan.silver_loan_features"
GOLD_CARD_SCORES = "gold.gold_card_scores"
GOLD_LOAN_SCORES = "gold.gold_loan_scores"
GOLD_FRAUD_ALERTS = "gold.gold_fraud_alerts"
GOLD_CUSTOMER_RISK = "gold.gold_customer_risk"
RUN_LOG = "logs.logtable"

#: Columns that silver and gold show masked.
SENSITIVE = ("id_number", "ip_address")

# --- fixed values: tier bounds (inclusive) and labels ------------------------
HIGH_RISK = 0.7
MEDIUM_RISK = 0.4
TIER_HIGH, TIER_MEDIUM, TIER_LOW = "high", "medium", "low"


# --- fixed values: what each raw feed has to carry ---------------------------
@dataclass(frozen=True)
class Feed:
    """A raw feed: its file, its key, the columns that must be there and the
    columns that must not be blank."""

    name: str
    file: str
    table: str
    key: str
    required: tuple[str, ...]
    critical: tuple[str, ...]
    breakdowns: tuple[str, ...]


CARD_TXN = Feed(
    name="card_txn",
    file="card_transactions.csv",
    table=BRONZE_CARD_TXN,
    key="transaction_id",
    required=(
        "transaction_id", "account_id", "customer_id", "transaction_date",
        "transaction_time", "amount", "currency", "merchant_name",
        "merchant_category_code", "merchant_country", "channel", "status",
        "is_fraud_label",
    ),
    critical=("transaction_id", "account_id", "customer_id", "amount", "transaction_date"),
    breakdowns=("status", "channel", "is_fraud_label"),
)
CARD_ACC = Feed(
    name="card_acc",
    file="card_accounts.csv",
    table=BRONZE_CARD_ACC,
    key="account_id",
    required=(
        "account_id", "customer_id", "card_type", "card_tier", "account_status",
        "credit_limit", "billing_country", "billing_city",
    ),
    critical=("account_id", "customer_id", "credit_limit"),
    breakdowns=("card_type",),
)
LOAN_APP = Feed(
    name="loan_app",
    file="loan_applications.csv",
    table=BRONZE_LOAN_APP,
    key="application_id",
    required=(
        "application_id", "customer_id", "application_date", "loan_type",
        "loan_amount_requested", "loan_term_months", "stated_income",
        "stated_employment_status", "id_number", "agent_id",
        "application_channel", "application_status", "is_fraud_label",
    ),
    critical=("application_id", "customer_id", "loan_amount_requested", "stated_income"),
    breakdowns=("application_status", "loan_type", "application_channel", "is_fraud_label"),
)
LOAN_REP = Feed(
    name="loan_rep",
    file="loan_repayments.csv",
    table=BRONZE_LOAN_REP,
    key="repayment_id",
    required=(
        "repayment_id", "application_id", "customer_id", "due_date",
        "payment_date", "due_amount", "paid_amount", "payment_status",
        "days_past_due", "outstanding_balance",
    ),
    critical=("repayment_id", "application_id", "customer_id", "due_amount"),
    breakdowns=("payment_status",),
)
FEEDS = {f.name: f for f in (CARD_TXN, CARD_ACC, LOAN_APP, LOAN_REP)}


# --- score rules -------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """One scoring rule: fires when the SQL condition is true, adds `weight`
    hundredths. Hundredths are integers, so sums land exactly on tier bounds."""

    name: str
    condition: str
    weight: int


def card_rules(
    countries: float = 2,
    declines: float = 3,
    international_ratio: float = 0.5,
    late_night_ratio: float = 0.3,
    merchant_risk: float = 2.0,
    merchant_risk_column: str = "merchant_risk_score",
) -> list[Rule]:
    """The six card rules."""
    # Weights and default bounds.
    return [
        Rule("multi_country", f"distinct_countries_30d > {countries}", 25),
        Rule("unknown_device", "unknown_device_flag", 20),
        Rule("repeated_declines", f"declined_txn_count_7d > {declines}", 20),
        Rule("international_ratio", f"international_txn_ratio > {international_ratio}", 15),
        Rule("late_night_ratio", f"late_night_txn_ratio > {late_night_ratio}", 10),
        Rule("merchant_risk", f"{merchant_risk_column} > {merchant_risk}", 10),
    ]


def job_card_rules() -> list[Rule]:
    """The card rules of the feature job: merchant risk is that of the categories paid in.

    The mean of a customer's own z-scores, which the rule compares by default, is 0 by
    construction and never fires. A category whose payments are declined more often than
    not is risky (this project's own bound).
    """
    return card_rules(merchant_risk=0.5, merchant_risk_column="merchant_category_risk")


def loan_rules(
    loan_to_income: float = 5,
    applications: float = 3,
    missed: float = 3,
    partial_ratio: float = 0.5,
) -> list[Rule]:
    """The loan rules. No published weights exist; these are this project's own."""
    return [
        Rule("loan_to_income", f"loan_to_income_ratio > {loan_to_income}", 20),
        Rule("shared_identity", "id_shared_flag", 20),
        Rule("loan_stacking", f"applications_last_30d > {applications}", 15),
        Rule("missed_payments", f"consecutive_missed_count >= {missed}", 15),
        Rule("shared_address", "address_shared_flag", 10),
        Rule("agent_risk", "agent_risk_flag", 10),
        Rule("partial_payments", f"partial_payment_ratio > {partial_ratio}", 10),
    ]
