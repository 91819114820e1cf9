"""The risk tables in SQL: functions for tiers and scores, the risk view, the run log.

`register` makes temporary functions and views of a session, so that

    SELECT * FROM customer_risk WHERE overall_risk_tier = 'high'
    SELECT * FROM log_summary('card', 24, current_timestamp())
    SELECT card_fraud_score(3, true, 0, 0.6, 0.1, 0.0)

give what the DataFrame operators give. Rules and bounds come from the same data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from riskflow import config as c

# Arguments of the score functions, by the columns that the rules name.
CARD_ARGUMENTS = (
    ("distinct_countries_30d", "BIGINT"),
    ("unknown_device_flag", "BOOLEAN"),
    ("declined_txn_count_7d", "BIGINT"),
    ("international_txn_ratio", "DOUBLE"),
    ("late_night_txn_ratio", "DOUBLE"),
    ("merchant_risk_score", "DOUBLE"),
)
LOAN_ARGUMENTS = (
    ("loan_to_income_ratio", "DOUBLE"),
    ("id_shared_flag", "BOOLEAN"),
    ("applications_last_30d", "BIGINT"),
    ("consecutive_missed_count", "BIGINT"),
    ("address_shared_flag", "BOOLEAN"),
    ("agent_risk_flag", "BOOLEAN"),
    ("partial_payment_ratio", "DOUBLE"),
)


def _function(name: str, arguments: Sequence[tuple[str, str]], returns: str, body: str) -> str:
    listed = ", ".join(f"{a} {t}" for a, t in arguments)
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({listed}) RETURNS {returns} RETURN {body}"


def score_sql(rules: Sequence[c.Rule]) -> str:
    """The weighted score as a SQL expression over the rules' columns."""
    points = " + ".join(f"CASE WHEN {r.condition} THEN {r.weight} ELSE 0 END" for r in rules)
    return f"least(1.0D, greatest(0.0D, ({points}) / 100.0D))"


def signal_sql(rules: Sequence[c.Rule]) -> str:
    """The heaviest rule that fires as a SQL expression."""
    ranked = sorted(rules, key=lambda r: -r.weight)
    cases = " ".join(f"WHEN {r.condition} THEN '{r.name}'" for r in ranked)
    return f"CASE {cases} ELSE 'none' END"


def register_functions(
    spark: SparkSession,
    card_rules: Sequence[c.Rule] | None = None,
    loan_rules: Sequence[c.Rule] | None = None,
    merchant_risk_column: str = "merchant_risk_score",
) -> None:
    """risk_tier, overall_risk_score, and a score and a signal function for card and loan.

    `merchant_risk_column` names the last card argument, as the card rules call it.
    """
    card = c.card_rules() if card_rules is None else card_rules
    loan = c.loan_rules() if loan_rules is None else loan_rules
    card_arguments = (*CARD_ARGUMENTS[:-1], (merchant_risk_column, "DOUBLE"))
    tier = (
        f"CASE WHEN score >= {c.HIGH_RISK} THEN '{c.TIER_HIGH}' "
        f"WHEN score >= {c.MEDIUM_RISK} THEN '{c.TIER_MEDIUM}' ELSE '{c.TIER_LOW}' END"
    )
    larger = "greatest(coalesce(card_score, 0.0D), coalesce(loan_score, 0.0D))"
    both = (("card_score", "DOUBLE"), ("loan_score", "DOUBLE"))
    for statement in (
        _function("risk_tier", (("score", "DOUBLE"),), "STRING", tier),
        _function("overall_risk_score", both, "DOUBLE", larger),
        _function("card_fraud_score", card_arguments, "DOUBLE", score_sql(card)),
        _function("card_top_signal", card_arguments, "STRING", signal_sql(card)),
        _function("loan_fraud_score", LOAN_ARGUMENTS, "DOUBLE", score_sql(loan)),
        _function("loan_top_signal", LOAN_ARGUMENTS, "STRING", signal_sql(loan)),
    ):
        spark.sql(statement)


def register_risk_view(customers: DataFrame, card: DataFrame, loan: DataFrame) -> None:
    """The view `customer_risk` over customers and score tables, each unique per customer."""
    spark = customers.sparkSession
    names = {"risk_customers": customers, "risk_card_scores": card, "risk_loan_scores": loan}
    for name, df in names.items():
        df.createOrReplaceTempView(name)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY VIEW customer_risk AS
        SELECT *, risk_tier(overall_risk_score) AS overall_risk_tier,
               card_risk_tier = '{c.TIER_HIGH}' AS flagged_in_card,
               loan_risk_tier = '{c.TIER_HIGH}' AS flagged_in_loan,
               card_risk_tier = '{c.TIER_HIGH}' AND loan_risk_tier = '{c.TIER_HIGH}' AS flagged_in_both,
               current_timestamp() AS risk_updated_at
        FROM (SELECT c.*, k.card_fraud_score, k.card_risk_tier, l.loan_fraud_score, l.loan_risk_tier,
                     overall_risk_score(k.card_fraud_score, l.loan_fraud_score) AS overall_risk_score
              FROM risk_customers c
              LEFT JOIN risk_card_scores k ON c.customer_id = k.customer_id
              LEFT JOIN risk_loan_scores l ON c.customer_id = l.customer_id)""")


def register_log(log: DataFrame) -> None:
    """`log_recent`, `log_summary` and `log_errors`, each of (pipeline, hours, as_of)."""
    spark = log.sparkSession
    log.createOrReplaceTempView("run_log")
    at = dict(log.dtypes)["log_timestamp"]
    arguments = (("of_pipeline", "STRING"), ("hours", "INT"), ("as_of", at))
    recent = (
        "run_log WHERE pipeline = of_pipeline AND log_timestamp "
        "BETWEEN as_of - make_dt_interval(0, hours) AND as_of"
    )
    entry = f"TABLE(pipeline STRING, level STRING, message STRING, log_timestamp {at})"
    counts = "TABLE(level STRING, count BIGINT)"
    grouped = f"SELECT level, count(*) FROM {recent} GROUP BY level"
    errors = f"SELECT count_if(level = 'ERROR') FROM {recent}"
    columns = "pipeline, level, message, log_timestamp"
    spark.sql(_function("log_recent", arguments, entry, f"SELECT {columns} FROM {recent}"))
    spark.sql(_function("log_summary", arguments, counts, grouped))
    spark.sql(_function("log_errors", arguments, "TABLE(errors BIGINT)", errors))


def register(
    customers: DataFrame, card: DataFrame, loan: DataFrame, log: DataFrame | None = None
) -> None:
    """All of the above, with the default rules."""
    register_functions(customers.sparkSession)
    register_risk_view(customers, card, loan)
    if log is not None:
        register_log(log)
