"""The same results in plain SQL, written apart from the operators.

`VIEWS` are common table expressions; a query names those it starts from and gets
them with all they rest on, in order.
"""

from __future__ import annotations

import re

from riskflow import config as c
from riskflow.checks.views import AS_OF, AS_OF_TXN

ASOF = f"TIMESTAMP '{AS_OF}'"
ASOF_TXN = f"TIMESTAMP '{AS_OF_TXN}'"


def approx(x: str, places: int = 5) -> str:
    return f"round({x} + 1.2e-6, {places}) + 0.0"


def half_up(x: str, places: int) -> str:
    """Round the decimal text of a double half up, as Spark does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {places}) AS DOUBLE)"


def share(condition: str, of: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) / CAST(count({of}) AS DOUBLE)"


VIEWS: dict[str, str] = {
    "acc": """
        SELECT c_custkey AS account_id, c_custkey AS customer_id,
               c_nationkey AS billing_country, c_acctbal AS credit_limit,
               c_mktsegment AS account_status
        FROM customer""",
    "txn": """
        SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
               o_custkey AS account_id, o_custkey AS customer_id,
               l_shipdate + to_hours(CAST(l_partkey % 24 AS INTEGER))
                          + to_minutes(CAST(l_suppkey % 60 AS INTEGER)) AS transaction_ts,
               l_extendedprice AS amount, l_suppkey AS merchant_id, s_name AS merchant_name,
               s_nationkey AS merchant_country, l_partkey % 5 AS merchant_category_code,
               CASE l_returnflag WHEN 'R' THEN 'declined' ELSE 'approved' END AS status,
               CASE l_linestatus WHEN 'O' THEN 'online' ELSE 'pos' END AS channel,
               l_partkey % 97 AS device_id, l_partkey AS part_id, l_quantity AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey""",
    "evt": """
        SELECT event_id AS transaction_id, user_id AS customer_id, ts AS transaction_ts,
               value AS amount,
               CASE event_type WHEN 'error' THEN 'declined' ELSE 'approved' END AS status,
               CASE event_type WHEN 'purchase' THEN 'online' ELSE 'pos' END AS channel,
               event_type AS merchant_country, substr(props, 1, 7) AS merchant_name
        FROM events""",
    "app": """
        SELECT o_orderkey AS application_id, o_custkey AS customer_id,
               CAST(o_orderdate AS DATE) AS application_date, o_orderpriority AS loan_type,
               o_totalprice AS loan_amount_requested, c_acctbal AS stated_income,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'unemployed' ELSE 'employed' END
                   AS stated_employment_status,
               CAST(c_custkey % 20 AS INTEGER) AS stated_years_employed,
               nullif(c_custkey % 1000, 7) AS id_number,
               c_nationkey || '-' || c_mktsegment || '-' || (c_custkey % 10) AS address,
               nullif(o_orderkey % 200, 13) AS agent_id, o_orderkey % 50 AS branch_id,
               CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'pending'
                    ELSE 'declined' END AS application_status
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "rep": """
        SELECT l_orderkey * 10 + l_linenumber AS repayment_id, l_orderkey AS application_id,
               o_custkey AS customer_id, CAST(l_shipdate AS DATE) AS due_date,
               l_extendedprice AS due_amount,
               CASE l_returnflag WHEN 'R' THEN CAST(0 AS DOUBLE)
                    WHEN 'A' THEN l_extendedprice * (1 - l_discount * 5)
                    ELSE l_extendedprice END AS paid_amount,
               CASE WHEN l_returnflag = 'R' THEN 'missed' WHEN l_returnflag = 'A' THEN 'partial'
                    WHEN l_tax > 0.06 THEN 'late' ELSE 'paid' END AS payment_status,
               CAST(l_quantity AS INTEGER) AS days_past_due,
               l_extendedprice * l_tax AS outstanding_balance,
               l_partkey AS part_id, l_suppkey AS supplier_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "cust": """
        SELECT c_custkey AS customer_id, c_name AS full_name, c_nationkey AS country,
               c_mktsegment AS city, CAST(NULL AS INTEGER) AS age, 'active' AS account_status,
               'employed' AS employment_status, c_acctbal AS stated_income
        FROM customer""",
    # --- raw text feeds ---
    "bronze_txn": """
        SELECT CAST(transaction_id AS VARCHAR) AS transaction_id,
               CAST(account_id AS VARCHAR) AS account_id,
               CAST(customer_id AS VARCHAR) AS customer_id,
               strftime(transaction_ts, '%Y-%m-%d') AS transaction_date,
               strftime(transaction_ts, '%H:%M:%S') AS transaction_time,
               CASE quantity WHEN 13 THEN 'n/a' WHEN 17 THEN 'NaN' WHEN 18 THEN 'Infinity'
                   ELSE CAST(amount AS VARCHAR) END AS amount,
               ' zar' AS currency, CAST(merchant_id AS VARCHAR) AS merchant_id, merchant_name,
               CAST(merchant_category_code AS VARCHAR) AS merchant_category_code,
               CASE WHEN merchant_id % 17 <> 0 THEN ' c' || merchant_country || ' ' END
                   AS merchant_country,
               CASE channel WHEN 'online' THEN ' Online' ELSE 'POS ' END AS channel,
               CAST(device_id AS VARCHAR) AS device_id,
               CASE status WHEN 'declined' THEN 'Declined' ELSE 'Approved' END AS status,
               CAST(transaction_id % 2 AS VARCHAR) AS is_fraud_label,
               part_id * 10000000000 + merchant_id * 10000000 + CAST(quantity AS BIGINT)
                   AS _ingested_at,
               'card_transactions.csv' AS _source_file
        FROM txn""",
    "bronze_acc": """
        SELECT CAST(account_id AS VARCHAR) AS account_id,
               CAST(customer_id AS VARCHAR) AS customer_id,
               ' VISA' AS card_type, 'Gold ' AS card_tier,
               CASE WHEN account_id % 10 = 3 THEN '31/12/2020' ELSE '2020-12-31' END
                   AS account_open_date,
               ' ' || account_status AS account_status,
               CASE WHEN account_id % 10 = 4 THEN '' ELSE CAST(credit_limit AS VARCHAR) END
                   AS credit_limit,
               'c' || billing_country || ' ' AS billing_country, 'Town' AS billing_city,
               2 AS _ingested_at
        FROM acc
        -- every seventh account was loaded before, with another country
        UNION ALL SELECT CAST(account_id AS VARCHAR), CAST(customer_id AS VARCHAR),
               ' VISA', 'Gold ', '2020-12-31', ' old', '1', 'c' || (billing_country + 50), 'Town', 1
        FROM acc WHERE account_id % 7 = 0""",
    "silver_acc": """
        SELECT * FROM bronze_acc
        QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY _ingested_at DESC) = 1""",
    "bronze_app": """
        SELECT CAST(application_id AS VARCHAR) AS application_id,
               CAST(customer_id AS VARCHAR) AS customer_id,
               strftime(application_date, '%Y-%m-%d') AS application_date,
               ' ' || loan_type AS loan_type,
               CAST(loan_amount_requested AS VARCHAR) AS loan_amount_requested,
               CASE WHEN application_id % 7 = 0 THEN 'twelve' ELSE '12' END AS loan_term_months,
               CAST(stated_income AS VARCHAR) AS stated_income,
               upper(stated_employment_status) AS stated_employment_status,
               CAST(stated_years_employed AS VARCHAR) AS stated_years_employed,
               '2' AS num_dependants, CAST(id_number AS VARCHAR) AS id_number,
               CAST(customer_id % 50 + 1940 AS VARCHAR) || '-03-05' AS date_of_birth, address,
               CAST(agent_id AS VARCHAR) AS agent_id, CAST(branch_id AS VARCHAR) AS branch_id,
               'Online' AS application_channel,
               upper(application_status[1]) || application_status[2:] AS application_status,
               '0' AS is_fraud_label
        FROM app""",
    "bronze_rep": """
        SELECT CAST(repayment_id AS VARCHAR) AS repayment_id,
               CAST(application_id AS VARCHAR) AS application_id,
               CAST(customer_id AS VARCHAR) AS customer_id,
               CASE WHEN supplier_id % 11 <> 0 THEN strftime(due_date, '%Y-%m-%d') END AS due_date,
               CASE WHEN payment_status <> 'missed' THEN strftime(due_date, '%Y-%m-%d') END
                   AS payment_date,
               CAST(due_amount AS VARCHAR) AS due_amount,
               CAST(paid_amount AS VARCHAR) AS paid_amount,
               upper(payment_status[1]) || payment_status[2:] || ' ' AS payment_status,
               CAST(days_past_due AS VARCHAR) AS days_past_due,
               CAST(outstanding_balance AS VARCHAR) AS outstanding_balance,
               part_id * 10000000000 + supplier_id * 10000000 + days_past_due AS _ingested_at
        FROM rep""",
    # --- row signals ---
    "txn_signals": """
        SELECT txn.*, coalesce(merchant_country <> billing_country, false) AS is_international,
               CAST(hour(transaction_ts) AS INTEGER) AS hour_of_day,
               dayofweek(transaction_ts) IN (0, 6) AS is_weekend,
               CASE WHEN stddev_samp(amount) OVER p > 0
                    THEN (amount - avg(amount) OVER p) / stddev_samp(amount) OVER p
                    ELSE 0.0 END AS amount_zscore
        FROM txn LEFT JOIN (SELECT account_id, billing_country FROM acc) a USING (account_id)
        WINDOW p AS (PARTITION BY txn.customer_id)""",
    "txn_latest": """
        SELECT * FROM txn_signals
        QUALIFY row_number() OVER (PARTITION BY transaction_id
            ORDER BY transaction_ts DESC, part_id DESC, merchant_id DESC, quantity DESC) = 1""",
    "agents": """
        SELECT agent_id, count(*) FILTER (WHERE application_status = 'approved')
               / CAST(count(application_id) AS DOUBLE) AS agent_approval_rate
        FROM app GROUP BY agent_id""",
    "app_signals": f"""
        SELECT app.*,
               CASE WHEN stated_income > 0 THEN {half_up('loan_amount_requested / stated_income', 4)}
                    END AS loan_to_income_ratio,
               CASE WHEN stated_employment_status = 'unemployed' AND stated_income > 5000 THEN false
                    WHEN stated_years_employed <= 1 AND stated_income > 8000 THEN false
                    ELSE true END AS is_income_realistic,
               count(application_id) OVER (PARTITION BY customer_id) AS applications_last_30d,
               coalesce(ids.n > 1, false) AS id_shared_flag,
               coalesce(addresses.n > 1, false) AS address_shared_flag, agent_approval_rate
        FROM app
        LEFT JOIN (SELECT id_number, count(DISTINCT customer_id) AS n FROM app GROUP BY 1) ids
            USING (id_number)
        LEFT JOIN (SELECT address, count(DISTINCT customer_id) AS n FROM app GROUP BY 1) addresses
            USING (address)
        LEFT JOIN agents USING (agent_id)""",
    "rep_signals": f"""
        SELECT *, {half_up('due_amount - paid_amount', 2)} AS payment_shortfall,
               payment_status = 'missed' AS is_missed, payment_status = 'partial' AS is_partial,
               payment_status = 'late' AS is_late,
               CAST(sum(CAST(payment_status = 'missed' AS INTEGER))
                    OVER (PARTITION BY customer_id ORDER BY due_date) AS BIGINT)
                   AS consecutive_missed_count
        FROM rep""",
    "rep_latest": """
        SELECT * FROM rep_signals
        QUALIFY row_number() OVER (PARTITION BY repayment_id
            ORDER BY due_date DESC, part_id DESC, supplier_id DESC, days_past_due DESC) = 1""",
    "runs": """
        SELECT *, sum(CAST(NOT is_missed AS INTEGER)) OVER (PARTITION BY customer_id
                      ORDER BY due_date, repayment_id ROWS UNBOUNDED PRECEDING) AS run
        FROM rep_latest""",
    "streaks": """
        SELECT customer_id, due_date, repayment_id, is_missed,
               CAST(sum(CAST(is_missed AS INTEGER)) OVER (PARTITION BY customer_id, run
                   ORDER BY due_date, repayment_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
                   AS missed_streak
        FROM runs""",
    # --- features, scores ---
    "mcc_risk": """
        SELECT customer_id, avg(risk) AS merchant_category_risk
        FROM txn JOIN (SELECT merchant_category_code,
                              avg(CAST(status = 'declined' AS INTEGER)) AS risk
                       FROM txn GROUP BY 1) USING (merchant_category_code)
        GROUP BY customer_id""",
    "card_agg": f"""
        SELECT customer_id, count(transaction_id) AS txn_count_30d,
               avg(amount) AS avg_txn_amount_30d, max(amount) AS max_txn_amount_30d,
               count(*) FILTER (WHERE status = 'declined') AS declined_txn_count_7d,
               count(*) FILTER (WHERE hour_of_day BETWEEN 0 AND 1) AS txn_count_1h,
               {share('hour_of_day BETWEEN 0 AND 4', 'transaction_id')} AS late_night_txn_ratio,
               count(DISTINCT merchant_country) AS distinct_countries_30d,
               count(DISTINCT merchant_name) AS distinct_merchants_7d,
               {share('is_international', 'transaction_id')} AS international_txn_ratio,
               {share("channel = 'online'", 'transaction_id')} AS online_txn_ratio,
               count(DISTINCT device_id) > 33 AS unknown_device_flag,
               avg(amount_zscore) AS merchant_risk_score
        FROM txn_signals GROUP BY customer_id""",
    "card_features": """
        SELECT customer_id, account_id, account_status, credit_limit,
               coalesce(txn_count_30d, 0) AS txn_count_30d,
               coalesce(avg_txn_amount_30d, 0) AS avg_txn_amount_30d,
               coalesce(max_txn_amount_30d, 0) AS max_txn_amount_30d,
               coalesce(declined_txn_count_7d, 0) AS declined_txn_count_7d,
               coalesce(txn_count_1h, 0) AS txn_count_1h,
               coalesce(late_night_txn_ratio, 0) AS late_night_txn_ratio,
               coalesce(distinct_countries_30d, 0) AS distinct_countries_30d,
               coalesce(distinct_merchants_7d, 0) AS distinct_merchants_7d,
               coalesce(international_txn_ratio, 0) AS international_txn_ratio,
               coalesce(online_txn_ratio, 0) AS online_txn_ratio,
               coalesce(unknown_device_flag, false) AS unknown_device_flag,
               coalesce(merchant_risk_score, 0) AS merchant_risk_score,
               merchant_category_risk
        FROM acc LEFT JOIN card_agg USING (customer_id) LEFT JOIN mcc_risk USING (customer_id)""",
    "card_scored": f"""
        SELECT *, CASE WHEN points >= 70 THEN 'high' WHEN points >= 40 THEN 'medium'
                       ELSE 'low' END AS card_risk_tier,
               points / CAST(100 AS DOUBLE) AS card_fraud_score, {ASOF} AS feature_updated_at
        FROM (SELECT *, CASE WHEN distinct_countries_30d > 18 THEN 25 ELSE 0 END
                 + CASE WHEN unknown_device_flag THEN 20 ELSE 0 END
                 + CASE WHEN declined_txn_count_7d > 13 THEN 20 ELSE 0 END
                 + CASE WHEN international_txn_ratio > 0.96 THEN 15 ELSE 0 END
                 + CASE WHEN late_night_txn_ratio > 0.22 THEN 10 ELSE 0 END
                 + CASE WHEN merchant_category_risk > 0.334 THEN 10 ELSE 0 END AS points
              FROM card_features)""",
    "app_features": """
        SELECT customer_id, count(application_id) AS applications_last_30d,
               count(DISTINCT branch_id) AS distinct_branches_30d,
               max(loan_to_income_ratio) AS loan_to_income_ratio,
               bool_or(id_shared_flag) AS id_shared_flag,
               bool_or(address_shared_flag) AS address_shared_flag,
               max(agent_approval_rate) AS agent_approval_rate,
               bool_or(is_income_realistic) AS income_realistic_flag,
               arg_max(application_id, (application_date, application_id)) AS application_id,
               coalesce(max(agent_approval_rate) >= 0.42, false) AS agent_risk_flag
        FROM app_signals GROUP BY customer_id""",
    "rep_features": f"""
        SELECT customer_id, count(*) FILTER (WHERE is_missed) AS missed_payment_count,
               max(consecutive_missed_count) AS consecutive_missed_count,
               avg(CASE WHEN due_amount > 0 THEN paid_amount / due_amount END)
                   AS avg_payment_ratio,
               avg(days_past_due) AS avg_days_past_due,
               sum(outstanding_balance) AS total_outstanding_balance,
               {share('is_partial', 'repayment_id')} AS partial_payment_ratio
        FROM rep_signals GROUP BY customer_id""",
    "loan_features": """
        SELECT customer_id, applications_last_30d, distinct_branches_30d,
               coalesce(loan_to_income_ratio, 0) AS loan_to_income_ratio, id_shared_flag,
               address_shared_flag, coalesce(agent_approval_rate, 0) AS agent_approval_rate,
               income_realistic_flag, application_id, agent_risk_flag,
               coalesce(missed_payment_count, 0) AS missed_payment_count,
               coalesce(consecutive_missed_count, 0) AS consecutive_missed_count,
               coalesce(avg_payment_ratio, 0) AS avg_payment_ratio,
               coalesce(avg_days_past_due, 0) AS avg_days_past_due,
               coalesce(total_outstanding_balance, 0) AS total_outstanding_balance,
               coalesce(partial_payment_ratio, 0) AS partial_payment_ratio
        FROM app_features LEFT JOIN rep_features USING (customer_id)""",
    "loan_scored": """
        SELECT *, CASE WHEN points >= 70 THEN 'high' WHEN points >= 40 THEN 'medium'
                       ELSE 'low' END AS loan_risk_tier,
               points / CAST(100 AS DOUBLE) AS loan_fraud_score
        FROM (SELECT *, CASE WHEN loan_to_income_ratio > 100 THEN 20 ELSE 0 END
                 + CASE WHEN id_shared_flag THEN 20 ELSE 0 END
                 + CASE WHEN applications_last_30d > 10 THEN 15 ELSE 0 END
                 + CASE WHEN consecutive_missed_count >= 13 THEN 15 ELSE 0 END
                 + CASE WHEN address_shared_flag THEN 10 ELSE 0 END
                 + CASE WHEN agent_risk_flag THEN 10 ELSE 0 END
                 + CASE WHEN partial_payment_ratio > 0.33 THEN 10 ELSE 0 END AS points
              FROM loan_features)""",
    # --- gold ---
    "card_scores": f"""
        SELECT customer_id, account_id, card_fraud_score, card_risk_tier,
               CASE WHEN distinct_countries_30d > 18 THEN 'multi_country'
                    WHEN unknown_device_flag THEN 'unknown_device'
                    WHEN declined_txn_count_7d > 13 THEN 'repeated_declines'
                    WHEN international_txn_ratio > 0.96 THEN 'international_ratio'
                    WHEN late_night_txn_ratio > 0.22 THEN 'late_night_ratio'
                    WHEN merchant_category_risk > 0.334 THEN 'merchant_risk'
                    ELSE 'none' END AS top_fraud_signal,
               txn_count_1h > 4 AS velocity_flag,
               distinct_countries_30d > 18 OR international_txn_ratio > 0.96 AS geo_anomaly_flag,
               unknown_device_flag AS device_anomaly_flag,
               declined_txn_count_7d > 13 AS declined_txn_flag, {ASOF} AS score_updated_at
        FROM card_scored""",
    "loan_scores": f"""
        SELECT customer_id, application_id, loan_fraud_score, loan_risk_tier,
               CASE WHEN loan_to_income_ratio > 100 THEN 'loan_to_income'
                    WHEN id_shared_flag THEN 'shared_identity'
                    WHEN applications_last_30d > 10 THEN 'loan_stacking'
                    WHEN consecutive_missed_count >= 13 THEN 'missed_payments'
                    WHEN address_shared_flag THEN 'shared_address'
                    WHEN agent_risk_flag THEN 'agent_risk'
                    WHEN partial_payment_ratio > 0.33 THEN 'partial_payments'
                    ELSE 'none' END AS top_fraud_signal,
               NOT income_realistic_flag OR loan_to_income_ratio > 100 AS income_fraud_flag,
               id_shared_flag AS identity_fraud_flag,
               applications_last_30d > 10 AS loan_stacking_flag, agent_risk_flag,
               missed_payment_count >= 13 OR partial_payment_ratio > 0.33 AS repayment_risk_flag,
               {ASOF} AS score_updated_at
        FROM loan_scored""",
    "raised": """
        SELECT customer_id, 'card_transaction' AS alert_type, 'card' AS alert_source,
               CAST(account_id AS VARCHAR) AS reference_id, card_fraud_score AS fraud_score,
               card_risk_tier AS risk_tier, top_fraud_signal AS top_signal
        FROM card_scores WHERE card_risk_tier IN ('medium', 'high')
        UNION ALL
        SELECT customer_id, 'card_takeover', 'card', CAST(account_id AS VARCHAR),
               card_fraud_score, card_risk_tier, 'unknown_device'
        FROM card_scores WHERE device_anomaly_flag AND card_risk_tier IN ('medium', 'high')
        UNION ALL
        SELECT customer_id, 'loan_application', 'loan', CAST(application_id AS VARCHAR),
               loan_fraud_score, loan_risk_tier, top_fraud_signal
        FROM loan_scores WHERE loan_risk_tier IN ('medium', 'high')
        UNION ALL
        SELECT customer_id, 'loan_repayment', 'loan', CAST(application_id AS VARCHAR),
               loan_fraud_score, loan_risk_tier, 'repayment_risk'
        FROM loan_scores WHERE repayment_risk_flag AND loan_risk_tier IN ('medium', 'high')""",
    "alerts": f"""
        SELECT upper(substr(sha256(concat_ws('|', alert_type, customer_id, reference_id,
                                             strftime({ASOF}, '%Y-%m-%d'))), 1, 16)) AS alert_id,
               raised.*, 'open' AS alert_status, CAST(NULL AS VARCHAR) AS assigned_to,
               {ASOF} AS created_at, CAST(NULL AS TIMESTAMP) AS resolved_at,
               CAST(NULL AS VARCHAR) AS resolution_note
        FROM raised""",
    "risk": f"""
        SELECT *, CASE WHEN overall_risk_score >= 0.7 THEN 'high'
                       WHEN overall_risk_score >= 0.4 THEN 'medium' ELSE 'low' END
                   AS overall_risk_tier,
               card_risk_tier = 'high' AS flagged_in_card,
               loan_risk_tier = 'high' AS flagged_in_loan,
               card_risk_tier = 'high' AND loan_risk_tier = 'high' AS flagged_in_both,
               {ASOF} AS risk_updated_at
        FROM (SELECT cust.*, card_fraud_score, card_risk_tier, loan_fraud_score, loan_risk_tier,
                     greatest(coalesce(card_fraud_score, 0), coalesce(loan_fraud_score, 0))
                         AS overall_risk_score
              FROM cust LEFT JOIN card_scores USING (customer_id)
              LEFT JOIN loan_scores USING (customer_id))""",
    # --- run log ---
    "log": """
        SELECT CASE WHEN user_id % 2 = 0 THEN 'card' ELSE 'loan' END AS pipeline,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARNING'
                    ELSE 'INFO' END AS level,
               props AS message, ts AS log_timestamp
        FROM events""",
}


def with_views(body: str) -> str:
    """Prefix `body` with the views it names and all they rest on, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, sql in VIEWS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(sql)
                needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    return f"WITH {ctes}\n{body}"


def _breakdown(view: str, column: str) -> str:
    return f'SELECT {column}, count(*) AS "count" FROM {view} GROUP BY 1 ORDER BY 2 DESC, 1'


def _breakdowns(view: str, columns) -> str:
    parts = [
        f"""SELECT '{x}' AS "column", CAST({x} AS VARCHAR) AS value, count(*) AS "count"
            FROM {view} GROUP BY {x}"""
        for x in columns
    ]
    return "\nUNION ALL\n".join(parts)


def _profile(view: str, feed: c.Feed, have: set[str]) -> str:
    def row(check: str, column: str, value: str) -> str:
        return (
            f"""SELECT '{check}' AS "check", '{column}' AS "column", """
            f"CAST({value} AS BIGINT) AS value FROM {view}"
        )

    key = feed.key
    distinct = f"count(DISTINCT {key}) + max(CAST({key} IS NULL AS INTEGER))"
    rows = [
        row("rows", "", "count(*)"),
        row("duplicate_keys", key, f"count(*) - ({distinct})"),
        row("null_keys", key, f"count(*) FILTER (WHERE {key} IS NULL)"),
    ]
    rows += [
        row("blanks", x, f"count(*) FILTER (WHERE {x} IS NULL OR {x} = '')")
        for x in feed.critical
    ]
    rows += [row("nulls", x, f"count(*) FILTER (WHERE {x} IS NULL)") for x in sorted(have)]
    rows += [row("missing_column", x, f"max({int(x not in have)})") for x in feed.required]
    body = "\nUNION ALL\n".join(rows)
    return f"""SELECT *, CASE WHEN "check" = 'rows' THEN CASE WHEN value > 0 THEN 'OK' ELSE 'ERROR' END
        WHEN value = 0 OR "check" = 'nulls' THEN 'OK' WHEN "check" = 'missing_column' THEN 'ERROR'
        ELSE 'WARNING' END AS status FROM ({body})"""


def _columns(view: str) -> set[str]:
    named = set(re.findall(r"\bAS (\w+)", VIEWS[view]))
    plain = set(re.findall(r"\b(merchant_name|address)\b", VIEWS[view]))
    return (named | plain) - {"VARCHAR", "BIGINT", "INTEGER", "DOUBLE", "DATE"}


def _except_approx(view: str, *columns: str) -> str:
    replaced = ", ".join(f"{approx(x)} AS {x}" for x in columns)
    return f"SELECT * REPLACE ({replaced}) FROM {view}"


def _asof(view: str, as_of: str) -> str:
    week = f"transaction_ts >= {as_of} - INTERVAL 7 DAY"
    return f"""
        SELECT customer_id, count(transaction_id) AS txn_count_30d_asof,
               {approx('avg(amount)')} AS avg_txn_amount_30d_asof,
               max(amount) AS max_txn_amount_30d_asof,
               count(DISTINCT merchant_country) AS distinct_countries_30d_asof,
               count(*) FILTER (WHERE {week} AND status = 'declined')
                   AS declined_txn_count_7d_asof,
               count(DISTINCT merchant_name) FILTER (WHERE {week}) AS distinct_merchants_7d_asof
        FROM {view}
        WHERE transaction_ts BETWEEN {as_of} - INTERVAL 30 DAY AND {as_of}
        GROUP BY customer_id"""


def _rolling(interval: str, out: str, view: str = "evt") -> str:
    return f"""
        SELECT DISTINCT customer_id, transaction_ts,
               count(*) OVER (PARTITION BY customer_id ORDER BY transaction_ts
                   RANGE BETWEEN INTERVAL {interval} PRECEDING AND CURRENT ROW) AS {out}
        FROM {view}"""


RECENT = """log_timestamp >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL {} HOUR
    AND log_timestamp <= TIMESTAMP '2024-01-30 12:00:00'"""
Z = f"{approx('amount_zscore')} AS amount_zscore"


def _silver_txn(source: str) -> str:
    return f"""
        SELECT transaction_id, account_id, customer_id, amount,
               upper(trim(currency)) AS currency, merchant_id, merchant_name,
               merchant_category_code, upper(trim(merchant_country)) AS merchant_country,
               lower(trim(channel)) AS channel, device_id, lower(trim(status)) AS status,
               TRY_CAST(is_fraud_label AS INTEGER) AS is_fraud_label, _ingested_at, _source_file,
               CAST(transaction_date || ' ' || transaction_time AS TIMESTAMP) AS transaction_ts,
               coalesce(upper(trim(merchant_country)) <> upper(trim(billing_country)), false)
                   AS is_international,
               CAST(hour(CAST(transaction_date || ' ' || transaction_time AS TIMESTAMP)) AS INTEGER)
                   AS hour_of_day,
               dayofweek(CAST(transaction_date AS DATE)) IN (0, 6) AS is_weekend,
               CASE WHEN stddev_samp(amount) OVER p > 0
                    THEN (amount - avg(amount) OVER p) / stddev_samp(amount) OVER p
                    ELSE 0.0 END AS amount_zscore
        FROM (SELECT * REPLACE (CASE WHEN isfinite(TRY_CAST(amount AS DOUBLE))
                                THEN TRY_CAST(amount AS DOUBLE) END AS amount) FROM {source})
        LEFT JOIN (SELECT account_id, billing_country FROM silver_acc) USING (account_id)
        WINDOW p AS (PARTITION BY customer_id)"""


LATEST_TXN = "row_number() OVER (PARTITION BY transaction_id ORDER BY _ingested_at DESC) = 1"

QUERIES: dict[str, str] = {
    "ingest_metadata": f"""
        SELECT c_custkey, {ASOF} AS _ingested_at, 'customer.parquet' AS _source_file
        FROM customer""",
    "cast_columns": """
        SELECT p_partkey,
               CASE WHEN p_size NOT IN (3, 4, 5) THEN p_retailprice END AS price,
               CASE WHEN p_size <= 25 THEN p_size END AS size FROM part""",
    "parse_dates": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS at
        FROM orders""",
    "combine_date_time": """
        SELECT CASE WHEN merchant_id % 17 <> 0 THEN transaction_ts END AS transaction_ts,
               count(*) AS n FROM txn GROUP BY 1""",
    "normalize_labels": """
        SELECT CASE WHEN merchant_id % 17 <> 0 THEN 'C' || merchant_country END
                   AS merchant_country,
               'ZAR' AS currency, channel, status, count(*) AS n
        FROM txn GROUP BY 1, 2, 3, 4""",
    "mask_tail": "SELECT c_custkey, '****' || right(c_name, 4) AS masked FROM customer",
    "drop_nulls": """
        SELECT application_id, id_number, agent_id FROM app
        WHERE id_number IS NOT NULL AND agent_id IS NOT NULL""",
    "age": """
        SELECT application_id,
               CAST(date_sub('year', application_date, DATE '2024-01-31') AS INTEGER) AS age
        FROM app""",
    "null_profile": "\nUNION ALL\n".join(
        f"""SELECT '{x}' AS "column", count(*) - count({x}) AS null_count FROM bronze_rep"""
        for x in (
            "repayment_id", "application_id", "customer_id", "due_date", "payment_date",
            "due_amount", "paid_amount", "payment_status", "days_past_due",
            "outstanding_balance", "_ingested_at",
        )
    ),
    "null_or_empty_profile": "\nUNION ALL\n".join(
        f"""SELECT '{x}' AS "column",
                   count(*) FILTER (WHERE {x} IS NULL OR {x} = '') AS blank_count
            FROM bronze_acc"""
        for x in ("account_id", "customer_id", "credit_limit")
    ),
    "duplicate_profile": """
        SELECT count(*) AS total_rows, count(DISTINCT transaction_id) AS distinct_keys,
               count(*) - count(DISTINCT transaction_id) AS duplicates FROM txn""",
    "row_counts": "\nUNION ALL\n".join(
        f"""SELECT '{x}' AS "table", count(*) AS "rows" FROM {x}"""
        for x in ("customer", "orders", "lineitem", "events")
    ),
    "profile_txn": _profile("bronze_txn", c.CARD_TXN, _columns("bronze_txn")),
    "profile_acc": _profile("bronze_acc", c.CARD_ACC, _columns("bronze_acc")),
    "profile_app": _profile("bronze_app", c.LOAN_APP, _columns("bronze_app")),
    "profile_rep": _profile("bronze_rep", c.LOAN_REP, _columns("bronze_rep")),
    "breakdown_status": _breakdown("txn", "status"),
    "breakdown_loan_type": _breakdown("app", "loan_type"),
    "breakdowns_card": _breakdowns("bronze_txn", c.CARD_TXN.breakdowns),
    "breakdowns_accounts": _breakdowns("bronze_acc", c.CARD_ACC.breakdowns),
    "breakdowns_loan": _breakdowns("bronze_app", c.LOAN_APP.breakdowns),
    "breakdowns_repayments": _breakdowns("bronze_rep", c.LOAN_REP.breakdowns),
    "breakdowns_txn_signals": _breakdowns(
        "txn_signals", ["is_international", "hour_of_day", "is_weekend"]
    ),
    "breakdowns_loan_signals": _breakdowns(
        "app_signals", ["is_income_realistic", "id_shared_flag", "address_shared_flag"]
    ),
    "breakdowns_repayment_signals": _breakdowns("rep_signals", ["payment_status", "is_missed"]),
    "ratio_distribution": f"""
        SELECT {approx('min(loan_to_income_ratio)')} AS min_value,
               {approx('max(loan_to_income_ratio)')} AS max_value,
               {approx('avg(loan_to_income_ratio)')} AS avg_value, count(*) AS "rows"
        FROM app_signals""",
    "hour_top5": _breakdown("txn_signals", "hour_of_day") + " LIMIT 5",
    "dedup_latest": """
        SELECT transaction_id, customer_id, transaction_ts, amount, part_id FROM txn_latest""",
    "dedup_any": "SELECT DISTINCT transaction_id, customer_id FROM txn",
    "is_international": "SELECT transaction_id, part_id, is_international FROM txn_signals",
    "time_parts": "SELECT transaction_id, part_id, hour_of_day, is_weekend FROM txn_signals",
    "amount_zscore": f"SELECT transaction_id, part_id, amount, {Z} FROM txn_signals",
    "zscore_top10": f"""
        SELECT transaction_id, customer_id, amount, {Z}
        FROM (SELECT * FROM txn_latest WHERE amount_zscore > 2
              ORDER BY amount_zscore DESC, transaction_id LIMIT 10)""",
    "velocity_features": f"""
        SELECT customer_id, txn_count_30d, {approx('avg_txn_amount_30d')} AS avg_txn_amount_30d,
               max_txn_amount_30d, declined_txn_count_7d, txn_count_1h FROM card_agg""",
    "late_night_ratio": "SELECT customer_id, late_night_txn_ratio FROM card_agg",
    "geo_channel_features": """
        SELECT customer_id, distinct_countries_30d, distinct_merchants_7d,
               international_txn_ratio, online_txn_ratio FROM card_agg""",
    "device_flag": "SELECT customer_id, unknown_device_flag FROM card_agg",
    "merchant_risk_ref": f"""
        SELECT customer_id, {approx('avg(amount_zscore)')} AS merchant_risk_score
        FROM txn_latest GROUP BY customer_id""",
    "merchant_risk_mcc": f"""
        SELECT customer_id, {approx('merchant_category_risk')} AS merchant_category_risk
        FROM mcc_risk""",
    "rolling_10min": _rolling("10 MINUTE", "txn_count_10min_rolling"),
    "rolling_1h": _rolling("1 HOUR", "txn_count_1h_rolling"),
    "peak_velocity": f"""
        SELECT * FROM
            (SELECT customer_id, max(n) AS txn_count_10min_rolling
             FROM ({_rolling('10 MINUTE', 'n')}) GROUP BY 1)
        JOIN (SELECT customer_id, max(n) AS txn_count_1h_rolling
              FROM ({_rolling('1 HOUR', 'n')}) GROUP BY 1) USING (customer_id)""",
    "rolling_velocity": f"""
        SELECT customer_id, account_id,
               coalesce(t.n, 0) AS txn_count_10min_rolling, coalesce(h.n, 0) AS txn_count_1h_rolling
        FROM acc
        LEFT JOIN (SELECT customer_id, max(n) AS n
                   FROM ({_rolling('10 MINUTE', 'n', 'txn')}) GROUP BY 1) t USING (customer_id)
        LEFT JOIN (SELECT customer_id, max(n) AS n
                   FROM ({_rolling('1 HOUR', 'n', 'txn')}) GROUP BY 1) h USING (customer_id)""",
    "rolling_30d_rows": f"""
        SELECT transaction_id, part_id, merchant_id, count(*) OVER w AS txn_count_30d_rolling,
               {approx('avg(amount) OVER w')} AS avg_txn_amount_30d_rolling,
               max(amount) OVER w AS max_txn_amount_30d_rolling,
               count(*) FILTER (WHERE status = 'declined') OVER (PARTITION BY customer_id
                   ORDER BY transaction_ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)
                   AS declined_txn_count_7d_rolling
        FROM txn WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_ts
            RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)""",
    "rolling_30d_events": f"""
        SELECT customer_id, transaction_ts, any_value(n) AS txn_count_30d_rolling,
               {approx('any_value(a)')} AS avg_txn_amount_30d_rolling,
               {approx('any_value(m)')} AS max_txn_amount_30d_rolling,
               any_value(d) AS declined_txn_count_7d_rolling, count(*) AS _rows
        FROM (SELECT customer_id, transaction_ts, count(*) OVER w AS n, avg(amount) OVER w AS a,
                     max(amount) OVER w AS m,
                     count(*) FILTER (WHERE status = 'declined') OVER (PARTITION BY customer_id
                         ORDER BY transaction_ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS d
              FROM evt WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_ts
                  RANGE BETWEEN INTERVAL 10 DAYS PRECEDING AND CURRENT ROW))
        GROUP BY customer_id, transaction_ts""",
    "moments_merged": f"""
        SELECT customer_id, count(*) AS txn_count_30d,
               {approx('avg(amount)')} AS avg_txn_amount_30d, max(amount) AS max_txn_amount_30d,
               count(*) FILTER (WHERE status = 'declined') AS declined_txn_count_7d,
               count(*) FILTER (WHERE hour_of_day BETWEEN 0 AND 1) AS txn_count_1h,
               {share('hour_of_day BETWEEN 0 AND 4', 'transaction_id')} AS late_night_txn_ratio,
               {share('is_international', 'transaction_id')} AS international_txn_ratio,
               {share("channel = 'online'", 'transaction_id')} AS online_txn_ratio,
               {approx('stddev_samp(amount)')} AS amount_deviation
        FROM txn_signals GROUP BY customer_id""",
    "zscore_from_state": f"""
        SELECT transaction_id, part_id, amount, {approx('amount_zscore')} AS amount_zscore
        FROM txn_signals WHERE transaction_ts >= TIMESTAMP '1998-06-01'""",
    "distinct_asof_daily": f"""
        SELECT customer_id, count(DISTINCT merchant_country) AS distinct_countries_30d_asof,
               count(DISTINCT merchant_name) FILTER (WHERE CAST(transaction_ts AS DATE)
                   > CAST({ASOF_TXN} AS DATE) - 7) AS distinct_merchants_7d_asof
        FROM txn WHERE CAST(transaction_ts AS DATE) BETWEEN CAST({ASOF_TXN} AS DATE) - 29
            AND CAST({ASOF_TXN} AS DATE)
        GROUP BY customer_id""",
    "daily_value_counts": """
        SELECT customer_id, CAST(transaction_ts AS DATE) AS day, kind,
               count(DISTINCT value) AS "values", count(*) AS n
        FROM (SELECT customer_id, transaction_ts, 'country' AS kind, merchant_country AS value FROM evt
              UNION ALL SELECT customer_id, transaction_ts, 'merchant', merchant_name FROM evt)
        GROUP BY customer_id, day, kind""",
    "asof_features": _asof("txn", ASOF_TXN),
    "asof_features_events": _asof("evt", ASOF),
    "card_features": _except_approx(
        "card_features", "avg_txn_amount_30d", "merchant_risk_score", "merchant_category_risk"
    ),
    "card_feature_table": f"""
        SELECT f.* REPLACE ({approx('f.avg_txn_amount_30d')} AS avg_txn_amount_30d,
                   {approx('f.merchant_risk_score')} AS merchant_risk_score,
                   {approx('coalesce(f.merchant_category_risk, 0)')} AS merchant_category_risk),
               coalesce(t.n, 0) AS txn_count_10min_rolling,
               coalesce(h.n, 0) AS txn_count_1h_rolling,
               coalesce(txn_count_30d_asof, 0) AS txn_count_30d_asof,
               coalesce(avg_txn_amount_30d_asof, 0) AS avg_txn_amount_30d_asof,
               coalesce(max_txn_amount_30d_asof, 0) AS max_txn_amount_30d_asof,
               coalesce(distinct_countries_30d_asof, 0) AS distinct_countries_30d_asof,
               coalesce(declined_txn_count_7d_asof, 0) AS declined_txn_count_7d_asof,
               coalesce(distinct_merchants_7d_asof, 0) AS distinct_merchants_7d_asof
        FROM card_features f
        LEFT JOIN (SELECT customer_id, max(n) AS n
                   FROM ({_rolling('10 MINUTE', 'n', 'txn')}) GROUP BY 1) t USING (customer_id)
        LEFT JOIN (SELECT customer_id, max(n) AS n
                   FROM ({_rolling('1 HOUR', 'n', 'txn')}) GROUP BY 1) h USING (customer_id)
        LEFT JOIN ({_asof('txn', ASOF_TXN)}) a USING (customer_id)""",
    "customer_risk_masked": """
        SELECT customer_id, '****' || right(CAST(customer_id * 1000003 AS VARCHAR), 4) AS id_number,
               overall_risk_tier FROM risk""",
    "card_score": """
        SELECT customer_id, account_id, card_fraud_score, card_risk_tier, feature_updated_at
        FROM card_scored""",
    "risk_tiers": """
        SELECT score, CASE WHEN score >= 0.7 THEN 'high' WHEN score >= 0.4 THEN 'medium'
                           ELSE 'low' END AS tier, count(*) AS n
        FROM (SELECT nullif(round(l_discount * 10, 1), 0.3) AS score FROM lineitem)
        GROUP BY 1, 2""",
    "risk_tier_breakdown": _breakdown("card_scored", "card_risk_tier"),
    "score_distribution": f"""
        SELECT min(card_fraud_score) AS min_value, max(card_fraud_score) AS max_value,
               {approx('avg(card_fraud_score)')} AS avg_value, count(*) AS "rows"
        FROM card_scored""",
    "top10_risk": """
        SELECT customer_id, card_fraud_score, card_risk_tier, distinct_countries_30d,
               unknown_device_flag, declined_txn_count_7d, international_txn_ratio
        FROM card_scored ORDER BY card_fraud_score DESC, customer_id LIMIT 10""",
    "loan_to_income": "SELECT application_id, loan_to_income_ratio FROM app_signals",
    "income_realistic": "SELECT application_id, is_income_realistic FROM app_signals",
    "applications_per_customer": """
        SELECT application_id, customer_id, applications_last_30d FROM app_signals""",
    "applications_30d_branches": """
        SELECT b.customer_id, b.application_date, count(*) AS applications_30d_rolling,
               count(DISTINCT a.branch_id) AS distinct_branches_30d_rolling,
               count(*) FILTER (WHERE a.application_date = b.application_date)
                   AS applications_on_date
        FROM (SELECT DISTINCT customer_id, application_date FROM app) b
        JOIN app a ON a.customer_id = b.customer_id
            AND a.application_date BETWEEN b.application_date - 30 AND b.application_date
        GROUP BY 1, 2""",
    "applications_30d_rows": """
        SELECT b.application_id, count(*) AS applications_30d_rolling,
               count(DISTINCT a.branch_id) AS distinct_branches_30d_rolling
        FROM app b JOIN app a ON a.customer_id = b.customer_id
            AND a.application_date BETWEEN b.application_date - 30 AND b.application_date
        GROUP BY 1""",
    "shared_id_flag": "SELECT application_id, id_number, id_shared_flag FROM app_signals",
    "shared_address_flag": "SELECT application_id, address_shared_flag FROM app_signals",
    "agent_approval_rate": "SELECT application_id, agent_id, agent_approval_rate FROM app_signals",
    "payment_flags": "SELECT repayment_id, part_id, is_missed, is_partial, is_late FROM rep_signals",
    "payment_shortfall": "SELECT repayment_id, part_id, payment_shortfall FROM rep_signals",
    "cumulative_missed": """
        SELECT repayment_id, part_id, customer_id, due_date, consecutive_missed_count
        FROM rep_signals""",
    "missed_streak": "SELECT * FROM streaks",
    "longest_streak": """
        SELECT customer_id, max(missed_streak) AS longest_missed_streak
        FROM streaks GROUP BY 1""",
    "application_features": "SELECT * FROM app_features",
    "repayment_features": _except_approx(
        "rep_features", "avg_payment_ratio", "avg_days_past_due", "total_outstanding_balance"
    ),
    "loan_features": _except_approx(
        "loan_features", "avg_payment_ratio", "avg_days_past_due", "total_outstanding_balance"
    ),
    "loan_score": """
        SELECT customer_id, application_id, loan_fraud_score, loan_risk_tier FROM loan_scored""",
    "silver_card_txn": f"""
        SELECT * REPLACE ({Z}) FROM ({_silver_txn('bronze_txn')}) QUALIFY {LATEST_TXN}""",
    "silver_card_txn_dedup_first": f"""
        SELECT transaction_id, customer_id, amount, {Z}
        FROM ({_silver_txn(f'(SELECT * FROM bronze_txn QUALIFY {LATEST_TXN})')})""",
    "silver_card_acc": """
        SELECT account_id, customer_id, 'visa' AS card_type, 'gold' AS card_tier,
               CASE WHEN account_open_date = '2020-12-31' THEN DATE '2020-12-31' END
                   AS account_open_date,
               lower(trim(account_status)) AS account_status,
               TRY_CAST(credit_limit AS DOUBLE) AS credit_limit,
               upper(trim(billing_country)) AS billing_country, billing_city, _ingested_at
        FROM silver_acc""",
    # The raw text holds the same values as `app`, but for the limits of realistic income.
    "silver_loan_app": """
        SELECT CAST(application_id AS VARCHAR) AS application_id,
               CAST(customer_id AS VARCHAR) AS customer_id, application_date,
               lower(loan_type) AS loan_type, loan_amount_requested,
               CASE WHEN application_id % 7 <> 0 THEN 12 END AS loan_term_months,
               stated_income, stated_employment_status, stated_years_employed,
               2 AS num_dependants, CAST(id_number AS VARCHAR) AS id_number,
               make_date(customer_id % 50 + 1940, 3, 5) AS date_of_birth,
               CAST(date_sub('year', make_date(customer_id % 50 + 1940, 3, 5), application_date)
                   AS INTEGER) AS age, applications_30d_rolling, distinct_branches_30d_rolling,
               address,
               CAST(agent_id AS VARCHAR) AS agent_id, CAST(branch_id AS VARCHAR) AS branch_id,
               'online' AS application_channel, application_status, 0 AS is_fraud_label,
               loan_to_income_ratio, true AS is_income_realistic, applications_last_30d,
               id_shared_flag, address_shared_flag, agent_approval_rate
        FROM app_signals JOIN (
            SELECT b.application_id, count(*) AS applications_30d_rolling,
                   count(DISTINCT a.branch_id) AS distinct_branches_30d_rolling
            FROM app b JOIN app a ON a.customer_id = b.customer_id
                AND a.application_date BETWEEN b.application_date - 30 AND b.application_date
            GROUP BY 1) USING (application_id)""",
    "silver_loan_rep": f"""
        SELECT * EXCLUDE (paid_so_far), CAST(sum(CAST(is_missed AS INTEGER)) OVER (
                   PARTITION BY customer_id, paid_so_far
                   ORDER BY due_date NULLS FIRST, repayment_id) AS BIGINT) AS missed_streak
        FROM (SELECT *, sum(CAST(NOT is_missed AS INTEGER)) OVER (
                  PARTITION BY customer_id ORDER BY due_date NULLS FIRST, repayment_id)
                  AS paid_so_far FROM (
        SELECT repayment_id, application_id, customer_id, CAST(due_date AS DATE) AS due_date,
               CAST(payment_date AS DATE) AS payment_date,
               CAST(due_amount AS DOUBLE) AS due_amount,
               {approx('CAST(paid_amount AS DOUBLE)')} AS paid_amount,
               lower(trim(payment_status)) AS payment_status,
               CAST(days_past_due AS INTEGER) AS days_past_due,
               {approx('CAST(outstanding_balance AS DOUBLE)')} AS outstanding_balance,
               _ingested_at,
               {half_up('CAST(due_amount AS DOUBLE) - CAST(paid_amount AS DOUBLE)', 2)}
                   AS payment_shortfall,
               payment_status = 'Missed ' AS is_missed, payment_status = 'Partial ' AS is_partial,
               payment_status = 'Late ' AS is_late,
               CAST(sum(CAST(payment_status = 'Missed ' AS INTEGER)) OVER (
                   PARTITION BY customer_id ORDER BY due_date NULLS FIRST) AS BIGINT)
                   AS consecutive_missed_count
        FROM bronze_rep
        QUALIFY row_number() OVER (PARTITION BY repayment_id ORDER BY _ingested_at DESC) = 1))""",
    "card_scores": "SELECT * FROM card_scores",
    "loan_scores": "SELECT * FROM loan_scores",
    "fraud_alerts": "SELECT * FROM alerts",
    "alerts_by_type": _breakdown("alerts", "alert_type"),
    "alerts_by_tier": _breakdown("alerts", "risk_tier"),
    "alerts_by_signal": _breakdown("alerts", "top_signal"),
    "top10_alerts": """
        SELECT customer_id, alert_type, fraud_score, risk_tier, top_signal
        FROM alerts ORDER BY fraud_score DESC, customer_id, alert_type LIMIT 10""",
    "customer_risk": "SELECT * FROM risk",
    "customer_risk_activity": """
        SELECT risk.*, coalesce(total_alerts, 0) AS total_alerts,
               coalesce(open_alerts, 0) AS open_alerts, last_alert_date,
               last_card_transaction, last_loan_application
        FROM risk
        LEFT JOIN (SELECT customer_id, count(*) AS total_alerts,
                          count(*) FILTER (WHERE alert_status = 'open') AS open_alerts,
                          max(created_at) AS last_alert_date
                   FROM alerts GROUP BY 1) USING (customer_id)
        LEFT JOIN (SELECT customer_id, max(transaction_ts) AS last_card_transaction
                   FROM txn GROUP BY 1) USING (customer_id)
        LEFT JOIN (SELECT customer_id, max(application_date) AS last_loan_application
                   FROM app GROUP BY 1) USING (customer_id)""",
    "kpi_summary": f"""
        SELECT *, {half_up('high_risk_customers / CAST(total_customers AS DOUBLE) * 100', 2)}
                   AS high_risk_pct
        FROM (SELECT (SELECT count(*) FROM risk) AS total_customers,
            (SELECT count(*) FROM risk WHERE overall_risk_tier = 'high') AS high_risk_customers,
            (SELECT count(*) FROM risk WHERE flagged_in_both) AS flagged_in_both,
            (SELECT count(*) FROM alerts) AS total_alerts,
            (SELECT count(*) FROM alerts WHERE alert_status = 'open') AS open_alerts,
            (SELECT count(*) FROM alerts WHERE alert_source = 'card') AS card_alerts,
            (SELECT count(*) FROM alerts WHERE alert_source = 'loan') AS loan_alerts)""",
    "export_customer_risk": """
        SELECT customer_id, full_name, country, city, age, account_status, employment_status,
               stated_income, card_fraud_score, loan_fraud_score, overall_risk_score,
               overall_risk_tier, card_risk_tier, loan_risk_tier, flagged_in_card,
               flagged_in_loan, flagged_in_both, risk_updated_at FROM risk""",
    "export_alerts": """
        SELECT alert_id, customer_id, alert_type, alert_source, reference_id, fraud_score,
               risk_tier, top_signal, alert_status, created_at FROM alerts""",
    "export_card": """
        SELECT customer_id, card_fraud_score, card_risk_tier, top_fraud_signal, velocity_flag,
               geo_anomaly_flag, device_anomaly_flag, declined_txn_flag, score_updated_at
        FROM card_scores""",
    "export_loan": """
        SELECT customer_id, loan_fraud_score, loan_risk_tier, top_fraud_signal,
               income_fraud_flag, identity_fraud_flag, loan_stacking_flag, agent_risk_flag,
               repayment_risk_flag, score_updated_at FROM loan_scores""",
    "run_log_recent": f"SELECT * FROM log WHERE pipeline = 'loan' AND {RECENT.format(3)}",
    "run_log_summary": f"""
        SELECT level, count(*) AS "count" FROM log
        WHERE pipeline = 'card' AND {RECENT.format(24)} GROUP BY level ORDER BY level""",
    "run_log_errors": f"""
        SELECT count(*) AS errors FROM log
        WHERE pipeline = 'card' AND level = 'ERROR' AND {RECENT.format(24)}""",
    "run_log_checks": f"""
        SELECT 'card' AS pipeline, CASE status WHEN 'OK' THEN 'INFO' ELSE status END AS level,
               "check" || CASE WHEN "column" <> '' THEN ' in ' || "column" ELSE '' END
                   || ': ' || value AS message,
               {ASOF} AS log_timestamp
        FROM ({_profile('bronze_acc', c.CARD_ACC, _columns('bronze_acc'))})""",
    # --- SQL, streams, files and tables ---
    "sql_customer_risk": "SELECT * EXCLUDE (risk_updated_at) FROM risk",
    "sql_card_score": """
        SELECT customer_id, card_fraud_score, top_fraud_signal, card_risk_tier FROM card_scores""",
    "sql_log_summary": f"""
        SELECT level, count(*) AS "count" FROM log
        WHERE pipeline = 'card' AND {RECENT.format(24)} GROUP BY level""",
    "sql_log_errors": f"""
        SELECT count(*) AS errors FROM log
        WHERE pipeline = 'card' AND level = 'ERROR' AND {RECENT.format(24)}""",
    "streaming_velocity": """
        SELECT customer_id, s AS window_start, s + INTERVAL 1 HOUR AS window_end,
               count(*) AS txn_count,
               count(*) FILTER (WHERE status = 'declined') AS declined_count
        FROM (SELECT *, time_bucket(INTERVAL 10 MINUTES, transaction_ts)
                        - to_minutes(CAST(10 * i AS INTEGER)) AS s
              FROM evt, range(0, 6) r(i))
        -- a window is final once the watermark, an hour behind the last event, has passed it
        WHERE s + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
        GROUP BY customer_id, s""",
    "csv_round_trip": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               ' "' || c_name || '", in' || chr(10) || c_mktsegment || ' ' AS note,
               CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment
        FROM customer""",
    "malformed_rows": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_custkey % 10 IN (3, 4) AS malformed,
               CASE c_custkey % 10 WHEN 3 THEN c_custkey || ',' || c_name
                   WHEN 4 THEN c_custkey || ',' || c_name || ',' || c_mktsegment || ',more'
                   END AS line
        FROM customer""",
    "ingest_accounts": """
        SELECT * EXCLUDE (_ingested_at) REPLACE (nullif(credit_limit, '') AS credit_limit),
               'card_accounts.csv' AS _source_file
        FROM bronze_acc""",
    "ingest_log": """
        SELECT 'card_acc_ingest' AS pipeline, level, message
        FROM (SELECT 'INFO' AS level, 'started' AS message UNION ALL SELECT 'INFO', 'finished'
              UNION ALL SELECT 'INFO', count(*) || ' rows' FROM bronze_acc
              UNION ALL SELECT 'WARNING', 'null_keys: ' || count(*) FROM bronze_acc
                  WHERE account_id = '5' HAVING count(*) > 0)""",
    "load_days": """
        SELECT account_id, TRY_CAST(nullif(credit_limit, '') AS DOUBLE) AS credit_limit,
               lower(trim(account_status)) AS account_status,
               upper(trim(billing_country)) AS billing_country,
               CASE _ingested_at WHEN 1 THEN DATE '2024-05-01' ELSE DATE '2024-05-02' END
                   AS _load_date
        FROM silver_acc""",
    "table_append": """
        SELECT * FROM acc WHERE account_id % 2 = 0
        UNION ALL SELECT * FROM acc WHERE account_id % 3 = 0""",
    "export_csv_file": """
        SELECT account_status, count(*) AS accounts, 1 AS files FROM acc GROUP BY account_status""",
}
_KPIS = (
    "total_customers", "high_risk_customers", "flagged_in_both", "total_alerts", "open_alerts",
    "card_alerts", "loan_alerts", "high_risk_pct",
)
# Queries that start from another query.
QUERIES |= {
    "export_kpis": f"""
        SELECT {', '.join(f'CAST({k} AS DOUBLE) AS {k}' for k in _KPIS)}
        FROM ({QUERIES['kpi_summary']})""",
    "run_log_append": f"""
        SELECT runs.pipeline, level, message
        FROM (SELECT level, message FROM ({QUERIES['run_log_checks']})
              UNION ALL SELECT 'INFO', count(*) || ' customers' FROM customer),
             (VALUES ('run1'), ('run2')) runs(pipeline)""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in QUERIES.items()}
