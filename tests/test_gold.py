"""Scores, alerts, customer view, KPIs, exports, checks and the run log."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskflow.config import CARD_TXN, Feed
from riskflow.operators import quality, report, runlog, scores
from riskflow.operators.alerts import fraud_alerts
from riskflow.operators.customer_risk import customer_risk, with_activity
from riskflow.sources.export import write_csv

AT = datetime(2024, 6, 1, 12)


def at():
    return F.lit(AT)


@pytest.fixture
def card(spark):
    features = spark.createDataFrame(
        [
            ("a", "acc-a", 0.8, "high", 3, True, 0, 0.6, 0.1, 0.0, 5),
            ("b", "acc-b", 0.4, "medium", 0, False, 4, 0.0, 0.4, 0.0, 0),
            ("c", "acc-c", 0.1, "low", 0, True, 0, 0.0, 0.0, 0.0, 0),
        ],
        "customer_id string, account_id string, card_fraud_score double, card_risk_tier string, "
        "distinct_countries_30d int, unknown_device_flag boolean, declined_txn_count_7d int, "
        "international_txn_ratio double, late_night_txn_ratio double, merchant_risk_score double, "
        "txn_count_1h int",
    )
    return scores.card_scores(features, as_of=at())


@pytest.fixture
def loan(spark):
    features = spark.createDataFrame(
        [
            ("a", "app-a", 0.9, "high", 6.0, True, False, 4, 3, 0.2, False, True, 3),
            ("b", "app-b", 0.5, "medium", 1.0, False, True, 1, 0, 0.6, True, True, 0),
            ("d", "app-d", 0.7, "high", 0.0, False, False, 1, 1, 0.1, False, False, 1),
        ],
        "customer_id string, application_id string, loan_fraud_score double, loan_risk_tier string, "
        "loan_to_income_ratio double, id_shared_flag boolean, address_shared_flag boolean, "
        "applications_last_30d int, missed_payment_count int, partial_payment_ratio double, "
        "agent_risk_flag boolean, income_realistic_flag boolean, consecutive_missed_count int",
    )
    return scores.loan_scores(features, as_of=at())


def test_scores(card, loan):
    assert rows(card) == [
        ("a", "acc-a", 0.8, "high", "multi_country", True, True, True, False, AT),
        ("b", "acc-b", 0.4, "medium", "repeated_declines", False, False, False, True, AT),
        ("c", "acc-c", 0.1, "low", "unknown_device", False, False, True, False, AT),
    ]
    assert rows(loan) == [
        ("a", "app-a", 0.9, "high", "loan_to_income", True, True, True, False, True, AT),
        ("b", "app-b", 0.5, "medium", "shared_address", False, False, False, True, True, AT),
        ("d", "app-d", 0.7, "high", "none", True, False, False, False, False, AT),
    ]


def test_alerts(card, loan):
    got = fraud_alerts(card, loan, at())
    assert rows(got, "customer_id", "alert_type", "alert_source", "reference_id", "top_signal") == [
        ("a", "card_takeover", "card", "acc-a", "unknown_device"),
        ("a", "card_transaction", "card", "acc-a", "multi_country"),
        ("a", "loan_application", "loan", "app-a", "loan_to_income"),
        ("a", "loan_repayment", "loan", "app-a", "repayment_risk"),
        ("b", "card_transaction", "card", "acc-b", "repeated_declines"),
        ("b", "loan_application", "loan", "app-b", "shared_address"),
        ("b", "loan_repayment", "loan", "app-b", "repayment_risk"),
        ("d", "loan_application", "loan", "app-d", "none"),
    ]
    ids = [r.alert_id for r in got.collect()]
    assert len(set(ids)) == len(ids) == 8 and all(len(i) == 16 and i == i.upper() for i in ids)
    assert sorted(ids) == sorted(r.alert_id for r in fraud_alerts(card, loan, at()).collect())
    assert got.filter("resolved_at IS NULL AND assigned_to IS NULL AND alert_status = 'open'").count() == 8
    assert dict(got.dtypes)["resolved_at"] == "timestamp"


@pytest.fixture
def risk(spark, card, loan):
    customers = spark.createDataFrame(
        [(c, c.upper(), "ZA", "CT", 30, "active", "employed", 1.0) for c in "abcde"],
        "customer_id string, full_name string, country string, city string, age int, "
        "account_status string, employment_status string, stated_income double",
    )
    return customer_risk(customers, card, loan, at())


def test_customer_risk(risk):
    columns = ("customer_id", "overall_risk_score", "overall_risk_tier", "flagged_in_card", "flagged_in_loan", "flagged_in_both")
    assert rows(risk, *columns) == [
        ("a", 0.9, "high", True, True, True),
        ("b", 0.5, "medium", False, False, False),
        ("c", 0.1, "low", False, None, False),
        ("d", 0.7, "high", None, True, None),
        ("e", 0.0, "low", None, None, None),
    ]


def test_activity(spark, risk, card, loan):
    txn = spark.createDataFrame([("a", AT), ("a", AT - timedelta(days=1))], "customer_id string, transaction_ts timestamp")
    app = spark.createDataFrame([("b", AT.date())], "customer_id string, application_date date")
    alerts = fraud_alerts(card, loan, at())
    closed = alerts.withColumn("alert_status", F.when(F.col("alert_type") == "card_takeover", "confirmed_fraud").otherwise(F.col("alert_status")))
    got = with_activity(risk, closed, txn, app)
    columns = ("customer_id", "total_alerts", "open_alerts", "last_alert_date", "last_card_transaction", "last_loan_application")
    assert rows(got, *columns) == [
        ("a", 4, 3, AT, AT, None),
        ("b", 3, 3, AT, None, AT.date()),
        ("c", 0, 0, None, None, None),
        ("d", 1, 1, AT, None, None),
        ("e", 0, 0, None, None, None),
    ]


def test_kpis_and_exports(spark, tmp_path, risk, card, loan):
    alerts = fraud_alerts(card, loan, at())
    kpis = report.kpi_summary(risk, alerts)
    assert kpis.first().asDict() == {
        "total_customers": 5, "high_risk_customers": 2, "flagged_in_both": 1, "total_alerts": 8,
        "open_alerts": 8, "card_alerts": 3, "loan_alerts": 5, "high_risk_pct": 40.0,
    }
    assert report.kpi_summary(risk.limit(0), alerts.limit(0)).first().high_risk_pct is None
    view = report.export_view(risk.withColumn("card_fraud_score", F.lit(0.123456)), report.CUSTOMER_RISK)
    assert view.columns == report.CUSTOMER_RISK and view.first().card_fraud_score == 0.1235
    for name, df, columns in (("a", alerts, report.FRAUD_ALERTS), ("c", card, report.CARD_SCORES), ("l", loan, report.LOAN_SCORES)):
        out = tmp_path / name
        write_csv(report.export_view(df, columns), str(out), single_file=True)
        assert len(list(out.glob("*.csv"))) == 1
        back = spark.read.option("header", True).csv(str(out))
        assert back.columns == columns and back.count() == df.count()
    many = spark.range(0, 100, 1, 4)
    for single, parts in ((True, 1), (False, 4)):
        write_csv(many, str(tmp_path / "many"), single_file=single)
        assert len(list((tmp_path / "many").glob("*.csv"))) == parts


FEED = Feed("f", "f.csv", "f", "k", ("k", "v", "gone"), ("k", "v"), ("v",))


def test_profile(spark):
    df = spark.createDataFrame([("a", "1"), ("a", ""), (None, None), (None, "1")], "k string, v string")
    got = {(r.check, r.column): (r.value, r.status) for r in quality.profile(df, FEED).collect()}
    assert got == {
        ("rows", ""): (4, "OK"),
        ("duplicate_keys", "k"): (2, "WARNING"),
        ("null_keys", "k"): (2, "WARNING"),
        ("blanks", "k"): (2, "WARNING"),
        ("blanks", "v"): (2, "WARNING"),
        ("missing_column", "k"): (0, "OK"),
        ("missing_column", "v"): (0, "OK"),
        ("missing_column", "gone"): (1, "ERROR"),
        ("nulls", "k"): (2, "OK"),
        ("nulls", "v"): (1, "OK"),
    }
    values = quality.report(df, FEED).filter("check = 'values'")
    assert rows(values, "column", "detail", "value") == [("v", None, 1), ("v", "", 1), ("v", "1", 2)]
    assert rows(quality.null_counts(df)) == [("k", 2), ("v", 1)]
    assert rows(quality.blank_counts(df, ["v"])) == [("v", 2)]
    assert rows(quality.duplicate_count(df, "k")) == [(4, 2, 2)]
    empty = quality.profile(df.limit(0), FEED).filter("check = 'rows'").first()
    assert (empty.value, empty.status) == (0, "ERROR")
    assert rows(quality.duplicate_count(df.limit(0), "k")) == [(0, 0, 0)]


def test_gates(spark):
    df = spark.createDataFrame([("a",)], "k string")
    assert quality.require_not_empty(df, "t") is df
    with pytest.raises(ValueError, match="t has no rows"):
        quality.require_not_empty(df.limit(0), "t")
    assert quality.require_columns(df, ["k"], "t") is df
    with pytest.raises(ValueError, match="amount"):
        quality.require_columns(df, CARD_TXN.required, "t")


def test_summaries(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 3.0), ("x", None), (None, 2.0)], "k string, v double")
    assert [tuple(r) for r in quality.breakdown(df, "k").collect()] == [("x", 2), (None, 1), ("y", 1)]
    assert rows(quality.breakdowns(df, ["k", "v"])) == [
        ("k", None, 1), ("k", "x", 2), ("k", "y", 1),
        ("v", None, 1), ("v", "1.0", 1), ("v", "2.0", 1), ("v", "3.0", 1),
    ]
    assert tuple(quality.distribution(df, "v").first()) == (1.0, 3.0, 2.0, 4)
    assert [r.k for r in quality.top(df, "v", 2, ["k"], ["k"]).collect()] == ["y", None]
    z = spark.createDataFrame([(i, "c", 1.0, z) for i, z in ((1, 2.0), (2, 2.5), (3, 9.0), (4, 2.5))], "transaction_id int, customer_id string, amount double, amount_zscore double")
    assert [r.transaction_id for r in quality.outliers(z).collect()] == [3, 2, 4]
    assert rows(quality.row_counts({"a": df, "b": z})) == [("a", 4), ("b", 4)]


def test_run_log(spark, tmp_path):
    table = str(tmp_path / "log")
    log = runlog.RunLog("card")
    log.info("started")
    log.warning("it's odd")
    log.append(spark, table)
    log.add("ERROR", "old", datetime.now(timezone.utc) - timedelta(hours=2))
    log.append(spark, table)
    with pytest.raises(ValueError):
        log.add("FATAL", "no such level")
    df = spark.read.parquet(table)
    assert [tuple(r) for r in runlog.summary(df, "card").collect()] == [("INFO", 1), ("WARNING", 1)]
    assert runlog.recent(df, "loan").count() == 0
    runlog.gate(df, "card")
    log.error("broken")
    log.append(spark, table)
    with pytest.raises(RuntimeError, match="1 error"):
        runlog.gate(spark.read.parquet(table), "card")
    with pytest.raises(RuntimeError, match="2 error"):
        runlog.gate(spark.read.parquet(table), "card", hours=3)


def test_recent_log_ends_at_its_time(spark):
    """Of entries around 12:00, those after it don't count for a look back from 12:00."""
    noon = datetime(2024, 1, 1, 12)
    entries = [("card", "ERROR", str(m), noon + timedelta(minutes=m)) for m in (-61, -60, 0, 1, 600)]
    df = spark.createDataFrame(entries, runlog.SCHEMA)
    as_of = F.lit("2024-01-01 12:00:00").cast("timestamp")
    assert rows(runlog.recent(df, "card", 1, as_of), "message") == [("-60",), ("0",)]
    assert runlog.error_count(df, "card", 1, as_of).first()["errors"] == 2
