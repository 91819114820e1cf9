"""SQL functions and views against the DataFrame operators; streams against batches."""

from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from riskflow import config as c
from riskflow.functions.scoring import risk_tier, top_signal, weighted_score
from riskflow.operators import runlog
from riskflow.operators.customer_risk import customer_risk
from riskflow.plans import sql
from riskflow.streaming import velocity


def test_score_functions(spark):
    sql.register_functions(spark)
    values = [(n, b, n, n / 4, n / 8, n / 2.0) for n in range(6) for b in (True, False, None)] + [(None,) * 6]
    names = [n for n, _ in sql.CARD_ARGUMENTS]
    card = spark.createDataFrame(values, ", ".join(f"{n} {t}" for n, t in sql.CARD_ARGUMENTS))
    rules = c.card_rules()
    want = card.select("*", weighted_score(rules).alias("s"), top_signal(rules).alias("g"), risk_tier(weighted_score(rules)).alias("t"))
    card.createOrReplaceTempView("card_rows")
    listed = ", ".join(names)
    got = spark.sql(f"SELECT *, card_fraud_score({listed}) s, card_top_signal({listed}) g, risk_tier(card_fraud_score({listed})) t FROM card_rows")
    assert rows(got) == rows(want) and len({r.t for r in got.collect()}) == 3
    loan = spark.createDataFrame(
        [(x, b, n, n, b, not b, x / 9) for x in (0.0, 5.0, 6.0) for n in (1, 3, 4) for b in (True, False)],
        ", ".join(f"{n} {t}" for n, t in sql.LOAN_ARGUMENTS),
    )
    rules = c.loan_rules()
    want = loan.select("*", weighted_score(rules).alias("s"), top_signal(rules).alias("g"))
    loan.createOrReplaceTempView("loan_rows")
    listed = ", ".join(n for n, _ in sql.LOAN_ARGUMENTS)
    got = spark.sql(f"SELECT *, loan_fraud_score({listed}) s, loan_top_signal({listed}) g FROM loan_rows")
    assert rows(got) == rows(want)
    assert spark.sql("SELECT overall_risk_score(NULL, 0.5), overall_risk_score(NULL, NULL), risk_tier(NULL)").first() == (0.5, 0.0, "low")


def test_risk_view_and_log(spark):
    customers = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "customer_id string, full_name string")
    card = spark.createDataFrame([("a", 0.9, "high"), ("b", 0.4, "medium")], "customer_id string, card_fraud_score double, card_risk_tier string")
    loan = spark.createDataFrame([("a", 0.8, "high")], "customer_id string, loan_fraud_score double, loan_risk_tier string")
    at = datetime(2024, 5, 1, 12)
    entries = [("card", level, "m", at - timedelta(minutes=m)) for level, m in (("INFO", 0), ("ERROR", 10), ("INFO", 60), ("ERROR", 61), ("INFO", -1))]
    log = spark.createDataFrame([*entries, ("loan", "ERROR", "m", at)], "pipeline string, level string, message string, log_timestamp timestamp")
    sql.register(customers, card, loan, log)
    want = customer_risk(customers, card, loan).drop("risk_updated_at")
    got = spark.table("customer_risk").select(want.columns)
    assert rows(got) == rows(want)
    when = F.lit(at)
    call = "('card', 1, TIMESTAMP '2024-05-01 12:00:00')"
    assert rows(spark.sql(f"SELECT * FROM log_recent{call}")) == rows(runlog.recent(log, "card", 1, when))
    assert rows(spark.sql(f"SELECT * FROM log_summary{call}")) == rows(runlog.summary(log, "card", 1, when)) == [("ERROR", 1), ("INFO", 2)]
    assert spark.sql(f"SELECT * FROM log_errors{call}").first()[0] == 1


def test_final_windows_equal_the_batch(spark, tmp_path):
    """Files arrive one by one; what comes behind the watermark is counted, not added."""
    start = datetime(2024, 1, 1)
    schema = "customer_id string, transaction_ts timestamp, status string"
    folder = tmp_path / "in"
    sets = [[("a" if i % 3 else "b", start + timedelta(minutes=7 * i + 60 * k * 4), "declined" if i % 5 == 0 else "approved") for i in range(30)] for k in range(4)]
    late = [("a", start + timedelta(minutes=3), "declined")]
    # Two empty micro-batches' worth of later rows close the windows of the others.
    end = [("z", start + timedelta(days=2 + k), None) for k in range(2)]
    for k, part in enumerate([*sets, late, end[:1], end[1:]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder))
        newest = max(folder.glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
        newest.rename(folder / f"{k}.parquet")
    txn = velocity.read_transactions(spark, str(folder), schema, files=1)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = velocity.write_counts(velocity.windowed_counts(txn), out, checkpoint)
    assert query.awaitTermination(120)
    assert velocity.late_rows(query) == 6  # one row in six windows
    got = spark.read.parquet(out).filter("customer_id <> 'z'")
    batch = spark.createDataFrame([x for part in sets for x in part], schema)
    assert rows(got) == rows(velocity.windowed_counts(batch))
    # A restart reads nothing twice.
    again = velocity.write_counts(velocity.windowed_counts(txn), out, checkpoint)
    assert again.awaitTermination(120)
    assert rows(spark.read.parquet(out).filter("customer_id <> 'z'")) == rows(got)
