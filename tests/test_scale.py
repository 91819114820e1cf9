"""What large tables need: bounded tasks, feeds that are read once, narrow shuffles."""

import re
from datetime import datetime

import pytest

from riskflow.checks import queries as q
from riskflow.checks import views as v
from riskflow.operators import features, loans, skew
from riskflow.operators import transactions as t
from riskflow.plans import silver

DAY = datetime(1995, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    made = {
        "customer": [(c, f"C{c}", c % 3, 10.0 * c, "BUILDING") for c in range(1, 6)],
        "supplier": [(s, f"S{s}", s % 3, 1.0) for s in range(1, 4)],
        "orders": [(o, o % 5 + 1, "F", 100.0, DAY, "1-URGENT") for o in range(40)],
        "lineitem": [
            (o, o + n, n % 3 + 1, n, 1.0, 10.0 + o, 0.05, 0.02, "R" if o % 2 else "N", "O", DAY)
            for o in range(40) for n in range(3)
        ],
    }
    for name, data in made.items():
        spark.createDataFrame(data, v.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("feed", [v.txn, v.rep])
def test_tasks_of_a_feed_grow_with_its_rows(spark, tables, monkeypatch, feed):
    monkeypatch.setattr(v, "LINES_PER_TASK", 10)
    df = feed(spark, tables)
    assert df.count() == 120
    assert df.rdd.getNumPartitions() == 12


def test_card_features_join_the_feed_once(spark, tables):
    features_, table = q.card_features(spark, tables), q.card_feature_table(spark, tables)
    assert features_.count() == table.count() == 5
    assert "lineitem.parquet" not in plan(features_)  # it has been joined and stored
    # The statistics alone read it again. The plan names one aggregate twice, for hot customers
    # and for others, and so all features for hot and other customers of the accounts.
    assert plan(table).count("lineitem.parquet") <= 4


def test_counts_of_the_feature_table_are_of_rows_joined_to_accounts(spark, tables, tmp_path):
    for name in ("supplier", "orders", "lineitem"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    once = spark.read.parquet(f"{tables}/customer.parquet")
    once.unionAll(once.filter("c_custkey = 1")).write.parquet(f"{tmp_path}/customer.parquet")
    df = q.card_feature_table(spark, str(tmp_path))
    found = {r.customer_id: r for r in df.collect()}
    assert found[1].txn_count_30d == 48 and found[2].txn_count_30d == 24
    assert found[1].txn_count_1h_rolling == 2 * q.card_feature_table(spark, tables).filter(
        "customer_id = 1"
    ).first().txn_count_1h_rolling


def test_rolling_counts_shuffle_no_row_per_window(spark, tables):
    text = plan(t.peak_rolling_counts(v.txn(spark, tables), features.PEAK_WINDOWS))
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert any("_slice" in k for k in keys) and not any("_window" in k for k in keys)


def test_few_values_are_attached_without_a_shuffle_of_the_rows(spark, tables):
    app = v.app(spark, tables)
    shared = loans.with_agent_approval_rate(loans.with_shared_flag(app, "address", "shared"))
    assert shared.count() == 40
    assert "Exchange hashpartitioning" not in plan(shared)


def test_runs_and_what_is_carried_hold_the_customer_once(spark, tables):
    out = loans.missed_streak(v.rep(spark, tables).withColumn("is_missed", v.F.col("payment_status") == "missed"))
    assert out.columns == ["customer_id", "due_date", "repayment_id", "is_missed", "missed_streak"]
    scans = re.findall(r"ReadSchema: (\S+)", plan(out))
    assert scans and all(x.count("customer_id") == 1 for x in scans)


def test_running_misses_are_counted_where_the_customer_lies(spark, tables):
    df = loans.with_cumulative_missed(v.rep(spark, tables).withColumn("is_missed", v.F.col("payment_status") == "missed"))
    per_customer = df.groupBy("customer_id").agg(v.F.max("consecutive_missed_count").alias("n"))
    assert {r.customer_id: r.n for r in per_customer.collect()} == dict.fromkeys(range(1, 6), 12)
    # By order (twice) and by customer, not by due date, nor once more to aggregate.
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(per_customer).split("Initial Plan")[-1])
    assert sorted(re.findall(r"[a-z_]+(?=#)", " ".join(keys))) == ["customer_id", "l_orderkey", "o_orderkey"]


@pytest.mark.parametrize("limit", [3, 100])
def test_running_misses_of_hot_customers(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", limit)
    days = [None, *[datetime(2024, 1, d).date() for d in (1, 1, 2, 3)]]
    data = [(c, day, i, missed) for c in (1, 2, None) for i, (day, missed) in enumerate(zip(days, (True, True, False, None, True), strict=True))]
    data += [(7, days[1], 1, True)]
    df = spark.createDataFrame(data, "customer_id bigint, due_date date, repayment_id bigint, is_missed boolean")
    got = loans.with_cumulative_missed(df)
    assert got.columns == [*df.columns, "consecutive_missed_count"]
    want = [(c, i, n) for c in (1, 2, None) for i, n in enumerate((1, 2, 2, 2, 3))] + [(7, 1, 1)]
    found = [(r.customer_id, r.repayment_id, r.consecutive_missed_count) for r in got.collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("limit", [3, 100])
def test_distinct_values_by_customer(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", limit)
    monkeypatch.setattr(features, "ROWS_OF_DISTINCT", 2)
    data = [(c, f"C{i % 2}", f"M{i}", i % 3) for c in (1, 2, None) for i in range(5)]
    data += [(7, None, None, None), (8, "C1", None, 4)]
    df = spark.createDataFrame(data, "customer_id bigint, merchant_country string, merchant_name string, device_id int")
    plain = features.distinct_values(df, 2)
    got = features.distinct_values(df, 2, by_customer=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    if limit == 100:  # 17 rows, two a task, in one shuffle
        text = plan(got).split("Initial Plan")[-1]
        assert re.findall(r"hashpartitioning\(customer_id#\d+L, (\d+)\)", text) == ["9"]


def test_feeds_ask_for_no_fewer_tasks_than_spark(spark, tables):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 7)  # more than cores
    try:
        text = v.rep(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert re.findall(r"RepartitionByExpression \[[^\]]*\], (\d+)", text) == ["7", "7"]


def shuffled_inputs(spark, df):
    """The columns that go into each shuffle, where no table is small enough to be broadcast."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text, re.MULTILINE)


@pytest.fixture()
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_silver_transactions_are_shuffled_for_copies_and_once_more(spark, tables, no_broadcast):
    df = q.silver_card_txn(spark, tables)
    assert len([x for x in shuffled_inputs(spark, df) if "merchant_name#" in x]) == 2
    # The rows, and once for pairs and statistics, which are also read for hot and for other keys.
    scans = re.findall(r"ReadSchema: (\S*l_orderkey\S*)", plan(df))
    assert len(scans) > 2 and len(set(scans)) == 2


@pytest.mark.parametrize("limit", [2, 100])
def test_country_and_zscore_by_pairs_of_account_and_customer(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", limit)
    who = [("a", 1), ("a", 2), ("b", 1), (None, 1), ("a", None), (None, None), ("x", 7)]
    data = [(f"{i}-{k}", acc, cust, 10.0 * i + k * k) for i, (acc, cust) in enumerate(who) for k in range(3)]
    txn = spark.createDataFrame(data, "transaction_id string, account_id string, customer_id bigint, amount double")
    txn = txn.unionAll(txn.filter("transaction_id = '0-0'"))  # a copy is counted
    accounts = spark.createDataFrame([("a", "ZA"), ("b", None), ("c", "KE")], "account_id string, billing_country string")
    pairs = t.with_billing_country(t.account_pairs(txn), accounts)
    kept = txn.dropDuplicates(["transaction_id"])
    got = t.with_amount_zscore(kept, source=txn, pairs=pairs)
    assert got.columns == [*txn.columns, "billing_country", "amount_zscore"]
    want = t.with_amount_zscore(t.with_billing_country(kept, accounts), source=txn).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == len(data) and got.filter("billing_country = 'ZA'").count() == 9


def test_silver_repayments_are_shuffled_for_copies_and_once_more(spark, tables, no_broadcast):
    df = q.silver_loan_rep(spark, tables)
    assert "lineitem.parquet" in plan(df)  # nor stored in between, which would hide shuffles
    found = shuffled_inputs(spark, df)
    assert len([x for x in found if "payment_date#" in x]) == 2


@pytest.mark.parametrize("dedup_first", [False, True])
@pytest.mark.parametrize("limit", [4, 100])
def test_running_misses_and_streaks_of_silver_repayments(spark, monkeypatch, limit, dedup_first):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", limit)
    days = [None, "2024-01-01", "2024-01-01", "2024-01-02", "soon", "2024-01-03"]
    labels = ["Missed ", "missed", "Paid", " missed", None, "MISSED"]
    data = [(f"{c}{i}", c, day, label, 1) for c in ("a", "b", None) for i, (day, label) in enumerate(zip(days, labels, strict=True))]
    data += [("x1", "x", "2024-01-01", "missed", 1), ("x1", "x", "2024-01-01", "missed", 2), ("x2", "x", "2024-01-02", "paid", 1)]
    data += [("y1", "x", "2024-01-02", "missed", 1), ("y1", "y", "2024-01-05", "paid", 2), (None, "y", "2024-01-06", "missed", 1)]
    bronze = spark.createDataFrame(data, "repayment_id string, customer_id string, due_date string, payment_status string, _ingested_at int")
    nothing = v.F.lit(None).cast("string")
    for column in ("payment_date", "due_amount", "paid_amount", "days_past_due", "outstanding_balance"):
        bronze = bronze.withColumn(column, nothing)
    got = silver.silver_repayments(bronze, dedup_first)
    assert got.columns[-2:] == ["consecutive_missed_count", "missed_streak"]

    date = lambda x: "" if x in (None, "soon") else x
    missed = lambda x: (x or "").strip().lower() == "missed"
    kept = {r[0]: r for r in sorted(data, key=lambda r: r[4])}
    want = []
    for id_, who, day, _, _ in kept.values():
        counted = kept.values() if dedup_first else data
        so_far = sum(missed(r[3]) for r in counted if r[1] == who and date(r[2]) <= date(day))
        streak = 0
        for r in sorted((r for r in kept.values() if r[1] == who), key=lambda r: (date(r[2]), r[0] or "")):
            streak = streak + 1 if missed(r[3]) else 0
            if r[0] == id_:
                want.append((id_, so_far, streak))
    found = [(r.repayment_id, r.consecutive_missed_count, r.missed_streak) for r in got.collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
