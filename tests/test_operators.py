"""Operators against brute force, with ordinary keys and with hot ones."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from statistics import mean, stdev

import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskflow.operators import features as f
from riskflow.operators import loans, skew
from riskflow.operators import transactions as t
from riskflow.operators.dedup import dedup_any, dedup_latest
from riskflow.plans.silver import silver_accounts

# A limit of 5 rows per task makes most keys below hot.
LIMITS = [pytest.param(None, id="no-hot-key"), pytest.param(5, id="hot-keys")]


@pytest.fixture(params=LIMITS)
def limit(request, monkeypatch):
    if request.param is not None:
        monkeypatch.setattr(skew, "ROWS_PER_TASK", request.param)
    return request.param


def close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) < 1e-9)


def test_attach_keeps_every_row_once(spark, limit):
    data = [("a", i) for i in range(40)] + [("b", i) for i in range(3)] + [(None, i) for i in range(30)]
    left = spark.createDataFrame(data, "k string, i int").repartition(3)
    right = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), (None, 9)], "k string, v int")
    want = {"a": 1, "b": None, None: None}
    got = skew.attach_per_key(left, right, ["k"], ["i"])
    assert rows(got) == rows(spark.createDataFrame([(k, i, want[k]) for k, i in data], "k string, i int, v int"))
    sized = right.withColumn("n", F.lit(40))
    null_safe = skew.attach_per_key(left, sized, ["k"], ["i"], size="n", null_safe=True)
    want[None] = 9
    assert rows(null_safe) == rows(spark.createDataFrame([(k, i, want[k]) for k, i in data], "k string, i int, v int"))


def test_hot_rows_spread_over_tasks(spark):
    left = spark.range(4000).select(F.lit("a").alias("k"), "id").repartition(4)
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("v"))
    plan_setting = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = skew.attach_per_key(left, right, ["k"], ["id"], size="n", rows_per_task=100)
        per_task = Counter(r[0] for r in got.select(F.spark_partition_id()).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", plan_setting)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(per_task) == 4 and max(per_task.values()) < 1500


def test_zscore(spark, limit):
    rnd = random.Random(1)
    data = [(i, rnd.choice(["a", "a", "b", "c", None]), rnd.choice([1.0, 2.5, 9.0, None])) for i in range(80)]
    data += [(900, "single", 5.0)] + [(910 + i, "constant", 0.1) for i in range(9)]
    df = spark.createDataFrame(data, "transaction_id int, customer_id string, amount double")
    groups = defaultdict(list)
    for _, c, a in data:
        if a is not None:
            groups[c].append(a)
    for i, c, a, z in rows(t.with_amount_zscore(df)):
        g = groups[c]
        sd = stdev(g) if len(g) > 1 else 0
        want = (None if a is None else (a - mean(g)) / sd) if sd > 1e-12 else 0.0
        assert close(z, want), (i, c, a)


def test_billing_country_does_not_double_rows(spark, limit):
    txn = spark.createDataFrame([(i, "x") for i in range(20)] + [(20, "y"), (21, None)], "transaction_id int, account_id string")
    raw = [("x", "c", "za ", 1), ("x", "c", "gb", 2), ("z", "c", "GH", 1)]
    raw = spark.createDataFrame(raw, "account_id string, customer_id string, billing_country string, _ingested_at int")
    for name in ("credit_limit", "account_open_date", "card_type", "card_tier", "account_status"):
        raw = raw.withColumn(name, F.lit(None).cast("string"))
    got = rows(t.with_billing_country(txn, silver_accounts(raw)), "transaction_id", "billing_country")
    assert got == [(i, "GB") for i in range(20)] + [(20, None), (21, None)]


@pytest.mark.parametrize("seconds", [600, 3600])
def test_rolling_count(spark, seconds):
    rnd = random.Random(seconds)
    start = datetime(2024, 1, 1)
    data = [(rnd.choice("aab"), start + timedelta(seconds=rnd.randrange(0, 20000, 100))) for _ in range(300)]
    data += [("edge", start), ("edge", start + timedelta(seconds=seconds)), ("edge", start + timedelta(seconds=seconds + 1)), ("edge", None)]
    df = spark.createDataFrame(data, "customer_id string, transaction_ts timestamp")
    got = {(r[0], r[1]): r[2] for r in t.rolling_count(df, seconds, "n").collect()}
    known = [(c, s) for c, s in data if s is not None]
    assert set(got) == set(known)
    for c, s in got:
        assert got[c, s] == sum(1 for k, x in known if k == c and s - timedelta(seconds=seconds) <= x <= s)
    peaks = dict(rows(t.peak_rolling_count(df, seconds, "n")))
    assert peaks == {k: max(v for (c, _), v in got.items() if c == k) for k in ("a", "b", "edge")}


def test_rolling_count_of_zoneless_timestamps(spark):
    """02:30 and 03:30 are an hour apart, also where clocks skip from 02:00 to 03:00."""
    data = [("a", datetime(2024, 3, 10, 2, 30)), ("a", datetime(2024, 3, 10, 3, 30)), ("a", datetime(1969, 12, 31, 23, 59, 59, 999999))]
    df = spark.createDataFrame(data, "customer_id string, transaction_ts timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    for name in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", name)
        try:
            assert [r[2] for r in rows(t.rolling_count(df, 3599, "n"))] == [1, 1, 1]
            assert [r[2] for r in rows(t.rolling_count(df, 3600, "n"))] == [1, 1, 2]
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)


def test_dedup(spark):
    data = [("a", 1, "old"), ("a", 2, "new"), ("b", None, "x"), ("b", 1, "y"), (None, 1, "p"), (None, 2, "q")]
    df = spark.createDataFrame(data, "k string, at int, v string")
    once = dedup_latest(df, ["k"], ["at"])
    assert rows(once, "k", "v") == [(None, "q"), ("a", "new"), ("b", "y")]
    assert rows(dedup_latest(once, ["k"], ["at"])) == rows(once)
    assert dedup_any(df, ["k"]).count() == 3
    tied = spark.createDataFrame([("a", 1, str(i)) for i in range(50)], "k string, at int, v string")
    picks = {rows(dedup_latest(tied.repartition(n), ["k"], ["at"]))[0] for n in (1, 2, 5)}
    assert len(picks) == 1


def test_dedup_cuts_copies_before_the_shuffle(spark):
    df = spark.range(0, 100, 1, 4).select((F.col("id") % 7).alias("k"), "id")
    plan = dedup_latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def _applications(spark):
    rnd = random.Random(3)
    data = []
    for i in range(150):
        c = rnd.choice(["a", "a", "b", "c", "d"])
        data.append((
            i, c, rnd.choice([c, c, "s", None]), rnd.choice(["street " + c, "common", None]),
            rnd.choice(["g1", "g1", "g2", None]), rnd.choice(["approved", "declined", None]),
            rnd.choice(["n1", "n2", "n3", None]),
            None if i % 29 == 0 else date(2024, 1, 1) + timedelta(days=rnd.randrange(120)),
        ))
    data.append((900, "e", "only-e", "lane", "g3", "approved", "n1", date(2024, 1, 1)))
    schema = "application_id int, customer_id string, id_number string, address string, agent_id string, application_status string, branch_id string, application_date date"
    return data, spark.createDataFrame(data, schema)


def test_application_signals(spark, limit):
    data, df = _applications(spark)
    got = loans.with_applications_per_customer(df, source=df)
    got = loans.with_shared_flag(got, "id_number", "id_shared_flag", source=df)
    got = loans.with_shared_flag(got, "address", "address_shared_flag", source=df)
    got = loans.with_agent_approval_rate(got, source=df)
    got = {r.application_id: r for r in got.collect()}
    assert len(got) == len(data) == df.count()
    per_customer = Counter(r[1] for r in data)
    for r in data:
        g = got[r[0]]
        assert g.applications_last_30d == per_customer[r[1]]
        assert g.id_shared_flag == (r[2] is not None and len({x[1] for x in data if x[2] == r[2]}) > 1)
        assert g.address_shared_flag == (r[3] is not None and len({x[1] for x in data if x[3] == r[3]}) > 1)
        mine = [x for x in data if x[4] == r[4]]
        rate = sum(x[5] == "approved" for x in mine) / len(mine) if r[4] else None
        assert g.agent_approval_rate == rate


def test_applications_in_window(spark, limit):
    data, df = _applications(spark)
    got = {(r[0], r[1]): (r[2], r[3]) for r in loans.applications_in_window(df).collect()}
    dated = [r for r in data if r[7] is not None]
    assert set(got) == {(r[1], r[7]) for r in dated}
    for c, d in got:
        inside = [r for r in dated if r[1] == c and d - timedelta(days=30) <= r[7] <= d]
        assert got[c, d] == (len(inside), len({r[6] for r in inside} - {None}))
    per_row = {r.application_id: r for r in loans.with_applications_in_window(df).collect()}
    for r in data:
        mine = per_row[r[0]]
        got_here = (mine.applications_30d_rolling, mine.distinct_branches_30d_rolling)
        assert got_here == got.get((r[1], r[7]), (None, None))


def _repayments(spark):
    rnd = random.Random(5)
    data = [
        (i, rnd.choice(["a", "a", "a", "b", None]),
         None if i % 17 == 0 else date(2024, 1, 1) + timedelta(days=rnd.randrange(9)),
         rnd.random() < 0.6)
        for i in range(200)
    ]
    start = len(data)
    story = [(date(2024, 2, d), m) for d, m in ((1, True), (2, True), (3, False), (4, True))]
    data += [(start + i, "story", d, m) for i, (d, m) in enumerate(story)]
    data += [(start + 10 + i, "never", date(2024, 3, 1 + i), True) for i in range(8)]
    return data, spark.createDataFrame(data, "repayment_id int, customer_id string, due_date date, is_missed boolean")


def test_cumulative_missed(spark, limit):
    data, df = _repayments(spark)
    got = {r.repayment_id: r.consecutive_missed_count for r in loans.with_cumulative_missed(df).collect()}
    assert len(got) == len(data)
    low = date(1, 1, 1)
    for i, c, d, _ in data:
        assert got[i] == sum(m for _, c2, d2, m in data if c2 == c and (d2 or low) <= (d or low))


@pytest.mark.parametrize("ranges", [None, 1, 40])
def test_missed_streak(spark, ranges):
    data, df = _repayments(spark)
    got = loans.missed_streak(df, ranges=ranges)
    got = {r.repayment_id: r.missed_streak for r in got.collect()}
    assert len(got) == len(data)
    run = Counter()
    for i, c, d, m in sorted(data, key=lambda r: (r[2] or date(1, 1, 1), r[0])):
        run[c] = run[c] + 1 if m else 0
        assert got[i] == run[c], (i, c, d)
    longest = dict(rows(loans.longest_streak(df, ranges=ranges)))
    assert longest["story"] == 2 and longest["never"] == 8
    total = {r.customer_id: r.m for r in df.groupBy("customer_id").agg(F.count_if("is_missed").alias("m")).collect()}
    assert all(longest[c] <= total[c] for c in total)


def test_merchant_category_risk(spark, limit):
    rnd = random.Random(7)
    data = [(rnd.choice("abc"), rnd.choice(["m1", "m1", "m2", None]), rnd.choice(["declined", "approved"])) for _ in range(120)]
    df = spark.createDataFrame(data, "customer_id string, merchant_category_code string, status string")
    risk = {m: mean(s == "declined" for _, k, s in data if k == m) for m in ("m1", "m2")}
    for c, got in rows(f.merchant_category_risk(df)):
        assert close(got, mean(risk[m] for k, m, _ in data if k == c and m))


def _card(spark):
    txn = spark.createDataFrame(
        [
            (1, "a", 10.0, "declined", 0, "ZA", "m1", True, "online", "d1", 1.0),
            (2, "a", 30.0, "approved", 4, "ZA", "m2", False, "pos", "d2", -1.0),
            (3, "a", None, None, 5, None, "m2", None, None, "d3", None),
            (4, "a", 20.0, "declined", 1, "US", None, True, "online", "d4", 0.0),
            (5, "b", 7.0, "approved", None, "KE", "m1", False, "pos", None, 0.0),
        ],
        "transaction_id int, customer_id string, amount double, status string, hour_of_day int, "
        "merchant_country string, merchant_name string, is_international boolean, channel string, "
        "device_id string, amount_zscore double",
    )
    acc = spark.createDataFrame(
        [("x1", "a", "active", 1.0), ("x2", "a", "closed", 2.0), ("y", "b", "active", 3.0), ("z", "none", "active", None)],
        "account_id string, customer_id string, account_status string, credit_limit double",
    )
    return txn, acc


def test_card_features(spark, limit):
    txn, acc = _card(spark)
    got = {r.account_id: r for r in f.card_features(txn, acc).collect()}
    assert set(got) == {"x1", "x2", "y", "z"}
    a = got["x1"]
    assert (a.txn_count_30d, a.avg_txn_amount_30d, a.max_txn_amount_30d) == (4, 20.0, 30.0)
    assert (a.declined_txn_count_7d, a.txn_count_1h, a.late_night_txn_ratio) == (2, 2, 0.75)
    assert (a.distinct_countries_30d, a.distinct_merchants_7d) == (2, 2)
    assert (a.international_txn_ratio, a.online_txn_ratio) == (0.5, 0.5)
    assert (a.unknown_device_flag, a.merchant_risk_score) == (True, 0.0)
    z = got["z"]
    assert (z.txn_count_30d, z.avg_txn_amount_30d, z.unknown_device_flag) == (0, 0.0, False)
    assert got["y"].unknown_device_flag is False and got["y"].late_night_txn_ratio == 0.0
    per_customer = {r.customer_id: r.account_id for r in f.card_features(txn, acc, grain="customer").collect()}
    assert per_customer == {"a": "x1", "b": "y", "none": "z"}
    with pytest.raises(ValueError, match="grain"):
        f.card_features(txn, acc, grain="card")


def test_asof_features(spark):
    as_of = datetime(2024, 3, 1)
    data = [
        (1, "a", as_of, 10.0, "declined", "ZA", "m1"),
        (2, "a", as_of - timedelta(days=7), 20.0, "declined", "US", "m2"),
        (3, "a", as_of - timedelta(days=7, seconds=1), 30.0, "declined", "KE", "m3"),
        (4, "a", as_of - timedelta(days=30), 40.0, "approved", "KE", "m4"),
        (5, "a", as_of - timedelta(days=30, seconds=1), 50.0, "declined", "GH", "m5"),
        (6, "a", as_of + timedelta(seconds=1), 60.0, "declined", "GH", "m6"),
    ]
    df = spark.createDataFrame(data, "transaction_id int, customer_id string, transaction_ts timestamp, amount double, status string, merchant_country string, merchant_name string")
    row = f.asof_features(df, F.lit(as_of)).drop("customer_id").first().asDict()
    assert row == {
        "txn_count_30d_asof": 4, "avg_txn_amount_30d_asof": 25.0, "max_txn_amount_30d_asof": 40.0,
        "distinct_countries_30d_asof": 3, "declined_txn_count_7d_asof": 2, "distinct_merchants_7d_asof": 2,
    }


def test_loan_features(spark):
    app = spark.createDataFrame(
        [
            ("p1", "a", date(2024, 1, 1), "b1", 1.5, False, False, 0.95, True),
            ("p9", "a", date(2024, 5, 1), "b1", None, True, False, None, False),
            ("p2", "a", date(2024, 5, 1), None, 7.0, False, False, 0.2, False),
            ("q", "b", None, "b2", None, False, False, None, False),
        ],
        "application_id string, customer_id string, application_date date, branch_id string, loan_to_income_ratio double, id_shared_flag boolean, address_shared_flag boolean, agent_approval_rate double, is_income_realistic boolean",
    )
    rep = spark.createDataFrame(
        [("r1", "a", True, False, 1, 100.0, 0.0, 30, 50.0), ("r2", "a", False, True, 1, 0.0, 9.0, None, None), ("r3", "a", False, False, 1, 100.0, 100.0, 0, 25.0)],
        "repayment_id string, customer_id string, is_missed boolean, is_partial boolean, consecutive_missed_count int, due_amount double, paid_amount double, days_past_due int, outstanding_balance double",
    )
    got = {r.customer_id: r for r in f.loan_features(app, rep).collect()}
    a, b = got["a"], got["b"]
    assert (a.application_id, a.applications_last_30d, a.distinct_branches_30d) == ("p9", 3, 1)
    assert (a.loan_to_income_ratio, a.id_shared_flag, a.agent_risk_flag, a.income_realistic_flag) == (7.0, True, True, True)
    assert (a.missed_payment_count, a.avg_payment_ratio, a.avg_days_past_due) == (1, 0.5, 15.0)
    assert a.total_outstanding_balance == 75.0 and close(a.partial_payment_ratio, 1 / 3)
    assert (b.agent_risk_flag, b.agent_approval_rate, b.missed_payment_count, b.avg_payment_ratio) == (False, 0.0, 0, 0.0)
