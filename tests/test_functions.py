from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from riskflow.config import Rule, card_rules, loan_rules
from riskflow.functions import normalize as n
from riskflow.functions import signals
from riskflow.functions.scoring import risk_tier, top_signal, weighted_score


def test_casts_give_null_on_bad_text(spark):
    df = spark.createDataFrame(
        [("1.5", "7", "2024-02-29"), (" 2 ", "x", "2023-02-29"), (None, "", "29/02/2024")],
        "a string, b string, d string",
    )
    out = n.parse_dates(n.cast_columns(df, {"a": "double", "b": "int"}), ["d"]).collect()
    assert [tuple(r) for r in out] == [
        (1.5, 7, date(2024, 2, 29)),
        (2.0, None, None),
        (None, None, None),
    ]


def test_texts_for_nan_and_infinity_are_no_numbers(spark):
    texts = ["NaN", "nan", "Infinity", "-inf", "+Infinity", "1e400", "1e300"]
    df = spark.createDataFrame([(x,) for x in texts], "a string")
    out = n.cast_columns(df, {"a": "double"}).collect()
    assert [r.a for r in out] == [None] * 6 + [1e300]


def test_timestamps(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "23:59:59"), ("2024-01-01", None), ("2024-01-01", "25:00:00")],
        "d string, t string",
    )
    out = df.select(n.combine_date_time("d", "t").alias("ts")).collect()
    assert [r.ts for r in out] == [datetime(2024, 1, 1, 23, 59, 59), None, None]
    parsed = n.parse_timestamps(
        spark.createDataFrame([("2024-01-01 10:00:00",), ("later",)], "ts string"), ["ts"]
    ).collect()
    assert [r.ts for r in parsed] == [datetime(2024, 1, 1, 10), None]


def test_text_helpers(spark):
    df = spark.createDataFrame([(" za ", " Online", "1234567", None)], "a string, b string, c string, d string")
    df = n.labels_lower(n.codes_upper(df, ["a", "d"]), ["b"])
    row = df.select("a", "b", n.mask_tail("c").alias("c"), "d").first()
    assert tuple(row) == ("ZA", "online", "****4567", None)


def test_drop_and_fill(spark):
    df = spark.createDataFrame([(1, None), (None, True), (None, None)], "a int, b boolean")
    assert n.drop_nulls_in(df, ["a", "b"]).count() == 0
    assert n.drop_nulls_in(df, ["a"]).count() == 1
    filled = n.fill_defaults(df, ["a"], ["b"]).collect()
    assert [tuple(r) for r in filled] == [(1, False), (0, True), (0, False)]


def test_weekend_and_hour(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, d, h),) for d, h in ((5, 0), (6, 4), (7, 5), (8, 23))] + [(None,)],
        "ts timestamp",
    )
    out = df.select(signals.hour_of_day("ts").alias("h"), signals.is_weekend("ts").alias("w"))
    assert [tuple(r) for r in out.collect()] == [
        (0, False), (4, True), (5, True), (23, False), (None, False),
    ]


def test_international_with_null_side_is_false(spark):
    df = spark.createDataFrame(
        [("ZA", "ZA"), ("US", "ZA"), (None, "ZA"), ("US", None)],
        "merchant_country string, billing_country string",
    )
    out = df.select(signals.is_international().alias("x")).collect()
    assert [r.x for r in out] == [False, True, False, False]


def test_loan_to_income(spark):
    df = spark.createDataFrame(
        [(100.0, 3.0), (100.0, 0.0), (100.0, -1.0), (100.0, None), (None, 5.0)],
        "loan_amount_requested double, stated_income double",
    )
    out = df.select(signals.loan_to_income().alias("x")).collect()
    assert [r.x for r in out] == [33.3333, None, None, None, None]


def test_income_realistic_is_true_unless_doubtful(spark):
    df = spark.createDataFrame(
        [
            ("unemployed", 5, 50_000.0, True),
            ("unemployed", 5, 50_001.0, False),
            ("employed", 1, 100_001.0, False),
            ("employed", 2, 100_001.0, True),
            (None, 1, 100_001.0, False),
            (None, None, None, True),
            ("unemployed", None, None, True),
        ],
        "stated_employment_status string, stated_years_employed int, stated_income double, want boolean",
    )
    for r in df.select(signals.income_realistic().alias("got"), "want").collect():
        assert r.got == r.want


def test_payment_signals(spark):
    df = spark.createDataFrame(
        [(100.0, 40.55, "partial"), (100.0, 120.0, "paid"), (100.0, None, None)],
        "due_amount double, paid_amount double, payment_status string",
    )
    out = df.select(
        signals.payment_shortfall().alias("s"),
        *[e.alias(k) for k, e in signals.payment_flags().items()],
    ).collect()
    assert [tuple(r) for r in out] == [
        (59.45, False, True, False),
        (-20.0, False, False, False),
        (None, False, False, False),
    ]


def test_age(spark):
    df = spark.createDataFrame([(date(2000, 1, 31),), (date(2000, 2, 1),), (None,)], "d date")
    out = df.select(signals.age("d", F.lit("2024-01-31").cast("date")).alias("a")).collect()
    assert [r.a for r in out] == [24, 23, None]


@pytest.mark.parametrize(
    ("score", "tier"),
    [(0.3999, "low"), (0.4, "medium"), (0.6999, "medium"), (0.7, "high"), (None, "low")],
)
def test_tier_bounds(spark, score, tier):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(risk_tier(F.col("s")).alias("t")).first().t == tier


def test_every_combination_of_card_rules_lands_on_its_tier(spark):
    """All 64 sums: none misses a tier bound through rounding."""
    cases = spark.range(64).select(
        "id",
        F.when(F.col("id").bitwiseAND(1) > 0, 3).otherwise(2).alias("distinct_countries_30d"),
        (F.col("id").bitwiseAND(2) > 0).alias("unknown_device_flag"),
        F.when(F.col("id").bitwiseAND(4) > 0, 4).otherwise(3).alias("declined_txn_count_7d"),
        F.when(F.col("id").bitwiseAND(8) > 0, 0.51).otherwise(0.5).alias("international_txn_ratio"),
        F.when(F.col("id").bitwiseAND(16) > 0, 0.31).otherwise(0.3).alias("late_night_txn_ratio"),
        F.when(F.col("id").bitwiseAND(32) > 0, 2.1).otherwise(2.0).alias("merchant_risk_score"),
    )
    weights = [25, 20, 20, 15, 10, 10]
    scored = cases.withColumn("score", weighted_score(card_rules()))
    scored = scored.withColumn("tier", risk_tier(F.col("score")))
    for r in scored.withColumn("signal", top_signal(card_rules())).collect():
        points = sum(w for i, w in enumerate(weights) if r.id >> i & 1)
        assert r.score == points / 100
        assert r.tier == ("high" if points >= 70 else "medium" if points >= 40 else "low")
        first = next((rule.name for i, rule in enumerate(card_rules()) if r.id >> i & 1), "none")
        assert r.signal == first  # the card rules are listed heaviest first


def test_score_is_clamped_and_null_conditions_do_not_fire(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    rules = [Rule("x", "a > 0", 80), Rule("y", "a = 1", 70), Rule("z", "b > 0", 50)]
    row = df.select(weighted_score(rules).alias("s"), top_signal(rules).alias("t")).first()
    assert tuple(row) == (1.0, "x")
    assert sum(r.weight for r in card_rules()) == sum(r.weight for r in loan_rules()) == 100
