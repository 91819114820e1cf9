"""Look-back values per row and state that merges, against brute force."""

import random
from datetime import date, datetime, timedelta
from statistics import mean

import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskflow.operators import features as f
from riskflow.operators import rolling, skew, state
from riskflow.operators import transactions as t

LIMITS = [pytest.param(None, id="no-hot-key"), pytest.param(5, id="hot-keys")]
SCHEMA = (
    "transaction_id int, customer_id string, transaction_ts timestamp_ntz, amount double, status string, "
    "channel string, merchant_country string, merchant_name string, is_international boolean"
)


@pytest.fixture(params=LIMITS)
def limit(request, monkeypatch):
    if request.param is not None:
        monkeypatch.setattr(skew, "ROWS_PER_TASK", request.param)


def transactions(n=260, seed=4):
    """Instants on window edges, repeated instants, a busy customer, unknown times and amounts."""
    rnd = random.Random(seed)
    start = datetime(1969, 11, 20)  # before and after the epoch
    out = []
    for i in range(n):
        who = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", None])
        at = start + timedelta(days=rnd.randrange(100), hours=rnd.choice([0, 0, 3, 23]), microseconds=rnd.choice([0, 0, 1]))
        out.append((
            i, who, at if i % 23 else None, rnd.randrange(1, 900) / 4 if i % 7 else None,
            rnd.choice(["declined", "approved", None]), rnd.choice(["online", "pos"]),
            rnd.choice(["ZA", "GB", "US", None]), f"shop {rnd.randrange(90)}", rnd.random() < 0.3,
        ))
    return out


def test_rolling_values_of_each_row(spark, limit):
    data = transactions()
    got = rolling.with_rolling_values(spark.createDataFrame(data, SCHEMA).repartition(3))
    found = {r.transaction_id: r for r in got.collect()}
    assert len(found) == len(data)
    for i, who, at, *_ in data:
        r = [found[i][c] for c in rolling.ROLLING]
        if at is None:
            assert r == [None] * 4
            continue
        near = [x for x in data if x[1] == who and x[2] and timedelta(0) <= at - x[2] <= timedelta(days=30)]
        amounts = [x[3] for x in near if x[3] is not None]
        declines = sum(x[4] == "declined" and at - x[2] <= timedelta(days=7) for x in near)
        assert (r[0], r[2], r[3]) == (len(near), max(amounts, default=None), declines)
        assert r[1] == (pytest.approx(mean(amounts)) if amounts else None)


@pytest.mark.parametrize(("days", "decline_days"), [(2, 2), (10, 1), (90, 60)])
def test_rolling_windows_of_other_lengths(spark, days, decline_days):
    data = transactions(120, 9)
    got = rolling.rolling_values(spark.createDataFrame(data, SCHEMA), days, decline_days)
    for r in got.collect():
        near = [x for x in data if x[1] == r.customer_id and x[2] and timedelta(0) <= r.transaction_ts - x[2] <= timedelta(days=days)]
        short = [x for x in near if r.transaction_ts - x[2] <= timedelta(days=decline_days)]
        assert r.txn_count_30d_rolling == len(near)
        assert r.declined_txn_count_7d_rolling == sum(x[4] == "declined" for x in short)
    with pytest.raises(ValueError, match="decline_days"):
        rolling.rolling_values(spark.createDataFrame(data, SCHEMA), 5, 6)


def test_moments_of_parts_are_those_of_the_whole(spark):
    data = [(i, who, at, 1e9 + a if a is not None else None, *x) for i, who, at, a, *x in transactions()]
    whole = t.with_time_parts(spark.createDataFrame(data, SCHEMA))
    parts = [state.moments(whole.filter(F.col("transaction_id") % 3 == k)) for k in range(3)]
    merged = state.merge_moments(state.merge_moments(*parts[:2]), parts[2])
    got = {r.customer_id: r.asDict() for r in state.features_of_moments(merged).collect()}
    direct = whole.groupBy("customer_id").agg(
        *f.velocity_aggregates(), *f.late_night_aggregates(), *f.channel_aggregates(),
        F.stddev_samp("amount").alias("amount_deviation"),
    )
    for r in direct.collect():
        for name, value in r.asDict().items():
            if name != "customer_id":
                assert got[r.customer_id][name] == (pytest.approx(value, rel=1e-9) if value is not None else None), name
    assert state.merge_moments(parts[0].limit(0), parts[1]).count() == parts[1].count()


def test_zscores_against_a_state(spark, limit):
    whole = t.with_time_parts(spark.createDataFrame(transactions(), SCHEMA))
    want = {r.transaction_id: r.amount_zscore for r in t.with_amount_zscore(whole).collect()}
    got = state.with_zscore_of_state(whole, state.moments(whole)).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.amount_zscore == (pytest.approx(want[r.transaction_id], abs=1e-9) if want[r.transaction_id] is not None else None)


def test_days_are_added_to_the_values(spark):
    data = transactions()
    whole = spark.createDataFrame(data, SCHEMA)
    first, second = whole.filter("transaction_id < 150"), whole.filter("transaction_id >= 150")
    numbers = state.number_values(first, buckets=4)
    later = state.number_values(second, numbers, buckets=4)
    old = {(r.kind, r.value): r.number for r in numbers.collect()}
    new = {(r.kind, r.value): r.number for r in later.collect()}
    assert old.items() <= new.items() and len(old) < len(new)
    assert len({(k, n) for (k, _), n in new.items()}) == len(new)  # no number twice
    assert set(new) == {("country", x[6]) for x in data if x[6]} | {("merchant", x[7]) for x in data}
    daily = state.merge_daily_values(state.daily_values(first, numbers), state.daily_values(second, later))
    assert rows(daily) == rows(state.daily_values(whole, later).select(daily.columns))
    for day in (date(1970, 1, 15), date(1969, 11, 20), date(1971, 1, 1)):
        got = {r.customer_id: tuple(r)[1:] for r in state.distinct_as_of(daily, F.lit(day)).collect()}
        want = {}
        for who in {x[1] for x in data}:
            mine = [x for x in data if x[1] == who and x[2] and 0 <= (day - x[2].date()).days < 30]
            week = [x for x in mine if (day - x[2].date()).days < 7]
            if mine:
                want[who] = (len({x[6] for x in mine} - {None}), len({x[7] for x in week}))
        assert got == want
