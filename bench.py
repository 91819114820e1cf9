"""Times the headline queries and prints one JSON line.

Each query is planned and run twice into a sink that discards rows; the second,
warm run counts. `BENCH_SF_DIR` and `BENCH_CPUS` choose data and cores. With
`--plain` the card features are also timed in their plainest form: one aggregate and
one join per group of features, and a window over each customer for the z-score.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.checks import queries as q
from riskflow.checks import views as v
from riskflow.functions import signals
from riskflow.operators import features as f

HEADLINE = [
    "profile_txn",
    "breakdowns_card",
    "dedup_latest",
    "amount_zscore",
    "rolling_1h",
    "asof_features",
    "card_features",
    "card_score",
    "applications_30d_branches",
    "breakdowns_loan_signals",
    "cumulative_missed",
    "missed_streak",
    "loan_score",
    "silver_card_txn",
    "silver_loan_rep",
    "fraud_alerts",
    "customer_risk",
    "kpi_summary",
]


def plain_card_features(spark: SparkSession, sf: str) -> DataFrame:
    """What the fused plan is compared with; same columns, no care for hot customers."""
    accounts = v.acc(spark, sf)
    by_customer = W.partitionBy("customer_id")
    spread = F.stddev("amount").over(by_customer)
    txn = v.txn(spark, sf).join(accounts.select("account_id", "billing_country"), "account_id", "left")
    txn = txn.withColumns(
        {
            "is_international": signals.is_international(),
            "hour_of_day": signals.hour_of_day(),
            "amount_zscore": F.when(
                spread > 0, (F.col("amount") - F.avg("amount").over(by_customer)) / spread
            ).otherwise(0.0),
        }
    )
    features = accounts.select("customer_id", "account_id", "account_status", "credit_limit")
    category = txn.filter(F.col("merchant_category_code").isNotNull())
    rates = category.groupBy("merchant_category_code").agg(
        F.avg((F.col("status") == "declined").cast("double")).alias("rate")
    )
    by_group = [
        txn.groupBy("customer_id").agg(*group)
        for group in (
            f.velocity_aggregates(),
            f.late_night_aggregates(),
            f.channel_aggregates(),
            [
                F.count_distinct("merchant_country").alias("distinct_countries_30d"),
                F.count_distinct("merchant_name").alias("distinct_merchants_7d"),
            ],
            [(F.count_distinct("device_id") > q.DEVICE_LIMIT).alias("unknown_device_flag")],
            f.merchant_aggregates(),
        )
    ]
    by_group.append(
        category.join(rates, "merchant_category_code")
        .groupBy("customer_id")
        .agg(F.avg("rate").alias(q.MCC))
    )
    for group in by_group:
        features = features.join(group, "customer_id", "left")
    return features


def run(spark: SparkSession, query, sf: str) -> float:
    start = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: q.QUERIES[name] for name in HEADLINE}
    if "--plain" in sys.argv:
        queries["card_features_plain"] = plain_card_features
    seconds = {}
    for name, query in queries.items():
        run(spark, query, sf)
        seconds[name] = round(run(spark, query, sf), 3)
    spark.stop()
    total = sum(seconds[name] for name in HEADLINE)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm run",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
