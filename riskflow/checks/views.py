"""The feeds of this project, built from the driver's star-schema tables.

with padding, mixed case, NULLs and unreadable numbers, for the cleaning jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"  # after the last event
AS_OF_TXN = "2001-01-15 00:00:00"
#: Rows of lineitem that one task joins to orders.
LINES_PER_TASK = 250_000


# --- fixed values: columns of the driver's tables, so that no file is opened to plan ---
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem with the customer of its order, as large at scale, so merged and not broadcast.

    The shuffle partitions grow with the rows and are not coalesced: otherwise a few tasks sort
    and aggregate all rows after the join, and their memory grows with the table. They are not
    fewer than Spark's own, which would have it shuffle one side once more.
    """
    li = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(few, -(-li.count() // LINES_PER_TASK))
    return li.repartition(parts, "l_orderkey").join(
        orders.repartition(parts, "o_orderkey").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    )


def _txt(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def acc(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("billing_country"),
        F.col("c_acctbal").alias("credit_limit"),
        F.col("c_mktsegment").alias("account_status"),
    )


def txn(spark: SparkSession, sf: str) -> DataFrame:
    li = _lines(spark, sf)
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    ts = F.col("l_shipdate") + F.make_dt_interval(
        F.lit(0),
        (F.col("l_partkey") % 24).cast("int"),
        (F.col("l_suppkey") % 60).cast("int"),
    )
    return (
        li.join(supplier, li.l_suppkey == supplier.s_suppkey)
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
            F.col("o_custkey").alias("account_id"),
            F.col("o_custkey").alias("customer_id"),
            ts.alias("transaction_ts"),
            F.col("l_extendedprice").alias("amount"),
            F.col("l_suppkey").alias("merchant_id"),
            F.col("s_name").alias("merchant_name"),
            F.col("s_nationkey").alias("merchant_country"),
            (F.col("l_partkey") % 5).alias("merchant_category_code"),
            F.when(F.col("l_returnflag") == "R", "declined").otherwise("approved").alias("status"),
            F.when(F.col("l_linestatus") == "O", "online").otherwise("pos").alias("channel"),
            (F.col("l_partkey") % 97).alias("device_id"),
            F.col("l_partkey").alias("part_id"),
            F.col("l_quantity").alias("quantity"),
        )
    )


def evt(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("transaction_ts"),
        F.col("value").alias("amount"),
        F.when(kind == "error", "declined").otherwise("approved").alias("status"),
        F.when(kind == "purchase", "online").otherwise("pos").alias("channel"),
        kind.alias("merchant_country"),
        F.substring("props", 1, 7).alias("merchant_name"),
    )


def app(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    state = F.col("o_orderstatus")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("application_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("application_date"),
        F.col("o_orderpriority").alias("loan_type"),
        F.col("o_totalprice").alias("loan_amount_requested"),
        F.col("c_acctbal").alias("stated_income"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "unemployed")
        .otherwise("employed")
        .alias("stated_employment_status"),
        (F.col("c_custkey") % 20).cast("int").alias("stated_years_employed"),
        F.nullif(F.col("c_custkey") % 1000, F.lit(7)).alias("id_number"),
        F.concat_ws("-", _txt("c_nationkey"), "c_mktsegment", _txt(F.col("c_custkey") % 10)).alias(
            "address"
        ),
        F.nullif(F.col("o_orderkey") % 200, F.lit(13)).alias("agent_id"),
        (F.col("o_orderkey") % 50).alias("branch_id"),
        F.when(state == "F", "approved")
        .when(state == "O", "pending")
        .otherwise("declined")
        .alias("application_status"),
    )


def rep(spark: SparkSession, sf: str) -> DataFrame:
    li = _lines(spark, sf)
    flag, due = F.col("l_returnflag"), F.col("l_extendedprice")
    status = (
        F.when(flag == "R", "missed")
        .when(flag == "A", "partial")
        .when(F.col("l_tax") > 0.06, "late")
        .otherwise("paid")
    )
    paid = (
        F.when(flag == "R", 0.0).when(flag == "A", due * (1 - F.col("l_discount") * 5)).otherwise(due)
    )
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("repayment_id"),
        F.col("l_orderkey").alias("application_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("l_shipdate").alias("due_date"),
        due.alias("due_amount"),
        paid.alias("paid_amount"),
        status.alias("payment_status"),
        F.col("l_quantity").cast("int").alias("days_past_due"),
        (due * F.col("l_tax")).alias("outstanding_balance"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
    )


def cust(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_nationkey").alias("country"),
        F.col("c_mktsegment").alias("city"),
        F.lit(None).cast("int").alias("age"),
        F.lit("active").alias("account_status"),
        F.lit("employed").alias("employment_status"),
        F.col("c_acctbal").alias("stated_income"),
    )


# --- the same feeds as raw text ----------------------------------------------------
def bronze_txn(spark: SparkSession, sf: str) -> DataFrame:
    t = txn(spark, sf)
    padded = F.concat(F.lit(" c"), _txt("merchant_country"), F.lit(" "))
    return t.select(
        _txt("transaction_id").alias("transaction_id"),
        _txt("account_id").alias("account_id"),
        _txt("customer_id").alias("customer_id"),
        F.date_format("transaction_ts", "yyyy-MM-dd").alias("transaction_date"),
        F.date_format("transaction_ts", "HH:mm:ss").alias("transaction_time"),
        F.when(F.col("quantity") == 13, "n/a")
        .when(F.col("quantity") == 17, "NaN")
        .when(F.col("quantity") == 18, "Infinity")
        .otherwise(_txt("amount"))
        .alias("amount"),
        F.lit(" zar").alias("currency"),
        _txt("merchant_id").alias("merchant_id"),
        "merchant_name",
        _txt("merchant_category_code").alias("merchant_category_code"),
        F.when(F.col("merchant_id") % 17 != 0, padded).alias("merchant_country"),
        F.when(F.col("channel") == "online", " Online").otherwise("POS ").alias("channel"),
        _txt("device_id").alias("device_id"),
        F.initcap("status").alias("status"),
        _txt(F.col("transaction_id") % 2).alias("is_fraud_label"),
        # A load time without ties among the rows of one id.
        (
            F.col("part_id") * 10_000_000_000
            + F.col("merchant_id") * 10_000_000
            + F.col("quantity").cast("bigint")
        ).alias("_ingested_at"),
        F.lit("card_transactions.csv").alias("_source_file"),
    )


def bronze_acc(spark: SparkSession, sf: str) -> DataFrame:
    a = acc(spark, sf)
    now = a.select(
        _txt("account_id").alias("account_id"),
        _txt("customer_id").alias("customer_id"),
        F.lit(" VISA").alias("card_type"),
        F.lit("Gold ").alias("card_tier"),
        F.when(F.col("account_id") % 10 == 3, "31/12/2020")
        .otherwise("2020-12-31")
        .alias("account_open_date"),
        F.concat(F.lit(" "), "account_status").alias("account_status"),
        F.when(F.col("account_id") % 10 == 4, "").otherwise(_txt("credit_limit")).alias(
            "credit_limit"
        ),
        F.concat(F.lit("c"), _txt("billing_country"), F.lit(" ")).alias("billing_country"),
        F.lit("Town").alias("billing_city"),
        F.lit(2).alias("_ingested_at"),
    )
    # Every seventh account was loaded before, with another country.
    before = a.filter(F.col("account_id") % 7 == 0).select(
        _txt("account_id"),
        _txt("customer_id"),
        F.lit(" VISA"),
        F.lit("Gold "),
        F.lit("2020-12-31"),
        F.lit(" old"),
        F.lit("1"),
        F.concat(F.lit("c"), _txt(F.col("billing_country") + 50)),
        F.lit("Town"),
        F.lit(1),
    )
    return now.unionAll(before)


def bronze_app(spark: SparkSession, sf: str) -> DataFrame:
    a = app(spark, sf)
    return a.select(
        _txt("application_id").alias("application_id"),
        _txt("customer_id").alias("customer_id"),
        F.date_format("application_date", "yyyy-MM-dd").alias("application_date"),
        F.concat(F.lit(" "), "loan_type").alias("loan_type"),
        _txt("loan_amount_requested").alias("loan_amount_requested"),
        F.when(F.col("application_id") % 7 == 0, "twelve").otherwise("12").alias(
            "loan_term_months"
        ),
        _txt("stated_income").alias("stated_income"),
        F.upper("stated_employment_status").alias("stated_employment_status"),
        _txt("stated_years_employed").alias("stated_years_employed"),
        F.lit("2").alias("num_dependants"),
        _txt("id_number").alias("id_number"),
        F.concat(_txt(F.col("customer_id") % 50 + 1940), F.lit("-03-05")).alias("date_of_birth"),
        "address",
        _txt("agent_id").alias("agent_id"),
        _txt("branch_id").alias("branch_id"),
        F.lit("Online").alias("application_channel"),
        F.initcap("application_status").alias("application_status"),
        F.lit("0").alias("is_fraud_label"),
    )


def bronze_rep(spark: SparkSession, sf: str) -> DataFrame:
    r = rep(spark, sf)
    return r.select(
        _txt("repayment_id").alias("repayment_id"),
        _txt("application_id").alias("application_id"),
        _txt("customer_id").alias("customer_id"),
        F.when(F.col("supplier_id") % 11 != 0, F.date_format("due_date", "yyyy-MM-dd")).alias(
            "due_date"
        ),
        F.when(F.col("payment_status") != "missed", F.date_format("due_date", "yyyy-MM-dd")).alias(
            "payment_date"
        ),
        _txt("due_amount").alias("due_amount"),
        _txt("paid_amount").alias("paid_amount"),
        F.concat(F.initcap("payment_status"), F.lit(" ")).alias("payment_status"),
        _txt("days_past_due").alias("days_past_due"),
        _txt("outstanding_balance").alias("outstanding_balance"),
        (
            F.col("part_id") * 10_000_000_000
            + F.col("supplier_id") * 10_000_000
            + F.col("days_past_due")
        ).alias("_ingested_at"),
    )
