"""The table jobs, each reading and writing tables through one `Store`.

Order: ingest, validate, silver, features, gold, export. Every job writes its
result once and later jobs read it back, so nothing is computed twice. Scores come
before alerts and alerts before customer risk, which counts them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow import config as c
from riskflow.functions import signals
from riskflow.functions.normalize import cast_columns, mask_tail, parse_dates
from riskflow.operators import features as f
from riskflow.operators import quality, report, runlog, scores, state
from riskflow.operators.alerts import fraud_alerts
from riskflow.operators.customer_risk import customer_risk, with_activity
from riskflow.operators.dedup import dedup_latest
from riskflow.plans import silver
from riskflow.sources.export import write_csv
from riskflow.sources.raw import MALFORMED, has_malformed_rows, read_raw, with_ingest_metadata
from riskflow.sources.tables import (
    read_table,
    replace_partitions,
    upsert_latest,
    write_bucketed,
    write_table,
)

#: The day a row was loaded, and the state per customer and load date.
LOAD_DATE = "_load_date"
CARD_STATE = "silver_card.silver_card_state"


@dataclass(frozen=True)
class Store:
    """Where tables live: folders under `root`, or catalog tables if it is None.

    With `buckets`, catalog tables of one row per customer are bucketed by customer, and so
    are silver transactions and repayments where no customer has too many of them.
    """

    spark: SparkSession
    root: str | None = None
    fmt: str = "parquet"
    buckets: int = 0

    def name(self, table: str) -> str:
        return table if self.root is None else f"{self.root}/{table.replace('.', '/')}"

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.name(table), self.fmt)

    def ensure(self, table: str) -> None:
        """Create the database of a catalog table where there is none."""
        if self.root is None and "." in table:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")

    def write(
        self, df: DataFrame, table: str, mode: str = "overwrite", bucket_by: str | None = None
    ) -> DataFrame:
        """Write `df`, creating a missing database first, and read it back."""
        self.ensure(table)
        write_table(df, self.name(table), mode, self.fmt, bucket_by, self.buckets)
        return self.read(table)

    def write_large(self, df: DataFrame, table: str, sort_by: str) -> DataFrame:
        """Write a table of many rows per customer, and its statistics if it is in the catalog.

        With `buckets` it is bucketed by customer and sorted, so that aggregates per customer
        read it without a shuffle, unless `write_bucketed` finds a customer too large.
        """
        self.ensure(table)
        name = self.name(table)
        if self.root is not None or not self.buckets:
            write_table(df, name, "overwrite", self.fmt)
        else:
            write_bucketed(df, name, "customer_id", sort_by, self.buckets, self.fmt)
        if self.root is None:
            self.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS customer_id")
        return self.read(table)


@contextmanager
def logged(store: Store, stage: str) -> Iterator[runlog.RunLog]:
    """Log the start, end or failure of a stage, and what it notes, in one append."""
    log = runlog.RunLog(stage)
    log.info("started")
    try:
        yield log
        log.info("finished")
    except Exception as error:
        log.error(f"failed: {type(error).__name__}: {error}"[:2000])
        raise
    finally:
        store.ensure(c.RUN_LOG)
        log.append(store.spark, store.name(c.RUN_LOG), store.fmt)


def _landed(
    store: Store, feed: c.Feed, path: str, multiline: bool, write: Callable[[DataFrame], None]
) -> dict[str, int]:
    """Write the sound rows of a raw file with `write`, counting all rows in the same pass."""
    raw = read_raw(store.spark, path, multiline, malformed=MALFORMED)
    quality.require_not_empty(raw, feed.file)
    rows, seen = quality.observed(with_ingest_metadata(raw, feed.file), feed.key, MALFORMED)
    write(rows.filter(F.col(MALFORMED).isNull()).drop(MALFORMED))
    return seen.get


def _land(
    store: Store,
    feed: c.Feed,
    path: str,
    multiline: bool | None,
    log: runlog.RunLog,
    write: Callable[[DataFrame], None],
    written: Callable[[], DataFrame],
) -> dict[str, int]:
    """Raw file to bronze by `write`; its rows, malformed rows and NULL keys.

    `multiline=None` reads line by line, many tasks to a file, and only if that makes
    malformed rows once more with line breaks in fields. Rows that are still malformed are
    kept apart with their text, in a table of their own. Counts come from the pass that
    writes; the table, whose own count is read from its files' footers, has to agree.
    """
    counts = _landed(store, feed, path, bool(multiline), write)
    if multiline is None and counts["malformed"]:
        multiline = True
        counts = _landed(store, feed, path, True, write)
    raw = with_ingest_metadata(
        read_raw(store.spark, path, bool(multiline), malformed=MALFORMED), feed.file
    )
    broken = raw.filter(F.col(MALFORMED).isNotNull())
    if not counts["malformed"]:
        broken = store.spark.createDataFrame([], raw.schema)
    store.write(broken, malformed_table(feed))
    found = written().count()
    if found != counts["rows"] - counts["malformed"]:
        raise RuntimeError(f"{feed.table} has {found} rows, not those written: {counts}")
    log.info(f"{found} rows")
    for name in ("malformed", "null_keys"):
        if counts[name]:
            log.warning(f"{name}: {counts[name]}")
    return counts


def malformed_table(feed: c.Feed) -> str:
    return f"{feed.table}_malformed"


def ingest(
    store: Store, feed: c.Feed, path: str, multiline: bool | None = None
) -> dict[str, int]:
    """Raw file to bronze, replacing the table; see `_land` for what it returns and checks."""
    with logged(store, f"{feed.name}_ingest") as log:
        return _land(
            store, feed, path, multiline, log,
            lambda rows: store.write(rows, feed.table), lambda: store.read(feed.table),
        )


def load_day(
    store: Store, feed: c.Feed, path: str, day: date, multiline: bool | None = None
) -> dict[str, int]:
    """One day's raw file into bronze that is partitioned by load date, and what follows from it.

    The day's partition is replaced, so loading a day twice changes nothing, and the files of
    other days stay. Accounts are then brought into silver, which rewrites only the parts
    with a key of that day; of transactions the day's state per customer is replaced. An
    account that a corrected file no longer has stays in silver.
    """
    with logged(store, f"{feed.name}_load") as log:
        store.ensure(feed.table)
        name = store.name(feed.table)
        loaded = lambda: store.read(feed.table).filter(F.col(LOAD_DATE) == F.lit(day))
        counts = _land(
            store, feed, path, multiline, log,
            lambda rows: replace_partitions(
                rows.withColumn(LOAD_DATE, F.lit(day)), name, LOAD_DATE, store.fmt
            ),
            loaded,
        )
        if feed.name == c.CARD_ACC.name:
            store.ensure(c.SILVER_CARD_ACC)
            rows = silver.silver_accounts(loaded())
            upsert_latest(
                rows, store.name(c.SILVER_CARD_ACC), ["account_id"], [LOAD_DATE, "_ingested_at"],
                fmt=store.fmt,
            )
        if feed.name == c.CARD_TXN.name:
            accounts = store.read(c.SILVER_CARD_ACC)
            store.ensure(CARD_STATE)
            typed = silver.silver_transactions(loaded(), accounts)
            day_state = state.moments(typed).withColumn(LOAD_DATE, F.lit(day))
            replace_partitions(day_state, store.name(CARD_STATE), LOAD_DATE, store.fmt)
        return counts


def card_state(store: Store) -> DataFrame:
    """The state of all loaded transactions per customer, from the states of the days."""
    return state.merge_moments(store.read(CARD_STATE).drop(LOAD_DATE))


def validate(store: Store, feed: c.Feed) -> DataFrame:
    """The report on a bronze table: computed once, stored, and also kept in the run log."""
    with logged(store, f"{feed.name}_bronze"):
        bronze = store.read(feed.table)
        quality.require_not_empty(bronze, feed.table)
        broken = store.read(malformed_table(feed)).count()
        report_rows = store.write(quality.report(bronze, feed, broken), f"{feed.table}_report")
        checks = report_rows.filter("check <> 'values'")
        store.write(runlog.from_checks(checks, f"{feed.name}_bronze"), c.RUN_LOG, "append")
        quality.require_columns(bronze, feed.required, feed.table)
        return report_rows


def masked(df: DataFrame, mask: bool) -> DataFrame:
    """Ids and addresses of the network reduced to their last characters."""
    sensitive = [x for x in c.SENSITIVE if mask and x in df.columns]
    return df.withColumns({x: mask_tail(x) for x in sensitive})


def build_silver(store: Store, mask: bool = True) -> None:
    """The four silver tables. Ids are masked after the shared-id flag has seen them."""
    with logged(store, "silver"):
        accounts = store.write(
            silver.silver_accounts(store.read(c.BRONZE_CARD_ACC)), c.SILVER_CARD_ACC
        )
        transactions = silver.silver_transactions(store.read(c.BRONZE_CARD_TXN), accounts)
        store.write_large(masked(transactions, mask), c.SILVER_CARD_TXN, "transaction_ts")
        applications = silver.silver_applications(store.read(c.BRONZE_LOAN_APP))
        store.write(masked(applications, mask), c.SILVER_LOAN_APP)
        repayments = silver.silver_repayments(store.read(c.BRONZE_LOAN_REP))
        store.write_large(repayments, c.SILVER_LOAN_REP, "due_date")


def build_features(
    store: Store, as_of: Column | None = None, card_rules: list[c.Rule] | None = None
) -> None:
    """Feature tables with scores. `as_of` ends the 30-day and 7-day windows (default: now).

    Cards are scored by `config.job_card_rules` unless `card_rules` gives others.
    """
    with logged(store, "features"):
        _build_features(store, F.current_timestamp() if as_of is None else as_of, card_rules)


def _build_features(store: Store, as_of: Column, card_rules: list[c.Rule] | None) -> None:
    card = f.card_feature_table(
        store.read(c.SILVER_CARD_TXN), store.read(c.SILVER_CARD_ACC), as_of
    )
    rules = c.job_card_rules() if card_rules is None else card_rules
    store.write(
        f.with_score(card, rules, "card_fraud_score", "card_risk_tier"), c.SILVER_CARD_FEATURES
    )
    loan = f.loan_features(store.read(c.SILVER_LOAN_APP), store.read(c.SILVER_LOAN_REP))
    store.write(
        f.with_score(loan, c.loan_rules(), "loan_fraud_score", "loan_risk_tier"),
        c.SILVER_LOAN_FEATURES,
        bucket_by="customer_id",
    )


def build_gold(
    store: Store, customers_path: str, mask: bool = True, multiline: bool | None = None
) -> None:
    """Scores, then alerts, then the customer view with its alert counts."""
    with logged(store, "gold"):
        customers = masked(customer_reference(store.spark, customers_path, multiline), mask)
        _build_gold(store, customers)


def _build_gold(store: Store, customers: DataFrame) -> None:
    per_account = store.read(c.SILVER_CARD_FEATURES)
    per_customer = f.one_account(per_account)
    card = store.write(
        scores.card_scores(per_customer), c.GOLD_CARD_SCORES, bucket_by="customer_id"
    )
    loan = store.write(
        scores.loan_scores(store.read(c.SILVER_LOAN_FEATURES)),
        c.GOLD_LOAN_SCORES,
        bucket_by="customer_id",
    )
    alerts = store.write(fraud_alerts(card, loan), c.GOLD_FRAUD_ALERTS)
    risk = customer_risk(customers, card, loan)
    activity = with_activity(
        risk, alerts, store.read(c.SILVER_CARD_TXN), store.read(c.SILVER_LOAN_APP)
    )
    store.write(activity, c.GOLD_CUSTOMER_RISK, bucket_by="customer_id")


def customer_reference(
    spark: SparkSession, path: str, multiline: bool | None = None
) -> DataFrame:
    """The customers file, one row per customer, typed, with an age where it gives none.

    Of repeated customers any one row is kept, but the same on every run. `multiline=None`
    allows line breaks in fields only if the file has malformed rows without them.
    """
    if multiline is None:
        multiline = has_malformed_rows(spark, path)
    raw = dedup_latest(read_raw(spark, path, multiline), ["customer_id"], [])
    df = parse_dates(
        cast_columns(raw, {"age": "int", "stated_income": "double"}), ["date_of_birth"]
    )
    return df.withColumn(
        "age", F.coalesce("age", signals.age("date_of_birth", F.current_date()))
    )


def export_all(store: Store, folder: str, single_file: bool = False) -> None:
    """The four gold tables and the KPI row as CSV, one folder each.

    Tables are written in parts, or, with `single_file`, as one file by one task.
    """
    risk, alerts = store.read(c.GOLD_CUSTOMER_RISK), store.read(c.GOLD_FRAUD_ALERTS)
    views = {
        "customer_risk": (risk, report.CUSTOMER_RISK),
        "fraud_alerts": (alerts, report.FRAUD_ALERTS),
        "card_scores": (store.read(c.GOLD_CARD_SCORES), report.CARD_SCORES),
        "loan_scores": (store.read(c.GOLD_LOAN_SCORES), report.LOAN_SCORES),
    }
    for name in ("customer_risk", "fraud_alerts"):
        quality.require_not_empty(views[name][0], name)
    for name, (df, columns) in views.items():
        write_csv(report.export_view(df, columns), f"{folder}/{name}", single_file)
    write_csv(report.kpi_summary(risk, alerts), f"{folder}/kpi_summary", True)


def run_all(
    store: Store,
    source: str,
    export_to: str | None = None,
    multiline: bool | None = None,
    mask: bool = True,
    as_of: Column | None = None,
    card_rules: list[c.Rule] | None = None,
    single_file: bool = False,
) -> DataFrame:
    """Everything, from the raw files in `source` to gold; returns the stored reports.

    Each stage logs its start and its end or failure, and a failure stops the run. At
    the end the run log is searched for errors since the run began.
    """
    began = datetime.now(timezone.utc)
    reports = []
    for feed in c.FEEDS.values():
        ingest(store, feed, f"{source}/{feed.file}", multiline)
        reports.append(validate(store, feed).withColumn("feed", F.lit(feed.name)))
    build_silver(store, mask)
    build_features(store, as_of, card_rules)
    build_gold(store, f"{source}/customers.csv", mask, multiline)
    if export_to:
        with logged(store, "export"):
            export_all(store, export_to, single_file)
    stages = [f"{feed}_{stage}" for feed in c.FEEDS for stage in ("ingest", "bronze")]
    log = store.read(c.RUN_LOG).filter(F.col("log_timestamp") >= F.lit(began))
    runlog.gate_all(log, [*stages, "silver", "features", "gold", "export"])
    return reduce(DataFrame.unionByName, reports)
