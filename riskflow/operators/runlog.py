"""An append-only table of run messages and check results, and its summary."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.sources.tables import write_table

INFO, WARNING, ERROR = "INFO", "WARNING", "ERROR"
SCHEMA = "pipeline string, level string, message string, log_timestamp timestamp"


class RunLog:
    """Collects the messages of one run and appends them in one write."""

    def __init__(self, pipeline: str):
        self.pipeline = pipeline
        self.entries: list[tuple[str, str, str, datetime]] = []

    def add(self, level: str, message: str, at: datetime | None = None) -> None:
        if level not in (INFO, WARNING, ERROR):
            raise ValueError(f"unknown level {level!r}")
        at = at or datetime.now(timezone.utc)
        self.entries.append((self.pipeline, level, message, at))

    def info(self, message: str) -> None:
        self.add(INFO, message)

    def warning(self, message: str) -> None:
        self.add(WARNING, message)

    def error(self, message: str) -> None:
        self.add(ERROR, message)

    def append(self, spark: SparkSession, table: str, fmt: str = "parquet") -> None:
        """Append the collected entries to `table` (a folder if it has a slash)."""
        if self.entries:
            rows = spark.createDataFrame(self.entries, SCHEMA).coalesce(1)
            write_table(rows, table, "append", fmt)
            self.entries = []


def from_checks(checks: DataFrame, pipeline: str, as_of: Column | None = None) -> DataFrame:
    """Check results (check, column, value, status) as log rows; OK becomes INFO."""
    where = F.when(F.col("column") != "", F.concat(F.lit(" in "), F.col("column"))).otherwise("")
    return checks.select(
        F.lit(pipeline).alias("pipeline"),
        F.when(F.col("status") == "OK", INFO).otherwise(F.col("status")).alias("level"),
        F.concat(F.col("check"), where, F.lit(": "), F.col("value")).alias("message"),
        (F.current_timestamp() if as_of is None else as_of).alias("log_timestamp"),
    )


def recent(
    log: DataFrame, pipeline: str, hours: int = 1, as_of: Column | None = None
) -> DataFrame:
    """Entries of `pipeline` in the `hours` up to and including `as_of` (default: now)."""
    as_of = F.current_timestamp() if as_of is None else as_of
    since = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    return log.filter(
        (F.col("pipeline") == pipeline) & F.col("log_timestamp").between(since, as_of)
    )


def summary(
    log: DataFrame, pipeline: str, hours: int = 1, as_of: Column | None = None
) -> DataFrame:
    """Recent entries per level, ordered by level."""
    counted = recent(log, pipeline, hours, as_of).groupBy("level")
    return counted.agg(F.count(F.lit(1)).alias("count")).orderBy("level")


def error_count(
    log: DataFrame, pipeline: str, hours: int = 1, as_of: Column | None = None
) -> DataFrame:
    """One row: `errors`, the recent entries of level ERROR."""
    return recent(log, pipeline, hours, as_of).agg(
        F.count_if(F.col("level") == ERROR).alias("errors")
    )


def gate_all(log: DataFrame, pipelines: Sequence[str]) -> None:
    """Raise if any of `pipelines` has an error in `log`; names those that have."""
    failed = log.filter(F.col("pipeline").isin(list(pipelines)) & (F.col("level") == ERROR))
    names = [r["pipeline"] for r in failed.select("pipeline").distinct().collect()]
    if names:
        raise RuntimeError(f"errors in the run log of {', '.join(sorted(names))}")


def gate(log: DataFrame, pipeline: str, hours: int = 1, as_of: Column | None = None) -> None:
    """Raise if `pipeline` logged an error recently."""
    errors = error_count(log, pipeline, hours, as_of).first()["errors"]
    if errors:
        raise RuntimeError(f"{pipeline}: {errors} error(s) in the run log")
