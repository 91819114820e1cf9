"""Checks and summaries of a table: one pass each, results as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskflow.config import Feed


# --- gates: raise at once -------------------------------------------------------
def require_not_empty(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: Sequence[str], name: str) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{name} lacks columns: {', '.join(missing)}")
    return df


# --- counts: each one aggregate over the table -----------------------------------
def _as_rows(df: DataFrame, counts: dict[tuple[str, str], Column]) -> DataFrame:
    """Aggregate all `counts` in one pass; one row (check, column, value) for each."""
    cells = {f"_{i}": value for i, value in enumerate(counts.values())}
    one = df.agg(*[value.cast("bigint").alias(name) for name, value in cells.items()])
    rows = [
        F.struct(
            F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(name).alias("value")
        )
        for name, (check, column) in zip(cells, counts, strict=True)
    ]
    return one.select(F.inline(F.array(*rows)))


def _blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column).cast("string") == "")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs in every column: (column, null_count)."""
    wanted = df.columns if columns is None else list(columns)
    counts = {("nulls", c): F.count_if(F.col(c).isNull()) for c in wanted}
    return _as_rows(df, counts).select("column", F.col("value").alias("null_count"))


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL or empty values in each of `columns`: (column, blank_count)."""
    counts = {("blanks", c): F.count_if(_blank(c)) for c in columns}
    return _as_rows(df, counts).select("column", F.col("value").alias("blank_count"))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys (NULL counts as one) and rows beyond the first per key.

    Keys are counted per key first, so a hot key is combined before the shuffle.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    distinct = F.count(F.lit(1))
    return per_key.agg(
        total.alias("total_rows"),
        distinct.alias("distinct_keys"),
        (total - distinct).alias("duplicates"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of rows of each table: (table, rows)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def observed(df: DataFrame, key: str, malformed: str) -> tuple[DataFrame, Observation]:
    """`df`, and the counts of what passes when it is written: rows, malformed, null_keys.

    NULL keys are those of sound rows. Without a key column there are none.
    """
    seen = Observation()
    sound = F.col(malformed).isNull()
    no_key = F.col(key).isNull() if key in df.columns else F.lit(False)
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~sound).alias("malformed"),
        F.count_if(sound & no_key).alias("null_keys"),
    )
    return counted, seen


def profile(df: DataFrame, feed: Feed) -> DataFrame:
    """The checks on a raw feed: (check, column, value, status).

    Checks: rows, duplicate keys, NULL keys, blanks in critical columns, missing columns,
    and the NULLs of every column, which are for information. Of the others a count
    above zero is a warning, a missing column or an empty table an error. A
    column that is missing has no other checks. One pass without a shuffle counts all
    but the duplicates; only keys are shuffled for those.
    """
    counts = {("rows", ""): F.count(F.lit(1))}
    for c in df.columns:
        counts["nulls", c] = F.count_if(F.col(c).isNull())
    if feed.key in df.columns:
        counts["null_keys", feed.key] = F.count_if(F.col(feed.key).isNull())
    for c in feed.critical:
        if c in df.columns:
            counts["blanks", c] = F.count_if(_blank(c))
    missing = missing_columns(df, feed.required)
    for c in feed.required:
        counts["missing_column", c] = F.lit(int(c in missing))
    checks = _as_rows(df, counts)
    if feed.key in df.columns:
        repeated = duplicate_count(df, feed.key).select(
            F.lit("duplicate_keys").alias("check"),
            F.lit(feed.key).alias("column"),
            F.col("duplicates").alias("value"),
        )
        checks = checks.unionByName(repeated)
    found = F.col("value") > 0
    status = (
        F.when(F.col("check") == "rows", F.when(found, "OK").otherwise("ERROR"))
        .when(~found | (F.col("check") == "nulls"), "OK")
        .when(F.col("check") == "missing_column", "ERROR")
        .otherwise("WARNING")
    )
    return checks.withColumn("status", status)


def report(df: DataFrame, feed: Feed, malformed: int | None = None) -> DataFrame:
    """`profile`, and how often each value of the feed's breakdown columns occurs.

    A frequency is a row with the check `values` and the value in `detail`, which is NULL
    in all other rows and for a NULL value. `malformed` is the number of rows that were
    kept apart when the feed was read; above zero it is a warning.
    """
    checks = profile(df, feed)
    if malformed is not None:
        status = "WARNING" if malformed else "OK"
        row = [("malformed_rows", "", malformed, status)]
        checks = checks.unionByName(df.sparkSession.createDataFrame(row, checks.schema))
    checks = checks.withColumn("detail", F.lit(None).cast("string"))
    present = [c for c in feed.breakdowns if c in df.columns]
    if not present:
        return checks
    found = breakdowns(df, present).select(
        F.lit("values").alias("check"),
        "column",
        F.col("count").alias("value"),
        F.lit("OK").alias("status"),
        F.col("value").alias("detail"),
    )
    return checks.unionByName(found)


# --- summaries --------------------------------------------------------------------
def breakdown(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of `column`, most frequent first."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), F.asc(column))


def breakdowns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each of `columns`, in one pass: (column, value, count)."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(cells))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Smallest, largest and mean value, and the number of rows."""
    return df.agg(
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
        F.avg(column).alias("avg_value"),
        F.count(F.lit(1)).alias("rows"),
    )


def top(df: DataFrame, by: str, n: int, columns: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The `n` rows greatest on `by`; ties go to the smallest `tie` values."""
    return df.orderBy(F.desc(by), *[F.asc(c) for c in tie]).limit(n).select(*columns)


def outliers(
    txn: DataFrame, n: int = 10, above: float = 2.0, zscore: str = "amount_zscore"
) -> DataFrame:
    """The `n` transactions with the largest z-score above a bound."""
    return top(
        txn.filter(F.col(zscore) > above), zscore, n,
        ["transaction_id", "customer_id", "amount", zscore], ["transaction_id"],
    )
