"""Transactions per customer in sliding windows of event time, as they arrive.

The streaming form of the 10-minute and 1-hour velocity: windows of `length` that begin
every `slide`. A window is final when the watermark, `late_by` behind the latest time seen,
has passed its end; rows that come later than that are dropped and counted by Spark as
dropped by the watermark. State holds open windows only, so it is bounded by the customers
active in `length` + `late_by`, and survives a restart in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow.operators.transactions import _micros


def read_transactions(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files: int | None = None
) -> DataFrame:
    """A stream of the files of a folder, at most `files` of them in a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.load(path)


def windowed_counts(
    txn: DataFrame,
    length: str = "1 hour",
    slide: str = "10 minutes",
    late_by: str = "1 hour",
    customer: str = "customer_id",
    ts: str = "transaction_ts",
) -> DataFrame:
    """(customer, window_start, window_end, txn_count, declined_count) of each window with rows.

    The same on a stream and on a table, where nothing is late. Windows include their start
    and not their end; rows without a time or customer are left out. A zoneless time, which
    no watermark can be on, is taken as its own clock's and given back as such.
    """
    zoneless = txn.schema[ts].dataType == T.TimestampNTZType()
    timed = txn.filter(F.col(ts).isNotNull() & F.col(customer).isNotNull())
    if zoneless:
        timed = timed.withColumn(ts, F.timestamp_micros(_micros(txn, ts)))
    if timed.isStreaming:
        timed = timed.withWatermark(ts, late_by)
    counted = timed.groupBy(F.window(ts, length, slide), customer).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.count_if(F.col("status") == "declined").alias("declined_count"),
    )
    edge = _own_clock if zoneless else F.col
    return counted.select(
        customer,
        edge("window.start").alias("window_start"),
        edge("window.end").alias("window_end"),
        "txn_count",
        "declined_count",
    )


def _own_clock(instant: str) -> Column:
    """The zoneless time that shows an instant's clock in UTC, in any session's zone."""
    seconds = F.unix_seconds(instant)
    day = F.floor(seconds / 86_400).cast("int")
    within = (seconds - day.cast("bigint") * 86_400).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(day, F.lit(0), F.lit(0), within)


def write_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append final windows to a Parquet folder, each once, and stop when all input is read."""
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows of windows (one for each window of a row) that came too late, so far."""
    states = [s for p in query.recentProgress for s in p.stateOperators]
    return sum(s.numRowsDroppedByWatermark for s in states)
