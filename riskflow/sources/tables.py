"""Table scans and sinks, and cutting lineage in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.dedup import dedup_latest

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Average buckets that one key may fill in a bucketed table.
HOT_BUCKETS = 2


def read_table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """Read a table by name, or a folder if `name` contains a slash."""
    if "/" in name:
        return spark.read.format(fmt).load(name)
    return spark.table(name)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    bucket_by: str | None = None,
    buckets: int = 0,
) -> None:
    """Write a table (or a folder if `name` contains a slash): overwrite or append.

    A catalog table can be bucketed, so that later joins and aggregates on that
    column read it without a shuffle. Rows are spread by the column first, which
    leaves one file per bucket; use it for tables with few rows per key.
    """
    bucketed = bucket_by is not None and buckets > 0 and "/" not in name
    if bucketed:
        df = df.repartition(buckets, bucket_by)
    writer = df.write.format(fmt).mode(mode)
    if bucketed:
        writer = writer.bucketBy(buckets, bucket_by)
    if "/" in name:
        writer.save(name)
    else:
        writer.saveAsTable(name)


def write_bucketed(
    df: DataFrame, name: str, key: str, sort_by: str, buckets: int, fmt: str = "parquet"
) -> bool:
    """Write a catalog table bucketed by `key` and sorted by it and `sort_by`; True if it is.

    A bucket is read by one task. If a key alone (NULL counts as one) has more rows than
    `HOT_BUCKETS` average buckets, the table is written without buckets instead: a shuffle
    combines its rows where they lie, and salted joins spread them. Rows are spread by
    bucket before they are written, large buckets over several tasks and files.
    """
    rows = stored(df, "bucketed")
    total = rows.count()
    largest = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    writer = rows.write
    bucketed = largest <= max(1, HOT_BUCKETS * total // buckets)
    if bucketed:
        # The same hash that Spark deals rows into buckets by.
        bucket = F.pmod(F.hash(key), F.lit(buckets))
        spread = rows.withColumn("_bucket", bucket).hint("rebalance", F.col("_bucket"))
        writer = spread.drop("_bucket").write.bucketBy(buckets, key).sortBy(key, sort_by)
    writer.format(fmt).mode("overwrite").saveAsTable(name)
    return bucketed


def table_exists(spark: SparkSession, name: str, fmt: str = "parquet") -> bool:
    """Whether a table, or a folder if `name` contains a slash, can be read."""
    if "/" not in name:
        return spark.catalog.tableExists(name)
    try:
        spark.read.format(fmt).load(name)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def replace_partitions(df: DataFrame, name: str, partition: str, fmt: str = "parquet") -> None:
    """Write `df`, replacing just those partitions of the table that it has rows for.

    The table is made where there is none. Others keep their files, and writing the same
    rows again changes nothing. A table with the partitions' rows must not be read by `df`.
    """
    spark = df.sparkSession
    df = df.select(*[c for c in df.columns if c != partition], partition)
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if "/" in name:
        writer.partitionBy(partition).save(name)
    elif table_exists(spark, name):
        df.select(*spark.table(name).columns).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).insertInto(name)
    else:
        writer.partitionBy(partition).saveAsTable(name)


def upsert_latest(
    rows: DataFrame,
    name: str,
    key: Sequence[str],
    latest: Sequence[str | Column],
    parts: int = 64,
    fmt: str = "parquet",
) -> list[int]:
    """Bring `rows` into a table that keeps the latest row of each key; the parts written.

    The table is partitioned by `_part`, the key's hash modulo `parts` (always the same
    number). Only parts with a key among `rows` are read, merged and written again; so a
    load costs what it touches, and loading the same rows twice changes nothing.
    """
    spark = rows.sparkSession
    part = F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")
    rows = rows.withColumn("_part", part)
    touched = sorted(r[0] for r in rows.select("_part").distinct().collect())  # at most `parts`
    if not touched:
        return []
    if table_exists(spark, name, fmt):
        old = read_table(spark, name, fmt).filter(F.col("_part").isin(touched))
        rows = old.unionByName(rows)
    kept = dedup_latest(rows, key, latest)
    # Stored first: the table is both read and written.
    replace_partitions(stored(kept, "upsert").hint("rebalance", F.col("_part")), name, "_part", fmt)
    return touched


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, seen by the driver and all executors.

    That is the one named in `spark.checkpoint.dir`, or, where none is set, a folder in
    the warehouse, which they share as well. Never a machine's own temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read back, which cuts its lineage.

    Unlike a checkpoint it is compressed, and Spark knows its size when it plans joins.
    The files outlive the session; clear the folder when nothing reads them any more.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder's checkpoint and read back, safe against lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
