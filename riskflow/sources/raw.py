"""Raw CSV feeds: every column a string, tagged with when and where it came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Holds the text of a row that doesn't have just the columns of the header.
MALFORMED = "_malformed"


def read_raw(
    spark: SparkSession,
    path: str,
    multiline: bool = False,
    columns: Sequence[str] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Read CSV with a header, all columns as strings.

    Columns are `columns`, by default those of the first file's header. Every file has
    to have just these, in this order: a header that differs fails the read, so that no
    value ends up under another name. Files are split among tasks, however large.
    `multiline` lets a quoted field contain line breaks, which makes each file one task.

    A row with too few or too many fields keeps what fits. `malformed` names a column that
    then holds the row's text, and is NULL for sound rows; read line by line, a field with
    a line break makes malformed rows of its row's lines.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multiline)
        .option("escape", '"')
    )
    names = reader.csv(path).columns if columns is None else columns
    if malformed is not None:
        names = [*names, malformed]
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
    raw = reader.schema(schema).option("enforceSchema", False).csv(path)
    if malformed is None:
        return raw
    # Only a row of which all fields are read is known to be malformed, so this column asks
    # for all of them. The condition always holds, yet is no constant.
    all_read = F.hash(*[c for c in raw.columns if c != malformed]).bitwiseAND(F.lit(0)) == 0
    return raw.withColumn(malformed, F.when(all_read, F.col(malformed)))


def has_malformed_rows(spark: SparkSession, path: str, multiline: bool = False) -> bool:
    """Whether any row hasn't just the columns of the header."""
    raw = read_raw(spark, path, multiline, malformed=MALFORMED)
    return not raw.filter(F.col(MALFORMED).isNotNull()).isEmpty()


def with_ingest_metadata(
    df: DataFrame, source: str | None = None, as_of: Column | None = None
) -> DataFrame:
    """Add `_ingested_at` and `_source_file`.

    Without `source` each row carries the name of the file it was read from.
    """
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp() if as_of is None else as_of,
            "_source_file": F.col("_metadata.file_name") if source is None else F.lit(source),
        }
    )
