"""Text clean-up and casts that give NULL, not an error, on bad input."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def cast_columns(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast columns in place, e.g. ``{"amount": "double"}``.

    What isn't a number becomes NULL, and so do the texts for NaN and infinity, which a
    cast would let through: one of them would spoil every mean of its customer.
    """
    return df.withColumns({c: _finite(F.col(c).try_cast(t), t) for c, t in casts.items()})


def _finite(value: Column, kind: str) -> Column:
    if kind not in ("double", "float"):
        return value
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def parse_dates(df: DataFrame, columns: Iterable[str], fmt: str = DATE_FORMAT) -> DataFrame:
    return df.withColumns({c: F.try_to_date(F.col(c), fmt) for c in columns})


def parse_timestamps(
    df: DataFrame, columns: Iterable[str], fmt: str = TIMESTAMP_FORMAT
) -> DataFrame:
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(fmt)) for c in columns})


def combine_date_time(date: str, time: str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Timestamp from a date text and a time text; NULL if either is."""
    return F.try_to_timestamp(F.concat(F.col(date), F.lit(" "), F.col(time)), F.lit(fmt))


def codes_upper(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.upper(F.trim(F.col(c))) for c in columns})


def labels_lower(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.lower(F.trim(F.col(c))) for c in columns})


def drop_nulls_in(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def mask_tail(column: str, keep: int = 4) -> Column:
    """Show only the last `keep` characters: ``****1234``."""
    return F.concat(F.lit("****"), F.right(F.col(column).cast("string"), F.lit(keep)))


def fill_defaults(
    df: DataFrame, numeric: Iterable[str] = (), flags: Iterable[str] = ()
) -> DataFrame:
    """NULL numbers become 0 and NULL flags become False."""
    numeric, flags = list(numeric), list(flags)
    if numeric:
        df = df.fillna(0, subset=numeric)
    if flags:
        df = df.fillna(False, subset=flags)
    return df
