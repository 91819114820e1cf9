"""CSV exports with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write `df` as CSV under the folder `path`, replacing what is there.

    Quotes are doubled and white space is kept, as CSV readers expect. Parts are written
    side by side. `single_file` asks for one part, at any size: one
    task then writes all rows, streaming them, so it is meant for small tables.
    """
    if single_file:
        # The rows are computed by many tasks and only written by one.
        df = df.repartition(1)
    exact = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").option("header", True).options(**exact).csv(path)
