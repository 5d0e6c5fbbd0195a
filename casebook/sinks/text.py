"""Delimited text and line sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from casebook.sources.landing import CSV_DIALECT


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with header in the dialect the landing scan reads, one file per partition."""
    df.write.mode("overwrite").csv(
        path,
        compression=compression,
        header=True,
        quote=CSV_DIALECT["quote"],
        escape=CSV_DIALECT["escape"],
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_single_csv(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """One CSV file. Only for report tables, whose size does not grow with the data."""
    one = df.coalesce(1)
    if order_by:
        one = one.sortWithinPartitions(order_by).drop(order_by)
    write_csv(one, path)


def write_lines(lines: DataFrame, path: str, order_by: str = "line_no", text: str = "line") -> None:
    """One text file of ordered lines, for reports."""
    lines.coalesce(1).sortWithinPartitions(order_by).select(text).write.mode("overwrite").text(path)
