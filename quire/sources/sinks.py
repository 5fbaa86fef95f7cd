"""Results out: tables as Parquet, one JSON report for each document."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reports say null where there is nothing, so null members are kept.
JSON_OPTIONS = {"ignoreNullFields": "false"}


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def report_column(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns), JSON_OPTIONS)


def write_reports(df: DataFrame, path: str, *columns: str) -> None:
    """One line of JSON for each row."""
    df.select(report_column(*(columns or df.columns)).alias("value")).write.mode("overwrite").text(path)


def one_report(df: DataFrame, *columns: str) -> str:
    """The only row of ``df`` as indented JSON text."""
    rows = df.select(report_column(*(columns or df.columns)).alias("value")).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a report is one row")
    return json.dumps(json.loads(rows[0].value), ensure_ascii=False, indent=2)


def write_text(path: str | Path, report: str) -> None:
    Path(path).write_text(report + "\n", encoding="utf-8")


def write_one_report(df: DataFrame, path: str | Path, *columns: str) -> None:
    write_text(path, one_report(df, *columns))
