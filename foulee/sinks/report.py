"""Report files."""

from pyspark.sql import DataFrame


def write_csv_report(report: DataFrame, path: str) -> None:
    """A report of a few rows as one CSV file with a header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
