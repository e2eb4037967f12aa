"""Bonus rates applied to a stored table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foulee.operators.benefits import apply_rate
from foulee.sinks.lake import merge_rows
from foulee.sources.lake import Lake


def rerate_table(
    spark: SparkSession, lake: Lake, table: str, employees: DataFrame, rate: Decimal, unique: bool = False
) -> tuple[int, int]:
    """``apply_rate`` in place: only files that hold a granted bonus of a known employee are rewritten. How many files
    were rewritten and how many kept. A table clustered by ``prime_sportive`` keeps all files without a bonus."""
    known = employees.select("id_salarie").filter("id_salarie is not null")
    return merge_rows(
        spark, lake, table, known, lambda rows: apply_rate(rows, employees, rate, unique), where=F.col("prime_sportive")
    )
