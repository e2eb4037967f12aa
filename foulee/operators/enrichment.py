"""Reference joins: sport category and business unit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foulee.operators.lookup import left_lookup


def enrich_activities(activities: DataFrame, sport_reference: DataFrame) -> DataFrame:
    """Add category and minimum duration; an activity is valid when its sport is known and it
    lasted long enough. An unknown sport gives false, not null."""
    reference = sport_reference.select("type_sport", "categorie", "duree_min_s")
    return left_lookup(activities, reference, ["type_sport"]).withColumn(
        "activite_valide",
        F.col("categorie").isNotNull() & (F.col("temps_ecoule_s") >= F.col("duree_min_s")),
    )


def check_business_units(employees: DataFrame, business_units: DataFrame) -> DataFrame:
    """Add ``bu_valide``: whether the employee's business unit is in the reference."""
    reference = business_units.select("bu", F.lit(True).alias("bu_connue"))
    return left_lookup(employees, reference, ["bu"], spread_by=["id_salarie"]).select(
        *employees.columns, F.col("bu_connue").isNotNull().alias("bu_valide")
    )
