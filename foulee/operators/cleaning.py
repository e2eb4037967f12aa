"""Employee and activity cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foulee.operators.lookup import keep_one
from foulee.reference import RUNNING, RUNNING_ALIAS
from foulee.settings import Rules


def clean_employees(employees: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Employees with an id, a positive salary and a known contract, one row per id."""
    valid = employees.filter(
        F.col("id_salarie").isNotNull()
        & (F.col("salaire_brut") > 0)
        & F.col("type_contrat").isin(*rules.contracts)
    )
    return keep_one(valid, ["id_salarie"])


def clean_activities(activities: DataFrame) -> DataFrame:
    """Activities with a sport, a duration, both dates and no negative distance, one row per
    (id, employee, start)."""
    valid = activities.filter(
        F.col("type_sport").isNotNull()
        & (F.col("temps_ecoule_s") > 0)
        & F.col("date_debut").isNotNull()
        & F.col("date_fin").isNotNull()
        & (F.col("distance_m").isNull() | (F.col("distance_m") >= 0))
    )
    sport = F.when(F.col("type_sport") == RUNNING_ALIAS, RUNNING).otherwise(F.col("type_sport"))
    return keep_one(valid.withColumn("type_sport", sport), ["id", "id_salarie", "date_debut"])


def employee_sport_profile(employees: DataFrame, declared_sports: DataFrame) -> DataFrame:
    """Each employee once, with one declared sport if there is any.

    Both inputs may repeat an id. Reducing each on its own before the join gives what joining
    and then deduplicating would, without the fan-out in between. Both are stacked and grouped
    once: one shuffle serves the two reductions and the join, and a null id pairs with a null id.
    """
    others = [name for name in employees.columns if name != "id_salarie"]
    row_type = employees.select(F.struct(*others).alias("salarie")).schema["salarie"].dataType
    stacked = employees.select(
        "id_salarie", F.struct(*others).alias("salarie"), F.lit(None).cast("string").alias("sport")
    ).unionByName(
        declared_sports.select("id_salarie", F.lit(None).cast(row_type).alias("salarie"), "sport")
    )
    paired = stacked.groupBy("id_salarie").agg(
        F.min("salarie").alias("salarie"), F.min("sport").alias("sport")
    )
    return paired.filter(F.col("salarie").isNotNull()).select(
        *[F.col(n) if n == "id_salarie" else F.col("salarie")[n].alias(n) for n in employees.columns], "sport"
    )
