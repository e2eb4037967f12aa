"""Layer and monitoring reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foulee.operators.benefits import calculation_date
from foulee.settings import Rules


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """Put one-row aggregates of different tables side by side without joining them."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def _rows(df: DataFrame, name: str, **measures: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name), *[m.alias(n) for n, m in measures.items()])


def silver_report(
    bronze_employees: DataFrame,
    bronze_activities: DataFrame,
    silver_employees: DataFrame,
    silver_activities: DataFrame,
    rules: Rules = Rules(),
) -> DataFrame:
    """Row counts before and after cleaning, valid and invalid activities, verdicts by state.
    One aggregate per table."""
    verdict = F.col("declaration_ok")
    return _one_row(
        [
            _rows(bronze_employees, "salaries_bronze"),
            _rows(bronze_activities, "activites_bronze"),
            _rows(
                silver_employees,
                "salaries_silver",
                deplacement_actif=F.count_if(F.col("moyen_deplacement").isin(*rules.active_modes)),
                declaration_ok=F.count_if(verdict),
                declaration_ko=F.count_if(~verdict),
                declaration_nulle=F.count_if(verdict.isNull()),
                bu_valides=F.count_if(F.col("bu_valide")),
            ),
            _rows(
                silver_activities,
                "activites_silver",
                activites_valides=F.count_if(F.col("activite_valide")),
                activites_invalides=F.count_if(~F.col("activite_valide")),
            ),
        ]
    )


def monitoring_report(
    employees: DataFrame, activities: DataFrame, benefits: DataFrame, rules: Rules = Rules()
) -> DataFrame:
    """One row of totals. Wellness counts people, whatever number of days they get."""
    totals = _one_row(
        [
            _rows(employees, "nb_salaries"),
            _rows(activities, "nb_activites"),
            benefits.agg(
                F.count_if(F.col("prime_sportive")).alias("nb_primes"),
                F.count_if(F.col("jours_bienetre") > 0).alias("nb_bienetre"),
                F.coalesce(
                    F.sum(F.col("montant_prime").cast("decimal(18,4)")).cast("double"), F.lit(0.0)
                ).alias("cout_primes"),
            ),
        ]
    )
    return totals.withColumn("date_rapport", calculation_date(rules))
