"""Commute bonus and wellness days."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foulee.functions.numeric import money
from foulee.operators.lookup import keep_one
from foulee.settings import Rules


def calculation_date(rules: Rules) -> Column:
    return F.current_date() if rules.as_of is None else F.lit(rules.as_of)


def activity_counts(activities: DataFrame) -> DataFrame:
    """Per employee: ``nb_activites`` counts activities with an id, ``nb_lignes`` counts rows."""
    return activities.groupBy("id_salarie").agg(
        F.count("id").alias("nb_activites"), F.count(F.lit(1)).alias("nb_lignes")
    )


def gold_benefits(
    employees: DataFrame,
    activities: DataFrame,
    rules: Rules = Rules(),
    only_valid: bool = False,
    since: dt.date | None = None,
) -> DataFrame:
    """Benefits per silver employee, one row each.

    The bonus needs a verdict of true and an active mode; its amount is rounded to cents in
    decimal. All activities count unless ``only_valid`` (needs ``activite_valide``) or ``since``
    narrows them. Employees and counts are both grouped by id, so the join adds no shuffle of
    its own when the employees arrive grouped.
    """
    if only_valid:
        activities = activities.filter("activite_valide")
    if since is not None:
        activities = activities.filter(F.col("date_debut") >= F.lit(since))
    counts = activity_counts(activities).select("id_salarie", "nb_activites")
    eligible = F.col("declaration_ok") & F.col("moyen_deplacement").isin(*rules.active_modes)
    amount = F.when(
        eligible, F.round(money(F.col("salaire_brut"), rules.bonus_rate), 2).cast("double")
    ).otherwise(0.0)
    return (
        employees.join(counts, "id_salarie", "left")
        .fillna({"nb_activites": 0})
        .select(
            "id_salarie",
            (amount > 0).alias("prime_sportive"),
            amount.alias("montant_prime"),
            F.when(F.col("nb_activites") >= rules.wellness_threshold, rules.wellness_days)
            .otherwise(0)
            .alias("jours_bienetre"),
            "nb_activites",
            calculation_date(rules).alias("date_calcul"),
        )
    )


def gold_benefits_lenient(employees: DataFrame, activities: DataFrame, rules: Rules) -> DataFrame:
    """The all-in-one variant: an open verdict counts as accepted, the flag comes first, the
    amount is not rounded and wellness is a flag.

    ``employees`` carries ``declaration_ok`` and one row per id; every activity row counts.
    """
    counts = activity_counts(activities).select("id_salarie", "nb_lignes")
    eligible = F.coalesce("declaration_ok", F.lit(True)) & F.col("moyen_deplacement").isin(
        *rules.active_modes
    )
    nb = F.coalesce("nb_lignes", F.lit(0))
    return employees.join(counts, "id_salarie", "left").select(
        "id_salarie",
        eligible.alias("prime_sportive"),
        F.when(eligible, money(F.col("salaire_brut"), rules.bonus_rate).cast("double"))
        .otherwise(0.0)
        .alias("montant_prime"),
        (nb >= rules.wellness_threshold).alias("jours_bienetre"),
        nb.cast("int").alias("nb_activites"),
        calculation_date(rules).alias("date_calcul"),
    )


def apply_rate(benefits: DataFrame, employees: DataFrame, rate: Decimal, unique: bool = False) -> DataFrame:
    """Benefits with the bonus recomputed at ``rate`` wherever one is granted and the employee
    is known; the other rows are unchanged. The new amount is not rounded. ``unique``: employees
    have one row per id already, as silver employees do."""
    salaries = employees.select("id_salarie", F.col("salaire_brut").alias("_salaire"))
    salaries = (salaries if unique else keep_one(salaries, ["id_salarie"])).withColumn("_connu", F.lit(True))
    rerated = F.col("prime_sportive") & F.col("_connu")
    amount = F.when(rerated, money(F.col("_salaire"), rate).cast("double")).otherwise(F.col("montant_prime"))
    return (
        benefits.join(salaries, "id_salarie", "left")
        .withColumn("montant_prime", amount)
        .select(*benefits.columns)
    )


def restore_rate(
    benefits: DataFrame, employees: DataFrame, rules: Rules = Rules(), unique: bool = False
) -> DataFrame:
    """Back to the configured rate."""
    return apply_rate(benefits, employees, rules.bonus_rate, unique)
