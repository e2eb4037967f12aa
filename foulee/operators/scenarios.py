"""What-if scenarios on the bonus rate."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rates compared, in percent, the one in force, and the mark of the selected one.
COMPARED_RATES = (3, 5, 8, 10, 15)
REFERENCE_RATE = 5
SELECTED_MARK = "<-- Selectionne"


def _eligible(benefits: DataFrame, employees: DataFrame) -> DataFrame:
    """Benefits of known employees reduced to what the totals need."""
    salaries = employees.select("id_salarie", F.col("salaire_brut").cast("decimal(12,2)").alias("salaire"))
    return benefits.select("id_salarie", "prime_sportive", "jours_bienetre").join(salaries, "id_salarie")


def _payroll() -> Column:
    """Gross salaries of the bonus holders; null when there is none."""
    return F.sum(F.when(F.col("prime_sportive"), F.col("salaire")))


def _at_percent(amount: Column, percent: Column) -> Column:
    return (amount.cast("decimal(30,2)") * percent.cast("decimal(5,0)") / F.lit(Decimal(100))).cast("double")


def scenario_summary(benefits: DataFrame, employees: DataFrame, percent: int) -> DataFrame:
    """Bonus holders, total and mean cost at ``percent``, the gap to the rate in force, and the
    number of people with wellness days. Empty totals are 0."""
    totals = _eligible(benefits, employees).agg(
        F.count_if(F.col("prime_sportive")).alias("nb_primes"),
        F.count_if(F.col("jours_bienetre") > 0).alias("nb_bienetre"),
        _payroll().alias("masse"),
        F.count(F.when(F.col("prime_sportive"), F.col("salaire"))).alias("nb_salaires"),
    )
    cost = F.coalesce(_at_percent(F.col("masse"), F.lit(percent)), F.lit(0.0))
    if percent == REFERENCE_RATE:
        reference = cost
    else:
        reference = cost * F.lit(float(REFERENCE_RATE)) / F.lit(float(percent))
    return totals.select(
        F.lit(percent).alias("taux_pct"),
        "nb_primes",
        cost.alias("cout_total"),
        F.coalesce(F.try_divide(cost, F.col("nb_salaires")), F.lit(0.0)).alias("prime_moyenne"),
        "nb_bienetre",
        reference.alias("cout_reference"),
        (cost - reference).alias("ecart"),
    )


def scenario_costs(
    benefits: DataFrame,
    employees: DataFrame,
    selected: int,
    rates: Sequence[int] = COMPARED_RATES,
) -> DataFrame:
    """Total cost per compared rate. The payroll is summed once and then priced at every rate."""
    payroll = _eligible(benefits, employees).agg(_payroll().alias("masse"))
    percent = F.col("taux_pct")
    cost = F.coalesce(_at_percent(F.col("masse"), percent), F.lit(0.0))
    return payroll.select("masse", F.explode(F.array(*[F.lit(r) for r in rates])).alias("taux_pct")).select(
        "taux_pct",
        F.concat(percent.cast("string"), F.lit("%")).alias("taux"),
        cost.alias("cout_total"),
        F.concat(F.format_number(cost, 0), F.lit(" EUR")).alias("cout_affiche"),
        F.when(percent == selected, SELECTED_MARK).otherwise("").alias("statut"),
    )
