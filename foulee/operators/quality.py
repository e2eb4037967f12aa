"""The fifteen data-quality checks, computed together in one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foulee.operators.benefits import calculation_date
from foulee.settings import Rules

# Verdicts, and the checks as (counter, label, detail unit, stops the run).
PASS = "✅ PASS"
FAIL = "❌ FAIL"
CHECKS = (
    ("doublons", "Pas de doublons ID salarié", "doublon(s)", True),
    ("salaires", "Salaire brut > 0", "salaire(s) invalide(s)", False),
    ("contrats", "Type contrat valide (CDI/CDD)", "contrat(s) invalide(s)", False),
    ("embauches", "Date d'embauche non nulle", "date(s) manquante(s)", False),
    ("modes", "Moyen de déplacement valide", "mode(s) invalide(s)", False),
    ("distances", "Distance jamais négative", "distance(s) négative(s)", False),
    ("durees", "Temps écoulé > 0 secondes", "durée(s) invalide(s)", False),
    ("dates", "Date début < Date fin", "activité(s) incohérente(s)", True),
    ("sports", "Type sport non nul", "type(s) manquant(s)", False),
    ("anciennes", "Activités dans les 12 derniers mois", "activité(s) hors période", False),
    ("orphelins", "ID salarié existe dans RH", "ID inconnu(s)", True),
    ("montants", "Montant prime >= 0", None, False),
    ("compteurs", "Nb activités >= 0", None, False),
    ("primes", "Prime uniquement pour déplacement actif", None, False),
    ("bien_etre", "Bien-être uniquement si >= 15 activités", None, False),
)


class CriticalQualityError(RuntimeError):
    """A check that must stop the run has failed."""


def _outside(column: str, values) -> Column:
    """True when the value is not in the list; a null is outside, as it is for the reports' readers."""
    return ~F.coalesce(F.col(column).isin(*values), F.lit(False))


def _flags(df: DataFrame, **conditions: Column) -> DataFrame:
    return df.select("id_salarie", *[c.cast("int").alias(name) for name, c in conditions.items()])


def quality_counts(
    employees: DataFrame, activities: DataFrame, benefits: DataFrame, rules: Rules = Rules()
) -> DataFrame:
    """One row with the number of violations per check.

    Each table is scanned once and turned into 0/1 flags; the three are stacked and grouped by
    employee id, which collapses before the shuffle however hot an id is. Per id it is then
    known how often HR lists it, whether activities use it and how many bonuses meet how many
    inactive commuters: the duplicate, orphan and bonus checks need no join.
    """
    oldest = F.date_sub(calculation_date(rules), rules.freshness_days)
    hr = _flags(
        employees,
        rh=F.lit(True),
        salaires=F.col("salaire_brut") <= 0,
        contrats=_outside("type_contrat", rules.contracts),
        embauches=F.col("date_embauche").isNull(),
        modes=_outside("moyen_deplacement", rules.known_modes),
        inactif=_outside("moyen_deplacement", rules.active_modes),
    )
    sport = _flags(
        activities,
        activite=F.lit(True),
        distances=F.col("distance_m") < 0,
        durees=F.col("temps_ecoule_s") <= 0,
        dates=F.col("date_debut") >= F.col("date_fin"),
        sports=F.col("type_sport").isNull(),
        anciennes=F.col("date_debut") < oldest,
    )
    gold = _flags(
        benefits,
        prime=F.col("prime_sportive"),
        montants=F.col("montant_prime") < 0,
        compteurs=F.col("nb_activites") < 0,
        bien_etre=(F.col("jours_bienetre") > 0) & (F.col("nb_activites") < rules.wellness_threshold),
    )
    stacked = hr.unionByName(sport, allowMissingColumns=True).unionByName(gold, allowMissingColumns=True)
    names = [name for name in stacked.columns if name != "id_salarie"]
    per_id = stacked.groupBy("id_salarie").agg(*[F.sum(n).alias(n) for n in names]).fillna(0, names)
    unknown = (F.col("rh") == 0) | F.col("id_salarie").isNull()
    derived = {
        "doublons": F.sum(F.greatest(F.col("rh") - 1, F.lit(0))),
        "orphelins": F.count_if((F.col("activite") > 0) & unknown),
        "primes": F.sum(F.when(F.col("id_salarie").isNotNull(), F.col("prime") * F.col("inactif"))),
    }
    totals = [derived[name] if name in derived else F.sum(name) for name, *_ in CHECKS]
    return per_id.agg(*[F.coalesce(t, F.lit(0)).alias(check[0]) for t, check in zip(totals, CHECKS)])


def _line(name: str, label: str, unit: str | None, critical: bool) -> str:
    """One report line as an SQL struct over the counter ``name``."""
    label = label.replace("'", "\\'")
    detail = f"concat({name}, ' {unit}')" if unit else "''"
    return (
        f"struct('{label}' AS test, if({name} = 0, '{PASS}', '{FAIL}') AS statut, {detail} AS detail, "
        f"{str(critical).lower()} AS critique, {name} AS nb_erreurs)"
    )


def quality_report(
    employees: DataFrame, activities: DataFrame, benefits: DataFrame, rules: Rules = Rules()
) -> DataFrame:
    """Fifteen rows ``test, statut, detail, critique, nb_erreurs`` in check order."""
    counts = quality_counts(employees, activities, benefits, rules)
    lines = ", ".join(_line(*check) for check in CHECKS)
    return counts.selectExpr(f"inline(array({lines}))")


def quality_summary(report: DataFrame) -> DataFrame:
    """How many checks passed and failed."""
    return report.agg(
        F.count_if(F.col("statut") == PASS).alias("nb_pass"),
        F.count_if(F.col("statut") == FAIL).alias("nb_fail"),
    )


def require_no_critical_failure(report: DataFrame) -> None:
    """Raise when a critical check failed. Reads the report, which has fifteen rows."""
    failed = report.filter(F.col("critique") & (F.col("statut") == FAIL)).select("test", "detail").collect()
    if failed:
        raise CriticalQualityError("; ".join(f"{row.test} ({row.detail})" for row in failed))


def orphan_ids(activities: DataFrame, employees: DataFrame) -> DataFrame:
    """Distinct employee ids used by activities and absent from HR; a null id is always absent.

    Both sides are reduced to distinct ids first, so that neither carries a hot id into the join.
    """
    known = employees.select("id_salarie").distinct()
    return activities.select("id_salarie").distinct().join(known, "id_salarie", "left_anti")
