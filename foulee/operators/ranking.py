"""Directories and top-k listings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foulee.functions.numeric import kilometres
from foulee.functions.text import full_name
from foulee.session import cut_lineage

# Newest rows probed before the whole join is made, per row of the listing.
_PROBE_FACTOR = 20


def employee_directory(employees: DataFrame) -> DataFrame:
    """Id and names, sorted by last name."""
    return employees.select("id_salarie", "nom", "prenom").orderBy("nom", "id_salarie")


# What orders activities of one time and id: everything that a listing shows of them.
_TIES = ("id_salarie", "type_sport", "distance_m", "temps_ecoule_s", "commentaire")


def newest_first(activities: DataFrame, n: int) -> DataFrame:
    """The ``n`` most recent activities, ties broken by id and then by all that is shown, so that the
    order of the input never matters: a bounded heap per task, no shuffle."""
    ties = [F.asc_nulls_first(name) for name in _TIES]
    return activities.orderBy(F.desc_nulls_last("date_debut"), F.desc_nulls_last("id"), *ties).limit(n)


def latest_activities(
    activities: DataFrame,
    employees: DataFrame,
    n: int = 10,
    probe_factor: int = _PROBE_FACTOR,
    newest: Callable[[int], DataFrame] | None = None,
) -> DataFrame:
    """The ``n`` newest activities of known employees, in display units.

    Runs a small job: the newest few rows are taken and joined first (they are broadcast, so
    neither table is shuffled), and kept through the checkpoint folder. They hold the answer
    whenever ``n`` of them have a known employee. Only when they do not is the whole join made.
    ``newest`` gives a part of the activities that holds so many of the newest, if there is a cheaper way
    to them than all activities (``read_newest`` of a lake table that tracks their start).
    """
    names = employees.select("id_salarie", full_name(F.col("prenom"), F.col("nom")).alias("salarie"))
    shown = ["id", "id_salarie", "type_sport", "distance_m", "temps_ecoule_s", "commentaire", "date_debut"]
    narrow, probed = activities.select(shown), n * probe_factor
    first = narrow if newest is None else newest(probed).select(shown)
    known = cut_lineage(newest_first(first, probed).join(names, "id_salarie"))
    if known.count() < n:
        known = narrow.join(names, "id_salarie")
    latest = newest_first(known, n)
    return latest.select(
        "id",
        "salarie",
        "type_sport",
        kilometres(F.col("distance_m")).cast("double").alias("km"),
        F.round(F.col("temps_ecoule_s").cast("decimal(18,0)") / 60, 0).cast("double").alias("minutes"),
        "commentaire",
        F.col("date_debut").cast("string").alias("date"),
    )


def top_bonuses(benefits: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest bonuses, ties broken by id."""
    return benefits.orderBy(F.desc("montant_prime"), "id_salarie").limit(n)
