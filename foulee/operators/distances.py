"""Home-to-office distance and the tri-state commute verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foulee.functions.geo import haversine_m
from foulee.functions.text import address_key
from foulee.operators.lookup import keep_one, left_lookup
from foulee.settings import Rules


def prepare_geocodes(geocodes: DataFrame) -> DataFrame:
    """``cle_adresse, lat, lon``: one row per normalised address that has both coordinates."""
    located = geocodes.select(address_key(F.col("adresse")).alias("cle_adresse"), "lat", "lon").dropna()
    return keep_one(located, ["cle_adresse"])


def office_coordinates(geocodes: DataFrame, office_address: str) -> tuple[Column, Column]:
    """The office looked up in the geocode table, as two scalar subqueries; null when unknown."""
    office = geocodes.filter(F.col("cle_adresse") == address_key(F.lit(office_address)))
    return office.agg(F.min("lat")).scalar(), office.agg(F.min("lon")).scalar()


def _office(rules: Rules) -> tuple[Column, Column]:
    lat, lon = rules.office or (None, None)
    return F.lit(lat).cast("double"), F.lit(lon).cast("double")


def _limit(mode: Column, rules: Rules) -> Column:
    """The mode's distance limit in metres; null for a mode that is not active."""
    limit = F.lit(None).cast("double")
    for name, metres in rules.distance_limits_m.items():
        limit = F.when(mode == name, float(metres)).otherwise(limit)
    return limit


def measured_distances(
    employees: DataFrame,
    geocodes: DataFrame,
    rules: Rules,
    office: tuple[Column, Column] | None = None,
) -> DataFrame:
    """``id_salarie, distance_m, distance_max`` for employees with an active commute mode.

    Only the id, mode and address of those employees are shuffled to the geocode table; the rest
    of the row stays where it is. ``distance_m`` is null when home or office is unknown.
    """
    active = employees.filter(F.col("moyen_deplacement").isin(*rules.active_modes)).select(
        "id_salarie",
        _limit(F.col("moyen_deplacement"), rules).alias("distance_max"),
        address_key(F.col("adresse")).alias("cle_adresse"),
    )
    office_lat, office_lon = office or _office(rules)
    return left_lookup(active, geocodes, ["cle_adresse"], unique=True, spread_by=["id_salarie"]).select(
        "id_salarie",
        haversine_m(F.col("lat"), F.col("lon"), office_lat, office_lon).alias("distance_m"),
        "distance_max",
    )


def employee_distances(
    employees: DataFrame,
    geocodes: DataFrame,
    rules: Rules,
    office: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Employees with ``declaration_ok`` (true, false or null) and ``distance_m``.

    ``employees`` must hold one row per id. A distance equal to the limit is accepted. Without
    a measured distance (inactive mode, unknown address) the verdict is null under the strict
    policy and true under the lenient one. ``geocodes`` comes from :func:`prepare_geocodes`.
    """
    distances = measured_distances(employees, geocodes, rules, office)
    verdict = F.col("distance_m") <= F.col("distance_max")
    if rules.policy == "lenient":
        verdict = F.coalesce(verdict, F.lit(True))
    return employees.join(distances, "id_salarie", "left").select(
        *employees.columns, verdict.alias("declaration_ok"), "distance_m"
    )


def distance_report(
    employees: DataFrame,
    geocodes: DataFrame,
    rules: Rules,
    office: tuple[Column, Column] | None = None,
) -> DataFrame:
    """One line per employee saying how the distance check ended, with a comment."""
    distances = measured_distances(employees, geocodes, rules, office)
    inactive = F.col("distance_max").isNull()
    within = F.col("distance_m") <= F.col("distance_max")
    comment = (
        F.when(inactive, "Mode non actif")
        .when(F.col("distance_m").isNull(), "Adresse non trouvée")
        .when(within, "OK")
        .otherwise("Distance excessive")
    )
    return employees.join(distances, "id_salarie", "left").select(
        "id_salarie",
        F.col("moyen_deplacement").alias("mode"),
        "distance_m",
        "distance_max",
        F.when(inactive, True).otherwise(within).alias("declaration_ok"),
        comment.alias("commentaire"),
    )
