"""Validation and shaping of declared activities.

A declaration is ``id_salarie, type_sport, distance_m, duree_s, commentaire, date_debut``;
further columns pass through.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foulee import schemas
from foulee.functions.numeric import decimal_text
from foulee.functions.text import blank_to_null, day_first, text
from foulee.operators.lookup import left_lookup
from foulee.reference import SHORTEST_SESSION_S, UNKNOWN_SPORT_MAX_S

# Fixed value: duration assumed when an unvalidated entry leaves it out.
DEFAULT_DURATION_S = 3600

_LIMITS = ["dist_max", "vitesse_min", "vitesse_max", "duree_max"]
_ACTIVITY = ["id_salarie", "date_debut", "type_sport", "distance_m", "temps_ecoule_s", "date_fin", "commentaire"]


def speed_kmh(distance_m: Column, seconds: Column) -> Column:
    """Kilometres per hour; null when there is no positive duration."""
    return F.when(seconds > 0, (distance_m / F.lit(1000.0)) / (seconds / F.lit(3600.0)))


def declaration_errors(declarations: DataFrame, limits: DataFrame, speed_unit: str = "kmh") -> DataFrame:
    """Declarations with ``valide`` and ``erreurs``, the list of what is wrong with each.

    Bounds are strict, so a value equal to a limit passes. A missing duration counts as 0. The
    speed limits are compared in km/h as they are; ``speed_unit="ms"`` reads them as metres per
    second instead. ``limits`` has one row per sport.
    """
    if speed_unit not in ("kmh", "ms"):
        raise ValueError(f"speed_unit must be 'kmh' or 'ms', not {speed_unit!r}")
    limited = left_lookup(declarations, limits.select("type_sport", *_LIMITS), ["type_sport"], unique=True)
    sport = F.coalesce("type_sport", F.lit(""))
    metres, longest_m = F.col("distance_m"), F.col("dist_max")
    seconds, longest_s = F.coalesce("duree_s", F.lit(0)), F.coalesce("duree_max", F.lit(UNKNOWN_SPORT_MAX_S))
    speed, unit = speed_kmh(metres, seconds), "km/h"
    if speed_unit == "ms":
        speed, unit = speed / F.lit(3.6), "m/s"
    moving = metres > 0
    hours = lambda s: decimal_text(s / F.lit(3600.0), 1)
    km = lambda m, digits: decimal_text(m / F.lit(1000.0), digits)
    limit = lambda column: F.col(column).cast("string")
    # The message texts, in the order in which errors are listed.
    rules = [
        (seconds <= 0, ["La duree doit etre superieure a 0 seconde."]),
        (
            seconds > longest_s,
            ["Duree trop longue pour ", sport, " : max ", hours(longest_s),
             "h (vous avez saisi ", hours(seconds), "h)."],
        ),
        (seconds < SHORTEST_SESSION_S, ["Duree trop courte : minimum 5 minutes."]),
        (
            moving & (metres > longest_m),
            ["Distance impossible pour ", sport, " : max ", km(longest_m, 0),
             " km (vous avez saisi ", km(metres, 1), " km)."],
        ),
        (
            moving & (speed > F.col("vitesse_max")),
            ["Vitesse impossible : ", decimal_text(speed, 1), f" {unit} pour ", sport,
             " (max realiste : ", limit("vitesse_max"), f" {unit}). Verifiez distance/duree."],
        ),
        (
            moving & (speed < F.col("vitesse_min")),
            ["Vitesse trop lente : ", decimal_text(speed, 2), f" {unit} pour ", sport,
             " (min : ", limit("vitesse_min"), f" {unit}). Verifiez distance/duree."],
        ),
    ]
    none = F.array().cast("array<string>")
    broken = [F.coalesce(condition, F.lit(False)) for condition, _ in rules]
    return limited.select(
        *declarations.columns,
        longest_m.isNotNull().alias("avec_distance"),
        (~reduce(or_, broken)).alias("valide"),
        F.concat(*[F.when(condition, F.array(text(*parts))).otherwise(none) for condition, parts in rules]).alias(
            "erreurs"
        ),
    )


def _shape(declarations: DataFrame, distance: Column, duration: Column) -> DataFrame:
    return declarations.select(
        "id_salarie",
        "date_debut",
        "type_sport",
        distance.alias("distance_m"),
        duration.alias("temps_ecoule_s"),
        F.timestamp_add("SECOND", duration, F.col("date_debut")).alias("date_fin"),
        blank_to_null(F.col("commentaire")).alias("commentaire"),
    ).select(*_ACTIVITY)


def accepted(checked: DataFrame) -> DataFrame:
    """Activity rows for the declarations without errors. The end is start plus duration; a zero
    distance, or one for a sport that has none, is null; a blank comment is null."""
    valid = checked.filter("valide")
    distance = F.when(F.col("avec_distance") & (F.col("distance_m") != 0), F.col("distance_m"))
    return _shape(valid, distance, F.col("duree_s"))


def as_activities(accepted: DataFrame) -> DataFrame:
    """Accepted rows with the activities' columns. The id is negative, which no loaded id is, and a hash of
    the row: the same declaration has the same id whenever it is read again."""
    values = [F.col(name) for name in _ACTIVITY]
    # xxhash64 passes over nulls, so where they stand is hashed too.
    hashed = F.xxhash64(*values, *[value.isNull() for value in values])
    identified = accepted.withColumn("id", -1 - hashed.bitwiseAND(F.lit((1 << 62) - 1)))
    return schemas.conform(identified, schemas.ACTIVITIES)


def refused(checked: DataFrame) -> DataFrame:
    """The declarations with at least one error."""
    return checked.filter("NOT valide")


def declarations_accepted(declarations: DataFrame, limits: DataFrame, speed_unit: str = "kmh") -> DataFrame:
    return accepted(declaration_errors(declarations, limits, speed_unit))


def declarations_unvalidated(declarations: DataFrame) -> DataFrame:
    """Activity rows without any check: a missing duration becomes one hour, any distance stays."""
    duration = F.coalesce(F.col("duree_s"), F.lit(DEFAULT_DURATION_S))
    return _shape(declarations, F.col("distance_m"), duration)


def declaration_recap(activities: DataFrame) -> DataFrame:
    """Accepted activities as shown back to the employee: distance, h/min/s, speed and date."""
    distance, seconds = F.col("distance_m"), F.col("temps_ecoule_s")
    return activities.select(
        "id_salarie",
        "type_sport",
        decimal_text(distance / F.lit(1000.0), 1).alias("distance_km"),
        F.call_function("div", seconds, F.lit(3600)).alias("duree_h"),
        F.call_function("div", seconds % 3600, F.lit(60)).alias("duree_min"),
        (seconds % 60).alias("duree_s"),
        decimal_text(speed_kmh(distance, seconds), 1).alias("vitesse_kmh"),
        day_first(F.col("date_debut")).alias("date"),
    )
