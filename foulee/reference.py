"""Reference tables with fixed content, and the session-side frames built from them.

The frames go through Arrow, which makes them local relations of known size: Spark broadcasts
them on its own because it can see how small they are.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Default business units.
BUSINESS_UNITS = ("Marketing", "R&D", "Ventes", "Support", "Finance")

# Default sport reference as (sport, minimum seconds, category).
SPORTS = (
    ("Course à pied", 1800, "cardio"),
    ("Randonnée", 3600, "cardio"),
    ("Natation", 1800, "cardio"),
    ("Tennis", 2700, "raquette"),
    ("Badminton", 1800, "raquette"),
    ("Football", 3600, "collectif"),
    ("Rugby", 3600, "collectif"),
    ("Basketball", 3600, "collectif"),
    ("Judo", 3600, "combat"),
    ("Boxe", 2700, "combat"),
    ("Escalade", 5400, "outdoor"),
    ("Triathlon", 5400, "cardio"),
    ("Voile", 3000, "outdoor"),
    ("Équitation", 3600, "outdoor"),
    ("Tennis de table", 1800, "raquette"),
    ("Runing", 1800, "cardio"),
)

# The source's spelling of running and the one every later table uses.
RUNNING_ALIAS = "Runing"
RUNNING = "Course à pied"

# Declaration limits as (sport, max metres, min speed, max speed, max seconds).
# A sport without a distance has no distance and speed limits.
DECLARATION_LIMITS = (
    ("Course à pied", 100000, 2.0, 7.0, 36000),
    ("Randonnée", 60000, 0.5, 2.5, 50400),
    ("Natation", 20000, 0.5, 2.5, 28800),
    ("Triathlon", 200000, 1.5, 6.0, 72000),
    ("Voile", 500000, 0.5, 10.0, 86400),
    ("Tennis", None, None, None, 21600),
    ("Football", None, None, None, 14400),
    ("Rugby", None, None, None, 14400),
    ("Badminton", None, None, None, 18000),
    ("Judo", None, None, None, 14400),
    ("Boxe", None, None, None, 10800),
    ("Escalade", None, None, None, 28800),
    ("Basketball", None, None, None, 14400),
    ("Équitation", 80000, 0.5, 5.0, 28800),
    ("Tennis de table", None, None, None, 14400),
)

# Limits for a sport the table above does not know, and the shortest session.
UNKNOWN_SPORT_MAX_S = 86400
SHORTEST_SESSION_S = 300

# Emoji per sport, with the one for every other sport.
EMOJIS = (
    ("Runing", "🏃‍♂️🔥"),
    ("Randonnée", "🥾🌄"),
    ("Natation", "🏊‍♂️💦"),
    ("Tennis", "🎾"),
    ("Football", "⚽"),
    ("Rugby", "🏉"),
    ("Badminton", "🏸"),
    ("Judo", "🥋"),
    ("Boxe", "🥊"),
    ("Escalade", "🧗"),
    ("Triathlon", "🏅"),
    ("Équitation", "🐴"),
    ("Tennis de table", "🏓"),
    ("Basketball", "🏀"),
    ("Voile", "⛵"),
)
DEFAULT_EMOJI = "🏅"

# Message templates per sport, with the pair for every other sport.
TEMPLATES = (
    (
        "Runing",
        "Bravo {prenom} {nom} ! Tu viens de courir {distance} km en {duree} min ! Quelle énergie ! 🏃‍♂️🔥",
        "Superbe sortie {prenom} {nom} ! {distance} km avalés en {duree} min ! Respect ! 💪",
    ),
    (
        "Randonnée",
        "Magnifique {prenom} {nom} ! Une randonnée de {distance} km terminée ! 🥾🌄{commentaire}",
        "Bravo {prenom} {nom} ! {distance} km de randonnée en {duree} min ! Nature lover ! 🌿",
    ),
    (
        "Natation",
        "Splash ! {prenom} {nom} vient de nager {distance} m en {duree} min ! 🏊‍♂️💦",
        "Bravo {prenom} {nom} ! {distance} m dans l'eau en {duree} min ! Champion(ne) ! 🏊",
    ),
    (
        "Tennis",
        "Ace ! {prenom} {nom} vient de jouer {duree} min de tennis ! 🎾",
        "Bravo {prenom} {nom} ! Belle séance de tennis de {duree} min ! 🎾",
    ),
)
DEFAULT_TEMPLATES = (
    "Bravo {prenom} {nom} ! Belle séance de {sport} de {duree} min ! {emoji}",
    "Superbe {prenom} {nom} ! {duree} min de {sport} au compteur ! {emoji}",
)


def _frame(spark: SparkSession, rows, **columns: pa.DataType) -> DataFrame:
    schema = pa.schema(list(columns.items()))
    values = [list(column) for column in zip(*rows)]
    return spark.createDataFrame(pa.table(values, schema=schema))


def business_units(spark: SparkSession) -> DataFrame:
    return _frame(spark, [(bu,) for bu in BUSINESS_UNITS], bu=pa.string())


def sports(spark: SparkSession) -> DataFrame:
    return _frame(spark, SPORTS, type_sport=pa.string(), duree_min_s=pa.int64(), categorie=pa.string())


def declaration_limits(spark: SparkSession) -> DataFrame:
    return _frame(
        spark,
        DECLARATION_LIMITS,
        type_sport=pa.string(),
        dist_max=pa.float64(),
        vitesse_min=pa.float64(),
        vitesse_max=pa.float64(),
        duree_max=pa.int64(),
    )


def message_templates(spark: SparkSession) -> DataFrame:
    """One row per sport with an emoji: ``type_sport, emoji, modele_1, modele_2``."""
    templates = {sport: pair for sport, *pair in TEMPLATES}
    rows = [(sport, emoji, *templates.get(sport, DEFAULT_TEMPLATES)) for sport, emoji in EMOJIS]
    return _frame(
        spark, rows, type_sport=pa.string(), emoji=pa.string(), modele_1=pa.string(), modele_2=pa.string()
    )
