"""Rendering of activities as chat messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foulee.functions.numeric import decimal_text, round_binary, whole_minutes
from foulee.functions.text import full_name, quoted_comment, text
from foulee.operators.lookup import keep_one, left_lookup
from foulee.operators.ranking import newest_first
from foulee.reference import DEFAULT_EMOJI, DEFAULT_TEMPLATES, message_templates
from foulee.session import cut_lineage


def event_messages(normalised: DataFrame, employees: DataFrame, unique: bool = False) -> DataFrame:
    """Normalised events with the ``message`` announcing them. ``unique``: employees have one row per id.

    Works on a stream too: the employee table is then the static side. An employee HR does not
    know is called by id.
    """
    names = employees.select("id_salarie", full_name(F.col("prenom"), F.col("nom")).alias("_nom"))
    named = left_lookup(normalised, names, ["id_salarie"], unique).withColumn(
        "_km", decimal_text(F.col("distance_m") / F.lit(1000.0), 1)
    )
    name = F.coalesce("_nom", F.concat(F.lit("Salarié "), F.col("id_texte")))
    sport = F.col("type_sport")
    km = F.coalesce("_km", (F.col("distance_m") / F.lit(1000.0)).cast("string"))
    minutes = whole_minutes(F.col("temps_ecoule_s")).cast("string")
    # The three texts of the live feed and the words that select them.
    body = (
        F.when(
            sport.contains("Course") | sport.contains("Run"),
            text(
                "Bravo *", name, "* ! Tu viens de courir ", km, " km en ", minutes, " min ! Quelle énergie ! 🏃‍♂️🔥"
            ),
        )
        .when(
            sport.contains("Rando"),
            text("Magnifique *", name, "* ! Une randonnée de ", km, " km terminée ! 🥾"),
        )
        .otherwise(text("Bravo *", name, "* ! ", km, " km de ", sport, " en ", minutes, " min ! 🏅"))
    )
    message = F.concat(body, quoted_comment(F.col("commentaire")))
    return named.select(*normalised.columns, message.alias("message"))


def _fill(template: Column, values: dict[str, Column]) -> Column:
    """The template with each name in braces replaced, in one pass: braces in a value stay as they are."""

    def one(part: Column) -> Column:
        chosen = reduce(
            lambda rest, item: F.when(part == "{" + item[0] + "}", item[1]).otherwise(rest), values.items(), part
        )
        return F.coalesce(chosen, F.lit(""))

    return F.array_join(F.transform(F.split(template, r"(?=\{)|(?<=\})"), one), "")


def activity_messages(named: DataFrame) -> DataFrame:
    """Activities with names (``id, id_salarie, type_sport, distance_m, temps_ecoule_s,
    commentaire, prenom, nom``) as messages from the sport's templates.

    Of a sport's two templates the activity id picks one, so that a rerun says the same. Swimming
    templates speak of metres and get metres. A missing or zero distance shows as a question mark.
    """
    templates = message_templates(named.sparkSession)
    chosen = left_lookup(named, templates, ["type_sport"], unique=True, spread_by=["id"]).withColumns(
        {
            "_km": round_binary(F.col("distance_m") / F.lit(1000.0), 1),
            "_metres": round_binary(F.col("distance_m"), 0),
        }
    )
    first = F.pmod(F.coalesce(F.col("id"), F.lit(0)), F.lit(2)) == 0
    template = F.when(first, F.coalesce("modele_1", F.lit(DEFAULT_TEMPLATES[0]))).otherwise(
        F.coalesce("modele_2", F.lit(DEFAULT_TEMPLATES[1]))
    )
    km, metres, sport = F.col("_km"), F.col("_metres"), F.col("type_sport")
    shown = F.when(sport == "Natation", F.when(metres != 0, metres.try_cast("decimal(30,0)").cast("string"))).when(
        km != 0, km.try_cast("decimal(30,1)").cast("string")
    )
    known = F.col("prenom").isNotNull() & F.col("nom").isNotNull()
    values = {
        "distance": F.coalesce(shown, F.lit("?")),
        "duree": F.coalesce(whole_minutes(F.col("temps_ecoule_s")).cast("string"), F.lit("?")),
        "emoji": F.coalesce("emoji", F.lit(DEFAULT_EMOJI)),
        "sport": F.coalesce(sport, F.lit("?")),
        "prenom": F.when(known, F.col("prenom")).otherwise("Salarié"),
        "nom": F.when(known, F.col("nom")).otherwise(F.coalesce(F.col("id_salarie").cast("string"), F.lit("?"))),
        "commentaire": quoted_comment(F.col("commentaire")),
    }
    return chosen.select("id", "id_salarie", "type_sport", _fill(template, values).alias("message"))


def latest_messages(activities: DataFrame, employees: DataFrame, n: int = 10) -> DataFrame:
    """Messages for the ``n`` newest activities, known employee or not.

    Runs a small job: the ``n`` rows are taken first and kept through the checkpoint folder, then
    broadcast to pick their names, so the employee table is scanned but not shuffled.
    """
    latest = cut_lineage(
        newest_first(
            activities.select(
                "id", "id_salarie", "type_sport", "distance_m", "temps_ecoule_s", "commentaire", "date_debut"
            ),
            n,
        )
    )
    wanted = latest.select("id_salarie").distinct()
    names = employees.select("id_salarie", "prenom", "nom").join(
        F.broadcast(wanted), "id_salarie", "left_semi"
    )
    return activity_messages(latest.join(keep_one(names, ["id_salarie"]), "id_salarie", "left"))
