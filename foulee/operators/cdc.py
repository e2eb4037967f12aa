"""Change-data-capture events of the activity table: decoding, rejects and normalisation.

All functions take any frame with a string column ``value``, batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foulee.functions.cdc_codec import decode_number, number_bytes
from foulee.functions.numeric import number_or_null

# The operations that announce an activity, and the default sport name.
ANNOUNCED_OPS = ("c", "r")
DEFAULT_SPORT = "Sport"
#: Why an event is unusable.
MOTIFS = ("json", "payload", "after", "type_sport", "temps_ecoule_s", "commentaire")


def _kind(field: Column) -> Column:
    """JSON kind of a variant: OBJECT<...>, ARRAY<...>, STRING, BIGINT, ..., VOID for an explicit null."""
    return F.schema_of_variant(field)


def _whole_seconds(kind: Column, value: Column) -> Column:
    """A duration as a whole number: absent, null and empty values are 0, numbers lose their decimals,
    booleans count as 0 or 1, and a text must be a whole number. Null when it is none of these."""
    whole = F.regexp_replace(F.trim(value), "_", "").try_cast("long")
    return (
        F.when(kind.isNull() | (kind == "VOID") | value.isin("", "[]", "{}"), F.lit(0).cast("long"))
        .when(kind == "BOOLEAN", (value == "true").cast("long"))
        .when(kind == "STRING", F.when(value.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"), whole))
        .when(~kind.rlike("^(OBJECT|ARRAY)"), number_or_null(value).try_cast("long"))
    )


def decode_events(
    events: DataFrame, scale: int = 2, signed: bool = False, activity_id: bool = False
) -> DataFrame:
    """Every non-null event as activity fields plus ``motif``, which says why it is unusable.

    Events keep their JSON kinds, as a missing key, an explicit null, a number and a text differ: a
    missing sport gets the default name, a null one cannot be rendered. An event that is no JSON object
    has motif ``json``, one whose payload is there but no object ``payload``. Of the announced
    operations, a row that is no object has motif ``after``; a sport that is no text ``type_sport``; a
    duration that is no whole number ``temps_ecoule_s``; a comment that is no text ``commentaire``.
    An empty row or another operation announces nothing. Tombstones (null values) are dropped.
    ``activity_id`` adds the row's own id, as text, as ``id_activite``.
    """
    # Exploding the one parsed value keeps later filters above it: pushed below a plain column they
    # would parse the text again for every condition.
    parsed = events.filter(F.col("value").isNotNull()).select(
        *events.columns, F.explode(F.array(F.try_parse_json("value"))).alias("_json")
    )

    def get(path: str, kind: str = "variant") -> Column:
        return F.try_variant_get(F.col("_json"), path, kind)

    names = ["id_salarie", "type_sport", "distance_m", "temps_ecoule_s", "commentaire"]
    own_id = [get("$.payload.after.id", "string").alias("id_activite")] if activity_id else []
    fields = parsed.select(
        *events.columns,
        *own_id,
        F.coalesce(_kind(F.col("_json")).startswith("OBJECT"), F.lit(False)).alias("_objet"),
        _kind(get("$.payload")).alias("_payload"),
        get("$.payload.op", "string").alias("op"),
        _kind(get("$.payload.after")).alias("_after"),
        get("$.payload.after", "string").alias("_ligne"),
        *[get(f"$.payload.after.{name}", "string").alias(f"_{name}") for name in names],
        *[_kind(get(f"$.payload.after.{name}")).alias(f"_k_{name}") for name in names],
    )
    row = F.coalesce(F.col("_after").startswith("OBJECT") & (F.col("_after") != "OBJECT<>"), F.lit(False))
    nothing = F.col("_after").isNull() | (F.col("_after") == "VOID") | F.col("_ligne").isin("", "0", "false", "[]", "{}")
    announced = F.coalesce(F.col("op").isin(*ANNOUNCED_OPS), F.lit(False))
    distance = F.when(F.col("_k_distance_m") == "BOOLEAN", (F.col("_distance_m") == "true").cast("int").cast("string")).when(
        ~F.col("_k_distance_m").rlike("^(OBJECT|ARRAY|VOID)"), F.col("_distance_m")
    )
    fields = fields.select(
        "*",
        (announced & row).alias("annonce"),
        distance.alias("_distance"),
        _whole_seconds(F.col("_k_temps_ecoule_s"), F.col("_temps_ecoule_s")).alias("_secondes"),
    ).withColumn(
        # Only a text that is no number can hold bytes.
        "_octets",
        F.when(
            (F.col("_k_distance_m") == "STRING") & number_or_null(F.col("_distance")).isNull(), number_bytes(F.col("_distance"))
        ),
    )
    sport, comment = F.col("_k_type_sport"), F.col("_k_commentaire")
    # Python's own words: a comment of 0 or false counts as none.
    odd_comment = comment.isNotNull() & ~comment.isin("STRING", "VOID") & ~F.col("_commentaire").isin("0", "false", "[]", "{}")
    reason = (
        F.when(~F.col("_objet"), "json")
        .when(F.col("_payload").isNotNull() & ~F.col("_payload").startswith("OBJECT"), "payload")
        .when(announced & ~row & ~nothing, "after")
        .when(F.col("annonce") & (sport != "STRING"), "type_sport")
        .when(F.col("annonce") & F.col("_secondes").isNull(), "temps_ecoule_s")
        .when(F.col("annonce") & odd_comment, "commentaire")
    )
    shown_id = F.when(F.col("_k_id_salarie") == "BOOLEAN", F.initcap("_id_salarie")).otherwise(F.col("_id_salarie"))
    return fields.select(
        *events.columns,
        "annonce",
        "op",
        F.coalesce(
            F.col("_id_salarie").try_cast("long"), number_or_null(F.col("_id_salarie")).try_cast("long")
        ).alias("id_salarie"),
        F.coalesce(shown_id, F.lit("None")).alias("id_texte"),
        F.coalesce("_type_sport", F.lit(DEFAULT_SPORT)).alias("type_sport"),
        decode_number(F.col("_distance"), F.col("_octets"), scale, signed).alias("distance_m"),
        F.col("_secondes").alias("temps_ecoule_s"),
        F.when(comment == "STRING", F.col("_commentaire")).alias("commentaire"),
        reason.alias("motif"),
        *[F.col("id_activite") for _ in own_id],
    )


def normalised(decoded: DataFrame) -> DataFrame:
    """The usable created or snapshot activities of a decoded feed."""
    return decoded.filter(F.col("annonce") & F.col("motif").isNull()).drop("value", "annonce", "motif")


def rejects(decoded: DataFrame) -> DataFrame:
    """The unusable events of a decoded feed with the reason."""
    return decoded.filter(F.col("motif").isNotNull()).drop(
        "annonce", "op", "id_salarie", "id_texte", "type_sport", "distance_m", "temps_ecoule_s", "commentaire"
    )


def normalise_events(events: DataFrame, scale: int = 2, signed: bool = False) -> DataFrame:
    return normalised(decode_events(events, scale, signed))


def rejected_events(events: DataFrame) -> DataFrame:
    return rejects(decode_events(events))
