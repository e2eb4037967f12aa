"""Change events as signed rows: what each adds to and takes from the activities of an employee."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Operations of a change feed that bring a row, change it, take it away.
CREATED, UPDATED, DELETED = ("c", "r"), "u", "d"


def decode_changes(events: DataFrame) -> DataFrame:
    """Every non-null event with ``op`` and the employee and id of the row before and after it.

    ``motif`` says why an event changes nothing countable: no JSON object (``json``), an operation that is none of the
    four (``op``), or a row that its operation needs and that is missing (``before``, ``after``).
    """
    parsed = events.filter(F.col("value").isNotNull()).select(
        *events.columns, F.explode(F.array(F.try_parse_json("value"))).alias("_json")
    )

    def get(path: str, kind: str) -> Column:
        return F.try_variant_get(F.col("_json"), path, kind)

    sides = {"avant": "before", "apres": "after"}
    fields = parsed.select(
        *events.columns,
        F.col("_json").isNull().alias("_casse"),
        get("$.payload.op", "string").alias("op"),
        *[get(f"$.payload.{side}.id_salarie", "long").alias(f"{name}_salarie") for name, side in sides.items()],
        *[get(f"$.payload.{side}.id", "long").alias(f"{name}_id") for name, side in sides.items()],
        *[
            F.coalesce(F.schema_of_variant(get(f"$.payload.{side}", "variant")).startswith("OBJECT"), F.lit(False)).alias(f"_{name}")
            for name, side in sides.items()
        ],
    )
    created, updated, deleted = F.col("op").isin(*CREATED), F.col("op") == UPDATED, F.col("op") == DELETED
    reason = (
        F.when(F.col("_casse"), "json")
        .when(~F.coalesce(created | updated | deleted, F.lit(False)), "op")
        .when((updated | deleted) & ~F.col("_avant"), "before")
        .when((created | updated) & ~F.col("_apres"), "after")
    )
    return fields.withColumn("motif", reason).drop("_casse", "_avant", "_apres")


def count_changes(changes: DataFrame) -> DataFrame:
    """What decoded changes add to the counts of ``activity_counts``, for each employee whose counts change."""
    row = lambda salarie, own_id, sign: F.struct(
        F.col(salarie).alias("id_salarie"),
        (F.col(own_id).isNotNull().cast("long") * sign).alias("nb_activites"),
        F.lit(sign).cast("long").alias("nb_lignes"),
    )
    gone = F.when(F.col("op").isin(UPDATED, DELETED), row("avant_salarie", "avant_id", -1))
    come = F.when(F.col("op").isin(*CREATED, UPDATED), row("apres_salarie", "apres_id", 1))
    signed = changes.filter("motif is null").select(F.inline(F.array_compact(F.array(gone, come))))
    return add_counts(signed)


def add_counts(rows: DataFrame) -> DataFrame:
    """Counts of each employee added up; those without anything left go."""
    total = rows.groupBy("id_salarie").agg(F.sum("nb_activites").alias("nb_activites"), F.sum("nb_lignes").alias("nb_lignes"))
    return total.filter("nb_activites <> 0 or nb_lignes <> 0")


def event_key(announced: Column, own_id: Column, value: Column, time: Column) -> Column:
    """What makes two events the same one: of announcing events the id of the row they announce, whatever else they say
    (a connector that takes its snapshot again announces every row anew); of others the whole event at its time."""
    whole = F.concat(F.lit("e:"), F.sha2(value, 256), F.lit(":"), F.coalesce(time.cast("string"), F.lit("")))
    return F.when(announced & own_id.isNotNull(), F.concat(F.lit("a:"), own_id)).otherwise(whole)
