"""Domain tables derived from the star-schema tables, with dirt in them.

Every adapter keeps all rows of its table. The arithmetic on keys only decides what a row looks
like: which values are missing, wrong, repeated or spelled differently.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foulee.functions.text import day_first
from foulee.operators.distances import prepare_geocodes
from foulee.session import scratch_path
from foulee.settings import CYCLING, MOTOR_VEHICLE, PUBLIC_TRANSPORT, WALKING, Rules
from foulee.sources.extracts import (
    ACTIVITY_HEADERS,
    DECLARED_SPORT_HEADERS,
    EMPLOYEE_HEADERS,
    read_extract,
    write_extract,
)

AS_OF = dt.date(2001, 8, 2)
OFFICE = (43.6, 3.9)
RULES = Rules(office=OFFICE, as_of=AS_OF)
LENIENT = Rules(office=OFFICE, as_of=AS_OF, policy="lenient")

# Sports by remainder of the order key; the last one is in no reference.
SPORTS = (
    "Runing",
    "Course à pied",
    "Randonnée",
    "Natation",
    "Triathlon",
    "Voile",
    "Équitation",
    "Tennis",
    "Badminton",
    "Football",
    "Rugby",
    "Basketball",
    "Judo",
    "Boxe",
    "Escalade",
    "Tennis de table",
    "Parkour {nom}",
)
WITH_DISTANCE = 7  # the first seven have a distance
MODES = (WALKING, WALKING, CYCLING, CYCLING, PUBLIC_TRANSPORT, PUBLIC_TRANSPORT, MOTOR_VEHICLE, MOTOR_VEHICLE)
UNITS = {"BUILDING": "Marketing", "AUTOMOBILE": "R&D", "MACHINERY": "Ventes", "HOUSEHOLD": "Support"}


SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table arriving as a stream of files."""
    return spark.readStream.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet*")


def _pick(values, index: Column) -> Column:
    """The value at ``index``, or null past the end."""
    return F.get(F.expr("array({})".format(", ".join(f"'{v}'" for v in values))), index.cast("int"))


def _copies(condition: Column) -> Column:
    return F.explode(F.when(condition, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as HR rows: some repeated with another salary, some repeated without an id."""
    k = F.col("c_custkey")
    again = (k % 50 == 0) | (k % 97 == 0)
    rows = table(spark, sf_dir, "customer").withColumn("copie", _copies(again))
    second = F.col("copie") == 1
    contract = (
        F.when(k % 10 == 0, "Stage").when(k % 10 == 1, F.lit(None)).when(k % 2 == 0, "CDI").otherwise("CDD")
    )
    unit = F.coalesce(*[F.when(F.col("c_mktsegment") == s, u) for s, u in UNITS.items()], F.col("c_mktsegment"))
    street = F.floor(k / 12).cast("string")
    address = (
        F.when(k % 61 == 0, F.lit(None))
        .when(k % 5 == 0, F.concat(F.lit("  RUE   des Pins "), street, F.lit(" ")))
        .otherwise(F.concat(F.lit("rue des pins "), street))
    )
    return rows.select(
        F.when(second & (k % 97 == 0), F.lit(None)).otherwise(k).alias("id_salarie"),
        F.col("c_name").alias("nom"),
        F.concat(F.lit("P"), (k % 7).cast("string")).alias("prenom"),
        F.date_add(F.lit(dt.date(1960, 1, 1)), (k * 37 % 14000).cast("int")).alias("date_naissance"),
        unit.alias("bu"),
        F.when(k % 83 != 0, F.date_add(F.lit(dt.date(2000, 1, 1)), (k * 11 % 9000).cast("int"))).alias("date_embauche"),
        (F.col("c_acctbal").cast("decimal(12,2)") + F.when(second, 100).otherwise(0))
        .cast("decimal(12,2)")
        .alias("salaire_brut"),
        contract.alias("type_contrat"),
        (k % 6 + 25).alias("nb_jours_cp"),
        address.alias("adresse"),
        _pick(MODES, F.floor(k / 3) % 9).alias("moyen_deplacement"),
    )


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as activities: some repeated with another comment, some of unknown employees."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").withColumn("copie", _copies(k % 50 == 0))
    seconds = F.when(k % 193 == 0, F.lit(None)).when(k % 97 == 0, 0).otherwise(k * 53 % 9000 + 300)
    metres = F.when(k % 89 == 0, -1.0).when(k % 17 < WITH_DISTANCE, (k * 31 % 30000).cast("double"))
    start = F.timestamp_add("MINUTE", k * 7 % 1440, F.col("o_orderdate"))
    comment = F.when(k % 36 == 0, 'Dit "super", oui,\nvraiment {nom}').when(k % 4 == 0, "Belle séance").when(k % 4 == 2, "   ").when(k % 4 == 3, F.col("o_orderpriority"))
    return rows.select(
        F.when(k % 401 == 0, F.lit(None))
        .when(k % 307 == 0, F.col("o_custkey") + 1000000000)
        .otherwise(F.col("o_custkey"))
        .alias("id_salarie"),
        F.when(k % 101 != 0, _pick(SPORTS, k % 17)).alias("type_sport"),
        metres.alias("distance_m"),
        seconds.alias("temps_ecoule_s"),
        start.alias("date_debut"),
        F.when(k % 211 != 0, F.timestamp_add("SECOND", F.coalesce(seconds, F.lit(0)), start)).alias("date_fin"),
        F.when(F.col("copie") == 1, "copie").otherwise(comment).alias("commentaire"),
        F.when(k % 503 != 0, k).alias("id"),
    )


def declared_sports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as declared sports: a third without one, some employees twice, some ids missing."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").withColumn("copie", _copies(k % 20 == 0))
    sport = F.when(F.col("copie") == 1, "Yoga").when(k % 3 != 0, _pick(SPORTS, k % 17))
    return rows.select(F.when(k % 89 != 0, k).alias("id_salarie"), sport.alias("sport"))


def raw_geocodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as located addresses: some without coordinates, some twice with different ones."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").withColumn("copie", _copies(k % 10 == 0))
    second = F.col("copie") == 1
    name = F.concat(F.when(second, " Rue DES pins  ").otherwise("rue des pins "), k.cast("string"))
    lat = (k % 41 + 4340 + F.when(second, 3).otherwise(0)) / F.lit(100.0)
    return rows.select(
        name.alias("adresse"),
        F.when(k % 13 != 0, lat).alias("lat"),
        ((k % 37 + 370) / F.lit(100.0)).alias("lon"),
    )


def geocodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_geocodes(raw_geocodes(spark, sf_dir))


def declarations_of(lineitem: DataFrame) -> DataFrame:
    """lineitem, batch or streaming, as declarations: durations from negative to too long."""
    k, line = F.col("l_partkey"), F.col("l_linenumber")
    seconds = F.when(k % 67 == 0, F.lit(None)).otherwise((k * 97 + line * 1201) % 90000 - 500)
    metres = (
        F.when(k % 19 == 0, F.lit(None))
        .when(k % 23 == 0, 0.0)
        .when(k % 3 == 0, F.col("l_extendedprice") / 8.0)
        .when(k % 3 == 1, seconds * F.lit(0.9))
        .otherwise(F.col("l_extendedprice"))
    )
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").alias("id_salarie"),
        _pick(SPORTS, k % 17).alias("type_sport"),
        metres.alias("distance_m"),
        seconds.alias("duree_s"),
        F.when(F.col("l_returnflag") == "A", "  ")
        .when(F.col("l_returnflag") == "R", F.concat(F.lit(" \tvu "), F.col("l_linestatus"), F.lit(" \n")))
        .alias("commentaire"),
        F.col("l_shipdate").alias("date_debut"),
    )


def declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declarations_of(table(spark, sf_dir, "lineitem"))


def _big_endian_double(x: Column) -> Column:
    """Hex of the eight bytes of a positive double of ordinary size."""
    exponent = F.floor(F.log2(x))
    fraction = (x / F.pow(F.lit(2.0), exponent.cast("double")) - 1.0) * F.lit(float(1 << 52))
    bits = F.shiftleft(exponent + 1023, 52) + fraction.cast("long")
    return F.lpad(F.hex(bits), 16, "0")


def envelope(event: DataFrame, keep: Sequence[str] = (), identified: bool = False) -> DataFrame:
    """Rows of the events table, batch or streaming, as change events ``event_id, value`` and the columns ``keep``.
    ``identified``: rows of activities have an id of their own."""
    k = F.col("event_id")
    metres = (F.col("value") * 100).cast("decimal(18,0)").cast("long")
    cents = F.hex(metres * 100)
    even = F.lpad(cents, (F.length(cents) + F.length(cents) % 2).cast("int"), "0")
    quote = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
    distance = (
        F.when(k % 53 == 0, F.lit("true"))
        .when(k % 6 == 0, metres.cast("string"))
        .when(k % 6 == 1, quote(F.concat(metres.cast("string"), F.lit(".5"))))
        .when(k % 6 == 2, quote(F.base64(F.unhex(even))))
        .when(k % 6 == 3, quote(F.base64(F.unhex(_big_endian_double(metres.cast("double") + 1)))))
        .when(k % 6 == 4, F.lit('"???"'))
        .otherwise(F.lit("null"))
    )
    sport = _pick(["Course à pied", "Running", "Randonnée", "Natation", "Tennis"], k % 7)
    op = F.coalesce(
        F.when(F.col("event_type").isin("signup", "click"), "c"),
        F.when(F.col("event_type") == "purchase", "r"),
        F.when(F.col("event_type") == "view", "u"),
        F.lit("d"),
    )
    fields = [
        F.concat(F.lit('"id_salarie": '), F.col("user_id").cast("string")),
        F.when(k % 29 == 0, F.lit('"type_sport": null'))
        .when(k % 59 == 0, F.lit('"type_sport": 7'))
        .when(sport.isNotNull(), F.concat(F.lit('"type_sport": '), quote(sport))),
        F.concat(F.lit('"distance_m": '), distance),
        F.when(k % 31 == 0, F.lit('"temps_ecoule_s": "bientôt"'))
        .when(k % 43 == 0, F.lit('"temps_ecoule_s": "12.7"'))
        .when(k % 47 == 0, F.lit('"temps_ecoule_s": true'))
        .when(k % 8 != 0, F.concat(F.lit('"temps_ecoule_s": '), (k * 37 % 7000).cast("string"))),
        F.when(k % 3 == 0, F.lit('"commentaire": "bravo"')).when(k % 3 == 1, F.lit('"commentaire": "  "')),
    ]
    if identified:
        fields = [F.concat(F.lit('"id": '), k.cast("string")), *fields]
    after = F.when(k % 37 == 0, F.lit("null")).otherwise(
        F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
    )
    text = F.concat(F.lit('{"payload": {"op": "'), op, F.lit('", "after": '), after, F.lit("}}"))
    text = F.when(k % 41 == 0, F.lit('{"payload": null}')).otherwise(text)
    value = F.when(k % 13 == 0, F.lit(None)).when(k % 11 == 0, F.substring(text, 1, 40)).otherwise(text)
    # exploded so that filters on the text do not build it a second time
    return event.select("event_id", *keep, F.explode(F.array(value)).alias("value"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change events, arriving as a stream of files."""
    return envelope(table_stream(spark, sf_dir, "events"))


def _file_stream(rows: Sequence[DataFrame], parts: int, per_batch: int, spread: bool = False) -> DataFrame:
    """Frames written one after the other, each in so many parts, arriving as a stream in batches of ``per_batch`` parts.
    A part is a file, or, ``spread``, as many as give every core one of a batch: a file is one task's work. What comes in
    which batch then depends on the number of cores."""
    spark, path = rows[0].sparkSession, scratch_path(rows[0].sparkSession, "arrivees")
    files = -(-spark.sparkContext.defaultParallelism // per_batch) if spread else 1
    for frame in rows:
        frame.repartition(parts * files).write.mode("append").parquet(path)
    return spark.readStream.schema(rows[0].schema).option("maxFilesPerTrigger", per_batch * files).parquet(path)


def snapshot_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change events as a stream of several batches in which the connector takes its snapshot again: a day later
    every row comes once more, created ones as read."""
    first = envelope(table(spark, sf_dir, "events"), ["ts"], identified=True)
    again = F.regexp_replace("value", '"op": "c"', '"op": "r"')
    later = first.select("event_id", (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"), again.alias("value"))
    return _file_stream([first, later], 3, 2, spread=True)


def activity_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as the life of activities: ``event_id, ts, value``. Each is created or read by a snapshot, a
    fourth are read again by another one, a fifth move to the next employee, a seventh are deleted; some have no id, some
    no employee, and some events are broken."""
    k = F.col("event_id")
    text = lambda *parts: F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])
    row = lambda salarie: text(
        '{"id": ', F.when(k % 97 == 0, "null").otherwise(k.cast("string")), ', "id_salarie": ',
        F.when(k % 89 == 0, "null").otherwise(salarie.cast("string")), "}",
    )
    change = lambda op, before, after: text(f'{{"payload": {{"op": "{op}", "before": ', before, ', "after": ', after, "}}")
    user, moved = F.col("user_id"), k % 5 == 0
    last = F.when(moved, user + 1).otherwise(user)
    null = F.lit("null")
    created = F.when(k % 10 == 3, change("r", null, row(user))).otherwise(change("c", null, row(user)))
    values = F.array(
        created,
        F.when((k % 4 == 0) & (k % 97 != 0), change("r", null, row(user))),
        F.when(moved, change("u", row(user), row(user + 1))),
        F.when(k % 7 == 0, change("d", row(last), null)),
        F.when(k % 31 == 0, change("u", null, row(user))),
        F.when(k % 37 == 0, F.substring(created, 1, 30)),
    )
    rows = table(spark, sf_dir, "events").select("event_id", "ts", F.posexplode(values).alias("etape", "value"))
    return rows.select("event_id", F.timestamp_add("HOUR", F.col("etape"), F.col("ts")).alias("ts"), "value")


def activity_change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, arriving in several batches."""
    return _file_stream([activity_changes(spark, sf_dir)], 5, 2)


def _extract(df: DataFrame, headers: dict[str, str], **texts: Column) -> DataFrame:
    """A domain table back under its extract's headers, every value as text."""
    return df.select(*[texts.get(c, F.col(c).cast("string")).alias(header) for header, c in headers.items()])


def through_csv(extract: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """An extract written as CSV files in the shared folder and read again."""
    path = scratch_path(extract.sparkSession, "extrait")
    write_extract(extract, path)
    return read_extract(extract.sparkSession, path, headers)


def employee_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(employees(spark, sf_dir), EMPLOYEE_HEADERS)


def declared_sport_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(declared_sports(spark, sf_dir), DECLARED_SPORT_HEADERS)


def activity_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    distance = F.when(F.col("distance_m") < 0, "n/a").otherwise(F.col("distance_m").cast("string"))
    return _extract(
        activities(spark, sf_dir),
        ACTIVITY_HEADERS,
        date_debut=day_first(F.col("date_debut")),
        date_fin=day_first(F.col("date_fin")),
        distance_m=distance,
    )
