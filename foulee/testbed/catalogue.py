"""One query per operator of the inventory, on the tables of ``foulee.testbed.tables``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foulee import reference, schemas
from foulee.operators import benefits as gold
from foulee.operators import (
    cdc,
    cleaning,
    declarations,
    distances,
    enrichment,
    messages,
    quality,
    ranking,
    reports,
    scenarios,
)
from foulee.operators.lookup import keep_one, left_lookup
from foulee.plans import medallion
from foulee.session import scratch_path
from foulee.sinks.counts import read_counts
from foulee.sinks.ids import append_numbered
from foulee.sinks.lake import rewrite_table, write_table
from foulee.sinks.rerating import rerate_table
from foulee.sources import extracts
from foulee.sources.lake import Lake, read_between, read_newest, read_table
from foulee.streaming.feeds import Once, read_outbox, start_count_feed, start_declaration_feed, start_message_feed
from foulee.testbed import tables as t
from foulee.testbed.tables import LENIENT, RULES

Query = Callable[[SparkSession, str], DataFrame]

SCENARIO_PERCENT = 8
APPLIED_RATE = Decimal("0.08")


def clean_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_employees(t.employees(spark, sf_dir), RULES)


def clean_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_activities(t.activities(spark, sf_dir))


def employee_sport_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.employee_sport_profile(t.employees(spark, sf_dir), t.declared_sports(spark, sf_dir))


def employee_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.employee_directory(t.employees(spark, sf_dir))


def enrich_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.enrich_activities(clean_activities(spark, sf_dir), reference.sports(spark))


def employee_bu_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.check_business_units(clean_employees(spark, sf_dir), reference.business_units(spark))


def employee_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distances.employee_distances(clean_employees(spark, sf_dir), t.geocodes(spark, sf_dir), RULES)


def employee_distances_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distances.employee_distances(
        keep_one(t.employees(spark, sf_dir), ["id_salarie"]), t.geocodes(spark, sf_dir), LENIENT
    )


def distance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distances.distance_report(clean_employees(spark, sf_dir), t.geocodes(spark, sf_dir), RULES)


def activity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.activity_counts(t.activities(spark, sf_dir))


def _silver_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.silver_employees(
        t.employees(spark, sf_dir), t.geocodes(spark, sf_dir), reference.business_units(spark), RULES
    )


def gold_benefits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_benefits(
        employee_distances(spark, sf_dir), clean_activities(spark, sf_dir), RULES
    )


def gold_benefits_valid_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid activities of the last year only, as the written business rule has it."""
    return gold.gold_benefits(
        employee_distances(spark, sf_dir),
        enrich_activities(spark, sf_dir),
        RULES,
        only_valid=True,
        since=t.AS_OF.replace(year=t.AS_OF.year - 1),
    )


def gold_benefits_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.lenient_benefits(
        t.employees(spark, sf_dir), t.activities(spark, sf_dir), t.geocodes(spark, sf_dir), LENIENT
    )


def top_bonuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_bonuses(gold_benefits(spark, sf_dir))


def silver_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.silver_report(
        t.employees(spark, sf_dir),
        t.activities(spark, sf_dir),
        _silver_employees(spark, sf_dir),
        enrich_activities(spark, sf_dir),
        RULES,
    )


def monitoring_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.monitoring_report(
        t.employees(spark, sf_dir), t.activities(spark, sf_dir), gold_benefits(spark, sf_dir), RULES
    )


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        t.employees(spark, sf_dir), t.activities(spark, sf_dir), gold_benefits(spark, sf_dir), RULES
    )


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_summary(quality_report(spark, sf_dir))


def orphan_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphan_ids(t.activities(spark, sf_dir), t.employees(spark, sf_dir))


def scenario_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenarios.scenario_summary(
        gold_benefits(spark, sf_dir), clean_employees(spark, sf_dir), SCENARIO_PERCENT
    )


def scenario_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenarios.scenario_costs(
        gold_benefits(spark, sf_dir), clean_employees(spark, sf_dir), SCENARIO_PERCENT
    )


def apply_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.apply_rate(gold_benefits(spark, sf_dir), clean_employees(spark, sf_dir), APPLIED_RATE, unique=True)


def restore_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.restore_rate(apply_rate(spark, sf_dir), clean_employees(spark, sf_dir), RULES, unique=True)


def latest_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.latest_activities(t.activities(spark, sf_dir), clean_employees(spark, sf_dir))


def latest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.latest_messages(t.activities(spark, sf_dir), clean_employees(spark, sf_dir))


def activity_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The templates over every activity, not only the newest."""
    names = clean_employees(spark, sf_dir).select("id_salarie", "prenom", "nom")
    return messages.activity_messages(left_lookup(t.activities(spark, sf_dir), names, ["id_salarie"], spread_by=["id"]))


def load_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracts.load_employees(t.through_csv(t.employee_extract(spark, sf_dir), extracts.EMPLOYEE_HEADERS))


def load_declared_sports(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = t.through_csv(t.declared_sport_extract(spark, sf_dir), extracts.DECLARED_SPORT_HEADERS)
    return extracts.load_declared_sports(raw)


def load_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = extracts.load_activities(t.through_csv(t.activity_extract(spark, sf_dir), extracts.ACTIVITY_HEADERS))
    return extracts.with_surrogate_id(loaded, ["id_salarie", "date_debut"])


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declarations.declaration_errors(t.declarations(spark, sf_dir), reference.declaration_limits(spark))


def declaration_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "id_salarie",
        "type_sport",
        "avec_distance",
        F.size("erreurs").alias("nb_erreurs"),
        F.array_join("erreurs", " | ").alias("erreurs"),
    )


def declarations_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declarations.accepted(_checked(spark, sf_dir))


def declarations_unvalidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declarations.declarations_unvalidated(t.declarations(spark, sf_dir))


def declaration_recap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declarations.declaration_recap(declarations_accepted(spark, sf_dir))


def cdc_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.normalise_events(t.events(spark, sf_dir))


def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.rejected_events(t.events(spark, sf_dir)).select("event_id", "motif")


def cdc_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.event_messages(
        cdc.normalise_events(t.events(spark, sf_dir)), clean_employees(spark, sf_dir), unique=True
    ).select("event_id", "message")


def cdc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream through the message feed; returns what reached the outbox."""
    outbox = scratch_path(spark, "boite")
    lake = Lake(scratch_path(spark, "lac"))
    write_table(clean_employees(spark, sf_dir), lake, "silver/salaries")
    feed = start_message_feed(
        t.event_stream(spark, sf_dir),
        lambda: read_table(spark, lake, "silver/salaries"),
        outbox,
        scratch_path(spark, "suivi"),
        trigger={"availableNow": True},
    )
    feed.awaitTermination()
    return read_outbox(spark, f"{outbox}/messages").select("event_id", "message")


def declaration_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declarations as a stream through the declaration feed; returns the accepted rows."""
    target = scratch_path(spark, "declarations")
    feed = start_declaration_feed(
        t.declarations_of(t.table_stream(spark, sf_dir, "lineitem")),
        reference.declaration_limits(spark),
        target,
        scratch_path(spark, "suivi"),
        trigger={"availableNow": True},
    )
    feed.awaitTermination()
    return read_outbox(spark, f"{target}/activites").drop("lot", "id")


def benefits_with_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benefits over loaded and declared activities."""
    declared = declarations.as_activities(declarations_accepted(spark, sf_dir))
    loaded = schemas.conform(t.activities(spark, sf_dir), schemas.ACTIVITIES)
    moves = cleaning.clean_activities(loaded.unionByName(declared))
    return gold.gold_benefits(employee_distances(spark, sf_dir), moves, RULES)


def lenient_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The all-in-one run, over tables of another schema; returns the benefits as read back."""
    lake = Lake(scratch_path(spark, "lac"))
    write_table(spark.range(1), lake, "avantages")
    sources = medallion.Sources(
        t.employees(spark, sf_dir), t.activities(spark, sf_dir), t.declared_sports(spark, sf_dir), t.raw_geocodes(spark, sf_dir)
    )
    medallion.run_lenient(spark, sources, lake, LENIENT)
    return read_table(spark, lake, "avantages")


def reference_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sport reference, which no file provides here, with the activities each sport has."""
    sports = extracts.reference_or_default(
        spark, f"{sf_dir}/sports_valides.csv", schemas.SPORT_REFERENCE, reference.sports(spark)
    )
    counts = t.activities(spark, sf_dir).groupBy("type_sport").agg(F.count(F.lit(1)).alias("nb_activites"))
    return sports.join(counts, "type_sport", "left").fillna({"nb_activites": 0})


def reference_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the reference in a CSV file."""
    path = scratch_path(spark, "sports_valides")
    extracts.write_extract(reference.sports(spark), path)
    sports = extracts.reference_or_default(spark, path, schemas.SPORT_REFERENCE, reference.sports(spark).limit(0))
    counts = t.activities(spark, sf_dir).groupBy("type_sport").agg(F.count(F.lit(1)).alias("nb_activites"))
    return sports.join(counts, "type_sport", "left").fillna({"nb_activites": 0})


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze, silver and gold through lake tables; returns gold as read back after a rewrite."""
    lake = Lake(scratch_path(spark, "lac"))
    for name, df in {
        "bronze/salaries": t.employees(spark, sf_dir),
        "bronze/activites": t.activities(spark, sf_dir),
        "silver/ref_adresses": t.geocodes(spark, sf_dir),
    }.items():
        write_table(df, lake, name)
    geocodes = read_table(spark, lake, "silver/ref_adresses")
    staff = medallion.silver_employees(
        read_table(spark, lake, "bronze/salaries"), geocodes, reference.business_units(spark), RULES
    )
    write_table(staff, lake, "silver/salaries")
    moves = medallion.silver_activities(read_table(spark, lake, "bronze/activites"), reference.sports(spark))
    write_table(moves, lake, "silver/activites")
    staff = read_table(spark, lake, "silver/salaries")
    benefits = gold.gold_benefits(staff, read_table(spark, lake, "silver/activites"), RULES)
    write_table(benefits, lake, "gold/avantages")
    rerated = gold.apply_rate(read_table(spark, lake, "gold/avantages"), staff, APPLIED_RATE, unique=True)
    rewrite_table(rerated, lake, "gold/avantages")
    return read_table(spark, lake, "gold/avantages")


def rerate_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another rate for the stored benefits: files without a bonus stay as they are."""
    lake = Lake(scratch_path(spark, "lac"))
    write_table(clean_employees(spark, sf_dir), lake, "silver/salaries")
    staff = read_table(spark, lake, "silver/salaries")
    benefits = gold_benefits(spark, sf_dir).repartitionByRange(8, "prime_sportive", "id_salarie")
    write_table(benefits, lake, "gold/avantages", track=["id_salarie"])
    rerate_table(spark, lake, "gold/avantages", staff, APPLIED_RATE, unique=True)
    return read_table(spark, lake, "gold/avantages")


def latest_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest activities of a lake table clustered by their start, from the few files that may hold them."""
    lake = Lake(scratch_path(spark, "lac"))
    write_table(
        t.activities(spark, sf_dir).repartitionByRange(16, "date_debut"), lake, "bronze/activites", track=["date_debut"]
    )
    return ranking.latest_activities(
        read_table(spark, lake, "bronze/activites"),
        clean_employees(spark, sf_dir),
        newest=lambda n: read_newest(spark, lake, "bronze/activites", "date_debut", n),
    )


def recent_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benefits over the activities of the last year, of which only the files of that year are read."""
    lake = Lake(scratch_path(spark, "lac"))
    write_table(
        enrich_activities(spark, sf_dir).repartitionByRange(16, "date_debut"), lake, "silver/activites", track=["date_debut"]
    )
    since = t.AS_OF.replace(year=t.AS_OF.year - 1)
    recent = read_between(spark, lake, "silver/activites", "date_debut", low=dt.datetime.combine(since, dt.time()))
    return gold.gold_benefits(employee_distances(spark, sf_dir), recent, RULES, only_valid=True)


def loads_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The activity extract loaded twice, the second load tried again: every row has an id of its own."""
    lake = Lake(scratch_path(spark, "lac"))
    raw = t.through_csv(t.activity_extract(spark, sf_dir), extracts.ACTIVITY_HEADERS)
    for load in ("janvier", "février", "février"):
        append_numbered(extracts.load_activities(raw), ["id_salarie", "date_debut"], lake, "bronze/activites", load)
    return read_table(spark, lake, "bronze/activites")


def counts_from_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity counts kept up to date from change events, batch by batch."""
    lake = Lake(scratch_path(spark, "lac"))
    feed = start_count_feed(
        t.activity_change_stream(spark, sf_dir), lake, "gold/compteurs", scratch_path(spark, "suivi"), "activites",
        trigger={"availableNow": True}, once=Once("ts", "60 days"),
    )
    feed.awaitTermination()
    return read_counts(spark, lake, "gold/compteurs")


def _feed_twice(spark: SparkSession, sf_dir: str) -> str:
    """The message feed over a snapshot that is taken twice; the outbox it filled."""
    outbox, lake = scratch_path(spark, "boite"), Lake(scratch_path(spark, "lac"))
    write_table(clean_employees(spark, sf_dir), lake, "silver/salaries")
    feed = start_message_feed(
        t.snapshot_twice(spark, sf_dir), lambda: read_table(spark, lake, "silver/salaries"), outbox,
        scratch_path(spark, "suivi"), trigger={"availableNow": True}, once=Once("ts", "60 days"),
    )
    feed.awaitTermination()
    return outbox


def messages_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each activity is announced once, although every event comes twice and in several batches."""
    outbox = _feed_twice(spark, sf_dir)
    return read_outbox(spark, f"{outbox}/messages").select("event_id", "message")


def feed_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the message feed observed while it wrote its batches, added up."""
    measures = read_outbox(spark, f"{_feed_twice(spark, sf_dir)}/mesures")
    return measures.groupBy("mesure").agg(F.sum("nombre").alias("nombre"))


def _comparable(query: Query) -> Query:
    """The query with decimals as doubles and dates as ISO text: types on which every engine's
    client library agrees, so that results can be compared value by value."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        as_text = {f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, T.DateType)}
        as_double = {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.DecimalType)}
        return df.withColumns({**as_text, **as_double})

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _comparable(query)
    for query in (
        clean_employees,
        clean_activities,
        employee_sport_profile,
        employee_directory,
        enrich_activities,
        employee_bu_check,
        employee_distances,
        employee_distances_lenient,
        distance_report,
        activity_counts,
        gold_benefits,
        gold_benefits_valid_only,
        gold_benefits_lenient,
        top_bonuses,
        silver_report,
        monitoring_report,
        quality_report,
        quality_summary,
        orphan_ids,
        scenario_summary,
        scenario_costs,
        apply_rate,
        restore_rate,
        latest_activities,
        latest_messages,
        activity_messages,
        load_employees,
        load_declared_sports,
        load_activities,
        declaration_errors,
        declarations_accepted,
        declarations_unvalidated,
        declaration_recap,
        cdc_normalised,
        cdc_messages,
        cdc_rejects,
        cdc_stream,
        declaration_stream,
        benefits_with_declared,
        lenient_run,
        reference_fallback,
        reference_file,
        lake_roundtrip,
        rerate_in_place,
        latest_from_lake,
        recent_from_lake,
        loads_numbered,
        counts_from_feed,
        messages_once,
        feed_measures,
    )
}
