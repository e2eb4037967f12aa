"""The batch run: bronze, silver, gold, publication, quality, monitoring, in one session."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from foulee import reference, schemas
from foulee.operators import benefits, cleaning, distances, enrichment, quality, reports
from foulee.operators.lookup import keep_one
from foulee.settings import Rules
from foulee.sinks.lake import write_table
from foulee.sinks.report import write_csv_report
from foulee.sources.lake import Lake, read_table


@dataclass(frozen=True)
class Sources:
    """Input frames of a run. References default to the built-in tables."""

    employees: DataFrame
    activities: DataFrame
    declared_sports: DataFrame
    geocodes: DataFrame
    sports: DataFrame | None = None
    business_units: DataFrame | None = None
    office_address: str | None = None
    #: Accepted declarations as activities, as the declaration feed writes them.
    declared_activities: DataFrame | None = None

    def all_activities(self) -> DataFrame:
        loaded = schemas.conform(self.activities, schemas.ACTIVITIES)
        if self.declared_activities is None:
            return loaded
        return loaded.unionByName(schemas.conform(self.declared_activities, schemas.ACTIVITIES))


@dataclass(frozen=True)
class Run:
    """What a run produced: table row counts as written, and the reports."""

    rows: dict[str, int]
    quality: DataFrame
    monitoring: DataFrame
    silver: DataFrame


def silver_employees(
    employees: DataFrame, geocodes: DataFrame, business_units: DataFrame, rules: Rules, office=None
) -> DataFrame:
    """Clean employees with distance verdict and business-unit check."""
    clean = cleaning.clean_employees(employees, rules)
    located = distances.employee_distances(clean, geocodes, rules, office)
    return enrichment.check_business_units(located, business_units)


def silver_activities(activities: DataFrame, sports: DataFrame) -> DataFrame:
    """Clean activities with category and validity."""
    return enrichment.enrich_activities(cleaning.clean_activities(activities), sports)


def lenient_benefits(
    employees: DataFrame, activities: DataFrame, geocodes: DataFrame, rules: Rules, office=None
) -> DataFrame:
    """The all-in-one variant: raw employees once each, lenient verdicts, every activity row."""
    once = keep_one(employees, ["id_salarie"])
    located = distances.employee_distances(once, geocodes, rules, office)
    return benefits.gold_benefits_lenient(located, activities, rules)


def _saver(spark: SparkSession, lake: Lake, rows: dict[str, int], replace_schema: bool = False):
    """Writes a table, notes how many rows went by, and reads it back."""

    def save(df: DataFrame, table: str) -> DataFrame:
        seen = Observation(table)
        observed = df.observe(seen, F.count(F.lit(1)).alias("lignes"))
        write_table(observed, lake, table, replace_schema=replace_schema)
        rows[table] = seen.get["lignes"]
        return read_table(spark, lake, table)

    return save


def run_medallion(
    spark: SparkSession,
    sources: Sources,
    lake: Lake,
    rules: Rules = Rules(),
    publish: Callable[[DataFrame], None] | None = None,
    report_path: str | None = None,
) -> Run:
    """Run every stage. Each table is computed once, written, and read back by the next stage.

    Row counts are observed while the tables are written, not counted again. A source that cannot
    be read stops the run where it is. The quality report is written before a critical failure
    is raised.
    """
    rows: dict[str, int] = {}
    save = _saver(spark, lake, rows)

    bronze_employees = save(schemas.conform(sources.employees, schemas.EMPLOYEES), "bronze/salaries")
    bronze_activities = save(sources.all_activities(), "bronze/activites")
    save(schemas.conform(sources.declared_sports, schemas.DECLARED_SPORTS), "bronze/sports_declares")

    sports = reference.sports(spark) if sources.sports is None else sources.sports
    units = reference.business_units(spark) if sources.business_units is None else sources.business_units
    sports = save(sports, "silver/ref_sportif")
    units = save(units, "silver/ref_entreprise")
    geocodes = save(distances.prepare_geocodes(sources.geocodes), "silver/ref_adresses")
    office = None
    if sources.office_address is not None:
        office = distances.office_coordinates(geocodes, sources.office_address)

    staff = save(silver_employees(bronze_employees, geocodes, units, rules, office), "silver/salaries")
    moves = save(silver_activities(bronze_activities, sports), "silver/activites")
    silver = reports.silver_report(bronze_employees, bronze_activities, staff, moves, rules)
    silver = save(silver, "rapports/silver")
    gold = save(benefits.gold_benefits(staff, moves, rules), "gold/avantages")
    if publish is not None:
        publish(gold)

    report = save(quality.quality_report(bronze_employees, bronze_activities, gold, rules), "rapports/qualite")
    if report_path is not None:
        write_csv_report(report.select("test", "statut", "detail"), report_path)
    quality.require_no_critical_failure(report)
    totals = save(reports.monitoring_report(bronze_employees, bronze_activities, gold, rules), "rapports/suivi")
    return Run(rows, report, totals, silver)


def run_lenient(
    spark: SparkSession,
    sources: Sources,
    lake: Lake,
    rules: Rules,
    publish: Callable[[DataFrame], None] | None = None,
) -> dict[str, int]:
    """The all-in-one run: raw tables as they come and the lenient benefits, each replaced with its schema.

    Returns the rows of each table. ``rules`` carry the lenient policy.
    """
    rows: dict[str, int] = {}
    save = _saver(spark, lake, rows, replace_schema=True)
    employees = save(sources.employees, "brut/salaries")
    activities = save(sources.all_activities(), "brut/activites")
    geocodes = distances.prepare_geocodes(sources.geocodes)
    office = None
    if sources.office_address is not None:
        office = distances.office_coordinates(geocodes, sources.office_address)
    benefits_table = save(lenient_benefits(employees, activities, geocodes, rules, office), "avantages")
    if publish is not None:
        publish(benefits_table)
    return rows
