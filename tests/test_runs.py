import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from foulee import reference, schemas
from foulee.operators import cdc, messages, quality
from foulee.plans.medallion import Sources, run_medallion
from foulee.settings import WALKING, Rules
from foulee.sources.lake import Lake, read_table
from foulee.streaming.feeds import read_outbox, start_declaration_feed, start_message_feed

NOW = dt.datetime(2024, 5, 1, 18, 30)
RULES = Rules(as_of=dt.date(2024, 6, 1))


@pytest.fixture
def sources(frame):
    staff = [
        {
            "id_salarie": i, "nom": f"N{i}", "prenom": "P", "bu": "Finance", "date_embauche": dt.date(2020, 1, 1),
            "salaire_brut": Decimal(1000 * i), "type_contrat": "CDI", "adresse": f"{i} rue A", "moyen_deplacement": WALKING,
        }
        for i in (1, 2)
    ]
    moves = [
        {
            "id": n, "id_salarie": 1 + n % 2, "type_sport": "Tennis", "temps_ecoule_s": 3600,
            "date_debut": NOW + dt.timedelta(minutes=n), "date_fin": NOW + dt.timedelta(minutes=n + 60),
        }
        for n in range(31)
    ]
    return Sources(
        employees=frame(staff, schemas.EMPLOYEES),
        activities=frame(moves, schemas.ACTIVITIES),
        declared_sports=frame([{"id_salarie": 1, "sport": "Tennis"}], schemas.DECLARED_SPORTS),
        geocodes=frame(
            [{"adresse": "1 Rue A", "lat": 43.6, "lon": 3.9}, {"adresse": "siège", "lat": 43.61, "lon": 3.9}],
            schemas.GEOCODES,
        ),
        office_address="Siège",
    )


def test_whole_run(spark, sources, tmp_path):
    published = []
    run = run_medallion(
        spark, sources, Lake(str(tmp_path / "lac")), RULES, published.append, str(tmp_path / "rapport")
    )
    assert run.rows["bronze/activites"] == 31 and run.rows["gold/avantages"] == 2
    gold = {r.id_salarie: tuple(r)[1:5] for r in published[0].collect()}
    assert gold == {1: (True, 50.0, 5, 16), 2: (False, 0.0, 5, 15)}
    assert quality.quality_summary(run.quality).first().nb_fail == 0
    assert run.monitoring.first().cout_primes == 50.0
    staff = read_table(spark, Lake(str(tmp_path / "lac")), "silver/salaries")
    assert {r.id_salarie: r.declaration_ok for r in staff.collect()} == {1: True, 2: None}
    # the same run again replaces every table
    assert run_medallion(spark, sources, Lake(str(tmp_path / "lac")), RULES).rows == run.rows


def test_critical_failure_is_reported_before_it_stops_the_run(spark, sources, tmp_path):
    doubled = Sources(**{**sources.__dict__, "employees": sources.employees.union(sources.employees)})
    with pytest.raises(quality.CriticalQualityError):
        run_medallion(spark, doubled, Lake(str(tmp_path / "lac")), RULES, report_path=str(tmp_path / "rapport"))
    assert list((tmp_path / "rapport").glob("*.csv"))
    # one benefit row per clean employee even so
    assert read_table(spark, Lake(str(tmp_path / "lac")), "gold/avantages").count() == 2


def test_a_missing_source_stops_the_run(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_table(spark, Lake(str(tmp_path)), "bronze/salaries")


def _drop(folder, name, values):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"value": v}) + "\n" for v in values), encoding="utf-8")


def test_message_feed_equals_batch_and_resumes(spark, sources, tmp_path):
    good = '{"payload": {"op": "c", "after": {"id_salarie": %d, "type_sport": "Judo", "temps_ecoule_s": 60}}}'
    inbox, outbox = tmp_path / "entree", str(tmp_path / "boite")
    delivered = []

    def run():
        events = spark.readStream.schema("value string").json(str(inbox))
        start_message_feed(
            events, lambda: sources.employees, outbox, str(tmp_path / "suivi"), {"availableNow": True},
            lambda batch, n: delivered.append((n, batch.count())),
        ).awaitTermination()

    _drop(inbox, "1.json", [good % 1, "{bad", None])
    run()
    _drop(inbox, "2.json", [good % 7])
    run()
    run()
    got = sorted(r.message for r in read_outbox(spark, f"{outbox}/messages").collect())
    batch = spark.read.schema("value string").json(str(inbox))
    expected = messages.event_messages(cdc.normalise_events(batch), sources.employees)
    assert got == sorted(r.message for r in expected.collect()) and len(got) == 2
    assert [r.motif for r in read_outbox(spark, f"{outbox}/rejets").collect()] == ["json"]
    assert delivered == [(0, 1), (1, 1)]


def test_declaration_feed(spark, tmp_path):
    schema = (
        "id_salarie long, type_sport string, distance_m double, duree_s long, commentaire string, "
        "date_debut timestamp_ntz"
    )
    rows = [(1, "Tennis", None, 3600, " ok ", NOW), (2, "Tennis", None, 10, None, NOW)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    start_declaration_feed(
        spark.readStream.schema(schema).parquet(str(tmp_path / "in")),
        reference.declaration_limits(spark),
        str(tmp_path / "out"),
        str(tmp_path / "suivi"),
        {"availableNow": True},
    ).awaitTermination()
    row = read_outbox(spark, str(tmp_path / "out/activites")).first()
    assert (row.id_salarie, row.commentaire, row.date_fin) == (1, "ok", NOW + dt.timedelta(hours=1))
    refused = read_outbox(spark, str(tmp_path / "out/refus")).select("id_salarie", F.size("erreurs")).collect()
    assert [tuple(r) for r in refused] == [(2, 1)]


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    from pyspark.sql import functions as F

    from foulee.sinks.lake import write_table
    from foulee.sources.lake import Lake, read_table

    lake = Lake(str(tmp_path))
    write_table(spark.range(10), lake, "t")
    half = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        write_table(half.repartition(2), lake, "t")
    assert read_table(spark, lake, "t").count() == 10


def test_versions(spark, tmp_path):
    from foulee.sinks.lake import SchemaMismatch, rewrite_table, write_table
    from foulee.sources.lake import Lake, find_table, read_table

    lake = Lake(str(tmp_path))
    assert find_table(spark, lake, "a/t") is None
    write_table(spark.range(3), lake, "a/t")
    write_table(spark.range(3, 5), lake, "a/t", mode="append")
    open_reader = read_table(spark, lake, "a/t")
    rewrite_table(open_reader.selectExpr("id * 10 AS id"), lake, "a/t")
    assert sorted(r.id for r in read_table(spark, lake, "a/t").collect()) == [0, 10, 20, 30, 40]
    assert open_reader.count() == 5
    rewrite_table(read_table(spark, lake, "a/t").selectExpr("id + 1 AS id"), lake, "a/t")
    assert sorted(r.id for r in read_table(spark, lake, "a/t").collect()) == [1, 11, 21, 31, 41]
    assert len(list((tmp_path / "a/t/_versions").iterdir())) == 2
    with pytest.raises(SchemaMismatch):
        write_table(spark.range(3).selectExpr("id AS x"), lake, "a/t")
    write_table(spark.range(3).selectExpr("id AS x"), lake, "a/t", replace_schema=True)
    assert read_table(spark, lake, "a/t").columns == ["x"]


def test_a_declared_activity_crosses_the_threshold(spark, frame):
    from foulee.operators import benefits, declarations

    when = dt.datetime(2024, 1, 1, 10)
    staff = frame([{"id_salarie": 7, "salaire_brut": Decimal("1000"), "moyen_deplacement": WALKING}], schemas.EMPLOYEES)
    staff = staff.withColumn("declaration_ok", F.lit(True))
    loaded = frame([{"id": i, "id_salarie": 7, "type_sport": "Judo", "temps_ecoule_s": 600, "date_debut": when, "date_fin": when} for i in range(1, 15)], schemas.ACTIVITIES)
    declared = frame([(7, when, "Judo", 900, None, "  ")], "id_salarie long, date_debut timestamp_ntz, type_sport string, duree_s long, distance_m double, commentaire string")
    rows = declarations.as_activities(declarations.declarations_accepted(declared, reference.declaration_limits(spark)))
    again = declarations.as_activities(declarations.declarations_accepted(declared, reference.declaration_limits(spark)))
    assert rows.first().id < 0 and rows.first().id == again.first().id
    days = lambda moves: benefits.gold_benefits(staff, moves, Rules()).first().jours_bienetre
    assert days(loaded) == 0 and days(loaded.unionByName(rows)) > 0


def test_raw_schemas_of_the_queries(spark):
    """The comparison with SQL softens money and dates; the operators' own types are these."""
    from foulee.testbed import catalogue

    sf_dir = "/root/testdata/sf0.001"
    money, day = "decimal(12,2)", "date"
    types = {
        name: dict(getattr(catalogue, name)(spark, sf_dir).dtypes) for name in ("clean_employees", "gold_benefits", "load_employees", "load_activities")
    }
    assert types["clean_employees"]["salaire_brut"] == money and types["clean_employees"]["date_embauche"] == day
    assert types["load_employees"] == {f.name: f.dataType.simpleString() for f in schemas.EMPLOYEES}
    assert {n: t for n, t in types["load_activities"].items()} == {f.name: f.dataType.simpleString() for f in schemas.ACTIVITIES}
    assert types["gold_benefits"]["date_calcul"] == day and types["gold_benefits"]["montant_prime"] == "double"


def test_staged_tables_go_with_their_block(spark):
    from pathlib import Path

    from foulee.session import shared_folder, staged, staging

    folder = Path(shared_folder(spark))
    before = set(folder.glob("probe-*"))
    with staging(spark):
        assert staged(spark.range(3), "probe").count() == 3
        assert len(set(folder.glob("probe-*")) - before) == 1
        with staging(spark):
            staged(spark.range(4), "probe")
        assert len(set(folder.glob("probe-*")) - before) == 1
    assert set(folder.glob("probe-*")) == before
    kept = staged(spark.range(5), "probe")
    assert kept.count() == 5
