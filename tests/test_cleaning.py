import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from foulee import reference, schemas
from foulee.operators.cleaning import clean_activities, clean_employees, employee_sport_profile
from foulee.operators.enrichment import check_business_units, enrich_activities
from foulee.operators.lookup import keep_one, left_lookup

START = dt.datetime(2024, 5, 1, 8, 0)


def staff(**values):
    return {"id_salarie": 1, "salaire_brut": Decimal(1000), "type_contrat": "CDI", **values}


def move(**values):
    return {
        "id": 1,
        "id_salarie": 1,
        "type_sport": "Tennis",
        "temps_ecoule_s": 3600,
        "date_debut": START,
        "date_fin": START + dt.timedelta(hours=1),
        **values,
    }


def test_clean_employees(frame):
    rows = [
        staff(),
        staff(nom="b"),
        staff(id_salarie=None),
        staff(id_salarie=2, salaire_brut=Decimal(0)),
        staff(id_salarie=3, salaire_brut=Decimal(-1)),
        staff(id_salarie=4, salaire_brut=None),
        staff(id_salarie=5, type_contrat=None),
        staff(id_salarie=6, type_contrat="Stage"),
        staff(id_salarie=7, type_contrat="CDD", salaire_brut=Decimal("0.01")),
    ]
    kept = clean_employees(frame(rows, schemas.EMPLOYEES))
    assert kept.columns == schemas.EMPLOYEES.fieldNames()
    assert sorted((r.id_salarie, r.nom) for r in kept.collect()) == [(1, None), (7, None)]


def test_clean_activities(frame):
    rows = [
        move(),
        move(commentaire="copie"),
        move(id=2, type_sport=None),
        move(id=3, temps_ecoule_s=0),
        move(id=4, temps_ecoule_s=None),
        move(id=5, date_debut=None),
        move(id=6, date_fin=None),
        move(id=7, distance_m=-1.0),
        move(id=8, distance_m=0.0),
        move(id=9, type_sport="Runing", distance_m=5.0),
        move(id=None),
        move(id=None),
    ]
    kept = clean_activities(frame(rows, schemas.ACTIVITIES)).collect()
    assert sorted((r.id or 0, r.type_sport) for r in kept) == [
        (0, "Tennis"),
        (1, "Tennis"),
        (8, "Tennis"),
        (9, "Course à pied"),
    ]
    assert next(r.commentaire for r in kept if r.id == 1) is None


def test_keep_one_is_deterministic_and_treats_nulls_as_a_key(frame):
    df = frame([(1, "b"), (1, "a"), (None, "z"), (None, "y"), (2, None), (2, "a")], "k long, v string")
    for parts in (1, 3):
        got = {tuple(r) for r in keep_one(df.repartition(parts), ["k"]).collect()}
        assert got == {(1, "a"), (None, "y"), (2, None)}


def test_hot_key_copies_collapse_before_the_shuffle(spark):
    df = spark.range(20000).select((F.col("id") % 3 * 0).alias("k"), (F.col("id") % 7).alias("v"))
    kept = keep_one(df, ["k"])
    assert [tuple(r) for r in kept.collect()] == [(0, 0)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_sport_profile_does_not_fan_out(frame):
    employees = frame([staff(), staff(nom="a"), staff(id_salarie=2), staff(id_salarie=None)], schemas.EMPLOYEES)
    sports = frame([(1, None), (1, "Tennis"), (1, "Judo"), (None, "Rugby"), (9, "Boxe")], "id_salarie long, sport string")
    got = sorted((r.id_salarie or 0, r.sport or "") for r in employee_sport_profile(employees, sports).collect())
    assert got == [(0, "Rugby"), (1, "Judo"), (2, "")]


def test_enrichment(spark, frame):
    rows = [
        move(temps_ecoule_s=2700),
        move(id=2, temps_ecoule_s=2699),
        move(id=3, type_sport="Parkour"),
    ]
    doubled = reference.sports(spark).union(reference.sports(spark))
    got = enrich_activities(frame(rows, schemas.ACTIVITIES), doubled).collect()
    assert sorted((r.id, r.categorie, r.activite_valide) for r in got) == [
        (1, "raquette", True),
        (2, "raquette", False),
        (3, None, False),
    ]


def test_business_units(spark, frame):
    rows = [staff(bu="Finance"), staff(id_salarie=2, bu="Autre"), staff(id_salarie=3)]
    units = reference.business_units(spark).union(reference.business_units(spark))
    got = check_business_units(frame(rows, schemas.EMPLOYEES), units).collect()
    assert sorted((r.id_salarie, r.bu_valide) for r in got) == [(1, True), (2, False), (3, False)]


def test_lookup_splits_a_hot_key_and_spreads_missing_ones(spark):
    """A third of the rows share a key, a third have none; no task may get either third whole."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        n = 60000
        key = F.when(F.col("id") % 3 == 0, F.lit("chaud")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id")))
        left = spark.range(0, n, 1, 8).select("id", key.alias("k"))
        dimension = spark.range(n).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"))
        dimension = dimension.union(spark.sql("SELECT 'chaud', -1L")).union(spark.sql("SELECT 'chaud', -2L"))
        joined = left_lookup(left, dimension, ["k"], spread_by=["id"]).withColumn("tache", F.spark_partition_id())
        joined = joined.persist()
        biggest, total = joined.groupBy("tache").count().agg(F.max("count"), F.sum("count")).first()
        assert total == n
        assert joined.filter("k = 'chaud' AND v = -2").count() == n // 3
        assert joined.filter("k IS NULL AND v IS NULL").count() == n // 3
        assert joined.filter("v >= 0 AND v = id").count() == n // 3
        assert biggest < n // 4
        joined.unpersist()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_lookup_keeps_column_pruning(spark, tmp_path):
    """Counting valid activities reads neither comments nor distances."""
    row = tuple(move().get(name) for name in schemas.ACTIVITIES.fieldNames())
    spark.createDataFrame([row], schemas.ACTIVITIES).write.parquet(str(tmp_path / "a"))
    activities = spark.read.schema(schemas.ACTIVITIES).parquet(str(tmp_path / "a"))
    valid = enrich_activities(activities, reference.sports(spark)).agg(F.count_if("activite_valide"))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<type_sport:string,temps_ecoule_s:bigint>" in plan
    assert "BroadcastHashJoin" in plan
