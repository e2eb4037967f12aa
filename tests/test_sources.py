import datetime as dt
from decimal import Decimal
from inspect import signature

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from foulee import reference, schemas
from foulee.session import shared_folder
from foulee.sinks import jdbc as jdbc_sink
from foulee.sinks.lake import SchemaMismatch, rewrite_table, write_table
from foulee.sinks.report import write_csv_report
from foulee.sources import extracts, jdbc, kafka
from foulee.sources.lake import Lake, find_table, read_table


def test_activity_extract(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "ID,ID salarié,Date de début,Type,Distance (m),Temps écoulé (s),Date de fin,Commentaire\n"
        "7,1,05/03/2024 08:15,Tennis,,3600,05/03/2024 09:15,ok\n"
        "8,2,5/3/2024 8:05,Randonnée,12.5,60,5/3/2024 8:06,\n"
        "9,2,05/03/2024 08:05,Natation,12d,60,05/03/2024 08:06,\n",
        encoding="utf-8",
    )
    raw = extracts.read_extract(spark, str(tmp_path), extracts.ACTIVITY_HEADERS)
    loaded = extracts.with_surrogate_id(extracts.load_activities(raw), ["id_salarie", "date_debut"])
    assert sorted(loaded.columns) == sorted(schemas.ACTIVITIES.fieldNames())
    got = [(r.id, r.id_salarie, r.type_sport, r.distance_m, r.date_debut) for r in loaded.orderBy("id").collect()]
    assert got == [
        (1, 1, "Tennis", None, dt.datetime(2024, 3, 5, 8, 15)),
        (2, 2, "Natation", None, dt.datetime(2024, 3, 5, 8, 5)),
        (3, 2, "Randonnée", 12.5, dt.datetime(2024, 3, 5, 8, 5)),
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_bad_timestamp_stops_the_load(spark, frame, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        schema = ", ".join(f"`{header}` string" for header in extracts.ACTIVITY_HEADERS)
        raw = frame([(None, "1", "hier", "Tennis", None, "60", None, None)], schema)
        with pytest.raises(Exception, match="hier"):
            extracts.load_activities(raw).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_wrong_header_stops_the_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Sport,ID salarié\nTennis,1\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        extracts.read_extract(spark, str(tmp_path), extracts.DECLARED_SPORT_HEADERS).collect()


def test_employee_and_sport_extracts(spark, tmp_path):
    (tmp_path / "e.csv").write_text(
        ",".join(extracts.EMPLOYEE_HEADERS)
        + '\n1,Dupont,Léa,1990-02-03,R&D,2020-01-01,31000.5,CDI,25,"1, rue A",x\n',
        encoding="utf-8",
    )
    raw = extracts.read_extract(spark, str(tmp_path / "e.csv"), extracts.EMPLOYEE_HEADERS)
    row = extracts.load_employees(raw).first()
    assert (row.id_salarie, row.salaire_brut, row.date_naissance, row.adresse) == (
        1, Decimal("31000.50"), dt.date(1990, 2, 3), "1, rue A",
    )
    (tmp_path / "s.csv").write_text("ID salarié,Pratique d'un sport\n1,Tennis\n2,\n", encoding="utf-8")
    raw = extracts.read_extract(spark, str(tmp_path / "s.csv"), extracts.DECLARED_SPORT_HEADERS)
    assert [tuple(r) for r in extracts.load_declared_sports(raw).collect()] == [(1, "Tennis"), (2, None)]


def test_surrogate_ids_are_dense_and_spread_equal_rows(spark):
    """A third of the rows are equal; they still spread over the ranges."""
    df = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("a"), F.lit("x").alias("b")
    )
    numbered = extracts.with_surrogate_id(df, ["a"], partitions=6).withColumn("p", F.spark_partition_id())
    rows = numbered.collect()
    assert sorted(r.id for r in rows) == list(range(1, 9001))
    ordered = sorted(rows, key=lambda r: r.id)
    assert [r.a for r in ordered] == sorted(r.a for r in rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1KB")  # one staged range per task
    try:
        sizes = [r["count"] for r in numbered.groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(sizes) == 9000 and max(sizes) < 9000 / 3


def test_reference_fallback(spark, tmp_path):
    default, absent = reference.sports(spark), str(tmp_path / "absent.csv")
    assert extracts.reference_or_default(spark, absent, schemas.SPORT_REFERENCE, default) is default
    assert extracts.reference_or_default(spark, None, schemas.SPORT_REFERENCE, default) is default
    file = tmp_path / "sports.csv"
    file.write_text("type_sport,duree_min_s,categorie\nTennis,60,x\nTennis,90,y\n", encoding="utf-8")
    table = extracts.reference_or_default(spark, str(file), schemas.SPORT_REFERENCE, default)
    assert [tuple(r) for r in table.collect()] == [("Tennis", 60, "x")]
    file.write_text("nom,duree_min_s,categorie\nTennis,60,x\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        extracts.reference_or_default(spark, str(file), schemas.SPORT_REFERENCE, default).collect()


def test_fixed_tables(spark):
    assert reference.sports(spark).count() == 16 and reference.business_units(spark).count() == 5
    assert reference.declaration_limits(spark).filter("dist_max IS NULL").count() == 9
    assert reference.message_templates(spark).count() == 15


def test_lake(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert find_table(spark, lake, "a/b") is None
    with pytest.raises(AnalysisException):
        read_table(spark, lake, "a/b")
    df = spark.range(3).withColumn("v", F.lit("x"))
    write_table(df, lake, "a/b", partition_by=["v"])
    write_table(df.filter("id < 2"), lake, "a/b", partition_by=["v"])
    assert read_table(spark, lake, "a/b").count() == 2
    other = spark.range(1).withColumn("w", F.lit(1))
    with pytest.raises(SchemaMismatch):
        write_table(other, lake, "a/b")
    write_table(other, lake, "a/b", replace_schema=True)
    assert read_table(spark, lake, "a/b").columns == ["id", "w"]
    write_table(other, lake, "a/b", mode="append")
    rewrite_table(read_table(spark, lake, "a/b").withColumn("w", F.col("w") + 1), lake, "a/b")
    assert [tuple(r) for r in read_table(spark, lake, "a/b").collect()] == [(0, 2), (0, 2)]


def test_csv_report(spark, frame, tmp_path):
    write_csv_report(frame([("a", "✅ PASS", "")], "test string, statut string, detail string"), str(tmp_path / "r"))
    files = list((tmp_path / "r").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text(encoding="utf-8").splitlines()[0] == "test,statut,detail"


def test_jdbc_options():
    assert jdbc.read_options("u", "t", {"user": "x"}) == {
        "url": "u", "dbtable": "t", "preferTimestampNTZ": "true", "user": "x"
    }
    wide = jdbc.read_options("u", "t", column="id", bounds=(1, 1), partitions=4)
    assert (wide["lowerBound"], wide["upperBound"], wide["numPartitions"]) == ("1", "2", "4")
    assert jdbc.bounds_query("t", "id") == "SELECT MIN(id) AS lo, MAX(id) AS hi FROM t"
    assert jdbc_sink.write_options("u", "t", cascade=True)["cascadeTruncate"] == "true"
    assert jdbc_sink.write_options("u", "t")["truncate"] == "true"


def test_reload_order(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(
        jdbc_sink, "publish", lambda df, url, table, *a, mode="overwrite", **k: calls.append((mode, table, df.count()))
    )
    jdbc_sink.reload_tables([("parents", spark.range(2)), ("enfants", spark.range(3))], "u")
    assert calls == [
        ("overwrite", "enfants", 0), ("overwrite", "parents", 0), ("append", "parents", 2), ("append", "enfants", 3)
    ]


def test_kafka_options():
    assert kafka.feed_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest"
    }
    assert kafka.feed_options("h:1", "t", "earliest", 10)["maxOffsetsPerTrigger"] == "10"


def test_a_feed_is_read_in_bounded_batches():
    assert signature(kafka.read_feed).parameters["per_trigger"].default == kafka.PER_TRIGGER


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_extract_reads_what_pandas_reads(spark, tmp_path):
    import pandas as pd

    from foulee.sources import extracts

    file = tmp_path / "activites.csv"
    rows = ['1,7,01/02/2024 10:00,Tennis,,600,01/02/2024 10:10,"dit ""super"", oui"', '2,7,01/02/2024 11:00,Judo,5.5,60,,"ligne un\nligne deux"']
    file.write_text("\n".join([",".join(extracts.ACTIVITY_HEADERS), *rows]) + "\n", encoding="utf-8")
    want = pd.read_csv(file, dtype=str).astype(object).where(lambda x: x.notna(), None).to_numpy().tolist()
    got = [list(r) for r in extracts.read_extract(spark, str(file), extracts.ACTIVITY_HEADERS).collect()]
    assert got == want and len(got) == 2


def test_a_broken_row_fails_instead_of_loading_as_nulls(spark, tmp_path):
    from foulee.sources import extracts

    file = tmp_path / "sports.csv"
    file.write_text("ID salarié,Pratique d'un sport\n1,\"a\nb\"\n2,c\n", encoding="utf-8")
    assert extracts.read_extract(spark, str(file), extracts.DECLARED_SPORT_HEADERS).count() == 2
    split = extracts.read_extract(spark, str(file), extracts.DECLARED_SPORT_HEADERS, multi_line=False)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        split.collect()


def test_written_extracts_come_back_unchanged(spark, tmp_path):
    from foulee.sources import extracts

    rows = [("1", ' "a", b\n\nc '), ("2", None), (None, "\\ ' ;"), ("3", '""'), ("4", "  ")]
    df = spark.createDataFrame(rows, "`ID salarié` string, `Pratique d'un sport` string")
    extracts.write_extract(df, str(tmp_path / "x"))
    back = extracts.read_extract(spark, str(tmp_path / "x"), extracts.DECLARED_SPORT_HEADERS)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
