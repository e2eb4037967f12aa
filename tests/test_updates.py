"""Stored tables kept up to date: rates in place, counts from change events, ids of many loads, feeds that repeat."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from foulee.operators import benefits, changes
from foulee.sinks import ids
from foulee.sinks.counts import merge_counts, read_counts
from foulee.sinks.ids import append_numbered, reload_numbered, reserve_ids
from foulee.sinks.lake import ConflictingWrite, write_table
from foulee.sinks.rerating import rerate_table
from foulee.sources.journal import Journal
from foulee.sources.lake import Lake, read_table, state_of
from foulee.streaming.feeds import Ledger, Once, read_outbox, start_count_feed, start_message_feed

NOON = dt.datetime(2024, 5, 1, 12)
GOLD = "id_salarie long, prime_sportive boolean, montant_prime double, jours_bienetre int, nb_activites long, date_calcul date"


def test_a_rate_in_place(spark, tmp_path):
    lake = Lake(str(tmp_path))
    rows = [(i, i < 8, 50.0 if i < 8 else 0.0, 0, i, NOON.date()) for i in range(64)]
    gold = spark.createDataFrame(rows, GOLD)
    staff = spark.createDataFrame([(i, Decimal("1000.10")) for i in (1, 2, 2, 60)] + [(None, Decimal(1))], "id_salarie long, salaire_brut decimal(12,2)")
    write_table(gold.repartitionByRange(8, "prime_sportive", "id_salarie"), lake, "g", track=["id_salarie"])
    want = sorted(map(tuple, benefits.apply_rate(gold, staff, Decimal("0.08")).collect()))
    before = set(read_table(spark, lake, "g").inputFiles())
    rewritten, kept = rerate_table(spark, lake, "g", staff, Decimal("0.08"))
    after = read_table(spark, lake, "g")
    assert sorted(map(tuple, after.collect())) == want
    assert rewritten < len(before) / 2 and len(before & set(after.inputFiles())) == kept > 0


def _change(op, before=None, after=None):
    row = lambda r: None if r is None else {"id": r[0], "id_salarie": r[1]}
    return json.dumps({"payload": {"op": op, "before": row(before), "after": row(after)}})


def _decoded(spark, values):
    return changes.decode_changes(spark.createDataFrame([(v,) for v in values], "value string"))


def test_signed_changes(spark):
    values = [
        _change("c", after=(1, 7)), _change("r", after=(2, 7)), _change("c", after=(None, 7)), _change("c", after=(3, None)),
        _change("u", (1, 7), (1, 8)), _change("d", (2, 7)), _change("u", None, (1, 7)), _change("c"), _change("d"),
        _change("x", (1, 7), (1, 7)), "{broken", "[1]", None, "{}", _change("u", (2, 5), (2, 5)),
    ]
    decoded = _decoded(spark, values)
    assert [r.motif for r in decoded.collect()] == [None] * 6 + ["before", "after", "before", "op", "json", "op", "op", None]
    found = {tuple(r) for r in changes.count_changes(decoded).collect()}
    assert found == {(7, 0, 1), (8, 1, 1), (None, 1, 1)}


def _counts(df):
    return {tuple(r) for r in df.collect()}


def test_counts_after_batches_and_replays(spark, tmp_path):
    lake, activities = Lake(str(tmp_path)), {}
    for batch_id in range(4):
        values = []
        for i in range(batch_id * 10, batch_id * 10 + 10):
            activities[i] = i % 6 if i % 5 else None
            values.append(_change("c", after=(i, activities[i])))
        for i in range(0, batch_id * 10, 3):
            if i in activities:
                old = activities[i]
                if i % 2:
                    values.append(_change("d", (i, old)))
                    del activities[i]
                else:
                    activities[i] = 100 + batch_id
                    values.append(_change("u", (i, old), (i, activities[i])))
        signed = changes.count_changes(_decoded(spark, values))
        assert merge_counts(spark, lake, "c", signed, "f", batch_id)
        assert not merge_counts(spark, lake, "c", signed, "f", batch_id)
        if batch_id:
            assert not merge_counts(spark, lake, "c", signed, "f", batch_id - 1)
        rows = spark.createDataFrame(list(activities.items()), "id long, id_salarie long")
        assert _counts(read_counts(spark, lake, "c")) == _counts(benefits.activity_counts(rows))
    files = set(read_table(spark, lake, "c").inputFiles())
    merge_counts(spark, lake, "c", changes.count_changes(_decoded(spark, [_change("c", after=(1, 3))])), "other", 0)
    assert state_of(spark, lake, "c").marks == {"lot:f": 3, "lot:other": 0}
    assert files  # each batch is one commit with its mark


def test_a_batch_that_fails_before_its_commit_is_added_once(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    signed = changes.count_changes(_decoded(spark, [_change("c", after=(1, 3))]))
    merge_counts(spark, lake, "c", signed, "f", 0)
    with monkeypatch.context() as patch:
        patch.setattr(Journal, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            merge_counts(spark, lake, "c", signed, "f", 1)
    assert merge_counts(spark, lake, "c", signed, "f", 1) and _counts(read_counts(spark, lake, "c")) == {(3, 2, 2)}


def test_a_merge_touches_the_files_of_its_buckets_only(spark, tmp_path):
    lake = Lake(str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = changes.add_counts(spark.range(5000).selectExpr("id AS id_salarie", "1L AS nb_activites", "1L AS nb_lignes"))
        merge_counts(spark, lake, "c", many, "f", 0)
        before = set(read_table(spark, lake, "c").inputFiles())
        merge_counts(spark, lake, "c", many.filter("id_salarie = 17"), "f", 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    after = read_table(spark, lake, "c")
    assert len(before) > 1 and len(before & set(after.inputFiles())) == len(before) - 1
    assert read_counts(spark, lake, "c").filter("nb_lignes = 2").count() == 1 and after.count() == 5000


def _drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"value": value, "ts": when.isoformat()}) for value, when in rows]
    (folder / name).write_text("\n".join(lines))


def _events(spark, folder):
    return spark.readStream.schema("value string, ts timestamp_ntz").option("maxFilesPerTrigger", 1).json(str(folder))


def _announce(own_id, op="c", sport="Tennis"):
    return json.dumps({"payload": {"op": op, "after": {"id": own_id, "id_salarie": 1, "type_sport": sport, "temps_ecoule_s": 600}}})


def test_a_new_snapshot_announces_nothing_again(spark, tmp_path):
    staff = spark.createDataFrame([(1, "Zoé", "Li")], "id_salarie long, prenom string, nom string")
    inbox, outbox = tmp_path / "in", str(tmp_path / "out")
    delivered = []

    def run():
        start_message_feed(
            _events(spark, inbox), lambda: staff, outbox, str(tmp_path / "suivi"), {"availableNow": True},
            deliver=lambda df, lot: delivered.append((lot, df.count())), once=Once("ts", "2 days"),
        ).awaitTermination()

    _drop(inbox, "1.json", [(_announce(1), NOON), (_announce(1, "r"), NOON), (_announce(2), NOON), ("{bad", NOON), ("{bad", NOON)])
    run()
    hour = dt.timedelta(hours=1)
    _drop(inbox, "2.json", [(_announce(1, "r"), NOON + hour), (_announce(2, "r", "Judo"), NOON), (_announce(3, "r"), NOON + hour), ("{bad", NOON)])
    run()
    _drop(inbox, "3.json", [(_announce(None), NOON + hour), (_announce(None), NOON + 2 * hour), (_announce(4, "u"), NOON), (_announce(4), NOON)])
    run()
    # With a watermark, a batch without events may follow to clean the state up.
    found = read_outbox(spark, f"{outbox}/messages").groupBy("lot").count().orderBy("lot").collect()
    assert [r["count"] for r in found] == [2, 1, 3]
    assert read_outbox(spark, f"{outbox}/rejets").count() == 1
    assert delivered == [(r.lot, r["count"]) for r in found]
    assert Ledger(spark, outbox).state() == {"livre": found[-1].lot, "commence": None, "repetes": []}
    measures = read_outbox(spark, f"{outbox}/mesures").filter("nombre > 0").orderBy("lot", "mesure").collect()
    assert [(r.mesure, r.nombre) for r in measures] == [
        ("messages", 2), ("rejets", 1), ("rejets:json", 1), ("messages", 1), ("messages", 3)
    ]
    # State is bounded: once the watermark has passed, an old row's key is gone.
    late = NOON + dt.timedelta(days=30)
    _drop(inbox, "4.json", [(_announce(9), late)])
    run()
    assert spark.read.format("statestore").load(str(tmp_path / "suivi")).count() == 1


def test_delivery_is_noted_before_and_after(spark, tmp_path):
    outbox, got = str(tmp_path), []
    ledger = Ledger(spark, outbox)
    assert ledger.deliver(0, lambda: got.append(0)) and not ledger.deliver(0, lambda: got.append(0))

    def dies():
        got.append(1)
        raise OSError("died after handing on")

    with pytest.raises(OSError):
        ledger.deliver(1, dies)
    assert ledger.state() == {"livre": 0, "commence": 1, "repetes": []}
    again = Ledger(spark, outbox)
    assert again.deliver(1, lambda: got.append(1)) and again.deliver(2, lambda: got.append(2))
    assert not again.deliver(1, lambda: got.append(1))
    assert got == [0, 1, 1, 2] and again.state() == {"livre": 2, "commence": None, "repetes": [1]}


def test_a_count_feed_that_is_replayed(spark, tmp_path):
    inbox, lake = tmp_path / "in", Lake(str(tmp_path / "lac"))

    def run(checkpoint):
        start_count_feed(
            _events(spark, inbox), lake, "c", str(tmp_path / checkpoint), "f", {"availableNow": True}, Once("ts", "9 days")
        ).awaitTermination()

    _drop(inbox, "1.json", [(_change("c", after=(1, 5)), NOON), (_change("r", after=(1, 5)), NOON), (_change("c", after=(2, 5)), NOON)])
    run("suivi")
    _drop(inbox, "2.json", [(_change("r", after=(1, 5)), NOON), (_change("d", (2, 5)), NOON), ("{", NOON)])
    run("suivi")
    assert _counts(read_counts(spark, lake, "c")) == {(5, 1, 1)}
    run("another")  # the same batches under a checkpoint that knows of none
    assert _counts(read_counts(spark, lake, "c")) == {(5, 1, 1)}


def test_ids_of_many_loads(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    load = lambda *words: spark.createDataFrame([(w,) for w in words], "w string").repartition(3)
    assert append_numbered(load("b", "a", "c"), ["w"], lake, "t", "one")
    with monkeypatch.context() as patch:
        patch.setattr(ids, "write_table", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            append_numbered(load("e", "d"), ["w"], lake, "t", "two")
    assert append_numbered(load("f"), ["w"], lake, "t", "three")
    assert append_numbered(load("e", "d"), ["w"], lake, "t", "two")  # tried again: the ids it had
    assert not append_numbered(load("e", "d"), ["w"], lake, "t", "two")
    rows = lambda: sorted((r.id, r.w) for r in read_table(spark, lake, "t").collect())
    assert rows() == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f")]
    with pytest.raises(ValueError, match="had 2 rows"):
        reserve_ids(spark, lake, "t", "two", 3)
    assert reload_numbered(load("z", "y"), ["w"], lake, "t", "again") and rows() == [(1, "y"), (2, "z")]
    assert not reload_numbered(load("z", "y"), ["w"], lake, "t", "again")
    assert append_numbered(load("x"), ["w"], lake, "t", "one") and rows() == [(1, "y"), (2, "z"), (3, "x")]
    assert append_numbered(load(), ["w"], lake, "t", "empty") and len(rows()) == 3


def test_two_loads_reserve_at_once(spark, tmp_path, monkeypatch):
    lake, real, lost = Lake(str(tmp_path)), Journal.commit, []

    def once(self, base, entries):
        if not lost:
            lost.append(reserve_ids(spark, lake, "t", "faster", 10) if not lost.append(None) else 0)
        return real(self, base, entries)

    monkeypatch.setattr(Journal, "commit", once)
    assert reserve_ids(spark, lake, "t", "slower", 5) == 11 and lost[1] == 1
    monkeypatch.setattr(Journal, "commit", lambda *a: (_ for _ in ()).throw(ConflictingWrite("always")))
    with pytest.raises(ConflictingWrite):
        reserve_ids(spark, lake, "t", "never", 1)


def test_measures_are_what_the_folders_hold(spark):
    from foulee.testbed import catalogue

    outbox = catalogue._feed_twice(spark, "/root/testdata/sf0.001")
    measured = {(r.lot, r.mesure): r.nombre for r in read_outbox(spark, f"{outbox}/mesures").collect()}
    rejected = read_outbox(spark, f"{outbox}/rejets").groupBy("lot", "motif").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {(r.lot, f"rejets:{r.motif}"): r.n for r in rejected}.items() <= measured.items()
    for lot in {lot for lot, _ in measured}:
        assert measured[lot, "messages"] == read_outbox(spark, f"{outbox}/messages").filter(F.col("lot") == lot).count()
        assert measured[lot, "rejets"] == sum(n for (own, name), n in measured.items() if own == lot and name.startswith("rejets:"))


def test_stream_files_give_every_core_one_of_each_batch(spark):
    """A file is one task's work from its writing to its decoding: batches hold as many files as there are cores."""
    from foulee.testbed import tables

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000).selectExpr("id")
    for parts, per_batch in ((3, 2), (5, 2)):
        sizes, seen = [], []

        def each(batch, _):
            found = batch.selectExpr("id", "input_file_name() AS file").collect()
            sizes.append(len({r.file for r in found}))
            seen.extend(r.id for r in found)

        stream = tables._file_stream([rows, rows], parts, per_batch, spread=True)
        stream.writeStream.foreachBatch(each).trigger(availableNow=True).start().awaitTermination()
        assert len(sizes) == -(-2 * parts // per_batch) and all(n >= cores for n in sizes)
        assert sorted(seen) == sorted([*range(1000)] * 2)
