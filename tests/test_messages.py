import datetime as dt
import json
import struct
from base64 import b64encode

import pytest

from foulee import schemas
from foulee.operators import cdc, messages, ranking

NOW = dt.datetime(2024, 5, 1, 18, 30)


@pytest.fixture
def staff(frame):
    rows = [{"id_salarie": 1, "nom": "Dupont", "prenom": "Léa"}, {"id_salarie": 2, "nom": "Roux", "prenom": "Max"}]
    return frame(rows, schemas.EMPLOYEES)


def event(op="c", **after):
    return json.dumps({"payload": {"op": op, "after": after}})


FULL = {"id_salarie": 1, "type_sport": "Course à pied", "distance_m": 5000.0, "temps_ecoule_s": 1800}
EVENTS = [
    event(**FULL, commentaire="ok"),
    event(op="r", **{**FULL, "type_sport": "Trail Run", "id_salarie": 9, "commentaire": "  "}),
    event(**{**FULL, "type_sport": "Randonnée", "distance_m": "12350"}),
    event(id_salarie=2, distance_m=b64encode(struct.pack(">d", 1500.0)).decode(), temps_ecoule_s=None),
    event(**{**FULL, "distance_m": b64encode((123456).to_bytes(3, "big")).decode(), "type_sport": "Vélo"}),
    event(op="u", **FULL),
    event(op="d", **FULL),
    '{"payload": {"op": "c", "after": null}}',
    '{"payload": {"op": "c"}}',
    "{}",
    None,
    '{"payload": {"op": "c", ',
    "[1]",
    event(**{**FULL, "type_sport": None}),
    event(**{**FULL, "temps_ecoule_s": "bientôt"}),
    event(**{**FULL, "distance_m": None, "temps_ecoule_s": 90.9, "type_sport": "run"}),
]


@pytest.fixture
def feed(frame):
    return frame(list(enumerate(EVENTS)), "n long, value string")


def test_event_messages(feed, staff):
    got = {r.n: r.message for r in messages.event_messages(cdc.normalise_events(feed), staff).collect()}
    assert got == {
        0: "Bravo *Léa Dupont* ! Tu viens de courir 5.0 km en 30 min ! Quelle énergie ! 🏃‍♂️🔥\n> _ok_",
        1: "Bravo *Salarié 9* ! Tu viens de courir 5.0 km en 30 min ! Quelle énergie ! 🏃‍♂️🔥",
        2: "Magnifique *Léa Dupont* ! Une randonnée de 12.3 km terminée ! 🥾",
        3: "Bravo *Max Roux* ! 1.5 km de Sport en 0 min ! 🏅",
        4: "Bravo *Léa Dupont* ! 1.2 km de Vélo en 30 min ! 🏅",
        15: "Bravo *Léa Dupont* ! 0.0 km de run en 2 min ! 🏅",
    }


def test_rejects(feed):
    got = {r.n: r.motif for r in cdc.rejected_events(feed).collect()}
    assert got == {11: "json", 12: "json", 13: "type_sport", 14: "temps_ecoule_s"}


def test_events_are_parsed_once(feed):
    plan = cdc.normalise_events(feed)._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("parsejson(") == 1


@pytest.fixture
def moves(frame):
    rows = [
        (1, 1, "Runing", 12350.0, 90, None),
        (2, 1, "Randonnée", 8000.0, 3600, "vue"),
        (3, 2, "Randonnée", None, 3600, " "),
        (4, 2, "Natation", 1550.4, 1800, None),
        (5, 7, "Natation", 0.0, 1800, None),
        (6, None, "Parkour", 10.0, None, None),
        (7, 2, "Football", None, 5400, None),
        (8, 1, "Tennis", None, 5400, None),
    ]
    rows = [(*row, NOW + dt.timedelta(hours=row[0] // 2)) for row in rows]
    return frame(
        rows,
        "id long, id_salarie long, type_sport string, distance_m double, temps_ecoule_s long, commentaire string, "
        "date_debut timestamp_ntz",
    )


def test_latest_messages(moves, staff):
    got = {r.id: r.message for r in messages.latest_messages(moves, staff).collect()}
    assert got == {
        1: "Superbe sortie Léa Dupont ! 12.3 km avalés en 2 min ! Respect ! 💪",
        2: "Magnifique Léa Dupont ! Une randonnée de 8.0 km terminée ! 🥾🌄\n> _vue_",
        3: "Bravo Max Roux ! ? km de randonnée en 60 min ! Nature lover ! 🌿",
        4: "Splash ! Max Roux vient de nager 1550 m en 30 min ! 🏊‍♂️💦",
        5: "Bravo Salarié 7 ! ? m dans l'eau en 30 min ! Champion(ne) ! 🏊",
        6: "Bravo Salarié ? ! Belle séance de Parkour de ? min ! 🏅",
        7: "Superbe Max Roux ! 90 min de Football au compteur ! ⚽",
        8: "Ace ! Léa Dupont vient de jouer 90 min de tennis ! 🎾",
    }
    assert sorted(r.id for r in messages.latest_messages(moves, staff, 3).collect()) == [6, 7, 8]


def test_latest_activities(moves, staff):
    got = ranking.latest_activities(moves, staff, 3).collect()
    assert [(r.id, r.salarie, r.km, r.minutes, r.date) for r in got] == [
        (8, "Léa Dupont", None, 90.0, "2024-05-01 22:30:00"),
        (7, "Max Roux", None, 90.0, "2024-05-01 21:30:00"),
        (4, "Max Roux", 1.6, 30.0, "2024-05-01 20:30:00"),
    ]


def test_latest_activities_when_the_newest_are_all_unknown(spark, staff):
    """More unknown employees in front than the first probe holds: the whole join answers."""
    moves = spark.range(500).selectExpr(
        "id",
        "IF(id < 3, 1L, 1000L + id) AS id_salarie",
        "'Tennis' AS type_sport",
        "CAST(NULL AS DOUBLE) AS distance_m",
        "60L AS temps_ecoule_s",
        "CAST(NULL AS STRING) AS commentaire",
        "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, CAST(id AS INT)) AS date_debut",
    )
    assert [r.id for r in ranking.latest_activities(moves, staff, 2).collect()] == [2, 1]


def test_directory_and_top(frame, staff):
    assert [r.nom for r in ranking.employee_directory(staff).collect()] == ["Dupont", "Roux"]
    gold = frame([{"id_salarie": i, "montant_prime": float(i // 2)} for i in range(8)], schemas.BENEFITS)
    assert [r.id_salarie for r in ranking.top_bonuses(gold, 3).collect()] == [6, 7, 4]


def test_values_in_braces_are_not_expanded(spark, frame):
    named = frame(
        [(2, 7, "{nom} {sport}", 1000.0, 600, "{prenom} {x}", "Zoé", "Durand")],
        "id long, id_salarie long, type_sport string, distance_m double, temps_ecoule_s long, commentaire string, prenom string, nom string",
    )
    message = messages.activity_messages(named).first().message
    assert "{nom} {sport}" in message and "Zoé Durand" in message and "{duree}" not in message


def test_tied_rows_give_one_listing_for_any_order_and_probe(spark, frame):
    import datetime as dt

    from foulee.operators.ranking import latest_activities

    when = dt.datetime(2024, 1, 1, 10)
    rows = [
        {"id": 1, "id_salarie": 7, "type_sport": s, "distance_m": 5.0, "temps_ecoule_s": 60, "commentaire": c, "date_debut": when}
        for s, c in (("b", None), ("a", "y"), ("a", None), (None, "x"))
    ]
    staff = frame([{"id_salarie": 7, "nom": "N", "prenom": "P"}], schemas.EMPLOYEES)
    found = {
        tuple(map(tuple, latest_activities(frame(order, schemas.ACTIVITIES), staff, 2, probe_factor=factor).collect()))
        for order in (rows, rows[::-1], rows[2:] + rows[:2])
        for factor in (1, 20)
    }
    assert len(found) == 1
    strangers = [dict(r, id_salarie=8, date_debut=when + dt.timedelta(hours=1)) for r in rows]
    whole = latest_activities(frame(strangers + rows, schemas.ACTIVITIES), staff, 2, probe_factor=1)  # the probe finds none
    assert tuple(map(tuple, whole.collect())) == next(iter(found))


def test_every_event_is_a_message_a_reject_or_nothing(spark, frame):
    import json

    after = {"id_salarie": 7, "type_sport": "Tennis", "distance_m": 5, "temps_ecoule_s": 60, "commentaire": None}
    event = lambda **changes: json.dumps({"payload": {"op": "c", "after": {**after, **changes}}})
    cases = {
        event(): None, '{"payload": null}': "payload", '{"payload": [1]}': "payload", "{}": None, "[1]": "json", "{": "json", "": "json",
        '{"payload": {"op": "d", "after": 5}}': None, '{"payload": {"op": "c", "after": 5}}': "after",
        '{"payload": {"op": "c", "after": {}}}': None, '{"payload": {"op": "c", "after": null}}': None, '{"payload": {"op": "r"}}': None,
        event(type_sport=7): "type_sport", event(type_sport=None): "type_sport", event(type_sport=["Run"]): "type_sport",
        event(temps_ecoule_s="12.7"): "temps_ecoule_s", event(temps_ecoule_s=" 1_2 "): None, event(temps_ecoule_s=12.9): None,
        event(temps_ecoule_s=True): None, event(temps_ecoule_s=[1]): "temps_ecoule_s", event(temps_ecoule_s=""): None,
        event(commentaire=3): "commentaire", event(commentaire=""): None, event(distance_m=True): None, event(distance_m={"a": 1}): None,
    }
    rows = cdc.decode_events(frame([(i, v) for i, v in enumerate(cases)], "n long, value string")).collect()
    assert {r.n: r.motif for r in rows} == dict(enumerate(cases.values()))
    got = {r.value: r for r in rows}
    assert got[event(distance_m=True)].distance_m == 1.0 and got[event(distance_m={"a": 1})].distance_m == 0.0
    assert [got[event(temps_ecoule_s=x)].temps_ecoule_s for x in (" 1_2 ", 12.9, True, "")] == [12, 12, 1, 0]


def test_a_batch_does_not_group_the_staff(spark, frame, tmp_path):
    from foulee.streaming.feeds import batch_messages

    staff = frame([{"id_salarie": i, "nom": "N", "prenom": "P"} for i in range(50)], schemas.EMPLOYEES)
    staff.write.parquet(str(tmp_path / "staff"))
    events = frame([(1, '{"payload": {"op": "c", "after": {"id_salarie": 7, "type_sport": "Tennis"}}}')], "n long, value string")
    df = batch_messages(cdc.decode_events(events), spark.read.parquet(str(tmp_path / "staff")))
    assert df.first().message.startswith("Bravo *P N*")
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(plan) if "Relation" in line and "id_salarie" in line)
    depth = plan[scan].index("+-") if "+-" in plan[scan] else 0
    above = [line for line in plan[:scan] if "Aggregate" in line and line.index("Aggregate") < depth]
    assert not above


def test_compaction_keeps_every_row_once(spark, tmp_path):
    from foulee.streaming.feeds import compact_outbox, read_outbox

    path = str(tmp_path / "messages")
    for lot in range(5):
        spark.range(lot, lot + 2).write.parquet(f"{path}/lot={lot}")
    want = sorted((i, lot) for lot in range(5) for i in (lot, lot + 1))
    read = lambda: sorted((r.id, r.lot) for r in read_outbox(spark, path).collect())
    assert read() == want
    compact_outbox(spark, path, 3)
    assert read() == want and len(list((tmp_path / "messages").glob("lot=*"))) == 2
    spark.range(2, 4).write.parquet(f"{path}/lot=2")  # as if the removal had been interrupted
    assert read() == want
    compact_outbox(spark, path, 5)
    assert read() == want and not list((tmp_path / "messages").glob("lot=*"))
