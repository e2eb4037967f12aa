import datetime as dt

import pytest

from foulee import reference
from foulee.operators import declarations as d

NOW = dt.datetime(2024, 5, 1, 18, 30)
SCHEMA = (
    "id_salarie long, type_sport string, distance_m double, duree_s long, commentaire string, date_debut timestamp_ntz"
)


@pytest.fixture
def errors(spark, frame):
    def run(*cases, **options):
        rows = [(n, sport, metres, seconds, None, NOW) for n, (sport, metres, seconds) in enumerate(cases)]
        checked = d.declaration_errors(frame(rows, SCHEMA), reference.declaration_limits(spark), **options)
        return [r.erreurs for r in checked.orderBy("id_salarie").collect()]

    return run


SHORT = "Duree trop courte : minimum 5 minutes."
NONE = "La duree doit etre superieure a 0 seconde."


def test_durations(errors):
    got = errors(
        ("Tennis", None, -1), ("Tennis", None, 0), ("Tennis", None, 299), ("Tennis", None, 300),
        ("Tennis", None, 21600), ("Tennis", None, 21601), ("Tennis", None, None),
        ("Parkour", None, 86400), ("Parkour", None, 90000),
    )
    assert got == [
        [NONE, SHORT], [NONE, SHORT], [SHORT], [], [],
        ["Duree trop longue pour Tennis : max 6.0h (vous avez saisi 6.0h)."],
        [NONE, SHORT], [],
        ["Duree trop longue pour Parkour : max 24.0h (vous avez saisi 25.0h)."],
    ]


def test_distance_and_speed(errors):
    got = errors(
        ("Randonnée", 2500.0, 3600),  # at the top speed
        ("Randonnée", 2501.0, 3600),
        ("Randonnée", 500.0, 3600),  # at the lowest speed
        ("Randonnée", 499.0, 3600),
        ("Randonnée", 0.0, 3600),
        ("Randonnée", None, 3600),
        ("Natation", 20000.0, 28800),
        ("Natation", 20050.0, 28800),
        ("Tennis", 999999.0, 3600),  # no distance for this sport
        ("Course à pied", 5000.0, 1800),
        ("Course à pied", 5000.0, 0),
    )
    too_fast = "Vitesse impossible : {} km/h pour {} (max realiste : {} km/h). Verifiez distance/duree."
    assert got[0] == got[2] == got[4] == got[5] == got[8] == []
    assert got[1] == [too_fast.format("2.5", "Randonnée", "2.5")]
    assert got[3] == ["Vitesse trop lente : 0.50 km/h pour Randonnée (min : 0.5 km/h). Verifiez distance/duree."]
    assert got[6] == []
    assert got[7] == [
        "Distance impossible pour Natation : max 20 km (vous avez saisi 20.1 km).",
        too_fast.format("2.5", "Natation", "2.5"),
    ]
    assert got[9] == [too_fast.format("10.0", "Course à pied", "7.0")]
    assert got[10] == [NONE, SHORT]


def test_speed_in_metres_per_second(errors):
    assert errors(("Course à pied", 5000.0, 1800), speed_unit="ms") == [[]]
    assert errors(("Course à pied", 26000.0, 3600), speed_unit="ms") == [
        ["Vitesse impossible : 7.2 m/s pour Course à pied (max realiste : 7.0 m/s). Verifiez distance/duree."]
    ]
    with pytest.raises(ValueError):
        errors(("Tennis", None, 1), speed_unit="mph")


def test_accepted_rows(spark, frame):
    rows = [
        (1, "Randonnée", 2000.0, 3600, "  vu \n", NOW),
        (2, "Randonnée", 0.0, 3600, " ", NOW),
        (3, "Tennis", 12.0, 3600, None, NOW),
        (4, "Tennis", None, 10, None, NOW),
    ]
    checked = d.declaration_errors(frame(rows, SCHEMA), reference.declaration_limits(spark))
    got = d.accepted(checked).orderBy("id_salarie").collect()
    assert [(r.id_salarie, r.distance_m, r.commentaire) for r in got] == [(1, 2000.0, "vu"), (2, None, None), (3, None, None)]
    assert got[0].date_fin == NOW + dt.timedelta(hours=1)
    assert [r.id_salarie for r in d.refused(checked).collect()] == [4]


def test_unvalidated_rows(frame):
    rows = [(1, "Tennis", 0.0, None, " ok ", NOW), (2, "Tennis", None, -5, "", NOW)]
    got = d.declarations_unvalidated(frame(rows, SCHEMA)).orderBy("id_salarie").collect()
    assert [(r.distance_m, r.temps_ecoule_s, r.commentaire) for r in got] == [(0.0, 3600, "ok"), (None, -5, None)]
    assert got[0].date_fin == NOW + dt.timedelta(hours=1)


def test_recap(frame):
    rows = [(1, NOW, "Randonnée", 2250.0, 5025), (2, NOW, "Tennis", None, 59)]
    activities = frame(
        rows, "id_salarie long, date_debut timestamp_ntz, type_sport string, distance_m double, temps_ecoule_s long"
    )
    got = [tuple(r)[2:] for r in d.declaration_recap(activities).orderBy("id_salarie").collect()]
    assert got == [
        (f"{2.25:.1f}", 1, 23, 45, f"{2.25 / (5025 / 3600):.1f}", "01/05/2024 18:30"),
        (None, 0, 0, 59, None, "01/05/2024 18:30"),
    ]
