import datetime as dt
from decimal import Decimal

import pytest

from foulee import schemas
from foulee.operators import quality, reports
from foulee.settings import MOTOR_VEHICLE, WALKING, Rules

TODAY = dt.date(2024, 6, 1)
RULES = Rules(as_of=TODAY)
NOON = dt.datetime(2024, 5, 1, 12)


def staff(i, **values):
    base = {
        "id_salarie": i,
        "salaire_brut": Decimal(1000),
        "type_contrat": "CDI",
        "date_embauche": dt.date(2020, 1, 1),
        "moyen_deplacement": WALKING,
    }
    return {**base, **values}


def move(i, **values):
    base = {
        "id": 1,
        "id_salarie": i,
        "type_sport": "Tennis",
        "distance_m": 1.0,
        "temps_ecoule_s": 60,
        "date_debut": NOON,
        "date_fin": NOON + dt.timedelta(minutes=1),
    }
    return {**base, **values}


def benefit(i, **values):
    base = {"id_salarie": i, "prime_sportive": False, "montant_prime": 0.0, "jours_bienetre": 0, "nb_activites": 1}
    return {**base, **values}


def failures(frame, employees, activities, benefits):
    counts = quality.quality_counts(
        frame(employees, schemas.EMPLOYEES),
        frame(activities, schemas.ACTIVITIES),
        frame(benefits, schemas.BENEFITS),
        RULES,
    )
    return {name: n for name, n in counts.first().asDict().items() if n}


def test_clean_data_passes(frame):
    assert failures(frame, [staff(1)], [move(1)], [benefit(1)]) == {}


def test_empty_tables_pass(frame):
    assert failures(frame, [], [], []) == {}


def test_every_check_fails_on_its_own_row(frame):
    oldest = dt.datetime.combine(TODAY - dt.timedelta(days=366), dt.time())
    cases = {
        "doublons": ([staff(1), staff(1), staff(None), staff(None), staff(2)], [], [], 2),
        "salaires": ([staff(1, salaire_brut=Decimal(0)), staff(2, salaire_brut=None)], [], [], 1),
        "contrats": ([staff(1, type_contrat="Stage"), staff(2, type_contrat=None)], [], [], 2),
        "embauches": ([staff(1, date_embauche=None)], [], [], 1),
        "modes": ([staff(1, moyen_deplacement="cheval"), staff(2, moyen_deplacement=None)], [], [], 2),
        "distances": ([staff(1)], [move(1, distance_m=-0.5), move(1, distance_m=None)], [], 1),
        "durees": ([staff(1)], [move(1, temps_ecoule_s=0), move(1, temps_ecoule_s=None)], [], 1),
        "dates": ([staff(1)], [move(1, date_fin=NOON), move(1, date_fin=None)], [], 1),
        "sports": ([staff(1)], [move(1, type_sport=None)], [], 1),
        "anciennes": (
            [staff(1)],
            [move(1, date_debut=oldest), move(1, date_debut=oldest - dt.timedelta(seconds=1))],
            [],
            1,
        ),
        "orphelins": ([staff(1), staff(None)], [move(7), move(7), move(8), move(None), move(None)], [], 3),
        "montants": ([staff(1)], [], [benefit(1, montant_prime=-0.01)], 1),
        "compteurs": ([staff(1)], [], [benefit(1, nb_activites=-1)], 1),
        "primes": (
            [staff(1, moyen_deplacement=MOTOR_VEHICLE), staff(2)],
            [],
            [benefit(1, prime_sportive=True), benefit(2, prime_sportive=True), benefit(3, prime_sportive=True)],
            1,
        ),
        "bien_etre": ([staff(1)], [], [benefit(1, jours_bienetre=5, nb_activites=14), benefit(1, jours_bienetre=5, nb_activites=15)], 1),
    }
    assert list(cases) == [check[0] for check in quality.CHECKS]
    for name, (employees, activities, benefits, expected) in cases.items():
        assert failures(frame, employees, activities, benefits) == {name: expected}, name


def test_report_summary_and_stop(frame):
    report = quality.quality_report(
        frame([staff(1), staff(1)], schemas.EMPLOYEES),
        frame([move(1, distance_m=-1.0)], schemas.ACTIVITIES),
        frame([], schemas.BENEFITS),
        RULES,
    )
    rows = report.collect()
    assert len(rows) == 15
    assert tuple(rows[0])[:3] == ("Pas de doublons ID salarié", "❌ FAIL", "1 doublon(s)")
    assert tuple(rows[5])[:3] == ("Distance jamais négative", "❌ FAIL", "1 distance(s) négative(s)")
    assert tuple(rows[11])[:3] == ("Montant prime >= 0", "✅ PASS", "")
    assert tuple(quality.quality_summary(report).first()) == (13, 2)
    with pytest.raises(quality.CriticalQualityError, match="doublon"):
        quality.require_no_critical_failure(report)


def test_one_shuffle_by_id(frame):
    counts = quality.quality_counts(
        frame([staff(1)], schemas.EMPLOYEES), frame([move(1)], schemas.ACTIVITIES), frame([benefit(1)], schemas.BENEFITS)
    )
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_orphans(frame):
    got = quality.orphan_ids(
        frame([move(1), move(2), move(2), move(None)], schemas.ACTIVITIES),
        frame([staff(1), staff(None)], schemas.EMPLOYEES),
    )
    assert sorted((r.id_salarie for r in got.collect()), key=str) == [2, None]


def test_reports(frame):
    employees = frame([staff(1), staff(2)], schemas.EMPLOYEES)
    moves = frame([move(1)], schemas.ACTIVITIES)
    gold = frame(
        [benefit(1, prime_sportive=True, montant_prime=10.25, jours_bienetre=5), benefit(2, jours_bienetre=5)],
        schemas.BENEFITS,
    )
    assert tuple(reports.monitoring_report(employees, moves, gold, RULES).first()) == (2, 1, 1, 2, 10.25, TODAY)
    empty = reports.monitoring_report(employees.limit(0), moves.limit(0), gold.limit(0), RULES).first()
    assert tuple(empty) == (0, 0, 0, 0, 0.0, TODAY)
    silver = frame(
        [(1, True, True, WALKING), (2, False, True, WALKING), (3, None, False, MOTOR_VEHICLE)],
        "id_salarie long, declaration_ok boolean, bu_valide boolean, moyen_deplacement string",
    )
    rich = frame([(True,), (False,), (False,)], "activite_valide boolean")
    row = reports.silver_report(employees, moves, silver, rich, RULES).first().asDict()
    assert row == {
        "salaries_bronze": 2,
        "activites_bronze": 1,
        "salaries_silver": 3,
        "deplacement_actif": 2,
        "declaration_ok": 1,
        "declaration_ko": 1,
        "declaration_nulle": 1,
        "bu_valides": 2,
        "activites_silver": 3,
        "activites_valides": 1,
        "activites_invalides": 2,
    }
