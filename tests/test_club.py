"""Mountaineering club: seeding, cascades, added columns, rules."""

import datetime as dt

import pytest
from conftest import row_set, rows

from ledgerline.operators.mutate import Reference, parent_first
from ledgerline.operators.quality import violations
from ledgerline.plans import club

SCHEMAS = {
    "area": "area_id bigint, area_name string, country string",
    "mountain": "mountain_id bigint, area_id bigint, mountain_name string, height_meters int",
    "route": "route_id bigint, mountain_id bigint, route_name string, difficulty_level string",
    "guide": "guide_id bigint, guide_first_name string, guide_last_name string, experience_years int, guide_phone_number string",
    "climber": "climber_id bigint, climber_first_name string, climber_last_name string, address string, gender string",
    "climb": "climb_id bigint, mountain_id bigint, route_id bigint, guide_id bigint, start_date date, end_date date",
    "climb_note": "note_id bigint, climb_id bigint, climber_id bigint, note_text string, note_date date",
    "equipment": "equipment_id bigint, climber_id bigint, equipment_name string, equipment_type string",
    "rescuer": "rescuer_id bigint, rescuer_first_name string, rescuer_last_name string, organization string, rescuer_contact string",
    "climber_medical_info": "medical_info_id bigint, climber_id bigint, blood_type string, allergies string, other_medical_note string",
    "climb_participant": "climb_id bigint, climber_id bigint",
    "climb_rescue": "climb_id bigint, rescuer_id bigint, rescue_date date, rescue_details string",
}
DAY = dt.date(2020, 5, 1)


@pytest.fixture
def empty(frame):
    return {name: frame(schema) for name, schema in SCHEMAS.items()}


@pytest.fixture
def batches(frame):
    return {
        "area": frame("area_name string, country string", ("North", "Utopia"), ("South", "Utopia"), ("North", "Utopia")),
        "mountain": frame(
            "area_name string, country string, mountain_name string, height_meters int",
            ("North", "Utopia", "Horn", 4000),
            ("South", "Utopia", "Dome", 5000),
            ("West", "Utopia", "Lost", 1),
        ),
        "route": frame(
            "mountain_name string, route_name string, difficulty_level string",
            ("Horn", "Ridge", "Hard"),
            ("Dome", "Face", "Harder"),
        ),
        "guide": frame(
            "guide_first_name string, guide_last_name string, experience_years int, guide_phone_number string",
            ("Gil", "One", 17, "1"),
            ("Gus", "Two", 28, "2"),
        ),
        "climber": frame(
            "climber_first_name string, climber_last_name string, address string, gender string",
            ("Cal", "One", "A street", "M"),
            ("Cat", "Two", None, "F"),
        ),
        "rescuer": frame(
            "rescuer_first_name string, rescuer_last_name string, organization string, rescuer_contact string",
            ("Ray", "One", "Org", "3"),
            ("Ros", "Two", "Org", "4"),
        ),
    }


@pytest.fixture
def full(frame, empty):
    """Two mountains in two areas, one climb on each, children everywhere."""
    data = {
        "area": [(1, "North", "Utopia"), (2, "South", "Utopia")],
        "mountain": [(1, 1, "Horn", 4000), (2, 2, "Dome", None)],
        "route": [(1, 1, "Ridge", "Hard"), (2, 2, "Face", "Hard")],
        "guide": [(1, "Gil", "One", 3, None), (2, "Gus", "Two", 9, None)],
        "climber": [(1, "Cal", "One", None, "M"), (2, "Cat", "Two", None, "F")],
        "climb": [(1, 1, 1, 1, DAY, dt.date(2020, 5, 9)), (2, 2, 2, 2, DAY, None)],
        "climb_note": [(1, 1, 1, "n", DAY), (2, 2, 1, "n", DAY), (3, 2, 2, "n", DAY)],
        "equipment": [(1, 1, "rope", "gear"), (2, 2, "axe", "gear")],
        "rescuer": [(1, "Ray", "One", "Org", "3")],
        "climber_medical_info": [(1, 1, "A", None, None), (2, 2, "O", None, None)],
        "climb_participant": [(1, 1), (1, 2), (2, 2)],
        "climb_rescue": [(1, 1, DAY, None), (2, 1, DAY, None)],
    }
    return {name: frame(SCHEMAS[name], *data[name]) for name in SCHEMAS}


def test_seeding_twice_adds_nothing(empty, batches):
    once = club.seed(empty, batches)
    counts = {name: once[name].count() for name in batches}
    assert counts == {"area": 2, "mountain": 2, "route": 2, "guide": 2, "climber": 2, "rescuer": 2}
    twice = club.seed(once, batches)
    assert {name: twice[name].count() for name in batches} == counts
    assert row_set(once["mountain"], "mountain_name", "area_id") == [("Dome", 2), ("Horn", 1)]


def test_new_keys_follow_existing_ones(empty, batches, frame):
    start = {**empty, "area": frame(SCHEMAS["area"], (41, "North", "Utopia"))}
    seeded = club.seed(start, {"area": batches["area"]})
    assert row_set(seeded["area"]) == [(41, "North", "Utopia"), (42, "South", "Utopia")]


@pytest.mark.parametrize(
    "start, doomed, left",
    [
        (
            "area",
            1,
            dict(area=1, mountain=1, route=1, guide=2, climber=2, climb=1, climb_note=2, equipment=2, rescuer=1,
                 climber_medical_info=2, climb_participant=1, climb_rescue=1),
        ),
        (
            "climber",
            1,
            dict(area=2, mountain=2, route=2, guide=2, climber=1, climb=2, climb_note=1, equipment=1, rescuer=1,
                 climber_medical_info=1, climb_participant=2, climb_rescue=2),
        ),
        (
            "guide",
            2,
            dict(area=2, mountain=2, route=2, guide=1, climber=2, climb=1, climb_note=1, equipment=2, rescuer=1,
                 climber_medical_info=2, climb_participant=2, climb_rescue=1),
        ),
        (
            "equipment",
            1,
            dict(area=2, mountain=2, route=2, guide=2, climber=2, climb=2, climb_note=3, equipment=1, rescuer=1,
                 climber_medical_info=2, climb_participant=3, climb_rescue=2),
        ),
    ],
)
def test_cascade(frame, full, start, doomed, left):
    key = club.KEYS[start][0]
    after = club.delete_with_children(full, start, frame(f"{key} bigint", (doomed,)))
    assert {name: df.count() for name, df in after.items()} == left


def test_no_violation_after_a_cascade(spark, frame, full):
    assert violations(spark, full, club.rules()).count() == 0
    after = club.delete_with_children(full, "area", frame("area_id bigint", (2,)))
    assert violations(spark, after, club.rules()).count() == 0


def test_plain_delete_would_leave_orphans(spark, frame, full):
    broken = {**full, "climb": full["climb"].filter("climb_id = 1")}
    found = violations(spark, broken, club.rules())
    assert row_set(found, "table_name", "rule", "key", "n_rows") == [
        ("climb_note", "foreign_key", "2", 2),
        ("climb_participant", "foreign_key", "2", 1),
        ("climb_rescue", "foreign_key", "2", 1),
    ]


def test_rules_find_bad_rows(spark, frame, full):
    bad = {
        **full,
        "mountain": frame(SCHEMAS["mountain"], (1, 1, "Horn", -1), (2, 1, "Horn", None), (3, None, "Null", 5), (4, None, "Null", 5)),
        "climber": frame(SCHEMAS["climber"], (1, "Cal", "One", None, "X"), (2, None, "Two", None, "F")),
        "guide": frame(SCHEMAS["guide"], (1, "Gil", "One", 2, None), (2, "Gus", "Two", None, None)),
        "climb": frame(SCHEMAS["climb"], (1, 1, 1, 1, dt.date(1999, 1, 1), None), (2, 2, 2, 2, DAY, None)),
        "climber_medical_info": frame(SCHEMAS["climber_medical_info"], (1, 1, "C", None, None), (2, 1, "A", None, None)),
    }
    found = violations(spark, bad, club.rules())
    assert row_set(found, "table_name", "rule", "key") == [
        ("climb", "check", "1"),
        ("climber", "domain", "1"),
        ("climber", "not_null", "2"),
        ("climber_medical_info", "domain", "1"),
        ("climber_medical_info", "unique", "1"),
        ("guide", "check", "1"),
        ("mountain", "check", "1"),
        ("mountain", "not_null", "3"),
        ("mountain", "not_null", "4"),
        ("mountain", "unique", "Horn|1"),
    ]


def test_generated_and_added_columns(full, frame):
    assert rows(club.climb_durations(full["climb"]).orderBy("climb_id"), "climb_duration_days") == [(8,), (None,)]
    dated = club.with_record_date(full, DAY)
    assert all(df.filter("record_ts is null").count() == 0 for df in dated.values())
    again = club.with_record_date(dated, dt.date(2021, 1, 1))
    assert rows(again["area"], "record_ts") == [(DAY,), (DAY,)]
    new = club.guide_defaults(frame("guide_first_name string", ("Gil",)))
    assert rows(new) == [("Gil", 3)]
    given = club.guide_defaults(frame("experience_years int", (None,), (5,)))
    assert row_set(given) == [(5,), (None,)]


def test_parent_first_and_cycles():
    order = parent_first(club.REFERENCES)
    assert all(order.index(r.parent) < order.index(r.child) for r in club.REFERENCES)
    loop = [Reference("a", ("x",), "b", ("x",)), Reference("b", ("x",), "a", ("x",))]
    with pytest.raises(ValueError):
        parent_first(loop)
