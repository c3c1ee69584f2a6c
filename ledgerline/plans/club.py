"""A mountaineering club: twelve tables, their rules, cascades, seeding and added columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.operators import mutate
from ledgerline.operators import quality as q
from ledgerline.operators.mutate import Reference
from ledgerline.operators.ordering import ascending

FIRST_DAY = dt.date(2000, 1, 1)
MINIMUM_GUIDE_YEARS = 3
BLOOD_TYPES = ("A", "B", "AB", "O")
GENDERS = ("M", "F")


def _link(child: str, parent: str) -> Reference:
    return Reference(child, (f"{parent}_id",), parent, (f"{parent}_id",))


# Every foreign key; all of them cascade on delete.
REFERENCES = (
    _link("mountain", "area"),
    _link("route", "mountain"),
    _link("climb", "mountain"),
    _link("climb", "route"),
    _link("climb", "guide"),
    _link("climb_note", "climb"),
    _link("climb_note", "climber"),
    _link("equipment", "climber"),
    _link("climber_medical_info", "climber"),
    _link("climb_participant", "climb"),
    _link("climb_participant", "climber"),
    _link("climb_rescue", "climb"),
    _link("climb_rescue", "rescuer"),
)

KEYS = {
    "area": ("area_id",),
    "mountain": ("mountain_id",),
    "route": ("route_id",),
    "guide": ("guide_id",),
    "climber": ("climber_id",),
    "climb": ("climb_id",),
    "climb_note": ("note_id",),
    "equipment": ("equipment_id",),
    "rescuer": ("rescuer_id",),
    "climber_medical_info": ("medical_info_id",),
    "climb_participant": ("climb_id", "climber_id"),
    "climb_rescue": ("climb_id", "rescuer_id"),
}

# Longest text per column; the second item says whether NULL is refused.
TEXTS = {
    "area": {"area_name": (255, True), "country": (100, True)},
    "mountain": {"mountain_name": (255, True)},
    "route": {"route_name": (255, True), "difficulty_level": (100, True)},
    "guide": {"guide_first_name": (100, True), "guide_last_name": (100, True), "guide_phone_number": (20, False)},
    "climber": {
        "climber_first_name": (100, True),
        "climber_last_name": (100, True),
        "address": (255, False),
        "gender": (1, True),
    },
    "climb": {},
    "climb_note": {"note_text": (1000, True)},
    "equipment": {"equipment_name": (255, True), "equipment_type": (100, True)},
    "rescuer": {
        "rescuer_first_name": (100, True),
        "rescuer_last_name": (100, True),
        "organization": (255, True),
        "rescuer_contact": (20, True),
    },
    "climber_medical_info": {"blood_type": (2, True), "allergies": (255, False), "other_medical_note": (1000, False)},
    "climb_participant": {},
    "climb_rescue": {"rescue_details": (1000, False)},
}

UNIQUE = {
    "area": ("area_name", "country"),
    "mountain": ("mountain_name", "area_id"),
    "route": ("route_name", "mountain_id"),
    "climber_medical_info": ("climber_id",),
}


def _checks() -> dict[str, list[q.RowRule]]:
    first = F.lit(FIRST_DAY)
    return {
        "mountain": [q.check("height_meters >= 0", F.col("height_meters") >= 0)],
        "guide": [
            q.check(f"experience_years >= {MINIMUM_GUIDE_YEARS}", F.col("experience_years") >= MINIMUM_GUIDE_YEARS)
        ],
        "climber": [q.one_of("gender", GENDERS)],
        "climb": [q.not_null("start_date"), q.check(f"start_date > {FIRST_DAY}", F.col("start_date") > first)],
        "climb_note": [q.not_null("note_date")],
        "climber_medical_info": [q.one_of("blood_type", BLOOD_TYPES)],
        "climb_rescue": [q.not_null("rescue_date"), q.check(f"rescue_date > {FIRST_DAY}", F.col("rescue_date") > first)],
    }


def rules() -> dict[str, q.TableRules]:
    """All rules of the twelve tables."""
    checks = _checks()
    result = {}
    for table, key in KEYS.items():
        rows: list[q.RowRule] = []
        for column, (length, required) in TEXTS[table].items():
            if required:
                rows.append(q.not_null(column))
            rows.append(q.max_length(column, length))
        links = [r for r in REFERENCES if r.child == table]
        rows += [q.not_null(c) for r in links for c in r.columns if c not in key]
        rows += checks.get(table, [])
        result[table] = q.TableRules(
            key,
            tuple(rows),
            unique=(q.Unique(UNIQUE[table]),) if table in UNIQUE else (),
            foreign=tuple(q.ForeignKey(r.columns, r.parent, r.parent_columns) for r in links),
        )
    return result


def delete_with_children(tables: Mapping[str, DataFrame], start: str, doomed: DataFrame) -> dict[str, DataFrame]:
    """Delete rows of one table and everything that hangs on them.

    Four tables hang on ``climb``, which has three parents itself, so the key sets
    are materialised.
    """
    return mutate.cascade_delete(tables, REFERENCES, start, doomed, materialise=True)


def climb_durations(climb: DataFrame) -> DataFrame:
    """The stored generated column: days from start to end, NULL while there is no end."""
    return climb.withColumn("climb_duration_days", cal.days_between(F.col("end_date"), F.col("start_date")))


def with_record_date(tables: Mapping[str, DataFrame], as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """Every table with a filled ``record_ts``."""
    today = F.lit(cal.as_of_or_today(as_of))
    return {name: mutate.add_column(df, "record_ts", today) for name, df in tables.items()}


def guide_defaults(batch: DataFrame) -> DataFrame:
    return mutate.with_defaults(batch, {"experience_years": F.lit(MINIMUM_GUIDE_YEARS)})


def seed(tables: Mapping[str, DataFrame], batches: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Insert-if-absent for areas, mountains, routes and people; run again, it adds nothing.

    A mountain batch names its area and country, a route batch its mountain. Returns
    the new snapshots of the seeded tables.
    """
    result = dict(tables)

    def grow(name: str, rows: DataFrame, natural: list[str]) -> None:
        key = KEYS[name][0]
        keyed = mutate.assign_keys(rows, result[name], key, ascending(*natural))
        result[name] = result[name].unionByName(keyed.select(*[c for c in result[name].columns if c in keyed.columns]), allowMissingColumns=True)

    people = {
        "guide": ["guide_first_name", "guide_last_name"],
        "climber": ["climber_first_name", "climber_last_name"],
        "rescuer": ["rescuer_first_name", "rescuer_last_name"],
    }
    for name, natural in {"area": ["area_name", "country"], **people}.items():
        if name in batches:
            grow(name, mutate.insert_absent(result[name], batches[name], natural), natural)
    if "mountain" in batches:
        rows = mutate.insert_absent_child(
            result["mountain"],
            batches["mountain"],
            result["area"],
            {"area_name": "area_name", "country": "country"},
            "area_id",
            "area_id",
            ["mountain_name"],
        )
        grow("mountain", rows, ["mountain_name", "area_id"])
    if "route" in batches:
        rows = mutate.insert_absent_child(
            result["route"],
            batches["route"],
            result["mountain"],
            {"mountain_name": "mountain_name"},
            "mountain_id",
            "mountain_id",
            ["route_name"],
        )
        grow("route", rows, ["route_name", "mountain_id"])
    return result
