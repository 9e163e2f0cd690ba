"""The staging views reproduce the row counts documented for the fixture rule."""

import pytest

from starpipe.sources import fixtures
from tests.conftest import SF_ORACLE, SF_SMALL

# --- fixed values: rows per staging view as documented for sf0.001 / sf0.01.
ROWS = {
    "BusinessUnit": (8, 8),
    "Org": (38, 38),
    "Attendee": (222, 2215),
    "Enrollment": (2333, 23310),
    "Attendance": (8914, 88897),
    "HeadCount": (16, 149),
    "Program": (296, 2953),
}
KEYS = {"BusinessUnit": 5, "Org": 25, "Attendee": 1485, "Enrollment": 15628, "Attendance": 59865,
        "HeadCount": 100, "Program": 2000}   # distinct business keys at sf0.01


@pytest.mark.parametrize("name", sorted(ROWS))
def test_staging_row_counts(spark, name):
    small, oracle = ROWS[name]
    assert fixtures.STAGING[name](spark, SF_SMALL).count() == small
    assert fixtures.STAGING[name](spark, SF_ORACLE).count() == oracle


def test_distinct_business_keys_at_sf001(spark):
    from starpipe.plans.registry import QUERIES

    cleaned = {"BusinessUnit": "clean_business_unit", "Org": "clean_organisation",
               "Attendee": "clean_attendee", "Enrollment": "clean_enrollment",
               "Attendance": "clean_attendance", "HeadCount": "clean_headcount", "Program": "clean_program"}
    got = {name: QUERIES[q](spark, SF_ORACLE).count() for name, q in cleaned.items()}
    assert got == KEYS
