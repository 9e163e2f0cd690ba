"""The copy manifest: which source tables land in staging, and how.

Five tables declare a column-by-column mapping with types; four are copied
through by name.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CopyEntry:
    table: str
    mapping: tuple[tuple[str, str, str], ...] | None  # (source, target, type); None = by name


def _same(*pairs: tuple[str, str]) -> tuple[tuple[str, str, str], ...]:
    return tuple((name, name, dtype) for name, dtype in pairs)


# --- fixed values: copied tables in manifest order, and the declared
# --- (column, type) mappings of the copy job.
ATTENDANCE_MAPPING = _same(
    ("Id", "int"), ("OrgId", "int"), ("TypeId", "int"), ("AttendeeId", "int"),
    ("EnrollmentId", "int"), ("ProgramId", "int"), ("Date", "string"),
    ("IsActive", "boolean"), ("CreatedOn", "timestamp"), ("UpdatedOn", "timestamp"),
    ("TimeStart", "timestamp"), ("TimeEnd", "timestamp"), ("BookingId", "int"),
)
HEADCOUNT_MAPPING = _same(
    ("Id", "int"), ("OrgId", "int"), ("TermProgramSetId", "int"), ("TermProductId", "int"),
    ("Description", "string"), ("HeadcountType", "string"), ("StatusId", "int"),
    ("HeadcountDateTime", "timestamp"), ("TotalCount", "int"), ("IsActive", "boolean"),
    ("CreatedOn", "timestamp"), ("UpdatedOn", "timestamp"),
)
PROGRAM_MAPPING = _same(
    ("Id", "int"), ("ProgramCategoryId", "int"), ("OrgId", "int"), ("Code", "string"),
    ("IsActive", "boolean"), ("CreatedOn", "timestamp"), ("UpdatedOn", "timestamp"),
    ("Version", "binary"), ("BusinessUnitId", "int"), ("ProgramName", "string"),
)
PROGRAM_CATEGORY_MAPPING = _same(
    ("Id", "int"), ("BusinessUnitId", "int"), ("Code", "string"), ("ProgramName", "string"),
    ("TypeId", "int"), ("IsActive", "boolean"), ("CreatedOn", "timestamp"),
    ("UpdatedOn", "timestamp"), ("OrgId", "int"),
)
PUBLIC_HOLIDAY_MAPPING = _same(
    ("Id", "int"), ("CountryId", "int"), ("Date", "string"), ("HolidayName", "string"),
    ("Description", "string"), ("IsActive", "boolean"), ("CreatedOn", "timestamp"),
    ("UpdatedOn", "timestamp"),
)

MANIFEST: tuple[CopyEntry, ...] = (
    CopyEntry("Attendance", ATTENDANCE_MAPPING),
    CopyEntry("Attendee", None),
    CopyEntry("BusinessUnit", None),
    CopyEntry("Enrollment", None),
    CopyEntry("HeadCount", HEADCOUNT_MAPPING),
    CopyEntry("Org", None),
    CopyEntry("Program", PROGRAM_MAPPING),
    CopyEntry("ProgramCategory", PROGRAM_CATEGORY_MAPPING),
    CopyEntry("PublicHoliday", PUBLIC_HOLIDAY_MAPPING),
)
