"""Table contracts: the target shape of every cleaned table, as data.

A contract is an ordered list of fields (source column -> target column,
target type), the columns that must be present for a row to survive, and
the business key the latest-record rule is applied to.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Field:
    target: str
    dtype: str
    # Source column, or candidates tried in order (first present wins).
    source: str | tuple[str, ...] | None = None

    def sources(self) -> tuple[str, ...]:
        if self.source is None:
            return (self.target,)
        if isinstance(self.source, str):
            return (self.source,)
        return self.source


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    business_key: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [f.target for f in self.fields]


def _audit() -> tuple[Field, ...]:
    return (
        Field("IsActive", "boolean"),
        Field("CreatedOn", "timestamp"),
        Field("UpdatedOn", "timestamp"),
    )


# --- fixed values: target column names, types and source columns of the
# --- cleaned tables, as the reference's cleaning step defines them.

BUSINESS_UNIT = Contract(
    name="BusinessUnit",
    fields=(
        Field("BusinessUnitId", "long", "Id"),
        Field("BusinessUnitCode", "string", "Code"),
        Field("BusinessUnitName", "string", "Name"),
        Field("EnterpriseId", "long"),
        Field("TypeId", "long"),
    ) + _audit(),
    required=("BusinessUnitId",),
    business_key=("BusinessUnitId",),
)

ORGANISATION = Contract(
    name="Organisation",
    fields=(
        Field("OrganisationId", "long", "Id"),
        Field("BusinessUnitId", "long"),
        Field("OrganisationCode", "string", "Code"),
        Field("OrganisationName", "string", "Name"),
        Field("EnterpriseId", "long"),
        Field("TypeId", "long"),
    ) + _audit(),
    required=("OrganisationId", "BusinessUnitId"),
    business_key=("BusinessUnitId", "OrganisationId"),
)

ATTENDEE = Contract(
    name="Attendee",
    fields=(
        Field("AttendeeId", "long", "Id"),
        Field("BusinessUnitId", "long"),
        Field("AccountId", "long"),
        Field("EnterpriseId", "long"),
        Field("GenderId", "long"),
        Field("StatusId", "long"),
        Field("IsActive", "boolean"),
        Field("RawDateOfBirth", "date", "DateOfBirth"),
        Field("CreatedOn", "timestamp"),
        Field("UpdatedOn", "timestamp"),
    ),
    required=("AttendeeId", "BusinessUnitId"),
    business_key=("BusinessUnitId", "AttendeeId"),
)

ENROLLMENT = Contract(
    name="Enrollment",
    fields=(
        Field("EnrollmentId", "long", "Id"),
        Field("BusinessUnitId", "long"),
        Field("OrganisationId", "long", "OrgId"),
        Field("AttendeeId", "long"),
        Field("AccountId", "long"),
        Field("SubscriptionId", "long"),
        Field("StatusId", "long"),
        Field("EnrolledDate", "date"),
        Field("StartDate", "date"),
        Field("EndDate", "date"),
    ) + _audit(),
    required=("EnrollmentId", "BusinessUnitId"),
    business_key=("BusinessUnitId", "EnrollmentId"),
)

ATTENDANCE = Contract(
    name="Attendance",
    fields=(
        Field("AttendanceId", "long", "Id"),
        Field("EnrollmentId", "long"),
        Field("OrganisationId", "long", "OrgId"),
        Field("AttendeeId", "long"),
        Field("ProgramId", "long"),
        Field("BookingId", "long"),
        Field("TypeId", "long"),
        Field("AttendanceDate", "date", "Date"),
        Field("TimeStart", "timestamp"),
        Field("TimeEnd", "timestamp"),
    ) + _audit(),
    required=("AttendanceId",),
    business_key=("AttendanceId",),
)

# The copied HeadCount table carries ``HeadcountType``; older extracts call
# it ``Name``. Whichever is present is used.
HEADCOUNT = Contract(
    name="HeadCount",
    fields=(
        Field("HeadcountId", "long", "Id"),
        Field("OrganisationId", "long", "OrgId"),
        Field("TermProgramSetId", "long"),
        Field("TermProductId", "long"),
        Field("Description", "string"),
        Field("HeadcountType", "string", ("HeadcountType", "Name")),
        Field("StatusId", "long"),
        Field("TotalCount", "int"),
    ) + _audit(),
    required=("HeadcountId",),
    business_key=("HeadcountId",),
)

HEADCOUNT_TIMED = replace(HEADCOUNT, fields=(*HEADCOUNT.fields, Field("HeadcountDateTime", "timestamp")))

# Program is copied but never cleaned upstream; it gets a contract of its
# own (columns of the copied table) so bookings can name their program.
PROGRAM = Contract(
    name="Program",
    fields=(
        Field("ProgramId", "long", "Id"),
        Field("ProgramCategoryId", "long"),
        Field("OrganisationId", "long", "OrgId"),
        Field("ProgramCode", "string", "Code"),
        Field("BusinessUnitId", "long"),
        Field("ProgramName", "string"),
    ) + _audit(),
    required=("ProgramId",),
    business_key=("ProgramId",),
)
