"""The whole pipeline in one call: staging -> cleaned -> star schema -> checks.

    result = run_pipeline(spark, {"BusinessUnit": df, "Org": df, ...})
    result.tables["Fact_Attendance"], result.saved_rows, result.checks[...]

Each layer is saved as a catalog table (overwrite, schema replaced, row
count observed during the write) and re-read from the catalog before the
next layer uses it, so later steps read files instead of recomputing
lineage. ``save=False`` keeps everything lazy (nothing is written).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starpipe.operators import quality as Q
from starpipe.operators.dates import DEFAULT_END, DEFAULT_START, date_spine, date_spine_covering, dim_date
from starpipe.operators.lookup import fanout_rows, orphans
from starpipe.plans import clean, model, validation
from starpipe.sources.io import save_validated, scratch_scope

# Staging table name -> (cleaned table name, cleaner).
CLEANERS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "BusinessUnit": ("cln_BusinessUnit", clean.clean_business_unit),
    "Org": ("cln_Organisation", clean.clean_organisation),
    "Attendee": ("cln_Attendee", clean.clean_attendee),
    "Enrollment": ("cln_Enrollment", clean.clean_enrollment),
    "Attendance": ("cln_Attendance", clean.clean_attendance),
    "HeadCount": ("cln_HeadCount", clean.clean_headcount),
    "Program": ("cln_Program", clean.clean_program),
}


@dataclass
class PipelineResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    saved_rows: dict[str, int] = field(default_factory=dict)
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)
    checks: dict[str, DataFrame] = field(default_factory=dict)


def run_pipeline(spark: SparkSession, staging: Mapping[str, DataFrame], *, as_of=None,
                 save: bool = True, prefix: str = "", date_start: str = DEFAULT_START,
                 date_end: str = DEFAULT_END, date_span: str = "fixed") -> PipelineResult:
    """Clean every staging table given, then build the dimensions and facts
    whose inputs are present, then the validation reports. Counts, unmatched
    keys and date bounds come from the writes (``metrics``, ``checks["validation"]``);
    the other checks are lazy frames that name the rows.

    ``date_span="fixed"`` builds Dim_Date over ``date_start``..``date_end``;
    ``"data"`` spans the earliest to the latest enrolment / attendance date
    instead, so every fact date has a dimension row."""
    res = PipelineResult()

    def keep(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if not save:
            res.tables[name] = build()
            return res.tables[name]
        full = f"{prefix}{name}"
        with scratch_scope(spark):  # the table holds its rows now; what led to it may go
            res.metrics[name] = save_validated(build(), full, validation.table_metrics(name))
        res.saved_rows[name] = res.metrics[name]["rows"]
        res.tables[name] = spark.table(full)
        return res.tables[name]

    if staging:
        res.checks["staging_row_counts"] = Q.table_row_counts(staging)
    for stg_name, (cln_name, cleaner) in CLEANERS.items():
        if stg_name in staging:
            src = staging[stg_name]
            keep(cln_name, lambda c=cleaner, s=src, n=stg_name: c(s, as_of=as_of) if n == "Attendee" else c(s))

    t = res.tables
    dated = [(t[n], c) for n, c in (("cln_Enrollment", ["EnrolledDate", "StartDate", "EndDate"]),
                                    ("cln_Attendance", ["AttendanceDate"])) if n in t]
    if date_span == "data" and dated:
        keep("Dim_Date", lambda: dim_date(date_spine_covering(dated)))
    else:
        keep("Dim_Date", lambda: dim_date(date_spine(spark, date_start, date_end)))
    if "cln_BusinessUnit" in t:
        keep("Dim_BusinessUnit", lambda: model.dim_business_unit(t["cln_BusinessUnit"]))
        if "cln_Organisation" in t:
            keep("Dim_Organisation", lambda: model.dim_organisation(t["cln_Organisation"], t["Dim_BusinessUnit"]))
        if "cln_Attendee" in t:
            keep("Dim_Attendee", lambda: model.dim_attendee(t["cln_Attendee"], t["Dim_BusinessUnit"]))
    dims = ("Dim_BusinessUnit", "Dim_Organisation", "Dim_Attendee")
    if "cln_Enrollment" in t and all(d in t for d in dims):
        keep("Fact_Enrollment", lambda: model.fact_enrollment(t["cln_Enrollment"], *[t[d] for d in dims]))
        if "cln_Attendance" in t:
            keep("Fact_Attendance", lambda: model.fact_attendance(
                t["cln_Attendance"], t["Fact_Enrollment"], *[t[d] for d in dims]))
    if "cln_HeadCount" in t and "Dim_Organisation" in t:
        keep("Fact_Headcount", lambda: model.fact_headcount(
            t["cln_HeadCount"], t["Dim_Organisation"], t["Dim_BusinessUnit"]))

    if save:
        # Counted, with the other metrics, by the writes themselves.
        res.checks["row_counts"] = validation.row_counts(spark, res.metrics)
        res.checks["validation"] = validation.report(spark, res.metrics)
    else:
        res.checks["row_counts"] = Q.table_row_counts({n: t[n] for n in validation.MODEL_TABLES if n in t})
    if "Fact_Enrollment" in t:
        res.checks["enrollments_without_attendee"] = (
            Q.unknown_member_rows(t["Fact_Enrollment"], "AttendeeKey")
            .select("EnrollmentId", "BusinessUnitId", "AttendeeId", "AccountId"))
    if "Fact_Attendance" in t:
        res.checks["attendance_without_enrollment"] = (
            Q.missing_key_rows(t["Fact_Attendance"], ["EnrollmentFactKey"])
            .select("AttendanceId", "EnrollmentId", "AttendeeId", "OrganisationId"))
    for fact, key in (("Fact_Enrollment", "EnrolledDateKey"), ("Fact_Attendance", "AttendanceDateKey"),
                      ("Fact_Headcount", "HeadcountDateKey")):
        if fact in t:
            res.checks[f"{fact.lower()}_dates_outside"] = Q.dates_outside(t[fact], key, t["Dim_Date"])
    if "Dim_Organisation" in t:
        res.checks["organisations_without_unit"] = (
            Q.unmatched_parents(t["Dim_Organisation"], "OrganisationId", "BusinessUnitKey")
            .select("OrganisationId", "BusinessUnitId", "OrganisationCode", "OrganisationName"))
        res.checks["duplicate_organisation_keys"] = Q.duplicate_keys(
            t["Dim_Organisation"], ["BusinessUnitId", "OrganisationId"])
    if "Fact_Headcount" in t:
        # Headcount joins organisations on OrganisationId alone: ids held by
        # several business units multiply headcount rows.
        res.checks["headcount_organisation_fanout"] = fanout_rows(t["Dim_Organisation"], "OrganisationId")
    if "cln_Enrollment" in t and "cln_Attendee" in t:
        res.checks["orphan_enrollments"] = orphans(t["cln_Enrollment"], t["cln_Attendee"],
                                                   ["BusinessUnitId", "AttendeeId"])
    return res
