"""What is validated of each model table, as aggregates that its own write collects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The order of the tables in the reports.
MODEL_TABLES = ("Dim_Attendee", "Fact_Enrollment", "Fact_Attendance", "Fact_Headcount",
                "Dim_Date", "Dim_BusinessUnit", "Dim_Organisation")


def _unknown(key: str) -> Column:
    return F.count_if(F.col(key) == 0)


def _dates(key: str) -> dict[str, Column]:
    return {"MissingDate": F.count_if(F.col(key).isNull()), "MinDateKey": F.min(key), "MaxDateKey": F.max(key)}


def table_metrics(name: str) -> dict[str, Column]:
    """The metrics of a model table by name; a table that is not listed has none."""
    members = {"UnknownBusinessUnit": _unknown("BusinessUnitKey"), "UnknownOrganisation": _unknown("OrganisationKey")}
    return {
        "Dim_BusinessUnit": {"MissingBusinessKey": F.count_if(F.col("BusinessUnitId").isNull())},
        "Dim_Organisation": {"UnknownBusinessUnit": _unknown("BusinessUnitKey")},
        "Dim_Attendee": {"UnknownBusinessUnit": _unknown("BusinessUnitKey"),
                         "MissingDateOfBirth": F.count_if(F.col("DateOfBirth").isNull())},
        "Dim_Date": {"MinDateKey": F.min("DateKey"), "MaxDateKey": F.max("DateKey")},
        "Fact_Enrollment": {**members, "UnknownAttendee": _unknown("AttendeeKey"), **_dates("EnrolledDateKey")},
        "Fact_Attendance": {**members, "UnknownAttendee": _unknown("AttendeeKey"),
                            "WithoutEnrollment": F.count_if(F.col("EnrollmentFactKey").isNull()), **_dates("AttendanceDateKey")},
        "Fact_Headcount": {**members, **_dates("HeadcountDateKey")},
    }.get(name, {})


def row_counts(spark: SparkSession, saved: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(TableName, Rows) from what the writes counted: no scan."""
    rows = [(n, saved[n]["rows"]) for n in MODEL_TABLES if n in saved]
    return spark.createDataFrame(rows, "TableName string, Rows long")


def report(spark: SparkSession, saved: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(TableName, Metric, Value) of every table written, and for each fact whether its dates lie
    in the date dimension (``DatesInside``, 1 or 0): no scan."""
    rows = [(n, m, None if v is None else int(v)) for n in MODEL_TABLES for m, v in saved.get(n, {}).items() if m != "rows"]
    days = saved.get("Dim_Date", {})
    for n in MODEL_TABLES:
        own = saved.get(n, {})
        if n.startswith("Fact_") and days.get("MinDateKey") is not None:
            low, high = own.get("MinDateKey"), own.get("MaxDateKey")
            inside = low is None or (low >= days["MinDateKey"] and high <= days["MaxDateKey"])
            if own:
                rows.append((n, "DatesInside", int(inside)))
    return spark.createDataFrame(rows, "TableName string, Metric string, Value long")
