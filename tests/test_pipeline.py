import uuid

from starpipe.plans.pipeline import run_pipeline
from starpipe.plans.registry import DOB_AS_OF
from starpipe.sources import fixtures
from tests.conftest import SF_SMALL


def test_run_pipeline_saves_every_layer_and_reports(spark):
    staging = {name: build(spark, SF_SMALL) for name, build in fixtures.STAGING.items()}
    prefix = f"p{uuid.uuid4().hex[:6]}_"
    res = run_pipeline(spark, staging, as_of=DOB_AS_OF, prefix=prefix)
    expected = {"cln_BusinessUnit", "cln_Organisation", "cln_Attendee", "cln_Enrollment", "cln_Attendance",
                "cln_HeadCount", "cln_Program", "Dim_Date", "Dim_BusinessUnit", "Dim_Organisation",
                "Dim_Attendee", "Fact_Enrollment", "Fact_Attendance", "Fact_Headcount"}
    assert set(res.tables) == expected == set(res.saved_rows)
    # the observed write count equals what the catalog now holds
    for name, n in res.saved_rows.items():
        assert spark.table(f"{prefix}{name}").count() == n
    assert res.saved_rows["Dim_Date"] == 13149           # 2000-01-01 .. 2035-12-31
    counts = {r["TableName"]: r["Rows"] for r in res.checks["row_counts"].collect()}
    assert counts["Fact_Attendance"] == res.saved_rows["Fact_Attendance"]
    # surrogate keys are dense and unique; business keys unique after cleaning
    fa = res.tables["Fact_Attendance"]
    assert fa.agg({"AttendanceFactKey": "max"}).first()[0] == fa.count() == fa.select("AttendanceFactKey").distinct().count()
    assert res.checks["duplicate_organisation_keys"].count() == 0
    assert res.checks["attendance_without_enrollment"].count() > 0     # injected misses are found
    assert res.checks["enrollments_without_attendee"].count() == res.checks["orphan_enrollments"].count()
    fan = res.checks["headcount_organisation_fanout"]
    assert fan.count() > 0          # organisations 0..7 sit under several units
    assert res.saved_rows["Fact_Headcount"] >= res.saved_rows["cln_HeadCount"]


def test_run_pipeline_lazy_with_partial_inputs(spark):
    staging = {name: fixtures.STAGING[name](spark, SF_SMALL) for name in ("BusinessUnit", "Org")}
    res = run_pipeline(spark, staging, save=False)
    assert set(res.tables) == {"cln_BusinessUnit", "cln_Organisation", "Dim_Date", "Dim_BusinessUnit",
                               "Dim_Organisation"}
    assert res.saved_rows == {}


def test_run_pipeline_date_span_from_data(spark):
    from pyspark.sql import functions as F

    staging = {name: fixtures.STAGING[name](spark, SF_SMALL) for name in ("Enrollment", "Attendance")}
    res = run_pipeline(spark, staging, save=False, date_span="data")
    dd = res.tables["Dim_Date"]
    lo, hi = dd.agg(F.min("FullDate"), F.max("FullDate")).first()
    att = res.tables["cln_Attendance"].agg(F.min("AttendanceDate"), F.max("AttendanceDate")).first()
    assert lo <= att[0] and hi >= att[1]
    assert dd.count() == (hi - lo).days + 1
