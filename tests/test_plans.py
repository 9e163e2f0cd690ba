"""Guards on the physical plans the design relies on."""

import datetime as dt
import re

from pyspark.sql import functions as F

from starpipe.operators.dedup import version_history
from starpipe.plans import kpi
from tests.test_conform_dedup import LATEST_ROWS


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_version_history_shuffles_the_written_rows_once(spark):
    rows = [(i % 40, i % 2 == 0, dt.datetime(2020, 1, 1) + dt.timedelta(hours=i), dt.datetime(2019, 1, 1), str(i))
            for i in range(20000)]
    plan = _plan(version_history(spark.createDataFrame(rows, LATEST_ROWS), ["k"], partitions=6))
    final = plan.split("Initial Plan")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(_part", final)) == 1 and final.count("Exchange hash") == 1
    assert "SinglePartition" not in final and final.count("BroadcastHashJoin") == 1


def test_funnel_has_no_per_user_window(spark):
    ev = spark.range(3000).select((F.col("id") % 17).alias("user_id"),
                                  F.element_at(F.array(*[F.lit(s) for s in kpi.FUNNEL_STEPS]),
                                               (F.col("id") % 4 + 1).cast("int")).alias("event_type"),
                                  F.timestamp_seconds(F.col("id") * 61).cast("timestamp_ntz").alias("ts"))
    plan = _plan(kpi.funnel_conversion(ev, persist=False))
    windows = re.findall(r"Window \[[^\n]*", plan)
    assert windows and all("_u" not in w.split("], [")[1] for w in windows if "], [" in w)


def test_fact_lookups_carry_the_salt_in_every_sort_merge_exchange(spark):
    from starpipe.plans.registry import QUERIES
    from tests.conftest import SF_SMALL

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["fact_enrollment"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lookups = [p for p in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if not p.startswith("_part#")]
    assert lookups and all("_null_salt" in p for p in lookups), lookups


def test_colocated_fact_meets_its_enrolments_without_an_exchange(spark):
    from starpipe.plans.registry import QUERIES
    from tests.conftest import SF_SMALL

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["fact_attendance_colocated"](spark, SF_SMALL))
        plain = _plan(QUERIES["fact_attendance"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning(EnrollmentId" in plain
    assert "Exchange hashpartitioning(EnrollmentId" not in plan and re.search(r"SortMergeJoin(\(skew=true\))? \[EnrollmentId", plan)
    assert "Bucketed: true" in plan or "bucket" in plan.lower()


def _wide_exchanges(df, column: str) -> int:
    """Exchanges in the plan that carry ``column``."""
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    final = text.split("== Initial Plan ==")[0]
    details = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\n]*)\]", final)
    return len({d for d in details if re.search(rf"\b{column}#", d)})


def test_attendance_rows_meet_their_enrolment_and_attendee_in_one_shuffle(spark):
    """Not one for the enrolment and another one for the attendee of its unit."""
    from starpipe.plans.registry import QUERIES
    from tests.conftest import SF_SMALL

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:   # the other three are for offsets, units and organisations, which are broadcast unless they are large
        assert _wide_exchanges(QUERIES["fact_attendance"](spark, SF_SMALL), "TimeEnd") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_attendances_are_shuffled_once_for_their_latest_version_and_their_place(spark, monkeypatch):
    """The cleaned table is written in key order: the key's layout is not a second shuffle and write of the rows."""
    from starpipe.operators import keys
    from starpipe.plans.registry import Warehouse
    from tests.conftest import SF_SMALL

    laid = []
    ranged = keys.range_layout
    monkeypatch.setattr(keys, "range_layout", lambda df, order, **how: (laid.append(list(order)), ranged(df, order, **how))[1])
    w = Warehouse(spark, SF_SMALL)
    fact = w.fact_att()
    assert ["AttendanceId"] not in laid and ["BusinessUnitId", "EnrollmentId"] not in laid
    ids = [r[0] for r in fact.orderBy("AttendanceFactKey").select("AttendanceId").collect()]
    assert ids == sorted(ids) and fact.agg(F.max("AttendanceFactKey")).first()[0] == len(ids) == fact.select("AttendanceId").distinct().count()


def test_lines_are_shuffled_once_to_become_attendances(spark):
    """Orders meet customers before the lines meet the orders."""
    from starpipe.sources.fixtures import stg_attendance
    from tests.conftest import SF_SMALL

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _wide_exchanges(stg_attendance(spark, SF_SMALL), "l_shipdate") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_columns_of_the_fact_that_a_query_does_not_read_are_not_shuffled(spark):
    """All lookups stay; the salt of rows without a key does not drag whole rows to the joins."""
    from starpipe.plans.registry import Warehouse
    from tests.conftest import SF_SMALL

    w = Warehouse(spark, SF_SMALL)
    whole, narrow = w.build_fact_att(), w.build_fact_att().select("AttendanceFactKey", "AttendanceId")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _wide_exchanges(whole, "CreatedOn") > 0 and _wide_exchanges(whole, "TimeEnd") > 0
        assert _wide_exchanges(narrow, "CreatedOn") == 0 and _wide_exchanges(narrow, "TimeEnd") == 0
        assert _plan(whole).count("LeftOuter") == _plan(narrow).count("LeftOuter") > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_latest_versions_in_key_order_are_sorted_once(spark):
    from starpipe import contracts as C
    from starpipe.plans.clean import clean_in_key_order
    from starpipe.sources.fixtures import stg_attendance
    from tests.conftest import SF_SMALL

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _plan(clean_in_key_order(stg_attendance(spark, SF_SMALL), C.ATTENDANCE)).count("Sort [AttendanceId") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
