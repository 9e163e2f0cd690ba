import datetime as dt
import itertools

from pyspark.sql import functions as F

from starpipe.plans import kpi


def _t(s):
    return dt.datetime.fromisoformat(s)


def _funnel_brute(events, steps):
    users = {u for u, _, _ in events}
    reached = {s: 0 for s in steps}
    for u in users:
        t = None
        for s in steps:
            cand = [ts for uu, k, ts in events if uu == u and k == s and (t is None or ts >= t)]
            if not cand:
                break
            t = min(cand)
            reached[s] += 1
    return reached


def test_funnel_against_brute_force(spark):
    kinds = ["view", "click", "signup", "purchase", "error"]
    events = []
    for i in range(400):
        u = i % 23
        events.append((u, kinds[(i * 7 + u) % 5], _t("2024-01-01") + dt.timedelta(minutes=(i * 37) % 1000)))
    df = spark.createDataFrame(events, "user_id long, event_type string, ts timestamp_ntz")
    got = {r["Step"]: r for r in kpi.funnel_conversion(df).collect()}
    want = _funnel_brute(events, kpi.FUNNEL_STEPS)
    assert {s: got[s]["Users"] for s in kpi.FUNNEL_STEPS} == want
    assert got["view"]["ConversionFromPrevious"] is None
    assert got["click"]["ConversionFromPrevious"] == want["click"] / want["view"]


def test_occupancy_outlook_against_brute_force(spark):
    rows = []
    for i, (s, e) in enumerate(itertools.product(
            ["1998-01-10", "1998-07-31", "1998-09-01", "1999-02-01"],
            [None, "1998-06-30", "1998-07-01", "1998-10-15", "1999-05-01"])):
        rows.append((1, i % 2, dt.date.fromisoformat(s), dt.date.fromisoformat(e) if e else None))
    df = spark.createDataFrame(rows, "BusinessUnitId long, OrganisationId long, StartDate date, EndDate date")
    got = {(r["OrganisationId"], r["MonthStart"]): r["ExpectedEnrollments"]
           for r in kpi.occupancy_outlook(df, as_of="1998-06-30", months=6).collect()}
    want = {}
    for m in range(7, 13):
        first = dt.date(1998, m, 1)
        last = dt.date(1998 + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)
        for _, org, s, e in rows:
            if s <= last and (e is None or e >= first):
                want[(org, first)] = want.get((org, first), 0) + 1
    assert got == want


def test_peak_program_fill_ties_pick_earliest_day(spark):
    rows = [(1, dt.date(2024, 1, 2)), (1, dt.date(2024, 1, 2)), (1, dt.date(2024, 1, 1)),
            (1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 5))]
    df = spark.createDataFrame(rows, "ProgramId long, AttendanceDate date")
    got = {r["ProgramId"]: (r["PeakDate"], r["PeakVisits"]) for r in kpi.peak_program_fill(df).collect()}
    assert got == {1: (dt.date(2024, 1, 1), 2), 2: (dt.date(2024, 1, 5), 1)}


def test_occupancy_rate_includes_empty_organisations(spark):
    enr = spark.createDataFrame([(1, 1, dt.date(1998, 1, 1), None), (1, 1, dt.date(1999, 1, 1), None)],
                                "BusinessUnitId long, OrganisationId long, StartDate date, EndDate date")
    cap = spark.createDataFrame([(1, 1, 50), (1, 2, 40)], "BusinessUnitId long, OrganisationId long, LicensedCapacity int")
    got = {r["OrganisationId"]: (r["ActiveEnrollments"], r["OccupancyRatePct"])
           for r in kpi.occupancy_rate(enr, cap, as_of="1998-06-30").collect()}
    assert got == {1: (1, 2.0), 2: (0, 0.0)}
    # an organisation without known capacity keeps its enrolments
    got = {r["OrganisationId"]: (r["LicensedCapacity"], r["ActiveEnrollments"], r["OccupancyRatePct"])
           for r in kpi.occupancy_rate(enr, cap.where("OrganisationId = 2"), as_of="1998-06-30").collect()}
    assert got == {1: (None, 1, None), 2: (40, 0, 0.0)}


def test_attended_use_counts_an_attendee_once_a_day(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [(1, 1, d1, 7), (1, 1, d1, 7), (1, 1, d1, 8), (1, 1, d2, 7), (1, 1, None, 9), (1, 3, d1, 7)]
    att = spark.createDataFrame(rows, "BusinessUnitId long, OrganisationId long, AttendanceDate date, AttendeeId long")
    cap = spark.createDataFrame([(1, 1, 4), (1, 2, 40)], "BusinessUnitId long, OrganisationId long, LicensedCapacity int")
    got = {r["OrganisationId"]: tuple(r)[2:] for r in kpi.attended_use(att, cap).collect()}
    assert got == {1: (4, 2, 2, 1.5, 50.0, 37.5), 2: (40, 0, 0, None, 0.0, None), 3: (None, 1, 1, 1.0, None, None)}


def test_outlook_has_a_row_for_a_month_with_nobody(spark):
    enr = spark.createDataFrame([(1, 1, dt.date(1998, 8, 3), dt.date(1998, 8, 20)), (1, None, None, None)],
                                "BusinessUnitId long, OrganisationId long, StartDate date, EndDate date")
    got = sorted((str(r["OrganisationId"]), r["MonthStart"].month, r["ExpectedEnrollments"])
                 for r in kpi.occupancy_outlook(enr, as_of="1998-06-30", months=3).collect())
    assert got == [("1", 7, 0), ("1", 8, 1), ("1", 9, 0), ("None", 7, 0), ("None", 8, 0), ("None", 9, 0)]


def test_funnel_with_a_user_holding_a_third_of_events(spark):
    kinds = ["view", "click", "signup", "purchase"]
    events = []
    for i in range(3000):
        u = 0 if i % 3 == 0 else i % 97 + 1
        events.append((u, kinds[(i * 13 + u) % 4], _t("2024-01-01") + dt.timedelta(seconds=(i * 7919) % 86400)))
    df = spark.createDataFrame(events, "user_id long, event_type string, ts timestamp_ntz")
    got = {r["Step"]: r["Users"] for r in kpi.funnel_conversion(df).collect()}
    assert got == _funnel_brute(events, kpi.FUNNEL_STEPS)


def test_booking_detail_unknown_attendee_stays_visible(spark):
    att = spark.createDataFrame(
        [(1, 1, 70, 7, 100, dt.date(2024, 1, 1), _t("2024-01-01 08:00"), _t("2024-01-01 09:30")),
         (2, 2, 71, 8, 101, dt.date(2024, 1, 2), None, None),
         (3, 3, 99, 7, 100, None, None, None)],
        "AttendanceId long, BookingId long, EnrollmentId long, AttendeeId long, ProgramId long, "
        "AttendanceDate date, TimeStart timestamp_ntz, TimeEnd timestamp_ntz")
    # enrolment 70 exists under two units; the lower one wins
    enr = spark.createDataFrame([(70, 2), (70, 1), (71, 1)], "EnrollmentId long, BusinessUnitId long")
    attendee = spark.createDataFrame([(1, 7, 55), (2, 7, 66)], "BusinessUnitId long, AttendeeId long, AccountId long")
    program = spark.createDataFrame([(100, "Swim")], "ProgramId long, ProgramName string")
    got = {r["AttendanceId"]: (r["AccountId"], r["ProgramName"], r["DayName"], r["AttendanceMinutes"])
           for r in kpi.booking_detail(att, enr, attendee, program).collect()}
    assert got == {1: (55, "Swim", "Monday", 90), 2: (None, None, "Tuesday", None), 3: (None, "Swim", None, None)}


def test_attendance_behaviour_by_weekday(spark):
    rows = [(1, 10, dt.date(2024, 1, 1), 30), (1, 11, dt.date(2024, 1, 1), None),   # Monday
            (1, 10, dt.date(2024, 1, 8), 60), (2, 12, dt.date(2024, 1, 6), 15)]      # Monday, Saturday
    df = spark.createDataFrame(rows, "OrganisationId long, AttendeeId long, AttendanceDate date, m int").select(
        "*", F.lit(_t("2024-01-01")).alias("TimeStart"),
        (F.lit(_t("2024-01-01")) + F.make_dt_interval(F.lit(0), F.lit(0), "m")).alias("TimeEnd"))
    got = {(r["OrganisationId"], r["DayName"]): (r["DayOfWeek"], r["Visits"], r["Attendees"], r["TotalMinutes"],
                                                 r["AvgMinutes"])
           for r in kpi.attendance_behaviour(df).collect()}
    assert got == {(1, "Monday"): (2, 3, 2, 90, 45.0), (2, "Saturday"): (7, 1, 1, 15, 15.0)}


def test_new_enrollments_monthly_change_on_previous_month(spark):
    dates = [dt.date(2024, 1, 5)] * 3 + [dt.date(2024, 2, 1)] + [dt.date(2024, 4, 9)] * 2 + [None]
    df = spark.createDataFrame([(d,) for d in dates], "EnrolledDate date")
    got = [tuple(r) for r in kpi.new_enrollments_monthly(df).orderBy("YearMonth").collect()]
    # a month without enrolments counts 0; undated ones have a row of their own
    assert got == [(None, 1, None, None), ("2024-01", 3, None, None), ("2024-02", 1, 3, -2), ("2024-03", 0, 1, -1),
                   ("2024-04", 2, 0, 2)]
    undated = kpi.new_enrollments_monthly(df.where("EnrolledDate IS NULL")).collect()
    assert [tuple(r) for r in undated] == [(None, 1, None, None)]
