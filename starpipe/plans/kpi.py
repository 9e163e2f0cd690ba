"""Business metrics on the star schema.

The questions come from the pipeline's stated goals; how each is measured
is this library's definition (stated per function).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starpipe.functions.scalar import _as_date_col, duration_minutes
from starpipe.operators.intervals import concurrency
from starpipe.operators.lookup import lookup_key

# --- fixed values: funnel steps in order (our definition over the event table).
FUNNEL_STEPS = ("view", "click", "signup", "purchase")


def booking_detail(attendance: DataFrame, enrollment: DataFrame, attendee: DataFrame,
                   program: DataFrame) -> DataFrame:
    """Who booked, which program, when: one row per cleaned attendance.

    The business unit comes from the enrolment (of several units the lowest,
    which is the one with the lowest fact key), the account from the attendee
    of that unit. Unmatched rows keep NULLs, and the lookups' salt spreads
    NULL keys instead of sending them all to one reducer.
    """
    units = enrollment.groupBy("EnrollmentId").agg(F.min("BusinessUnitId").alias("BusinessUnitId"))
    out = lookup_key(attendance, units, "EnrollmentId", "BusinessUnitId", default=None)
    out = lookup_key(out, attendee.select("BusinessUnitId", "AttendeeId", "AccountId"),
                     ["BusinessUnitId", "AttendeeId"], "AccountId", default=None)
    out = lookup_key(out, program, "ProgramId", "ProgramName", default=None)
    return out.select("AttendanceId", "BookingId", "AttendeeId", "AccountId", "ProgramId", "ProgramName",
                      "AttendanceDate", F.date_format("AttendanceDate", "EEEE").alias("DayName"),
                      F.date_format("AttendanceDate", "yyyy-MM").alias("YearMonth"), "TimeStart", "TimeEnd",
                      duration_minutes("TimeStart", "TimeEnd").alias("AttendanceMinutes"))


def _active_at(as_of) -> F.Column:
    d = _as_date_col(as_of)
    return (F.col("StartDate") <= d) & (F.col("EndDate").isNull() | (F.col("EndDate") >= d))


def occupancy_rate(fact_enr: DataFrame, capacity: DataFrame, as_of=None) -> DataFrame:
    """Enrolments active on ``as_of`` per organisation over its licensed places, in %.

    Active: started on or before ``as_of`` and not ended before it (an open
    end counts as active). The record's ``IsActive`` flag says whether it is the
    current version, not whether the child is enrolled, and does not count.
    Organisations with capacity but no enrolment show 0; those with
    enrolments but no known capacity have NULL capacity and NULL rate.
    """
    active = (fact_enr.filter(_active_at(as_of))
              .groupBy("BusinessUnitId", "OrganisationId")
              .agg(F.count(F.lit(1)).alias("ActiveEnrollments")))
    return (capacity.join(active, on=["BusinessUnitId", "OrganisationId"], how="full")
            .fillna({"ActiveEnrollments": 0})
            .withColumn("OccupancyRatePct",
                        F.try_divide(F.col("ActiveEnrollments").cast("double") * 100,
                                     F.col("LicensedCapacity").cast("double")))
            .select("BusinessUnitId", "OrganisationId", "LicensedCapacity",
                    "ActiveEnrollments", "OccupancyRatePct"))


def attended_use(fact_att: DataFrame, capacity: DataFrame) -> DataFrame:
    """Actual use against capacity: distinct attendees a day per organisation.

    DaysAttended, the busiest day's attendees, the mean over days attended,
    and both over the licensed places in %. Undated attendances do not count.
    Organisations on one side only are kept, as in ``occupancy_rate``.
    """
    daily = (fact_att.filter(F.col("AttendanceDate").isNotNull())
             .select("BusinessUnitId", "OrganisationId", "AttendanceDate", "AttendeeId").distinct()
             .groupBy("BusinessUnitId", "OrganisationId", "AttendanceDate").agg(F.count("AttendeeId").alias("_n")))
    used = daily.groupBy("BusinessUnitId", "OrganisationId").agg(
        F.count(F.lit(1)).alias("DaysAttended"), F.max("_n").alias("PeakAttendees"), F.sum("_n").alias("_sum"))
    places = F.col("LicensedCapacity").cast("double")
    mean = F.try_divide(F.col("_sum").cast("double"), F.col("DaysAttended").cast("double"))
    return (capacity.join(used, on=["BusinessUnitId", "OrganisationId"], how="full")
            .fillna({"DaysAttended": 0, "PeakAttendees": 0})
            .select("BusinessUnitId", "OrganisationId", "LicensedCapacity", "DaysAttended", "PeakAttendees",
                    mean.alias("MeanAttendees"),
                    F.try_divide(F.col("PeakAttendees").cast("double") * 100, places).alias("PeakUsePct"),
                    F.try_divide(mean * 100, places).alias("MeanUsePct")))


def attendance_behaviour(attendance: DataFrame) -> DataFrame:
    """Visits, distinct attendees and minutes per organisation and weekday, from cleaned attendances."""
    return (attendance
            .withColumn("AttendanceMinutes", duration_minutes("TimeStart", "TimeEnd"))
            .withColumn("DayOfWeek", F.dayofweek("AttendanceDate"))
            .withColumn("DayName", F.date_format("AttendanceDate", "EEEE"))
            .groupBy("OrganisationId", "DayOfWeek", "DayName")
            .agg(F.count(F.lit(1)).alias("Visits"),
                 F.count_distinct("AttendeeId").alias("Attendees"),
                 F.sum("AttendanceMinutes").cast("long").alias("TotalMinutes"),
                 F.try_divide(F.sum("AttendanceMinutes").cast("double"),
                              F.count("AttendanceMinutes").cast("double")).alias("AvgMinutes")))


def peak_program_fill(attendance: DataFrame) -> DataFrame:
    """Each program's busiest day (most attendances; earliest day on a tie).

    Daily counts are aggregated first (map-side combined), so the per-program
    window only sees one row per (program, day).
    """
    daily = (attendance.filter(F.col("AttendanceDate").isNotNull())
             .groupBy("ProgramId", "AttendanceDate")
             .agg(F.count(F.lit(1)).alias("Visits")))
    w = Window.partitionBy("ProgramId").orderBy(F.col("Visits").desc(), F.col("AttendanceDate").asc())
    return (daily.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select("ProgramId", F.col("AttendanceDate").alias("PeakDate"),
                    F.col("Visits").alias("PeakVisits")))


def max_capacity(capacity: DataFrame) -> DataFrame:
    """The most licensed places of any organisation per business unit, and how many organisations have any."""
    return capacity.groupBy("BusinessUnitId").agg(
        F.max("LicensedCapacity").alias("MaxCapacity"), F.count("LicensedCapacity").alias("Organisations"))


def max_room_headcount(fact_hc: DataFrame, room_type: str = "Room") -> DataFrame:
    """Largest room headcount per organisation (and how many rooms were counted)."""
    return (fact_hc.filter(F.col("HeadcountType") == room_type)
            .groupBy("OrganisationId")
            .agg(F.max("TotalCount").alias("MaxRoomCount"),
                 F.count_distinct("HeadcountId").alias("Rooms")))


ORGANISATION = ("BusinessUnitId", "OrganisationId")


def room_peaks(fact_att: DataFrame, places: DataFrame) -> DataFrame:
    """Present at the same time, against the places: one row per organisation.

    PeakPresent and the first moment it is reached, and the whole minutes in
    which more were present than ``places(BusinessUnitId, OrganisationId, Places)``
    (NULL where the places are not known). Attendances without both
    times, or that end when they start, are not present. Organisations with
    places and no attendance have a peak of 0.
    """
    steps = concurrency(fact_att, ORGANISATION, "TimeStart", "TimeEnd")
    seconds = F.timestamp_diff("SECOND", F.col("At"), F.col("Until"))
    peaks = (steps.join(places, [*ORGANISATION], "left").groupBy(*ORGANISATION).agg(
        F.max("Level").alias("PeakPresent"),
        F.min_by("At", F.struct(-F.col("Level"), "At")).alias("PeakAt"),
        F.sum(F.when(F.col("Level") > F.col("Places"), seconds)
               .when(F.col("Places").isNotNull(), 0)).alias("_over")))
    return (places.join(peaks, [*ORGANISATION], "full")
            .select(*ORGANISATION, "Places", F.coalesce("PeakPresent", F.lit(0)).alias("PeakPresent"), "PeakAt",
                    F.floor(F.when(F.col("Places").isNotNull(), F.coalesce("_over", F.lit(0))) / 60).alias("MinutesOverPlaces")))


def room_peaks_by_hour(fact_att: DataFrame) -> DataFrame:
    """The most present at the same time in each hour of the day, over all days, per organisation.

    Each step counts in the hours that it touches: at most 24 rows a step,
    as a longer one touches every hour of the day. Hours in which nobody was ever present have no row.
    """
    hour = F.date_trunc("hour", F.col("At")).cast("timestamp_ntz")
    last = F.least(F.col("Until") - F.expr("INTERVAL 1 MICROSECOND"), hour + F.expr("INTERVAL 23 HOURS"))
    steps = concurrency(fact_att, ORGANISATION, "TimeStart", "TimeEnd").where("Level > 0")
    return (steps.select(*ORGANISATION, "Level", F.explode(F.sequence(hour, last, F.expr("INTERVAL 1 HOUR"))).alias("h"))
            .groupBy(*ORGANISATION, F.hour("h").alias("HourOfDay")).agg(F.max("Level").alias("PeakPresent")))


def new_enrollments_monthly(fact_enr: DataFrame) -> DataFrame:
    """New enrolments per month of EnrolledDate and the change on the month before.

    Every month from the first to the last has a row, those without
    enrolments with 0. Enrolments without a readable date are the row of NULL
    YearMonth, which has no month before. The series has one row per
    calendar month, so the ``lag`` over it runs in one task without harm.
    """
    counted = (fact_enr.groupBy(F.trunc("EnrolledDate", "month").alias("_m"))
               .agg(F.count(F.lit(1)).alias("NewEnrollments")))
    spine = (counted.agg(F.min("_m").alias("lo"), F.max("_m").alias("hi"))
             .where("lo IS NOT NULL")
             .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("_m")))
    monthly = spine.join(counted, "_m", "left").fillna({"NewEnrollments": 0})
    previous = F.lag("NewEnrollments").over(Window.orderBy("_m"))
    dated = monthly.select(F.date_format("_m", "yyyy-MM").alias("YearMonth"), "NewEnrollments",
                           previous.alias("PreviousEnrollments"))
    undated = counted.where("_m IS NULL").select(
        F.lit(None).cast("string").alias("YearMonth"), "NewEnrollments", F.lit(None).cast("long").alias("PreviousEnrollments"))
    return dated.unionByName(undated).withColumn(
        "ChangeFromPrevious", F.col("NewEnrollments") - F.col("PreviousEnrollments"))


def occupancy_outlook(fact_enr: DataFrame, as_of=None, months: int = 6) -> DataFrame:
    """Enrolments expected to be active in each of the next ``months`` months.

    An enrolment counts in a month when it starts by the month's last day and
    does not end before its first day (open end = still enrolled). Each
    enrolment is expanded to the months it covers *within the horizon*
    (at most ``months`` rows), then counted - an equi-aggregation instead of
    a range join against a month table. Every organisation with any enrolment
    has a row for each month, with 0 where nobody is expected.
    """
    d = _as_date_col(as_of)
    h_first = F.add_months(F.trunc(d, "month"), 1)
    h_last = F.add_months(F.trunc(d, "month"), months)
    lo = F.greatest(F.trunc("StartDate", "month"), h_first)
    hi = F.least(F.coalesce(F.trunc("EndDate", "month"), h_last), h_last)
    org = ["BusinessUnitId", "OrganisationId"]
    month = F.expr("INTERVAL 1 MONTH")
    expected = (fact_enr.filter(F.col("StartDate").isNotNull())
                .select(*org, lo.alias("_lo"), hi.alias("_hi"))
                .filter(F.col("_lo") <= F.col("_hi"))
                .select(*org, F.explode(F.sequence("_lo", "_hi", month)).alias("MonthStart"), F.lit(1).alias("_one")))
    # A row of weight 0 for each organisation and month, so a month with nobody is there too.
    spine = (fact_enr.select(*org).distinct()
             .select("*", F.explode(F.sequence(h_first, h_last, month)).alias("MonthStart"), F.lit(0).alias("_one")))
    return expected.unionByName(spine).groupBy(*org, "MonthStart").agg(F.sum("_one").alias("ExpectedEnrollments"))


def funnel_conversion(events: DataFrame, steps: Sequence[str] = FUNNEL_STEPS,
                      user: str = "user_id", kind: str = "event_type", ts: str = "ts",
                      persist: bool = True) -> DataFrame:
    """Ordered funnel: a user reaches step k with an event of that type at or
    after the moment they reached step k-1 (first time). Per step: users
    reaching it, conversion from the previous step and from the first.

    Step k: that step's events (type filter pushed to the scan) inner-joined
    to the users who reached step k-1, filtered on time, then a per-user
    ``min`` (combined map-side). No per-user window anywhere; in an inner
    join AQE may split either side, so a user holding a third of all events
    is spread over tasks. Each step's per-user table feeds the next step
    and the count, so it is written once to the shared scratch folder
    (``persist``) instead of being recomputed for every later step.
    """
    from starpipe.sources.io import materialize

    ev = events.select(F.col(user).alias("_u"), F.col(kind).alias("_k"), F.col(ts).alias("_t"))
    keep = (lambda df, i: materialize(df, f"funnel{i}")) if persist else (lambda df, i: df)
    reached = keep(ev.filter(F.col("_k") == steps[0]).groupBy("_u").agg(F.min("_t").alias("_t")), 1)
    counts = [reached.agg(F.count(F.lit(1)).alias("Users"))
              .select(F.lit(1).alias("StepNumber"), F.lit(steps[0]).alias("Step"), "Users")]
    for i, step in enumerate(steps[1:], start=2):
        nxt = (ev.filter(F.col("_k") == step)
               .join(reached.withColumnRenamed("_t", "_prev"), on="_u", how="inner")
               .filter(F.col("_t") >= F.col("_prev"))
               .groupBy("_u").agg(F.min("_t").alias("_t")))
        reached = keep(nxt, i)
        counts.append(reached.agg(F.count(F.lit(1)).alias("Users"))
                      .select(F.lit(i).alias("StepNumber"), F.lit(step).alias("Step"), "Users"))
    allc = counts[0]
    for c in counts[1:]:
        allc = allc.unionByName(c)
    w = Window.orderBy("StepNumber")  # one row per step: a handful of rows
    return (allc.withColumn("_prev", F.lag("Users").over(w))
            .withColumn("_first", F.first("Users").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("ConversionFromPrevious", F.try_divide(F.col("Users").cast("double"),
                                                               F.col("_prev").cast("double")))
            .withColumn("ConversionFromFirst", F.try_divide(F.col("Users").cast("double"),
                                                            F.col("_first").cast("double")))
            .drop("_prev", "_first"))
