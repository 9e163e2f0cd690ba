"""Dirty staging tables derived from the driver's TPC-H-like tables.

The driver's tables are clean (no NULL keys, no versions, every parent
present), so dirt is injected deterministically - the same rule is written
once here with the DataFrame API and once as DuckDB SQL in
``starpipe.plans.oracle``. Every view grows with its base table.

Rule: each base row appears as version n = 0, plus n = 1 when key % 3 = 0,
plus n = 2 when key % 7 = 0, with

    IsActive  = NULL when key % 13 = 0 and n = 0, else (key + n) % 2 = 0
    CreatedOn = base_ts + n hours
    UpdatedOn = NULL when key % 11 = 0, else base_ts + n days

so (IsActive, UpdatedOn, CreatedOn) orders the versions of a key totally.
Domain mapping: BusinessUnit <- region, Org <- nation, Attendee <- customer,
Enrollment <- orders, Attendance <- lineitem, HeadCount <- supplier,
Program <- part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Timestamp literal all fixture rows without a date of their own start from.
BASE_TS = "TIMESTAMP_NTZ'2020-01-01 00:00:00'"


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _div(k: Column, d: int) -> Column:
    return ((k - k % d) / d).cast("long")


def _versions(df: DataFrame, k: Column, base_ts: Column) -> DataFrame:
    n = F.col("_n")
    by3, by7 = k % 3 == 0, k % 7 == 0
    # Only the versions a key has are generated (no expand-then-filter).
    versions = (F.when(by3 & by7, F.array(F.lit(0), F.lit(1), F.lit(2)))
                 .when(by3, F.array(F.lit(0), F.lit(1)))
                 .when(by7, F.array(F.lit(0), F.lit(2)))
                 .otherwise(F.array(F.lit(0))))
    v = df.withColumn("_n", F.explode(versions))
    return (v.withColumn("IsActive", F.when((k % 13 == 0) & (n == 0), F.lit(None).cast("boolean"))
                                       .otherwise((k + n) % 2 == 0))
             .withColumn("CreatedOn", base_ts + F.make_dt_interval(F.lit(0), n))
             .withColumn("UpdatedOn", F.when(k % 11 == 0, F.lit(None).cast("timestamp_ntz"))
                                       .otherwise(base_ts + F.make_dt_interval(n))))


def _audit() -> list[str]:
    return ["IsActive", "CreatedOn", "UpdatedOn"]


def _audit_text() -> list[Column]:
    """The audit columns as text, as a source without types delivers them."""
    return [F.col(c).cast("string").alias(c) for c in _audit()]


def _date_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def stg_business_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = base(spark, sf_dir, "region")
    k = F.col("r_regionkey")
    v = _versions(r, k, F.expr(BASE_TS))
    return v.select(
        F.when(F.col("_n") == 2, F.lit(None).cast("int")).otherwise(k).alias("Id"),
        F.concat(F.lit("BU"), k.cast("string")).alias("Code"),
        F.col("r_name").alias("Name"),
        F.lit(1).cast("long").alias("EnterpriseId"),
        F.lit(0).cast("long").alias("TypeId"),
        *_audit(),
    )


def stg_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = base(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    v = _versions(n, k, F.expr(BASE_TS))
    return v.select(
        _div(k, 3).cast("string").alias("Id"),
        F.when(k == 24, F.lit(99)).otherwise(F.col("n_regionkey")).cast("long").alias("BusinessUnitId"),
        F.concat(F.lit("ORG"), k.cast("string")).alias("Code"),
        F.col("n_name").alias("Name"),
        F.lit(1).cast("long").alias("EnterpriseId"),
        (k % 4).cast("long").alias("TypeId"),
        *_audit_text(),
    )


def stg_attendee(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = base(spark, sf_dir, "customer")
    nat = base(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    j = c.join(nat, c.c_nationkey == nat.n_nationkey, "inner")
    k = F.col("c_custkey")
    v = _versions(j, k, F.expr(BASE_TS))
    dob = (F.when(k % 5 == 0, F.lit("31/12/2015"))
             .when(k % 5 == 1, F.lit("1899-12-31"))
             .when(k % 5 == 2, F.lit("2999-01-01"))
             .otherwise(F.concat(F.lit("2016-0"), (k % 9 + 1).cast("string"), F.lit("-15"))))
    return v.select(
        F.when(k % 97 == 96, F.lit(None).cast("long")).otherwise(k).alias("Id"),
        F.col("n_regionkey").cast("long").alias("BusinessUnitId"),
        _div(k, 2).alias("AccountId"),
        F.lit(1).cast("long").alias("EnterpriseId"),
        (k % 3).alias("GenderId"),
        (k % 4).alias("StatusId"),
        dob.alias("DateOfBirth"),
        *_audit_text(),
    )


def _org_of(orderkey: Column) -> Column:
    nk = F.col("n_nationkey")
    return F.when(orderkey % 23 == 0, F.lit(99).cast("long")).otherwise(_div(nk, 3))


def stg_enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = base(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = base(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nat = base(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    j = (o.join(c, o.o_custkey == c.c_custkey, "inner")
          .join(nat, F.col("c_nationkey") == nat.n_nationkey, "inner"))
    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    d = F.col("o_orderdate")
    # One id in 19 exists under two business units.
    unit = F.col("n_regionkey").cast("long")
    units = F.when(k % 19 == 0, F.array(unit, (unit + 1) % 5)).otherwise(F.array(unit))
    v = _versions(j, k, d).withColumn("_unit", F.explode(units))
    return v.select(
        F.when(k % 97 == 96, F.lit(None).cast("long")).otherwise(k).alias("Id"),
        F.col("_unit").alias("BusinessUnitId"),
        _org_of(k).alias("OrgId"),
        F.when(k % 29 == 0, cust + 100000000).otherwise(cust).alias("AttendeeId"),
        _div(cust, 2).alias("AccountId"),
        (k % 50).alias("SubscriptionId"),
        (k % 4).alias("StatusId"),
        F.when(k % 17 == 0, F.lit("not a date")).otherwise(_date_text(d)).alias("EnrolledDate"),
        _date_text(d).alias("StartDate"),
        F.when(k % 2 == 0, F.lit(None).cast("string"))
         .otherwise(F.date_add(d.cast("date"), 90).cast("string")).alias("EndDate"),
        *_audit(),
    )


def stg_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = base(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = base(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = base(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nat = base(spark, sf_dir, "nation").select("n_nationkey")
    # Orders meet their customers first: the lines, the most rows by far, are shuffled once.
    placed = (o.join(c, F.col("o_custkey") == c.c_custkey, "inner")
               .join(nat, F.col("c_nationkey") == nat.n_nationkey, "inner")
               .select("o_orderkey", "o_custkey", "n_nationkey"))
    j = li.join(placed, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    k = F.col("l_partkey")
    ship = F.col("l_shipdate")
    start = ship + F.make_dt_interval(F.lit(0), F.lit(8))
    end = start + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("l_quantity") * 10 - 50).cast("int"), F.col("l_linenumber"))
    v = _versions(j, k, ship)
    return v.select(
        # Fits the declared ``int``; a few rows share an id, as versions of one attendance.
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 128 + k % 128).alias("Id"),
        F.when(k % 31 == 0, F.col("l_orderkey") + 100000000).otherwise(F.col("l_orderkey")).alias("EnrollmentId"),
        _org_of(F.col("o_orderkey")).alias("OrgId"),
        F.col("o_custkey").alias("AttendeeId"),
        k.alias("ProgramId"),
        F.col("l_orderkey").alias("BookingId"),
        F.col("l_linenumber").alias("TypeId"),
        _date_text(ship).alias("Date"),
        F.when(k % 37 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(start).alias("TimeStart"),
        end.alias("TimeEnd"),
        *_audit(),
    )


def stg_headcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = base(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    bts = F.expr(BASE_TS)
    v = _versions(s, k, bts)
    return v.select(
        k.alias("Id"),
        _div(F.col("s_nationkey").cast("long"), 3).alias("OrgId"),
        (k % 6).alias("TermProgramSetId"),
        (k % 5).alias("TermProductId"),
        F.col("s_name").alias("Description"),
        F.when(k % 3 == 0, F.lit("Room")).when(k % 3 == 1, F.lit("Yard"))
         .otherwise(F.lit("Excursion")).alias("HeadcountType"),
        (k % 4).alias("StatusId"),
        (bts + F.make_dt_interval(k.cast("int"))).alias("HeadcountDateTime"),
        (k % 40).cast("int").alias("TotalCount"),
        *_audit(),
    )


def stg_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = base(spark, sf_dir, "part")
    k = F.col("p_partkey")
    v = _versions(p, k, F.expr(BASE_TS))
    return v.select(
        k.alias("Id"),
        F.col("p_size").cast("long").alias("ProgramCategoryId"),
        (k % 9).alias("OrgId"),
        F.col("p_brand").alias("Code"),
        (k % 5).alias("BusinessUnitId"),
        F.col("p_name").alias("ProgramName"),
        *_audit(),
    )


def stg_program_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = base(spark, sf_dir, "part").select(F.col("p_size").alias("k"), "p_brand", "p_partkey")
    one = p.groupBy("k").agg(F.min("p_brand").alias("b"), F.count(F.lit(1)).alias("n"))
    k = F.col("k")
    return one.select(
        k.cast("string").alias("Id"), (k % 5).alias("BusinessUnitId"), F.col("b").alias("Code"),
        F.concat(F.lit("Category "), k.cast("string")).alias("ProgramName"), F.col("n").alias("TypeId"),
        F.lit("true").alias("IsActive"), F.lit("2020-01-01 00:00:00").alias("CreatedOn"),
        F.lit("never").alias("UpdatedOn"), (k % 9).alias("OrgId"))


def stg_public_holiday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day of each month in which anything was shipped."""
    day = F.last_day(F.col("l_shipdate").cast("date"))
    d = base(spark, sf_dir, "lineitem").select(day.alias("d")).distinct()
    return d.select(
        (F.year("d") * 100 + F.month("d")).alias("Id"), F.lit(1).alias("CountryId"), F.col("d").cast("string").alias("Date"),
        F.date_format("d", "MMMM").alias("HolidayName"), F.lit(None).cast("string").alias("Description"),
        F.lit(True).alias("IsActive"), F.lit("2020-01-01 00:00:00").alias("CreatedOn"), F.lit(None).cast("string").alias("UpdatedOn"))


def manifest_source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A source table of the copy manifest; Program gets the row version that its staging rows lack."""
    extra = {"ProgramCategory": stg_program_category, "PublicHoliday": stg_public_holiday}
    df = (extra.get(table) or STAGING[table])(spark, sf_dir)
    return df.withColumn("Version", F.encode(F.col("Id").cast("string"), "UTF-8")) if table == "Program" else df


def attendee_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of attendees (ten letters from the key's MD5) with planted misspellings: one key in ten comes
    again without its fourth letter, one in fifteen with another sixth letter, one in twenty as it is."""
    c = base(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.substring(F.translate(F.md5(k.cast("string").cast("binary")), "0123456789", "ghijklmnop"), 1, 10)
    dropped = F.concat(F.substring(name, 1, 3), F.substring(name, 5, 6))
    changed = F.concat(F.substring(name, 1, 5), F.lit("z"), F.substring(name, 7, 4))
    copies = F.array(F.struct(F.lit(0).alias("n"), name.alias("name")),
                     F.when(k % 10 == 0, F.struct(F.lit(1).alias("n"), dropped.alias("name"))),
                     F.when(k % 15 == 0, F.struct(F.lit(2).alias("n"), changed.alias("name"))),
                     F.when(k % 20 == 0, F.struct(F.lit(3).alias("n"), F.upper(name).alias("name"))))
    return (c.select(k.alias("k"), "c_nationkey", F.explode(F.array_compact(copies)).alias("x"))
            .select((F.col("k") * 4 + F.col("x.n")).cast("long").alias("AttendeeId"), F.col("c_nationkey").cast("long").alias("NationId"),
                    F.col("x.name").alias("AttendeeName")))


def capacity(cln_org: DataFrame) -> DataFrame:
    """Licensed places per organisation (our fixture: 500 + 10 x OrganisationId)."""
    return cln_org.select(
        "BusinessUnitId", "OrganisationId",
        (F.lit(500) + F.col("OrganisationId") * 10).cast("int").alias("LicensedCapacity"))


def places(cln_org: DataFrame) -> DataFrame:
    """Places that an organisation has at one time (our fixture: its licensed places over 250)."""
    return capacity(cln_org).select("BusinessUnitId", "OrganisationId", F.expr("LicensedCapacity div 250").alias("Places"))


def funnel_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir, "events").select("user_id", "event_type", "ts")


STAGING = {
    "BusinessUnit": stg_business_unit,
    "Org": stg_org,
    "Attendee": stg_attendee,
    "Enrollment": stg_enrollment,
    "Attendance": stg_attendance,
    "HeadCount": stg_headcount,
    "Program": stg_program,
}
