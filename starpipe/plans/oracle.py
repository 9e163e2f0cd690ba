"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: the same dirty staging rule, the
same cleaning and model semantics, in plain SQL with window functions where
Spark needs distributed forms. Each query is one statement: the CTEs it
needs (transitively), then its final SELECT, over the pre-registered views
``region nation customer supplier part orders lineitem events``.
"""

from __future__ import annotations

import datetime as dt

BASE = "TIMESTAMP '2020-01-01 00:00:00'"


def _keep(k: str) -> str:
    return f"(n = 0 OR (n = 1 AND {k} % 3 = 0) OR (n = 2 AND {k} % 7 = 0))"


def _audit(k: str, base: str) -> str:
    return (f"CASE WHEN {k} % 13 = 0 AND n = 0 THEN NULL ELSE ({k} + n) % 2 = 0 END AS IsActive, "
            f"{base} + to_hours(n) AS CreatedOn, "
            f"CASE WHEN {k} % 11 = 0 THEN NULL ELSE {base} + to_days(n) END AS UpdatedOn")


def _audit_text(k: str, base: str) -> str:
    return (f"CAST(CASE WHEN {k} % 13 = 0 AND n = 0 THEN NULL ELSE ({k} + n) % 2 = 0 END AS VARCHAR) AS IsActive, "
            f"CAST({base} + to_hours(n) AS VARCHAR) AS CreatedOn, "
            f"CAST(CASE WHEN {k} % 11 = 0 THEN NULL ELSE {base} + to_days(n) END AS VARCHAR) AS UpdatedOn")


def _versioned(source: str) -> str:
    return f"(SELECT *, unnest([0, 1, 2]) AS n FROM {source})"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


_cte("stg_BusinessUnit", (), f"""
SELECT CAST(CASE WHEN n = 2 THEN NULL ELSE r_regionkey END AS INTEGER) AS Id,
       'BU' || CAST(r_regionkey AS VARCHAR) AS Code, r_name AS Name,
       CAST(1 AS BIGINT) AS EnterpriseId, CAST(0 AS BIGINT) AS TypeId,
       {_audit('r_regionkey', BASE)}
FROM {_versioned('region')} v WHERE {_keep('r_regionkey')}""")

_cte("stg_Org", (), f"""
SELECT CAST(CAST(n_nationkey // 3 AS BIGINT) AS VARCHAR) AS Id,
       CAST(CASE WHEN n_nationkey = 24 THEN 99 ELSE n_regionkey END AS BIGINT) AS BusinessUnitId,
       'ORG' || CAST(n_nationkey AS VARCHAR) AS Code, n_name AS Name,
       CAST(1 AS BIGINT) AS EnterpriseId, CAST(n_nationkey % 4 AS BIGINT) AS TypeId,
       {_audit_text('n_nationkey', BASE)}
FROM {_versioned('nation')} v WHERE {_keep('n_nationkey')}""")

_cte("stg_Attendee", (), f"""
SELECT CASE WHEN c_custkey % 97 = 96 THEN NULL ELSE c_custkey END AS Id,
       CAST(n_regionkey AS BIGINT) AS BusinessUnitId,
       c_custkey // 2 AS AccountId, CAST(1 AS BIGINT) AS EnterpriseId,
       c_custkey % 3 AS GenderId, c_custkey % 4 AS StatusId,
       CASE c_custkey % 5 WHEN 0 THEN '31/12/2015' WHEN 1 THEN '1899-12-31' WHEN 2 THEN '2999-01-01'
            ELSE '2016-0' || CAST(c_custkey % 9 + 1 AS VARCHAR) || '-15' END AS DateOfBirth,
       {_audit_text('c_custkey', BASE)}
FROM {_versioned('(SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey)')} v
WHERE {_keep('c_custkey')}""")

_cte("stg_Enrollment", (), f"""
SELECT CASE WHEN o_orderkey % 97 = 96 THEN NULL ELSE o_orderkey END AS Id,
       unit AS BusinessUnitId,
       CAST(CASE WHEN o_orderkey % 23 = 0 THEN 99 ELSE n_nationkey // 3 END AS BIGINT) AS OrgId,
       CASE WHEN o_orderkey % 29 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS AttendeeId,
       o_custkey // 2 AS AccountId, o_orderkey % 50 AS SubscriptionId, o_orderkey % 4 AS StatusId,
       CASE WHEN o_orderkey % 17 = 0 THEN 'not a date' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS EnrolledDate,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS StartDate,
       CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + 90 AS VARCHAR) END AS EndDate,
       {_audit('o_orderkey', 'o_orderdate')}
FROM {_versioned("""(SELECT *, unnest(CASE WHEN o_orderkey % 19 = 0 THEN [CAST(n_regionkey AS BIGINT), (n_regionkey + 1) % 5]
                           ELSE [CAST(n_regionkey AS BIGINT)] END) AS unit
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""")} v
WHERE {_keep('o_orderkey')}""")

_cte("stg_Attendance", (), f"""
SELECT (l_orderkey * 8 + l_linenumber) * 128 + l_partkey % 128 AS Id,
       CASE WHEN l_partkey % 31 = 0 THEN l_orderkey + 100000000 ELSE l_orderkey END AS EnrollmentId,
       CAST(CASE WHEN o_orderkey % 23 = 0 THEN 99 ELSE n_nationkey // 3 END AS BIGINT) AS OrgId,
       o_custkey AS AttendeeId, l_partkey AS ProgramId, l_orderkey AS BookingId, l_linenumber AS TypeId,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS Date,
       CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE l_shipdate + INTERVAL 8 HOUR END AS TimeStart,
       l_shipdate + INTERVAL 8 HOUR + to_minutes(CAST(l_quantity * 10 - 50 AS BIGINT))
           + to_seconds(CAST(l_linenumber AS BIGINT)) AS TimeEnd,
       {_audit('l_partkey', 'l_shipdate')}
FROM {_versioned('(SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)')} v
WHERE {_keep('l_partkey')}""")

_cte("stg_HeadCount", (), f"""
SELECT s_suppkey AS Id, CAST(s_nationkey // 3 AS BIGINT) AS OrgId,
       s_suppkey % 6 AS TermProgramSetId, s_suppkey % 5 AS TermProductId, s_name AS Description,
       CASE s_suppkey % 3 WHEN 0 THEN 'Room' WHEN 1 THEN 'Yard' ELSE 'Excursion' END AS HeadcountType,
       s_suppkey % 4 AS StatusId, {BASE} + to_days(CAST(s_suppkey AS INTEGER)) AS HeadcountDateTime,
       CAST(s_suppkey % 40 AS INTEGER) AS TotalCount,
       {_audit('s_suppkey', BASE)}
FROM {_versioned('supplier')} v WHERE {_keep('s_suppkey')}""")

_cte("stg_Program", (), f"""
SELECT p_partkey AS Id, CAST(p_size AS BIGINT) AS ProgramCategoryId, p_partkey % 9 AS OrgId,
       p_brand AS Code, p_partkey % 5 AS BusinessUnitId, p_name AS ProgramName,
       {_audit('p_partkey', BASE)}
FROM {_versioned('part')} v WHERE {_keep('p_partkey')}""")

LATEST = "IsActive DESC NULLS LAST, UpdatedOn DESC NULLS LAST, CreatedOn DESC NULLS LAST"


# The cleaned columns are written out here, not taken from the library's
# contracts, so that a wrong column or type there shows.
def _big(*cols: str) -> str:
    """Columns as BIGINT; ``Source>Target`` renames."""
    return ", ".join(f"TRY_CAST({c.split('>')[0]} AS BIGINT) AS {c.split('>')[-1]}" for c in cols)


def _day(*cols: str) -> str:
    return ", ".join(f"TRY_CAST(CAST({c.split('>')[0]} AS VARCHAR) AS DATE) AS {c.split('>')[-1]}" for c in cols)


def _time(*cols: str) -> str:
    return ", ".join(f"TRY_CAST(CAST({c} AS VARCHAR) AS TIMESTAMP) AS {c}" for c in cols)


_AUDIT = f"TRY_CAST(IsActive AS BOOLEAN) AS IsActive, {_time('CreatedOn', 'UpdatedOn')}"

_cte("conf_BusinessUnit", ("stg_BusinessUnit",), f"""
SELECT {_big('Id>BusinessUnitId')}, Code AS BusinessUnitCode, Name AS BusinessUnitName,
       {_big('EnterpriseId', 'TypeId')}, {_AUDIT} FROM stg_BusinessUnit WHERE TRY_CAST(Id AS BIGINT) IS NOT NULL""")
_cte("conf_Organisation", ("stg_Org",), f"""
SELECT {_big('Id>OrganisationId', 'BusinessUnitId')}, Code AS OrganisationCode, Name AS OrganisationName,
       {_big('EnterpriseId', 'TypeId')}, {_AUDIT} FROM stg_Org
WHERE TRY_CAST(Id AS BIGINT) IS NOT NULL AND BusinessUnitId IS NOT NULL""")
_cte("conf_Attendee", ("stg_Attendee",), f"""
SELECT {_big('Id>AttendeeId', 'BusinessUnitId', 'AccountId', 'EnterpriseId', 'GenderId', 'StatusId')},
       {_day('DateOfBirth>RawDateOfBirth')}, {_AUDIT} FROM stg_Attendee
WHERE Id IS NOT NULL AND BusinessUnitId IS NOT NULL""")
_cte("conf_Enrollment", ("stg_Enrollment",), f"""
SELECT {_big('Id>EnrollmentId', 'BusinessUnitId', 'OrgId>OrganisationId', 'AttendeeId', 'AccountId', 'SubscriptionId', 'StatusId')},
       {_day('EnrolledDate', 'StartDate', 'EndDate')}, {_AUDIT} FROM stg_Enrollment
WHERE Id IS NOT NULL AND BusinessUnitId IS NOT NULL""")
_cte("conf_Attendance", ("stg_Attendance",), f"""
SELECT {_big('Id>AttendanceId', 'EnrollmentId', 'OrgId>OrganisationId', 'AttendeeId', 'ProgramId', 'BookingId', 'TypeId')},
       {_day('Date>AttendanceDate')}, {_time('TimeStart', 'TimeEnd')}, {_AUDIT} FROM stg_Attendance WHERE Id IS NOT NULL""")
_cte("conf_HeadCount", ("stg_HeadCount",), f"""
SELECT {_big('Id>HeadcountId', 'OrgId>OrganisationId', 'TermProgramSetId', 'TermProductId')}, Description, HeadcountType,
       {_big('StatusId')}, TRY_CAST(TotalCount AS INTEGER) AS TotalCount, {_AUDIT} FROM stg_HeadCount WHERE Id IS NOT NULL""")
_cte("conf_Program", ("stg_Program",), f"""
SELECT {_big('Id>ProgramId', 'ProgramCategoryId', 'OrgId>OrganisationId')}, Code AS ProgramCode, {_big('BusinessUnitId')},
       ProgramName, {_AUDIT} FROM stg_Program WHERE Id IS NOT NULL""")

_DOB_OK = (r"regexp_matches(CAST(RawDateOfBirth AS VARCHAR), '^\d{4}-\d{2}-\d{2}$') "
           f"AND RawDateOfBirth >= DATE '1900-01-01' AND RawDateOfBirth <= DATE '2025-06-30'")
_cte("conf_Attendee_dob", ("conf_Attendee",), f"""
SELECT AttendeeId, BusinessUnitId, AccountId, EnterpriseId, GenderId, StatusId, IsActive, CreatedOn, UpdatedOn,
       CASE WHEN {_DOB_OK} THEN RawDateOfBirth END AS DateOfBirth
FROM conf_Attendee""")

for _name, _source, _keys in (
        ("BusinessUnit", "conf_BusinessUnit", "BusinessUnitId"),
        ("Organisation", "conf_Organisation", "BusinessUnitId, OrganisationId"),
        ("Attendee", "conf_Attendee_dob", "BusinessUnitId, AttendeeId"),
        ("Enrollment", "conf_Enrollment", "BusinessUnitId, EnrollmentId"),
        ("Attendance", "conf_Attendance", "AttendanceId"),
        ("HeadCount", "conf_HeadCount", "HeadcountId"),
        ("Program", "conf_Program", "ProgramId")):
    _cte(f"cln_{_name}", (_source,),
         f"SELECT * FROM {_source} QUALIFY row_number() OVER (PARTITION BY {_keys} ORDER BY {LATEST}) = 1")


def _dkey(col: str) -> str:
    return f"CAST(strftime({col}, '%Y%m%d') AS INTEGER)"


_MINUTES = ("CASE WHEN t.TimeStart IS NOT NULL AND t.TimeEnd IS NOT NULL AND t.TimeEnd >= t.TimeStart "
            "THEN CAST((CAST(floor(epoch(t.TimeEnd)) AS BIGINT) - CAST(floor(epoch(t.TimeStart)) AS BIGINT)) // 60 "
            "AS INTEGER) END")

_cte("dim_BusinessUnit", ("cln_BusinessUnit",),
     "SELECT *, row_number() OVER (ORDER BY BusinessUnitId) AS BusinessUnitKey FROM cln_BusinessUnit")

_cte("dim_Organisation", ("cln_Organisation", "dim_BusinessUnit"), """
SELECT o.OrganisationKey, o.OrganisationId, COALESCE(b.BusinessUnitKey, 0) AS BusinessUnitKey, o.BusinessUnitId,
       o.OrganisationCode, o.OrganisationName, o.EnterpriseId, o.TypeId, o.IsActive, o.CreatedOn, o.UpdatedOn
FROM (SELECT *, row_number() OVER (ORDER BY BusinessUnitId, OrganisationId) AS OrganisationKey
      FROM cln_Organisation) o
LEFT JOIN dim_BusinessUnit b ON o.BusinessUnitId = b.BusinessUnitId""")

_cte("dim_Attendee", ("cln_Attendee", "dim_BusinessUnit"), """
SELECT a.AttendeeKey, a.AttendeeId, COALESCE(b.BusinessUnitKey, 0) AS BusinessUnitKey, a.BusinessUnitId,
       a.AccountId, a.EnterpriseId, a.GenderId, a.DateOfBirth, a.StatusId, a.IsActive, a.CreatedOn, a.UpdatedOn
FROM (SELECT *, row_number() OVER (ORDER BY BusinessUnitId, AttendeeId) AS AttendeeKey FROM cln_Attendee) a
LEFT JOIN dim_BusinessUnit b ON a.BusinessUnitId = b.BusinessUnitId""")

_cte("fact_Enrollment", ("cln_Enrollment", "dim_BusinessUnit", "dim_Organisation", "dim_Attendee"), f"""
SELECT e.EnrollmentFactKey, e.EnrollmentId, COALESCE(b.BusinessUnitKey, 0) AS BusinessUnitKey,
       COALESCE(o.OrganisationKey, 0) AS OrganisationKey, COALESCE(a.AttendeeKey, 0) AS AttendeeKey,
       e.BusinessUnitId, e.OrganisationId, e.AttendeeId, e.AccountId, e.SubscriptionId, e.StatusId,
       {_dkey('e.EnrolledDate')} AS EnrolledDateKey, {_dkey('e.StartDate')} AS StartDateKey,
       {_dkey('e.EndDate')} AS EndDateKey, e.EnrolledDate, e.StartDate, e.EndDate, e.IsActive,
       1 AS EnrollmentCount, e.CreatedOn, e.UpdatedOn
FROM (SELECT *, row_number() OVER (ORDER BY BusinessUnitId, EnrollmentId) AS EnrollmentFactKey
      FROM cln_Enrollment) e
LEFT JOIN dim_BusinessUnit b ON e.BusinessUnitId = b.BusinessUnitId
LEFT JOIN dim_Organisation o ON e.BusinessUnitId = o.BusinessUnitId AND e.OrganisationId = o.OrganisationId
LEFT JOIN dim_Attendee a ON e.BusinessUnitId = a.BusinessUnitId AND e.AttendeeId = a.AttendeeId""")

_cte("enr_keys", ("cln_Enrollment",),
     "SELECT *, row_number() OVER (ORDER BY BusinessUnitId, EnrollmentId) AS EnrollmentFactKey FROM cln_Enrollment")

_cte("enr_lookup", ("enr_keys",), """
SELECT EnrollmentId, arg_min(BusinessUnitId, EnrollmentFactKey) AS BusinessUnitId,
       min(EnrollmentFactKey) AS EnrollmentFactKey
FROM enr_keys GROUP BY EnrollmentId""")

_cte("fact_Attendance", ("cln_Attendance", "enr_lookup", "dim_BusinessUnit", "dim_Organisation", "dim_Attendee"), f"""
SELECT t.AttendanceFactKey, t.AttendanceId, l.EnrollmentFactKey, COALESCE(b.BusinessUnitKey, 0) AS BusinessUnitKey,
       COALESCE(o.OrganisationKey, 0) AS OrganisationKey, COALESCE(a.AttendeeKey, 0) AS AttendeeKey,
       t.EnrollmentId, l.BusinessUnitId, t.OrganisationId, t.AttendeeId, t.ProgramId, t.BookingId, t.TypeId,
       {_dkey('t.AttendanceDate')} AS AttendanceDateKey, t.AttendanceDate, t.TimeStart, t.TimeEnd,
       {_MINUTES} AS AttendanceMinutes, 1 AS AttendanceCount, t.IsActive, t.CreatedOn, t.UpdatedOn
FROM (SELECT *, row_number() OVER (ORDER BY AttendanceId) AS AttendanceFactKey FROM cln_Attendance) t
LEFT JOIN enr_lookup l ON t.EnrollmentId = l.EnrollmentId
LEFT JOIN dim_BusinessUnit b ON l.BusinessUnitId = b.BusinessUnitId
LEFT JOIN dim_Organisation o ON l.BusinessUnitId = o.BusinessUnitId AND t.OrganisationId = o.OrganisationId
LEFT JOIN dim_Attendee a ON l.BusinessUnitId = a.BusinessUnitId AND t.AttendeeId = a.AttendeeId""")

_cte("fact_Headcount", ("cln_HeadCount", "dim_Organisation", "dim_BusinessUnit"), f"""
SELECT h.HeadcountFactKey, h.HeadcountId, COALESCE(b.BusinessUnitKey, 0) AS BusinessUnitKey,
       COALESCE(o.OrganisationKey, 0) AS OrganisationKey, o.BusinessUnitId, h.OrganisationId,
       h.TermProgramSetId, h.TermProductId, h.StatusId,
       {_dkey('CAST(h.CreatedOn AS DATE)')} AS HeadcountDateKey, CAST(h.CreatedOn AS DATE) AS HeadcountDate,
       h.Description, h.HeadcountType, h.TotalCount, 1 AS HeadcountRecordCount, h.IsActive, h.CreatedOn, h.UpdatedOn
FROM (SELECT *, row_number() OVER (ORDER BY HeadcountId) AS HeadcountFactKey FROM cln_HeadCount) h
LEFT JOIN dim_Organisation o ON h.OrganisationId = o.OrganisationId
LEFT JOIN dim_BusinessUnit b ON o.BusinessUnitId = b.BusinessUnitId""")

_cte("fact_Headcount_timed", ("fact_Headcount", "stg_HeadCount"), f"""
SELECT * REPLACE ({_dkey('day')} AS HeadcountDateKey, day AS HeadcountDate) FROM (
  SELECT f.*, s.day FROM fact_Headcount f
  JOIN (SELECT DISTINCT Id, CAST(HeadcountDateTime AS DATE) AS day FROM stg_HeadCount) s ON f.HeadcountId = s.Id) x""")

_cte("date_bounds", ("cln_Enrollment", "cln_Attendance"), """
SELECT min(d) AS lo, max(d) AS hi FROM (
  SELECT EnrolledDate AS d FROM cln_Enrollment UNION ALL SELECT StartDate FROM cln_Enrollment
  UNION ALL SELECT EndDate FROM cln_Enrollment UNION ALL SELECT AttendanceDate FROM cln_Attendance) x""")

_cte("dim_Date", ("date_bounds",), f"""
SELECT {_dkey('d')} AS DateKey, d AS FullDate, CAST(dayofmonth(d) AS INTEGER) AS DayNumber,
       dayname(d) AS DayName, CAST(weekofyear(d) AS INTEGER) AS WeekNumber,
       CAST(month(d) AS INTEGER) AS MonthNumber, monthname(d) AS MonthName,
       CAST(quarter(d) AS INTEGER) AS Quarter, CAST(year(d) AS INTEGER) AS Year,
       strftime(d, '%Y-%m') AS YearMonth, dayofweek(d) IN (0, 6) AS IsWeekend
FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM date_bounds WHERE lo IS NOT NULL) s""")

_cte("capacity", ("cln_Organisation",), """
SELECT BusinessUnitId, OrganisationId, CAST(500 + 10 * OrganisationId AS INTEGER) AS LicensedCapacity
FROM cln_Organisation""")

_cte("presence", ("fact_Attendance",), """
SELECT BusinessUnitId, OrganisationId, t, sum(sum(d)) OVER w AS n, lead(t) OVER w AS until
FROM (SELECT BusinessUnitId, OrganisationId, TimeStart AS t, 1 AS d FROM fact_Attendance WHERE TimeEnd > TimeStart
      UNION ALL SELECT BusinessUnitId, OrganisationId, TimeEnd, -1 FROM fact_Attendance WHERE TimeEnd > TimeStart) x
GROUP BY BusinessUnitId, OrganisationId, t
WINDOW w AS (PARTITION BY BusinessUnitId, OrganisationId ORDER BY t)""")

_cte("places", ("capacity",), """
SELECT BusinessUnitId, OrganisationId, CAST(LicensedCapacity // 250 AS BIGINT) AS Places FROM capacity""")
_cte("room_steps", ("presence", "places"),
     "SELECT presence.*, Places FROM presence LEFT JOIN places USING (BusinessUnitId, OrganisationId)")

_cte("orphan_enr", ("cln_Enrollment", "cln_Attendee"), """
SELECT e.EnrollmentId, e.BusinessUnitId, e.AttendeeId, e.AccountId FROM cln_Enrollment e
WHERE NOT EXISTS (SELECT 1 FROM cln_Attendee a
                  WHERE a.BusinessUnitId = e.BusinessUnitId AND a.AttendeeId = e.AttendeeId)""")

_FUNNEL = ('view', 'click', 'signup', 'purchase')
_cte("funnel_s1", (), f"SELECT user_id, min(ts) AS t FROM events WHERE event_type = '{_FUNNEL[0]}' GROUP BY user_id")
for _i, _step in enumerate(_FUNNEL[1:], start=2):
    _cte(f"funnel_s{_i}", (f"funnel_s{_i - 1}",), f"""
SELECT e.user_id, min(e.ts) AS t FROM events e JOIN funnel_s{_i - 1} p ON e.user_id = p.user_id
WHERE e.event_type = '{_step}' AND e.ts >= p.t GROUP BY e.user_id""")
_cte("funnel_counts", tuple(f"funnel_s{i}" for i in range(1, len(_FUNNEL) + 1)), " UNION ALL ".join(
    f"SELECT {i} AS StepNumber, '{s}' AS Step, (SELECT count(*) FROM funnel_s{i}) AS Users"
    for i, s in enumerate(_FUNNEL, start=1)))


def _month_bounds(as_of: str, months: int) -> tuple[str, str]:
    d = dt.date.fromisoformat(as_of).replace(day=1)

    def add(m: int) -> dt.date:
        y, mm = divmod(d.month - 1 + m, 12)
        return dt.date(d.year + y, mm + 1, 1)

    return add(1).isoformat(), add(months).isoformat()


_H1, _HN = _month_bounds('1998-06-30', 6)
_cte("outlook_months", (), f"""
SELECT CAST(unnest(generate_series(TIMESTAMP '{_H1} 00:00:00', TIMESTAMP '{_HN} 00:00:00', INTERVAL 1 MONTH)) AS DATE)
       AS MonthStart""")


def _null_profile_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS ColumnName, count(*) FILTER (WHERE {c} IS NULL) AS NullCount, "
        f"count(DISTINCT {c}) AS DistinctCount FROM {table}" for c in cols)


def _profile_keys_sql(table: str, keys: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{k}' AS KeyColumn, count(*) AS TotalRows, count(DISTINCT {k}) AS DistinctValues, "
        f"count(*) FILTER (WHERE {k} IS NULL) AS MissingValues FROM {table}" for k in keys)


_ACTIVE = (f"StartDate <= DATE '1998-06-30' AND (EndDate IS NULL OR EndDate >= DATE '1998-06-30')")
_LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_ENROLLMENT_COLUMNS = ["EnrollmentId", "BusinessUnitId", "OrganisationId", "AttendeeId", "AccountId", "SubscriptionId", "StatusId",
                       "EnrolledDate", "StartDate", "EndDate", "IsActive", "CreatedOn", "UpdatedOn"]


def _int(*cols: str) -> str:
    return ", ".join(f"TRY_CAST({c} AS INTEGER) AS {c}" for c in cols)


_cte("copied_Attendance", ("stg_Attendance",), f"""
SELECT {_int('Id', 'OrgId', 'TypeId', 'AttendeeId', 'EnrollmentId', 'ProgramId')}, CAST(Date AS VARCHAR) AS Date, {_AUDIT},
       {_time('TimeStart', 'TimeEnd')}, {_int('BookingId')} FROM stg_Attendance""")

_UNKNOWN = {"UnknownBusinessUnit": "BusinessUnitKey", "UnknownOrganisation": "OrganisationKey", "UnknownAttendee": "AttendeeKey"}


def _metrics_sql(table: str, unknown: list[str], day: str | None = None, **more: str) -> str:
    """One SELECT per metric of a model table, and for a fact whether its dates are in dim_Date."""
    each = {m: f"count(*) FILTER (WHERE {_UNKNOWN[m]} = 0)" for m in unknown} | more
    if day:
        each |= {"MissingDate": f"count(*) FILTER (WHERE {day} IS NULL)", "MinDateKey": f"min({day})", "MaxDateKey": f"max({day})"}
        if table.startswith("fact"):
            each["DatesInside"] = (f"CASE WHEN coalesce(min({day}) >= (SELECT min(DateKey) FROM dim_Date) "
                                   f"AND max({day}) <= (SELECT max(DateKey) FROM dim_Date), true) THEN 1 ELSE 0 END")
    name = table[0].upper() + table[1:]
    return " UNION ALL ".join(f"SELECT '{name}' AS TableName, '{m}' AS Metric, CAST({e} AS BIGINT) AS Value FROM {table}"
                              for m, e in each.items())


_LATTICE = ("AttendeeId", "AccountId", "BusinessUnitId", "OrganisationId")


def _dependency_sql(determinant: tuple[str, ...], dependent: str) -> str:
    """Determinant values and those with several dependents; with two columns only where neither alone determines."""
    x = ", ".join(determinant)
    new = " AND ".join(f"EXISTS (SELECT 1 FROM cln_Enrollment GROUP BY {c} HAVING count(DISTINCT {dependent}) + "
                       f"max(CASE WHEN {dependent} IS NULL THEN 1 ELSE 0 END) > 1)" for c in determinant) if len(determinant) > 1 else "true"
    return (f"SELECT '{'+'.join(determinant)}' AS Determinant, '{dependent}' AS Dependent, count(*) AS DeterminantValues, "
            f"count(*) FILTER (WHERE n > 1) AS Violations FROM (SELECT {x}, count(*) AS n FROM "
            f"(SELECT DISTINCT {x}, {dependent} FROM cln_Enrollment) d GROUP BY {x}) g HAVING {new}")


_PAIRS = [(c,) for c in _LATTICE] + [(a, b) for i, a in enumerate(_LATTICE) for b in _LATTICE[i + 1:]]
_MANIFEST = {
    "Attendance": "Id,OrgId,TypeId,AttendeeId,EnrollmentId,ProgramId,Date,IsActive,CreatedOn,UpdatedOn,TimeStart,TimeEnd,BookingId",
    "Attendee": "Id,BusinessUnitId,AccountId,EnterpriseId,GenderId,StatusId,DateOfBirth,IsActive,CreatedOn,UpdatedOn",
    "BusinessUnit": "Id,Code,Name,EnterpriseId,TypeId,IsActive,CreatedOn,UpdatedOn",
    "Enrollment": ("Id,BusinessUnitId,OrgId,AttendeeId,AccountId,SubscriptionId,StatusId,EnrolledDate,StartDate,EndDate,"
                   "IsActive,CreatedOn,UpdatedOn"),
    "HeadCount": ("Id,OrgId,TermProgramSetId,TermProductId,Description,HeadcountType,StatusId,HeadcountDateTime,TotalCount,"
                  "IsActive,CreatedOn,UpdatedOn"),
    "Org": "Id,BusinessUnitId,Code,Name,EnterpriseId,TypeId,IsActive,CreatedOn,UpdatedOn",
    "Program": "Id,ProgramCategoryId,OrgId,Code,IsActive,CreatedOn,UpdatedOn,Version,BusinessUnitId,ProgramName",
    "ProgramCategory": "Id,BusinessUnitId,Code,ProgramName,TypeId,IsActive,CreatedOn,UpdatedOn,OrgId",
    "PublicHoliday": "Id,CountryId,Date,HolidayName,Description,IsActive,CreatedOn,UpdatedOn",
}
_cte("named", (), """
SELECT k * 4 + n AS id, nation, CASE n WHEN 1 THEN substr(name, 1, 3) || substr(name, 5) WHEN 2 THEN substr(name, 1, 5) || 'z' || substr(name, 7)
       ELSE name END AS name
FROM (SELECT c_custkey AS k, CAST(c_nationkey AS BIGINT) AS nation, unnest([0, 1, 2, 3]) AS n,
             substr(translate(md5(CAST(c_custkey AS VARCHAR)), '0123456789', 'ghijklmnop'), 1, 10) AS name FROM customer) x
WHERE n = 0 OR (n = 1 AND k % 10 = 0) OR (n = 2 AND k % 15 = 0) OR (n = 3 AND k % 20 = 0)""")
_cte("near_names", ("named",), """
SELECT a.id, b.id AS other FROM named a JOIN named b ON a.nation = b.nation AND levenshtein(a.name, b.name) <= 1""")
# Three rounds of least neighbours: planted groups are chains of three links at most.
_cte("near_1", ("near_names",), "SELECT id, min(other) AS g FROM near_names GROUP BY id")
_cte("near_2", ("near_names", "near_1"), "SELECT x.id, min(g) AS g FROM near_names x JOIN near_1 y ON x.other = y.id GROUP BY x.id")
_cte("near_3", ("near_names", "near_2"), "SELECT x.id, min(g) AS g FROM near_names x JOIN near_2 y ON x.other = y.id GROUP BY x.id")

_cte("stg_ProgramCategory", (), "SELECT DISTINCT p_size FROM part")
_cte("stg_PublicHoliday", (), "SELECT DISTINCT last_day(CAST(l_shipdate AS DATE)) FROM lineitem")

_VALIDATION = " UNION ALL ".join([
    _metrics_sql("dim_BusinessUnit", [], MissingBusinessKey="count(*) FILTER (WHERE BusinessUnitId IS NULL)"),
    _metrics_sql("dim_Organisation", ["UnknownBusinessUnit"]),
    _metrics_sql("dim_Attendee", ["UnknownBusinessUnit"], MissingDateOfBirth="count(*) FILTER (WHERE DateOfBirth IS NULL)"),
    _metrics_sql("dim_Date", [], MinDateKey="min(DateKey)", MaxDateKey="max(DateKey)"),
    _metrics_sql("fact_Enrollment", list(_UNKNOWN), "EnrolledDateKey"),
    _metrics_sql("fact_Attendance", list(_UNKNOWN), "AttendanceDateKey",
                 WithoutEnrollment="count(*) FILTER (WHERE EnrollmentFactKey IS NULL)"),
    _metrics_sql("fact_Headcount", ["UnknownBusinessUnit", "UnknownOrganisation"], "HeadcountDateKey")])

FINAL: dict[str, tuple[tuple[str, ...], str]] = {
    "map_columns": ((), """
SELECT CAST(o_orderkey AS INTEGER) AS OrderId, CAST(o_custkey AS INTEGER) AS CustomerId, o_orderstatus AS OrderStatus,
       CAST(o_totalprice AS DOUBLE) AS TotalPrice, CAST(o_orderdate AS DATE) AS OrderDate, o_orderpriority AS Priority,
       CAST(o_orderkey AS VARCHAR) AS OrderText FROM orders"""),
    "copy_attendance": (("copied_Attendance",), "SELECT * FROM copied_Attendance"),
    "copy_rejected_values": (("stg_Attendee", "stg_Enrollment"), """
SELECT 'Attendee' AS TableName, concat_ws(':', CAST(Id AS VARCHAR), CAST(BusinessUnitId AS VARCHAR), CreatedOn) AS RowId,
       'DateOfBirth' AS ColumnName, DateOfBirth AS SourceText, 'not a date' AS Rule
FROM stg_Attendee WHERE DateOfBirth IS NOT NULL AND TRY_CAST(DateOfBirth AS DATE) IS NULL
UNION ALL
SELECT 'Enrollment', concat_ws(':', CAST(Id AS VARCHAR), CAST(BusinessUnitId AS VARCHAR), CAST(CreatedOn AS VARCHAR)),
       'EnrolledDate', EnrolledDate, 'not a date'
FROM stg_Enrollment WHERE EnrolledDate IS NOT NULL AND TRY_CAST(EnrolledDate AS DATE) IS NULL"""),
    "copy_accepted_values": (("stg_Attendee",), f"""
SELECT {_big('Id>AttendeeId')}, {_int('BusinessUnitId')}, {_day('DateOfBirth')},
       TRY_CAST(IsActive AS BOOLEAN) AS IsActive, {_time('CreatedOn')} FROM stg_Attendee"""),
    "copy_balanced": (("stg_Attendee",), "SELECT Id, BusinessUnitId, AccountId, CreatedOn FROM stg_Attendee"),
    "sink_append_load": (("cln_Program",),
                         "SELECT *, CAST(CASE WHEN ProgramId % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS LoadId FROM cln_Program"),
    "clean_in_loads": (("cln_Enrollment",), "SELECT * FROM cln_Enrollment"),
    "copy_manifest": (tuple(f"stg_{t}" for t in _MANIFEST), " UNION ALL ".join(
        f"SELECT '{t}' AS TableName, count(*) AS RowsCopied, count(*) AS RowsRead, '{c}' AS Columns FROM stg_{t}"
        for t, c in _MANIFEST.items())),
    "dependency_lattice": (("cln_Enrollment",), " UNION ALL ".join(
        _dependency_sql(x, a) for x in _PAIRS for a in _LATTICE if a not in x)),
    "merged_profiles": (("cln_Enrollment",), " UNION ALL ".join(
        f"SELECT '{c}' AS ColumnName, CAST(count(*) AS BIGINT) AS TotalRows, count(*) FILTER (WHERE {c} IS NULL) AS MissingValues, "
        f"true AS WithinThreePercent FROM cln_Enrollment" for c in _ENROLLMENT_COLUMNS)),
    "near_duplicate_attendees": (("near_3",), """
SELECT id AS AttendeeId, g AS GroupId, n AS GroupSize FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM near_3) x WHERE n > 1"""),
    "copy_headcount": (("stg_HeadCount",), f"""
SELECT {_int('Id', 'OrgId', 'TermProgramSetId', 'TermProductId')}, Description, HeadcountType, {_int('StatusId')},
       {_time('HeadcountDateTime')}, {_int('TotalCount')}, {_AUDIT} FROM stg_HeadCount"""),
    "copy_program": (("stg_Program",), f"""
SELECT {_int('Id', 'ProgramCategoryId', 'OrgId')}, Code, {_AUDIT}, {_int('BusinessUnitId')}, ProgramName FROM stg_Program"""),
    "copy_by_name": (("stg_Org",), "SELECT * FROM stg_Org"),
    "copy_then_clean_attendance": (("copied_Attendance",), f"""
SELECT {_big('Id>AttendanceId', 'EnrollmentId', 'OrgId>OrganisationId', 'AttendeeId', 'ProgramId', 'BookingId', 'TypeId')},
       {_day('Date>AttendanceDate')}, TimeStart, TimeEnd, IsActive, CreatedOn, UpdatedOn FROM copied_Attendance WHERE Id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY Id ORDER BY {LATEST}) = 1"""),
    "clean_business_unit": (("cln_BusinessUnit",), "SELECT * FROM cln_BusinessUnit"),
    "clean_organisation": (("cln_Organisation",), "SELECT * FROM cln_Organisation"),
    "clean_attendee": (("cln_Attendee",), "SELECT * FROM cln_Attendee"),
    "clean_enrollment": (("cln_Enrollment",), "SELECT * FROM cln_Enrollment"),
    "clean_attendance": (("cln_Attendance",), "SELECT * FROM cln_Attendance"),
    "clean_headcount": (("cln_HeadCount",), "SELECT * FROM cln_HeadCount"),
    "clean_program": (("cln_Program",), "SELECT * FROM cln_Program"),
    "valid_birth_dates": (("stg_Attendee",), f"""
SELECT Id AS AttendeeId, BusinessUnitId, DateOfBirth AS RawDateOfBirth,
       TRY_CAST(DateOfBirth AS DATE) AS ParsedDateOfBirth,
       CASE WHEN regexp_matches(CAST(TRY_CAST(DateOfBirth AS DATE) AS VARCHAR), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$')
             AND TRY_CAST(DateOfBirth AS DATE) >= DATE '1900-01-01'
             AND TRY_CAST(DateOfBirth AS DATE) <= DATE '2025-06-30'
            THEN TRY_CAST(DateOfBirth AS DATE) END AS DateOfBirth
FROM stg_Attendee"""),
    "latest_per_key": ((), """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST,
                                    l_suppkey DESC NULLS LAST) = 1"""),
    "version_history": (("conf_Enrollment",), f"""
SELECT BusinessUnitId, EnrollmentId, IsActive, CreatedOn, UpdatedOn,
       CAST(row_number() OVER w AS INTEGER) AS VersionRank,
       count(*) OVER (PARTITION BY BusinessUnitId, EnrollmentId) AS VersionCount,
       lag(UpdatedOn) OVER w AS PrevUpdatedOn, lead(UpdatedOn) OVER w AS NextUpdatedOn
FROM conf_Enrollment
WINDOW w AS (PARTITION BY BusinessUnitId, EnrollmentId ORDER BY {LATEST})"""),
    "dedup_lookup": (("enr_lookup",), "SELECT * FROM enr_lookup"),
    "surrogate_key": ((), f"SELECT {_LINE_ORDER}, row_number() OVER (ORDER BY {_LINE_ORDER}) AS LineKey FROM lineitem"),
    "date_keys": (("cln_Enrollment",), f"""
SELECT EnrollmentId, BusinessUnitId, {_dkey('EnrolledDate')} AS EnrolledDateKey,
       {_dkey('StartDate')} AS StartDateKey, {_dkey('EndDate')} AS EndDateKey FROM cln_Enrollment"""),
    "duration_minutes": (("cln_Attendance",),
                         f"SELECT t.AttendanceId, t.TimeStart, t.TimeEnd, {_MINUTES} AS AttendanceMinutes "
                         "FROM cln_Attendance t"),
    "dim_date": (("dim_Date",), "SELECT * FROM dim_Date"),
    "dim_business_unit": (("dim_BusinessUnit",), "SELECT * FROM dim_BusinessUnit"),
    "dim_organisation": (("dim_Organisation",), "SELECT * FROM dim_Organisation"),
    "dim_attendee": (("dim_Attendee",), "SELECT * FROM dim_Attendee"),
    "fact_enrollment": (("fact_Enrollment",), "SELECT * FROM fact_Enrollment"),
    "fact_attendance": (("fact_Attendance",), "SELECT * FROM fact_Attendance"),
    "fact_headcount_by_count_time": (("fact_Headcount_timed",), "SELECT * EXCLUDE (day) FROM fact_Headcount_timed"),
    "fact_attendance_colocated": (("fact_Attendance",), "SELECT * FROM fact_Attendance"),
    "scanned_row_counts": (("stg_Attendee", "stg_Enrollment", "stg_Attendance"), " UNION ALL ".join(
        f"SELECT '{t}' AS TableName, count(*) AS Rows FROM stg_{t}" for t in ("Attendee", "Enrollment", "Attendance"))),
    "validation_report": (("dim_Attendee", "fact_Enrollment", "fact_Attendance", "fact_Headcount", "dim_Date",
                           "dim_BusinessUnit", "dim_Organisation"), _VALIDATION),
    "fact_headcount": (("fact_Headcount",), "SELECT * FROM fact_Headcount"),
    "orphan_enrollments": (("orphan_enr",), "SELECT * FROM orphan_enr"),
    "orphan_attendance": (("cln_Attendance", "cln_Enrollment"), """
SELECT t.AttendanceId, t.EnrollmentId, t.AttendeeId, t.OrganisationId FROM cln_Attendance t
WHERE NOT EXISTS (SELECT 1 FROM cln_Enrollment e WHERE e.EnrollmentId = t.EnrollmentId)"""),
    "unknown_member_rows": (("fact_Enrollment",), """
SELECT EnrollmentId, BusinessUnitId, OrganisationId FROM fact_Enrollment WHERE OrganisationKey = 0"""),
    "dates_outside": (("cln_Attendance",), f"""
SELECT {_dkey('AttendanceDate')} AS DateKey, count(*) AS Rows FROM cln_Attendance
WHERE AttendanceDate < DATE '1996-01-01' OR AttendanceDate > DATE '1998-12-31' GROUP BY AttendanceDate"""),
    "duplicate_enrollment_ids": (("cln_Enrollment",), """
SELECT EnrollmentId, count(*) AS "count" FROM cln_Enrollment GROUP BY EnrollmentId HAVING count(*) > 1"""),
    "dedup_enrollment": (("cln_Enrollment",), """
SELECT EnrollmentId, BusinessUnitId, AttendeeId FROM cln_Enrollment
QUALIFY row_number() OVER (PARTITION BY EnrollmentId ORDER BY BusinessUnitId) = 1"""),
    "unmatched_parents": (("dim_Organisation",), """
SELECT OrganisationId, BusinessUnitId, OrganisationCode, OrganisationName FROM dim_Organisation
WHERE OrganisationId <> -1 AND BusinessUnitKey = 0"""),
    "missing_key_rows": (("stg_Attendee",), """
SELECT Id, BusinessUnitId, AccountId, DateOfBirth, CreatedOn FROM stg_Attendee
WHERE Id IS NULL OR BusinessUnitId IS NULL"""),
    "table_row_counts": (("dim_Attendee", "fact_Enrollment", "fact_Attendance", "fact_Headcount", "dim_Date",
                          "dim_BusinessUnit", "dim_Organisation"), " UNION ALL ".join(
        f"SELECT '{label}' AS TableName, count(*) AS Rows FROM {cte}" for label, cte in (
            ("Dim_Attendee", "dim_Attendee"), ("Fact_Enrollment", "fact_Enrollment"),
            ("Fact_Attendance", "fact_Attendance"), ("Fact_Headcount", "fact_Headcount"),
            ("Dim_Date", "dim_Date"), ("Dim_BusinessUnit", "dim_BusinessUnit"),
            ("Dim_Organisation", "dim_Organisation")))),
    "surrogate_key_integrity": (("fact_Attendance",), """
SELECT count(*) AS FinalRows, count(DISTINCT AttendanceFactKey) AS DistinctKeys,
       count(DISTINCT AttendanceId) AS DistinctBusinessKeys, min(AttendanceFactKey) AS MinKey,
       max(AttendanceFactKey) AS MaxKey FROM fact_Attendance"""),
    "profile_dim_business_unit": (("dim_BusinessUnit",), _profile_keys_sql("dim_BusinessUnit", ["BusinessUnitKey", "BusinessUnitId"])),
    "dim_duplicate_keys": (("dim_Organisation",), """
SELECT BusinessUnitId, OrganisationId, count(*) AS "count" FROM dim_Organisation
GROUP BY BusinessUnitId, OrganisationId HAVING count(*) > 1"""),
    "profile_keys": (("stg_Attendee",), _profile_keys_sql("stg_Attendee", ["Id", "BusinessUnitId"])),
    "profile_composite_key": (("dim_Organisation",), _profile_keys_sql("dim_Organisation", ["BusinessUnitId", "OrganisationId"])
                              + """ UNION ALL
SELECT 'BusinessUnitId+OrganisationId' AS KeyColumn, count(*) AS TotalRows,
       count(DISTINCT CASE WHEN BusinessUnitId IS NOT NULL AND OrganisationId IS NOT NULL
                           THEN (BusinessUnitId, OrganisationId) END) AS DistinctValues,
       count(*) FILTER (WHERE BusinessUnitId IS NULL OR OrganisationId IS NULL) AS MissingValues FROM dim_Organisation"""),
    "profile_unmatched": (("dim_Attendee",), """
SELECT count(*) AS TotalRows, count(*) FILTER (WHERE DateOfBirth IS NULL) AS MissingOrInvalidDateOfBirth,
       count(*) FILTER (WHERE BusinessUnitKey = 0) AS UnmatchedBusinessUnits FROM dim_Attendee"""),
    "null_profile": (("cln_Enrollment",), _null_profile_sql("cln_Enrollment", _ENROLLMENT_COLUMNS)),
    "value_distribution": (("stg_Attendee",),
                           'SELECT BusinessUnitId, count(*) AS "count" FROM stg_Attendee GROUP BY BusinessUnitId'),
    "duplicate_keys": (("stg_Enrollment",), """
SELECT BusinessUnitId, Id, count(*) AS "count" FROM stg_Enrollment GROUP BY BusinessUnitId, Id
HAVING count(*) > 1"""),
    "distinct_values": (("cln_Enrollment",), "SELECT DISTINCT BusinessUnitId FROM cln_Enrollment"),
    "entity_summary": (("cln_Enrollment",), """
SELECT count(DISTINCT AttendeeId) AS TotalAttendees, count(DISTINCT BusinessUnitId) AS TotalBusinessUnits,
       count(DISTINCT OrganisationId) AS TotalOrgs, count(DISTINCT AccountId) AS TotalAccounts
FROM cln_Enrollment"""),
    "dependency_violations": (("cln_Attendee",), """
SELECT AccountId, count(DISTINCT DateOfBirth) AS DistinctDateOfBirth, count(*) AS Rows FROM cln_Attendee
GROUP BY AccountId HAVING count(DISTINCT DateOfBirth) > 1"""),
    "duplicate_entities": (("cln_Attendee",), """
SELECT BusinessUnitId, GenderId, DateOfBirth, count(DISTINCT AttendeeId) AS DistinctIds,
       min(AttendeeId) AS MinAttendeeId, max(AttendeeId) AS MaxAttendeeId
FROM cln_Attendee
WHERE BusinessUnitId IS NOT NULL AND GenderId IS NOT NULL AND DateOfBirth IS NOT NULL
GROUP BY BusinessUnitId, GenderId, DateOfBirth HAVING count(DISTINCT AttendeeId) > 1"""),
    "unexpected_values": (("stg_Attendee",), """
SELECT 'GenderId' AS ColumnName, CAST(GenderId AS VARCHAR) AS Value, count(*) AS Rows FROM stg_Attendee
WHERE NOT COALESCE(GenderId IN (0, 1), false) GROUP BY CAST(GenderId AS VARCHAR)"""),
    "unexpected_range": (("stg_HeadCount",), """
SELECT 'TotalCount' AS ColumnName, CAST(TotalCount AS VARCHAR) AS Value, count(*) AS Rows FROM stg_HeadCount
WHERE NOT COALESCE(TotalCount BETWEEN 5 AND 30, false) GROUP BY TotalCount"""),
    "fanout_rows": (("cln_Organisation",), """
SELECT OrganisationId, count(*) AS Matches FROM cln_Organisation GROUP BY OrganisationId HAVING count(*) > 1"""),
    "table_roundtrip": (("cln_Enrollment",), "SELECT * FROM cln_Enrollment"),
    "sink_append": (("cln_Program",), "SELECT * FROM cln_Program UNION ALL SELECT * FROM cln_Program"),
    "sink_truncate_append": (("cln_Program",), "SELECT * FROM cln_Program WHERE ProgramId % 2 = 0"),
    "sink_overwrite_schema": (("cln_HeadCount",), "SELECT * FROM cln_HeadCount"),
    "sink_recreate": (("cln_Program",), "SELECT * FROM cln_Program"),
    "preview_rows": (("orphan_enr",), "SELECT * FROM orphan_enr ORDER BY EnrollmentId, BusinessUnitId LIMIT 50"),
    "booking_detail": (("fact_Attendance", "dim_Attendee", "cln_Program", "dim_Date"), """
SELECT f.AttendanceId, f.BookingId, f.AttendeeId, a.AccountId, f.ProgramId, p.ProgramName, f.AttendanceDate,
       d.DayName, d.YearMonth, f.TimeStart, f.TimeEnd, f.AttendanceMinutes
FROM fact_Attendance f
LEFT JOIN dim_Attendee a ON f.AttendeeKey = a.AttendeeKey
LEFT JOIN cln_Program p ON f.ProgramId = p.ProgramId
LEFT JOIN dim_Date d ON f.AttendanceDateKey = d.DateKey"""),
    "occupancy_rate": (("capacity", "fact_Enrollment"), f"""
SELECT COALESCE(c.BusinessUnitId, a.BusinessUnitId) AS BusinessUnitId, COALESCE(c.OrganisationId, a.OrganisationId) AS OrganisationId,
       c.LicensedCapacity, COALESCE(a.ActiveEnrollments, 0) AS ActiveEnrollments,
       CAST(COALESCE(a.ActiveEnrollments, 0) AS DOUBLE) * 100 / NULLIF(CAST(c.LicensedCapacity AS DOUBLE), 0)
           AS OccupancyRatePct
FROM capacity c FULL JOIN (
  SELECT BusinessUnitId, OrganisationId, count(*) AS ActiveEnrollments FROM fact_Enrollment
  WHERE {_ACTIVE} GROUP BY BusinessUnitId, OrganisationId) a
ON c.BusinessUnitId = a.BusinessUnitId AND c.OrganisationId = a.OrganisationId"""),
    "room_peaks": (("places", "room_steps"), """
SELECT BusinessUnitId, OrganisationId, Places, CAST(coalesce(top, 0) AS BIGINT) AS PeakPresent, peak_at AS PeakAt,
       CASE WHEN Places IS NOT NULL THEN CAST(floor(coalesce(over, 0) / 60) AS BIGINT) END AS MinutesOverPlaces
FROM places FULL JOIN (
  SELECT BusinessUnitId, OrganisationId, max(n) AS top, arg_min(t, (-n, t)) AS peak_at,
         sum(CASE WHEN n > Places THEN epoch(until) - epoch(t) ELSE 0 END) AS over
  FROM room_steps GROUP BY BusinessUnitId, OrganisationId) g USING (BusinessUnitId, OrganisationId)"""),
    "room_peaks_by_hour": (("presence",), """
SELECT BusinessUnitId, OrganisationId, CAST(hour(h) AS INTEGER) AS HourOfDay, CAST(max(n) AS BIGINT) AS PeakPresent
FROM (SELECT BusinessUnitId, OrganisationId, n, unnest(generate_series(date_trunc('hour', t),
        least(until - INTERVAL 1 MICROSECOND, date_trunc('hour', t) + INTERVAL 23 HOUR), INTERVAL 1 HOUR)) AS h
      FROM presence WHERE n > 0) x
GROUP BY BusinessUnitId, OrganisationId, hour(h)"""),
    "attended_use": (("capacity", "fact_Attendance"), """
SELECT COALESCE(c.BusinessUnitId, u.BusinessUnitId) AS BusinessUnitId, COALESCE(c.OrganisationId, u.OrganisationId) AS OrganisationId,
       c.LicensedCapacity, COALESCE(u.days, 0) AS DaysAttended, COALESCE(u.peak, 0) AS PeakAttendees,
       CAST(u.total AS DOUBLE) / CAST(u.days AS DOUBLE) AS MeanAttendees,
       CAST(COALESCE(u.peak, 0) AS DOUBLE) * 100 / CAST(c.LicensedCapacity AS DOUBLE) AS PeakUsePct,
       CAST(u.total AS DOUBLE) / CAST(u.days AS DOUBLE) * 100 / CAST(c.LicensedCapacity AS DOUBLE) AS MeanUsePct
FROM capacity c FULL JOIN (
  SELECT BusinessUnitId, OrganisationId, count(*) AS days, max(n) AS peak, sum(n) AS total FROM (
    SELECT BusinessUnitId, OrganisationId, AttendanceDate, count(DISTINCT AttendeeId) AS n FROM fact_Attendance
    WHERE AttendanceDate IS NOT NULL GROUP BY ALL) d GROUP BY ALL) u
ON c.BusinessUnitId = u.BusinessUnitId AND c.OrganisationId = u.OrganisationId"""),
    "attendance_behaviour": (("fact_Attendance",), """
SELECT OrganisationId, CAST(dayofweek(AttendanceDate) + 1 AS INTEGER) AS DayOfWeek, dayname(AttendanceDate) AS DayName,
       count(*) AS Visits, count(DISTINCT AttendeeId) AS Attendees,
       CAST(sum(AttendanceMinutes) AS BIGINT) AS TotalMinutes,
       CAST(sum(AttendanceMinutes) AS DOUBLE) / NULLIF(CAST(count(AttendanceMinutes) AS DOUBLE), 0) AS AvgMinutes
FROM fact_Attendance GROUP BY 1, 2, 3"""),
    "peak_program_fill": (("fact_Attendance",), """
SELECT ProgramId, AttendanceDate AS PeakDate, Visits AS PeakVisits FROM (
  SELECT ProgramId, AttendanceDate, count(*) AS Visits FROM fact_Attendance WHERE AttendanceDate IS NOT NULL
  GROUP BY ProgramId, AttendanceDate) s
QUALIFY row_number() OVER (PARTITION BY ProgramId ORDER BY Visits DESC, AttendanceDate ASC) = 1"""),
    "max_capacity": (("capacity",), """
SELECT BusinessUnitId, max(LicensedCapacity) AS MaxCapacity, count(LicensedCapacity) AS Organisations
FROM capacity GROUP BY BusinessUnitId"""),
    "max_room_headcount": (("fact_Headcount",), """
SELECT OrganisationId, max(TotalCount) AS MaxRoomCount, count(DISTINCT HeadcountId) AS Rooms
FROM fact_Headcount WHERE HeadcountType = 'Room' GROUP BY OrganisationId"""),
    "new_enrollments_monthly": (("fact_Enrollment",), """
SELECT strftime(m, '%Y-%m') AS YearMonth, n AS NewEnrollments, before AS PreviousEnrollments, n - before AS ChangeFromPrevious FROM (
  SELECT m, n, lag(n) OVER (ORDER BY m) AS before FROM (
    SELECT s.m, (SELECT count(*) FROM fact_Enrollment e WHERE date_trunc('month', e.EnrolledDate) = s.m) AS n
    FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(EnrolledDate)) AS TIMESTAMP),
                                             CAST(date_trunc('month', max(EnrolledDate)) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m
          FROM fact_Enrollment) s) c) l
UNION ALL SELECT NULL, count(*), NULL, NULL FROM fact_Enrollment WHERE EnrolledDate IS NULL HAVING count(*) > 0"""),
    "occupancy_outlook": (("fact_Enrollment", "outlook_months"), """
SELECT o.BusinessUnitId, o.OrganisationId, m.MonthStart, CAST((
  SELECT count(*) FROM fact_Enrollment e
  WHERE e.BusinessUnitId = o.BusinessUnitId AND e.OrganisationId IS NOT DISTINCT FROM o.OrganisationId
    AND e.StartDate <= last_day(m.MonthStart) AND (e.EndDate IS NULL OR e.EndDate >= m.MonthStart)) AS BIGINT) AS ExpectedEnrollments
FROM (SELECT DISTINCT BusinessUnitId, OrganisationId FROM fact_Enrollment) o, outlook_months m"""),
    "funnel_conversion": (("funnel_counts",), """
SELECT StepNumber, Step, Users,
       CAST(Users AS DOUBLE) / NULLIF(CAST(lag(Users) OVER (ORDER BY StepNumber) AS DOUBLE), 0) AS ConversionFromPrevious,
       CAST(Users AS DOUBLE) / NULLIF(CAST(first_value(Users) OVER (ORDER BY StepNumber) AS DOUBLE), 0)
           AS ConversionFromFirst
FROM funnel_counts"""),
}


def _order(deps: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for d in deps:
        visit(d)
    return seen


def sql_for(name: str) -> str:
    deps, final = FINAL[name]
    names = _order(deps)
    if not names:
        return final.strip()
    withs = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in names)
    return f"WITH {withs}\n{final.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: sql_for(name) for name in FINAL}
