"""Scalar column helpers.

Spark 4 runs with ANSI mode on, where a plain ``cast('x' as bigint)`` or
``to_date('31/12/2020')`` raises. Raw operational data is dirty, and the
pipeline later *counts* missing or invalid values, so every conversion here
is the ``try_`` form: an unparsable value becomes NULL, the row is kept.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPARK_TYPES = {
    "long": "bigint",
    "bigint": "bigint",
    "int": "int",
    "integer": "int",
    "string": "string",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "double": "double",
    "binary": "binary",
}


def spark_type(dtype: str) -> str:
    return _SPARK_TYPES.get(dtype, dtype)


_DATETIME = ("date", "timestamp_ntz", "timestamp")


def safe_cast(col: Column | str, dtype: str, source_type: str | None = None) -> Column:
    """Cast that yields NULL instead of failing.

    Text is parsed (a value that does not parse becomes NULL); a column that
    already has the target type passes through untouched, and a typed
    date/timestamp converts directly - no round trip through text, whose
    result would be the same. Timestamps are zone-less (TIMESTAMP_NTZ):
    operational wall-clock times must not shift with the session zone.
    ``source_type`` is the input's ``simpleString()`` type when known.
    """
    c = F.col(col) if isinstance(col, str) else col
    t = spark_type(dtype)
    if source_type == t:
        return c
    if t in ("date", "timestamp_ntz"):
        if source_type in _DATETIME:
            return c.cast(t)
        return c.cast("string").try_cast(t)
    return c.try_cast(t)


def date_key(col: Column | str) -> Column:
    """``yyyyMMdd`` integer key of a date (NULL date -> NULL key)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyyMMdd").cast("int")


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from start to end.

    NULL when a bound is missing or the end precedes the start. Seconds are
    whole (fractions dropped before the difference), the quotient truncated.
    """
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    ok = s.isNotNull() & e.isNotNull() & (e >= s)
    return F.when(ok, (F.unix_timestamp(e) - F.unix_timestamp(s)) / 60).cast("int")


# --- fixed values: lower bound and text pattern of a plausible date.
DATE_LOWER_BOUND = "1900-01-01"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def _as_date_col(v) -> Column:
    if v is None:
        return F.current_date()
    if isinstance(v, Column):
        return v
    if isinstance(v, (_dt.date, _dt.datetime)):
        v = v.isoformat()[:10]
    return F.lit(v).cast("date")


def valid_date(col: Column | str, lower=DATE_LOWER_BOUND, as_of=None,
               raw: Column | str | None = None) -> Column:
    """Keep a date only when it is plausible, else NULL (the row is kept).

    Plausible: text matches ``yyyy-MM-dd``, on or after ``lower`` and on or
    before ``as_of`` (default: today). By default the pattern is checked on
    the parsed date's canonical text, so in effect only the range applies;
    pass ``raw`` (the original text) for a strict check of how it was written.
    """
    d = F.col(col) if isinstance(col, str) else col
    text = d.cast("string") if raw is None else (F.col(raw) if isinstance(raw, str) else raw).cast("string")
    cond = text.rlike(DATE_PATTERN) & (d >= _as_date_col(lower)) & (d <= _as_date_col(as_of))
    return F.when(cond, d).otherwise(F.lit(None).cast("date"))
