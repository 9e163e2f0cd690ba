"""Cleaned tables: conform -> (date plausibility) -> latest record per key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starpipe import contracts as C
from starpipe.functions.scalar import DATE_LOWER_BOUND, valid_date
from starpipe.operators.conform import conform
from starpipe.operators.dedup import LATEST_ORDER, latest_in_order, latest_per_key


def clean_table(stg: DataFrame, contract: C.Contract, order=LATEST_ORDER) -> DataFrame:
    return latest_per_key(conform(stg, contract), contract.business_key, order)


def clean_business_unit(stg: DataFrame) -> DataFrame:
    return clean_table(stg, C.BUSINESS_UNIT)


def clean_organisation(stg: DataFrame) -> DataFrame:
    return clean_table(stg, C.ORGANISATION)


def attendee_source(stg: DataFrame, as_of=None, lower=DATE_LOWER_BOUND) -> DataFrame:
    """Conformed attendees with an implausible date of birth blanked (row kept)."""
    return (conform(stg, C.ATTENDEE)
            .withColumn("DateOfBirth", valid_date("RawDateOfBirth", lower=lower, as_of=as_of))
            .drop("RawDateOfBirth"))


def clean_attendee(stg: DataFrame, as_of=None, lower=DATE_LOWER_BOUND) -> DataFrame:
    return latest_per_key(attendee_source(stg, as_of, lower), C.ATTENDEE.business_key)


def clean_enrollment(stg: DataFrame) -> DataFrame:
    return clean_table(stg, C.ENROLLMENT)


def clean_in_key_order(stg: DataFrame, contract: C.Contract, order=LATEST_ORDER) -> DataFrame:
    """``clean_table`` in the order of the business key, with each row's place (``latest_in_order``)."""
    return latest_in_order(conform(stg, contract), contract.business_key, order)


def clean_attendance(stg: DataFrame) -> DataFrame:
    return clean_table(stg, C.ATTENDANCE)


def clean_headcount(stg: DataFrame, keep_time: bool = False) -> DataFrame:
    """``keep_time`` keeps the time of the count beside the contract's columns."""
    # Ranked, not first de-duplicated: dropping duplicates before ranking
    # would pick an arbitrary version and make the ranking a no-op.
    return clean_table(stg, C.HEADCOUNT_TIMED if keep_time else C.HEADCOUNT)


def clean_program(stg: DataFrame) -> DataFrame:
    return clean_table(stg, C.PROGRAM)
