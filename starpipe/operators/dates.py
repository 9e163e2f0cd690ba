"""Date spine and the date dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.functions.scalar import date_key

# --- fixed values: the calendar span of the reference's date dimension.
DEFAULT_START = "2000-01-01"
DEFAULT_END = "2035-12-31"


def date_spine(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """One row per day, ``FullDate`` from start to end inclusive."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias("FullDate"))


def date_spine_covering(frames: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Day spine from the earliest to the latest date found in the given columns.

    Each frame contributes one (min, max) row - a global aggregate combined
    map-side - and the union of those few rows is exploded into days. The
    spine's size is the calendar span, not the row count.
    """
    parts = []
    for df, cols in frames:
        lows = [F.min(c) for c in cols]
        highs = [F.max(c) for c in cols]
        parts.append(df.agg((F.least(*lows) if len(lows) > 1 else lows[0]).alias("lo"),
                            (F.greatest(*highs) if len(highs) > 1 else highs[0]).alias("hi")))
    bounds = parts[0]
    for p in parts[1:]:
        bounds = bounds.unionByName(p)
    return (bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
                  .filter(F.col("lo").isNotNull())
                  .select(F.explode(F.sequence(F.col("lo").cast("date"), F.col("hi").cast("date"),
                                               F.expr("INTERVAL 1 DAY"))).alias("FullDate")))


# --- fixed values: names and patterns of the date dimension's columns.
def dim_date(spine: DataFrame) -> DataFrame:
    """The 11-column date dimension over a ``FullDate`` spine.

    Names come from ``date_format`` (English, locale-independent in Spark);
    the weekend flag is computed from the day number, not from names.
    """
    d = F.col("FullDate")
    return spine.select(
        date_key(d).alias("DateKey"),
        d.alias("FullDate"),
        F.dayofmonth(d).alias("DayNumber"),
        F.date_format(d, "EEEE").alias("DayName"),
        F.weekofyear(d).alias("WeekNumber"),
        F.month(d).alias("MonthNumber"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.quarter(d).alias("Quarter"),
        F.year(d).alias("Year"),
        F.date_format(d, "yyyy-MM").alias("YearMonth"),
        F.dayofweek(d).isin(1, 7).alias("IsWeekend"),
    )
