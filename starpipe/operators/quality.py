"""Data-quality reports, each returned as a DataFrame (never printed).

Every report is one aggregation plan: partial aggregates are combined
map-side before the shuffle, so a hot key costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.operators.lookup import orphans  # noqa: F401  (re-exported)


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(TableName, Rows) for each named frame, as one union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("Rows"))
               .select(F.lit(name).alias("TableName"), "Rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _distinct_counts(df: DataFrame, groups: Mapping[str, Sequence[str]], approx: bool) -> DataFrame:
    """(Name, DistinctCount) per named column group: distinct values, or tuples, without a NULL.

    Exact counts are one column-pruned ``distinct`` each, joined by union:
    several distinct counts in one aggregate would copy every row once a
    count. ``df`` is read once per group, so it should be a saved table.
    """
    parts = []
    for name, cols in groups.items():
        if approx:
            one = df.agg(F.approx_count_distinct(F.when(_all_present(cols), F.struct(*cols))).alias("DistinctCount"))
        else:
            one = df.select(*cols).where(_all_present(cols)).distinct().agg(F.count(F.lit(1)).alias("DistinctCount"))
        parts.append(one.select(F.lit(name).alias("Name"), "DistinctCount"))
    return reduce(DataFrame.unionByName, parts)


def _all_present(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def profile_keys(df: DataFrame, keys: Sequence[str], approx: bool = False, composite: bool = False) -> DataFrame:
    """One row per key column: (KeyColumn, TotalRows, DistinctValues, MissingValues).

    ``composite`` adds a row for the tuple of all keys, named ``a+b``: its
    distinct values are tuples without a NULL, its missing ones have any.
    """
    groups = {k: [k] for k in keys} | ({"+".join(keys): list(keys)} if composite else {})
    counts = df.agg(F.count(F.lit(1)).alias("TotalRows"),
                    *[F.count_if(~_all_present(cols)).alias(f"_m{i}") for i, cols in enumerate(groups.values())])
    args = ", ".join(f"'{name}', _m{i}" for i, name in enumerate(groups))
    missing = counts.selectExpr("TotalRows", f"stack({len(groups)}, {args}) as (KeyColumn, MissingValues)")
    distinct = _distinct_counts(df, groups, approx)
    return missing.join(distinct, missing.KeyColumn == distinct.Name).select(
        "KeyColumn", "TotalRows", F.col("DistinctCount").alias("DistinctValues"), "MissingValues")


def count_where(df: DataFrame, conditions: Mapping[str, Column], total: str | None = "TotalRows") -> DataFrame:
    """One row: optional total count plus a conditional count per named condition."""
    aggs = [F.count(F.lit(1)).alias(total)] if total else []
    aggs += [F.count_if(cond).alias(name) for name, cond in conditions.items()]
    return df.agg(*aggs)


def value_distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per distinct value combination (NULL is a value here)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business keys held by more than one row, with their row count."""
    return value_distribution(df, keys).filter(F.col("count") > 1)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def entity_summary(df: DataFrame, columns: Mapping[str, str], approx: bool = False) -> DataFrame:
    """One row of distinct counts, e.g. {"TotalAttendees": "AttendeeId"}; ``df`` should be a saved table."""
    each = _distinct_counts(df, {name: [c] for name, c in columns.items()}, approx)
    return each.agg(*[F.max(F.when(F.col("Name") == name, F.col("DistinctCount"))).alias(name) for name in columns])


def dependency_violations(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    """Determinant values mapped to more than one distinct dependent value.

    E.g. one AccountId with several dates of birth. NULL dependents are not
    values. Output: determinant columns, ``Distinct<dependent>``, ``Rows``.
    """
    return (df.groupBy(*determinant)
              .agg(F.count_distinct(dependent).alias(f"Distinct{dependent}"),
                   F.count(F.lit(1)).alias("Rows"))
              .filter(F.col(f"Distinct{dependent}") > 1))


def duplicate_entities(df: DataFrame, attributes: Sequence[str], id_col: str) -> DataFrame:
    """Identical attribute values carried by more than one id (exact match).

    Rows with a NULL attribute are left out: a missing value is no evidence
    that two records are the same entity.
    """
    cond = reduce(lambda a, b: a & b, [F.col(a).isNotNull() for a in attributes])
    return (df.filter(cond)
              .groupBy(*attributes)
              .agg(F.count_distinct(id_col).alias("DistinctIds"),
                   F.min(id_col).alias(f"Min{id_col}"),
                   F.max(id_col).alias(f"Max{id_col}"))
              .filter(F.col("DistinctIds") > 1))


def null_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """(ColumnName, NullCount, DistinctCount) for every column; ``df`` should be a saved table."""
    return profile_keys(df, df.columns, approx).select(
        F.col("KeyColumn").alias("ColumnName"), F.col("MissingValues").alias("NullCount"),
        F.col("DistinctValues").alias("DistinctCount"))


def unexpected_values(df: DataFrame, col: str, allowed: Sequence | None = None,
                      lower=None, upper=None) -> DataFrame:
    """Values outside a declared set and/or range: (ColumnName, Value, Rows).

    NULL is reported as unexpected too (Value NULL).
    """
    c = F.col(col)
    ok = F.lit(True)
    if allowed is not None:
        ok = ok & c.isin(list(allowed))
    if lower is not None:
        ok = ok & (c >= F.lit(lower))
    if upper is not None:
        ok = ok & (c <= F.lit(upper))
    bad = df.filter(~F.coalesce(ok, F.lit(False)))
    return (bad.groupBy(c.cast("string").alias("Value"))
               .agg(F.count(F.lit(1)).alias("Rows"))
               .select(F.lit(col).alias("ColumnName"), "Value", "Rows"))


def missing_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows where any of ``keys`` is NULL."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def unknown_member_rows(df: DataFrame, key: str, unknown: int = 0) -> DataFrame:
    """Rows whose surrogate key fell back to the unknown member."""
    return df.filter(F.col(key) == unknown)


def unmatched_parents(dim: DataFrame, id_col: str, key_col: str, sentinel: int = -1,
                      unknown: int = 0) -> DataFrame:
    """Dimension rows whose parent key is unknown, excluding a sentinel member."""
    return dim.filter((F.col(id_col) != sentinel) & (F.col(key_col) == unknown))


def key_integrity(df: DataFrame, key: str, business_key: Sequence[str]) -> DataFrame:
    """One row: FinalRows, DistinctKeys and DistinctBusinessKeys, which should
    be equal, and the smallest and largest key, which should be 1 and N."""
    plain = (df.agg(F.count(F.lit(1)).alias("n"), F.min(key).cast("long").alias("lo"), F.max(key).cast("long").alias("hi"))
             .selectExpr("stack(3, 'FinalRows', n, 'MinKey', lo, 'MaxKey', hi) as (Name, DistinctCount)"))
    rows = plain.unionByName(_distinct_counts(
        df, {"DistinctKeys": [key], "DistinctBusinessKeys": list(business_key)}, approx=False))
    names = ("FinalRows", "DistinctKeys", "DistinctBusinessKeys", "MinKey", "MaxKey")
    return rows.agg(*[F.max(F.when(F.col("Name") == n, F.col("DistinctCount"))).alias(n) for n in names])


def dates_outside(fact: DataFrame, date_key_col: str, dim_date: DataFrame) -> DataFrame:
    """(DateKey, Rows): fact date keys that the date dimension does not have."""
    days = dim_date.select(F.col("DateKey").alias("_dk"))
    used = fact.where(F.col(date_key_col).isNotNull()).groupBy(F.col(date_key_col).alias("DateKey")).agg(
        F.count(F.lit(1)).alias("Rows"))
    return used.join(days, used.DateKey == F.col("_dk"), "left_anti")
