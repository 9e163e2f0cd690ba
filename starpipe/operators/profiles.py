"""Column profiles that can be stored per load and merged, and which dependencies hold."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starpipe.sources.io import materialize


def profile_sketches(df: DataFrame, columns: Sequence[str] | None = None, lg_k: int = 14) -> DataFrame:
    """(ColumnName, Rows, Missing, Sketch) per column of one load, from one pass.

    ``Sketch`` is a HyperLogLog sketch of the column's values (2**lg_k
    registers: a few kilobytes whatever the load's size; standard error about
    0.83 / sqrt(2**lg_k), 0.65 % for 14). Store it with the load: merging the
    loads' sketches gives the sketch of all rows together, so a profile of
    the whole table never needs the earlier loads again.
    """
    columns = list(df.columns if columns is None else columns)
    sums = df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)],
                  *[F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"s{i}") for i, c in enumerate(columns)])
    each = F.array(*[F.struct(F.lit(c).alias("ColumnName"), F.col("rows").alias("Rows"), F.col(f"m{i}").alias("Missing"),
                              F.col(f"s{i}").alias("Sketch")) for i, c in enumerate(columns)])
    return sums.select(F.explode(each).alias("p")).select("p.*")


def merge_profiles(sketches: DataFrame) -> DataFrame:
    """(ColumnName, TotalRows, MissingValues, DistinctEstimate) over all loads of ``profile_sketches``."""
    return sketches.groupBy("ColumnName").agg(
        F.sum("Rows").alias("TotalRows"), F.sum("Missing").alias("MissingValues"),
        F.hll_sketch_estimate(F.hll_union_agg("Sketch")).alias("DistinctEstimate"))


def _violations(base: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    """One row: how many values the determinant has, and how many of them have several dependents."""
    per_value = base.select(*determinant, dependent).distinct().groupBy(*determinant).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(F.count(F.lit(1)).alias("DeterminantValues"), F.count_if(F.col("n") > 1).alias("Violations")).select(
        F.lit("+".join(determinant)).alias("Determinant"), F.lit(dependent).alias("Dependent"), "DeterminantValues", "Violations")


def dependency_lattice(df: DataFrame, columns: Sequence[str], max_determinant: int = 2) -> DataFrame:
    """Which columns determine which: (Determinant, Dependent, DeterminantValues, Violations).

    A dependency holds where no value of the determinant has two dependents
    (``Violations`` 0; NULL is a value). Determinants are searched by size.
    One whose part already determines the dependent is left out: it holds
    as well and says nothing new. The rows' distinct tuples are written
    once; every level reads that table, and the distinct tuples of a level are taken
    from those of the columns needed alone, so cost follows the distinct values, not the rows.
    """
    base = materialize(df.select(*columns).distinct(), "tuples")
    holds: set[tuple[frozenset[str], str]] = set()
    out = None
    for size in range(1, max_determinant + 1):
        todo = [(x, a) for x in combinations(columns, size) for a in columns if a not in x
                and not any((frozenset(y), a) in holds for n in range(1, size) for y in combinations(x, n))]
        if not todo:
            break
        level = materialize(reduce(DataFrame.unionByName, [_violations(base, x, a) for x, a in todo]), "dependencies")
        holds |= {(frozenset(r["Determinant"].split("+")), r["Dependent"])
                  for r in level.where("Violations = 0").select("Determinant", "Dependent").collect()}   # columns, not rows
        out = level if out is None else out.unionByName(level)
    return out
