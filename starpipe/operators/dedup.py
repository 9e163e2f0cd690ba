"""Latest record per business key, explicit-order dedup, version history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starpipe.operators.ordering import OrderItem, sort_columns

# Preference among versions of one business key: the active record, then
# the latest update, then the latest creation; NULLs lose in each.
LATEST_ORDER: tuple[OrderItem, ...] = (
    ("IsActive", "desc"),
    ("UpdatedOn", "desc"),
    ("CreatedOn", "desc"),
)


def latest_per_key(df: DataFrame, keys: Sequence[str],
                   order: Sequence[OrderItem] = LATEST_ORDER,
                   deterministic: bool = True) -> DataFrame:
    """Keep row 1 of each business key under ``order`` (nulls last).

    Plans as Exchange(hash keys) + Sort + Window with a ``WindowGroupLimit``
    on *both* sides of the exchange: each map task already keeps only its
    best row per key, so a key holding a third of all rows ships one row per
    map task, not a third of the table, to a single reducer.

    Rows that tie under ``order`` are ranked by a hash of the whole row
    (``deterministic``), so the winner does not depend on the order rows
    arrive in - a recomputed task after an executor loss picks the same row.
    """
    cols = sort_columns(order)
    if deterministic:
        cols.append(F.xxhash64(*[F.col(c) for c in df.columns]).asc())
    w = Window.partitionBy(*keys).orderBy(*cols)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def latest_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem] = LATEST_ORDER) -> DataFrame:
    """``latest_per_key`` in the order of ``keys``, plus ``_part`` and ``_row``: to be written, then numbered.

    The versions are range-partitioned by the business key, which is all that the
    window asks for: rows that get a key (``keys.number_layout``) are shuffled once,
    not once for their latest version and again for their place. All versions of one
    key meet in one task, which reads them as a sorted stream; a key with a large
    share of all rows is better served by ``latest_per_key`` and ``add_key``.
    No column of ``keys`` may hold a NULL: the order is the window's own, so the
    rows are sorted once.
    """
    from starpipe.operators.keys import with_places

    cols = [F.col(k).asc() for k in keys]
    return with_places(latest_per_key(df.repartitionByRange(*cols), keys, order).sortWithinPartitions(*cols))


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem]) -> DataFrame:
    """``dropDuplicates(keys)`` with a declared winner instead of an arbitrary one."""
    return latest_per_key(df, keys, order)


def version_history(df: DataFrame, keys: Sequence[str],
                    order: Sequence[OrderItem] = LATEST_ORDER,
                    value: str = "UpdatedOn", partitions: int | None = None) -> DataFrame:
    """Rank every version of a business key and link it to its neighbours.

    Adds ``VersionRank`` (1 = the record ``latest_per_key`` keeps),
    ``VersionCount``, ``Prev<value>`` (the version ranked just before) and
    ``Next<value>`` (just after).

    Not a window over the key, which would put all versions of a hot key in
    one task. The rows are laid out by (keys, order) as ``add_key`` does, so
    a hot key lies in several parts one after another, and every window runs
    inside a part. Only a part's first and last key can go on in another
    part. What they need from there - rows before, rows after, the
    neighbouring version - comes from a written table of one row per part.
    """
    from starpipe.operators.keys import range_layout
    from starpipe.sources.io import materialize

    rows = range_layout(df, [*keys, *order], partitions=partitions)
    key = F.struct(*keys)
    # Runs of one key in one part, then each part's first and last run.
    runs = rows.groupBy("_part", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("_row").alias("lo"), F.max("_row").alias("hi"),
        F.min_by(value, "_row").alias("first"), F.max_by(value, "_row").alias("last"))
    parts = runs.groupBy("_part").agg(
        F.min_by(F.struct(key.alias("k"), "n", F.col("first").alias("v")), "lo").alias("head"),
        F.max_by(F.struct(key.alias("k"), "n", F.col("last").alias("v")), "hi").alias("tail"))
    ends = parts.select("_part", "head", "tail", F.explode(F.array(F.lit("head"), F.lit("tail"))).alias("end")).select(
        "_part", "end", F.when(F.col("end") == "head", F.col("head.k")).otherwise(F.col("tail.k")).alias("k"),
        F.when(F.col("end") == "head", F.col("head.n")).otherwise(0).alias("heads"),
        F.when(F.col("end") == "tail", F.col("tail.n")).otherwise(0).alias("tails"))
    along = Window.partitionBy("k").orderBy("_part")
    across = ends.select(
        "_part", "end",
        F.sum("tails").over(along.rangeBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.sum("heads").over(along.rangeBetween(1, Window.unboundedFollowing)).alias("after"),
    ).groupBy("_part").agg(
        F.coalesce(F.max(F.when(F.col("end") == "head", F.col("before"))), F.lit(0)).alias("_before"),
        F.coalesce(F.max(F.when(F.col("end") == "tail", F.col("after"))), F.lit(0)).alias("_after"))
    in_order = Window.orderBy("_part")   # one row per part
    edges = materialize(
        parts.join(across, "_part").select(
            "_part", "_before", "_after", F.col("head.k").alias("_headKey"), F.col("tail.k").alias("_tailKey"),
            F.lag("tail").over(in_order).alias("_prev"), F.lead("head").over(in_order).alias("_next")), "edges")

    frame = rows.join(edges, "_part").repartition("_part")
    w = Window.partitionBy("_part", *keys).orderBy("_row")
    frame = (frame
             .withColumn("_r", F.row_number().over(w))
             .withColumn("_n", F.count(F.lit(1)).over(
                 w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
             .withColumn("_lag", F.lag(value).over(w))
             .withColumn("_lead", F.lead(value).over(w)))
    before = F.when(key.eqNullSafe(F.col("_headKey")), F.col("_before")).otherwise(0)
    after = F.when(key.eqNullSafe(F.col("_tailKey")), F.col("_after")).otherwise(0)
    return frame.select(
        *df.columns,
        (F.col("_r") + before).cast("int").alias("VersionRank"),
        (F.col("_n") + before + after).cast("long").alias("VersionCount"),
        F.when(F.col("_r") > 1, F.col("_lag"))
         .when(key.eqNullSafe(F.col("_prev.k")), F.col("_prev.v")).alias(f"Prev{value}"),
        F.when(F.col("_r") < F.col("_n"), F.col("_lead"))
         .when(key.eqNullSafe(F.col("_next.k")), F.col("_next.v")).alias(f"Next{value}"),
    )
