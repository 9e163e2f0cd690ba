"""Dense surrogate keys without a single-partition window.

``row_number().over(Window.orderBy(...))`` - the obvious way to number rows
1..N - plans as ``Exchange SinglePartition``: every row of a fact table goes
through one task. ``add_key`` gives the same numbers with the work spread,
by one plan at every size:

1. The rows are range-partitioned by the order columns, sorted inside each
   partition, and tagged with partition number and place
   (``monotonically_increasing_id``). The range is over all order columns
   (and a hash of the whole row unless the order is declared unique), so a
   leading column with few distinct values, or one value holding a third of
   the rows, still splits.
2. They are written once to the shared scratch folder. That fixes the
   numbering: whatever is recomputed later reads the same places.
3. The rows of each partition are counted from what was written; running
   sums give each partition its offset. That table has one row per
   partition. It is written too, so its join with the rows is planned from
   its real size.

The numbers equal the global ``row_number`` whenever the order is total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starpipe.operators.ordering import OrderItem, sort_columns
from starpipe.sources.io import materialize

_PLACE_BITS = 33   # monotonically_increasing_id: partition number above, place below
PLACES = ("_part", "_row")


def with_places(df: DataFrame) -> DataFrame:
    """``df`` plus ``_part`` and ``_row``: its partition's number and the place in the partition, from 0."""
    at = F.col("_at")
    return (df.select(*df.columns, F.monotonically_increasing_id().alias("_at"))
            .select(*df.columns, F.shiftright(at, _PLACE_BITS).alias("_part"),
                    at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_row")))


def range_layout(df: DataFrame, order: Sequence[OrderItem], *, unique: bool = False,
                 partitions: int | None = None) -> DataFrame:
    """``df`` written in ``order``, plus ``_part`` and ``_row``.

    Every row of a part sorts before every row of the next one; ``_row`` is
    the place in the part, from 0. ``df`` is evaluated twice: for Spark's
    range sample and for the write. ``partitions`` fixes the number of
    parts; by default it is the session's shuffle partitions, which adaptive
    execution coalesces for small inputs.
    """
    cols = sort_columns(order)
    if not unique:
        cols.append(F.xxhash64(*[F.col(c) for c in df.columns]).asc())
    spread = df.repartitionByRange(*cols) if partitions is None else df.repartitionByRange(partitions, *cols)
    return materialize(with_places(spread.sortWithinPartitions(*cols)), "ranged")


def add_key(df: DataFrame, key_name: str, order: Sequence[OrderItem], *,
            unique: bool = False, partitions: int | None = None) -> DataFrame:
    """Append ``key_name`` = 1..N (long) in ``order`` (nulls last), distributed.

    ``unique=True`` declares the order columns unique (a business key after
    cleaning) and skips the whole-row hash tie-breaker. Writes the rows and
    the partition offsets when called; the result reads them lazily.
    """
    return number_layout(range_layout(df, order, unique=unique, partitions=partitions), key_name)


def number_layout(rows: DataFrame, key_name: str) -> DataFrame:
    """The second half of ``add_key``, for rows that are already written in the key's order
    with ``_part`` and ``_row`` (``range_layout``, ``dedup.latest_in_order``)."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)   # one row per part
    offsets = materialize(
        rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")), "offsets")
    return rows.join(offsets, "_part").select(
        *[c for c in rows.columns if c not in PLACES], (F.col("_before") + F.col("_row") + 1).cast("long").alias(key_name))


def add_key_single_partition(df: DataFrame, key_name: str, order: Sequence[OrderItem]) -> DataFrame:
    """The textbook form (one global window). Test oracle and benchmark baseline only."""
    w = Window.orderBy(*sort_columns(order))
    return df.withColumn(key_name, F.row_number().over(w).cast("long"))
