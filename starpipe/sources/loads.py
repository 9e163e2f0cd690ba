"""Loads that can be repeated: replaceable appends, merged loads, balanced copies.

All three write only the partitions that a load touches
(``partitionOverwriteMode=dynamic``): files of the others stay as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.operators.dedup import LATEST_ORDER, latest_per_key
from starpipe.operators.ordering import OrderItem
from starpipe.sources.io import materialize, save_table


@contextmanager
def _only_touched_partitions(spark: SparkSession) -> Iterator[None]:
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_load(df: DataFrame, name: str, load_id: str | int, load_col: str = "LoadId", path: str | None = None) -> int:
    """Append ``df`` to table ``name`` as load ``load_id`` and return the rows written.

    The load is a partition of the table. Running the same load again
    replaces that partition, so a rerun adds nothing; Spark writes the new
    files aside and puts them in place when the whole write has succeeded. A rerun
    with fewer rows leaves none of the old ones, one without rows leaves the load as it is.
    """
    if load_col in df.columns:
        raise ValueError(f"the rows have a column {load_col} already")
    with _only_touched_partitions(df.sparkSession):
        return save_table(df.withColumn(load_col, F.lit(load_id)), name, mode="replace_partitions",
                          partition_by=[load_col], path=path)


def merge_latest(new: DataFrame, name: str, keys: Sequence[str], order: Sequence[OrderItem] = LATEST_ORDER,
                 buckets: int = 64, path: str | None = None) -> int:
    """Merge conformed rows into a cleaned table: the latest record per key of what the
    table holds and what is new. Returns the rows written.

    The table is partitioned by a hash of the business key (``_bucket``).
    Only partitions that hold a key of the load are read and rewritten. As
    the winner among old and new versions is the winner of the old
    winner and the new versions, loads in any order give the rows of one run over all of them.
    ``buckets`` is fixed by the first load: choose it so that a partition is a few tasks' work.
    """
    spark = new.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    staged = materialize(new.withColumn("_bucket", bucket), "load")
    rows = staged
    if spark.catalog.tableExists(name):
        touched = [r["_bucket"] for r in staged.select("_bucket").distinct().collect()]   # at most ``buckets``
        rows = spark.table(name).where(F.col("_bucket").isin(touched)).unionByName(staged)
    # Ranked without the bucket, so ties fall as in one run over all loads.
    best = latest_per_key(rows.drop("_bucket"), keys, order).withColumn("_bucket", bucket)
    merged = materialize(best.repartition("_bucket"), "merged")   # a table cannot be read while it is overwritten
    with _only_touched_partitions(spark):
        return save_table(merged, name, mode="replace_partitions", partition_by=["_bucket"], path=path)


def _literal(value) -> str:
    if isinstance(value, (dt.datetime, dt.date)):
        kind = "TIMESTAMP" if isinstance(value, dt.datetime) else "DATE"
        return f"{kind} '{value.isoformat(sep=' ') if isinstance(value, dt.datetime) else value.isoformat()}'"
    return str(value)


def balanced_predicates(column_values: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[str]:
    """SQL predicates on ``column`` that split a table in about ``parts`` alike parts.

    The bounds are approximate quantiles of the values, so gaps in the values
    cost nothing. A value that is several quantiles in a row holds that share of the
    rows, which no range can split: it is a part of its own. NULLs are the last part. Every row meets
    exactly one predicate. ``column_values`` may be a sample: it sets the sizes only.
    Numbers, dates and timestamps.
    """
    if parts < 1:
        raise ValueError("parts must be 1 or more")
    at = [i / parts for i in range(1, parts)]
    bounds = (column_values.where(F.col(column).isNotNull())
              .agg(F.percentile_approx(column, at, accuracy).alias("q")).first()["q"] if at else []) or []
    hot = {a for a, b in zip(bounds, bounds[1:], strict=False) if a == b}
    out, low = [], None
    for b in sorted(set(bounds)):
        floor = [] if low is None else [f"{column} {low}"]
        if b in hot:
            out.append(" AND ".join([*floor, f"{column} < {_literal(b)}"]))
            out.append(f"{column} = {_literal(b)}")
            low = f"> {_literal(b)}"
        else:
            out.append(" AND ".join([*floor, f"{column} < {_literal(b)}"]))
            low = f">= {_literal(b)}"
    out.append(f"{column} {low}" if low else f"{column} IS NOT NULL")
    return [*out, f"{column} IS NULL"]


def read_in_parts(read: Callable[[str], DataFrame], predicates: Sequence[str]) -> DataFrame:
    """The union of ``read(predicate)`` for each predicate."""
    first, *rest = [read(p) for p in predicates]
    for part in rest:
        first = first.unionByName(part)
    return first

