"""How many intervals are open at once: a distributed sweep line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starpipe.operators.keys import range_layout
from starpipe.sources.io import materialize


def concurrency(df: DataFrame, keys: Sequence[str], start: str, end: str,
                partitions: int | None = None) -> DataFrame:
    """The steps of each key's count of open intervals: (keys, At, Until, Level).

    An interval is open from ``start`` to before ``end``; a row with a NULL
    or without a length opens none. ``Level`` holds from ``At`` to before
    ``Until``, which is NULL after a key's last change (level 0).

    Every interval is +1 at its start and -1 at its end; changes of one key
    and moment are summed first, map side. A level is a prefix sum, and
    not one over a window of the key, which would put a hot key in one task: the
    changes lie in parts by (keys, moment) as ``add_key`` lays out rows, sums
    run inside a part, and what a part's first key brings along from earlier
    parts, and its last key needs from the next, comes from a written table of
    one row per part. No interval is compared with another one.
    """
    both = F.array(F.struct(F.col(start).alias("At"), F.lit(1).alias("d")), F.struct(F.col(end).alias("At"), F.lit(-1).alias("d")))
    changes = materialize(
        df.where(F.col(end) > F.col(start)).select(*keys, F.explode(both).alias("e"))
        .groupBy(*keys, F.col("e.At").alias("At")).agg(F.sum("e.d").alias("_d")), "changes")
    rows = range_layout(changes, [*keys, "At"], unique=True, partitions=partitions)
    key = F.struct(*keys)
    runs = rows.groupBy("_part", *keys).agg(
        F.sum("_d").alias("s"), F.min("_row").alias("lo"), F.max("_row").alias("hi"), F.min("At").alias("from"))
    parts = runs.groupBy("_part").agg(
        F.min_by(F.struct(key.alias("k"), F.col("from").alias("at")), "lo").alias("head"),
        F.max_by(F.struct(key.alias("k"), "s"), "hi").alias("tail"))
    # A part's last key goes on in later parts with the sum of its run here.
    ends = parts.select("_part", F.explode(F.array(
        F.struct(F.col("head.k").alias("k"), F.lit(0).cast("long").alias("s"), F.lit(True).alias("is_head")),
        F.struct(F.col("tail.k").alias("k"), F.col("tail.s").alias("s"), F.lit(False).alias("is_head")))).alias("x")).select("_part", "x.*")
    earlier = Window.partitionBy("k").orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)
    before = ends.withColumn("before", F.coalesce(F.sum("s").over(earlier), F.lit(0))).where("is_head").select("_part", "before")
    in_order = Window.orderBy("_part")   # one row per part
    edges = materialize(parts.join(before, "_part").select(
        "_part", "before", F.col("head.k").alias("_first"), F.lead("head").over(in_order).alias("_next")), "edges")

    frame = rows.join(edges, "_part").repartition("_part")
    w = Window.partitionBy("_part", *keys).orderBy("_row")
    carried = F.when(key.eqNullSafe(F.col("_first")), F.col("before")).otherwise(0)
    return frame.select(
        *keys, "At",
        F.coalesce(F.lead("At").over(w), F.when(key.eqNullSafe(F.col("_next.k")), F.col("_next.at"))).alias("Until"),
        (F.sum("_d").over(w) + carried).alias("Level"))
