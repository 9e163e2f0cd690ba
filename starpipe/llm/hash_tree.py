"""Sharding by a hierarchical weighted hash tree (law: ``key``).

Shards lie in racks, racks in regions. A key descends from the top: at each
level every child draws a number from a hash of the key and the child,
scaled by the child's weight, and the key follows the best draw. A child's
weight is the sum of its shards' weights, so when a shard's weight changes only
the draws on its path change, and keys move only into or out of those
subtrees.

Growth keeps what is: weight that is added later is a new generation of its
path, drawn beside the earlier ones. A key that follows a new generation is
led by it straight to the shard that the weight was added to, so one more
shard takes keys only into itself, and no key moves between the old ones.

Only the key and the shards decide; sizes and texts do not. Defined cases: a
null key counts as the empty one; equal keys share a shard; equal
rows get different slots; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starpipe.sources.io import materialize


@dataclass(frozen=True)
class Leaf:
    """Some weight of a shard; ``generation`` 0 for the first layout."""
    region: int
    rack: int
    shard: int
    weight: float = 1.0
    generation: int = 0


def layout(shards: int, regions: int = 2, racks: int = 3) -> list[Leaf]:
    """``shards`` equal shards dealt evenly over ``regions`` x ``racks``."""
    return [Leaf(s * regions // shards, (s * regions * racks // shards) % racks, s) for s in range(shards)]


def grown(leaves: list[Leaf], more: int = 1) -> list[Leaf]:
    """The layout with ``more`` shards, each in the region and rack of least weight."""
    out = list(leaves)
    for _ in range(more):
        size: dict[tuple[int, int], float] = {}
        for x in out:
            size[x.region, x.rack] = size.get((x.region, x.rack), 0) + x.weight
        region, rack = min(size, key=lambda k: (size[k], k))
        out.append(Leaf(region, rack, max(x.shard for x in out) + 1, 1.0, max(x.generation for x in out) + 1))
    return out


def _children(leaves: list[Leaf], depth: int) -> dict[str, dict[str, float]]:
    """By parent's name, the children at ``depth`` with their weights. A name is
    generation/region[/rack[/shard]]: a generation is chosen with its region."""
    out: dict[str, dict[str, float]] = {}
    for x in leaves:
        if x.weight > 0:
            path = [str(v) for v in (x.generation, x.region, x.rack, x.shard)]
            parent, name = "/".join(path[:depth + 1]) if depth else "", "/".join(path[:depth + 2])
            own = out.setdefault(parent, {})
            own[name] = own.get(name, 0.0) + x.weight
    return out


def _best(key: Column, children: Column) -> Column:
    """The name of the child with the best weighted draw."""
    def draw(child: Column) -> Column:
        # 53 bits of a hash of key and child, in (0, 1)
        u = (F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11) + 0.5) / F.lit(float(1 << 53))
        return F.struct((F.log(u) / child["weight"]).alias("draw"), child["name"].alias("name"))
    return F.array_max(F.transform(children, draw))["name"]


def shard_of(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key, by descending the tree."""
    name = F.lit("")
    for depth in range(3):
        tree = F.create_map(*[x for parent, own in _children(leaves, depth).items() for x in (
            F.lit(parent), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight")) for n, w in own.items()]))])
        name = _best(key, tree[name])
    return F.element_at(F.split(name, "/"), -1).cast("int")


def assign(docs: DataFrame, leaves: list[Leaf], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, grown_shard): grown_shard is the shard with one more."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    return (docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                        F.crc32(text).alias("text_crc32"))
            .withColumn("shard", shard_of(key, leaves)).withColumn("grown_shard", shard_of(key, grown(leaves))))


def with_slots(rows: DataFrame, shard_col: str = "shard", rows_per_bucket: int = 100_000) -> DataFrame:
    """``rows`` plus ``slot``, gapless from 0 in each shard.

    Rows are numbered inside buckets of a shard and buckets by running sums, so no
    task holds a shard. Equal rows are counted first and numbered together,
    so a key with a third of all rows is one row when it is sorted. It is written out in
    runs of at most ``rows_per_bucket``, dealt over the tasks."""
    cols = rows.columns
    alike = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    counted = materialize(alike.withColumn("__order", F.xxhash64(*cols)), "slots")
    total, n_rows, most = counted.agg(F.count(F.lit(1)), F.sum("__n"), F.max("__n")).first()
    bits = max(0, (-(-total // rows_per_bucket) - 1).bit_length())
    bucket = F.shiftrightunsigned("__order", 64 - bits) if bits else F.lit(0).cast("long")
    counted = counted.withColumn("__bucket", bucket)
    sums = counted.groupBy(shard_col, "__bucket").agg(F.sum("__n").alias("__sum"))
    earlier = Window.partitionBy(shard_col).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(shard_col, "__bucket", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__base"))
    inside = (Window.partitionBy(shard_col, "__bucket").orderBy("__order", *cols)
              .rowsBetween(Window.unboundedPreceding, -1))
    runs = (counted.withColumn("__before", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
            .join(base, [shard_col, "__bucket"])
            .select(*cols, (F.col("__base") + F.col("__before")).alias("__first"),
                    (F.col("__base") + F.col("__before") + F.col("__n") - 1).alias("__last")))
    if (most or 0) > rows_per_bucket:
        parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // rows_per_bucket))
        step = F.lit(rows_per_bucket).cast("long")
        runs = (runs.withColumn("__first", F.explode(F.sequence("__first", "__last", step)))
                .withColumn("__last", F.least("__last", F.col("__first") + step - 1))
                .repartition(parts, shard_col, "__first"))
    return runs.select(*cols, F.explode(F.sequence("__first", "__last")).alias("slot"))
