"""Dimension lookups: business key -> surrogate key, with an unknown member.

No join here carries a broadcast hint. Dimensions are usually small, but a
dimension such as Attendee grows with the business; AQE measures each
side at runtime and turns a join into a broadcast only when the measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` - a checked size,
with sort-merge (and AQE skew splitting of hot keys) beyond it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _on(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


_SALT = "_null_salt"


def _salt_width(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _row_salt(df: DataFrame, spread: Sequence[str] | None):
    """1 to the salt's width, by a hash of the row or of the columns ``spread``."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in spread or df.columns]), F.lit(_salt_width(df))) + 1


def _left_join_spread_nulls(fact: DataFrame, dim: DataFrame, keys: list[str], how: str,
                            spread: Sequence[str] | None = None) -> DataFrame:
    """``fact`` left/anti-joined to ``dim`` on ``keys``, with NULL keys spread out.

    A NULL key never matches, but a sort-merge join still hashes every NULL
    to one reducer - and unmatched rows (the unknown member) can be a large
    share of a fact. Such rows get a deterministic salt (a row hash over as
    many values as there are shuffle partitions) as an extra join column;
    matched candidates carry salt 0 on both sides, so results are unchanged.
    ``spread`` names columns that tell the rows apart, such as a surrogate key: with a
    hash of the whole row, every column travels to the join, read later or not.
    """
    any_null = None
    for k in keys:
        p = F.col(k).isNull()
        any_null = p if any_null is None else any_null | p
    salted = fact.withColumn(_SALT, F.when(any_null, _row_salt(fact, spread)).otherwise(F.lit(0)).cast("long"))
    # Always 0, but computed from the row: a literal 0 would be folded into
    # the join condition and drop out of the hash-partitioning keys.
    right = dim.withColumn(_SALT, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(1)).cast("long"))
    return salted.join(right, on=keys + [_SALT], how=how).drop(_SALT)


def lookup_key(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], key: str,
               default: int | None = 0, extra: Sequence[str] = ()) -> DataFrame:
    """Left-join ``dim[key]`` (and ``extra`` columns) onto ``fact`` by ``on``.

    An unmatched row - including one whose business key is NULL - gets
    ``default`` (the unknown member, 0); ``default=None`` leaves it NULL.
    If ``on`` is not unique in ``dim`` (a partial key), fact rows fan out,
    as a left join does; see ``fanout_rows``.
    """
    cols = _on(on)
    out = _left_join_spread_nulls(fact, dim.select(*cols, key, *extra), cols, "left")
    if default is not None:
        out = out.fillna({key: default})
    return out


def star_lookup(fact: DataFrame, lookups: Sequence[tuple[DataFrame, str | Sequence[str], str]],
                default: int | None = 0, spread: Sequence[str] | None = None) -> DataFrame:
    """Chain of ``lookup_key`` calls: [(dim, on, key), ...]. ``spread``: columns that tell the rows
    apart, for those with a NULL key; by default, all."""
    out = fact
    for dim, on, key in lookups:
        out = _left_join_spread_nulls(out, dim.select(*_on(on), key), _on(on), "left", spread)
    if default is not None:
        out = out.fillna({key: default for _, _, key in lookups})
    return out


def resolve_parent(child: DataFrame, parent: DataFrame, on: str | Sequence[str],
                   cols: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Left join ``child`` to ``parent`` and bring named parent columns.

    ``cols`` items are a parent column or ``(parent column, new name)``. The
    child keeps every one of its columns (``child.*``); a parent column
    replaces a child column of the same name. Join keys come first.
    """
    keys = _on(on)
    named = [(x, x) if isinstance(x, str) else x for x in cols]
    clash = [new for _, new in named if new in keys]
    if clash:
        raise ValueError(f"parent columns {clash} would replace join keys")
    replaced = [new for _, new in named if new in child.columns]
    right = parent.select(*keys, *[F.col(src).alias(new) for src, new in named])
    return _left_join_spread_nulls(child.drop(*replaced), right, keys, "left")


def resolve_distinct(child: DataFrame, key: str, with_: str, resolve: Callable[[DataFrame], DataFrame],
                     spread: Sequence[str] | None = None) -> DataFrame:
    """Left join ``child`` to what ``resolve`` adds to its distinct pairs of ``key`` and ``with_``.

    For lookups one after another, where the second needs what the first one
    found: they run on the pairs, two columns wide, and the child's whole rows are
    shuffled once, not once a lookup. ``resolve`` must keep both columns. Rows with a
    NULL ``key`` match nothing and are spread, as in ``lookup_key``; a NULL in
    ``with_`` is a value like any other. A found column replaces a child's of the same name.
    """
    found = resolve(child.select(key, with_).where(F.col(key).isNotNull()).distinct())
    child = child.drop(*[c for c in found.columns if c not in (key, with_)])
    found = found.withColumnsRenamed({key: "_key", with_: "_with"})
    salt = F.when(F.col(key).isNull(), _row_salt(child, spread))
    salted = child.withColumn(_SALT, salt.otherwise(F.lit(0)).cast("long"))
    right = found.withColumn("_zero", F.pmod(F.xxhash64("_key"), F.lit(1)).cast("long"))
    met = ((F.col(key) == F.col("_key")) & F.col(with_).eqNullSafe(F.col("_with")) & (F.col(_SALT) == F.col("_zero")))
    return salted.join(right, met, "left").drop(_SALT, "_key", "_with", "_zero")


def resolve_parent_colocated(child: DataFrame, parent: DataFrame, on: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``resolve_parent`` for two tables saved in equal buckets of ``on``: a left join without an exchange.

    A salt would be one more join key and undo the layout. Rows with a NULL
    key, which match nothing, pass by the join instead; a hot key that is not
    NULL stays in its bucket.
    """
    keys = _on(on)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    child = child.drop(*[c for c in cols if c in child.columns])
    met = child.where(present).join(parent.select(*keys, *cols), on=keys, how="left")
    none = [F.lit(None).cast(parent.schema[c].dataType).alias(c) for c in cols]
    return met.unionByName(child.where(~present).select("*", *none))


def orphans(child: DataFrame, parent: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Child rows with no parent (a NULL key never has one): ``left_anti``."""
    keys = _on(on)
    return _left_join_spread_nulls(child, parent.select(*keys), keys, "left_anti")


def fanout_rows(dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keys of ``on`` that match more than one dimension row, with that count."""
    keys = _on(on)
    return (dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("Matches"))
               .filter(F.col("Matches") > 1))


def with_unknown_member(dim: DataFrame, key: str, ids: str | Sequence[str], sentinel: int = -1,
                        unknown: int = 0) -> DataFrame:
    """The dimension plus one explicit unknown-member row.

    Facts that match nothing get surrogate key ``unknown`` (0); this adds a
    dimension row carrying that key, with ``sentinel`` (-1) as its business
    id(s) and NULL elsewhere, so joins from facts to the dimension keep
    unmatched facts visible. Off by default in the pipeline.
    """
    id_cols = _on(ids)
    row = dim.sparkSession.range(1).select(*[
        (F.lit(unknown) if c == key else F.lit(sentinel) if c in id_cols else F.lit(None))
        .cast(dim.schema[c].dataType).alias(c) for c in dim.columns])
    return dim.unionByName(row)
