"""Entities that are the same but for one letter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.operators.components import connected_components
from starpipe.sources.io import materialize


def normal_name(col: Column | str) -> Column:
    """Lower case, accents and white space as they are but for runs, ends trimmed."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def _one_less(name: Column) -> Column:
    """The name and the name without each of its letters."""
    at = F.sequence(F.lit(1), F.length(name))
    less = F.transform(at, lambda i: F.concat(F.substring(name, F.lit(1), i - 1), F.substring(name, i + 1, F.length(name))))
    return F.when(F.length(name) > 0, F.array_distinct(F.concat(F.array(name), less))).otherwise(F.array(name))


def near_duplicate_entities(df: DataFrame, exact: Sequence[str], name: str, id_col: str) -> DataFrame:
    """Ids whose records agree in the ``exact`` columns and whose names differ by one edit at most,
    along chains: (id, GroupId, GroupSize); only groups of several ids. GroupId is the smallest id.

    Blocking without loss: two names one insertion, deletion or replacement
    apart share a form with one letter less (or one of them is that form). So a name
    meets candidates under its own forms, as many as it has letters, and each
    candidate is verified by its edit distance. What can share a form is limited by
    the alphabet, not by the table: no block is ever too big, and none is cut
    or dropped. A big group of equal records is one entry throughout. NULL in an
    exact column or the name is no evidence and takes no part.
    """
    keys = [F.col(c) for c in exact]
    rows = df.select(*keys, normal_name(name).alias("_name"), F.col(id_col).alias("_id")).dropna().distinct()
    entry = F.xxhash64(*[F.col(c).cast("string") for c in exact], "_name").alias("_entry")
    ids = materialize(rows.select(*exact, "_name", "_id", entry), "entity_ids")
    forms = (ids.select(*exact, "_name", "_entry").distinct()
             .select(*exact, "_name", "_entry", F.explode(_one_less(F.col("_name"))).alias("_form")))
    left = forms.select(*exact, "_form", F.col("_name").alias("_a"), F.col("_entry").alias("a"))
    right = forms.select(*exact, "_form", F.col("_name").alias("_b"), F.col("_entry").alias("b"))
    near = (left.join(right, [*exact, "_form"]).where((F.col("_a") < F.col("_b")) & (F.levenshtein("_a", "_b") <= 1))
            .select("a", "b").distinct())
    # An id with several records joins their entries, so ids are groups' members once.
    same = ids.groupBy("_id").agg(F.min("_entry").alias("a")).join(ids.select("_id", F.col("_entry").alias("b")), "_id").where("a <> b").select("a", "b")
    labels = connected_components(near.unionByName(same))
    of = ids.join(labels, ids._entry == labels.node, "left").select("_id", F.coalesce("label", "_entry").alias("label")).distinct()
    groups = of.groupBy("label").agg(F.min("_id").alias("GroupId"), F.count(F.lit(1)).alias("GroupSize")).where("GroupSize > 1")
    return of.join(groups, "label").select(F.col("_id").alias(id_col), "GroupId", "GroupSize")
