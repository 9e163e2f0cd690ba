"""Projection operators: declared column mappings and table contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.contracts import Contract
from starpipe.functions.scalar import safe_cast, spark_type

Mapping = Sequence[tuple[str, str, str]]  # (source column, target column, type)


def apply_mapping(df: DataFrame, mapping: Mapping | None = None) -> DataFrame:
    """Rename and convert columns as a copy translator declares them.

    ``mapping=None`` passes every column through by name. A declared mapping
    keeps only the listed columns, in the listed order; a value that does not
    convert becomes NULL (truncation allowed, nothing fails).
    """
    if mapping is None:
        return df.select("*")
    types = _types(df)
    return df.select(*[safe_cast(src, dtype, types.get(src)).alias(dst) for src, dst, dtype in mapping])


def apply_mapping_checked(df: DataFrame, mapping: Mapping, row_id: Column | str) -> DataFrame:
    """``apply_mapping`` plus ``_rejected``: what each row lost in the conversion.

    An array of (RowId, ColumnName, SourceText, Rule), empty where every
    value converted. It comes from the same projection, so the
    source is read once: write the result, then split it (``split_rejected``).
    """
    types = _types(df)
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    converted = [(src, dst, dtype, safe_cast(src, dtype, types.get(src))) for src, dst, dtype in mapping]
    lost = [F.when(F.col(src).isNotNull() & c.isNull(), F.struct(
        rid.cast("string").alias("RowId"), F.lit(dst).alias("ColumnName"), F.col(src).cast("string").alias("SourceText"),
        F.lit(f"not a {dtype}").alias("Rule"))) for src, dst, dtype, c in converted if types.get(src) != spark_type(dtype)]
    none = F.array().cast("array<struct<RowId:string,ColumnName:string,SourceText:string,Rule:string>>")
    return df.select(*[c.alias(dst) for _, dst, _, c in converted],
                     (F.array_compact(F.array(*lost)) if lost else none).alias("_rejected"))


def split_rejected(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected values) of ``apply_mapping_checked``'s saved result."""
    rejected = checked.select(F.explode("_rejected").alias("r")).select("r.*")
    return checked.drop("_rejected"), rejected


def _types(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def resolve_source(df: DataFrame, candidates: Sequence[str]) -> str:
    present = set(df.columns)
    for c in candidates:
        if c in present:
            return c
    raise ValueError(f"none of the columns {list(candidates)} is present in {df.columns}")


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Project a raw table onto a contract: rename, convert, require keys.

    Lowers to one Filter + one Project. The not-null test is also applied to
    the *raw* key columns first: a predicate above a cast cannot reach the
    parquet scan, one on the raw column can (``PushedFilters: IsNotNull``).
    """
    sources = {f.target: resolve_source(df, f.sources()) for f in contract.fields}
    raw_required = [sources[k] for k in contract.required]
    if raw_required:
        cond = None
        for c in raw_required:
            p = F.col(c).isNotNull()
            cond = p if cond is None else cond & p
        df = df.filter(cond)
    types = _types(df)
    out = df.select(*[safe_cast(sources[f.target], f.dtype, types.get(sources[f.target])).alias(f.target)
                      for f in contract.fields])
    cond = None
    for k in contract.required:
        p = F.col(k).isNotNull()
        cond = p if cond is None else cond & p
    return out.filter(cond) if cond is not None else out
