"""Shared helpers: text columns through Arrow, fresh column names, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starpipe.operators.components import connected_components  # noqa: F401  (used by the operators here)

#: Code points 9-13 and 32, which end a word (the same set as ``bytes.split()``).
SPACES = "\t\n\x0b\x0c\r "


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def doc_fold(doc_id: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def shared(spark: SparkSession, value) -> Callable[[], object]:
    """``value`` broadcast to the tasks, with its classes; callers bound its size. The result
    gives a task its copy."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(held.value)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside hand at most ``rows`` rows at a time to Python, so what a task holds outside
    of the heap does not follow the size of its partition."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def map_texts(df: DataFrame, text_col: str, outputs: list[T.StructField],
              make: Callable[[], Callable[[list[bytes | None]], list]]) -> DataFrame:
    """``df`` plus output columns computed from the text column, batch by batch.

    ``make()`` runs once in each task and returns the function that turns a
    list of UTF-8 texts (None for null) into one value list per output. Rows
    stay in their partition: no shuffle.
    """
    schema = T.StructType([*df.schema.fields, *outputs])
    at = df.columns.index(text_col)
    out_types = [_arrow_type(f.dataType) for f in outputs]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            cols = [pa.array(v, t) for v, t in zip(fn(texts), out_types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=names)

    return df.mapInArrow(run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)
