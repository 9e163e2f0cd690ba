"""Reading and writing tables.

Writes go through the session catalog (``saveAsTable``) or to paths under
the shared scratch folder; nothing is written to a machine-local folder
unless the session is local and names none (tests).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping as MappingType, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starpipe.operators.conform import Mapping, apply_mapping
from starpipe.operators.ordering import OrderItem, sort_columns
from starpipe.session import scratch_dir


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a parquet path (anything with a '/')."""
    if "/" in name:
        return spark.read.parquet(name)
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000, predicates: Sequence[str] | None = None) -> DataFrame:
    """A database table as a DataFrame, read in parallel when a numeric,
    evenly spread column and its bounds are given (one range per task), or
    ``predicates``, one task each (``sources.loads.balanced_predicates`` for any other column)."""
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("give predicates or a partition column, not both")
        return spark.read.option("fetchsize", str(fetch_size)).jdbc(url, table, predicates=list(predicates), properties=properties)
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", str(fetch_size))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partition column needs lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound))
              .option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions)))
    return r.load()


def _observed(df: DataFrame, metrics: MappingType[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with its row count and named aggregates collected by whatever job runs it."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]), obs


def save_table(df: DataFrame, name: str, **how) -> int:
    """Write ``df`` as catalog table ``name`` and return the rows written; see ``save_validated``."""
    return save_validated(df, name, {}, **how)["rows"]


def save_validated(df: DataFrame, name: str, metrics: MappingType[str, Column], mode: str = "overwrite", recreate: bool = False,
                   fmt: str = "parquet", partition_by: Sequence[str] = (), path: str | None = None,
                   bucket_by: tuple[int, Sequence[str]] | None = None) -> dict[str, int]:
    """Write ``df`` as catalog table ``name``; return ``rows`` and the named ``metrics``.

    The metrics are aggregate columns (null counts, unmatched keys, bounds)
    of the rows written, collected by the job that writes them: validating
    a table costs no scan of it.

    ``overwrite`` replaces data and schema. ``recreate`` drops the table
    first. ``truncate_append`` keeps an existing table's schema and replaces
    its rows, matched by column name. ``path`` is where a new table lies; without one it is the
    session's warehouse. ``replace_partitions`` replaces the partitions that the rows
    fall in, where the session overwrites partitions dynamically (``sources.loads``).
    ``bucket_by`` (number, columns) lays the rows out by a hash of the columns, sorted by them,
    so joins on them need no exchange.
    """
    spark = df.sparkSession
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if recreate and path is not None:
        mode = "overwrite"  # the files of a table with its own path outlive the drop
    observed, obs = _observed(df, metrics)
    kept = mode in ("truncate_append", "replace_partitions")   # the table stays, rows of it are replaced
    if kept and spark.catalog.tableExists(name):
        observed.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
        return obs.get
    w = observed.write.format(fmt).mode("append" if kept else mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by is not None:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(name)
    return obs.get


_scopes: list[str] = []   # folders of the scopes that are open, the innermost last


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What ``materialize`` writes inside lies in one folder of the shared
    scratch folder, which is removed at the end: save results before."""
    folder = f"{scratch_dir(spark).rstrip('/')}/scope-{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield
    finally:
        _scopes.pop()
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "t", compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared scratch folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the upstream plan) and gives later passes column pruning and pushdown.
    The files stay until their ``scratch_scope`` ends, or, outside of one,
    for as long as the folder does. ``compression`` is the files' codec, by
    default the session's.
    """
    folder = _scopes[-1] if _scopes else scratch_dir(df.sparkSession).rstrip("/")
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def materialize_validated(df: DataFrame, label: str, metrics: MappingType[str, Column],
                          compression: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    """``materialize``, and ``rows`` and the named metrics of the rows written, from the same job."""
    observed, obs = _observed(df, metrics)
    return materialize(observed, label, compression), obs.get


def copy_table(src: DataFrame, name: str, mapping: Mapping | None = None,
               mode: str = "append") -> int:
    """Copy a source table into staging: declared mapping (or by name), then write.

    ``mode``: ``append`` (the copy job's behaviour - a rerun doubles rows),
    ``overwrite``, or ``truncate_append``.
    """
    return save_table(apply_mapping(src, mapping), name, mode=mode)


def run_copy(spark: SparkSession, manifest, reader, prefix: str = "stg_",
             mode: str = "append") -> DataFrame:
    """Copy every table of a manifest; return (TableName, RowsCopied).

    ``reader(spark, table_name) -> DataFrame`` supplies each source (JDBC in
    production, parquet in tests). Tables are copied one after another; each
    copy is itself a parallel job.
    """
    rows = []
    for entry in manifest:
        n = copy_table(reader(spark, entry.table), f"{prefix}{entry.table}", entry.mapping, mode)
        rows.append((entry.table, n))
    return spark.createDataFrame(rows, "TableName string, RowsCopied long")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")


def schema_report(df: DataFrame) -> DataFrame:
    """(Position, ColumnName, DataType, Nullable) - metadata only, no scan."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([
        T.StructField("Position", T.IntegerType(), False),
        T.StructField("ColumnName", T.StringType(), False),
        T.StructField("DataType", T.StringType(), False),
        T.StructField("Nullable", T.BooleanType(), False),
    ])
    return df.sparkSession.createDataFrame(rows, schema)


def preview(df: DataFrame, order: Sequence[OrderItem], n: int = 50) -> DataFrame:
    """First ``n`` rows under a declared order (a distributed top-k)."""
    return df.orderBy(*sort_columns(order)).limit(n)
