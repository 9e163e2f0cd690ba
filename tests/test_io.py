import uuid

import pytest

from starpipe.sources.io import (
    copy_table,
    list_tables,
    materialize,
    preview,
    run_copy,
    save_table,
    schema_report,
)
from starpipe.sources.manifest import MANIFEST


def _name(prefix="t"):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def test_save_table_overwrite_replaces_schema_and_counts(spark):
    name = _name()
    assert save_table(spark.range(5), name) == 5
    assert spark.table(name).count() == 5
    n = save_table(spark.range(3).selectExpr("id", "id * 2 AS twice"), name)
    assert n == 3
    assert spark.table(name).columns == ["id", "twice"]
    assert spark.table(name).count() == 3


def test_append_doubles_and_truncate_append_does_not(spark):
    name = _name()
    src = spark.range(4)
    save_table(src, name, mode="append")
    save_table(src, name, mode="append")
    assert spark.table(name).count() == 8          # a rerun of an append-only copy doubles rows
    save_table(src, name, mode="truncate_append")
    assert spark.table(name).count() == 4


def test_recreate_drops_first(spark):
    name = _name()
    save_table(spark.range(2), name)
    assert save_table(spark.range(3), name, recreate=True) == 3
    assert spark.table(name).count() == 3


def test_copy_table_with_declared_mapping(spark):
    name = _name("stg")
    src = spark.createDataFrame([("1", "x"), ("oops", "y")], "Id string, Other string")
    assert copy_table(src, name, [("Id", "Id", "int")]) == 2
    rows = spark.table(name).collect()
    assert spark.table(name).columns == ["Id"] and sorted(r["Id"] is None for r in rows) == [False, True]


def test_run_copy_manifest(spark):
    mapped = {e.table for e in MANIFEST if e.mapping is not None}
    assert mapped == {"Attendance", "HeadCount", "Program", "ProgramCategory", "PublicHoliday"}
    assert len(MANIFEST) == 9

    def reader(s, table):
        entry = next(e for e in MANIFEST if e.table == table)
        if entry.mapping is None:
            return s.createDataFrame([(1, "a")], "Id long, Name string")
        cols = ", ".join(f"CAST(NULL AS STRING) AS {src}" for src, _, _ in entry.mapping)
        return s.sql(f"SELECT {cols}")

    prefix = f"stg{uuid.uuid4().hex[:6]}_"
    report = {r["TableName"]: r["RowsCopied"] for r in run_copy(spark, MANIFEST, reader, prefix=prefix).collect()}
    assert report == {e.table: 1 for e in MANIFEST}
    names = {r["tableName"] for r in list_tables(spark).collect()}
    assert f"{prefix}Attendance".lower() in names
    hc = spark.table(f"{prefix}HeadCount")
    assert hc.schema["TotalCount"].dataType.simpleString() == "int"


def test_schema_report_and_preview(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, v string")
    rep = [tuple(r) for r in schema_report(df).collect()]
    assert rep == [(1, "id", "int", True), (2, "v", "string", True)]
    assert [r["id"] for r in preview(df, ["id"], 2).collect()] == [1, 2]


def test_materialize_roundtrip(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS m")
    back = materialize(df, "rt")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    plan = back.select("m").filter("m = 3")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<m:bigint>" in plan


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_save_table_partitioned(spark, mode):
    name = _name()
    df = spark.range(10).selectExpr("id", "id % 2 AS p")
    assert save_table(df, name, mode=mode, partition_by=["p"]) == 10
    assert spark.table(name).filter("p = 1").count() == 5
