import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from starpipe import contracts as C
from starpipe.operators.conform import apply_mapping, apply_mapping_checked, conform, split_rejected
from starpipe.operators.dedup import latest_per_key
from starpipe.session import scratch_dir
from starpipe.sources import fixtures
from starpipe.sources.io import materialize, save_table, save_validated
from starpipe.sources.loads import append_load, balanced_predicates, merge_latest, read_in_parts
from tests.conftest import SF_SMALL


def _name(prefix="t"):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def _files(path):
    """Data files below a table's folder, with size and time of change."""
    out = {}
    for top, _, names in os.walk(path.removeprefix("file:")):
        for n in names:
            if n.endswith(".parquet"):
                f = os.path.join(top, n)
                out[f] = (os.path.getsize(f), os.stat(f).st_mtime_ns)
    return out


def _path(spark, name):
    return f"{scratch_dir(spark).rstrip('/')}/{name}"


def test_a_repeated_load_replaces_its_own_rows(spark):
    name = _name()
    path = _path(spark, name)
    assert append_load(spark.range(5), name, "2024-01", path=path) == 5
    assert append_load(spark.range(100, 103), name, "2024-02", path=path) == 3
    first = {f: s for f, s in _files(path).items() if "2024-01" in f}
    assert append_load(spark.range(100, 102), name, "2024-02", path=path) == 2
    assert sorted((r["id"], r["LoadId"]) for r in spark.table(name).collect()) == [
        *[(i, "2024-01") for i in range(5)], (100, "2024-02"), (101, "2024-02")]
    assert {f: s for f, s in _files(path).items() if "2024-01" in f} == first
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    with pytest.raises(ValueError):
        append_load(spark.range(1).withColumn("LoadId", F.lit(1)), name, 1)


@pytest.mark.parametrize("seed", range(3))
def test_loads_in_any_order_equal_one_run(spark, seed):
    rng = random.Random(seed)
    src = conform(fixtures.STAGING["Enrollment"](spark, SF_SMALL), C.ENROLLMENT)
    keys, salt = list(C.ENROLLMENT.business_key), rng.randrange(1000)
    part = F.pmod(F.xxhash64(*src.columns, F.lit(salt)), F.lit(3))
    name = _name()
    order = [0, 1, 2, rng.randrange(3)]
    rng.shuffle(order)
    for i in order:
        merge_latest(src.where(part == i), name, keys, buckets=8, path=_path(spark, name))
    whole = latest_per_key(src, keys)
    got = spark.table(name).drop("_bucket")
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


def test_untouched_files_stay(spark):
    name, order = _name(), [("v", "desc")]
    path = _path(spark, name)
    merge_latest(spark.range(1000).select("id", F.lit(1).alias("v")), name, ["id"], order, buckets=16, path=path)
    before = _files(path)
    assert merge_latest(spark.range(7, 8).select("id", F.lit(2).alias("v")), name, ["id"], order, buckets=16, path=path) < 200
    after = _files(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert len({os.path.dirname(f) for f in before}) == 16 and len({os.path.dirname(f) for f in same}) == 15
    rows = {r["id"]: r["v"] for r in spark.table(name).collect()}
    assert len(rows) == 1000 and rows[7] == 2 and sum(rows.values()) == 1001


def _spread(spark, values, column="k"):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{column} long, i long")


@pytest.mark.parametrize("values", [
    [None] * 300 + [7] * 500 + list(range(400)),                  # a hot value and NULLs
    list(range(100)) + [10**12 + i for i in range(900)],          # a gap
    [5] * 50, [None] * 9, [], list(range(-30, 30)) * 3])
def test_every_row_meets_one_predicate(spark, values):
    df = _spread(spark, values)
    predicates = balanced_predicates(df, "k", 6)
    hits = df.select(sum(F.expr(f"CASE WHEN {p} THEN 1 ELSE 0 END") for p in predicates).alias("n"))
    assert {r["n"] for r in hits.collect()} <= {1}
    back = read_in_parts(df.where, predicates)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_parts_are_alike_but_for_a_hot_value(spark):
    df = _spread(spark, [None] * 100 + [7] * 4000 + list(range(1000, 3000)) + [10**9 + i for i in range(2000)])
    sizes = {p: df.where(p).count() for p in balanced_predicates(df, "k", 8)}
    assert sizes["k = 7"] == 4000 and sizes["k IS NULL"] == 100
    assert max(n for p, n in sizes.items() if p != "k = 7") <= 1.3 * 8000 / 8


def test_predicates_on_dates_and_timestamps(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i * i) for i in range(60)]
    df = spark.createDataFrame([(d, dt.datetime(d.year, d.month, d.day, 7, 5, 3)) for d in days], "d date, t timestamp_ntz")
    for c in ("d", "t"):
        parts = [df.where(p).count() for p in balanced_predicates(df, c, 4)]
        assert sum(parts) == 60 and max(parts) <= 20


def test_accepted_and_rejected_make_up_the_source(spark):
    src = spark.createDataFrame(
        [("1", "2020-01-01", "x", 5), ("oops", "31/12/2015", "y", 6), (None, None, None, None), ("3", "", "z", 7)],
        "Id string, Day string, Name string, N int")
    mapping = [("Id", "Id", "int"), ("Day", "Day", "date"), ("Name", "Name", "string"), ("N", "Total", "long")]
    accepted, rejected = split_rejected(materialize(apply_mapping_checked(src, mapping, F.coalesce("Name", F.lit("none"))), "checked"))
    plain = apply_mapping(src, mapping)
    assert accepted.schema == plain.schema and accepted.exceptAll(plain).isEmpty() and accepted.count() == 4
    assert sorted(tuple(r) for r in rejected.collect()) == [
        ("y", "Day", "31/12/2015", "not a date"), ("y", "Id", "oops", "not a int"), ("z", "Day", "", "not a date")]
    values = sum(v is not None for r in src.collect() for v in r)
    kept = sum(v is not None for r in accepted.collect() for v in r)
    assert values == kept + rejected.count()
    typed, none = split_rejected(apply_mapping_checked(src.select("N"), [("N", "N", "int")], "N"))
    assert typed.count() == 4 and none.count() == 0


def test_metrics_come_from_the_write(spark):
    name = _name()
    df = spark.range(10).select("id", F.when(F.col("id") > 6, F.col("id")).alias("k"))
    got = save_validated(df, name, {"no_k": F.count_if(F.col("k").isNull()), "lo": F.min("k"), "hi": F.max("k")})
    assert got == {"rows": 10, "no_k": 7, "lo": 7, "hi": 9}
    assert save_table(df.where("false"), _name()) == 0


def test_bucketed_tables_join_without_an_exchange(spark):
    a, b = _name("a"), _name("b")
    save_table(spark.range(2000).selectExpr("id AS k", "id % 7 AS x"), a, bucket_by=(8, ["k"]))
    save_table(spark.range(500, 1500).selectExpr("id AS k", "id * 2 AS y"), b, bucket_by=(8, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.table(a).join(spark.table(b), "k")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
