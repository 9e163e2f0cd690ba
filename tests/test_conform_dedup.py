import datetime as dt

from pyspark.sql import functions as F

from starpipe import contracts as C
from starpipe.operators.conform import apply_mapping, conform
from starpipe.operators.dedup import latest_in_order, latest_per_key, version_history
from starpipe.plans.clean import clean_headcount

STG_BU = ("Id string, Code string, Name string, EnterpriseId long, TypeId long, "
          "IsActive boolean, CreatedOn timestamp_ntz, UpdatedOn timestamp_ntz")


def _t(s):
    return dt.datetime.fromisoformat(s) if s else None


def test_conform_renames_casts_and_requires_keys(spark):
    rows = [("1", "A", "a", 1, 0, True, _t("2020-01-01"), None),
            ("bad", "B", "b", 1, 0, True, _t("2020-01-01"), None),
            (None, "C", "c", 1, 0, True, _t("2020-01-01"), None)]
    out = conform(spark.createDataFrame(rows, STG_BU), C.BUSINESS_UNIT)
    assert out.columns == C.BUSINESS_UNIT.columns
    got = out.collect()
    assert [r["BusinessUnitId"] for r in got] == [1]
    assert out.schema["BusinessUnitId"].dataType.simpleString() == "bigint"


def test_conform_pushes_raw_not_null_to_the_scan(spark, tmp_path):
    rows = [("1", "A", "a", 1, 0, True, _t("2020-01-01"), None)]
    p = str(tmp_path / "bu")
    spark.createDataFrame(rows, STG_BU).write.parquet(p)
    plan = conform(spark.read.parquet(p), C.BUSINESS_UNIT)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Id)]" in plan


def test_headcount_source_column_fallback(spark):
    base = "Id long, OrgId long, TermProgramSetId long, TermProductId long, Description string, {} string, " \
           "StatusId long, TotalCount int, IsActive boolean, CreatedOn timestamp_ntz, UpdatedOn timestamp_ntz"
    row = [(1, 2, 3, 4, "d", "Room", 1, 5, True, _t("2020-01-01"), None)]
    for name in ("HeadcountType", "Name"):
        out = clean_headcount(spark.createDataFrame(row, base.format(name)))
        assert out.first()["HeadcountType"] == "Room"


def test_apply_mapping(spark):
    df = spark.createDataFrame([(1, "7", "x")], "a long, b string, c string")
    assert apply_mapping(df).columns == ["a", "b", "c"]
    out = apply_mapping(df, [("b", "B", "int"), ("c", "C", "int")]).first()
    assert out["B"] == 7 and out["C"] is None


LATEST_ROWS = "k long, IsActive boolean, UpdatedOn timestamp_ntz, CreatedOn timestamp_ntz, tag string"


def test_latest_per_key_order_and_nulls(spark):
    rows = [
        # only IsActive differs -> the active one wins
        (1, False, _t("2020-01-02"), _t("2020-01-01"), "k1-inactive"),
        (1, True, _t("2020-01-02"), _t("2020-01-01"), "k1-active"),
        # only UpdatedOn differs; NULL update loses
        (2, True, None, _t("2020-01-01"), "k2-null-update"),
        (2, True, _t("2020-01-01"), _t("2020-01-01"), "k2-old"),
        (2, True, _t("2020-02-01"), _t("2020-01-01"), "k2-new"),
        # only CreatedOn differs
        (3, None, None, _t("2020-01-01"), "k3-old"),
        (3, None, None, _t("2020-01-05"), "k3-new"),
        # NULL IsActive loses to False
        (4, None, _t("2021-01-01"), _t("2021-01-01"), "k4-null-active"),
        (4, False, _t("2020-01-01"), _t("2020-01-01"), "k4-false"),
        # everything NULL but creation
        (5, None, None, None, "k5-nothing"),
        (5, None, None, _t("2020-01-01"), "k5-created"),
    ]
    df = spark.createDataFrame(rows, LATEST_ROWS)
    got = {r["k"]: r["tag"] for r in latest_per_key(df, ["k"]).collect()}
    assert got == {1: "k1-active", 2: "k2-new", 3: "k3-new", 4: "k4-false", 5: "k5-created"}


def test_latest_per_key_is_idempotent_and_limits_before_the_shuffle(spark):
    rows = [(i % 50, i % 3 == 0, _t("2020-01-01") + dt.timedelta(days=i), _t("2020-01-01"), str(i))
            for i in range(500)]
    df = spark.createDataFrame(rows, LATEST_ROWS)
    once = latest_per_key(df, ["k"])
    twice = latest_per_key(once, ["k"])
    assert once.count() == 50
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_latest_in_order_is_latest_per_key_with_places(spark):
    from starpipe.operators.keys import add_key, number_layout
    from starpipe.sources.io import materialize

    rows = [(i * 7919 % 300, i % 3 == 0, _t("2020-01-01") + dt.timedelta(days=i % 4), _t("2020-01-01"), str(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, LATEST_ROWS).repartition(5)
    laid = latest_in_order(df, ["k"])
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning(k" in plan and "Exchange hashpartitioning" not in plan
    got = number_layout(materialize(laid, "laid"), "Key")
    want = add_key(latest_per_key(df, ["k"]), "Key", ["k"], unique=True)
    assert got.columns == want.columns and got.count() == 300
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_version_history_with_a_hot_key(spark):
    from pyspark.sql import Window

    # key 0 holds a third of all rows: the ranking must still be exact
    rows = [((0 if i % 3 == 0 else i), i % 2 == 0, _t("2020-01-01") + dt.timedelta(hours=i),
             _t("2019-01-01") + dt.timedelta(minutes=i), str(i)) for i in range(30000)]
    df = spark.createDataFrame(rows, LATEST_ROWS)
    got = version_history(df, ["k"])
    w = Window.partitionBy("k").orderBy(F.col("IsActive").desc_nulls_last(),
                                        F.col("UpdatedOn").desc_nulls_last(),
                                        F.col("CreatedOn").desc_nulls_last())
    want = df.select("*", F.row_number().over(w).cast("int").alias("VersionRank"),
                     F.count(F.lit(1)).over(Window.partitionBy("k")).alias("VersionCount"),
                     F.lag("UpdatedOn").over(w).alias("PrevUpdatedOn"),
                     F.lead("UpdatedOn").over(w).alias("NextUpdatedOn"))
    cols = want.columns
    assert got.select(*cols).exceptAll(want).count() == 0
    assert want.exceptAll(got.select(*cols)).count() == 0


def _history_oracle(df, keys):
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(F.col("IsActive").desc_nulls_last(),
                                          F.col("UpdatedOn").desc_nulls_last(),
                                          F.col("CreatedOn").desc_nulls_last())
    return df.select("*", F.row_number().over(w).cast("int").alias("VersionRank"),
                     F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("VersionCount"),
                     F.lag("UpdatedOn").over(w).alias("PrevUpdatedOn"),
                     F.lead("UpdatedOn").over(w).alias("NextUpdatedOn"))


def test_version_history_keys_spanning_many_buckets(spark):
    rows = []
    for i in range(6000):
        k = 0 if i % 3 == 0 else (1 if i % 5 == 0 else i % 400)   # two hot keys
        upd = None if i % 11 == 0 else _t("2020-01-01") + dt.timedelta(hours=i)
        rows.append((k, None if i % 13 == 0 else i % 2 == 0, upd,
                     _t("2019-01-01") + dt.timedelta(minutes=i), str(i)))
    df = spark.createDataFrame(rows, LATEST_ROWS)
    for b in (2, 37, 200):
        got = version_history(df, ["k"], partitions=b)
        want = _history_oracle(df, ["k"])
        cols = want.columns
        assert got.select(*cols).exceptAll(want).count() == 0, b
        assert want.exceptAll(got.select(*cols)).count() == 0, b


def test_version_history_exact_duplicates_and_composite_keys(spark):
    # identical rows give identical sort values: boundaries may repeat and
    # leave empty buckets; ranks among identical rows are interchangeable
    rows = [(i % 4, _t("2020-01-01"), _t("2020-01-01"), "same") for i in range(800)]
    rows += [(i % 4, _t("2020-01-01") + dt.timedelta(days=i), _t("2020-01-02"), str(i)) for i in range(800)]
    df = (spark.createDataFrame(rows, "k long, UpdatedOn timestamp_ntz, CreatedOn timestamp_ntz, tag string")
          .withColumn("IsActive", F.lit(True)).withColumn("k2", F.col("k") % 2))
    got = version_history(df, ["k2", "k"], partitions=60)
    want = _history_oracle(df, ["k2", "k"])
    cols = want.columns
    assert got.select(*cols).exceptAll(want).count() == 0
    assert want.exceptAll(got.select(*cols)).count() == 0


def test_version_history_single_bucket(spark):
    rows = [(i % 3, i % 2 == 0, _t("2020-01-01") + dt.timedelta(hours=i), _t("2019-01-01"), str(i))
            for i in range(30)]
    df = spark.createDataFrame(rows, LATEST_ROWS)
    got = version_history(df, ["k"])
    want = _history_oracle(df, ["k"])
    assert got.select(*want.columns).exceptAll(want).count() == 0
    assert want.exceptAll(got.select(*want.columns)).count() == 0


def test_latest_per_key_ties_resolve_the_same_way_in_any_row_order(spark):
    rows = [(1, True, _t("2020-01-01"), _t("2020-01-01"), f"tie{i}") for i in range(50)]
    a = spark.createDataFrame(rows, LATEST_ROWS).repartition(7)
    b = spark.createDataFrame(list(reversed(rows)), LATEST_ROWS).repartition(3)
    assert latest_per_key(a, ["k"]).first()["tag"] == latest_per_key(b, ["k"]).first()["tag"]


def test_copy_loses_no_key_and_duplicates_are_deduplicated(spark):
    from starpipe.plans.registry import QUERIES
    from tests.conftest import SF_SMALL

    copied = QUERIES["copy_attendance"](spark, SF_SMALL)
    assert copied.where("Id IS NULL").count() == 0 and copied.where("TimeStart IS NOT NULL").count() > 0
    assert QUERIES["copy_then_clean_attendance"](spark, SF_SMALL).count() > 5000
    enrolments = QUERIES["clean_enrollment"](spark, SF_SMALL).count()
    assert QUERIES["dedup_lookup"](spark, SF_SMALL).count() < enrolments
    assert QUERIES["dedup_enrollment"](spark, SF_SMALL).count() < enrolments


def test_exact_distinct_counts_copy_no_rows(spark):
    from starpipe.operators import quality as Q

    df = spark.range(100).selectExpr("id % 7 AS a", "CASE WHEN id % 5 = 0 THEN NULL ELSE id % 3 END AS b")
    for report in (Q.null_profile(df), Q.profile_keys(df, ["a", "b"], composite=True), Q.entity_summary(df, {"A": "a", "B": "b"}),
                   Q.key_integrity(df, "a", ["a", "b"])):
        assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
    got = {r["KeyColumn"]: tuple(r)[1:] for r in Q.profile_keys(df, ["a", "b"], composite=True).collect()}
    assert got == {"a": (100, 7, 0), "b": (100, 3, 20), "a+b": (100, 21, 20)}
    assert tuple(Q.null_profile(df, approx=True).where("ColumnName = 'b'").first())[1] == 20
