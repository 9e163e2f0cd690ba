from pyspark.sql import functions as F

from starpipe.operators import quality as Q
from starpipe.operators.lookup import fanout_rows, lookup_key, orphans, resolve_parent, star_lookup


def test_lookup_unknown_member_and_null_key(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, bu long")
    dim = spark.createDataFrame([(10, 1)], "bu long, BusinessUnitKey long")
    got = {r["id"]: r["BusinessUnitKey"] for r in lookup_key(fact, dim, "bu", "BusinessUnitKey").collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    kept = {r["id"]: r["BusinessUnitKey"]
            for r in lookup_key(fact, dim, "bu", "BusinessUnitKey", default=None).collect()}
    assert kept == {1: 1, 2: None, 3: None}


def test_lookup_on_unique_dimension_keeps_row_count(spark):
    fact = spark.range(1000).select(F.col("id"), (F.col("id") % 13).alias("bu"))
    dim = spark.range(10).select(F.col("id").alias("bu"), (F.col("id") + 1).alias("k"))
    assert lookup_key(fact, dim, "bu", "k").count() == 1000


def test_partial_key_fans_out(spark):
    fact = spark.createDataFrame([(1, 5)], "id int, org long")
    dim = spark.createDataFrame([(1, 5, 11), (2, 5, 12), (3, 6, 13)], "bu long, org long, k long")
    assert lookup_key(fact, dim, "org", "k").count() == 2
    assert [tuple(r) for r in fanout_rows(dim, "org").collect()] == [(5, 2)]


def test_star_lookup_and_composite_keys(spark):
    fact = spark.createDataFrame([(1, 1, 7), (2, 1, 8), (3, 2, 7)], "id int, bu long, org long")
    d_bu = spark.createDataFrame([(1, 100)], "bu long, kb long")
    d_org = spark.createDataFrame([(1, 7, 200), (2, 7, 201)], "bu long, org long, ko long")
    got = {r["id"]: (r["kb"], r["ko"]) for r in
           star_lookup(fact, [(d_bu, "bu", "kb"), (d_org, ["bu", "org"], "ko")]).collect()}
    assert got == {1: (100, 200), 2: (100, 0), 3: (0, 201)}


def test_resolve_parent_and_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "cid int, pid long")
    parent = spark.createDataFrame([(10, 5, 50)], "pid long, bu long, key long")
    got = {r["cid"]: (r["bu"], r["k"]) for r in
           resolve_parent(child, parent, "pid", ["bu", ("key", "k")]).collect()}
    assert got == {1: (5, 50), 2: (None, None), 3: (None, None)}
    assert sorted(r["cid"] for r in orphans(child, parent, "pid").collect()) == [2, 3]


def test_quality_reports(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, 3), (None, "c", 3)],
                               "id long, name string, acct long")
    prof = {r["KeyColumn"]: tuple(r)[1:] for r in Q.profile_keys(df, ["id", "name"]).collect()}
    assert prof == {"id": (4, 2, 1), "name": (4, 3, 1)}
    nulls = {r["ColumnName"]: (r["NullCount"], r["DistinctCount"]) for r in Q.null_profile(df).collect()}
    assert nulls == {"id": (1, 2), "name": (1, 3), "acct": (0, 3)}
    assert [tuple(r) for r in Q.duplicate_keys(df, ["id"]).collect()] == [(1, 2)]
    dv = Q.dependency_violations(df, ["id"], "name").collect()
    assert [(r["id"], r["Distinctname"], r["Rows"]) for r in dv] == [(1, 2, 2)]
    unexpected = {r["Value"]: r["Rows"] for r in Q.unexpected_values(df, "id", allowed=[1]).collect()}
    assert unexpected == {"2": 1, None: 1}
    assert Q.missing_key_rows(df, ["id", "name"]).count() == 2
    counts = {r["TableName"]: r["Rows"] for r in Q.table_row_counts({"a": df, "b": df.limit(1)}).collect()}
    assert counts == {"a": 4, "b": 1}
    assert tuple(Q.entity_summary(df, {"Ids": "id", "Accts": "acct"}).first()) == (2, 3)
    dup = Q.duplicate_entities(df.fillna({"id": 9}), ["acct"], "id").collect()  # NULL ids are not ids
    assert [(r["acct"], r["DistinctIds"]) for r in dup] == [(3, 2)]


def test_unmatched_parents_excludes_sentinel(spark):
    dim = spark.createDataFrame([(-1, 0), (5, 0), (6, 3)], "OrganisationId long, BusinessUnitKey long")
    got = [r[0] for r in Q.unmatched_parents(dim, "OrganisationId", "BusinessUnitKey").collect()]
    assert got == [5]


def test_null_keys_are_spread_in_sort_merge_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(9000).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("bu"))
        dim = spark.range(40).select(F.col("id").alias("bu"), (F.col("id") + 100).alias("k"))
        out = lookup_key(fact, dim, "bu", "k")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        import re
        parts = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
        assert parts and all("_null_salt" in p for p in parts), parts
        got = {r["id"]: r["k"] for r in out.collect()}
        assert len(got) == 9000
        assert all(got[i] == (0 if i % 3 == 0 or i % 50 >= 40 else i % 50 + 100) for i in range(9000))
        assert orphans(fact, dim, "bu").count() == 3000 + sum(1 for i in range(9000) if i % 3 and i % 50 >= 40)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_resolve_distinct_equals_lookups_one_after_another(spark):
    from starpipe.operators.lookup import resolve_distinct, resolve_parent, star_lookup

    fact = spark.range(4000).select(
        "id", F.when(F.col("id") % 5 != 0, F.col("id") % 60).alias("e"), F.when(F.col("id") % 7 != 0, F.col("id") % 3).alias("a"),
        F.lit("old").alias("bu"))
    enr = spark.range(50).select(F.col("id").alias("e"), F.when(F.col("id") % 4 != 0, F.col("id") % 2).alias("bu"))
    att = spark.createDataFrame([(0, 0, 11), (0, 1, 12), (1, 2, 13), (1, 2, 14)], "bu long, a long, k int")   # (1, 2) fans out

    def chain(rows):
        return star_lookup(resolve_parent(rows, enr, "e", ["bu"]), [(att, ["bu", "a"], "k")])

    want = chain(fact).select("id", "e", "a", "bu", "k")
    for limit in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            got = resolve_distinct(fact, "e", "a", chain).fillna({"k": 0}).select("id", "e", "a", "bu", "k")
            assert got.count() == want.count() > 4000
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_with_unknown_member(spark):
    from starpipe.operators.lookup import with_unknown_member

    dim = spark.createDataFrame([(1, 10, "a")], "OrganisationKey long, OrganisationId long, Name string")
    got = {r["OrganisationKey"]: tuple(r) for r in with_unknown_member(dim, "OrganisationKey", "OrganisationId").collect()}
    assert got == {1: (1, 10, "a"), 0: (0, -1, None)}
    # the sentinel is what the unmatched-parent report leaves out
    assert Q.unmatched_parents(with_unknown_member(dim, "OrganisationKey", "OrganisationId")
                               .withColumn("BusinessUnitKey", F.lit(0)), "OrganisationId",
                               "BusinessUnitKey").count() == 1
