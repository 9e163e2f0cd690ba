"""Property tests for the two operators with the most custom logic."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starpipe.operators.dedup import version_history
from starpipe.operators.lookup import lookup_key
from tests.test_conform_dedup import LATEST_ROWS, _history_oracle

BASE = dt.datetime(2020, 1, 1)

version_rows = st.lists(
    st.tuples(
        st.sampled_from([0, 0, 0, 1, 2, 3, 4, 5]),                 # skewed keys
        st.one_of(st.none(), st.booleans()),
        st.one_of(st.none(), st.integers(0, 50)),                  # UpdatedOn offset (ties possible)
        st.integers(0, 10_000),                                    # CreatedOn offset
    ),
    min_size=1, max_size=120)


@settings(max_examples=6, deadline=None)
@given(version_rows, st.integers(1, 12))
def test_version_history_matches_window_form(spark, rows, buckets):
    data = [(k, a, None if u is None else BASE + dt.timedelta(days=u), BASE + dt.timedelta(minutes=c), str(i))
            for i, (k, a, u, c) in enumerate(rows)]
    df = spark.createDataFrame(data, LATEST_ROWS)
    got = version_history(df, ["k"], partitions=buckets)
    want = _history_oracle(df, ["k"])
    # ranks among rows tied on the whole order are interchangeable: compare
    # everything but the tag, which identifies the row
    cols = [c for c in want.columns if c != "tag"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=200))
def test_salted_lookup_equals_plain_left_join(spark, keys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k long")
        dim = spark.createDataFrame([(k, k * 10) for k in range(0, 5)], "k long, key long")
        got = lookup_key(fact, dim, "k", "key", default=None)
        want = fact.join(dim, "k", "left")
        assert got.select("id", "k", "key").exceptAll(want.select("id", "k", "key")).count() == 0
        assert got.count() == len(keys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
