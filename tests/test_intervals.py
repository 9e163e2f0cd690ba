import datetime as dt
import random
from collections import defaultdict

import pytest

from starpipe.operators.intervals import concurrency
from tests.test_plans import _plan

DAY = dt.datetime(2024, 1, 1)


def brute(rows):
    """Steps (key, at, until, level) by counting the open intervals at every change."""
    spans = defaultdict(list)
    for k, a, b in rows:
        if a is not None and b is not None and b > a:
            spans[k].append((a, b))
    out = []
    for k, own in spans.items():
        moments = sorted({m for s in own for m in s})
        out += [(k, m, n, sum(a <= m < b for a, b in own)) for m, n in zip(moments, [*moments[1:], None])]
    return sorted(out, key=str)


def rows_of(seed, n=400):
    rng = random.Random(seed)
    at = lambda: DAY + dt.timedelta(minutes=rng.randrange(600))
    rows = [(rng.choice(["a", "a", "a", "b", "c", None]), at(), at()) for _ in range(n)]
    return rows + [("a", None, DAY), ("a", DAY, None), ("d", DAY, DAY), (None, None, None)] + [("e", DAY, DAY + dt.timedelta(hours=1))] * 3


@pytest.mark.parametrize("partitions", [1, 7, 60, 200])
def test_steps_equal_brute_force(spark, partitions):
    rows = rows_of(partitions)
    df = spark.createDataFrame(rows, "k string, a timestamp_ntz, b timestamp_ntz")
    got = concurrency(df, ["k"], "a", "b", partitions=partitions).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "k string, a timestamp_ntz, b timestamp_ntz")
    assert concurrency(df, ["k"], "a", "b").collect() == []


def test_no_range_join_and_no_window_over_a_key(spark):
    rows = [("hot", DAY + dt.timedelta(minutes=i), DAY + dt.timedelta(minutes=i + 50)) for i in range(5000)]
    plan = _plan(concurrency(spark.createDataFrame(rows, "k string, a timestamp_ntz, b timestamp_ntz"), ["k"], "a", "b", partitions=9))
    final = plan.split("Initial Plan")[0]
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "hashpartitioning(k" not in final
