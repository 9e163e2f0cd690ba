import random
from itertools import combinations

from pyspark.sql import functions as F

from starpipe.operators.profiles import dependency_lattice, merge_profiles, profile_sketches


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_sketches_of_loads_equal_the_sketch_of_all(spark):
    df = spark.range(60_000).select(F.col("id"), (F.col("id") % 1000).alias("m"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("few"),
                                    F.lit(None).cast("string").alias("none"))
    loads = [profile_sketches(df.where(f"id % 3 = {i}")) for i in range(3)]
    merged = rows_of(merge_profiles(loads[0].unionByName(loads[1]).unionByName(loads[2])))
    assert merged == rows_of(merge_profiles(profile_sketches(df)))
    got = {r[0]: r[1:] for r in merged}
    assert got["none"] == (60_000, 60_000, 0) and got["few"] == (60_000, 12_000, 7)
    assert abs(got["id"][2] - 60_000) < 0.03 * 60_000 and abs(got["m"][2] - 1000) < 30


def test_sketch_of_an_empty_load(spark):
    df = spark.range(10).selectExpr("id AS k")
    both = profile_sketches(df).unionByName(profile_sketches(df.where("false")))
    assert rows_of(merge_profiles(both)) == [("k", 10, 0, 10)]


def test_lattice_equals_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        a, b = rng.randrange(12), rng.choice([None, 0, 1, 2])
        rows.append((a, b, a // 3, (a + (b or 0)) % 5 if b is not None else None, rng.randrange(3)))
    names = ["a", "b", "c", "d", "e"]
    got = rows_of(dependency_lattice(spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names)), names, 3))

    def count(x, y):
        seen = {}
        for r in rows:
            seen.setdefault(tuple(r[names.index(c)] for c in x), set()).add(r[names.index(y)])
        return len(seen), sum(len(v) > 1 for v in seen.values())
    want = [("+".join(x), y, *count(x, y)) for n in (1, 2, 3) for x in combinations(names, n) for y in names if y not in x
            and not any(count(s, y)[1] == 0 for m in range(1, n) for s in combinations(x, m))]
    assert got == sorted(want)
    assert any(r[0] == "a" and r[1] == "c" and r[3] == 0 for r in got) and any(r[0] == "a+b" and r[1] == "d" and r[3] == 0 for r in got)
