import random

from starpipe.operators.fuzzy import near_duplicate_entities


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1:] or (len(a) == len(b) and a[i + 1:] == b[i + 1:])


def brute(rows):
    own = [(k, " ".join(n.lower().split()), i) for k, n, i in rows if None not in (k, n, i)]
    ids = sorted({i for _, _, i in own})
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x, (k, a, i) in enumerate(own):
        for k2, b, j in own[:x]:
            if k == k2 and distance_one(a, b):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    size = {}
    for i in ids:
        size[root(i)] = size.get(root(i), 0) + 1
    return sorted((i, root(i), size[root(i)]) for i in ids if size[root(i)] > 1)


def got(spark, rows):
    df = spark.createDataFrame(rows, "k long, name string, id long")
    return sorted(tuple(r) for r in near_duplicate_entities(df, ["k"], "name", "id").collect())


def misspelt(rng, name):
    i = rng.randrange(len(name))
    return rng.choice([name[:i] + name[i + 1:], name[:i] + rng.choice("abcxyz") + name[i + 1:], name[:i] + rng.choice("abcxyz") + name[i:]])


def test_planted_misspellings_are_all_found(spark):
    rng = random.Random(7)
    rows, planted = [], set()
    for i in range(0, 600, 2):
        name = "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 12)))
        rows.append((i % 5, name, i))
        if rng.random() < 0.4:
            rows.append((i % 5, misspelt(rng, name).upper(), i + 1))
            planted.add(i + 1)
    rows += [(None, "abc", 9001), (1, None, 9002), (1, "abc", None), (3, "", 9003), (3, "q", 9004), (3, "q", 9004), (3, "Same  Name", 9005), (3, " same name", 9006)]
    groups = got(spark, rows)
    assert groups == brute(rows)
    assert planted <= {i for i, _, _ in groups}     # recall 1


def test_one_block_of_many_names_is_not_cut(spark):
    """All names of one nation, two letters each: 676 names in one group, and 2,000 equal ones."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(1, a + b, i * 26 + j) for i, a in enumerate(letters) for j, b in enumerate(letters)]
    rows += [(2, "equal name", 10_000 + i) for i in range(2000)]
    groups = got(spark, rows)
    assert len(groups) == 2676 and {g for _, g, _ in groups} == {0, 10_000}


def test_empty(spark):
    assert got(spark, []) == []
