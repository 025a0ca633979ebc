"""Running sets, time-binned and as-of joins against plain Python."""

import random
from collections import defaultdict

from dovetail.operators.joins import asof_lookup, binned_interval_join
from dovetail.plans.labels import running_sets


def test_running_sets_of_a_busy_key(spark):
    """One user with 15,000 records over many pieces, others with few, repeated times and null values."""
    rng = random.Random(3)
    rows = [(i, 1 if i < 15_000 else rng.randrange(2, 6), rng.randrange(10**7), rng.choice(["a", "b", "c", None, f"v{rng.randrange(30)}"]))
            for i in range(15_200)]
    df = spark.createDataFrame(rows, "id long, k long, ms long, v string").repartition(5)
    got = {r["id"]: (r["n"], r["vs"]) for r in running_sets(df, "k", ["ms", "id"], "ms", {"vs": "v"}, "n", piece_ms=10**5).collect()}
    seen, n = defaultdict(set), defaultdict(int)
    for i, k, _, v in sorted(rows, key=lambda r: (r[2], r[0])):
        n[k] += 1
        seen[k] |= {v} - {None}
        assert got[i] == (n[k], ",".join(sorted(seen[k])))
    p = running_sets(df, "k", ["ms", "id"], "ms", {"vs": "v"}, "n")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in p and "__p#" in p  # rows are dealt by key and piece


def test_binned_interval_join(spark):
    rng = random.Random(4)
    left = [(i, rng.randrange(3), rng.randrange(-500, 2000)) for i in range(300)]
    right = [(i, rng.randrange(3), rng.randrange(-500, 2000)) for i in range(300)]
    lf, rt = spark.createDataFrame(left, "a long, k long, x long"), spark.createDataFrame(right, "b long, k long, y long")
    for before, after in ((20, 20), (0, 50), (100, 0), (0, 0)):
        j = binned_interval_join(lf, rt, "k", "x", "y", before, after)
        got = sorted((r["a"], r["b"]) for r in j.collect())
        assert got == sorted((a, b) for a, k, x in left for b, q, y in right if k == q and x - before <= y <= x + after)
        p = j._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_asof_lookup_takes_the_version_of_the_time(spark):
    v = spark.createDataFrame([("1", "old", 0), ("1", "new", 100), ("2", "late", 50)], "code string, name string, since bigint")
    rows = spark.createDataFrame([("1", 99), ("1", 100), ("1", 10**6), ("2", 49), ("2", 50), ("3", 5), (None, 5), ("1", None)], "c string, t bigint")
    got = {(r["c"], r["t"]): r["n"] for r in asof_lookup(rows, v, "c", "t", "n").collect()}
    assert got == {("1", 99): "old", ("1", 100): "new", ("1", 10**6): "new", ("2", 49): None, ("2", 50): "late", ("3", 5): None,
                   (None, 5): None, ("1", None): None}
