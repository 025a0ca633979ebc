"""Operator semantics on small hand-written fixtures."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from dovetail.operators.aggregates import order_grain, ratio, recent_days, union_group
from dovetail.operators.joins import decode, hierarchy, interval_join, overlay, prefixed
from dovetail.operators.windows import latest_per_key, zipper_merge


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_decode_missing_code_and_no_fanout(spark):
    facts = spark.createDataFrame([(1, "A"), (2, "B"), (3, "Z")], "id int, code string")
    dic = spark.createDataFrame([("A", "alpha"), ("A", "alpha2"), ("B", "beta")], "id string, name string")
    out = decode(facts, "code", dic, "code_name")
    assert rows(out, "id") == [(1, "A", "alpha"), (2, "B", "beta"), (3, "Z", None)]
    out2 = decode(facts, "code", dic, "code_name", default="N/A")
    assert rows(out2, "id")[2] == (3, "Z", "N/A")


def test_decode_roles_same_dictionary(spark):
    facts = spark.createDataFrame([(1, "A", "B")], "id int, s string, t string")
    dic = spark.createDataFrame([("A", "alpha"), ("B", "beta")], "id string, name string")
    out = decode(decode(facts, "s", dic, "s_name"), "t", dic, "t_name")
    assert rows(out) == [(1, "A", "B", "alpha", "beta")]


def test_hierarchy_walk(spark):
    tree = spark.createDataFrame([(1, 0, "P"), (10, 1, "C"), (100, 10, "D")], "id long, parent_id long, name string")
    df = spark.createDataFrame([(7, 100), (8, 999)], "k int, district long")
    out = hierarchy(df, "district", tree, ["city", "province"])
    assert rows(out.select("k", "city_id", "city_name", "province_id", "province_name"), "k") == [
        (7, 10, "C", 1, "P"), (8, None, None, None, None)]


def test_interval_join_bounds_inclusive(spark):
    base = datetime(2024, 1, 1, 12, 0, 0)
    left = spark.createDataFrame([(1, base)], "k int, t timestamp")
    right = spark.createDataFrame([
        (1, datetime(2024, 1, 1, 11, 30, 0), "at -30m"), (1, datetime(2024, 1, 1, 11, 29, 59), "before"),
        (1, datetime(2024, 1, 1, 12, 0, 5), "at +5s"), (1, datetime(2024, 1, 1, 12, 0, 6), "after"),
        (2, base, "other key")], "k int, rt timestamp, tag string")
    j = interval_join(left, right, "k", "t", "rt", "-30 minutes", "5 seconds")
    assert sorted(r.tag for r in j.select("r.tag").collect()) == ["at +5s", "at -30m"]


def test_prefixed_and_overlay(spark):
    l = spark.createDataFrame([(1, "a", None)], "k int, x string, g string")
    r = spark.createDataFrame([(1, None, "F")], "k int, x string, g string")
    assert prefixed(l, "info_", keep=["k"]).columns == ["k", "info_x", "info_g"]
    assert rows(overlay(l, r, ["k"])) == [(1, "a", "F")]   # right wins only when not null


def test_order_grain_collapses_repeated_amount(spark):
    d = spark.createDataFrame([(1, "2024-01-01", Decimal("10.00")), (1, "2024-01-01", Decimal("10.00")),
                               (2, "2024-01-01", Decimal("5.00"))], "order_id int, dt string, amount decimal(16,2)")
    g = order_grain(d, ["order_id", "dt"], "amount").groupBy("dt").agg(F.count("*").alias("n"),
                                                                      F.sum("amount").alias("s"))
    assert rows(g) == [("2024-01-01", 2, Decimal("15.00"))]


def test_recent_days_window_edges(spark):
    run = "2024-02-29"
    days = ["2024-02-29", "2024-02-23", "2024-02-22", "2024-01-31", "2024-01-30"]   # -0, -6, -7, -29, -30
    df = spark.createDataFrame([(d, 1) for d in days], "dt string, n int")
    out = {r.recent_days: r.n for r in recent_days(df, [], {"n": F.sum("n")}, run, windows=(1, 7, 30)).collect()}
    assert out == {1: 1, 7: 2, 30: 4}


def test_union_group_keeps_one_sided_keys(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, m1 int")
    b = spark.createDataFrame([("y", 5), ("z", 7)], "k string, m2 int")
    assert rows(union_group([a, b], ["k"]), "k") == [("x", 1, None), ("y", 2, 5), ("z", None, 7)]


def test_ratio_null_on_zero(spark):
    df = spark.createDataFrame([(10, 4), (1, 0)], "a int, b int")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [2.5, None]


def test_latest_per_key_tie_break(spark):
    df = spark.createDataFrame([(1, 5, 1, "old"), (1, 9, 1, "a"), (1, 9, 2, "b"), (2, 3, 1, "c")],
                               "k int, ts int, seq int, v string")
    assert rows(latest_per_key(df, ["k"], ["ts", "seq"]), "k") == [(1, 9, 2, "b"), (2, 3, 1, "c")]


def test_zipper_merge_closes_and_opens(spark):
    hist = spark.createDataFrame([(1, "a", "2024-01-01", "9999-12-31"), (2, "b", "2024-01-01", "9999-12-31"),
                                  (1, "z", "2023-01-01", "2023-12-31")],
                                 "id int, v string, start_date string, end_date string")
    chg = spark.createDataFrame([(1, "a2", None, None), (3, "c", None, None)],
                                "id int, v string, start_date string, end_date string")
    out = rows(zipper_merge(hist, chg, "id", "2024-01-05"), "id", "start_date")
    assert out == [(1, "z", "2023-01-01", "2023-12-31"), (1, "a", "2024-01-01", "2024-01-04"),
                   (1, "a2", "2024-01-05", "9999-12-31"), (2, "b", "2024-01-01", "9999-12-31"),
                   (3, "c", "2024-01-05", "9999-12-31")]
    # intervals of one key never overlap
    ones = [r for r in out if r[0] == 1]
    for a, b in zip(ones, ones[1:]):
        assert a[3] < b[2]


def test_zipper_merge_twice_changes_nothing(spark):
    schema = "id int, v string, start_date string, end_date string"
    hist = spark.createDataFrame([(1, "a", "2024-01-01", "9999-12-31"), (2, "b", "2024-01-01", "9999-12-31")], schema)
    chg = spark.createDataFrame([(1, "a2", None, None), (1, "a3", None, None), (3, "c", None, None)], schema)
    once = zipper_merge(hist, chg, "id", "2024-01-05", order=["v"])
    # of two changes on one day the last stays
    assert rows(once, "id", "start_date") == [
        (1, "a", "2024-01-01", "2024-01-04"), (1, "a3", "2024-01-05", "9999-12-31"), (2, "b", "2024-01-01", "9999-12-31"),
        (3, "c", "2024-01-05", "9999-12-31")]
    assert rows(zipper_merge(once, chg, "id", "2024-01-05", order=["v"]), "id", "start_date") == rows(once, "id", "start_date")
    # a corrected change set takes back what the first run did
    fixed = zipper_merge(once, chg.where("id = 3"), "id", "2024-01-05")
    assert rows(fixed, "id", "start_date") == [(1, "a", "2024-01-01", "9999-12-31"), (2, "b", "2024-01-01", "9999-12-31"),
                                               (3, "c", "2024-01-05", "9999-12-31")]


def test_a_value_that_is_not_there_scores_nothing(spark):
    from dovetail.plans.labels import FACTORS, apply_scores
    family = next(f for f, v, _ in FACTORS if v == "*")
    df = spark.createDataFrame([(1, None), (2, "no such value")], "user_id int, c string")
    out = apply_scores(df, {family: F.col("c")}, ["user_id"], spark)
    assert {r.user_id for r in out.collect()} == {2}


def test_zipper_store_touches_open_versions_and_one_day(spark):
    """Three days of changes, the second run twice: as a plain replay in Python."""
    import os

    from dovetail.session import scratch_dir
    from dovetail.sources.zipper import ZipperStore
    schema = "id int, v string, start_date string, end_date string"
    z = ZipperStore(scratch_dir(spark, "t-zip"), "id")
    z.begin(spark.createDataFrame([(i, "a", "2024-01-01", "9999-12-31") for i in range(5)], schema), "2024-01-01")
    days = [("2024-01-02", [(0, "b"), (7, "n")]), ("2024-01-03", [(0, "c"), (1, "c"), (1, "d")]), ("2024-01-03", [(0, "c"), (1, "d")]),
            ("2024-01-05", [(7, "m")])]
    for day, rows_ in days:
        before = {d: set(os.listdir(f"{z.path}/as_of={d}")) for d in z.days(spark) if d != day}
        z.merge(spark.createDataFrame([(*r, None, None) for r in rows_], schema), day, order=["v"])
        assert before == {d: set(os.listdir(f"{z.path}/as_of={d}")) for d in before}  # nothing else is written
    got = sorted(tuple(r) for r in z.read(spark, spark.createDataFrame([], schema).schema).select("id", "v", "start_date", "end_date").collect())
    o = "9999-12-31"
    assert got == sorted([(0, "a", "2024-01-01", "2024-01-01"), (0, "b", "2024-01-02", "2024-01-02"), (0, "c", "2024-01-03", o),
                          (1, "a", "2024-01-01", "2024-01-02"), (1, "d", "2024-01-03", o), (2, "a", "2024-01-01", o),
                          (3, "a", "2024-01-01", o), (4, "a", "2024-01-01", o), (7, "n", "2024-01-02", "2024-01-04"),
                          (7, "m", "2024-01-05", o)])
