"""Whole-table invariants on the sf0.01 tables."""

from collections import defaultdict

from pyspark.sql import functions as F

from dovetail.registry import load_all

SF01 = "/root/testdata/sf0.01"
Q = load_all()


def q(spark, key):
    return Q[key].build(spark, SF01)


def test_seven_day_never_exceeds_thirty_day(spark):
    for key, metric, keys in [("report_orders", "order_count", []),
                              ("report_cargo_type", "order_count", ["cargo_type"]),
                              ("rollup_receive_nd", "order_count", ["org_id", "city_id", "province_id"])]:
        by = defaultdict(dict)
        for r in q(spark, key).collect():
            by[tuple(r[k] for k in keys)][r.recent_days] = r[metric]
        for k, d in by.items():
            if 7 in d:
                assert 30 in d and d[7] <= d[30], (key, k, d)


def test_module_shares_sum_to_one_per_page(spark):
    for r in q(spark, "page_module_share").groupBy("page_id").agg(F.sum("click_share").alias("s")).collect():
        assert abs(r.s - 1.0) < 1e-9


def test_driver_halves_sum_to_trip_totals(spark):
    shifts = q(spark, "rollup_shift_nd").groupBy("recent_days").agg(
        F.sum("trans_finish_distance").alias("d"), F.sum("trans_finish_dur_sec").alias("s"))
    drivers = q(spark, "report_driver_stats").groupBy("recent_days").agg(
        F.sum("trans_finish_distance").alias("d"), F.sum("trans_finish_dur_sec").alias("s"))
    a = {r.recent_days: (r.d, r.s) for r in shifts.collect()}
    b = {r.recent_days: (r.d, r.s) for r in drivers.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert float(a[k][0]) == float(b[k][0]) and float(a[k][1]) == float(b[k][1])


def test_zipper_intervals_do_not_overlap(spark):
    z = q(spark, "dim_user_zip")
    rows = sorted((r.id, r.start_date, r.end_date) for r in z.collect())
    for (i1, s1, e1), (i2, s2, e2) in zip(rows, rows[1:]):
        if i1 == i2:
            assert e1 < s2
    open_per_key = z.where(F.col("end_date") == "9999-12-31").groupBy("id").count()
    assert open_per_key.where(F.col("count") != 1).count() == 0
    assert open_per_key.count() == z.select("id").distinct().count()


def test_rerunning_a_guarded_load_changes_nothing(spark):
    rows = {r.step: (r.status, r.n) for r in q(spark, "load_if_absent").collect()}
    assert rows["first"][1] == rows["second"][1]
    assert rows["second"][0] == ("skipped" if rows["first"][1] > 0 else "loaded")


def test_in_transit_equals_dispatched_minus_finished(spark):
    d = q(spark, "rollup_dispatch_td").collect()[0]
    f = q(spark, "rollup_finish_td").collect()[0]
    t = q(spark, "report_in_transit_td").collect()[0]
    assert t.bounding_order_count == d.order_total_count - f.order_count
    assert t.bounding_order_amount == d.order_total_amount - f.order_amount
