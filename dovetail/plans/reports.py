"""Report tables (ADS layer): 1 / 7 / 30-day figures for ``run_date``.

Each report reads the last 30 day folders of its stored 1-day tables, fans rows out to
the 1-, 7- and 30-day windows in one pass (``recent_days``) and merges metric
sets with ``union_group`` -- one shuffle where the reference chains full
outer joins.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from dovetail.operators.aggregates import ratio, recent_days, union_group
from dovetail.operators.joins import hierarchy, maybe_broadcast
from dovetail.plans import rollups as R_
from dovetail.plans.facts import FACT_MODEL
from dovetail.registry import query
from dovetail.sources import model
from dovetail.sources.model import RUN_DATE
from dovetail.sources.model_sql import with_model

WIN = (1, 7, 30)
R = f"DATE '{RUN_DATE}'"
HALF = Decimal("0.5")
_M1 = (*FACT_MODEL, "organ", "region_info")
_MT = ("transport_task", "organ", "dic", "region_info")


def windows(one, keys, measures):
    """1/7/30-day figures of a 1-day table, stamped with ``dt = run_date``."""
    return recent_days(one, keys, measures, RUN_DATE, windows=WIN).withColumn("dt", F.lit(RUN_DATE))


def windows_sql(one_sql, keys, measures, wins=WIN):
    vals = ", ".join(f"({w})" for w in wins)
    k = f"{keys}, " if keys else ""
    return f"""
    SELECT {k}w.recent_days, {measures}, '{RUN_DATE}' AS dt
    FROM ({one_sql}) one, (VALUES {vals}) AS w(recent_days)
    WHERE CAST(one.dt AS DATE) > {R} - w.recent_days AND CAST(one.dt AS DATE) <= {R}
    GROUP BY {k}w.recent_days"""


def _sum(*cols, prefix=""):
    return {f"{prefix}{c}": F.sum(c) for c in cols}


# -- orders ---------------------------------------------------------------------------------------

@query("report_orders", with_model(windows_sql(R_.ORDER_CARGO_1D_SQL, "",
       "sum(order_count) AS order_count, sum(order_amount) AS order_amount"), *_M1))
def report_orders(spark, sf_dir):
    one = R_.stored(spark, sf_dir, "order_cargo")
    return windows(one, [], _sum("order_count", "order_amount"))


@query("report_cargo_type", with_model(windows_sql(R_.ORDER_CARGO_1D_SQL, "cargo_type, cargo_type_name",
       "sum(order_count) AS order_count, sum(order_amount) AS order_amount"), *_M1))
def report_cargo_type(spark, sf_dir):
    one = R_.stored(spark, sf_dir, "order_cargo")
    return windows(one, ["cargo_type", "cargo_type_name"], _sum("order_count", "order_amount"))


def _union_group_sql(parts: list[tuple[str, list[str]]], keys: str) -> str:
    """SQL twin of union_group: every part padded with NULL metrics, one GROUP BY."""
    metrics: list[str] = []
    for _, ms in parts:
        metrics += [m for m in ms if m not in metrics]
    sels = []
    for sql, ms in parts:
        cols = ", ".join(m if m in ms else f"NULL AS {m}" for m in metrics)
        sels.append(f"SELECT {keys}, {cols} FROM ({sql}) p")
    aggs = ", ".join(f"sum({m}) AS {m}" for m in metrics)
    return f"SELECT {keys}, {aggs} FROM ({' UNION ALL '.join(sels)}) u GROUP BY {keys}"


@query("report_order_stats", with_model(_union_group_sql([
    (windows_sql(R_.RECEIVE_1D_SQL, "", "sum(order_count) AS receive_order_count, "
                 "sum(order_amount) AS receive_order_amount"), ["receive_order_count", "receive_order_amount"]),
    (windows_sql(R_.DISPATCH_1D_SQL, "", "sum(order_count) AS dispatch_order_count, "
                 "sum(order_amount) AS dispatch_order_amount"), ["dispatch_order_count", "dispatch_order_amount"]),
], "dt, recent_days"), *_M1))
def report_order_stats(spark, sf_dir):
    rec = windows(R_.stored(spark, sf_dir, "receive"), [],
                  {"receive_order_count": F.sum("order_count"), "receive_order_amount": F.sum("order_amount")})
    dis = windows(R_.stored(spark, sf_dir, "dispatch"), [],
                  {"dispatch_order_count": F.sum("order_count"), "dispatch_order_amount": F.sum("order_amount")})
    return union_group([rec, dis], ["dt", "recent_days"])


@query("report_in_transit_td", with_model(f"""
    SELECT dt, sum(order_count) AS bounding_order_count, sum(order_amount) AS bounding_order_amount
    FROM (SELECT dt, order_total_count AS order_count, order_total_amount AS order_amount
          FROM (SELECT sum(order_count) AS order_total_count, sum(order_amount) AS order_total_amount,
                       '{RUN_DATE}' AS dt
                FROM ({R_.DISPATCH_1D_SQL}) one WHERE CAST(one.dt AS DATE) <= {R}) d
          UNION ALL
          SELECT dt, -order_count, -order_amount
          FROM (SELECT count(order_id) AS order_count, sum(amount) AS order_amount, '{RUN_DATE}' AS dt
                FROM (SELECT order_id, max(amount) AS amount FROM ({R_.milestone_sql('bound_finish')}) x
                      WHERE CAST(dt AS DATE) <= {R} GROUP BY order_id) g) f) u
    GROUP BY dt""", *FACT_MODEL))
def report_in_transit_td(spark, sf_dir):
    """Orders dispatched to date minus orders finished to date (negated union + sum)."""
    d = R_.rollup_dispatch_td(spark, sf_dir).select(
        "dt", F.col("order_total_count").alias("order_count"), F.col("order_total_amount").alias("order_amount"))
    f = R_.rollup_finish_td(spark, sf_dir).select(
        "dt", (-F.col("order_count")).alias("order_count"), (-F.col("order_amount")).alias("order_amount"))
    return d.unionByName(f).groupBy("dt").agg(F.sum("order_count").alias("bounding_order_count"),
                                              F.sum("order_amount").alias("bounding_order_amount"))


# -- trips ------------------------------------------------------------------------------------------

_TRIP_MEASURES = ("sum(trans_finish_count) AS trans_finish_count, "
                  "sum(trans_finish_distance) AS trans_finish_distance, "
                  "sum(trans_finish_dur_sec) AS trans_finish_dur_sec")
_TRIPS = ("trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec")


@query("report_trans_stats", with_model(windows_sql(R_.TRIPS_1D_SQL, "", _TRIP_MEASURES), *_MT))
def report_trans_stats(spark, sf_dir):
    return windows(R_.stored(spark, sf_dir, "trips"), [], _sum(*_TRIPS))


def _avg_cols():
    return [ratio(F.col("trans_finish_distance"), F.col("trans_finish_count")).alias("avg_trans_finish_distance"),
            ratio(F.col("trans_finish_dur_sec"), F.col("trans_finish_count")).alias("avg_trans_finish_dur_sec")]


_AVG_SQL = ("CAST(trans_finish_distance AS DOUBLE) / NULLIF(CAST(trans_finish_count AS DOUBLE), 0) "
            "AS avg_trans_finish_distance, CAST(trans_finish_dur_sec AS DOUBLE) / "
            "NULLIF(CAST(trans_finish_count AS DOUBLE), 0) AS avg_trans_finish_dur_sec")


@query("report_truck_stats", with_model(f"""
    SELECT *, {_AVG_SQL} FROM ({windows_sql(R_.TRIPS_1D_SQL, 'truck_model_type, truck_model_type_name',
                                            _TRIP_MEASURES)}) x""", *_MT))
def report_truck_stats(spark, sf_dir):
    w = windows(R_.stored(spark, sf_dir, "trips"), ["truck_model_type", "truck_model_type_name"], _sum(*_TRIPS))
    return w.select("*", *_avg_cols())


@query("report_shift_stats", with_model(f"""
    SELECT dt, recent_days, shift_id, trans_finish_count, trans_finish_distance, trans_finish_dur_sec
    FROM ({R_.SHIFT_ND_SQL}) x""", "transport_task", "organ", "dic"))
def report_shift_stats(spark, sf_dir):
    return R_.shift_nd(spark, sf_dir).select("dt", "recent_days", "shift_id", *_TRIPS)


@query("report_line_stats", with_model(f"""
    SELECT dt, recent_days, line_id, {_TRIP_MEASURES}
    FROM ({R_.SHIFT_ND_SQL}) x GROUP BY dt, recent_days, line_id""", "transport_task", "organ", "dic"))
def report_line_stats(spark, sf_dir):
    return R_.shift_nd(spark, sf_dir).groupBy("dt", "recent_days", "line_id").agg(
        *[F.sum(c).alias(c) for c in _TRIPS])


@query("report_driver_stats", with_model(f"""
    SELECT dt, recent_days, driver_id, sum(trans_finish_count) AS trans_finish_count,
           sum(trans_finish_distance) AS trans_finish_distance, sum(trans_finish_dur_sec) AS trans_finish_dur_sec,
           CAST(sum(trans_finish_distance) AS DOUBLE) / CAST(sum(trans_finish_count) AS DOUBLE)
               AS avg_trans_finish_distance,
           CAST(sum(trans_finish_dur_sec) AS DOUBLE) / CAST(sum(trans_finish_count) AS DOUBLE)
               AS avg_trans_finish_dur_sec
    FROM (SELECT dt, recent_days, driver1_emp_id AS driver_id, trans_finish_count,
                 CAST(trans_finish_distance AS DECIMAL(38,3)) AS trans_finish_distance,
                 CAST(trans_finish_dur_sec AS DECIMAL(38,1)) AS trans_finish_dur_sec
          FROM ({R_.SHIFT_ND_SQL}) s WHERE driver2_emp_id IS NULL
          UNION ALL
          SELECT dt, recent_days, unnest([driver1_emp_id, driver2_emp_id]) AS driver_id, trans_finish_count,
                 trans_finish_distance * 0.5, trans_finish_dur_sec * 0.5
          FROM ({R_.SHIFT_ND_SQL}) s WHERE driver2_emp_id IS NOT NULL) t
    GROUP BY dt, recent_days, driver_id""", "transport_task", "organ", "dic"))
def report_driver_stats(spark, sf_dir):
    """Single-driver trips count fully; a two-driver trip gives each driver
    one trip and half its distance and duration."""
    s = R_.shift_nd(spark, sf_dir)
    # one pass: a row gives its driver the whole trip, or each of two drivers half of it
    shared = F.col("driver2_emp_id").isNotNull()
    drivers = F.when(shared, F.array("driver1_emp_id", "driver2_emp_id")).otherwise(F.array("driver1_emp_id"))

    def part(c: str, kind: str):
        return F.when(shared, (F.col(c) * F.lit(HALF)).cast(kind)).otherwise(F.col(c).cast(kind)).alias(c)

    g = s.select("dt", "recent_days", F.explode(drivers).alias("driver_id"), "trans_finish_count",
                 part("trans_finish_distance", "decimal(38,3)"), part("trans_finish_dur_sec", "decimal(38,1)"))
    g = g.groupBy("dt", "recent_days", "driver_id").agg(*[F.sum(c).alias(c) for c in _TRIPS])
    return g.select("*", *_avg_cols())


# -- area reports: orders + trips, express ------------------------------------------------------------

def _trips_area_1d(spark, sf_dir):
    """Trips per org with the org's city (district -> city walk)."""
    t = R_.stored(spark, sf_dir, "trips")
    org = model.organ(spark, sf_dir).select(F.col("id").alias("__oid"), "region_id")
    j = t.join(maybe_broadcast(org), t.org_id == F.col("__oid"), "left")
    return hierarchy(j, "region_id", model.region_info(spark, sf_dir), ["city"])


_TRIPS_AREA_SQL = f"""
    SELECT t.*, c.id AS city_id, c.name AS city_name
    FROM ({R_.TRIPS_1D_SQL}) t LEFT JOIN organ o ON t.org_id = o.id
    LEFT JOIN region_info dd ON o.region_id = dd.id LEFT JOIN region_info c ON dd.parent_id = c.id"""


def _order_trip_report(spark, sf_dir, keys):
    orders = windows(R_.stored(spark, sf_dir, "order_cargo"), keys, _sum("order_count", "order_amount"))
    trips = windows(_trips_area_1d(spark, sf_dir), keys, _sum(*_TRIPS))
    return union_group([orders, trips], ["dt", "recent_days", *keys]).select("*", *_avg_cols())


def _order_trip_sql(keys):
    o = windows_sql(R_.ORDER_CARGO_1D_SQL, keys, "sum(order_count) AS order_count, sum(order_amount) AS order_amount")
    t = windows_sql(_TRIPS_AREA_SQL, keys, _TRIP_MEASURES)
    u = _union_group_sql([(o, ["order_count", "order_amount"]), (t, list(_TRIPS))], f"dt, recent_days, {keys}")
    return f"SELECT *, {_AVG_SQL} FROM ({u}) x"


@query("report_city_stats", with_model(_order_trip_sql("city_id, city_name"), *_M1, "transport_task"))
def report_city_stats(spark, sf_dir):
    return _order_trip_report(spark, sf_dir, ["city_id", "city_name"])


@query("report_org_stats", with_model(_order_trip_sql("org_id, org_name"), *_M1, "transport_task"))
def report_org_stats(spark, sf_dir):
    """Orders and trips per organisation; both legs kept (the reference's
    inner join of the n-day legs would drop organisations with one side)."""
    return _order_trip_report(spark, sf_dir, ["org_id", "org_name"])


def _express(spark, sf_dir, keys):
    parts = [windows(R_.stored(spark, sf_dir, "deliver"), keys, {"deliver_suc_count": F.sum("order_count")}),
             windows(R_.stored(spark, sf_dir, "org_sort"), keys, {"sort_count": F.sum("sort_count")})]
    if keys:
        parts.append(windows(R_.stored(spark, sf_dir, "receive"), keys,
                             {"receive_order_count": F.sum("order_count"),
                              "receive_order_amount": F.sum("order_amount")}))
    return union_group(parts, ["dt", "recent_days", *keys])


def _express_sql(keys):
    parts = [(windows_sql(R_.DELIVER_1D_SQL, keys, "sum(order_count) AS deliver_suc_count"), ["deliver_suc_count"]),
             (windows_sql(R_.ORG_SORT_1D_SQL, keys, "sum(sort_count) AS sort_count"), ["sort_count"])]
    if keys:
        parts.append((windows_sql(R_.RECEIVE_1D_SQL, keys, "sum(order_count) AS receive_order_count, "
                                  "sum(order_amount) AS receive_order_amount"),
                      ["receive_order_count", "receive_order_amount"]))
    return _union_group_sql(parts, "dt, recent_days" + (f", {keys}" if keys else ""))


_ME = (*_M1, "order_org_bound")


@query("report_express_stats", with_model(_express_sql(""), *_ME))
def report_express_stats(spark, sf_dir):
    return _express(spark, sf_dir, [])


@query("report_express_province", with_model(_express_sql("province_id, province_name"), *_ME))
def report_express_province(spark, sf_dir):
    return _express(spark, sf_dir, ["province_id", "province_name"])


@query("report_express_city", with_model(_express_sql("city_id, city_name"), *_ME))
def report_express_city(spark, sf_dir):
    return _express(spark, sf_dir, ["city_id", "city_name"])


@query("report_express_org", with_model(_express_sql("org_id, org_name"), *_ME))
def report_express_org(spark, sf_dir):
    return _express(spark, sf_dir, ["org_id", "org_name"])
