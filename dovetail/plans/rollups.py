"""1-day, n-day and to-date summaries (DWS layer).

1-day tables are computed for every day at once (dynamic ``dt``); n-day
tables read only the widest window before ``run_date`` and fan rows out to
the 7- and 30-day windows in one pass; to-date tables aggregate all history
up to ``run_date``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dovetail.operators.aggregates import order_grain, recent_days
from dovetail.operators.joins import decode, hierarchy, maybe_broadcast
from dovetail.plans.facts import FACT_MODEL, MILESTONES, by_milestone, order_detail, \
    order_detail_sql, trans_finish
from dovetail.registry import query
from dovetail.sources import model
from dovetail.sources.daily import Daily, read_days
from dovetail.sources.model import RUN_DATE
from dovetail.sources.model_sql import with_model

R = f"DATE '{RUN_DATE}'"


def _org(spark, sf_dir, cols=("id", "org_name", "region_id")):
    return maybe_broadcast(model.organ(spark, sf_dir).select(*cols))


# -- order by org x city x cargo type ---------------------------------------------------------

def order_cargo_1d(spark: SparkSession, sf_dir: str, days=None) -> DataFrame:
    d = order_detail(spark, sf_dir, days=days)
    g = order_grain(d, ["order_id", "cargo_type", "cargo_type_name", "sender_district_id",
                        "sender_city_id", "dt"], "amount")
    org = _org(spark, sf_dir).withColumnRenamed("id", "org_id")
    agg = (g.join(org, g.sender_district_id == org.region_id, "left")
            .groupBy("org_id", "org_name", "cargo_type", "cargo_type_name",
                     F.col("sender_city_id").alias("city_id"), "dt")
            .agg(F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount")))
    city = maybe_broadcast(model.region_info(spark, sf_dir).select(F.col("id").alias("__cid"),
                                                                   F.col("name").alias("city_name")))
    return agg.join(city, agg.city_id == city["__cid"], "left").drop("__cid")


ORDER_CARGO_1D_SQL = f"""
    SELECT org_id, org_name, city_id, r.name AS city_name, cargo_type, cargo_type_name,
           order_count, order_amount, dt
    FROM (SELECT o.id AS org_id, o.org_name, g.sender_city_id AS city_id, cargo_type, cargo_type_name,
                 count(order_id) AS order_count, sum(amount) AS order_amount, dt
          FROM (SELECT order_id, cargo_type, cargo_type_name, sender_district_id, sender_city_id,
                       max(amount) AS amount, dt
                FROM ({order_detail_sql()}) x
                GROUP BY order_id, cargo_type, cargo_type_name, sender_district_id, sender_city_id, dt) g
          LEFT JOIN organ o ON g.sender_district_id = o.region_id
          GROUP BY o.id, o.org_name, g.sender_city_id, cargo_type, cargo_type_name, dt) a
    LEFT JOIN region_info r ON a.city_id = r.id"""

_M1 = (*FACT_MODEL, "organ", "region_info")


@query("rollup_order_cargo_1d", with_model(f"SELECT * FROM ({ORDER_CARGO_1D_SQL})", *_M1))
def rollup_order_cargo_1d(spark, sf_dir):
    return order_cargo_1d(spark, sf_dir)


def _window_days():
    from datetime import date, timedelta
    d = date.fromisoformat(RUN_DATE)
    return (str(d - timedelta(days=29)), RUN_DATE)


def order_cargo_nd(spark, sf_dir):
    one = stored(spark, sf_dir, "order_cargo")
    keys = ["org_id", "org_name", "city_id", "city_name", "cargo_type", "cargo_type_name"]
    nd = recent_days(one, keys, {"order_count": F.sum("order_count"),
                                 "order_amount": F.sum("order_amount")}, RUN_DATE)
    return nd.withColumn("dt", F.lit(RUN_DATE))


def _nd_sql(one_sql: str, keys: str, measures: str) -> str:
    return f"""
    SELECT {keys}, w.recent_days, {measures}, '{RUN_DATE}' AS dt
    FROM ({one_sql}) one, (VALUES (7), (30)) AS w(recent_days)
    WHERE CAST(one.dt AS DATE) > {R} - w.recent_days AND CAST(one.dt AS DATE) <= {R}
    GROUP BY {keys}, w.recent_days"""


ORDER_CARGO_ND_SQL = _nd_sql(ORDER_CARGO_1D_SQL, "org_id, org_name, city_id, city_name, cargo_type, cargo_type_name",
                             "sum(order_count) AS order_count, sum(order_amount) AS order_amount")


@query("rollup_order_cargo_nd", with_model(ORDER_CARGO_ND_SQL, *_M1))
def rollup_order_cargo_nd(spark, sf_dir):
    return order_cargo_nd(spark, sf_dir)


# -- receive / deliver by org x city x province ------------------------------------------------

def _area(df, spark, sf_dir, district_col):
    org = _org(spark, sf_dir).withColumnRenamed("id", "org_id")
    j = df.join(org, F.col(district_col) == org.region_id, "left")
    return hierarchy(j, "region_id", model.region_info(spark, sf_dir), ["city", "province"])


def receive_1d(spark, sf_dir, days=None):
    d = by_milestone(spark, sf_dir, MILESTONES["receive"], days=days, lean=True)
    a = _area(d, spark, sf_dir, "sender_district_id")
    keys = ["org_id", "org_name", "city_id", "city_name", "province_id", "province_name", "dt"]
    g = order_grain(a, ["order_id", *keys], "amount")
    return g.groupBy(*keys).agg(F.count("order_id").alias("order_count"),
                                F.sum("amount").alias("order_amount"))


def _area_sql(src: str, district_col: str) -> str:
    return f"""
        SELECT s.*, o.id AS org_id, o.org_name, c.id AS city_id, c.name AS city_name,
               p.id AS province_id, p.name AS province_name
        FROM ({src}) s
        LEFT JOIN organ o ON s.{district_col} = o.region_id
        LEFT JOIN region_info dd ON o.region_id = dd.id
        LEFT JOIN region_info c ON dd.parent_id = c.id
        LEFT JOIN region_info p ON c.parent_id = p.id"""


def _codes(name):
    return ", ".join(f"'{c}'" for c in MILESTONES[name])


def milestone_sql(name: str) -> str:
    return order_detail_sql("c.update_time", f"o.status NOT IN ({_codes(name)})")


_AREA = "org_id, org_name, city_id, city_name, province_id, province_name"
RECEIVE_1D_SQL = f"""
    SELECT {_AREA}, count(order_id) AS order_count, sum(amount) AS order_amount, dt
    FROM (SELECT order_id, {_AREA}, dt, max(amount) AS amount
          FROM ({_area_sql(milestone_sql('receive'), 'sender_district_id')}) a
          GROUP BY order_id, {_AREA}, dt) g
    GROUP BY {_AREA}, dt"""


@query("rollup_receive_1d", with_model(f"SELECT * FROM ({RECEIVE_1D_SQL})", *_M1))
def rollup_receive_1d(spark, sf_dir):
    return receive_1d(spark, sf_dir)


@query("rollup_receive_nd", with_model(_nd_sql(RECEIVE_1D_SQL, _AREA,
       "sum(order_count) AS order_count, sum(order_amount) AS order_amount"), *_M1))
def rollup_receive_nd(spark, sf_dir):
    one = stored(spark, sf_dir, "receive")
    return recent_days(one, _AREA.split(", "), {"order_count": F.sum("order_count"),
                                                "order_amount": F.sum("order_amount")}, RUN_DATE) \
        .withColumn("dt", F.lit(RUN_DATE))


def deliver_1d(spark, sf_dir, days=None):
    d = by_milestone(spark, sf_dir, MILESTONES["deliver"], days=days, lean=True)
    # delivered where the receiver is
    distinct = d.select("order_id", "receiver_district_id", "dt").distinct()
    a = _area(distinct, spark, sf_dir, "receiver_district_id")
    keys = ["org_id", "org_name", "city_id", "city_name", "province_id", "province_name", "dt"]
    return a.groupBy(*keys).agg(F.count("order_id").alias("order_count"))


DELIVER_1D_SQL = f"""
    SELECT {_AREA}, count(order_id) AS order_count, dt
    FROM ({_area_sql(f"SELECT DISTINCT order_id, receiver_district_id, dt FROM ({milestone_sql('deliver')})",
                     'receiver_district_id')}) a
    GROUP BY {_AREA}, dt"""


@query("rollup_deliver_1d", with_model(f"SELECT * FROM ({DELIVER_1D_SQL})", *_M1))
def rollup_deliver_1d(spark, sf_dir):
    return deliver_1d(spark, sf_dir)


@query("rollup_deliver_nd", with_model(_nd_sql(DELIVER_1D_SQL, _AREA, "sum(order_count) AS order_count"), *_M1))
def rollup_deliver_nd(spark, sf_dir):
    one = stored(spark, sf_dir, "deliver")
    return recent_days(one, _AREA.split(", "), {"order_count": F.sum("order_count")}, RUN_DATE) \
        .withColumn("dt", F.lit(RUN_DATE))


# -- dispatch: day grain ------------------------------------------------------------------------

def dispatch_1d(spark, sf_dir, days=None):
    d = by_milestone(spark, sf_dir, MILESTONES["dispatch"], days=days, lean=True)
    g = order_grain(d, ["order_id", "dt"], "amount")
    return g.groupBy("dt").agg(F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))


DISPATCH_1D_SQL = f"""
    SELECT count(order_id) AS order_count, sum(amount) AS order_amount, dt
    FROM (SELECT order_id, dt, max(amount) AS amount FROM ({milestone_sql('dispatch')}) x
          GROUP BY order_id, dt) g
    GROUP BY dt"""


@query("rollup_dispatch_1d", with_model(f"SELECT * FROM ({DISPATCH_1D_SQL})", *FACT_MODEL))
def rollup_dispatch_1d(spark, sf_dir):
    return dispatch_1d(spark, sf_dir)


@query("rollup_dispatch_nd", with_model(f"""
    SELECT w.recent_days, sum(order_count) AS order_count, sum(order_amount) AS order_amount,
           '{RUN_DATE}' AS dt
    FROM ({DISPATCH_1D_SQL}) one, (VALUES (7), (30)) AS w(recent_days)
    WHERE CAST(one.dt AS DATE) > {R} - w.recent_days AND CAST(one.dt AS DATE) <= {R}
    GROUP BY w.recent_days""", *FACT_MODEL))
def rollup_dispatch_nd(spark, sf_dir):
    one = stored(spark, sf_dir, "dispatch")
    return recent_days(one, [], {"order_count": F.sum("order_count"), "order_amount": F.sum("order_amount")},
                       RUN_DATE).withColumn("dt", F.lit(RUN_DATE))


@query("rollup_dispatch_td", with_model(f"""
    SELECT sum(order_count) AS order_total_count, sum(order_amount) AS order_total_amount,
           '{RUN_DATE}' AS dt
    FROM ({DISPATCH_1D_SQL}) one WHERE CAST(one.dt AS DATE) <= {R}""", *FACT_MODEL))
def rollup_dispatch_td(spark, sf_dir):
    """History-to-date: a global aggregate over every day up to ``run_date``
    (partial sums per task, one tiny final merge)."""
    one = dispatch_1d(spark, sf_dir, days=("1900-01-01", RUN_DATE))
    return one.agg(F.sum("order_count").alias("order_total_count"),
                   F.sum("order_amount").alias("order_total_amount")).withColumn("dt", F.lit(RUN_DATE))


@query("rollup_finish_td", with_model(f"""
    SELECT count(order_id) AS order_count, sum(amount) AS order_amount, '{RUN_DATE}' AS dt
    FROM (SELECT order_id, max(amount) AS amount FROM ({milestone_sql('bound_finish')}) x
          WHERE CAST(dt AS DATE) <= {R} GROUP BY order_id) g""", *FACT_MODEL))
def rollup_finish_td(spark, sf_dir):
    """Order grain first (an order finishing on several lines counts once)."""
    d = by_milestone(spark, sf_dir, MILESTONES["bound_finish"], days=("1900-01-01", RUN_DATE), lean=True)
    g = order_grain(d, ["order_id"], "amount")
    return g.agg(F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount")) \
        .withColumn("dt", F.lit(RUN_DATE))


# -- trips by org x truck model type --------------------------------------------------------------

def truck_dim(spark, sf_dir):
    p = model_part(spark, sf_dir)
    return decode(p, "truck_model_type", model.dic(spark), "truck_model_type_name", unique=True)


def model_part(spark, sf_dir):
    from dovetail.sources.tables import load
    return load(spark, sf_dir, "part").select(F.col("p_partkey").alias("truck_dim_id"),
                                              F.col("p_type").alias("truck_model_type"))


def trips_1d(spark, sf_dir, days=None):
    t = trans_finish(spark, sf_dir, days)
    org = _org(spark, sf_dir, ("id", "org_name")).withColumnRenamed("id", "org_id")
    j = t.join(org, t.start_org_id == org.org_id, "left") \
         .join(truck_dim(spark, sf_dir), t.truck_id == F.col("truck_dim_id"), "left")
    return j.groupBy("org_id", "org_name", "truck_model_type", "truck_model_type_name", "dt").agg(
        F.count("*").alias("trans_finish_count"), F.sum("actual_distance").alias("trans_finish_distance"),
        F.sum("finish_dur_sec").alias("trans_finish_dur_sec"))


TRIPS_SQL = """
    SELECT t.*, o.org_name, p.p_type AS truck_model_type, d.name AS truck_model_type_name
    FROM (SELECT start_org_id, truck_id, driver1_emp_id, driver2_emp_id, shift_id, line_id, actual_distance,
                 CAST((CAST(actual_end_time AS BIGINT) - CAST(actual_start_time AS BIGINT)) // 1000 AS BIGINT)
                     AS finish_dur_sec,
                 strftime(epoch_ms(CAST(actual_end_time AS BIGINT)), '%Y-%m-%d') AS dt
          FROM transport_task WHERE actual_end_time IS NOT NULL) t
    LEFT JOIN organ o ON t.start_org_id = o.id
    LEFT JOIN part p ON t.truck_id = p.p_partkey
    LEFT JOIN dic d ON p.p_type = d.id"""

TRIPS_1D_SQL = f"""
    SELECT start_org_id AS org_id, org_name, truck_model_type, truck_model_type_name,
           count(*) AS trans_finish_count, sum(actual_distance) AS trans_finish_distance,
           sum(finish_dur_sec) AS trans_finish_dur_sec, dt
    FROM ({TRIPS_SQL}) x
    GROUP BY start_org_id, org_name, truck_model_type, truck_model_type_name, dt"""


@query("rollup_trips_1d", with_model(f"SELECT * FROM ({TRIPS_1D_SQL})", "transport_task", "organ", "dic"))
def rollup_trips_1d(spark, sf_dir):
    return trips_1d(spark, sf_dir)


# -- sorting by org with level-dependent area ----------------------------------------------------

def org_sort_1d(spark, sf_dir, days=None):
    from dovetail.plans.facts import _bound
    s = _bound(spark, sf_dir, "sort_time", days).groupBy("org_id", "dt").agg(F.count("*").alias("sort_count"))
    org = model.organ(spark, sf_dir).select(F.col("id").alias("__oid"), "org_name", "org_level", "region_id")
    tree = maybe_broadcast(model.region_info(spark, sf_dir).select("id", "name", "parent_id"))
    r1, r2, r3 = (tree.select(*[F.col(c).alias(f"{a}_{c}") for c in ("id", "name", "parent_id")])
                  for a in ("r1", "r2", "r3"))
    j = (s.join(maybe_broadcast(org), s.org_id == F.col("__oid"), "left")
          .join(r1, F.col("region_id") == F.col("r1_id"), "left")
          .join(r2, F.col("r1_parent_id") == F.col("r2_id"), "left")
          .join(r3, F.col("r2_parent_id") == F.col("r3_id"), "left"))
    lvl1 = F.col("org_level") == 1
    return j.select(
        "org_id", "org_name",
        F.when(lvl1, F.col("r1_id")).otherwise(F.col("r2_id")).alias("city_id"),
        F.when(lvl1, F.col("r1_name")).otherwise(F.col("r2_name")).alias("city_name"),
        F.when(lvl1, F.col("r2_id")).otherwise(F.col("r3_id")).alias("province_id"),
        F.when(lvl1, F.col("r2_name")).otherwise(F.col("r3_name")).alias("province_name"),
        "sort_count", "dt")


ORG_SORT_1D_SQL = """
    SELECT a.org_id, o.org_name,
           CASE WHEN o.org_level = 1 THEN r1.id ELSE r2.id END AS city_id,
           CASE WHEN o.org_level = 1 THEN r1.name ELSE r2.name END AS city_name,
           CASE WHEN o.org_level = 1 THEN r2.id ELSE r3.id END AS province_id,
           CASE WHEN o.org_level = 1 THEN r2.name ELSE r3.name END AS province_name,
           a.sort_count, a.dt
    FROM (SELECT org_id, count(*) AS sort_count,
                 strftime(epoch_ms(CAST(sort_time AS BIGINT)), '%Y-%m-%d') AS dt
          FROM order_org_bound WHERE sort_time IS NOT NULL GROUP BY org_id, dt) a
    LEFT JOIN organ o ON a.org_id = o.id
    LEFT JOIN region_info r1 ON o.region_id = r1.id
    LEFT JOIN region_info r2 ON r1.parent_id = r2.id
    LEFT JOIN region_info r3 ON r2.parent_id = r3.id"""


@query("rollup_org_sort_1d", with_model(f"SELECT * FROM ({ORG_SORT_1D_SQL})", "order_org_bound", "organ",
                                        "region_info"))
def rollup_org_sort_1d(spark, sf_dir):
    return org_sort_1d(spark, sf_dir)


@query("rollup_sort_nd", with_model(_nd_sql(ORG_SORT_1D_SQL, _AREA, "sum(sort_count) AS sort_count"),
                                    "order_org_bound", "organ", "region_info"))
def rollup_sort_nd(spark, sf_dir):
    one = stored(spark, sf_dir, "org_sort")
    return recent_days(one, _AREA.split(", "), {"sort_count": F.sum("sort_count")}, RUN_DATE) \
        .withColumn("dt", F.lit(RUN_DATE))


# -- shift x drivers x truck, n days -------------------------------------------------------------

_SHIFT = ["shift_id", "line_id", "driver1_emp_id", "driver2_emp_id", "truck_id"]


def shift_1d(spark, sf_dir, days=None):
    return trans_finish(spark, sf_dir, days).groupBy(*_SHIFT, "dt").agg(
        F.count("*").alias("trans_finish_count"), F.sum("actual_distance").alias("trans_finish_distance"),
        F.sum("finish_dur_sec").alias("trans_finish_dur_sec"))


def shift_nd(spark, sf_dir):
    nd = recent_days(stored(spark, sf_dir, "shift"), _SHIFT,
                     {c: F.sum(c) for c in ("trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec")}, RUN_DATE)
    return (nd.join(truck_dim(spark, sf_dir), nd.truck_id == F.col("truck_dim_id"), "left")
              .drop("truck_dim_id").withColumn("dt", F.lit(RUN_DATE)))


SHIFT_ND_SQL = f"""
    SELECT shift_id, line_id, driver1_emp_id, driver2_emp_id, truck_id, truck_model_type, truck_model_type_name,
           w.recent_days, count(*) AS trans_finish_count, sum(actual_distance) AS trans_finish_distance,
           sum(finish_dur_sec) AS trans_finish_dur_sec, '{RUN_DATE}' AS dt
    FROM ({TRIPS_SQL}) x, (VALUES (7), (30)) AS w(recent_days)
    WHERE CAST(x.dt AS DATE) > {R} - w.recent_days AND CAST(x.dt AS DATE) <= {R}
    GROUP BY shift_id, line_id, driver1_emp_id, driver2_emp_id, truck_id, truck_model_type,
             truck_model_type_name, w.recent_days"""


@query("rollup_shift_nd", with_model(SHIFT_ND_SQL, "transport_task", "organ", "dic"))
def rollup_shift_nd(spark, sf_dir):
    return shift_nd(spark, sf_dir)


# -- the stored 1-day tables ---------------------------------------------------------------------------

_AREAS = ("supplier", "nation", "region")
DAILY = {t.name: t for t in (
    Daily("order_cargo", order_cargo_1d, ("lineitem", "orders", "part", *_AREAS)),
    Daily("receive", receive_1d, ("lineitem", "orders", *_AREAS)),
    Daily("deliver", deliver_1d, ("lineitem", "orders", *_AREAS)),
    Daily("dispatch", dispatch_1d, ("lineitem", "orders")),
    Daily("trips", trips_1d, ("lineitem", "part", "supplier")),
    Daily("org_sort", org_sort_1d, ("lineitem", *_AREAS)),
    Daily("shift", shift_1d, ("lineitem",)))}


def stored(spark, sf_dir, name: str) -> DataFrame:
    """The days of the widest window from a stored 1-day table."""
    return read_days(spark, sf_dir, DAILY[name], *_window_days())
