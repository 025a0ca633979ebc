"""Transaction, milestone and accumulating-snapshot facts (DWD layer)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dovetail.functions.dates import millis_to_day, millis_to_ts
from dovetail.functions.strings import mask_name
from dovetail.operators.joins import decode
from dovetail.registry import query
from dovetail.sources import model
from dovetail.sources.model_sql import with_model
from dovetail.sources.tables import dealt, load

FACT_COLS = ["id", "order_id", "line_no", "cargo_type", "cargo_type_name", "volume_length", "volume_width",
             "volume_height", "volume", "weight", "order_no", "status", "status_name", "collect_type",
             "collect_type_name", "payment_type", "payment_type_name", "user_id", "receiver_complex_id",
             "receiver_province_id", "receiver_city_id", "receiver_district_id", "sender_complex_id",
             "sender_province_id", "sender_city_id", "sender_district_id", "cargo_num", "amount", "distance"]
FACT_COLS_SQL = """c.id, c.order_id, c.line_no, c.cargo_type, d1.name AS cargo_type_name, c.volume_length, c.volume_width,
               c.volume_height, c.volume, c.weight, o.order_no, o.status, d2.name AS status_name, o.collect_type,
               d3.name AS collect_type_name, o.payment_type, d4.name AS payment_type_name, o.user_id,
               o.receiver_complex_id, r.province_id AS receiver_province_id, r.city_id AS receiver_city_id,
               o.receiver_district_id, c.sender_complex_id, c.sender_province_id, c.sender_city_id,
               c.sender_district_id, o.cargo_num, o.amount, c.distance,
               substr(o.receiver_name, 1, 1) || '*' AS receiver_name, substr(c.sender_name, 1, 1) || '*' AS sender_name,
               strftime(o.create_time, '%Y-%m-%d %H:%M:%S') AS order_time,
               strftime(o.estimate_arrive_date, '%Y-%m-%d') AS estimate_arrive_date"""
FACT_FROM_SQL = """order_cargo c JOIN order_info o ON c.order_id = o.order_id
        LEFT JOIN areas r ON o.receiver_district_id = r.district_id
        LEFT JOIN dic d1 ON c.cargo_type = d1.id
        LEFT JOIN dic d2 ON o.status = d2.id
        LEFT JOIN dic d3 ON o.collect_type = d3.id
        LEFT JOIN dic d4 ON o.payment_type = d4.id"""


def _day_bounds(col: str, days: tuple[str, str] | None):
    """Raw-column range for [first, last] days: a pushable scan predicate."""
    if days is None:
        return F.lit(True)
    lo, hi = days
    return (F.col(col) >= F.lit(lo).cast("timestamp_ntz")) & \
           (F.col(col) < F.date_add(F.lit(hi).cast("date"), 1).cast("timestamp_ntz"))


def order_detail(spark: SparkSession, sf_dir: str, time_col: str = "create_time",
                 excluded: list[str] | None = None, only: list[str] | None = None,
                 days: tuple[str, str] | None = None, lean: bool = False, with_city: bool = True) -> DataFrame:
    """Cargo lines joined to their order and decoded.

    ``excluded``/``only`` select milestone status codes; ``time_col`` is the
    event time that dates the row (``create_time`` of the order or
    ``update_time`` of the line); ``days`` restricts event days and is pushed
    to the parquet scan of the table holding that time column. ``lean``
    keeps only what the order-grain roll-ups read (no part / supplier joins,
    no decodes).
    """
    o = model.order_info(spark, sf_dir)
    c = model.order_cargo(spark, sf_dir, with_type=not lean, with_city=with_city and not lean)
    lines = load(spark, sf_dir, "lineitem")
    if time_col == "create_time":
        o = o.where(_day_bounds("create_time", days))
    else:
        c = c.where(_day_bounds("update_time", days))
        lines = lines.where(_day_bounds("l_shipdate", days))
    if excluded:
        o = o.where(~F.col("status").isin(*excluded))
    if only:
        o = o.where(F.col("status").isin(*only))
    c, o = dealt(lines.count(), c, "order_id", o)
    j = c.join(o, "order_id", "inner")
    ev = F.col(time_col)
    if lean:
        return j.select("order_id", "line_no", "status", "sender_district_id", "receiver_district_id", "amount",
                        F.date_format(ev, "yyyy-MM-dd").alias("dt"))
    return described(spark, sf_dir, j).select(
        *FACT_COLS, *_texts(), F.date_format(ev, "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        F.date_format(ev, "yyyy-MM-dd").alias("dt"))


def _texts():
    return [mask_name(F.col("receiver_name")).alias("receiver_name"), mask_name(F.col("sender_name")).alias("sender_name"),
            F.date_format("create_time", "yyyy-MM-dd HH:mm:ss").alias("order_time"),
            F.date_format("estimate_arrive_date", "yyyy-MM-dd").alias("estimate_arrive_date")]


def described(spark: SparkSession, sf_dir: str, j: DataFrame) -> DataFrame:
    """Cargo lines with their order: four codes decoded, the receiver's city
    and province looked up."""
    d = model.dic(spark)
    for code in ("cargo_type", "status", "collect_type", "payment_type"):
        j = decode(j, code, d, f"{code}_name", unique=True)
    r = model.areas(spark, sf_dir).select(F.col("district_id").alias("receiver_district_id"), F.col("city_id").alias("receiver_city_id"),
                                          F.col("province_id").alias("receiver_province_id"))
    return j.join(r, "receiver_district_id", "left")


def order_detail_sql(time_col: str = "create_time", where: str = "TRUE") -> str:
    """SQL text of :func:`order_detail` as a sub-select (needs the model CTEs)."""
    return f"""
        SELECT {FACT_COLS_SQL},
               strftime({time_col}, '%Y-%m-%d %H:%M:%S') AS event_time,
               strftime({time_col}, '%Y-%m-%d') AS dt
        FROM {FACT_FROM_SQL}
        WHERE {where}"""


FACT_MODEL = ("dic", "order_info", "order_cargo", "areas")


@query("fact_order_detail", with_model(f"SELECT * FROM ({order_detail_sql()})", *FACT_MODEL))
def fact_order_detail(spark, sf_dir):
    return order_detail(spark, sf_dir)


@query("dict_decode", with_model(
    "SELECT order_id, line_no, cargo_type_name, status_name, collect_type_name, payment_type_name "
    f"FROM ({order_detail_sql()})", *FACT_MODEL))
def dict_decode(spark, sf_dir):
    """Same dictionary decoded under four roles (cargo, status, collect, payment),
    each a left join on its own code column."""
    return order_detail(spark, sf_dir, with_city=False).select("order_id", "line_no", "cargo_type_name", "status_name",
                                              "collect_type_name", "payment_type_name")


# Milestone facts: status codes a row must NOT have (as written in the reference).
MILESTONES = {
    "pay": ["60010", "60999"],
    "receive": ["60010", "60020", "60999"],
    "dispatch": ["60010", "60020", "60030", "60040", "60999"],
    "bound_finish": ["60020", "60030", "60040", "60050"],
    "deliver": ["60020", "60030", "60040"],
    "sign": ["60020", "60030", "60040", "60050"],
}


def by_milestone(spark, sf_dir, excluded, days=None, lean=False):
    return order_detail(spark, sf_dir, time_col="update_time", excluded=excluded, days=days, lean=lean)


def _register_milestone(name, codes):
    codes_sql = ", ".join(f"'{c}'" for c in codes)
    sql = with_model(f"SELECT * FROM ({order_detail_sql('c.update_time', f'o.status NOT IN ({codes_sql})')})",
                     *FACT_MODEL)

    @query(f"fact_by_milestone_{name}", sql, family="facts")
    def _q(spark, sf_dir):
        return by_milestone(spark, sf_dir, codes)
    return _q


for _n, _c in MILESTONES.items():
    _register_milestone(_n, _c)


@query("fact_order_cancel", with_model(
    f"SELECT * FROM ({order_detail_sql('c.update_time', chr(39) + '60020' + chr(39) + ' = o.status')})",
    *FACT_MODEL))
def fact_order_cancel(spark, sf_dir):
    return order_detail(spark, sf_dir, time_col="update_time", only=["60020"])


@query("fact_order_process", with_model(f"""
    SELECT {FACT_COLS_SQL}, strftime(o.create_time, '%Y-%m-%d') AS start_date,
           CASE WHEN o.status IN ('60020', '60030') THEN strftime(c.update_time, '%Y-%m-%d')
                ELSE '9999-12-31' END AS end_date,
           CASE WHEN o.status IN ('60020', '60030') THEN strftime(c.update_time, '%Y-%m-%d')
                ELSE '9999-12-31' END AS dt
    FROM {FACT_FROM_SQL}""", *FACT_MODEL))
def fact_order_process(spark, sf_dir):
    """Accumulating snapshot: closed rows land in their end-day partition,
    open rows in ``9999-12-31`` (re-written when they close)."""
    c, o = dealt(load(spark, sf_dir, "lineitem").count(), model.order_cargo(spark, sf_dir), "order_id", model.order_info(spark, sf_dir))
    j = c.join(o, "order_id")
    end = F.when(F.col("status").isin("60020", "60030"), F.date_format("update_time", "yyyy-MM-dd")) \
        .otherwise(F.lit("9999-12-31"))
    return described(spark, sf_dir, j).select(*FACT_COLS, *_texts(), F.date_format("create_time", "yyyy-MM-dd").alias("start_date"),
                                              end.alias("end_date"), end.alias("dt"))


@query("fact_trans_finish", with_model("""
    SELECT order_id, shift_id, line_id, start_org_id, driver1_emp_id,
           substr('Driver' || CAST(driver1_emp_id AS VARCHAR), 1, 1) || '*' AS driver1_name,
           driver2_emp_id,
           CASE WHEN driver2_emp_id IS NOT NULL
                THEN substr('Driver' || CAST(driver2_emp_id AS VARCHAR), 1, 1) || '*' END AS driver2_name,
           truck_id, actual_distance,
           strftime(epoch_ms(CAST(actual_start_time AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS actual_start_time,
           strftime(epoch_ms(CAST(actual_end_time AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS actual_end_time,
           CAST((CAST(actual_end_time AS BIGINT) - CAST(actual_start_time AS BIGINT)) // 1000 AS BIGINT)
               AS finish_dur_sec,
           strftime(epoch_ms(CAST(actual_end_time AS BIGINT)), '%Y-%m-%d') AS dt
    FROM transport_task WHERE actual_end_time IS NOT NULL""", "transport_task"))
def fact_trans_finish(spark, sf_dir):
    """Finished trips: duration in seconds, driver names masked. The
    reference's join to the shift table adds no column and is left out."""
    return trans_finish(spark, sf_dir)


def trans_finish(spark, sf_dir, days=None):
    """``days``: the window of end days the caller keeps (pushed to the scan)."""
    t = model.transport_task(spark, sf_dir, days).where(F.col("actual_end_time").isNotNull())
    fmt = "yyyy-MM-dd HH:mm:ss"
    start, end = millis_to_ts(F.col("actual_start_time")), millis_to_ts(F.col("actual_end_time"))
    utc = F.current_timezone()
    return t.select(
        "order_id", "shift_id", "line_id", "start_org_id", "driver1_emp_id",
        mask_name(F.concat(F.lit("Driver"), F.col("driver1_emp_id").cast("string"))).alias("driver1_name"),
        "driver2_emp_id",
        mask_name(F.concat(F.lit("Driver"), F.col("driver2_emp_id").cast("string"))).alias("driver2_name"),
        "truck_id", "actual_distance",
        F.date_format(F.to_utc_timestamp(start, utc), fmt).alias("actual_start_time"),
        F.date_format(F.to_utc_timestamp(end, utc), fmt).alias("actual_end_time"),
        ((F.col("actual_end_time").cast("bigint") - F.col("actual_start_time").cast("bigint")) / 1000)
        .cast("bigint").alias("finish_dur_sec"),
        millis_to_day(F.col("actual_end_time")).alias("dt"),
    )


def _bound(spark, sf_dir, time_col, days=None):
    b = model.order_org_bound(spark, sf_dir, days).where(F.col(time_col).isNotNull())
    ts = F.to_utc_timestamp(millis_to_ts(F.col(time_col)), F.current_timezone())
    return b.select("id", "order_id", "org_id", time_col.replace("_time", "_emp_id"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias(time_col),
                    F.date_format(ts, "yyyy-MM-dd").alias("dt"))


def _bound_sql(time_col):
    return with_model(f"""
        SELECT id, order_id, org_id, {time_col.replace("_time", "_emp_id")},
               strftime(epoch_ms(CAST({time_col} AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS {time_col},
               strftime(epoch_ms(CAST({time_col} AS BIGINT)), '%Y-%m-%d') AS dt
        FROM order_org_bound WHERE {time_col} IS NOT NULL""", "order_org_bound")


@query("fact_bound_inbound", _bound_sql("inbound_time"))
def fact_bound_inbound(spark, sf_dir):
    """Dated once, by event day (the reference's second all-rows insert is dropped)."""
    return _bound(spark, sf_dir, "inbound_time")


@query("fact_bound_sort", _bound_sql("sort_time"))
def fact_bound_sort(spark, sf_dir):
    return _bound(spark, sf_dir, "sort_time")


@query("fact_bound_outbound", _bound_sql("outbound_time"))
def fact_bound_outbound(spark, sf_dir):
    return _bound(spark, sf_dir, "outbound_time")


__all__ = ["order_detail", "order_detail_sql", "by_milestone", "trans_finish"]
