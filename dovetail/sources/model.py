"""Reference source tables re-expressed over the driver tables.

The reference's ODS tables do not exist in the test data, so each one is a
deterministic projection of a driver table (SURVEY 7.4 roles):

==================  ===========================================================
reference table     derived from
==================  ===========================================================
order_info          orders: status from priority, cancelled = ('P', '5-LOW');
                    receiver = the customer (its own complex), in the
                    district its key ends in; 1 to 7 declared pieces
order_cargo         lineitem: cargo line with three sides; sender = supplier
                    of the line (complex of the same number)
base_region_info    region (province) / nation (city) / supplier (district)
base_organ          supplier: level 1 hub when s_acctbal >= 5000, else station
base_dic            fixed code dictionary below (bounded, broadcast)
transport_task      lineitem: one trip per line, second driver when discounted
order_org_bound     lineitem: in / sort / out scan times at the line's supplier
user_info           customer: phone / e-mail / birthday derived, some invalid
page behaviour      events (page = event_type, module = props.k)
==================  ===========================================================

Every function reads the driver tables lazily, so that Catalyst prunes columns
and pushes filters into the parquet scans. Each has a SQL twin in
:mod:`dovetail.sources.model_sql` that the oracle statements embed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dovetail.functions.dates import epoch_ms
from dovetail.sources.literal import literal_table
from dovetail.sources.tables import load

# The day the daily jobs run for: inside the order / ship date range of every scale.
RUN_DATE = "1998-08-02"

# Logistics code dictionary (id, name). Status codes are the
# reference's 600x0 series; names are descriptive inventions. Cargo type codes
# are the driver's part types; 'PROMO' is left out on purpose so that a code
# without dictionary entry decodes to null.
DIC_ROWS = [
    ("60010", "ordered"), ("60020", "paid"), ("60030", "collected"),
    ("60040", "dispatched"), ("60050", "in transit"), ("60999", "cancelled"),
    ("65001", "door pickup"), ("65002", "outlet drop-off"),
    ("66001", "cash"), ("66002", "card"), ("66003", "wallet"),
    ("ECONOMY", "economy cargo"), ("STANDARD", "standard cargo"), ("SMALL", "small parcel"),
    ("MEDIUM", "medium parcel"), ("LARGE", "large freight"),
    ("67001", "trunk line"), ("67002", "branch line"),
]
assert len({k for k, _ in DIC_ROWS}) == len(DIC_ROWS)  # codes are unique: decodes need no de-duplication


def dic(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DIC_ROWS, "id string, name string")


def status_code(orderstatus, priority):
    return (F.when((orderstatus == "P") & (priority == "5-LOW"), F.lit("60999"))
            .otherwise(F.concat(F.lit("600"), F.substring(priority, 1, 1), F.lit("0"))))


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("NO"), F.col("o_orderkey").cast("string")).alias("order_no"),
        status_code(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("status"),
        F.when(F.col("o_orderstatus") == "O", "65001").otherwise("65002").alias("collect_type"),
        F.when(F.col("o_orderstatus") == "O", "66001")
         .when(F.col("o_orderstatus") == "F", "66002").otherwise("66003").alias("payment_type"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("decimal(16,2)").alias("amount"),
        F.col("o_orderdate").alias("create_time"),
        (F.lit(10000) + F.col("o_custkey") % 10).cast("long").alias("receiver_district_id"),
        F.col("o_custkey").alias("receiver_complex_id"),
        F.concat(F.lit("Customer"), F.col("o_custkey").cast("string")).alias("receiver_name"),
        (F.col("o_orderkey") % 7 + 1).cast("long").alias("cargo_num"),
        F.date_add(F.col("o_orderdate").cast("date"), 7).alias("estimate_arrive_date"),
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and province of every district that has both."""
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        (F.col("s_suppkey") + 10000).alias("district_id"), (F.col("s_nationkey") + 100).cast("long").alias("city_id"),
        (F.col("n_regionkey") + 1).cast("long").alias("province_id"))


def order_cargo(spark: SparkSession, sf_dir: str, with_type: bool = True, with_city: bool = True) -> DataFrame:
    """Cargo lines with their part type and sender district / city / province.

    ``with_type`` / ``with_city`` add the part and supplier joins only when a
    job uses those columns (a left join Catalyst cannot drop by itself).
    """
    li = load(spark, sf_dir, "lineitem")
    out = li
    if with_type:
        p = load(spark, sf_dir, "part").select("p_partkey", "p_type")
        out = out.join(p, li.l_partkey == p.p_partkey, "left")
    if with_city:
        out = out.join(areas(spark, sf_dir), li.l_suppkey + 10000 == F.col("district_id"), "left")
    none = F.lit(None).cast("long")
    return out.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        (F.col("p_type") if with_type else F.lit(None).cast("string")).alias("cargo_type"),
        F.col("l_quantity").cast("decimal(16,2)").alias("weight"),
        (F.col("l_suppkey") + 10000).alias("sender_district_id"),
        (F.col("city_id") if with_city else none).alias("sender_city_id"),
        (F.col("province_id") if with_city else none).alias("sender_province_id"),
        F.col("l_suppkey").alias("sender_complex_id"),
        F.concat(F.lit("Supplier"), F.col("l_suppkey").cast("string")).alias("sender_name"),
        F.col("l_quantity").cast("long").alias("volume_length"),
        F.col("l_linenumber").cast("long").alias("volume_width"),
        (F.col("l_partkey") % 40 + 1).cast("long").alias("volume_height"),
        F.col("l_shipdate").alias("update_time"),
        (F.col("l_quantity") * F.col("l_linenumber")).cast("decimal(16,2)").alias("volume"),
        (F.col("l_quantity") * 10).cast("decimal(16,2)").alias("distance"),
    )


def region_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = load(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).cast("long").alias("id"), F.lit(0).cast("long").alias("parent_id"),
        F.col("r_name").alias("name"), F.lit("province").alias("dict_code"))
    n = load(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 100).cast("long").alias("id"), (F.col("n_regionkey") + 1).cast("long").alias("parent_id"),
        F.col("n_name").alias("name"), F.lit("city").alias("dict_code"))
    s = load(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 10000).alias("id"), (F.col("s_nationkey") + 100).cast("long").alias("parent_id"),
        F.concat(F.lit("DISTRICT_"), F.col("s_suppkey").cast("string")).alias("name"),
        F.lit("district").alias("dict_code"))
    return r.unionByName(n).unionByName(s)


def organ(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    level = F.when(F.col("s_acctbal") >= 5000, 1).otherwise(2)
    return s.select(
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit("ORG_"), F.col("s_suppkey").cast("string")).alias("org_name"),
        level.alias("org_level"),
        (F.col("s_suppkey") + 10000).alias("region_id"),
        F.when(level == 2, F.col("s_nationkey").cast("long")).alias("org_parent_id"),
    )


def raw_days(days: tuple[str, str] | None, hours_before: int = 0):
    """Rows of ``lineitem`` shipped on the days [first, last], or up to
    ``hours_before`` hours earlier: a range the scan can use."""
    if days is None:
        return F.lit(True)
    lo, hi = days
    return ((F.col("l_shipdate") >= F.lit(lo).cast("timestamp_ntz") - F.expr(f"INTERVAL '{hours_before}' HOUR"))
            & (F.col("l_shipdate") < F.date_add(F.lit(hi).cast("date"), 1).cast("timestamp_ntz")))


# A trip takes l_quantity hours. Trips up to this long are found by ship date
# alone; longer ones, if any, by their duration: the test loses no row.
USUAL_TRIP_HOURS = 50


def transport_task(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """``days``: leave out trips that cannot have ended on the days [first,
    last] (the exact test on the end day stays with the caller)."""
    li = load(spark, sf_dir, "lineitem")
    if days:
        ends = F.date_add(F.lit(days[1]).cast("date"), 1).cast("timestamp_ntz")
        li = li.where((raw_days(days, USUAL_TRIP_HOURS) | (F.col("l_quantity") > USUAL_TRIP_HOURS))
                      & (F.col("l_shipdate") < ends) & (F.col("l_linestatus") == "F"))
    start_ms = epoch_ms(F.col("l_shipdate"))
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("shift_id"),
        F.col("l_linenumber").cast("long").alias("line_id"),
        F.col("l_suppkey").alias("start_org_id"),
        F.col("l_suppkey").alias("driver1_emp_id"),
        F.when(F.col("l_discount") >= 0.05, F.col("l_partkey") + 100000).alias("driver2_emp_id"),
        F.col("l_partkey").alias("truck_id"),
        start_ms.cast("string").alias("actual_start_time"),
        F.when(F.col("l_linestatus") == "F",
               (start_ms + (F.col("l_quantity") * 3600000).cast("long")).cast("string")).alias("actual_end_time"),
        (F.col("l_quantity") * 10).cast("decimal(16,2)").alias("actual_distance"),
    )


def order_org_bound(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """``days``: leave out scans that cannot have been made on the days [first, last]."""
    li = load(spark, sf_dir, "lineitem").where(raw_days(days, hours_before=2))
    t = epoch_ms(F.col("l_shipdate"))
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("org_id"),
        (F.col("l_suppkey") + 20000).alias("inbound_emp_id"),
        (F.col("l_suppkey") + 30000).alias("sort_emp_id"),
        (F.col("l_suppkey") + 40000).alias("outbound_emp_id"),
        t.cast("string").alias("inbound_time"),
        F.when(F.col("l_returnflag") != "N", (t + 3600000).cast("string")).alias("sort_time"),
        F.when(F.col("l_linestatus") == "F", (t + 7200000).cast("string")).alias("outbound_time"),
    )


def user_info(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    """``where``: a test on the source columns (pushed to the scan)."""
    c = load(spark, sf_dir, "customer")
    c = c if where is None else c.where(where)
    key = F.col("c_custkey").cast("string")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("login"), key).alias("login_name"),
        F.col("c_name").alias("real_name"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("13"), F.lpad(key, 9, "0")))
         .otherwise(F.concat(F.lit("13"), key)).alias("phone_num"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("user"), key, F.lit("@mail.example")))
         .otherwise(F.concat(F.lit("user"), key, F.lit("#mail.example"))).alias("email"),
        (F.abs(F.col("c_acctbal")).cast("int") + 3000).alias("birthday"),
        F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE"), "F").otherwise("M").alias("gender"),
        F.col("c_mktsegment").alias("user_level"),
        F.col("c_nationkey"),
    )
