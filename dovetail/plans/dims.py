"""Dimension builds (DIM layer): full snapshots, zipper dimensions, calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from dovetail.functions import strings as S
from dovetail.operators.joins import decode, maybe_broadcast
from dovetail.operators.windows import latest_per_key
from dovetail.plans.scalars import COUPONS_SQL, coupons, rule_text
from dovetail.registry import query
from dovetail.session import scratch_dir, shared_dir
from dovetail.sources import model
from dovetail.sources.daily import source_state
from dovetail.sources.model import RUN_DATE
from dovetail.sources.model_sql import with_model
from dovetail.sources.literal import literal_table
from dovetail.sources.tables import load
from dovetail.sources.zipper import ZipperStore

PHONE = S.PHONE_RE
EMAIL = S.EMAIL_RE


@query("dim_region_full", with_model(f"""
    SELECT id, parent_id, name, dict_code, substr(name, 1, 3) AS short_name, '{RUN_DATE}' AS dt
    FROM region_info WHERE name IS NOT NULL""", "region_info"))
def dim_region_full(spark, sf_dir):
    r = model.region_info(spark, sf_dir).where(F.col("name").isNotNull())
    return r.select("id", "parent_id", "name", "dict_code", F.substring("name", 1, 3).alias("short_name"),
                    F.lit(RUN_DATE).alias("dt"))


@query("dim_organ_full", with_model(f"""
    SELECT o.id, o.org_name, o.org_level, o.region_id, r.name AS region_name, r.dict_code AS region_code,
           o.org_parent_id, p.org_name AS org_parent_name, '{RUN_DATE}' AS dt
    FROM organ o LEFT JOIN region_info r ON o.region_id = r.id
    LEFT JOIN organ p ON o.org_parent_id = p.id""", "organ", "region_info"))
def dim_organ_full(spark, sf_dir):
    """Organisation with its region and its parent organisation (aliased self join)."""
    o = model.organ(spark, sf_dir)
    r = maybe_broadcast(model.region_info(spark, sf_dir).select(
        F.col("id").alias("__rid"), F.col("name").alias("region_name"), F.col("dict_code").alias("region_code")))
    parent = maybe_broadcast(o.select(F.col("id").alias("__pid"), F.col("org_name").alias("org_parent_name")))
    return (o.join(r, o.region_id == F.col("__rid"), "left").join(parent, o.org_parent_id == F.col("__pid"), "left")
             .select("id", "org_name", "org_level", "region_id", "region_name", "region_code", "org_parent_id",
                     "org_parent_name", F.lit(RUN_DATE).alias("dt")))


@query("dim_complex_full", f"""
    WITH cour AS (SELECT o_custkey AS complex_id,
                         array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS courier_emp_ids
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)
    SELECT c.c_custkey AS id, c.c_name AS complex_name, r.r_regionkey + 1 AS province_id, r.r_name AS province_name,
           n.n_nationkey + 100 AS city_id, n.n_name AS city_name, cour.courier_emp_ids, '{RUN_DATE}' AS dt
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN cour ON c.c_custkey = cour.complex_id""")
def dim_complex_full(spark, sf_dir):
    """Complex (customer site) with city and province, plus the set of
    couriers (suppliers) that served it. Pairs are de-duplicated map-side
    before the set is built; the set is bounded by the supplier count."""
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pairs = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("complex_id"), "l_suppkey") \
        .distinct()
    cour = pairs.groupBy("complex_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_set("l_suppkey")), lambda x: x.cast("string")), ",")
        .alias("courier_emp_ids"))
    base = (c.join(maybe_broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(maybe_broadcast(r), n.n_regionkey == r.r_regionkey))
    return base.join(cour, base.c_custkey == cour.complex_id, "left").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("complex_name"),
        (F.col("r_regionkey") + 1).alias("province_id"), F.col("r_name").alias("province_name"),
        (F.col("n_nationkey") + 100).alias("city_id"), F.col("n_name").alias("city_name"),
        "courier_emp_ids", F.lit(RUN_DATE).alias("dt"))


@query("dim_courier_full", with_model(f"""
    SELECT u.id, u.id AS emp_id, o.id AS org_id, o.org_name,
           md5(CASE WHEN regexp_matches(u.phone_num, '{PHONE}') THEN u.phone_num END) AS working_phone,
           CASE WHEN u.gender = 'F' THEN '66001' ELSE '66002' END AS express_type,
           d.name AS express_type_name, '{RUN_DATE}' AS dt
    FROM user_info u JOIN organ o ON CAST(u.c_nationkey AS BIGINT) = o.id
    JOIN dic d ON (CASE WHEN u.gender = 'F' THEN '66001' ELSE '66002' END) = d.id""",
    "user_info", "organ", "dic"))
def dim_courier_full(spark, sf_dir):
    """Courier (customer row) with hashed valid phone, its organisation and
    express type name; inner joins as in the reference."""
    u = model.user_info(spark, sf_dir)
    o = maybe_broadcast(model.organ(spark, sf_dir).select(F.col("id").alias("org_id"), "org_name"))
    c = u.select("id", F.col("id").alias("emp_id"), F.col("c_nationkey").cast("long").alias("__org"),
                 S.md5_if_valid(F.col("phone_num"), S.PHONE_RE).alias("working_phone"),
                 F.when(F.col("gender") == "F", "66001").otherwise("66002").alias("express_type"))
    j = c.join(o, F.col("__org") == F.col("org_id")).drop("__org")
    return decode(j, "express_type", model.dic(spark), "express_type_name", unique=True, how="inner") \
        .withColumn("dt", F.lit(RUN_DATE))


def lines(spark, sf_dir):
    n = load(spark, sf_dir, "nation")
    return n.select((F.col("n_nationkey") + 1).cast("long").alias("line_id"), F.col("n_name").alias("line_name"),
                    F.concat(F.lit("L"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("line_no"),
                    F.col("n_regionkey").cast("long").alias("line_org_id"),
                    F.when(F.col("n_regionkey") < 2, "67001").otherwise("67002").alias("transport_line_type_id"))


LINES_SQL = """
    SELECT CAST(n_nationkey + 1 AS BIGINT) AS line_id, n_name AS line_name,
           'L' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS line_no, CAST(n_regionkey AS BIGINT) AS line_org_id,
           CASE WHEN n_regionkey < 2 THEN '67001' ELSE '67002' END AS transport_line_type_id
    FROM nation"""


@query("dim_shift_full", with_model(f"""
    SELECT p.p_partkey AS id, CAST(p.p_size AS BIGINT) AS line_id, l.line_name, l.line_no, l.line_org_id,
           l.transport_line_type_id, d.name AS transport_line_type_name,
           lpad(CAST(p.p_size % 24 AS VARCHAR), 2, '0') || ':00' AS start_time, '{RUN_DATE}' AS dt
    FROM part p JOIN ({LINES_SQL}) l ON CAST(p.p_size AS BIGINT) = l.line_id
    JOIN dic d ON l.transport_line_type_id = d.id""", "dic"))
def dim_shift_full(spark, sf_dir):
    """Shift (part row) on its line (nation row) with the line type decoded."""
    p = load(spark, sf_dir, "part")
    s = p.select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("__line"),
                 F.concat(F.lpad((F.col("p_size") % 24).cast("string"), 2, "0"), F.lit(":00")).alias("start_time"))
    j = s.join(maybe_broadcast(lines(spark, sf_dir)), F.col("__line") == F.col("line_id")).drop("__line")
    return decode(j, "transport_line_type_id", model.dic(spark), "transport_line_type_name", unique=True, how="inner") \
        .withColumn("dt", F.lit(RUN_DATE))


def teams(spark, sf_dir):
    n = load(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("long").alias("team_id"),
                    F.concat(F.lit("TEAM_"), F.col("n_name")).alias("team_name"),
                    F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("team_no"))


TEAMS_SQL = """SELECT CAST(n_nationkey AS BIGINT) AS team_id, 'TEAM_' || n_name AS team_name,
                      'T' || CAST(n_nationkey AS VARCHAR) AS team_no FROM nation"""


@query("dim_driver_full", with_model(f"""
    SELECT u.id, u.id AS emp_id, o.id AS org_id, o.org_name, t.team_id, t.team_name, t.team_no,
           u.user_level AS license_type, '{RUN_DATE}' AS dt
    FROM user_info u JOIN organ o ON CAST(u.c_nationkey AS BIGINT) = o.id
    JOIN ({TEAMS_SQL}) t ON CAST(u.c_nationkey AS BIGINT) = t.team_id""", "user_info", "organ"))
def dim_driver_full(spark, sf_dir):
    u = model.user_info(spark, sf_dir).select("id", F.col("id").alias("emp_id"),
                                              F.col("c_nationkey").cast("long").alias("__k"),
                                              F.col("user_level").alias("license_type"))
    o = maybe_broadcast(model.organ(spark, sf_dir).select(F.col("id").alias("org_id"), "org_name"))
    return (u.join(o, F.col("__k") == F.col("org_id")).join(maybe_broadcast(teams(spark, sf_dir)),
                                                            F.col("__k") == F.col("team_id"))
             .select("id", "emp_id", "org_id", "org_name", "team_id", "team_name", "team_no", "license_type",
                     F.lit(RUN_DATE).alias("dt")))


@query("dim_truck_full", with_model(f"""
    WITH models AS (SELECT p_brand AS model_id, min(p_type) AS model_type, count(*) AS model_parts
                    FROM part GROUP BY p_brand)
    SELECT p.p_partkey AS id, 'TRUCK' || CAST(p.p_partkey AS VARCHAR) AS truck_no, t.team_id, t.team_name,
           m.model_id, m.model_type, d1.name AS model_type_name, m.model_parts,
           o.id AS org_id, o.org_name,
           CASE WHEN p.p_retailprice >= 1500 THEN '67001' ELSE '67002' END AS truck_line_type,
           d2.name AS truck_line_type_name, '{RUN_DATE}' AS dt
    FROM part p JOIN ({TEAMS_SQL}) t ON CAST(p.p_size AS BIGINT) = t.team_id
    JOIN models m ON p.p_brand = m.model_id
    JOIN organ o ON t.team_id = o.id
    JOIN dic d1 ON m.model_type = d1.id
    JOIN dic d2 ON (CASE WHEN p.p_retailprice >= 1500 THEN '67001' ELSE '67002' END) = d2.id""",
    "organ", "dic"))
def dim_truck_full(spark, sf_dir):
    """Truck (part) -> team -> model (per brand) -> organisation, with two
    dictionary roles (model type, line type) on the same dictionary."""
    p = load(spark, sf_dir, "part")
    models = p.groupBy(F.col("p_brand").alias("model_id")).agg(F.min("p_type").alias("model_type"),
                                                              F.count("*").alias("model_parts"))
    t = p.select(F.col("p_partkey").alias("id"),
                 F.concat(F.lit("TRUCK"), F.col("p_partkey").cast("string")).alias("truck_no"),
                 F.col("p_size").cast("long").alias("__team"), F.col("p_brand").alias("__model"),
                 F.when(F.col("p_retailprice") >= 1500, "67001").otherwise("67002").alias("truck_line_type"))
    o = maybe_broadcast(model.organ(spark, sf_dir).select(F.col("id").alias("org_id"), "org_name"))
    j = (t.join(maybe_broadcast(teams(spark, sf_dir)), F.col("__team") == F.col("team_id"))
          .join(maybe_broadcast(models), F.col("__model") == F.col("model_id"))
          .join(o, F.col("team_id") == F.col("org_id")))
    dic = model.dic(spark)
    j = decode(j, "model_type", dic, "model_type_name", unique=True, how="inner")
    j = decode(j, "truck_line_type", dic, "truck_line_type_name", unique=True, how="inner")
    return j.select("id", "truck_no", "team_id", "team_name", "model_id", "model_type", "model_type_name",
                    "model_parts", "org_id", "org_name", "truck_line_type", "truck_line_type_name",
                    F.lit(RUN_DATE).alias("dt"))


# Category tree of the retail items (level-3 codes are the part types).
CATEGORY3 = [("ECONOMY", "Economy", "C2-VALUE"), ("STANDARD", "Standard", "C2-VALUE"),
             ("PROMO", "Promotion", "C2-VALUE"), ("SMALL", "Small", "C2-SIZE"),
             ("MEDIUM", "Medium", "C2-SIZE")]
CATEGORY2 = [("C2-VALUE", "Value lines", "C1-GOODS"), ("C2-SIZE", "Size lines", "C1-GOODS")]
CATEGORY1 = [("C1-GOODS", "Goods")]


def _values(rows):
    return ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)


CAT_SQL = {
    "c3": f"SELECT * FROM (VALUES {_values(CATEGORY3)}) AS t(id, name, category2_id)",
    "c2": f"SELECT * FROM (VALUES {_values(CATEGORY2)}) AS t(id, name, category1_id)",
    "c1": f"SELECT * FROM (VALUES {_values(CATEGORY1)}) AS t(id, name)",
}


def category_path(spark):
    c3 = literal_table(spark, CATEGORY3, "c3_id string, c3_name string, category2_id string")
    c2 = literal_table(spark, CATEGORY2, "c2_id string, c2_name string, category1_id string")
    c1 = literal_table(spark, CATEGORY1, "c1_id string, c1_name string")
    return (c3.join(F.broadcast(c2), c3.category2_id == c2.c2_id)
              .join(F.broadcast(c1), F.col("category1_id") == c1.c1_id)
              .select("c3_id", "c3_name", "c2_id", "c2_name", "c1_id", "c1_name"))


@query("dim_category_path", f"""
    WITH c3 AS ({CAT_SQL['c3']}), c2 AS ({CAT_SQL['c2']}), c1 AS ({CAT_SQL['c1']})
    SELECT p.p_partkey AS sku_id, c3.id AS c3_id, c3.name AS c3_name, c2.id AS c2_id, c2.name AS c2_name,
           c1.id AS c1_id, c1.name AS c1_name
    FROM part p JOIN c3 ON p.p_type = c3.id JOIN c2 ON c3.category2_id = c2.id JOIN c1 ON c2.category1_id = c1.id""")
def dim_category_path(spark, sf_dir):
    """Item -> level 3 -> level 2 -> level 1 category names; the (bounded)
    category tree is joined once and broadcast to the item scan."""
    p = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("sku_id"), "p_type")
    path = category_path(spark)
    return p.join(F.broadcast(path), p.p_type == path.c3_id).drop("p_type")


@query("dim_sku_full", f"""
    WITH c3 AS ({CAT_SQL['c3']}), c2 AS ({CAT_SQL['c2']}), c1 AS ({CAT_SQL['c1']}),
    attr AS (SELECT l_partkey AS sku_id,
                    to_json(list_sort(list(DISTINCT {{'attr_id': 'returnflag', 'value_id': l_returnflag,
                                                    'attr_name': 'return flag',
                                                    'value_name': 'flag ' || l_returnflag}}))) AS attrs
             FROM lineitem GROUP BY l_partkey),
    sale AS (SELECT l_partkey AS sku_id,
                    to_json(list_sort(list(DISTINCT {{'sale_attr_id': 'linestatus', 'sale_attr_value_id': l_linestatus,
                                                    'sale_attr_name': 'line status',
                                                    'sale_attr_value_name': 'status ' || l_linestatus}})))
                        AS sale_attrs
             FROM lineitem GROUP BY l_partkey)
    SELECT p.p_partkey AS id, CAST(p.p_retailprice AS DECIMAL(16,2)) AS price, p.p_name AS sku_name,
           CAST(p.p_size AS DECIMAL(16,2)) AS weight, p.p_size > 10 AS is_sale,
           split_part(p.p_name, ' ', 1) AS spu_id, upper(split_part(p.p_name, ' ', 1)) AS spu_name,
           p.p_type AS category3_id, c3.name AS category3_name, c3.category2_id, c2.name AS category2_name,
           c2.category1_id, c1.name AS category1_name, p.p_brand AS tm_id,
           replace(p.p_brand, 'Brand#', 'TM-') AS tm_name, attr.attrs, sale.sale_attrs, '{RUN_DATE}' AS dt
    FROM part p LEFT JOIN c3 ON p.p_type = c3.id LEFT JOIN c2 ON c3.category2_id = c2.id
    LEFT JOIN c1 ON c2.category1_id = c1.id
    LEFT JOIN attr ON p.p_partkey = attr.sku_id LEFT JOIN sale ON p.p_partkey = sale.sku_id""")
def dim_sku_full(spark, sf_dir):
    """Item with product, category path, trademark and attribute sets
    (``collect_set`` of structs, sorted, serialised as JSON text)."""
    p = load(spark, sf_dir, "part")
    li = load(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus")
    attr = F.struct(F.lit("returnflag").alias("attr_id"), F.col("l_returnflag").alias("value_id"),
                    F.lit("return flag").alias("attr_name"), F.concat(F.lit("flag "), "l_returnflag").alias("value_name"))
    sale = F.struct(F.lit("linestatus").alias("sale_attr_id"), F.col("l_linestatus").alias("sale_attr_value_id"),
                    F.lit("line status").alias("sale_attr_name"),
                    F.concat(F.lit("status "), "l_linestatus").alias("sale_attr_value_name"))
    sets = li.groupBy(F.col("l_partkey").alias("__a")).agg(F.to_json(F.array_sort(F.collect_set(attr))).alias("attrs"),
                                                           F.to_json(F.array_sort(F.collect_set(sale))).alias("sale_attrs"))
    c3 = literal_table(spark, CATEGORY3, "__c3 string, category3_name string, category2_id string")
    c2 = literal_table(spark, CATEGORY2, "__c2 string, category2_name string, category1_id string")
    c1 = literal_table(spark, CATEGORY1, "__c1 string, category1_name string")
    spu = S.first_word(F.col("p_name"))
    j = (p.join(F.broadcast(c3), p.p_type == F.col("__c3"), "left")
          .join(F.broadcast(c2), F.col("category2_id") == F.col("__c2"), "left")
          .join(F.broadcast(c1), F.col("category1_id") == F.col("__c1"), "left")
          .join(sets, p.p_partkey == F.col("__a"), "left"))
    return j.select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").cast("decimal(16,2)").alias("price"),
        F.col("p_name").alias("sku_name"), F.col("p_size").cast("decimal(16,2)").alias("weight"),
        (F.col("p_size") > 10).alias("is_sale"), spu.alias("spu_id"), F.upper(spu).alias("spu_name"),
        F.col("p_type").alias("category3_id"), "category3_name", "category2_id", "category2_name",
        "category1_id", "category1_name", F.col("p_brand").alias("tm_id"),
        F.regexp_replace("p_brand", "Brand#", "TM-").alias("tm_name"), "attrs", "sale_attrs",
        F.lit(RUN_DATE).alias("dt"))


@query("dim_coupon_full", with_model(f"""
    SELECT c.id, c.coupon_type, d1.name AS coupon_type_name, c.condition_amount, c.condition_num,
           c.benefit_amount, c.benefit_discount,
           CASE coupon_type WHEN '3201' THEN '满' || condition_amount || '元减' || benefit_amount || '元'
                            WHEN '3202' THEN '满' || condition_num || '件打' || benefit_discount || '折'
                            WHEN '3203' THEN '减' || benefit_amount || '元' END AS benefit_rule,
           CASE WHEN c.condition_num > 2 THEN '67001' ELSE '67002' END AS range_type, d2.name AS range_type_name,
           '{RUN_DATE}' AS dt
    FROM ({COUPONS_SQL}) c LEFT JOIN dic d1 ON c.coupon_type = d1.id
    LEFT JOIN dic d2 ON (CASE WHEN c.condition_num > 2 THEN '67001' ELSE '67002' END) = d2.id""", "dic"))
def dim_coupon_full(spark, sf_dir):
    """Coupon with two dictionary roles (type, range) and its rule text. The
    coupon type codes have no dictionary entry: left joins keep them."""
    c = coupons(spark, sf_dir).withColumn(
        "range_type", F.when(F.col("condition_num") > 2, "67001").otherwise("67002"))
    d = model.dic(spark)
    c = decode(c, "coupon_type", d, "coupon_type_name", unique=True)
    c = decode(c, "range_type", d, "range_type_name", unique=True)
    return c.select("id", "coupon_type", "coupon_type_name", "condition_amount", "condition_num", "benefit_amount",
                    "benefit_discount", rule_text("coupon").alias("benefit_rule"), "range_type", "range_type_name",
                    F.lit(RUN_DATE).alias("dt"))


def activity_rules(spark, sf_dir):
    c = coupons(spark, sf_dir)
    return c.select(F.col("id").alias("rule_id"),
                    F.concat(F.lit("A"), (F.col("id") / 100).cast("bigint").cast("string")).alias("activity_id"),
                    F.concat(F.lit("31"), F.substring("coupon_type", 3, 2)).alias("activity_type"),
                    "condition_amount", "condition_num", "benefit_amount", "benefit_discount")


@query("dim_activity_full", with_model(f"""
    SELECT r.rule_id, r.activity_id, i.activity_name, r.activity_type, d.name AS activity_type_name,
           r.condition_amount, r.condition_num, r.benefit_amount, r.benefit_discount,
           CASE r.activity_type WHEN '3101' THEN '满' || condition_amount || '元减' || benefit_amount || '元'
                                WHEN '3102' THEN '满' || condition_num || '件打' || benefit_discount || '折'
                                WHEN '3103' THEN '打' || benefit_discount || '折' END AS benefit_rule,
           '{RUN_DATE}' AS dt
    FROM (SELECT id AS rule_id, 'A' || CAST(CAST(trunc(id / 100) AS BIGINT) AS VARCHAR) AS activity_id,
                 '31' || substr(coupon_type, 3, 2) AS activity_type, condition_amount, condition_num,
                 benefit_amount, benefit_discount FROM ({COUPONS_SQL}) c) r
    LEFT JOIN (SELECT DISTINCT 'A' || CAST(CAST(trunc(p_partkey / 100) AS BIGINT) AS VARCHAR) AS activity_id,
                      'Activity ' || CAST(CAST(trunc(p_partkey / 100) AS BIGINT) AS VARCHAR) AS activity_name
               FROM part) i ON r.activity_id = i.activity_id
    LEFT JOIN dic d ON r.activity_type = d.id""", "dic"))
def dim_activity_full(spark, sf_dir):
    """Activity rule -> activity -> dictionary, with rule text."""
    r = activity_rules(spark, sf_dir)
    p = load(spark, sf_dir, "part")
    info = p.select(F.concat(F.lit("A"), (F.col("p_partkey") / 100).cast("bigint").cast("string")).alias("__aid"),
                    F.concat(F.lit("Activity "), (F.col("p_partkey") / 100).cast("bigint").cast("string"))
                    .alias("activity_name")).distinct()
    j = r.join(info, r.activity_id == F.col("__aid"), "left")
    j = decode(j, "activity_type", model.dic(spark), "activity_type_name", unique=True)
    return j.select("rule_id", "activity_id", "activity_name", "activity_type", "activity_type_name",
                    "condition_amount", "condition_num", "benefit_amount", "benefit_discount",
                    rule_text("activity").alias("benefit_rule"), F.lit(RUN_DATE).alias("dt"))


@query("dim_province_full", f"""
    SELECT n.n_nationkey AS id, n.n_name AS province_name, 'AC' || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS area_code,
           'ISO-' || CAST(n.n_nationkey AS VARCHAR) AS iso_code, r.r_regionkey AS region_id, r.r_name AS region_name,
           '{RUN_DATE}' AS dt
    FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def dim_province_full(spark, sf_dir):
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    return n.join(maybe_broadcast(r), n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("province_name"),
        F.concat(F.lit("AC"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("area_code"),
        F.concat(F.lit("ISO-"), F.col("n_nationkey").cast("string")).alias("iso_code"),
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"), F.lit(RUN_DATE).alias("dt"))


@query("dim_copy_redate", f"""
    SELECT p_partkey AS id, p_name AS pos_name, p_type AS pos_type, '{RUN_DATE}' AS dt FROM part""")
def dim_copy_redate(spark, sf_dir):
    """Projection re-dated to the run date (promotion position copy)."""
    p = load(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("pos_name"),
                    F.col("p_type").alias("pos_type"), F.lit(RUN_DATE).alias("dt"))


def user_zip_init(spark, sf_dir, where=None):
    u = model.user_info(spark, sf_dir, where)
    return u.select(
        "id", "login_name", F.md5("real_name").alias("real_name"),
        S.md5_if_valid(F.col("phone_num"), S.PHONE_RE).alias("phone_num"),
        S.md5_if_valid(F.col("email"), S.EMAIL_RE).alias("email"),
        "user_level", F.date_from_unix_date(F.col("birthday")).alias("birthday"), "gender",
        F.lit(RUN_DATE).alias("start_date"), F.lit("9999-12-31").alias("end_date"))


USER_ZIP_INIT_SQL = f"""
    SELECT id, login_name, md5(real_name) AS real_name,
           md5(CASE WHEN regexp_matches(phone_num, '{PHONE}') THEN phone_num END) AS phone_num,
           md5(CASE WHEN regexp_matches(email, '{EMAIL}') THEN email END) AS email,
           user_level, DATE '1970-01-01' + birthday AS birthday, gender,
           '{RUN_DATE}' AS start_date, '9999-12-31' AS end_date
    FROM user_info"""


@query("dim_user_zip_init", with_model(USER_ZIP_INIT_SQL, "user_info"))
def dim_user_zip_init(spark, sf_dir):
    """First load of the user zipper: PII hashed only when well-formed, open interval."""
    return user_zip_init(spark, sf_dir)


@query("dim_address_zip_init", f"""
    SELECT o_orderkey AS id, o_custkey AS user_id,
           md5(CASE WHEN regexp_matches('13' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'), '{PHONE}')
                    THEN '13' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END) AS phone,
           'Street ' || CAST(o_orderkey AS VARCHAR) AS address, o_orderpriority = '1-URGENT' AS is_default,
           substr(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z'), 1, 10) || ' ' ||
               substr(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z'), 12, 8) AS create_time,
           strftime(o_orderdate, '%Y-%m-%d') AS start_date, '9999-12-31' AS end_date
    FROM orders""")
def dim_address_zip_init(spark, sf_dir):
    """Address zipper first load (an address per order): phone hashed when
    valid, ISO text turned into ``yyyy-MM-dd HH:mm:ss`` by position."""
    from dovetail.functions.dates import iso_to_text
    o = load(spark, sf_dir, "orders")
    phone = F.concat(F.lit("13"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.000'Z'")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
                    S.md5_if_valid(phone, S.PHONE_RE).alias("phone"),
                    F.concat(F.lit("Street "), F.col("o_orderkey").cast("string")).alias("address"),
                    (F.col("o_orderpriority") == "1-URGENT").alias("is_default"),
                    iso_to_text(iso).alias("create_time"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"),
                    F.lit("9999-12-31").alias("end_date"))


DAY2 = "1998-08-03"


def user_changes(spark, sf_dir):
    """Day-2 change set: customers with a negative balance change level."""
    return user_zip_init(spark, sf_dir, F.col("c_acctbal") < 0).withColumn("user_level", F.lit("RECOVERY"))


@query("dim_user_zip", with_model(f"""
    WITH init AS ({USER_ZIP_INIT_SQL}),
         chg AS (SELECT * REPLACE ('RECOVERY' AS user_level) FROM init
                 WHERE id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))
    SELECT id, login_name, real_name, phone_num, email, user_level, birthday, gender, start_date,
           CASE WHEN id IN (SELECT id FROM chg) THEN CAST(DATE '{DAY2}' - 1 AS VARCHAR) ELSE end_date END AS end_date
    FROM init
    UNION ALL
    SELECT id, login_name, real_name, phone_num, email, user_level, birthday, gender,
           '{DAY2}' AS start_date, '9999-12-31' AS end_date FROM chg""", "user_info"))
def dim_user_zip(spark, sf_dir):
    """Daily zipper merge: the stored open versions of day 1 and the changes of
    day 2. Changed users get their open version closed on day-2 minus one and a
    new open version."""
    first = user_zip_init(spark, sf_dir)
    history = ZipperStore(shared_dir(spark, "zipper", "user", source_state(spark, sf_dir, ("customer",))), "id")
    if not history.days(spark):
        history.begin(first, RUN_DATE)
    merged = ZipperStore(scratch_dir(spark, "user-zip"), "id")
    history.merge(user_changes(spark, sf_dir), DAY2, into=merged)
    return history.read(spark, first.schema, merged)


@query("latest_per_key", """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_per_key_q(spark, sf_dir):
    """Each customer's latest order (ties: larger order key)."""
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
