"""Scalar-function coverage keys: each applies a family of column functions
to a whole driver table (narrow projections: one scan stage, no shuffle)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dovetail.functions import dates as D
from dovetail.functions import strings as S
from dovetail.functions.math import BUCKET_OVERRIDES, hash_bucket, hex_or_decimal, wei_to_ether
from dovetail.registry import query
from dovetail.sources import model
from dovetail.sources.model import RUN_DATE
from dovetail.sources.model_sql import with_model
from dovetail.sources.tables import live_slice, load

R = f"DATE '{RUN_DATE}'"


@query("scan_live_slice", f"""
    SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(16,2)) AS amount,
           strftime(o_orderdate, '%Y-%m-%d') AS dt
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '{RUN_DATE}' - INTERVAL 6 DAY AND o_orderdate < TIMESTAMP '{RUN_DATE}' + INTERVAL 1 DAY
      AND NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')""")
def scan_live_slice(spark, sf_dir):
    """One week of daily slices of the order snapshot, live rows only. The day
    range also goes on the raw timestamp so the parquet reader skips row
    groups; ``live_slice`` keeps the reference's dt / is_deleted form."""
    o = load(spark, sf_dir, "orders")
    lo = F.date_sub(F.lit(RUN_DATE).cast("date"), 6).cast("timestamp_ntz")
    hi = F.date_add(F.lit(RUN_DATE).cast("date"), 1).cast("timestamp_ntz")
    o = o.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))
    ods = o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                   F.col("o_totalprice").cast("decimal(16,2)").alias("amount"),
                   F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
                   F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), "1")
                    .otherwise("0").alias("is_deleted"))
    from datetime import date, timedelta
    days = [str(date.fromisoformat(RUN_DATE) - timedelta(days=i)) for i in range(7)]
    return live_slice(ods, days, ["order_id", "user_id", "amount", "dt"])


@query("fn_string", with_model("""
    SELECT id,
           concat(user_level, '-', CAST(c_nationkey AS VARCHAR)) AS level_code,
           substr(real_name, 1, 8) AS name_head,
           md5(CASE WHEN regexp_matches(phone_num, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\\d{8}$')
                    THEN phone_num END) AS phone_md5,
           regexp_matches(email, '^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\\.[a-zA-Z0-9_-]+)+$') AS email_ok,
           lpad(CAST(id AS VARCHAR), 10, '0') AS padded_id,
           user_level || repeat(' ', 2) || 'x' AS spaced,
           split_part(replace(real_name, '#', ' '), ' ', 1) AS first_word,
           split_part(concat_ws(',', user_level, login_name, gender), ',', 1) AS first_item,
           split_part(concat_ws(',', user_level, login_name, gender), ',', -1) AS last_item,
           upper(substr(lower(user_level), 1, 1)) || substr(lower(user_level), 2) AS cap_first,
           lower(substr(user_level, 1, 1)) || substr(user_level, 2) AS lower_first,
           repeat('*', length(user_level)) AS stars,
           (trim(substr(real_name, 19)) = '') AS tail_blank,
           split(email, '@')[1] AS email_user
    FROM user_info""", "user_info"))
def fn_string(spark, sf_dir):
    u = model.user_info(spark, sf_dir)
    items = F.concat_ws(",", "user_level", "login_name", "gender")
    return u.select(
        "id",
        F.concat("user_level", F.lit("-"), F.col("c_nationkey").cast("string")).alias("level_code"),
        F.substring("real_name", 1, 8).alias("name_head"),
        S.md5_if_valid(F.col("phone_num"), S.PHONE_RE).alias("phone_md5"),
        F.col("email").rlike(S.EMAIL_RE).alias("email_ok"),
        F.lpad(F.col("id").cast("string"), 10, "0").alias("padded_id"),
        F.concat("user_level", F.expr("space(2)"), F.lit("x")).alias("spaced"),
        S.first_word(F.regexp_replace("real_name", "#", " ")).alias("first_word"),
        S.first_item(items).alias("first_item"),
        S.last_item(items).alias("last_item"),
        S.cap_first(F.lower("user_level")).alias("cap_first"),
        S.lower_first(F.col("user_level")).alias("lower_first"),
        F.repeat(F.lit("*"), F.length("user_level")).alias("stars"),
        S.is_blank(F.substring("real_name", 19, 1 << 30)).alias("tail_blank"),
        F.split("email", "@").getItem(0).alias("email_user"),
    )


@query("fn_date", """
    SELECT event_id,
           strftime(ts, '%Y-%m-%d') AS day,
           strftime(ts, '%Y%m%d') AS day_compact,
           epoch_us(ts) // 1000 AS ts_ms,
           strftime(epoch_ms(epoch_us(ts) // 1000), '%Y-%m-%d %H:%M:%S') AS ms_text,
           strftime(epoch_ms(epoch_us(ts) // 1000), '%Y-%m-%d') AS ms_day,
           substr(strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z'), 1, 10) || ' ' ||
               substr(strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z'), 12, 8) AS iso_text,
           CAST(ts AS DATE) - DATE '1970-01-01' AS epoch_day,
           DATE '1970-01-01' + CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS INTEGER) AS from_epoch_day,
           CAST(ts AS DATE) + 7 AS plus_7,
           CAST(ts AS DATE) - 29 AS minus_29,
           epoch(date_trunc('second', ts))::BIGINT AS unix_sec,
           strftime(to_timestamp(epoch(date_trunc('second', ts))::BIGINT), '%Y-%m-%d %H:%M:%S') AS from_unix,
           CAST(trunc(value * 60000) AS BIGINT) // 1000 AS dur_sec
    FROM events""")
def fn_date(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    ms = D.epoch_ms(F.col("ts"))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.000'Z'")
    sec = (ms / 1000).cast("bigint")
    end_ms = ms + (F.col("value") * 60000).cast("bigint")
    return e.select(
        "event_id",
        D.day_text(F.col("ts")).alias("day"),
        F.date_format("ts", "yyyyMMdd").alias("day_compact"),
        ms.alias("ts_ms"),
        F.date_format(F.to_utc_timestamp(F.timestamp_millis(ms), F.current_timezone()),
                      "yyyy-MM-dd HH:mm:ss").alias("ms_text"),
        D.millis_to_day(ms).alias("ms_day"),
        D.iso_to_text(iso).alias("iso_text"),
        F.unix_date(F.col("ts").cast("date")).alias("epoch_day"),
        F.date_from_unix_date(F.unix_date(F.col("ts").cast("date"))).alias("from_epoch_day"),
        F.date_add(F.col("ts").cast("date"), 7).alias("plus_7"),
        F.date_sub(F.col("ts").cast("date"), 29).alias("minus_29"),
        sec.alias("unix_sec"),
        F.date_format(F.to_utc_timestamp(F.timestamp_seconds(sec), F.current_timezone()),
                      "yyyy-MM-dd HH:mm:ss").alias("from_unix"),
        ((end_ms - ms) / 1000).cast("bigint").alias("dur_sec"),
    )


@query("fn_math", """
    SELECT l_orderkey, l_linenumber,
           CAST(l_extendedprice AS DECIMAL(16,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS revenue,
           CAST(CAST(l_quantity AS DECIMAL(16,0)) * CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR)
               AS amount_text,
           round(CAST(l_extendedprice AS DECIMAL(16,2)) / 7, 3) AS per_day,
           CAST(floor(l_extendedprice / 1000) AS BIGINT) AS thousands,
           (l_linenumber + 3) * 2 - 1 AS arith,
           CASE WHEN l_linenumber = 7 THEN '0' WHEN l_linenumber = 6 THEN CAST(l_orderkey AS VARCHAR) || '.5'
                ELSE CAST(CAST(l_orderkey AS HUGEINT) * CAST(pow(2, 16 * l_linenumber) AS HUGEINT) AS VARCHAR)
           END AS from_hex,
           CAST(CAST(l_orderkey AS DECIMAL(38,18)) * l_linenumber / 1000000 AS DECIMAL(38,18)) AS ether
    FROM lineitem""")
def fn_math(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(16,2)")
    return li.select(
        "l_orderkey", "l_linenumber",
        (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).alias("revenue"),
        (F.col("l_quantity").cast("decimal(16,0)") * price).cast("string").alias("amount_text"),
        F.round(price / F.lit(7), 3).alias("per_day"),
        F.floor(F.col("l_extendedprice") / 1000).cast("bigint").alias("thousands"),
        ((F.col("l_linenumber") + 3) * 2 - 1).alias("arith"),
        # up to 4 * linenumber zeros behind the key's own digits, then a fraction, then null
        hex_or_decimal(F.when(F.col("l_linenumber") < 6, F.concat(
            F.lit("0x"), F.lower(F.hex("l_orderkey")), F.expr("repeat('0', 4 * cast(l_linenumber as int))")))
            .when(F.col("l_linenumber") == 6, F.concat(F.col("l_orderkey").cast("string"), F.lit(".5")))).alias("from_hex"),
        wei_to_ether((F.col("l_orderkey").cast("decimal(38,0)") * F.col("l_linenumber") * F.lit(10 ** 12)).cast("decimal(38,0)")
                     .cast("string")).alias("ether"),
    )


@query("fn_conditional", """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'open' END AS state,
           coalesce(CASE WHEN o_orderstatus = 'P' THEN 'partial' END, 'n/a') AS partial,
           CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 9 END AS prio,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio_num,
           TRY_CAST(o_orderpriority AS INTEGER) AS prio_bad,
           CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) AS cust_roundtrip,
           CAST(CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS BOOLEAN) AS is_open,
           CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(16,2)) AS price_dec
    FROM orders""")
def fn_conditional(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "finished").otherwise("open").alias("state"),
        F.coalesce(F.when(F.col("o_orderstatus") == "P", "partial"), F.lit("n/a")).alias("partial"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2)
         .otherwise(9).alias("prio"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("prio_num"),
        F.col("o_orderpriority").try_cast("int").alias("prio_bad"),
        F.col("o_custkey").cast("string").cast("bigint").alias("cust_roundtrip"),
        F.when(F.col("o_orderstatus") == "O", "true").otherwise("false").cast("boolean").alias("is_open"),
        F.col("o_totalprice").cast("string").cast("decimal(16,2)").alias("price_dec"),
    )


@query("fn_array_map_struct", """
    SELECT event_id, pos, item, first_id, k_value, type_of_pair
    FROM (SELECT event_id, [event_type, strftime(ts, '%Y-%m-%d'), CAST(user_id AS VARCHAR)] AS arr,
                 event_id AS first_id,
                 MAP {'k': CAST(json_extract_string(props, '$.k') AS INTEGER)}['k'] AS k_value,
                 {'type': event_type, 'user': user_id}.type AS type_of_pair
          FROM events) e,
         LATERAL (SELECT unnest(range(0, 3)) AS pos, unnest(arr) AS item) x""")
def fn_array_map_struct(spark, sf_dir):
    """array / index / posexplode, a struct field and a map lookup. Mixed
    types go in a struct, never in one array."""
    e = load(spark, sf_dir, "events")
    arr = F.array("event_type", F.date_format("ts", "yyyy-MM-dd"), F.col("user_id").cast("string"))
    m = F.create_map(F.lit("k"), F.get_json_object("props", "$.k").cast("int"))
    pair = F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))
    base = e.select("event_id", arr.alias("arr"), F.array("event_id", "user_id")[0].alias("first_id"),
                    m["k"].alias("k_value"), pair["type"].alias("type_of_pair"))
    return base.select("event_id", F.posexplode("arr").alias("pos", "item"), "first_id", "k_value", "type_of_pair")


@query("fn_json", """
    SELECT event_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           json_object('user', user_id, 'type', event_type, 'k', CAST(json_extract_string(props, '$.k') AS INTEGER))
               AS doc,
           json_object('user', user_id, 'k', CAST(json_extract_string(props, '$.k') AS INTEGER)) AS doc_without_type,
           contains(props, '"k"') AS has_k
    FROM events""")
def fn_json(spark, sf_dir):
    """Parse, nested get, put, remove, serialise. ``from_json`` gives the
    typed struct; dropping a field before ``to_json`` is the remove."""
    e = load(spark, sf_dir, "events")
    parsed = F.from_json("props", T.StructType([T.StructField("k", T.IntegerType())]))
    doc = F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"), parsed["k"].alias("k"))
    return e.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.to_json(doc).alias("doc"),
        F.to_json(doc.dropFields("type")).alias("doc_without_type"),
        F.col("props").contains('"k"').alias("has_k"),
    )


@query("mask_contacts", with_model("""
    SELECT id, substr(real_name, 1, 1) || '*' AS name,
           CASE WHEN regexp_matches(phone_num, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\\d{8}$')
                THEN substr(phone_num, 1, 3) || '****' || substr(phone_num, 8) END AS phone_num,
           CASE WHEN regexp_matches(email, '^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\\.[a-zA-Z0-9_-]+)+$')
                THEN '***@' || split_part(email, '@', 2) END AS email
    FROM user_info""", "user_info"))
def mask_contacts(spark, sf_dir):
    u = model.user_info(spark, sf_dir)
    return u.select("id", S.mask_name(F.col("real_name")).alias("name"),
                    S.mask_phone(F.col("phone_num")).alias("phone_num"),
                    S.mask_email(F.col("email")).alias("email"))


_OVR = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BUCKET_OVERRIDES.items())


@query("hash_bucket", f"""
    SELECT bucket, count(*) AS n FROM (
        SELECT CASE lower(CAST(o_custkey AS VARCHAR)) {_OVR}
               ELSE lpad(CAST((('0x' || right(md5(CAST(o_custkey AS VARCHAR)), 3))::INTEGER % 128) AS VARCHAR), 4, '0')
               END AS bucket
        FROM orders) GROUP BY bucket""")
def hash_bucket_counts(spark, sf_dir):
    """Rows per stable hash bucket (128 buckets) of the order's customer key."""
    o = load(spark, sf_dir, "orders")
    return (o.select(hash_bucket(F.col("o_custkey"), 128, BUCKET_OVERRIDES).alias("bucket"))
             .groupBy("bucket").agg(F.count("*").alias("n")))


@query("time_slot", """
    SELECT slot, count(*) AS n FROM (
        SELECT CASE WHEN hour(ts) < 6 THEN '凌晨' WHEN hour(ts) < 9 THEN '早晨' WHEN hour(ts) < 12 THEN '上午'
                    WHEN hour(ts) < 14 THEN '中午' WHEN hour(ts) < 18 THEN '下午' WHEN hour(ts) < 22 THEN '晚上'
                    ELSE '夜间' END AS slot
        FROM events WHERE event_type = 'purchase') GROUP BY slot""")
def time_slot(spark, sf_dir):
    """Purchases per day part."""
    e = load(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return e.groupBy(D.time_slot(F.col("ts")).alias("slot")).agg(F.count("*").alias("n"))


_Z = D.ZODIAC_STARTS
_ZSQL = " ".join(f"WHEN md >= {first} THEN '{name}'" for name, first in [_Z[-1]] + list(reversed(_Z[:-1])))


@query("zodiac_age", with_model(f"""
    SELECT id, birthday, age, decade, CASE {_ZSQL} ELSE '{_Z[-1][0]}' END AS zodiac_sign
    FROM (SELECT id, DATE '1970-01-01' + birthday AS birthday,
                 year({R}) - year(DATE '1970-01-01' + birthday)
                   - CASE WHEN month({R}) * 100 + day({R}) < month(DATE '1970-01-01' + birthday) * 100
                                + day(DATE '1970-01-01' + birthday) THEN 1 ELSE 0 END AS age,
                 CAST(floor(year(DATE '1970-01-01' + birthday) / 10) * 10 AS INTEGER) AS decade,
                 month(DATE '1970-01-01' + birthday) * 100 + day(DATE '1970-01-01' + birthday) AS md
          FROM user_info) u""", "user_info"))
def zodiac_age(spark, sf_dir):
    """Age on ``run_date`` (not the wall clock: deterministic), birth decade, sign."""
    u = model.user_info(spark, sf_dir)
    b = F.date_from_unix_date(F.col("birthday"))
    return u.select("id", b.alias("birthday"), D.age_years(b, F.lit(RUN_DATE).cast("date")).alias("age"),
                    D.decade(b).alias("decade"), D.zodiac(b).alias("zodiac_sign"))


def coupons(spark, sf_dir):
    """Coupons derived from parts: type by size band, thresholds from price."""
    p = load(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") <= 15, "3201").when(F.col("p_size") <= 35, "3202").otherwise("3203")
         .alias("coupon_type"),
        F.col("p_retailprice").cast("decimal(16,2)").alias("condition_amount"),
        (F.col("p_size") / 10).cast("int").cast("bigint").alias("condition_num"),
        F.col("p_size").cast("decimal(16,2)").alias("benefit_amount"),
        (F.lit(Decimal("9.5")) - F.col("p_size") / 10).cast("decimal(16,2)").alias("benefit_discount"),
    )


def rule_text(kind: str):
    # Promotion type codes and the rule-text templates.
    t = F.col(f"{kind}_type")
    if kind == "coupon":
        return (F.when(t == "3201", F.concat(F.lit("满"), "condition_amount", F.lit("元减"), "benefit_amount", F.lit("元")))
                 .when(t == "3202", F.concat(F.lit("满"), "condition_num", F.lit("件打"), "benefit_discount", F.lit("折")))
                 .when(t == "3203", F.concat(F.lit("减"), "benefit_amount", F.lit("元"))))
    return (F.when(t == "3101", F.concat(F.lit("满"), "condition_amount", F.lit("元减"), "benefit_amount", F.lit("元")))
             .when(t == "3102", F.concat(F.lit("满"), "condition_num", F.lit("件打"), "benefit_discount", F.lit("折")))
             .when(t == "3103", F.concat(F.lit("打"), "benefit_discount", F.lit("折"))))


COUPONS_SQL = """
    SELECT p_partkey AS id,
           CASE WHEN p_size <= 15 THEN '3201' WHEN p_size <= 35 THEN '3202' ELSE '3203' END AS coupon_type,
           CAST(p_retailprice AS DECIMAL(16,2)) AS condition_amount,
           CAST(trunc(p_size / 10) AS BIGINT) AS condition_num,
           CAST(p_size AS DECIMAL(16,2)) AS benefit_amount,
           CAST(9.5 - p_size / 10 AS DECIMAL(16,2)) AS benefit_discount
    FROM part"""


@query("coupon_rule_text", f"""
    SELECT id, coupon_type,
           CASE coupon_type WHEN '3201' THEN '满' || condition_amount || '元减' || benefit_amount || '元'
                            WHEN '3202' THEN '满' || condition_num || '件打' || benefit_discount || '折'
                            WHEN '3203' THEN '减' || benefit_amount || '元' END AS benefit_rule
    FROM ({COUPONS_SQL}) c""")
def coupon_rule_text(spark, sf_dir):
    return coupons(spark, sf_dir).select("id", "coupon_type", rule_text("coupon").alias("benefit_rule"))


@query("day_range", """
    WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
         spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
         have AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT CAST(strftime(spine.d, '%Y%m%d') AS INTEGER) AS day_id, have.d IS NOT NULL AS has_orders
    FROM spine LEFT JOIN have ON spine.d = have.d""")
def day_range(spark, sf_dir):
    """Inclusive day spine between the first and last order day as yyyymmdd
    integers, left-joined to the days that hold orders (finds gaps). The
    spine grows with the date range, not with the row count."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    b = o.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    spine = b.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    have = o.distinct().withColumn("has", F.lit(True))
    return spine.join(have, "d", "left").select(
        F.date_format("d", "yyyyMMdd").cast("int").alias("day_id"),
        F.coalesce(F.col("has"), F.lit(False)).alias("has_orders"))


@query("hex_chunks", """
    SELECT o_orderkey, i AS chunk_no, '0x' || substr(data, 3 + 64 * i, 64) AS chunk
    FROM (SELECT o_orderkey, '0x' || sha256(CAST(o_orderkey AS VARCHAR)) || sha256(o_orderpriority) AS data
          FROM orders) t, LATERAL (SELECT unnest(range(0, length(data) // 64)) AS i) x""")
def hex_chunks(spark, sf_dir):
    """Split a ``0x``-prefixed hex payload into 64-character words."""
    o = load(spark, sf_dir, "orders")
    data = F.concat(F.lit("0x"), F.sha2(F.col("o_orderkey").cast("string"), 256), F.sha2("o_orderpriority", 256))
    return hex_words(o.select("o_orderkey", data.alias("data")), "o_orderkey")


def hex_words(t, key):
    """64-character words of ``data``; none in a payload shorter than one word."""
    words = (F.length("data") / 64).cast("int")
    idx = F.when(words > 0, F.sequence(F.lit(0), words - 1))
    return t.select(key, "data", F.explode(idx).alias("chunk_no")).select(
        key, "chunk_no", F.concat(F.lit("0x"), F.expr("substring(data, 3 + 64 * chunk_no, 64)")).alias("chunk"))


@query("dim_date", """
    WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)
    SELECT strftime(d, '%Y-%m-%d') AS date_id, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
           day(d) AS day, week(d) AS week_of_year, dayofweek(d) + 1 AS day_of_week,
           dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b) s""")
def dim_date(spark, sf_dir):
    """Calendar over the order date range (built once, small)."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    s = o.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return s.select(F.date_format("d", "yyyy-MM-dd").alias("date_id"), F.year("d").alias("year"),
                    F.quarter("d").alias("quarter"), F.month("d").alias("month"), F.dayofmonth("d").alias("day"),
                    F.weekofyear("d").alias("week_of_year"), F.dayofweek("d").alias("day_of_week"),
                    F.dayofweek("d").isin(1, 7).alias("is_weekend"))


@query("limit_ordered", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500""")
def limit_ordered(spark, sf_dir):
    """Top-500 orders by value: the limit is the feature (a top-k report).
    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top 500, only those reach the final merge."""
    o = load(spark, sf_dir, "orders")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(500).select("o_orderkey", "o_totalprice")
