"""User age-band labels: device / search scores, order scores, base profile,
band totals and the final arg-max band.

Score tables are data: one small DataFrame ``(family, value, band, score)``
(broadcast; size fixed by the tables below) joined to the facts. Scores are
exact decimals ``factor x family weight`` rounded half-up to 3 places.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dovetail.functions import dates as D
from dovetail.operators.joins import binned_interval_join, interval_join
from dovetail.operators.windows import latest_per_key
from dovetail.registry import query
from dovetail.sources.literal import literal_table
from dovetail.sources.tables import load

BANDS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]

# Family weights of the age model.
WEIGHTS = {"device": "0.1", "search": "0.15", "time": "0.1", "amount": "0.15", "brand": "0.2", "category": "0.3"}

# Band factors per family and value, bands in the order of BANDS.
# '*' is the factor row used when the value has no row of its own.
FACTORS = [
    ("device", "iOS", [0.7, 0.6, 0.5, 0.4, 0.3, 0.2]),
    ("device", "Android", [0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    ("search", "时尚与潮流", [0.9, 0.7, 0.5, 0.3, 0.2, 0.1]),
    ("search", "性价比", [0.2, 0.4, 0.6, 0.7, 0.8, 0.8]),
    ("search", "健康与养生", [0.1, 0.2, 0.4, 0.6, 0.8, 0.7]),
    ("search", "家庭与育儿", [0.1, 0.2, 0.4, 0.6, 0.8, 0.7]),
    ("search", "科技与数码", [0.8, 0.6, 0.4, 0.3, 0.2, 0.1]),
    ("search", "学习与发展", [0.4, 0.5, 0.6, 0.7, 0.8, 0.7]),
    ("search", "*", [0, 0, 0, 0, 0, 0]),
    ("time", "凌晨", [0.2, 0.1, 0.1, 0.1, 0.1, 0.1]),
    ("time", "早晨", [0.1, 0.1, 0.1, 0.1, 0.2, 0.3]),
    ("time", "上午", [0.2, 0.2, 0.2, 0.2, 0.3, 0.4]),
    ("time", "中午", [0.4, 0.4, 0.4, 0.4, 0.4, 0.3]),
    ("time", "下午", [0.4, 0.5, 0.5, 0.5, 0.5, 0.4]),
    ("time", "晚上", [0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    ("time", "夜间", [0.9, 0.7, 0.5, 0.3, 0.2, 0.1]),
    ("amount", "低消费", [0.8, 0.6, 0.4, 0.3, 0.2, 0.1]),
    ("amount", "中消费", [0.2, 0.4, 0.6, 0.7, 0.8, 0.7]),
    ("amount", "高消费", [0.1, 0.2, 0.3, 0.4, 0.5, 0.6]),
    ("brand", "TCL", [0.2, 0.3, 0.4, 0.5, 0.6, 0.7]),
    ("brand", "苹果", [0.9, 0.8, 0.7, 0.7, 0.7, 0.5]),
    ("brand", "联想", [0.9, 0.8, 0.7, 0.7, 0.7, 0.5]),
    ("brand", "小米", [0.9, 0.8, 0.7, 0.7, 0.7, 0.5]),
    ("brand", "欧莱雅", [0.5, 0.6, 0.8, 0.8, 0.9, 0.2]),
    ("brand", "香奈儿", [0.3, 0.4, 0.6, 0.8, 0.9, 0.2]),
    ("brand", "*", [0.1, 0.2, 0.3, 0.4, 0.5, 0.6]),
    ("category", "数码", [0.9, 0.8, 0.6, 0.4, 0.2, 0.1]),
    ("category", "手机", [0.9, 0.8, 0.6, 0.4, 0.2, 0.1]),
    ("category", "电脑办公", [0.9, 0.8, 0.6, 0.4, 0.2, 0.1]),
    ("category", "个护化妆", [0.9, 0.8, 0.6, 0.4, 0.2, 0.1]),
    ("category", "服饰内衣", [0.9, 0.8, 0.6, 0.4, 0.2, 0.1]),
    ("category", "家居家装", [0.2, 0.4, 0.6, 0.8, 0.9, 0.7]),
    ("category", "图书、音像、电子书刊", [0.2, 0.4, 0.6, 0.8, 0.9, 0.7]),
    ("category", "厨具", [0.2, 0.4, 0.6, 0.8, 0.9, 0.7]),
    ("category", "鞋靴", [0.2, 0.4, 0.6, 0.8, 0.9, 0.7]),
    ("category", "母婴", [0.2, 0.4, 0.6, 0.8, 0.9, 0.7]),
    ("category", "汽车用品", [0.2, 0.4, 0.6, 0.8, 0.9, 0.7]),
    ("category", "珠宝", [0.2, 0.4, 0.6, 0.8, 0.9, 0.7]),
    ("category", "家用电器", [0.2, 0.4, 0.6, 0.8, 0.9, 0.7]),
    ("category", "*", [0.1, 0.2, 0.4, 0.5, 0.8, 0.9]),
]

# Fixed values (test fixture, invented): level-1 category of a searched item
# number, the search category of each level-1 name, brand names of the first
# six part brands, and the level-1 category of each part type.
B1_NAMES = ["数码", "手机", "电脑办公", "个护化妆", "服饰内衣", "家居家装", "图书、音像、电子书刊", "厨具",
            "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器", "运动户外", "食品饮料"]
SEARCH_OF_B1 = {"数码": "科技与数码", "手机": "科技与数码", "电脑办公": "科技与数码", "家用电器": "科技与数码",
                "个护化妆": "时尚与潮流", "服饰内衣": "时尚与潮流", "鞋靴": "时尚与潮流", "珠宝": "时尚与潮流",
                "家居家装": "家庭与育儿", "厨具": "家庭与育儿", "母婴": "家庭与育儿",
                "图书、音像、电子书刊": "学习与发展", "汽车用品": "性价比", "食品饮料": "健康与养生"}
BRAND_NAMES = {"Brand#1": "TCL", "Brand#2": "苹果", "Brand#3": "联想", "Brand#4": "小米", "Brand#5": "欧莱雅",
               "Brand#6": "香奈儿"}
B1_OF_TYPE = {"ECONOMY": "数码", "STANDARD": "家居家装", "PROMO": "服饰内衣", "SMALL": "母婴", "MEDIUM": "厨具",
              "LARGE": "运动户外"}
AS_OF = "2024-01-30"


def score_rows():
    out = []
    for fam, val, fs in FACTORS:
        w = Decimal(WEIGHTS[fam])
        for band, f in zip(BANDS, fs):
            out.append((fam, val, band, (Decimal(str(f)) * w).quantize(Decimal("0.001"))))
    return out


def scores(spark) -> DataFrame:
    return literal_table(spark, score_rows(), "family string, value string, band string, score decimal(6,3)")


SCORES_SQL = "SELECT family, value, band, CAST(score AS DECIMAL(6,3)) AS score FROM (VALUES " + ", ".join(
    f"('{a}', '{b}', '{c}', {d})" for a, b, c, d in score_rows()) + ") AS t(family, value, band, score)"


def _known(family):
    return [v for f, v, _ in FACTORS if f == family and v != "*"]


def apply_scores(df: DataFrame, families: dict[str, "F.Column"], keys: list[str], spark) -> DataFrame:
    """Score several families in one pass: each row is exploded into its
    ``(family, value)`` pairs, values without a row of their own fall to the
    family's '*' row (a literal-map test, no join), then one broadcast join
    with the score table yields one row per band. A family without a '*' row
    gives unknown values no score rows (the reference leaves them unset)."""
    known = F.create_map(*[F.lit(x) for f, v, _ in FACTORS if v != "*" for x in (f"{f}|{v}", True)])
    pairs = F.array(*[F.struct(F.lit(f).alias("family"), c.cast("string").alias("value")) for f, c in families.items()])
    # a value that is not there scores nothing, not even by the family's '*' row
    ex = df.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.family", "p.value").where("value is not null")
    key = F.when(known[F.concat_ws("|", "family", "value")].isNotNull(), F.col("value")).otherwise(F.lit("*"))
    s = F.broadcast(scores(spark).select(F.col("family").alias("__f"), F.col("value").alias("__v"), "band", "score"))
    return ex.withColumn("__key", key).join(s, (F.col("family") == F.col("__f")) & (F.col("__key") == F.col("__v"))) \
        .select(*keys, "family", "value", "band", "score")


def _map_expr(d: dict, col):
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])[col]


def _case_sql(d: dict, expr: str, default: str = "NULL") -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in d.items()) + f" ELSE {default} END"


def _score_sql(src: str, family: str, value_expr: str, keys: str) -> str:
    known = ", ".join(f"'{v}'" for v in _known(family))
    return f"""SELECT {keys}, '{family}' AS family, {value_expr} AS value, s.band, s.score
               FROM ({src}) x JOIN ({SCORES_SQL}) s ON s.family = '{family}'
                AND s.value = CASE WHEN {value_expr} IN ({known}) THEN {value_expr} ELSE '*' END
               WHERE {value_expr} IS NOT NULL"""


# -- device & search (base2) ----------------------------------------------------------------------

def _log(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").alias("uid"), "ts", "event_type",
                    F.when(F.col("value") < 10, "iOS").otherwise("Android").alias("os"),
                    F.get_json_object("props", "$.k").cast("int").alias("k"),
                    F.date_format("ts", "yyyy-MM-dd").alias("day"))


LOG_SQL = """SELECT event_id, user_id AS uid, ts, event_type, CASE WHEN value < 10 THEN 'iOS' ELSE 'Android' END AS os,
                    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, strftime(ts, '%Y-%m-%d') AS day
             FROM events"""


@query("label_device_profile", f"""
    SELECT uid, day, count(*) AS pv, array_to_string(list_sort(list(DISTINCT os)), ',') AS os_list,
           array_to_string(list_sort(list(DISTINCT event_type)), ',') AS page_list
    FROM ({LOG_SQL}) l GROUP BY uid, day""")
def label_device_profile(spark, sf_dir):
    """Per user and day: page views and the distinct device systems and pages
    seen, comma-joined (running count reset per day)."""
    l = _log(spark, sf_dir)
    return l.groupBy("uid", "day").agg(
        F.count("*").alias("pv"), F.array_join(F.array_sort(F.collect_set("os")), ",").alias("os_list"),
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("page_list"))


PIECE_MS = 86_400_000


def running_sets(df: DataFrame, key: str, order: list[str], ms: str, sets: dict[str, str], count: str,
                 piece_ms: int = PIECE_MS) -> DataFrame:
    """Per row, the running number of rows of its key and the running distinct
    values of columns (``sets``: result name -> column), itself included.

    In two steps: a key's rows are cut into pieces of time; each piece is
    reduced to its count and sets, a window over the pieces gives what stands
    before each, and a second window runs inside the pieces only. No window
    holds a key's whole history, and a key with very many rows is spread over
    its pieces. ``order`` begins with a column that grows with ``ms``."""
    cut = df.withColumn("__p", F.floor(F.col(ms) / piece_ms))
    parts = cut.groupBy(F.col(key).alias("__k"), F.col("__p").alias("__q")).agg(
        F.count("*").alias("__n"), *[F.collect_set(c).alias(f"__s_{n}") for n, c in sets.items()])
    earlier = Window.partitionBy("__k").orderBy("__q").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("__k", "__q", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
                          *[F.array_distinct(F.flatten(F.collect_list(f"__s_{n}").over(earlier))).alias(f"__b_{n}") for n in sets])
    inside = Window.partitionBy(key, "__p").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = cut.withColumns({"__i": F.row_number().over(inside), **{f"__r_{n}": F.collect_set(c).over(upto) for n, c in sets.items()}})
    j = rows.join(before, F.col(key).eqNullSafe(F.col("__k")) & F.col("__p").eqNullSafe(F.col("__q")))
    return j.select(*df.columns, (F.col("__before") + F.col("__i")).cast("bigint").alias(count),
                    *[F.array_join(F.array_sort(F.array_union(f"__b_{n}", f"__r_{n}")), ",").alias(n) for n in sets])


@query("label_device_running", f"""
    SELECT event_id, uid, count(*) OVER w AS pv, array_to_string(list_sort(list_distinct(list(os) OVER w)), ',') AS os_list,
           array_to_string(list_sort(list_distinct(list(event_type) OVER w)), ',') AS page_list,
           array_to_string(list_sort(list_distinct(list(CASE WHEN event_type = 'view' THEN CAST(k AS VARCHAR) END) OVER w)), ',') AS search_list
    FROM ({LOG_SQL}) l WINDOW w AS (PARTITION BY uid ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def label_device_running(spark, sf_dir):
    """Per log record, the user's running page views and the distinct device
    systems, pages and searched items seen so far, comma-joined."""
    l = _log(spark, sf_dir).withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp"))).withColumn(
        "searched", F.when(F.col("event_type") == "view", F.col("k").cast("string")))
    r = running_sets(l, "uid", ["ts", "event_id"], "ms", {"os_list": "os", "page_list": "event_type", "search_list": "searched"}, "pv")
    return r.select("event_id", "uid", "pv", "os_list", "page_list", "search_list")


def device_scores(spark, sf_dir):
    l = _log(spark, sf_dir)
    last = latest_per_key(l.select("uid", "os", "ts", "event_id"), ["uid"], ["ts", "event_id"])
    views = l.where(F.col("event_type") == "view").select("uid", "k", "ts", "event_id")
    last_view = latest_per_key(views, ["uid"], ["ts", "event_id"]).select(F.col("uid").alias("__u"), "k")
    b1 = F.element_at(F.array(*[F.lit(n) for n in B1_NAMES]), (F.col("k") % len(B1_NAMES) + 1).cast("int"))
    u = last.join(last_view, last.uid == F.col("__u"), "left").select(
        "uid", F.unix_millis(F.col("ts").cast("timestamp")).alias("made_ms"), F.col("os").alias("judge_os"), F.coalesce(_map_expr(SEARCH_OF_B1, b1), F.lit("unknown"))
        .alias("search_category"))
    return apply_scores(u, {"device": F.col("judge_os"), "search": F.col("search_category")}, ["uid", "made_ms"], spark)


_B1_ARR = "[" + ", ".join(f"'{n}'" for n in B1_NAMES) + "]"
DEVICE_BASE_SQL = f"""
    WITH l AS ({LOG_SQL}),
         last AS (SELECT uid, os, epoch_us(ts) // 1000 AS made_ms FROM l QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) = 1),
         lv AS (SELECT uid, k FROM l WHERE event_type = 'view'
                QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) = 1)
    SELECT last.uid, last.made_ms, last.os AS judge_os,
           coalesce({_case_sql(SEARCH_OF_B1, f"{_B1_ARR}[lv.k % {len(B1_NAMES)} + 1]")}, 'unknown') AS search_category
    FROM last LEFT JOIN lv ON last.uid = lv.uid"""
DEVICE_SCORES_SQL = (_score_sql(DEVICE_BASE_SQL, "device", "judge_os", "uid, made_ms") + " UNION ALL "
                     + _score_sql(DEVICE_BASE_SQL, "search", "search_category", "uid, made_ms"))


@query("label_device_scores", f"SELECT uid, family, value, band, score FROM ({DEVICE_SCORES_SQL}) x")
def label_device_scores(spark, sf_dir):
    """Device and search-category scores of each user's latest log record."""
    return device_scores(spark, sf_dir).drop("made_ms")


# -- order scores (base4) ----------------------------------------------------------------------------

# An order label is made on the run day at the time of day its order was paid.
LABEL_DAY_MS = 1_706_572_800_000


def order_scores(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    # a detail line is created l_linenumber seconds after its order's payment, a
    # large one (quantity over 44) ten minutes later: outside the +-2 minute
    # bound of the interval join, which is one residual predicate
    late = F.when(F.col("l_quantity") > 44, F.lit(600)).otherwise(F.lit(0))
    inside = (F.col("l_linenumber") + late).between(-120, 120)
    best = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    # of each order its last line within the bound, combined before it moves; orders after that
    lines = load(spark, sf_dir, "lineitem").where(inside).groupBy(F.col("l_orderkey").alias("k")).agg(
        F.max(F.struct(*best)).alias("line"))
    pay = o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                   (F.col("o_totalprice") / 100).alias("total_amount"),
                   (F.col("o_orderdate") + F.make_interval(hours=(F.col("o_totalprice").cast("bigint") % 24)
                                                           .cast("int"))).alias("pay_time"))
    j = pay.join(lines, F.col("order_id") == F.col("k")).select("user_id", "order_id", "total_amount", "pay_time", "line")
    latest = latest_per_key(j, ["user_id"], ["pay_time", "order_id", "line"])
    d = latest.join(p, F.col("line.l_partkey") == p.p_partkey, "left").select(
        "user_id", D.time_slot(F.col("pay_time")).alias("slot"),
        (F.unix_seconds(F.col("pay_time").cast("timestamp")) % 86400 * 1000 + LABEL_DAY_MS).alias("made_ms"),
        F.when(F.col("total_amount") < 1000, "低消费")
         .when((F.col("total_amount") > 1000) & (F.col("total_amount") < 4000), "中消费").otherwise("高消费")
         .alias("spending"),
        F.coalesce(_map_expr(BRAND_NAMES, F.col("p_brand")), F.col("p_brand")).alias("tname"),
        _map_expr(B1_OF_TYPE, F.col("p_type")).alias("b1_name"))
    return apply_scores(d, {"time": F.col("slot"), "amount": F.col("spending"), "brand": F.col("tname"),
                            "category": F.col("b1_name")}, ["user_id", "made_ms"], spark)


_SLOT_SQL = ("CASE WHEN hour(pay_time) < 6 THEN '凌晨' WHEN hour(pay_time) < 9 THEN '早晨' WHEN hour(pay_time) < 12 "
             "THEN '上午' WHEN hour(pay_time) < 14 THEN '中午' WHEN hour(pay_time) < 18 THEN '下午' "
             "WHEN hour(pay_time) < 22 THEN '晚上' ELSE '夜间' END")
ORDER_BASE_SQL = f"""
    WITH lines AS (
        SELECT o_custkey AS user_id, o_orderkey AS order_id, o_totalprice / 100 AS total_amount,
               o_orderdate + to_hours(CAST(trunc(o_totalprice) AS BIGINT) % 24) AS pay_time,
               l_linenumber AS line_no, l_partkey AS sku_id, l_suppkey AS supp, l_quantity AS qty
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND l_quantity <= 44),
    latest AS (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY user_id
               ORDER BY pay_time DESC, order_id DESC, line_no DESC, sku_id DESC, supp DESC, qty DESC) = 1)
    SELECT user_id, {_SLOT_SQL} AS slot, epoch_us(pay_time) // 1000000 % 86400 * 1000 + {LABEL_DAY_MS} AS made_ms,
           CASE WHEN total_amount < 1000 THEN '低消费' WHEN total_amount > 1000 AND total_amount < 4000 THEN '中消费'
                ELSE '高消费' END AS spending,
           coalesce({_case_sql(BRAND_NAMES, 'p_brand')}, p_brand) AS tname,
           {_case_sql(B1_OF_TYPE, 'p_type')} AS b1_name
    FROM latest LEFT JOIN part ON sku_id = p_partkey"""
ORDER_SCORES_SQL = " UNION ALL ".join(_score_sql(ORDER_BASE_SQL, f, v, "user_id, made_ms") for f, v in
                                      [("time", "slot"), ("amount", "spending"), ("brand", "tname"),
                                       ("category", "b1_name")])


@query("label_order_scores", f"SELECT user_id, family, value, band, score FROM ({ORDER_SCORES_SQL}) x")
def label_order_scores(spark, sf_dir):
    """Order ⋈ detail within ±2 minutes, newest line per user, then time-slot,
    amount, brand and category scores (first-match dictionaries as maps)."""
    return order_scores(spark, sf_dir).drop("made_ms")


# -- base profile (base6) ----------------------------------------------------------------------------

def user_base(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    t0 = F.lit(1_700_000_000_000).cast("bigint")
    user = c.select(F.col("c_custkey").alias("uid"), F.col("c_name").alias("name"),
                    F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("string"))
                     .when(F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE"), "F").otherwise("M").alias("gender"),
                    F.date_from_unix_date(F.abs(F.col("c_acctbal")).cast("int") + 3000).alias("birthday"),
                    F.timestamp_millis(t0 + F.col("c_custkey") * 1000).alias("ts"))
    supp = c.select(F.col("c_custkey").alias("uid"),
                    (F.lit(150) + F.abs(F.col("c_acctbal")).cast("int") % 50).alias("height"),
                    (F.lit(45) + F.abs(F.col("c_acctbal")).cast("int") % 40).alias("weight"),
                    F.when((F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_acctbal") > 5000), "F").alias("gender"),
                    F.timestamp_millis(t0 + F.col("c_custkey") * 1000
                                       + F.when(F.col("c_acctbal") < 0, 600000).otherwise(60000)).alias("sts"))
    j = interval_join(user, supp, "uid", "ts", "sts", "-5 minutes", "5 minutes")
    # the supplement's value wins where it has one; of several pairs of a user the newest supplement counts
    pairs = j.select(F.col("l.uid").alias("uid"), F.col("l.name").alias("name"), F.coalesce("r.gender", "l.gender").alias("gender"),
                     F.col("l.birthday").alias("birthday"), F.col("r.height").alias("height"), F.col("r.weight").alias("weight"),
                     F.col("r.sts").alias("sts"))
    m = latest_per_key(pairs, ["uid"], ["sts"])
    b = F.col("birthday")
    return m.select("uid", "name", F.coalesce("gender", F.lit("home")).alias("gender"), "birthday",
                    D.age_years(b, F.lit(AS_OF).cast("date")).alias("age"), D.decade(b).alias("decade"),
                    D.zodiac(b).alias("zodiac_sign"), "height", "weight")


_Z = D.ZODIAC_STARTS
_ZSQL = " ".join(f"WHEN md >= {first} THEN '{name}'" for name, first in [_Z[-1]] + list(reversed(_Z[:-1])))
USER_BASE_SQL = f"""
    SELECT uid, name, gender, birthday,
           year(DATE '{AS_OF}') - year(birthday) - CASE WHEN month(DATE '{AS_OF}') * 100 + day(DATE '{AS_OF}')
                < month(birthday) * 100 + day(birthday) THEN 1 ELSE 0 END AS age,
           CAST(floor(year(birthday) / 10) * 10 AS INTEGER) AS decade,
           CASE {_ZSQL} ELSE '{_Z[-1][0]}' END AS zodiac_sign, height, weight
    FROM (SELECT c_custkey AS uid, c_name AS name,
                 coalesce(CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 5000 THEN 'F' END,
                          CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL
                               WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'F' ELSE 'M' END, 'home') AS gender,
                 DATE '1970-01-01' + (CAST(trunc(abs(c_acctbal)) AS INTEGER) + 3000) AS birthday,
                 month(DATE '1970-01-01' + (CAST(trunc(abs(c_acctbal)) AS INTEGER) + 3000)) * 100
                   + day(DATE '1970-01-01' + (CAST(trunc(abs(c_acctbal)) AS INTEGER) + 3000)) AS md,
                 150 + CAST(trunc(abs(c_acctbal)) AS INTEGER) % 50 AS height,
                 45 + CAST(trunc(abs(c_acctbal)) AS INTEGER) % 40 AS weight
          FROM customer WHERE c_acctbal >= 0) c"""


@query("label_user_base", USER_BASE_SQL)
def label_user_base(spark, sf_dir):
    """User ⋈ body-data supplement within ±5 minutes (users whose supplement
    came later are dropped, as an inner interval join does); supplement
    fields overwrite equal names; age on a fixed date, decade, zodiac sign;
    missing gender becomes 'home'."""
    return user_base(spark, sf_dir)


# -- totals and profile ----------------------------------------------------------------------------

LABEL_BOUND_MS = 6 * 3_600_000


def age_totals(spark, sf_dir):
    dev = device_scores(spark, sf_dir).groupBy("uid", "made_ms", "band").agg(F.sum("score").alias("a"))
    odr = order_scores(spark, sf_dir).groupBy(F.col("user_id").alias("uid"), F.col("made_ms").alias("ordered"), "band").agg(
        F.sum("score").alias("b")).withColumnRenamed("band", "band_")
    j = binned_interval_join(dev, odr, "uid", "made_ms", "ordered", LABEL_BOUND_MS, LABEL_BOUND_MS).where("band = band_")
    return j.select("uid", "band", (F.col("a") + F.col("b")).alias("total"))


AGE_TOTALS_SQL = f"""
    SELECT d.uid, d.band, d.a + o.b AS total
    FROM (SELECT uid, made_ms, band, sum(score) AS a FROM ({DEVICE_SCORES_SQL}) x GROUP BY uid, made_ms, band) d
    JOIN (SELECT user_id AS uid, made_ms, band, sum(score) AS b FROM ({ORDER_SCORES_SQL}) y GROUP BY user_id, made_ms, band) o
      ON d.uid = o.uid AND d.band = o.band AND o.made_ms BETWEEN d.made_ms - {LABEL_BOUND_MS} AND d.made_ms + {LABEL_BOUND_MS}"""


@query("label_age_totals", AGE_TOTALS_SQL)
def label_age_totals(spark, sf_dir):
    """Per user and band, the six family scores summed (all six terms for
    every band: one naming scheme), where the device label and the order label
    lie within six hours of each other (interval join in time bins)."""
    return age_totals(spark, sf_dir)


_BAND_IDX = " ".join(f"WHEN '{b}' THEN {i}" for i, b in enumerate(BANDS))


@query("label_user_profile", f"""
    WITH t AS ({AGE_TOTALS_SQL}),
         best AS (SELECT uid, band AS best_band, total AS best_score FROM t WHERE total > 0
                  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY total DESC, CASE band {_BAND_IDX} END) = 1)
    SELECT b.uid, b.gender, b.age, b.decade, b.zodiac_sign, best.best_band, best.best_score
    FROM ({USER_BASE_SQL}) b JOIN (SELECT DISTINCT uid FROM t) u ON b.uid = u.uid
    LEFT JOIN best ON b.uid = best.uid""")
def label_user_profile(spark, sf_dir):
    """Base profile + the band with the highest total (zero never wins; ties
    go to the younger band)."""
    t = age_totals(spark, sf_dir)
    idx = F.create_map(*[F.lit(x) for i, b in enumerate(BANDS) for x in (b, -i)])
    pos = F.col("total") > 0
    best = t.groupBy("uid").agg(
        F.max_by(F.when(pos, F.col("band")), F.struct("total", idx[F.col("band")])).alias("best_band"),
        F.max(F.when(pos, F.col("total"))).alias("best_score"))
    return user_base(spark, sf_dir).join(best, "uid").select(
        "uid", "gender", "age", "decade", "zodiac_sign", "best_band", "best_score")
