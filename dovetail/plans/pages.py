"""Page-behaviour analytics over ``events``.

page = ``event_type``, module = ``props.k``, stay = ``value`` seconds; a
purchase event is a payment (amount ``value``, product ``props.k``). A
payment is *guided* by a click of the same user when it happens within 24
hours after the click.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dovetail.registry import query
from dovetail.sources.tables import load

PAGE_RUN_DATE = "2024-01-30"
PR = f"DATE '{PAGE_RUN_DATE}'"

BEHAVIOUR_SQL = """
    SELECT event_id AS log_id, user_id, event_type AS page_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS module_id,
           ts AS click_time, CAST(trunc(value * 1000) AS INTEGER) AS stay_duration,
           CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 AS is_click,
           strftime(ts, '%Y-%m-%d') AS dt
    FROM events WHERE event_type <> 'purchase'"""

PAY_SQL = """
    SELECT event_id AS pay_id, user_id AS pay_user, ts AS pay_time, CAST(value AS DECIMAL(18,2)) AS pay_amount,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS product_id
    FROM events WHERE event_type = 'purchase'"""


def behaviour(spark, sf_dir) -> DataFrame:
    e = load(spark, sf_dir, "events").where(F.col("event_type") != "purchase")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(F.col("event_id").alias("log_id"), "user_id", F.col("event_type").alias("page_id"),
                    k.alias("module_id"), F.col("ts").alias("click_time"),
                    (F.col("value") * 1000).cast("int").alias("stay_duration"), (k < 50).alias("is_click"),
                    F.date_format("ts", "yyyy-MM-dd").alias("dt"))


def payments(spark, sf_dir) -> DataFrame:
    e = load(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return e.select(F.col("event_id").alias("pay_id"), F.col("user_id").alias("pay_user"),
                    F.col("ts").alias("pay_time"), F.col("value").cast("decimal(18,2)").alias("pay_amount"),
                    F.get_json_object("props", "$.k").cast("int").alias("product_id"))


def guided(clicks: DataFrame, pays: DataFrame, by: tuple[str, ...] = ("page_id", "module_id")) -> DataFrame:
    """Payments within 24 hours after one of the user's clicks, for every
    ``by``; a payment comes at most twice for one of them (make it distinct).

    Clicks are first reduced to the first and last of a user, ``by`` and day.
    A payment follows one of its own day's clicks if it follows the first, and
    one of the day before by at most 24 hours if it does so for the last: the
    same answer as all (click, payment) pairs, none of which are made. Equi-join
    on (user, day); adaptive execution splits skewed keys.
    """
    day = F.to_date("click_time")
    c = clicks.groupBy("user_id", *by, day.alias("__of")).agg(F.min("click_time").alias("__first"), F.max("click_time").alias("__last"))
    c = c.withColumn("__day", F.explode(F.array(F.col("__of"), F.date_add("__of", 1))))
    p = pays.withColumn("__pday", F.to_date("pay_time"))
    cond = ((c.user_id == p.pay_user) & (c["__day"] == p["__pday"])
            & F.when(F.col("__day") == F.col("__of"), p.pay_time >= F.col("__first"))
               .otherwise(p.pay_time <= F.col("__last") + F.expr("INTERVAL 1 DAY")))
    return c.join(p, cond).drop("__of", "__day", "__pday", "__first", "__last")


GUIDED_SQL = f"""
    SELECT c.*, p.* FROM ({BEHAVIOUR_SQL}) c JOIN ({PAY_SQL}) p
      ON c.user_id = p.pay_user AND p.pay_time >= c.click_time AND p.pay_time <= c.click_time + INTERVAL 1 DAY"""


@query("page_detail", f"SELECT log_id, user_id, page_id, module_id, click_time, stay_duration, dt FROM ({BEHAVIOUR_SQL})")
def page_detail(spark, sf_dir):
    return behaviour(spark, sf_dir).drop("is_click")


def overview(spark, sf_dir):
    b = behaviour(spark, sf_dir)
    return b.groupBy("page_id").agg(
        F.countDistinct("user_id").alias("visitor_count"), F.count("*").alias("view_count"),
        F.count(F.when(F.col("is_click"), 1)).alias("click_count"),
        F.sum("stay_duration").alias("stay_duration_ms"))


OVERVIEW_SQL = f"""
    SELECT page_id, count(DISTINCT user_id) AS visitor_count, count(*) AS view_count,
           count(CASE WHEN is_click THEN 1 END) AS click_count, sum(stay_duration) AS stay_duration_ms
    FROM ({BEHAVIOUR_SQL}) b GROUP BY page_id"""


@query("page_overview", OVERVIEW_SQL)
def page_overview(spark, sf_dir):
    return overview(spark, sf_dir)


@query("page_overview_report", f"""
    SELECT page_id, visitor_count, view_count, click_count,
           CAST(stay_duration_ms AS DOUBLE) / NULLIF(CAST(view_count AS DOUBLE), 0) / 1000 AS avg_stay_sec
    FROM ({OVERVIEW_SQL}) o""")
def page_overview_report(spark, sf_dir):
    o = overview(spark, sf_dir)
    return o.select("page_id", "visitor_count", "view_count", "click_count",
                    (F.try_divide(F.col("stay_duration_ms").cast("double"), F.col("view_count").cast("double"))
                     / 1000).alias("avg_stay_sec"))


def module_stats(spark, sf_dir):
    """Clicks and users per module, and payments guided by the module's
    clicks -- aggregated separately and merged on the key, so a payment is
    counted once per module however many clicks preceded it."""
    b = behaviour(spark, sf_dir)
    clicks = b.groupBy("page_id", "module_id").agg(F.count("*").alias("click_count"),
                                                   F.countDistinct("user_id").alias("click_user_count"))
    g = guided(b.select("page_id", "module_id", "user_id", "click_time"), payments(spark, sf_dir))
    pay = (g.select("page_id", "module_id", "pay_id", "pay_user", "pay_amount").distinct()
            .groupBy("page_id", "module_id").agg(F.countDistinct("pay_user").alias("guide_pay_user_count"),
                                                 F.count("pay_id").alias("guide_pay_count"),
                                                 F.sum("pay_amount").alias("guide_pay_amount")))
    return clicks.join(pay, ["page_id", "module_id"], "left").select(
        "page_id", "module_id", "click_count", "click_user_count",
        F.coalesce("guide_pay_user_count", F.lit(0)).alias("guide_pay_user_count"),
        F.coalesce("guide_pay_count", F.lit(0)).alias("guide_pay_count"),
        F.coalesce("guide_pay_amount", F.lit(0).cast("decimal(28,2)")).alias("guide_pay_amount"))


MODULE_SQL = f"""
    WITH clicks AS (SELECT page_id, module_id, count(*) AS click_count, count(DISTINCT user_id) AS click_user_count
                    FROM ({BEHAVIOUR_SQL}) b GROUP BY page_id, module_id),
         pay AS (SELECT page_id, module_id, count(DISTINCT pay_user) AS guide_pay_user_count,
                        count(pay_id) AS guide_pay_count, sum(pay_amount) AS guide_pay_amount
                 FROM (SELECT DISTINCT page_id, module_id, pay_id, pay_user, pay_amount FROM ({GUIDED_SQL}) g) d
                 GROUP BY page_id, module_id)
    SELECT c.page_id, c.module_id, click_count, click_user_count,
           coalesce(guide_pay_user_count, 0) AS guide_pay_user_count, coalesce(guide_pay_count, 0) AS guide_pay_count,
           coalesce(guide_pay_amount, 0) AS guide_pay_amount
    FROM clicks c LEFT JOIN pay p ON c.page_id = p.page_id AND c.module_id = p.module_id"""


@query("page_module_guide_pay", MODULE_SQL)
def page_module_guide_pay(spark, sf_dir):
    return module_stats(spark, sf_dir)


@query("page_click_distribution", f"SELECT page_id, module_id, click_count, click_user_count FROM ({MODULE_SQL}) m")
def page_click_distribution(spark, sf_dir):
    return module_stats(spark, sf_dir).select("page_id", "module_id", "click_count", "click_user_count")


@query("page_trend_30d", f"""
    SELECT dt, count(DISTINCT user_id) AS visitor_count,
           count(DISTINCT CASE WHEN is_click THEN user_id END) AS clicker_count
    FROM ({BEHAVIOUR_SQL}) b
    WHERE click_time >= CAST({PR} - 29 AS TIMESTAMP) AND click_time < CAST({PR} + 1 AS TIMESTAMP)
    GROUP BY dt""")
def page_trend_30d(spark, sf_dir):
    """Daily visitors and clickers over the 30 days ending on the run date;
    the window is a raw timestamp range, pushed to the scan."""
    d = F.lit(PAGE_RUN_DATE).cast("date")
    b = behaviour(spark, sf_dir).where(
        (F.col("click_time") >= F.date_sub(d, 29).cast("timestamp_ntz"))
        & (F.col("click_time") < F.date_add(d, 1).cast("timestamp_ntz")))
    return b.groupBy("dt").agg(F.countDistinct("user_id").alias("visitor_count"),
                               F.countDistinct(F.when(F.col("is_click"), F.col("user_id"))).alias("clicker_count"))


@query("page_guide_detail", f"""
    WITH pages AS (SELECT DISTINCT page_id FROM ({BEHAVIOUR_SQL}) b),
         g AS (SELECT page_id, product_id, count(DISTINCT pay_user) AS guide_visitor_count,
                      count(pay_id) AS guide_pay_count, sum(pay_amount) AS guide_pay_amount
               FROM (SELECT DISTINCT page_id, product_id, pay_id, pay_user, pay_amount FROM ({GUIDED_SQL}) x) d
               GROUP BY page_id, product_id)
    SELECT pages.page_id, g.product_id, coalesce(g.guide_visitor_count, 0) AS guide_visitor_count,
           coalesce(g.guide_pay_count, 0) AS guide_pay_count, g.guide_pay_amount
    FROM pages LEFT JOIN g ON pages.page_id = g.page_id""")
def page_guide_detail(spark, sf_dir):
    """Per page and product: visitors whose payment the page guided, payments
    and amount (each payment once per page). Pages without any guided
    payment stay, with a null product."""
    b = behaviour(spark, sf_dir)
    g = guided(b.select("page_id", "user_id", "click_time"), payments(spark, sf_dir), by=("page_id",))
    agg = (g.select("page_id", "product_id", "pay_id", "pay_user", "pay_amount").distinct()
            .groupBy("page_id", "product_id").agg(F.countDistinct("pay_user").alias("guide_visitor_count"),
                                                  F.count("pay_id").alias("guide_pay_count"),
                                                  F.sum("pay_amount").alias("guide_pay_amount")))
    pages = b.select("page_id").distinct()
    return pages.join(agg, "page_id", "left").select(
        "page_id", "product_id", F.coalesce("guide_visitor_count", F.lit(0)).alias("guide_visitor_count"),
        F.coalesce("guide_pay_count", F.lit(0)).alias("guide_pay_count"), "guide_pay_amount")


@query("page_module_share", f"""
    SELECT page_id, module_id, click_count,
           CAST(click_count AS DOUBLE) / CAST(sum(click_count) OVER (PARTITION BY page_id) AS DOUBLE) AS click_share
    FROM (SELECT page_id, module_id, count(*) AS click_count FROM ({BEHAVIOUR_SQL}) b
          WHERE is_click GROUP BY page_id, module_id) m""")
def page_module_share(spark, sf_dir):
    """Share of a page's clicks per module: aggregate first, then a window
    sum over the (small) aggregate, partitioned by page."""
    b = behaviour(spark, sf_dir).where(F.col("is_click"))
    m = b.groupBy("page_id", "module_id").agg(F.count("*").alias("click_count"))
    w = Window.partitionBy("page_id")
    return m.select("page_id", "module_id", "click_count",
                    (F.col("click_count").cast("double") / F.sum("click_count").over(w).cast("double"))
                    .alias("click_share"))


@query("dense_grid", """
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day FROM events),
         span AS (SELECT event_type, min(day) AS lo, max(day) AS hi FROM d GROUP BY event_type),
         grid AS (SELECT event_type, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
         cnt AS (SELECT event_type, day, count(*) AS n FROM d GROUP BY event_type, day)
    SELECT grid.event_type, strftime(grid.day, '%Y-%m-%d') AS dt, coalesce(cnt.n, 0) AS event_count
    FROM grid LEFT JOIN cnt ON grid.event_type = cnt.event_type AND grid.day = cnt.day""")
def dense_grid(spark, sf_dir):
    """Zero-filled day x key grid: each key's day span is exploded with
    ``sequence`` (no cartesian product) and left-joined to the counts."""
    e = load(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"))
    span = e.groupBy("event_type").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    grid = span.select("event_type", F.explode(F.sequence("lo", "hi")).alias("day"))
    cnt = e.groupBy("event_type", "day").agg(F.count("*").alias("n"))
    return grid.join(cnt, ["event_type", "day"], "left").select(
        "event_type", F.date_format("day", "yyyy-MM-dd").alias("dt"), F.coalesce("n", F.lit(0)).alias("event_count"))
