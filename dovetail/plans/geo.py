"""Vehicle GPS: flatten the location envelopes; track length per vehicle and day."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dovetail.functions.dates import compact_to_millis
from dovetail.functions.geo import CLOSE, ROUNDS, WGS84_A, WGS84_B, WGS84_F, vincenty_m
from dovetail.registry import query
from dovetail.sources.tables import load


def gps_envelopes(spark, sf_dir):
    """GPS change rows derived from events: vehicle = user; position from the
    event value and item; the device clock ``yyyyMMddHHmmss`` at GMT+8 (error
    events carry a truncated clock); sign-ups are vehicle registrations
    without a position; purchases are live rows, the rest snapshot rows."""
    e = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    clock = F.date_format(F.col("ts") + F.expr("INTERVAL 8 HOURS"), "yyyyMMddHHmmss")
    clock = F.when(F.col("event_type") == "error", F.substring(clock, 1, 12)).otherwise(clock)
    loc = F.struct((F.lit(116) + k / 100 + F.col("value") / 1000).alias("lon"),
                   (F.lit(39) + F.col("value") / 100).alias("lat"), F.col("event_id").alias("msgId"),
                   (k * 3).alias("direction"), clock.alias("dateTime"))
    reg = F.struct(F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("plate"))
    is_reg = F.col("event_type") == "signup"
    after = F.struct(F.col("user_id").alias("vehicle_id"),
                     F.when(~is_reg, loc).alias("upexgmsgreallocation"), F.when(is_reg, reg).alias("upexgmsgregister"))
    return e.select(F.when(F.col("event_type") == "purchase", "c").otherwise("r").alias("op"), after.alias("after"))


def flatten(env, live: bool = False):
    """Lift the nested location; snapshot rows only, or with the live ones."""
    a = F.col("after")
    loc = a["upexgmsgreallocation"]
    reg = a["upexgmsgregister"].isNotNull()
    return (env if live else env.where(F.col("op") == "r")).select(
        a["vehicle_id"].alias("vehicle_id"), loc["msgId"].alias("msg_id"), loc["lon"].alias("lon"),
        loc["lat"].alias("lat"), loc["direction"].alias("direction"), loc["dateTime"].alias("date_time"),
        F.when(reg, F.lit(0).cast("bigint")).otherwise(compact_to_millis(loc["dateTime"])).alias("ts_ms"),
        F.when(reg, F.lit("99991231")).otherwise(F.substring(loc["dateTime"], 1, 8)).alias("day"))


FLAT_SQL = """
    SELECT user_id AS vehicle_id,
           CASE WHEN event_type <> 'signup' THEN event_id END AS msg_id,
           CASE WHEN event_type <> 'signup' THEN 116 + k / 100 + value / 1000 END AS lon,
           CASE WHEN event_type <> 'signup' THEN 39 + value / 100 END AS lat,
           CASE WHEN event_type <> 'signup' THEN k * 3 END AS direction,
           CASE WHEN event_type <> 'signup' THEN clock END AS date_time,
           CASE WHEN event_type = 'signup' THEN 0 WHEN length(clock) = 14
                THEN epoch_ms(strptime(clock, '%Y%m%d%H%M%S') - INTERVAL 8 HOUR) ELSE 0 END AS ts_ms,
           CASE WHEN event_type = 'signup' THEN '99991231' ELSE substr(clock, 1, 8) END AS day
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                 CASE WHEN event_type = 'error' THEN substr(strftime(ts + INTERVAL 8 HOUR, '%Y%m%d%H%M%S'), 1, 12)
                      ELSE strftime(ts + INTERVAL 8 HOUR, '%Y%m%d%H%M%S') END AS clock
          FROM events WHERE event_type <> 'purchase') e"""


@query("gps_flatten", FLAT_SQL)
def gps_flatten(spark, sf_dir):
    """Snapshot rows only (a stateless filter replaces the single-task
    snapshot detector); nested location lifted; device clock at GMT+8 to
    epoch millis (0 when malformed); registrations dated 99991231."""
    return flatten(gps_envelopes(spark, sf_dir))


TRACK_SQL = f"""
    WITH RECURSIVE fixes AS (
        SELECT user_id AS vehicle_id, substr(clock, 1, 8) AS day, event_id, epoch_ms(strptime(clock, '%Y%m%d%H%M%S')) AS ms,
               116 + k / 100 + value / 1000 AS lon, 39 + value / 100 AS lat
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, strftime(ts + INTERVAL 8 HOUR, '%Y%m%d%H%M%S') AS clock
              FROM events WHERE event_type NOT IN ('signup', 'error')) e),
    legs AS (
        SELECT vehicle_id, day, row_number() OVER () AS id, lon, lat, lag(lon, 1, lon) OVER w AS plon, lag(lat, 1, lat) OVER w AS plat
        FROM fixes WINDOW w AS (PARTITION BY vehicle_id, day ORDER BY ms, event_id)),
    ends AS (
        SELECT id, radians(lon - plon) AS l, atan((1 - {WGS84_F}::DOUBLE) * tan(radians(plat))) AS u1,
               atan((1 - {WGS84_F}::DOUBLE) * tan(radians(lat))) AS u2 FROM legs),
    walk AS (
        SELECT id, l, u1, u2, l AS lam, 1.0::DOUBLE AS step, 0 AS n FROM ends
        UNION ALL
        SELECT id, l, u1, u2, new, abs(new - lam), n + 1
        FROM (SELECT *, {WGS84_F}::DOUBLE / 16 * ca2 * (4 + {WGS84_F}::DOUBLE * (4 - 3 * ca2)) AS c,
                     l + (1 - c) * {WGS84_F}::DOUBLE * sa * (sigma + c * ss * (c2m + c * cs * (-1 + 2 * c2m ** 2))) AS new
              FROM (SELECT *, sqrt((cos(u2) * sin(lam)) ** 2 + (cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam)) ** 2) AS ss,
                           sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs, atan2(ss, cs) AS sigma,
                           CASE WHEN ss = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa, 1 - sa * sa AS ca2,
                           CASE WHEN ca2 = 0 THEN 0 ELSE cs - 2 * sin(u1) * sin(u2) / ca2 END AS c2m
                    FROM walk WHERE step > {CLOSE} AND n < {ROUNDS}) q) r),
    settled AS (
        SELECT id, sqrt((cos(u2) * sin(lam)) ** 2 + (cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam)) ** 2) AS ss,
               sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs, atan2(ss, cs) AS sigma,
               CASE WHEN ss = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa, 1 - sa * sa AS ca2,
               CASE WHEN ca2 = 0 THEN 0 ELSE cs - 2 * sin(u1) * sin(u2) / ca2 END AS c2m,
               ca2 * (({WGS84_A}::DOUBLE ** 2 - {WGS84_B}::DOUBLE ** 2) / {WGS84_B}::DOUBLE ** 2) AS u,
               1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))) AS a, u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) AS b,
               {WGS84_B}::DOUBLE * a * (sigma - b * ss * (c2m + b / 4 * (cs * (-1 + 2 * c2m ** 2)
                   - b / 6 * c2m * (-3 + 4 * ss ** 2) * (-3 + 4 * c2m ** 2)))) AS s
        FROM walk WHERE step <= {CLOSE}),
    metres AS (
        SELECT id, CASE WHEN s > 0 THEN round_even(s * 10.0::DOUBLE ** (7 - floor(log10(s))), 0) / 10.0::DOUBLE ** (7 - floor(log10(s)))
                        ELSE s END AS m FROM settled)
    SELECT vehicle_id, day, count(*) AS n_fixes,
           CASE WHEN bool_or(m IS NULL) THEN 'nan'::DOUBLE ELSE sum(m::DECIMAL(20, 7))::DOUBLE END AS track_m
    FROM legs LEFT JOIN metres USING (id) GROUP BY vehicle_id, day"""


@query("track_length", TRACK_SQL)
def track_length(spark, sf_dir):
    """Distance driven per vehicle and day, over snapshot and live fixes:
    consecutive fixes paired with ``lag`` inside (vehicle, day) partitions --
    a day bounds each window partition even for a vehicle holding a third of
    the fixes -- then the ellipsoid distance as built-in expressions, and one
    aggregate for count and sum (the first fix of a day adds no distance).
    Distances have 8 significant digits and are summed as decimals, so that
    the order of the rows does not change the sum; it is NaN where a pair's
    distance is."""
    pts = flatten(gps_envelopes(spark, sf_dir), live=True).where((F.col("day") != "99991231") & (F.col("ts_ms") > 0))
    w = Window.partitionBy("vehicle_id", "day").orderBy("ts_ms", "msg_id")
    lon, lat = F.col("lon"), F.col("lat")
    pairs = pts.select("vehicle_id", "day", "lon", "lat", F.coalesce(F.lag("lon").over(w), lon).alias("plon"),
                       F.coalesce(F.lag("lat").over(w), lat).alias("plat"))
    legs = pairs.select("vehicle_id", "day", vincenty_m(F.col("plon"), F.col("plat"), lon, lat).alias("m"))
    whole = F.sum(F.nanvl("m", F.lit(0.0)).cast("decimal(20,7)")).cast("double")
    return legs.groupBy("vehicle_id", "day").agg(
        F.count("*").alias("n_fixes"), F.when(F.isnan(F.max("m")), F.lit(float("nan"))).otherwise(whole).alias("track_m"))
