"""Column helpers against hand-computed values."""

import hashlib
import math
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dovetail.functions import dates as D
from dovetail.functions import strings as S
from dovetail.functions.geo import vincenty_m
from dovetail.functions.math import BUCKET_OVERRIDES, hash_bucket, hex_or_decimal, wei_to_ether
from dovetail.plans.cdc import day_bucket


def one(spark, col, value, schema):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).collect()[0].o


def test_masks_and_validated_hash(spark):
    df = spark.createDataFrame([("13812345678", "ab@x.cn", "张三"), ("1381234567", "bad#x", "Li")],
                               "p string, e string, n string")
    out = df.select(S.mask_phone(F.col("p")), S.mask_email(F.col("e")), S.mask_name(F.col("n")),
                    S.md5_if_valid(F.col("p"), S.PHONE_RE)).collect()
    assert tuple(out[0])[:3] == ("138****5678", "***@x.cn", "张*")
    assert out[0][3] == hashlib.md5(b"13812345678").hexdigest()
    # the digit class works (an unescaped \d would make every phone invalid)
    assert tuple(out[1]) == (None, None, "L*", None)


def test_list_items(spark):
    df = spark.createDataFrame([("iOS 17,a,b,", "x")], "s string, t string")
    r = df.select(S.first_word(F.col("s")), S.first_item(F.col("s")), S.last_item(F.col("s"))).collect()[0]
    assert tuple(r) == ("iOS", "iOS 17", "")


def test_hash_bucket_rule_and_override(spark):
    # md5('abc') ends in 'f72' = 3954; 3954 % 128 = 114
    assert one(spark, hash_bucket(F.col("x"), 128), "abc", "x string") == "0114"
    k = "0xDAC17F958D2EE523A2206206994597C13D831EC7"
    assert one(spark, hash_bucket(F.col("x"), 128, BUCKET_OVERRIDES), k, "x string") == "9002"


def test_time_slot_cuts(spark):
    hours = [0, 5, 6, 8, 9, 11, 12, 13, 14, 17, 18, 21, 22, 23]
    df = spark.createDataFrame([(datetime(2024, 1, 1, h, 30),) for h in hours], "t timestamp")
    got = [r[0] for r in df.select(D.time_slot(F.col("t"))).collect()]
    assert got == ["凌晨", "凌晨", "早晨", "早晨", "上午", "上午", "中午", "中午", "下午", "下午", "晚上", "晚上",
                   "夜间", "夜间"]


def test_zodiac_edges_and_age(spark):
    cases = [(date(2000, 1, 19), "摩羯座"), (date(2000, 1, 20), "水瓶座"), (date(2000, 10, 23), "天秤座"),
             (date(2000, 10, 24), "天蝎座"), (date(2000, 12, 21), "射手座"), (date(2000, 12, 22), "摩羯座")]
    df = spark.createDataFrame(cases, "b date, z string")
    assert [r[0] for r in df.select(D.zodiac(F.col("b"))).collect()] == [z for _, z in cases]
    ages = spark.createDataFrame([(date(2000, 2, 29), date(2001, 2, 28)), (date(2000, 2, 29), date(2001, 3, 1)),
                                  (date(1990, 6, 15), date(2024, 6, 14))], "b date, a date")
    assert [r[0] for r in ages.select(D.age_years(F.col("b"), F.col("a"))).collect()] == [0, 1, 33]


def test_compact_clock_to_millis(spark):
    df = spark.createDataFrame([("20240101080000",), ("202401010800",), ("2024130108000x",)], "t string")
    assert [r[0] for r in df.select(D.compact_to_millis(F.col("t"))).collect()] == [1704067200000, 0, 0]


def test_day_bucket_units(spark):
    df = spark.createDataFrame([("1704067200",), ("1704067200000",), ("oops",)], "f string")
    assert [r[0] for r in df.select(day_bucket(F.col("f"))).collect()] == ["20240101", "20240101", "error_bucket"]


def test_ellipsoid_distance(spark):
    """Against the scalar formula; a known distance; coincident, polar, near-antipodal and null points."""
    from tests.test_track_length import vincenty_scalar
    rng = random.Random(11)
    pairs = [(116.4074, 39.9042, 121.4737, 31.2304), (1.0, 1.0, 1.0, 1.0), (0.0, 0.0, 90.0, 0.0), (0.0, 0.0, 179.7, 0.5),
             (5.0, 90.0, 5.0, -90.0), (None, 1.0, 2.0, 3.0), (10.0, 20.0, 10.0000001, 20.0)]
    pairs += [(rng.uniform(-180, 180), rng.uniform(-80, 80), rng.uniform(-180, 180), rng.uniform(-80, 80)) for _ in range(200)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double, c double, d double")
    rows = df.select("i", vincenty_m(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("m"))
    got = {r["i"]: r["m"] for r in rows.collect()}
    assert 1.06e6 < got[0] < 1.075e6 and got[1] == 0.0 and math.isnan(got[3]) and got[5] is None
    for i, p in enumerate(pairs):
        if i not in (3, 5) and not math.isnan(got[i]):
            want = vincenty_scalar(*p)
            assert math.isclose(got[i], want, rel_tol=6e-8, abs_tol=1e-6), (p, got[i], want)
            assert got[i] == float(f"{got[i]:.8g}")
    assert sum(math.isnan(m) for i, m in got.items() if m is not None) <= 4


def test_track_length_has_no_python_worker(spark):
    from dovetail.plans.geo import track_length
    from tests.conftest import SF
    plan = track_length(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hex_values_of_any_length(spark):
    values = ["0x1158e460913d00000", "0x0", "0x" + "f" * 31, "0x000" + "f" * 16, "1.5", "-12", None, "x", "0XfF"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(hex_or_decimal(F.col("t"))).collect()]
    assert got == ["20000000000000000000", "0", str(16 ** 31 - 1), str(16 ** 16 - 1), "1.5", "-12", "0", "0", "255"]
    ether = [r[0] for r in df.limit(1).select(wei_to_ether(F.col("t"))).collect()]
    assert ether[0] == 20
    assert one(spark, wei_to_ether(F.col("t")), "-1500000000000000000", "t string") == Decimal("-1.5")
    with pytest.raises(Exception, match="beyond 31 digits"):
        one(spark, hex_or_decimal(F.col("t")), "0x" + "f" * 32, "t string")


def test_short_payload_has_no_chunks(spark, tmp_path):
    from dovetail.plans.scalars import hex_words
    df = spark.createDataFrame([(1, "0x" + "a" * 10), (2, "0x" + "b" * 130)], "k int, data string")
    assert sorted((r.k, r.chunk_no, r.chunk) for r in hex_words(df, "k").collect()) == [
        (2, 0, "0x" + "b" * 64), (2, 1, "0x" + "b" * 64)]
