"""Date and time column helpers (all built-in expressions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(ts_ntz: Column) -> Column:
    """Epoch millis of a wall-clock (``TIMESTAMP_NTZ``) value read as UTC,
    independent of the session time zone."""
    return F.unix_millis(F.to_utc_timestamp(ts_ntz.cast("timestamp"), F.current_timezone()))


def millis_to_ts(ms: Column) -> Column:
    """Epoch millis held as text or number -> timestamp. Free text goes null."""
    return F.timestamp_millis(ms.try_cast("bigint"))


def millis_to_day(ms: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Epoch millis -> day text in UTC (``yyyy-MM-dd`` or ``yyyyMMdd``)."""
    return F.date_format(F.to_utc_timestamp(millis_to_ts(ms), F.current_timezone()), fmt)


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def iso_to_text(iso: Column) -> Column:
    """``2024-01-02T03:04:05.000Z`` -> ``2024-01-02 03:04:05`` by position."""
    return F.concat(F.substring(iso, 1, 10), F.lit(" "), F.substring(iso, 12, 8))


def time_slot(ts: Column) -> Column:
    """Seven day parts cut at 6, 9, 12, 14, 18 and 22 o'clock."""
    # Slot names and hour cuts of the order-time label.
    h = F.hour(ts)
    return (F.when(h < 6, "凌晨").when(h < 9, "早晨").when(h < 12, "上午").when(h < 14, "中午")
             .when(h < 18, "下午").when(h < 22, "晚上").otherwise("夜间"))


def age_years(birth: Column, as_of: Column) -> Column:
    """Completed years between two dates (calendar rule: the birthday must
    have been reached in the ``as_of`` year)."""
    before = (F.month(as_of) * 100 + F.dayofmonth(as_of)) < (F.month(birth) * 100 + F.dayofmonth(birth))
    return (F.year(as_of) - F.year(birth) - F.when(before, 1).otherwise(0)).cast("int")


# Zodiac signs and the month*100+day on which each one begins.
ZODIAC_STARTS = [
    ("水瓶座", 120), ("双鱼座", 219), ("白羊座", 321), ("金牛座", 420),
    ("双子座", 521), ("巨蟹座", 622), ("狮子座", 723), ("处女座", 823),
    ("天秤座", 923), ("天蝎座", 1024), ("射手座", 1123), ("摩羯座", 1222),
]


def zodiac(birth: Column) -> Column:
    """Zodiac sign of a birth date; dates before 01-20 fall to the last sign."""
    md = F.month(birth) * 100 + F.dayofmonth(birth)
    out = F.lit(ZODIAC_STARTS[-1][0])
    for name, first in ZODIAC_STARTS[:-1]:
        out = F.when(md >= first, F.lit(name)).otherwise(out)
    return F.when(md >= ZODIAC_STARTS[-1][1], F.lit(ZODIAC_STARTS[-1][0])).otherwise(out)


def decade(birth: Column) -> Column:
    """Birth decade as ``1990`` style integer."""
    return (F.floor(F.year(birth) / 10) * 10).cast("int")


def compact_to_millis(text: Column, zone: str = "Asia/Shanghai") -> Column:
    """``yyyyMMddHHmmss`` wall-clock in ``zone`` -> epoch millis; 0 when the text
    is not exactly 14 characters or does not parse."""
    wall = F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))
    ms = F.unix_millis(F.to_utc_timestamp(F.to_utc_timestamp(wall, F.current_timezone()), F.lit(zone)))
    return F.when(F.length(text) == 14, F.coalesce(ms, F.lit(0))).otherwise(F.lit(0)).cast("bigint")
