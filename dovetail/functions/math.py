"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys that bypass hashing and their reserved bucket labels.
BUCKET_OVERRIDES = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}


def hash_bucket(c: Column, n: int, overrides: dict[str, str] | None = None) -> Column:
    """Stable 4-digit bucket: last 3 hex digits of md5(text) modulo ``n``.

    Keys listed in ``overrides`` (compared lower-cased) get their fixed label.
    The override table is a literal map: a projection, no join.
    """
    text = c.cast("string")
    num = F.conv(F.substring(F.md5(text), -3, 3), 16, 10).cast("int") % F.lit(n)
    out = F.lpad(num.cast("string"), 4, "0")
    if overrides:
        m = F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv])
        out = F.coalesce(m[F.lower(text)], out)
    return out


def _hex_value(digits: Column) -> Column:
    """Hexadecimal digits -> decimal(38,0), exact up to 31 digits; more (than
    leading zeros) are an error, not a wrong number."""
    d = F.regexp_replace(digits, "^0+", "")
    padded = F.lpad(d, 32, "0")
    part = lambda i: F.conv(F.substring(padded, i, 16), 16, 10).cast("decimal(20,0)")
    value = (part(1) * F.lit(str(2 ** 64)).cast("decimal(20,0)")).cast("decimal(38,0)") + part(17).cast("decimal(38,0)")
    return F.when(F.length(d) > 31, F.raise_error(F.concat(F.lit("hexadecimal value beyond 31 digits: "), digits))
                  .cast("decimal(38,0)")).otherwise(value.cast("decimal(38,0)"))


def hex_or_decimal(text: Column) -> Column:
    """``0x``-prefixed hexadecimal or decimal text -> decimal text, exact;
    null and text that is no number give ``0``."""
    decimal = F.when(text.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$"), text)
    return F.when(F.lower(text).startswith("0x"), _hex_value(F.substring(text, 3, 256)).cast("string")) \
        .otherwise(F.coalesce(decimal, F.lit("0")))


def wei_to_ether(text: Column) -> Column:
    """Whole wei, as hexadecimal or decimal text -> decimal(38,18) ether,
    exact (digits are placed, nothing is divided); a fraction of a wei is cut."""
    whole = F.regexp_replace(F.split(hex_or_decimal(text), r"\.")[0], "^[+-]", "")
    digits = F.when(F.length(whole) > 38, F.raise_error(F.concat(F.lit("more than 38 digits: "), text)).cast("string")) \
        .otherwise(F.lpad(whole, 38, "0"))
    value = F.concat(F.substring(digits, 1, 20), F.lit("."), F.substring(digits, 21, 18)).cast("decimal(38,18)")
    return F.when(text.startswith("-"), -value).otherwise(value)
