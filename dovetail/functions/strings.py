"""String column helpers: masks, validated hashing, list items."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Validation patterns for phone numbers and e-mail addresses.
PHONE_RE = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL_RE = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def mask_name(c: Column) -> Column:
    """First character followed by ``*``; null stays null."""
    return F.concat(F.substring(c, 1, 1), F.lit("*"))


def mask_phone(c: Column) -> Column:
    """``13812345678`` -> ``138****5678`` for valid numbers, else null."""
    return F.when(c.rlike(PHONE_RE), F.concat(F.substring(c, 1, 3), F.lit("****"), F.substring(c, 8, 1 << 30)))


def mask_email(c: Column) -> Column:
    """``name@host`` -> ``***@host`` for valid addresses, else null."""
    return F.when(c.rlike(EMAIL_RE), F.concat(F.lit("***@"), F.split(c, "@").getItem(1)))


def md5_if_valid(c: Column, pattern: str) -> Column:
    """md5 of the value when it matches ``pattern``, else null."""
    return F.md5(F.when(c.rlike(pattern), c))


def first_word(c: Column) -> Column:
    return F.split_part(c, F.lit(" "), F.lit(1))


def first_item(c: Column, sep: str = ",") -> Column:
    return F.split_part(c, F.lit(sep), F.lit(1))


def last_item(c: Column, sep: str = ",") -> Column:
    return F.element_at(F.split(c, re.escape(sep)), -1)


def cap_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def lower_first(c: Column) -> Column:
    return F.concat(F.lower(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")
