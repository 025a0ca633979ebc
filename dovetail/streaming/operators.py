"""Streaming operators: event time, last-per-window, de-duplication, what a
chain of joins knows after a batch, and the two keyed-state filters (newest-only, new-visitor repair).

The keyed filters work on one micro-batch and the state stored by the batches
before it, with joins, aggregations and windows: rows of a key are put in
order by Spark, so neither batch nor buffer sizes change the answer, and a key
with many rows is worked on in pieces.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_event_time(df: DataFrame, ms: Column, delay: str = "3 seconds", fallback: Column | None = None,
                    fallback_in_seconds: bool = False, out: str = "event_time") -> DataFrame:
    """Event time from an epoch-millis field (or a fallback field, seconds
    scaled to millis), bounded out-of-orderness ``delay``. Rows without any
    time are dropped rather than stamped 0 (which would hold the watermark
    back forever)."""
    t = ms.cast("bigint")
    if fallback is not None:
        fb = fallback.cast("bigint") * (1000 if fallback_in_seconds else 1)
        t = F.coalesce(t, fb)
    return df.withColumn(out, F.timestamp_millis(t)).where(F.col(out).isNotNull()).withWatermark(out, delay)


def tumble_last(df: DataFrame, key: str, ts: str, size: str) -> DataFrame:
    """Last record per key in each tumbling window (``max_by`` on event time:
    deterministic, unlike processing-time 'last arrived')."""
    rest = [c for c in df.columns if c not in (key,)]
    return (df.groupBy(F.window(ts, size).alias("w"), key)
              .agg(F.max_by(F.struct(*rest), F.col(ts)).alias("last"))
              .select(F.col("w.start").alias("window_start"), key, "last.*"))


def dedup(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop repeats of ``keys`` seen within the watermark delay, which is the
    de-duplication horizon: exact and bounded (state expires with the
    watermark), where a Bloom filter would be approximate and can drop
    genuinely new rows. Rows up to the horizon late are not dropped, so give
    the horizon here and not the usual lateness."""
    return df.dropDuplicatesWithinWatermark(keys)


def record_hash(df: DataFrame, cols: list[str]) -> Column:
    """64-bit hash of the whole record's JSON text: full-record duplicate key."""
    return F.xxhash64(F.to_json(F.struct(*cols)))


def newly_known(rows: DataFrame, new: list[str], waits: dict[str, Column], before: int | None, now: int | None) -> DataFrame:
    """Of a chain of joins over a batch and the rows held from those before it,
    the rows that are known by the watermark ``now`` and were not by ``before``
    (epoch millis; null: none yet).

    ``new``: flags of the sides that are always there, true where the row came
    with this batch; ``waits``: the same flag of each left-joined side (null
    where there is no match) and the time until which a match can come. A row
    with all its matches is known at once, one that misses some when the
    watermark has passed that time."""
    def known(mark: int | None) -> Column:
        past = [F.lit(False) if mark is None else F.coalesce(u < F.timestamp_millis(F.lit(mark)), F.lit(False)) for u in waits.values()]
        return reduce(Column.__and__, [F.col(c).isNotNull() | p for c, p in zip(waits, past)], F.lit(True))

    came = reduce(Column.__or__, [F.coalesce(F.col(c), F.lit(False)) for c in [*new, *waits]])
    return rows.where(known(now) & (came | ~known(before)))


# -- keyed state ------------------------------------------------------------------------------------

def newest_only(batch: DataFrame, state: DataFrame | None, key: str, order: str, time: str,
                ttl_ms: int | None = None, piece: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``time`` is later than that of every earlier arrival of their
    key, and the next state (key, newest time) of the batch's keys. Arrival order = ``order``, a
    whole number; ``state``: what the batches before have seen. With ``ttl_ms``
    a key's state is forgotten if this batch's times are all that much later.

    The running maximum is taken in two steps, over pieces of ``piece`` orders
    of a key and inside each, so that no window holds a key's whole history."""
    p = F.floor(F.col(order) / piece)
    parts = batch.groupBy(F.col(key).alias("__k"), p.alias("__p")).agg(F.max(time).alias("__t"), F.min(time).alias("__lo"))
    if state is not None:
        state = state.join(batch.select(key).distinct(), key, "left_semi")
        known = state.select(F.col(key).alias("__k"), F.lit(None).cast("bigint").alias("__p"), F.col(time).alias("__t"),
                             F.lit(None).cast("bigint").alias("__lo"))
        if ttl_ms is not None:
            first = parts.groupBy("__k").agg(F.min("__lo").alias("__first"))
            known = known.join(first, "__k", "left").where(
                F.col("__first").isNull() | (F.col("__first") - F.col("__t") <= ttl_ms)).drop("__first")
        parts = parts.unionByName(known)
    earlier = Window.partitionBy("__k").orderBy(F.col("__p").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    prior = parts.select("__k", "__p", F.max("__t").over(earlier).alias("__prior")).where("__p is not null")
    rows = batch.withColumn("__p", p).join(prior, (F.col(key) == F.col("__k")) & (prior["__p"] == p), "left").drop(prior["__p"])
    inside = Window.partitionBy(key, "__p").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.greatest(F.col("__prior"), F.max(time).over(inside))
    out = rows.withColumn("__seen", seen).where(F.col("__seen").isNull() | (F.col(time) > F.col("__seen")))
    return out.select(*batch.columns), parts.groupBy(F.col("__k").alias(key)).agg(F.max("__t").alias(time))


def repair_is_new(batch: DataFrame, state: DataFrame | None, key: str = "mid",
                  order: tuple[str, ...] = ("ts_ms", "event_id")) -> tuple[DataFrame, DataFrame]:
    """New-visitor repair per device, and the next state (key, first day) of the batch's devices. The
    first record of a device sets its day (its own when ``is_new='1'``, else
    the day before); later ``is_new='1'`` records of another day become
    ``'0'``. State does not expire: a device that is forgotten would be new again."""
    day = F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd")
    before = F.date_format(F.timestamp_millis(F.col("ts_ms") - 86_400_000), "yyyy-MM-dd")
    first = F.min_by(F.when(F.col("is_new") == "1", day).otherwise(before), F.struct(*order))
    here = batch.groupBy(key).agg(first.alias("first_day"))
    if state is not None:
        here = here.join(state.select(F.col(key), F.col("first_day").alias("__was")), key, "left").select(
            key, F.coalesce("__was", "first_day").alias("first_day"))
    fixed = F.when((F.col("is_new") == "1") & (day != F.col("first_day")), "0").otherwise(F.col("is_new"))
    return batch.join(here, key).select(*batch.columns, fixed.alias("fixed_is_new")), here


# -- Bloom filters --------------------------------------------------------------------------------------

BLOCK_BITS = 32_768  # bits of one bitmap of Spark's bitmap aggregates


def bloom_shape(expected: int, rate: float) -> tuple[int, int]:
    """(blocks, positions per item) for ``expected`` items at a false-positive rate."""
    bits = -max(expected, 1) * math.log(rate) / math.log(2) ** 2
    return max(1, math.ceil(bits / BLOCK_BITS)), max(1, round(-math.log2(rate)))


def bloom_new(batch: DataFrame, state: DataFrame | None, item: Column, shape: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Rows of the batch whose ``item`` a Bloom filter has not seen, one each
    (the one with the least columns), and the touched blocks of the filter
    (block, bits) as they are then.

    A hash of the item chooses its block and the positions in it. Blocks are
    bitmaps, built and merged by aggregates: the state has at most as many
    as ``shape`` says, however long the stream runs. An item that was seen is always
    dropped; a new one is dropped at the rate the shape was made for. Repeats
    inside the batch are told apart exactly."""
    one = _placed(batch, item, shape, whole=True)
    if state is not None:
        one = one.join(state.select("block", "bits"), "block", "left")
        seen = reduce(Column.__and__, [_bit("bits", F.col("__at")[i]) for i in range(shape[1])])
        one = one.where(F.col("bits").isNull() | ~seen)
    new = one.select("__row.*")
    return new, bloom_marked(new, state, item, shape)


def bloom_marked(new: DataFrame, state: DataFrame | None, item: Column, shape: tuple[int, int]) -> DataFrame:
    """The touched blocks of the filter (block, bits) after the rows it let
    through, one an item. Given those as they were written, the batch is not worked out again."""
    built = _placed(new, item, shape).select("block", F.explode("__at").alias("p")).groupBy("block").agg(
        F.bitmap_construct_agg("p").alias("bits"))
    if state is None:
        return built
    return state.select("block", "bits").join(built.select("block").distinct(), "block", "left_semi").unionByName(built) \
        .groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _placed(rows: DataFrame, item: Column, shape: tuple[int, int], whole: bool = False) -> DataFrame:
    """Rows with their block and positions; ``whole``: one of each item, as ``__row``."""
    blocks, positions = shape
    rows = rows.withColumn("__item", item) if not whole else rows.withColumn("__item", item).groupBy("__item").agg(
        F.min(F.struct(*rows.columns)).alias("__row"))
    # start and step below 2^15: the sums stay small; the step is odd, so positions differ
    first = F.pmod(F.xxhash64(F.lit(1), "__item"), F.lit(BLOCK_BITS))
    step = F.pmod(F.xxhash64(F.lit(2), "__item"), F.lit(BLOCK_BITS)).bitwiseOR(F.lit(1))
    at = F.array(*[F.pmod(first + i * step, F.lit(BLOCK_BITS)) for i in range(positions)])
    return rows.withColumn("__at", at).withColumn("block", F.pmod(F.xxhash64(F.lit(3), "__item"), F.lit(blocks)))


def _bit(bits: str, p: Column) -> Column:
    """Bit ``p`` of a bitmap: bytes in order, lowest bit first."""
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), p % 8)), F.lit(2)) == 1
