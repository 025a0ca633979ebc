"""Two-pass external shuffle into shards.

Pass one scatters records uniformly into buckets sized for memory by a seeded
hash of the record. Pass two takes one bucket at a time, brings it into an
order that depends on nothing but its records, and applies a seeded
Fisher-Yates shuffle. Buckets laid end to end are one random permutation of
all records: a record's rank is the size of the buckets before its own plus
its place inside. Shard k of S holds the ranks from ceil(k n / S) on, so shard
sizes differ by one at most (law ``rows``) and a bucket meets one or two
shards; records are written there in order of rank.

The result depends on seed, bucket count and records, not on input files,
order of arrival or retries.

Scale: records move once, in buckets of even expected size; counts come from a
scan with map-side combine; a task holds one bucket. The number of buckets
follows the input, at ``bucket_rows`` records and ``bucket_bytes`` characters
each. Rows equal in every column hash alike, so a group of them that would fill
a quarter of a bucket is counted, and its copies, which nothing tells
apart, are numbered and scattered by hash and number.

Defined cases: a null text has no bytes (size 1) and stays null; null doc_ids
are spread by their text; repeated rows are kept, each with a slot; an empty
table writes nothing; other columns travel with their record, under any names
but ``__rank``, ``__shard`` and ``__slot``, which are the operator's own (such
columns of the input give way). Columns must be of types Spark can group by.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dovetail.llm.common import documents_core, materialise
from dovetail.session import scratch_dir

SHARDS = 8
SEED = 20240229
BUCKET_ROWS = 16_384
BUCKET_CHARS = 32 << 20
MOST_PARTITIONS = 1 << 15  # beyond that a task takes several buckets, one after the other
COPIES = 65_536  # copies of one record that a row stands for before they are told apart
_B, _AT, _RANK, _SHARD, _SLOT, _H = "__bucket", "__before", "__rank", "__shard", "__slot", "__h"


def _hash(docs: DataFrame, seed: int, doc_id: str | None, text: str | None):
    """A seeded hash of the whole row, of doc_id and text first (maps cannot be hashed and stay out)."""
    col = lambda c, t: (F.col(c) if c else F.lit(None)).cast(t)
    rest = [f.name for f in docs.schema.fields if f.name not in (doc_id, text) and "map<" not in f.dataType.simpleString()]
    return F.xxhash64(F.lit(seed), col(doc_id, "bigint"), col(text, "string"), *rest)


def scattered(rows: DataFrame, seed: int, buckets: int, text, bucket_rows: int, bucket_chars: int) -> DataFrame:
    """Rows (with their hash) and the bucket each goes to."""
    own = F.pmod(F.col(_H), F.lit(buckets))
    if buckets == 1:
        return rows.withColumn(_B, own)
    n, chars = F.count("*"), F.coalesce(F.sum(F.length(text)), F.lit(0))
    alike = rows.groupBy(_H).agg(n.alias("n"), chars.alias("chars"))
    # at most four a bucket by rows and four by characters
    many = materialise(alike.where((F.col("n") > max(1, bucket_rows // 4)) | ((F.col("n") > 1) & (F.col("chars") > bucket_chars // 4)))
                       .select(_H), "copied-records")
    if many.isEmpty():
        return rows.withColumn(_B, own)
    cols = rows.columns
    same = rows.join(many, _H, "left_semi").select(*cols).groupBy(*cols).agg(F.count("*").alias("n"))
    # in two steps, so that neither an array nor a task grows with the copies
    packs = same.withColumn("pack", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {COPIES}L").cast("bigint")))) \
        .repartition(_H, "pack")
    here = F.least(F.col("n") - F.col("pack") * COPIES, F.lit(COPIES))
    each = packs.withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), here)))
    copy = F.pmod(F.xxhash64(F.lit(seed), _H, F.col("pack") * COPIES + F.col("i")), F.lit(buckets))
    return rows.join(many, _H, "left_anti").select(*cols, own.alias(_B)).unionByName(each.select(*cols, copy.alias(_B)))


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of range(n): numpy's shuffle swaps from the end, each
    place with a uniformly drawn one at or before it."""
    p = np.arange(n)
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(p)
    return p


def ranked(docs: DataFrame, seed: int = SEED, bucket_rows: int = BUCKET_ROWS, bucket_chars: int = BUCKET_CHARS):
    """All columns, then the rank of each record (and n) in the permutation."""
    names = [c for c in docs.columns if c.lower() not in (_RANK, _SHARD, _SLOT)]
    d = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])  # names of its own: none can clash
    have = {c.lower(): f"c{i}" for i, c in enumerate(names)}
    text = F.col(have["text"]).cast("string") if "text" in have else F.lit(None).cast("string")
    n, chars = d.agg(F.count("*"), F.sum(F.length(text))).first()
    buckets = max(1, -(-n // bucket_rows), -(-(chars or 0) // bucket_chars))
    rows = d.withColumn(_H, _hash(d, seed, have.get("doc_id"), have.get("text")))
    rows = scattered(rows, seed, buckets, text, bucket_rows, bucket_chars)
    counts = rows.groupBy(_B).agg(F.count("*").alias("c"))
    # one row per bucket: the running sum over them is small beside the data
    # (written out first, so its size is known and the records need not move again to meet it)
    before = materialise(counts.select(_B, (F.sum("c").over(Window.orderBy(_B)) - F.col("c")).alias(_AT)), "bucket-offsets")
    schema = T.StructType([*d.schema.fields, T.StructField(_B, T.LongType()), T.StructField(_RANK, T.LongType())])
    cols, key = list(d.columns), have.get("text")

    def shuffle(group):
        import pyarrow as pa
        import pyarrow.compute as pc
        t = group.combine_chunks()
        b = t.column(_B)[0].as_py()
        keys = [(_H, "ascending")]
        if key is not None and pa.types.is_string(t.schema.field(key).type):
            t = t.append_column("__t", t.column(key))
            keys.append(("__t", "ascending"))
        order = pc.sort_indices(t.select([k for k, _ in keys]), sort_keys=keys)
        at = np.empty(len(t), np.int64)
        at[:] = fisher_yates(len(t), seed, b)
        # record order[i] goes to place at[i]; emit in order of place
        place = np.empty(len(t), np.int64)
        place[at] = np.asarray(order)
        out = t.select([*cols, _B]).take(pa.array(place))
        return out.append_column(_RANK, pa.array(np.arange(len(t), dtype=np.int64)))

    # a partition per bucket: what a task reads does not grow with the input
    moved = rows.repartition(min(buckets, MOST_PARTITIONS), _B).groupBy(_B).applyInArrow(shuffle, schema)
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    return moved.join(before, _B).select(*back, (F.col(_RANK) + F.col(_AT)).alias(_RANK)), n


def with_slots(docs: DataFrame, shards: int = SHARDS, **how) -> DataFrame:
    """Records with __shard and __slot."""
    rows, n = ranked(docs, **how)
    # exact in whole numbers: floor(rank * S / n), ceil(shard * n / S)
    shard = F.expr(f"cast(({_RANK} * {shards}L) div {max(n, 1)}L as int)")
    start = F.expr(f"({_SHARD} * {n}L + {shards - 1}L) div {shards}L")
    return rows.withColumn(_SHARD, shard).withColumn(_SLOT, F.col(_RANK) - start).drop(_RANK)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, **how) -> None:
    """Parquet below ``path``, one folder per shard."""
    with_slots(docs, shards, **how).write.partitionBy(_SHARD).parquet(path)


def report(docs: DataFrame) -> DataFrame:
    """Write the shards, and read back where each record is and what it holds."""
    spark = docs.sparkSession
    d = documents_core(docs)
    path = scratch_dir(spark, "shards")
    write_shards(d, path)
    schema = T.StructType([*d.schema.fields, T.StructField(_SLOT, T.LongType()), T.StructField(_SHARD, T.IntegerType())])
    back = spark.read.schema(schema).parquet(path)
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return back.select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("bigint").alias("size"),
                       F.crc32(raw).alias("text_crc32"), F.lit("rows").alias("law"), F.col(_SHARD).alias("shard"),
                       F.col(_SLOT).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
