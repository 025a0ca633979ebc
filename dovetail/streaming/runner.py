"""Feed a streaming plan its input in time order and drain it into a sink.

A *topic* is a derived table, written once to the shared folder in slices of
event time. Slices land one after the other; after each one the query runs to
the end of what is there (``availableNow``) and stops, and the next run
resumes from its checkpoint, the way a daily job works. What a run sees
depends on the slices' time bounds alone: not on the number, size or names of
files, nor on the order of rows in them. A run that is stopped between two
slices, or inside one, is carried on by calling it again under the same name.

A join of streams holds a batch's rows in memory until the watermark has passed
them. Such a job takes a large slice in parts: shorter spans of event time, each
delivered to the running query when it has worked off the one before, so that
the state does not grow with the topics.

Sinks are Parquet folders with a checkpoint, below the cluster's shared
checkpoint folder.
"""

from __future__ import annotations

import hashlib
import math
import os
import time
from collections.abc import Callable
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dovetail.session import job_dir
from dovetail.sources.daily import source_state

SLICES = 3

# Rows (of all topics of a job) that one core is given in one part: three joins
# of streams hold about 600 bytes for each.
ROWS_A_CORE = 400_000

# The same where a part is joined as a batch: tasks sort and spill.
ROWS_A_JOINING_CORE = 1_000_000


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


@dataclass
class Topic:
    """``rows`` by ``at``, epoch millis (null: with the first slice);
    ``arrives`` (default ``at``): when a row is delivered. ``source``: (sf_dir,
    tables) where ``rows`` is what ``name`` says of these tables and nothing
    else, so that its time bounds are known to later jobs of the session.
    ``span``: its time bounds, where they are known."""
    name: str
    rows: DataFrame
    at: Column
    arrives: Column | None = None
    source: tuple[str, tuple[str, ...]] | None = None
    span: tuple[int, int] | None = None

    def order(self) -> Column:
        return self.at if self.arrives is None else self.arrives

    def digest(self, spark: SparkSession) -> str | None:
        if self.source is None:
            return None
        what = (self.name, self.rows.schema.simpleString(), str(self.order()), source_state(spark, *self.source))
        return hashlib.sha256(repr(what).encode()).hexdigest()[:16]


_BOUNDS: dict[str, tuple] = {}


def bounds(spark: SparkSession, topics: list[Topic]) -> tuple[int, int]:
    """First and last delivery time over all topics (one small job each, once
    for a topic of known source)."""
    lo, hi = [], []
    for t in topics:
        key = t.digest(spark) if t.span is None else None
        found = _BOUNDS.get(key) if key else t.span
        if found is None:
            found = tuple(t.rows.agg(F.min(t.order()), F.max(t.order())).first())
            if key:
                _BOUNDS[key] = found
        lo.append(found[0]), hi.append(found[1])
    lo, hi = [x for x in lo if x is not None], [x for x in hi if x is not None]
    return (int(min(lo)), int(max(hi))) if lo else (0, 0)


def slice_of(at: Column, lo: int, hi: int, slices: int) -> Column:
    """Number of the slice a time falls into: equal spans from lo to hi."""
    return F.coalesce(F.floor((at - lo) * slices / (hi - lo + 1)), F.lit(0)).cast("int")


def slice_sql(at: str, lo: str, hi: str, slices: int = SLICES) -> str:
    return f"CAST(floor(CAST(({at} - {lo}) AS DOUBLE) * {slices} / ({hi} - {lo} + 1)) AS INTEGER)"


def _cuts(topics: list[Topic], lo: int, hi: int, slices: int, rows_a_part: int) -> list[int]:
    """Times at which a new part begins inside a slice: as many parts of all
    topics' rows as its size asks for, cut where the rows lie, so that a busy
    season has shorter spans."""
    at = reduce(DataFrame.unionAll, [t.rows.select(t.order().cast("bigint").alias("at")) for t in topics])
    at = at.withColumn("slice", slice_of(F.col("at"), lo, hi, slices))
    parts = {r[0]: math.ceil(r[1] / rows_a_part) for r in at.groupBy("slice").count().collect()}  # one row a slice
    large = [(i, n) for i, n in parts.items() if n > 1]
    if not large:
        return []
    found = at.agg(*[F.percentile_approx(F.when(F.col("slice") == i, F.col("at")), [k / n for k in range(1, n)], max(10_000, 20 * n))
                     .alias(f"of_{i}") for i, n in large]).first()
    return sorted({c for cuts in found for c in cuts or ()})


def _stage(spark: SparkSession, base: str, topics: list[Topic], slices: int, rows_a_part: int | None = None) -> None:
    """Write every topic in slices, and these in parts where ``rows_a_part`` asks
    for some, unless an earlier run under this name has."""
    if all(_exists(spark, os.path.join(base, "staged", t.name, "_SUCCESS")) for t in topics):
        return
    lo, hi = bounds(spark, topics)
    cuts = _cuts(topics, lo, hi, slices, rows_a_part) if rows_a_part else []
    for t in topics:
        rows, by = t.rows.withColumn("__slice", slice_of(t.order(), lo, hi, slices)), ["__slice"]
        if cuts:
            part = F.greatest(F.lit(0), *[F.when(t.order() >= c, F.lit(n)) for n, c in enumerate(cuts, 1)])
            rows, by = rows.withColumn("__part", part), ["__slice", "__part"]
        rows.write.mode("overwrite").partitionBy(*by).parquet(os.path.join(base, "staged", t.name))


def _waiting(spark: SparkSession, base: str, topics: list[Topic], i: int) -> list[str]:
    """What of slice ``i`` is still to be delivered, in order of time: its
    parts, or the slice as a whole."""
    found = set()
    for t in topics:
        fs, p = _fs(spark, os.path.join(base, "staged", t.name, f"__slice={i}"))
        if fs.exists(p):
            found |= {st.getPath().getName() for st in fs.listStatus(p)}
    parts = sorted(int(n.split("=")[1]) for n in found if n.startswith("__part="))
    return [f"__slice={i}/__part={n}" for n in parts] if parts else [f"__slice={i}"]


def _land(spark: SparkSession, base: str, topics: list[Topic], what: str) -> None:
    """Deliver a slice or part of every topic (what is delivered already stays)."""
    name = "-".join(f"{int(x.split('=')[1]):05d}" for x in what.split("/"))
    for t in topics:
        target = os.path.join(base, "landing", t.name)
        fs, to = _fs(spark, os.path.join(target, name))
        _, src = _fs(spark, os.path.join(base, "staged", t.name, what))
        fs.mkdirs(to.getParent())
        if fs.exists(src) and not fs.exists(to):
            fs.rename(src, to)


def _sources(spark: SparkSession, base: str, topics: list[Topic]) -> list[DataFrame]:
    return [spark.readStream.schema(t.rows.schema).option("recursiveFileLookup", "true")
            .parquet(os.path.join(base, "landing", t.name)) for t in topics]


@dataclass
class Restarts:
    """How often a failed run starts again from its checkpoint: up to ``most``
    failures within ``seconds``, ``pause`` seconds after each; one more ends it
    with the failure."""
    most: int = 5
    seconds: float = 300.0
    pause: float = 10.0

    def run(self, start: Callable[[], object]) -> None:
        failed: list[float] = []
        while True:
            try:
                return start().awaitTermination()
            except StreamingQueryException:
                now = time.monotonic()
                failed = [t for t in failed if now - t <= self.seconds] + [now]
                if len(failed) > self.most:
                    raise
                time.sleep(self.pause)


@dataclass
class _Fed:
    """A running query that is given ``parts`` one by one and stopped when it has
    worked off the last. One that is delivered is off the list, so a query
    started again after a failure goes on with the rest."""
    query: StreamingQuery
    parts: list[str]
    land: Callable[[str], None]

    def awaitTermination(self) -> None:
        try:
            self.query.processAllAvailable()
            while self.parts:
                self.land(self.parts[0])
                del self.parts[0]
                self.query.processAllAvailable()
        finally:
            self.query.stop()


# On a local or mounted folder the default manager starts several processes for
# every state file (Hadoop without its native library asks the shell about links).
PLAIN_FILES = {"spark.sql.streaming.checkpointFileManagerClass":
               "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"}


@contextmanager
def _lean_state(spark: SparkSession, base: str):
    """Settings of a query that starts in here: no more tasks than cores for its
    state (each writes files in every batch, and parts keep them small), and
    plain renames where the checkpoint is a folder of the machine."""
    tasks = "spark.sql.shuffle.partitions"
    lean = {tasks: str(min(int(spark.conf.get(tasks)), spark.sparkContext.defaultParallelism))}
    if _fs(spark, base)[0].getScheme() == "file":
        lean |= PLAIN_FILES
    was = {k: spark.conf.get(k, None) for k in lean}
    try:
        for k, v in lean.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _drain(spark: SparkSession, base: str, topics: list[Topic], start: Callable[[dict], StreamingQuery], slices: int,
           until: int | None, before: Callable[[int], None] | None, restarts: Restarts | None = None,
           rows_a_part: int | None = None) -> None:
    _stage(spark, base, topics, slices, rows_a_part)
    again = restarts or Restarts()
    for i in range(slices if until is None else until):
        if before:
            before(i)
        first, *rest = _waiting(spark, base, topics, i)
        _land(spark, base, topics, first)
        if rest:
            again.run(lambda: _Fed(start({"processingTime": "0 seconds"}), rest, lambda p: _land(spark, base, topics, p)))
        else:
            again.run(lambda: start({"availableNow": True}))


def run_to_table(spark: SparkSession, topics: list[Topic], build: Callable[..., DataFrame], name: str,
                 output_mode: str = "append", slices: int = SLICES, run: str | None = None,
                 until: int | None = None, restarts: Restarts | None = None, rows_a_part: int | None = None) -> DataFrame:
    """``build(*streams)`` over the topics, drained slice by slice into a
    Parquet sink (exactly-once file sink + checkpoint); the sink as a batch
    DataFrame. ``run``: a fixed name, under which a stopped run is resumed;
    ``until``: stop after so many slices; ``rows_a_part``: for joins of streams,
    rows of all topics that are delivered at once (slices with more in parts)."""
    base = job_dir(spark, f"stream-{name}", run)
    schema = []

    def start(trigger):
        out = build(*_sources(spark, base, topics))
        schema[:] = [out.schema]
        sink = (out.writeStream.format("parquet").outputMode(output_mode).option("path", os.path.join(base, "out"))
                .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(**trigger))
        with _lean_state(spark, base) if rows_a_part else nullcontext():
            return sink.start()

    _drain(spark, base, topics, start, slices, until, None, restarts, rows_a_part)
    return spark.read.schema(schema[0]).parquet(os.path.join(base, "out"))


def _none(spark: SparkSession, schema) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def join_to_table(spark: SparkSession, topics: list[Topic], build: Callable[..., DataFrame], name: str, delay_ms: int, reach_ms: int,
                  slices: int = SLICES, run: str | None = None, until: int | None = None, restarts: Restarts | None = None,
                  rows_a_part: int | None = None) -> DataFrame:
    """A chain of joins of streams, drained like ``run_to_table``: what Spark's own
    joins of streams give, without their state, which they change row by row.

    ``build(frames, before, now)`` joins a frame for each topic: the rows of a
    micro-batch (``__new`` true) and those before them that can still meet later
    ones (false: no older than ``reach_ms`` behind the watermark). It returns the
    rows that are known by the watermark after the batch (``now``) and were not
    by the one before it; see ``operators.newly_known``. The watermark is the
    least of the topics' newest times, less ``delay_ms`` (null until each has
    one); rows at or behind it when they come are late and dropped, and rows
    without a time. The stream itself carries times and the deliveries they came
    in; a batch reads the whole rows of its deliveries, each topic's own columns.
    All is keyed by batch id: a replayed batch reads what was before it and
    writes the same again."""
    base = job_dir(spark, f"stream-{name}", run)
    rows_at, held_at, seen_at = (os.path.join(base, "out", x) for x in ("rows", "held", "seen"))
    columns = [[(f"{f.name}:{f.dataType.simpleString()}", f) for f in t.rows.schema.fields] for t in topics]
    shared = {c: f for own in columns for c, f in own}

    def together(frames: list[DataFrame]) -> DataFrame:
        """Rows of all topics: the columns of any, null where a topic has none."""
        return reduce(DataFrame.unionAll, [rows.select(F.lit(i).alias("__topic"), topics[i].at.cast("bigint").alias("__at"), *[
            (F.col(f.name) if c in dict(columns[i]) else F.lit(None).cast(f.dataType)).alias(c) for c, f in shared.items()])
            for i, rows in enumerate(frames)])

    def of_topic(held: DataFrame, i: int) -> DataFrame:
        return held.where(F.col("__topic") == i).select(*[F.col(f"`{c}`").alias(f.name) for c, f in columns[i]])

    def mark(newest: list[int | None]) -> int | None:
        return None if None in newest else min(newest) - delay_ms

    none = [_none(spark, t.rows.schema) for t in topics]
    kept = together(none).schema
    schema = build([x.withColumn("__new", F.lit(True)) for x in none], None, None).schema

    def write(batch: DataFrame, bid: int) -> None:
        session, last = batch.sparkSession, _committed(spark, seen_at, bid)
        came = batch.groupBy("__topic", "__from").agg(F.max("__at").alias("newest")).collect()  # one row a delivery
        seen, held = [None] * len(topics), _none(session, kept)
        if last:
            seen = list(session.read.parquet(os.path.join(seen_at, f"batch={last[-1]}")).first())
            held = session.read.schema(kept).parquet(os.path.join(held_at, f"batch={last[-1]}"))
        newest = [max((x for x in (s, *(r.newest for r in came if r["__topic"] == i)) if x is not None), default=None)
                  for i, s in enumerate(seen)]
        before, now = mark(seen), mark(newest)
        new = []
        for i, t in enumerate(topics):
            folders = sorted(os.path.join(base, "landing", t.name, r["__from"]) for r in came if r["__topic"] == i)
            rows = session.read.schema(t.rows.schema).parquet(*folders) if folders else _none(session, t.rows.schema)
            new.append(rows.where(t.at.isNotNull() if before is None else t.at > before))
        joined = build([rows.withColumn("__new", F.lit(True)).unionAll(of_topic(held, i).withColumn("__new", F.lit(False)))
                        for i, rows in enumerate(new)], before, now)
        joined.write.mode("overwrite").parquet(os.path.join(rows_at, f"batch={bid}"))
        later = together(new).unionAll(held)
        (later if now is None else later.where(F.col("__at") >= now - reach_ms)).write.mode("overwrite").parquet(
            os.path.join(held_at, f"batch={bid}"))
        session.range(1).select(*[F.lit(x).cast("bigint").alias(f"newest_{i}") for i, x in enumerate(newest)]) \
            .write.mode("overwrite").parquet(os.path.join(seen_at, f"batch={bid}"))
        for old in last[:-1]:  # the version before stays for a replay of this batch
            for path in (held_at, seen_at):
                fs, p = _fs(spark, os.path.join(path, f"batch={old}"))
                fs.delete(p, True)

    def start(trigger):
        times = [s.select(F.lit(i).alias("__topic"), topics[i].at.cast("bigint").alias("__at"),
                          F.element_at(F.split("_metadata.file_path", "/"), -2).alias("__from"))
                 for i, s in enumerate(_sources(spark, base, topics))]
        sink = reduce(DataFrame.unionAll, times).writeStream.foreachBatch(write) \
            .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(**trigger)
        with _lean_state(spark, base):
            return sink.start()

    _drain(spark, base, topics, start, slices, until, None, restarts, rows_a_part)
    fs, p = _fs(spark, rows_at)
    fs.mkdirs(p)
    return spark.read.schema(schema).parquet(rows_at).select(*schema.names)


def run_foreach_batch(spark: SparkSession, topics: list[Topic], build: Callable[..., DataFrame], name: str,
                      fn: Callable[[DataFrame, int, str], None], slices: int = SLICES, run: str | None = None,
                      until: int | None = None, before: Callable[[int], None] | None = None,
                      restarts: Restarts | None = None) -> str:
    """Drain through ``fn(batch_df, batch_id, out_dir)``; returns out_dir.

    ``fn`` must be idempotent per batch id (it writes folders that carry the
    id, with overwrite), so a replayed batch after a failure rewrites, never
    duplicates. ``before(i)`` is called before slice i is delivered."""
    base = job_dir(spark, f"foreach-{name}", run)
    out = os.path.join(base, "out")

    def start(trigger):
        return (build(*_sources(spark, base, topics)).writeStream.foreachBatch(lambda df, bid: fn(df, bid, out))
                .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(**trigger).start())

    _drain(spark, base, topics, start, slices, until, before, restarts)
    return out


def current(spark: SparkSession, table: str) -> str | None:
    """The newest complete version of a folder of ``batch=`` versions."""
    done = _committed(spark, table)
    return os.path.join(table, f"batch={max(done)}") if done else None


def _committed(spark: SparkSession, table: str, before: int = 1 << 62, kind: str = "batch") -> list[int]:
    """Batches below ``before`` whose folder is complete, in order."""
    fs, root = _fs(spark, table)
    if not fs.exists(root):
        return []
    ids = [int(n.split("=")[1]) for n in (st.getPath().getName() for st in fs.listStatus(root)) if n.startswith(f"{kind}=")]
    return sorted(i for i in ids if i < before and _exists(spark, os.path.join(table, f"{kind}={i}", "_SUCCESS")))


# -- a stored table of key-hash buckets -----------------------------------------------------------------

@dataclass
class BucketTable:
    """A table merged batch by batch. Rows lie in ``buckets`` folders by the
    hash of their key; a batch rewrites the buckets its keys fall into and no
    others. ``batch=n/__bucket=b`` is the state of a bucket after batch n, its
    newest committed version counts. A replayed batch starts from the versions
    before it, so it writes the same rows again; two versions of a bucket are
    kept, older ones are removed. Choose ``buckets`` so that one is a few
    hundred MB; the number is part of the table."""
    path: str
    keys: tuple[str, ...]
    buckets: int = 32

    def _versions(self, spark: SparkSession, before: int = 1 << 62) -> dict[int, list[int]]:
        """bucket -> batches that wrote it, in order."""
        out: dict[int, list[int]] = {}
        for i in _committed(spark, self.path, before):
            fs, p = _fs(spark, os.path.join(self.path, f"batch={i}"))
            for st in fs.listStatus(p):
                name = st.getPath().getName()
                if name.startswith("__bucket="):
                    out.setdefault(int(name.split("=")[1]), []).append(i)
        return out

    def _folder(self, batch: int, bucket: int) -> str:
        return os.path.join(self.path, f"batch={batch}", f"__bucket={bucket}")

    def merge(self, batch: DataFrame, batch_id: int, merge: Callable[[DataFrame], DataFrame]) -> None:
        """``merge`` of the stored rows of the touched buckets and the batch's
        becomes their next version."""
        spark = batch.sparkSession
        number = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows = batch.withColumn("__bucket", number)
        touched = {r[0] for r in rows.select("__bucket").distinct().collect()}  # at most ``buckets`` numbers
        stored = [self._folder(v[-1], b) for b, v in self._versions(spark, batch_id).items() if b in touched]
        both = batch
        if stored:
            both = spark.read.schema(batch.schema).parquet(*stored).unionByName(batch)
        # one task a bucket (adaptive execution splits a large one): few files a folder
        out = merge(both).select(*batch.columns).withColumn("__bucket", number).hint("rebalance", "__bucket")
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("__bucket") \
            .parquet(os.path.join(self.path, f"batch={batch_id}"))
        for b, v in self._versions(spark).items():
            for old in v[:-2]:
                fs, p = _fs(spark, self._folder(old, b))
                fs.delete(p, True)

    def read(self, spark: SparkSession, schema) -> DataFrame:
        folders = [self._folder(v[-1], b) for b, v in self._versions(spark).items()]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


# -- keyed state ------------------------------------------------------------------------------------------

@dataclass
class KeyedState:
    """State by key over batches, stored as changes: a batch writes the keys it
    saw. A read gives the newest row of each key; every ``compact`` batches the
    changes are merged into one full version (``drop``: rows that count no
    more, given the newest batch's rows), and what it replaces is removed two
    versions later. A replayed batch reads what was before it."""
    path: str
    key: str
    compact: int = 16
    drop: Callable[[DataFrame], DataFrame] | None = None

    def read(self, spark: SparkSession, before: int) -> DataFrame | None:
        full = _committed(spark, self.path, before, "full")
        first = full[-1] if full else -1
        folders = [os.path.join(self.path, f"full={first}")] if full else []
        folders += [os.path.join(self.path, f"batch={i}") for i in _committed(spark, self.path, before) if i > first]
        if not folders:
            return None
        rows = spark.read.parquet(*folders)
        rest = [c for c in rows.columns if c not in (self.key, "__at")]
        best = rows.groupBy(self.key).agg(F.max_by(F.struct(*rest), F.col("__at")).alias("s"), F.max("__at").alias("__at"))
        return best.select(self.key, "s.*", "__at")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows.withColumn("__at", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            os.path.join(self.path, f"batch={batch_id}"))
        full = _committed(spark, self.path, kind="full")
        changes = [i for i in _committed(spark, self.path) if not full or i > full[-1]]
        if len(changes) >= self.compact:
            whole = self.read(spark, batch_id + 1)
            (self.drop(whole) if self.drop else whole).write.mode("overwrite").parquet(os.path.join(self.path, f"full={batch_id}"))
            if full:  # the version before stays for a replay of this batch
                for kind, old in [("full", i) for i in full[:-1]] + [("batch", i) for i in _committed(spark, self.path) if i <= full[-1]]:
                    fs, p = _fs(spark, os.path.join(self.path, f"{kind}={old}"))
                    fs.delete(p, True)


def rows_a_part(spark: SparkSession, a_core: int | None = None) -> int:
    return (a_core or ROWS_A_CORE) * spark.sparkContext.defaultParallelism


def stage(spark: SparkSession, df: DataFrame, name: str, run: str | None = None) -> str:
    """Write derived rows once to the shared folder and return the path (under a
    fixed run name: what an earlier call has written)."""
    out = job_dir(spark, f"stage-{name}", run)
    if not _exists(spark, os.path.join(out, "_SUCCESS")):
        df.write.mode("overwrite").parquet(out)
    return out
