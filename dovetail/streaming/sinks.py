"""Sink tables that come and go with a routing config while a stream runs.

The config is a change log (op ``r`` / ``c``: create unless it is there, ``u``:
drop and create anew, ``d``: drop). A data row goes to the sink its source
table is routed to at the row's time, if there is one; a table holds what came
since it was made. The catalogue after a batch is one small file named by the
batch, so a replayed batch starts from the one before it. Each making of a
sink has a folder of its own, a :class:`~dovetail.streaming.runner.BucketTable`
with the configured columns and no others; dropped folders are deleted once the
catalogue without them is written.

The catalogue and the changes of a batch are read by the driver: they are
table definitions, as many as the config has, whatever the data.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dovetail.operators.windows import latest_per_key
from dovetail.streaming.runner import BucketTable, _committed, _fs

_CATALOG = "table string, source string, key string, columns string, since bigint"


@dataclass(frozen=True)
class Sink:
    """``columns``: names of the change's fields, comma-joined; ``since``: time
    of the config change that made the table."""
    table: str
    source: str
    key: str
    columns: str
    since: int


@dataclass(frozen=True)
class Change:
    op: str
    sink: Sink  # ``since`` is the time of the change


def after_changes(sinks: dict[str, Sink], changes: Iterable[Change]) -> dict[str, Sink]:
    """The catalogue after the changes, in order of their times."""
    out = dict(sinks)
    for c in sorted(changes, key=lambda c: (c.sink.since, c.sink.table)):
        if c.op == "d":
            out.pop(c.sink.table, None)
        elif c.op == "u" or c.sink.table not in out:
            out[c.sink.table] = c.sink
    return out


@dataclass
class SinkCatalog:
    path: str
    buckets: int = 8

    def at(self, spark: SparkSession, before: int = 1 << 62) -> dict[str, Sink]:
        """Sinks as they are after the last batch below ``before``."""
        done = _committed(spark, os.path.join(self.path, "catalog"), before)
        if not done:
            return {}
        rows = spark.read.schema(_CATALOG).parquet(os.path.join(self.path, "catalog", f"batch={done[-1]}")).collect()
        return {r["table"]: Sink(**r.asDict()) for r in rows}

    def _folder(self, s: Sink) -> str:
        return os.path.join(self.path, "tables", s.table, f"since={s.since}")

    def _store(self, s: Sink) -> BucketTable:
        return BucketTable(self._folder(s), ("row_key",), self.buckets)

    def run(self, spark: SparkSession, batch_id: int, changes: Iterable[Change], rows: DataFrame) -> None:
        """One batch: config ``changes``, and data ``rows`` (source, after:
        map of texts, ts_ms; no deletes)."""
        sinks = after_changes(self.at(spark, batch_id), changes)
        here = {r[0] for r in rows.select("source").distinct().collect()} if sinks else set()  # source tables, as many as the config routes
        for s in sinks.values():
            if s.source in here:
                mine = rows.where((F.col("source") == s.source) & (F.col("ts_ms") >= s.since))
                a = F.col("after")
                mine = mine.select(F.md5(F.element_at(a, s.key)).alias("row_key"),
                                   *[F.element_at(a, c).alias(c) for c in s.columns.split(",")], "ts_ms")
                order = ["ts_ms", *s.columns.split(",")]
                self._store(s).merge(mine, batch_id, lambda r, o=order: latest_per_key(r, ["row_key"], o))
        spark.createDataFrame([tuple(asdict(s).values()) for s in sinks.values()], _CATALOG).coalesce(1) \
            .write.mode("overwrite").parquet(os.path.join(self.path, "catalog", f"batch={batch_id}"))
        self._remove_others(spark, sinks)

    def _remove_others(self, spark: SparkSession, sinks: dict[str, Sink]) -> None:
        kept = {self._folder(s) for s in sinks.values()}
        fs, root = _fs(spark, os.path.join(self.path, "tables"))
        for table in fs.listStatus(root) if fs.exists(root) else []:
            for made in fs.listStatus(table.getPath()):
                name = os.path.join(self.path, "tables", table.getPath().getName(), made.getPath().getName())
                if name not in kept:
                    fs.delete(made.getPath(), True)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The table as its config has it now; a KeyError where there is none."""
        s = self.at(spark)[table]
        schema = ", ".join(["row_key string", *[f"`{c}` string" for c in s.columns.split(",")], "ts_ms bigint"])
        return self._store(s).read(spark, schema)
