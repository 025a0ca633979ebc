"""Stored 1-day summaries: one folder per day, written once, read by day.

An n-day table or a report of ``run_date`` reads the day folders of its window
and nothing else. A day that is not stored yet is built from the source tables
with its day window pushed to their scans, and written by dynamic partition
overwrite; the days that are there are not touched. When late rows of a day
arrive, :func:`refresh` rewrites that day alone.

A store belongs to the state of its source files (their paths, sizes and
times): over other files a new one is begun, so a stored day never outlives
the rows it was made from. Within one state a day is complete when its marker
is there, which is set after its rows have been committed; a job that stopped
half-way leaves no marker and its days are written again.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dovetail.session import shared_dir
from dovetail.sources.io import write_partitions
from dovetail.sources.tables import path as table_path

Build = Callable[[SparkSession, str, tuple[str, str]], DataFrame]


@dataclass(frozen=True)
class Daily:
    """A 1-day table: ``build(spark, sf_dir, (first, last))`` gives the rows of
    those days, with the day as text in ``dt``; ``sources``: the tables it reads."""
    name: str
    build: Build
    sources: tuple[str, ...]


_SCHEMAS: dict[str, T.StructType] = {}


def _schema(spark: SparkSession, sf_dir: str, table: Daily) -> T.StructType:
    if table.name not in _SCHEMAS:
        day = "1970-01-01"
        _SCHEMAS[table.name] = table.build(spark, sf_dir, (day, day)).schema
    return _SCHEMAS[table.name]


def day_list(first: str, last: str) -> list[str]:
    a, b = date.fromisoformat(first), date.fromisoformat(last)
    return [str(a + timedelta(days=i)) for i in range((b - a).days + 1)]


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def source_state(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> str:
    """Digest of the files of the source tables: path, size, time of change."""
    h = hashlib.sha256()
    for t in sorted(tables):
        fs, root = _fs(spark, table_path(sf_dir, t))
        files, it = [], fs.listFiles(root, True)
        while it.hasNext():
            st = it.next()
            files.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
        h.update(repr((t, sorted(files))).encode())
    return h.hexdigest()[:16]


def store_of(spark: SparkSession, sf_dir: str, table: Daily) -> str:
    return shared_dir(spark, "daily", table.name, source_state(spark, sf_dir, table.sources))


def stored_days(spark: SparkSession, store: str) -> set[str]:
    """Days that are complete, by their markers (one listing)."""
    fs, root = _fs(spark, os.path.join(store, "_days"))
    return {st.getPath().getName() for st in fs.listStatus(root)} if fs.exists(root) else set()


def _runs(days: list[str]) -> list[list[str]]:
    """Sorted days in runs without a gap."""
    out: list[list[str]] = []
    for d in sorted(days):
        if out and date.fromisoformat(d) - date.fromisoformat(out[-1][-1]) == timedelta(days=1):
            out[-1].append(d)
        else:
            out.append([d])
    return out


def _write(spark: SparkSession, sf_dir: str, store: str, table: Daily, days: list[str]) -> None:
    for run in _runs(days):
        rows = table.build(spark, sf_dir, (run[0], run[-1])).where(F.col("dt").between(run[0], run[-1]))
        write_partitions(rows, os.path.join(store, "rows"))
        for d in run:
            fs, marker = _fs(spark, os.path.join(store, "_days", d))
            fs.create(marker, True).close()


def read_days(spark: SparkSession, sf_dir: str, table: Daily, first: str, last: str, store: str | None = None) -> DataFrame:
    """The rows of the days [first, last], building those that are not stored.
    Only the folders of these days are listed and read."""
    store = store or store_of(spark, sf_dir, table)
    days = day_list(first, last)
    missing = sorted(set(days) - stored_days(spark, store))
    if missing:
        _write(spark, sf_dir, store, table, missing)
    schema = _schema(spark, sf_dir, table)
    rows = os.path.join(store, "rows")
    folders = [p for p in (os.path.join(rows, f"dt={d}") for d in days) if _exists(spark, p)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", rows).schema(schema).parquet(*folders).select(*schema.names)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def refresh(spark: SparkSession, sf_dir: str, table: Daily, days: list[str], store: str) -> None:
    """Write the given days of a store anew (late rows have arrived for them).
    A day that has no rows any more is written as an empty folder."""
    for d in sorted(set(days)):
        rows = table.build(spark, sf_dir, (d, d)).where(F.col("dt") == d).drop("dt")
        rows.write.mode("overwrite").parquet(os.path.join(store, "rows", f"dt={d}"))
        fs, marker = _fs(spark, os.path.join(store, "_days", d))
        fs.create(marker, True).close()
