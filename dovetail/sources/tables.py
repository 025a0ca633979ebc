"""Driver tables and the soft-delete partition slice."""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table as it is now (files are listed anew on every
    call). Column pruning and filters reach the scan later."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(path(sf_dir, name))


# Rows of the larger side in one task of a join of two large tables: what its
# sorts and hash maps hold stays some 400 MB however large the tables are.
ROWS_A_TASK = 500_000


def dealt(rows: int, larger: DataFrame, key: str, smaller: DataFrame, other_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of an equi-join of two large tables, dealt by their keys into
    as many tasks as ``rows``, those of the larger one, ask for. Left to
    itself, adaptive execution merges well-packed shuffles into about as many
    tasks as there are cores, and their memory grows with the tables. Tables
    that give a core no more than one such task stay as they are."""
    tasks = math.ceil(rows / ROWS_A_TASK)
    if tasks <= larger.sparkSession.sparkContext.defaultParallelism:
        return larger, smaller
    return larger.repartition(tasks, key), smaller.repartition(tasks, other_key or key)


def live_slice(df: DataFrame, run_date: str | list[str] | Column, cols: list[str] | None = None,
               dt_col: str = "dt", deleted_col: str = "is_deleted") -> DataFrame:
    """Daily partition(s), live rows only, optionally pruned to ``cols``.

    ``run_date`` is one day or a list of days (one scan either way). On a
    table partitioned by ``dt`` the test becomes a partition filter; the
    soft-delete test is pushed to the file scan.
    """
    if isinstance(run_date, list):
        day_ok = F.col(dt_col).isin(*run_date)
    else:
        day_ok = F.col(dt_col) == (run_date if isinstance(run_date, Column) else F.lit(run_date))
    out = df.where(day_ok & (F.col(deleted_col) == F.lit("0")))
    return out.select(*cols) if cols else out
