"""Partitioned table I/O: static / dynamic partition overwrite, guarded
loads, partition listing, re-dated copies with count reconciliation, and the
stage-and-swap report merge."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, fmt: str = "parquet", partition_col: str = "dt") -> None:
    """Overwrite exactly the ``dt`` partitions present in ``df`` (dynamic
    partition overwrite, asked for by this write: other days stay as they
    are). A static-partition write is the same call with a one-day frame."""
    # rebalance: rows of a day go to the same task (few files per day) and
    # AQE splits a day that holds far more rows than the others
    df.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(partition_col).format(fmt).save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", partition_col: str = "dt",
               schema=None) -> DataFrame:
    """Read a partitioned table; the partition value comes back as the text
    it was written as (discovery would otherwise infer a date). With a
    ``schema`` an empty table reads as zero rows instead of failing."""
    r = spark.read.format(fmt)
    t = (r.schema(schema) if schema is not None else r).load(path)
    return t.withColumn(partition_col, F.col(partition_col).cast("string")) if partition_col in t.columns else t


def _folders(spark: SparkSession, path: str, partition_col: str) -> list[str]:
    """Partition values by the names of the table's folders; no file is opened."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{partition_col}="))


def _partition(spark: SparkSession, path: str, dt: str, partition_col: str) -> DataFrame | None:
    """The rows of one partition, from its folder alone; None where there is none."""
    fs, folder = _fs(spark, os.path.join(path, f"{partition_col}={dt}"))
    if not fs.exists(folder) or not any(st.isFile() and not st.getPath().getName().startswith(("_", "."))
                                        for st in fs.listStatus(folder)):
        return None
    return spark.read.parquet(folder.toString())


def partition_exists(spark: SparkSession, path: str, dt: str, partition_col: str = "dt") -> bool:
    """Whether one partition holds a row (only its folder is listed)."""
    t = _partition(spark, path, dt, partition_col)
    return t is not None and not t.isEmpty()


def count_partition(spark: SparkSession, path: str, dt: str, partition_col: str = "dt") -> int:
    """Rows in one partition; 0 when there is none yet."""
    t = _partition(spark, path, dt, partition_col)
    return 0 if t is None else t.count()


def load_if_absent(spark: SparkSession, path: str, dt: str, build: Callable[[], DataFrame]) -> str:
    """Build and write a day only when its partition is missing; returns
    ``loaded`` or ``skipped``. Re-running a load changes nothing."""
    if partition_exists(spark, path, dt):
        return "skipped"
    write_partitions(build(), path)
    return "loaded"


def list_partitions(spark: SparkSession, path: str, partition_col: str = "dt") -> DataFrame:
    """Partition values, from the folder names (one listing, no file is opened)."""
    return spark.createDataFrame([(v,) for v in _folders(spark, path, partition_col)], f"{partition_col} string")


def copy_redate(spark: SparkSession, src: str, dst: str, new_dt: str) -> DataFrame:
    """Copy every partition of ``src`` except ``new_dt`` into partition
    ``new_dt`` of ``dst`` (overwrite of that partition only) and return the
    reconciliation row (source rows, target rows, status). One target day:
    each task writes what it reads, nothing is shuffled."""
    s = read_table(spark, src).where(F.col("dt") != new_dt)
    s.drop("dt").write.mode("overwrite").parquet(os.path.join(dst, f"dt={new_dt}"))
    return reconcile(spark, src, dst, new_dt)


def reconcile(spark: SparkSession, src: str, dst: str, new_dt: str) -> DataFrame:
    """Rows of ``src`` outside ``new_dt`` against rows of that day in ``dst``."""
    n_src = read_table(spark, src).where(F.col("dt") != new_dt).count()
    n_dst = count_partition(spark, dst, new_dt)
    return spark.createDataFrame([(os.path.basename(src.rstrip("/")), n_src, n_dst,
                                   "success" if n_src == n_dst else "mismatch")],
                                 "table string, source_rows long, target_rows long, status string")


def merge_report(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Replace-by-key merge: stored rows whose key is re-computed are dropped
    (anti join), the new rows are added."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem for ``path`` (HDFS, object stores, local): the
    shared folder is never touched through the driver's local filesystem."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _versions(spark: SparkSession, table_dir: str) -> list[tuple[int, str, bool]]:
    fs, root = _fs(spark, os.path.join(table_dir, "versions"))
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v") and name[1:].isdigit():
            done = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
            out.append((int(name[1:]), st.getPath().toString(), done))
    return sorted(out)


def stage_and_swap(spark: SparkSession, df: DataFrame, table_dir: str) -> str:
    """Spark will not overwrite a table it is reading: write the merged
    version to a new numbered folder. The job commit's ``_SUCCESS`` marker
    is the swap -- readers take the newest committed version, so a failed
    or half-written version is never read."""
    vs = _versions(spark, table_dir)
    n = (vs[-1][0] + 1) if vs else 0
    target = os.path.join(table_dir, "versions", f"v{n:05d}")
    df.write.mode("overwrite").parquet(target)
    return target


def current_version(spark: SparkSession, table_dir: str) -> str | None:
    done = [p for _, p, ok in _versions(spark, table_dir) if ok]
    return done[-1] if done else None
