"""A slowly-changing dimension stored so that a daily merge touches the open
versions and one day of closed ones.

``as_of=<day>/end_date=9999-12-31`` holds the versions that are open after
that day's merge, ``as_of=<day>/end_date=<day before>`` those it closed. A
merge reads the open versions of the day before it and the day's changes,
meets them in one join, and writes both folders in one job; closed days are
never read or written again. Running a day again reads what was open before
it, so it writes the same. The dimension is the newest open folder and all
closed ones.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dovetail.operators.windows import latest_per_key

OPEN = "9999-12-31"


@dataclass
class ZipperStore:
    path: str
    key: str
    start: str = "start_date"
    end: str = "end_date"

    def _fs(self, spark: SparkSession, path: str):
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath

    def days(self, spark: SparkSession) -> list[str]:
        """Days whose merge is complete."""
        fs, root = self._fs(spark, self.path)
        if not fs.exists(root):
            return []
        names = [st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith("as_of=")]
        return sorted(p.getName().split("=", 1)[1] for p in names
                      if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _folders(self, spark: SparkSession, day: str) -> list[str]:
        fs, root = self._fs(spark, os.path.join(self.path, f"as_of={day}"))
        return [st.getPath().getName() for st in fs.listStatus(root) if st.getPath().getName().startswith(f"{self.end}=")]

    def _read(self, spark: SparkSession, schema, day: str, folder: str) -> DataFrame:
        base = os.path.join(self.path, f"as_of={day}")
        return spark.read.option("basePath", base).schema(schema).parquet(os.path.join(base, folder))

    def _write(self, rows: DataFrame, day: str) -> None:
        rows.hint("rebalance", self.end).write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(self.end).parquet(os.path.join(self.path, f"as_of={day}"))

    def begin(self, rows: DataFrame, day: str) -> None:
        """First load: all versions, open ones with end ``9999-12-31``."""
        self._write(rows, day)

    def open_before(self, spark: SparkSession, schema, day: str) -> DataFrame:
        """Versions open after the last merge before ``day``."""
        done = [d for d in self.days(spark) if d < day]
        if not done or f"{self.end}={OPEN}" not in self._folders(spark, done[-1]):
            return spark.createDataFrame([], schema)
        return self._read(spark, schema, done[-1], f"{self.end}={OPEN}")

    def merge(self, changes: DataFrame, day: str, order: list[str] | None = None, into: "ZipperStore | None" = None) -> None:
        """Close the open versions of changed keys the day before ``day`` and
        open the changed rows on it (of a key's rows the last by ``order``).
        ``into``: another store that takes the result."""
        spark, cols = changes.sparkSession, changes.columns
        before = F.date_format(F.date_sub(F.lit(day).cast("date"), 1), "yyyy-MM-dd")
        last = latest_per_key(changes, [self.key], order or [c for c in cols if c not in (self.key, self.start, self.end)])
        new = last.select(F.col(self.key).alias("__key"), F.struct(*[
            (F.lit(day) if c == self.start else F.lit(OPEN) if c == self.end else F.col(c)).alias(c) for c in cols]).alias("new"))
        old = self.open_before(spark, changes.schema, day).select(F.col(self.key).alias("__old"), F.struct(*cols).alias("old"))
        j = old.join(new, F.col("__old") == F.col("__key"), "full_outer")
        closed = F.struct(*[(before if c == self.end else F.col(f"old.{c}")).alias(c) for c in cols])
        out = F.when(F.col("new").isNull(), F.array("old")).when(F.col("old").isNull(), F.array("new")).otherwise(F.array(closed, "new"))
        (into or self)._write(j.select(F.explode(out).alias("v")).select("v.*"), day)

    def read(self, spark: SparkSession, schema, later: "ZipperStore | None" = None) -> DataFrame:
        """All versions: open ones of the newest merge, closed ones of every
        merge. ``later``: a store that took the merges after this one's."""
        merges = [(self, d) for d in self.days(spark)] + [(later, d) for d in (later.days(spark) if later else [])]
        out = spark.createDataFrame([], schema)
        for i, (store, d) in enumerate(merges):
            for f in store._folders(spark, d):
                if f != f"{self.end}={OPEN}" or i + 1 == len(merges):
                    out = out.unionByName(store._read(spark, schema, d, f))
        return out
