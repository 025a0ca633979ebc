"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dovetail.session import scratch_dir

#: A word is a run of characters outside this class (space and \t \n \v \f \r).
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read anew (by a path only Spark may know)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: lineage is cut and every executor can reach the rows."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def core(docs: DataFrame, *cols: tuple[str, str]) -> DataFrame:
    """Only the columns an operator works on, cast to their types: columns of
    other names, whatever they are, cannot clash with working columns."""
    have = {c.lower(): c for c in docs.columns}
    return docs.select(*[(docs[f"`{have[c.lower()]}`"] if c.lower() in have else F.lit(None)).cast(t).alias(c)
                         for c, t in cols])


def documents_core(docs: DataFrame) -> DataFrame:
    return core(docs, ("doc_id", "bigint"), ("text", "string"))


def words(text: Column) -> Column:
    """Words of a text, unchanged and in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def row_key(text: Column) -> Column:
    """With the doc_id, names a row up to rows repeated in full."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def same_row(left: DataFrame, right: DataFrame, how: str, *cols: str) -> DataFrame:
    """Join on null-safe equality of ``cols``; the right side's copies go."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[f"_r_{c}"])
        cond = e if cond is None else cond & e
    return left.join(right, cond, how).drop(*[f"_r_{c}" for c in cols])


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that are computed once per row where they stand: the
    optimizer neither copies their expressions into later ones (a lambda would
    then repeat them for every element) nor moves filters on them below."""
    for name, c in cols.items():
        df = df.select("*", F.explode(F.array(c)).alias(name))
    return df
