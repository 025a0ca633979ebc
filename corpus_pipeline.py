"""A training-data pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept, written as Parquet and read again in between. All but the last return
the columns they were given.

Defined cases: every stage takes nulls in any column, empty and long texts,
repeated rows, an empty table and columns beside those of documents, which
travel along; see the operators for what each gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dovetail.llm import odd_sketch, positional_index, quality_ledger, secret_ledger, vector_packing
from dovetail.llm.common import materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the current policy of the rule ledger keeps."""
    return quality_ledger.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: its smallest doc_id."""
    return odd_sketch.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return positional_index.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in them replaced by a mask."""
    return secret_ledger.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return vector_packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secret_scans", secret_scans), ("best_fit_packing", best_fit_packing)]

#: Token ids and best-fit packing have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
