"""Small fixed-value tables: a SQL ``VALUES`` list, which the analyzer turns
into a ``LocalRelation`` -- no rows travel from Python through an RDD, no
generated code, and the optimizer knows the exact size, so joins against
these tables broadcast."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float, Decimal)):
        return str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    schema = T._parse_datatype_string(ddl)
    names = [f.name for f in schema.fields]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`" for i, f in enumerate(schema.fields))
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({aliases})")
