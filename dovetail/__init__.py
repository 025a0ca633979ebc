"""dovetail: a PySpark-native daily warehouse, page analytics and streaming layer.

Every job is a DataFrame plan; the registry in :mod:`dovetail.registry` maps a
query key to its Spark builder and an independent DuckDB oracle statement.
"""

__version__ = "0.1.0"
